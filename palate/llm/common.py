"""What the operators of this subpackage share: tables, word rules, column handling."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Upper and lower case of A-Z, the only letters whose case is folded.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word between white space, as a pattern that Java, Python and RE2 read alike.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
#: A word of digits, a-z and anything beyond ASCII, after folding.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# One byte to one byte: folds A-Z and blanks ASCII that is neither digit nor letter.
# All bytes of a character beyond ASCII are above 0x7F and stay.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))
_PLAIN_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def folded(text: bytes | None) -> bytes:
    """A UTF-8 text with A-Z folded and all but words blanked; every byte keeps its place."""
    return text.translate(_PLAIN) if text else b""


def plain_words(text: bytes | None) -> list[bytes]:
    """The folded words of a UTF-8 text; ``bytes.split`` cuts at ASCII white space only."""
    return folded(text).split()


def plain_offsets(text: bytes) -> list[tuple[int, int]]:
    """Where each of ``plain_words`` lies in the text, in bytes."""
    return [m.span() for m in _PLAIN_WORD.finditer(folded(text))]


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(stem: str) -> str:
    """A column name that no input has."""
    return f"__{stem}_{uuid.uuid4().hex[:12]}"


def others(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """The columns of ``df`` but for ``names``, compared without case as Spark does."""
    taken = {n.lower() for n in names}
    return [quoted(c) for c in df.columns if c.lower() not in taken]


def with_fields(df: DataFrame, struct: Column, names: Sequence[str]) -> DataFrame:
    """Add the fields ``names`` of ``struct``; input columns of those names give way."""
    hold = fresh("fields")
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]
    wide = df.withColumn(hold, struct)
    return wide.select(*(quoted(c) for c in kept), *(F.col(f"{hold}.{n}").alias(n) for n in names))


def spaced_word_count(text: Column) -> Column:
    """Number of white-space separated words, 0 for null, without leaving the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")
