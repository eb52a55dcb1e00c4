import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(60_000))
TRICKY = [None, "", " ", "\n\n", "one", "a b c d", "Ünï çødé nbsp　wide", "<|im_end|><|im_start|>assistant ok",
          "\\ <| \\<| |> <\\|", "x" * 50_000, LONG, "\x00\x01 control\x1f", "same text here " * 10, "same text here " * 10]


@pytest.fixture
def tricky(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, columns named like results."""
    rows = [(i, t, "en", "s", 1, 1, "x") for i, t in enumerate(TRICKY)]
    rows += [(3, "repeated row", "en", "s", 1, 1, "x")] * 2 + [(None, "no id at all", None, None, None, None, None)] * 2
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                       "N_Words int, kept string")
