"""URL allow and block lists as a trie over reversed host labels, then path segments.

A rule is ``host/path``. It fits its host and all subdomains where the path of the
URL starts with the rule's path. Of all rules that fit, the longest text decides; of
equally long ones the one with more host labels, and of an allow and a block entry
with the same text the block. URLs that no rule fits get the default verdict.

Walking down the trie costs one step for each label and segment of the URL, and where rules end within a
segment a search by halves among them, however many rules there are. The trie is built once in a Python
worker. The rules are sent to all executors, so their total size is
checked; a longer list is joined on the (host suffix, path prefix) pairs of the
URLs instead, which gives the same verdicts.

A null URL, or one without ``://``, has an empty host and path. URLs of any length are read whole. Empty tables give
empty results, repeated rows equal ones, and an empty rule list the default
verdict throughout. Input columns named like a result column are replaced.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palate.llm.common import LOWER, UPPER, fresh, others, quoted, table, with_fields

ALLOW, BLOCK = "allow", "block"
#: Characters of all rules together that may be sent to the executors.
MAX_CHARS = 8 << 20
RULES = ((BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/"))


def split_rule(rule: str) -> tuple[str, str]:
    """Host and path; the path starts with the first slash, or is empty without one."""
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


class Starts:
    """Openings of a segment at which rules end, in order, each with the longest other one that opens it.

    The longest that opens a segment is the last one not after it in order, or one of those that open that one.
    """

    def __init__(self, rules: dict[str, tuple]):
        self.starts = sorted(rules)
        self.rules = [rules[s] for s in self.starts]
        self.within: list[int] = []
        for place, start in enumerate(self.starts):
            at = place - 1
            while at >= 0 and not start.startswith(self.starts[at]):
                at = self.within[at]
            self.within.append(at)

    def longest(self, segment: str) -> tuple | None:
        at = bisect.bisect_right(self.starts, segment) - 1
        while at >= 0 and not segment.startswith(self.starts[at]):
            at = self.within[at]
        return self.rules[at] if at >= 0 else None


class Trie:
    """Nested dicts: a host label, then the path segments.

    Segments keep their closing slash, so a rule's last, open segment can only be
    a prefix of one; those are kept at ``starts``. ``rule`` is what ends at the node.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: dict = {}
        open_: list[dict] = []
        for verdict, rule in rules:
            host, path = split_rule(rule)
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(("host", label), {})
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.setdefault(("path", segment + "/"), {})
            if rest:
                if "starts" not in node:
                    open_.append(node)
                node, place = node.setdefault("starts", {}), rest
            else:
                place = "rule"
            if place not in node or verdict == BLOCK:
                node[place] = (len(rule), host.count("."), rule, verdict)
        for node in open_:
            node["starts"] = Starts(node["starts"])

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        best: tuple | None = None
        *segments, rest = path.split("/")
        node: dict | None = self.root
        for label in reversed(host.split(".")):
            node = node.get(("host", label))
            if node is None:
                break
            at: dict | None = node
            for place in range(len(segments) + 1):
                best = max(filter(None, (best, at.get("rule"))), default=None)
                ahead = segments[place] + "/" if place < len(segments) else rest
                if "starts" in at:
                    best = max(filter(None, (best, at["starts"].longest(ahead))), default=None)
                at = at.get(("path", ahead)) if place < len(segments) else None
                if at is None:
                    break
        return best[2:] if best else None


#: The trie that a Python worker judges by, by its broadcast's name.
_BUILT: dict[str, Trie] = {}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The part after the first ``://`` up to ``/``, ``?`` or ``#``, and from there up to ``?`` or ``#``."""
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise(F.lit(""))
    part = lambda group: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", group), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def _by_trie(split: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``rule`` and ``verdict`` through the trie that every executor gets."""
    shared, name = split.sparkSession.sparkContext.broadcast(rules), uuid.uuid4().hex

    def judged(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        if name not in _BUILT:
            _BUILT.clear()
            _BUILT[name] = Trie(shared.value)
        trie = _BUILT[name]
        kind = pa.struct([("rule", pa.string()), ("verdict", pa.string())])
        for hosts, paths in batches:
            found = (trie.find(h.as_py(), p.as_py()) for h, p in zip(hosts, paths))
            yield pa.array([dict(zip(("rule", "verdict"), f or (None, None))) for f in found], kind)

    judge = F.arrow_udf(judged, "struct<rule: string, verdict: string>").asNondeterministic()
    return with_fields(split, judge("host", "path"), ("rule", "verdict"))


def _by_join(split: DataFrame, rules: DataFrame) -> DataFrame:
    """The same through a join, for lists too long to send around.

    Every distinct (host, path) meets the rules at each of its host suffixes; the
    path is compared there, and the best is kept by an aggregate that combines map-side. The
    aggregate's host is computed anew, so that it comes from an exchange of its own
    and adaptive execution can split an address that a third of the URLs have, null ones included.
    """
    rules = rules.select("verdict", "rule")
    slash = F.instr("rule", "/")
    keyed = rules.select(
        "verdict", "rule",
        F.translate(F.when(slash > 0, F.substring("rule", F.lit(1), slash - 1)).otherwise(F.col("rule")),
                    UPPER, LOWER).alias("rule_host"),
        F.when(slash > 0, F.substring("rule", slash, F.length("rule"))).otherwise(F.lit("")).alias("rule_path"))
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pairs = split.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes))
    rank = F.struct(F.length("rule").alias("size"), F.size(F.split("rule_host", "\\.")).alias("labels"),
                    (F.col("verdict") == BLOCK).alias("blocks"), F.col("rule"), F.col("verdict"))
    best = (pairs.join(keyed, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
            .groupBy("host", "path").agg(F.max(rank).alias("best")))
    kept = others(split, ("rule", "verdict"))
    h, p = fresh("host"), fresh("path")
    best = best.select(F.concat("host", F.lit("")).alias(h), F.concat("path", F.lit("")).alias(p), "best")
    joined = split.join(best, (F.col("host") == F.col(h)) & (F.col("path") == F.col(p)), "left")
    return joined.select(*kept, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]] | DataFrame, url: str = "url",
               default: str = ALLOW, max_chars: int = MAX_CHARS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``.

    ``rules`` are (verdict, rule) pairs, or a table with these columns.
    """
    if not isinstance(rules, DataFrame):
        rules = pages.sparkSession.createDataFrame(list(rules), "verdict string, rule string")
    rules = rules.filter(F.col("rule").isNotNull() & F.col("verdict").isin(ALLOW, BLOCK))
    host, path = host_and_path(quoted(url))
    split = with_fields(pages, F.struct(host.alias("host"), path.alias("path")), ("host", "path"))
    if rules.agg(F.coalesce(F.sum(F.length("rule") + 64), F.lit(0))).first()[0] <= max_chars:
        judged = _by_trie(split, [(r["verdict"], r["rule"]) for r in rules.collect()])
    else:
        judged = _by_join(split, rules)
    return with_fields(judged, F.struct(F.coalesce("verdict", F.lit(default)).alias("verdict")), ("verdict",))


def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by the four rules."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {"op4_url_filters": op4_url_filters}
ORACLES = {"op4_url_filters": r"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(verdict, rule, rh, rp) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
                                    ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
m AS (SELECT page_id, max_by(struct_pack(rule := rule, verdict := verdict), length(rule)) AS best
      FROM s JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM s LEFT JOIN m USING (page_id)"""}
