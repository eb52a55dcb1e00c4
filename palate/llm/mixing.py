"""Sources mixed to target weights by weighted sampling without replacement.

Every source gets a target of words: its weight's share of the budget, at most
``MAX_EPOCHS`` times its own size, what is above being shared again by weight. A
source is taken whole as often as its target allows; for the rest, documents are drawn
by the method of Efraimidis and Spirakis: each draws an exponential key divided by
its quality weight, and the smallest keys are taken until the rest is filled. The
draw is a hash of the document's id, so reruns agree.

Documents are never sorted or shuffled by source. Keys are cut into ``CELLS`` cells, cells are totalled
map-side and prefix-summed (at most ``CELLS`` rows for each source), and in each source one cell is left in which
the rest runs out. Only what that cell holds (ids and sizes, no texts, equal rows counted) is ordered, which
gives each source one cut; every row is then decided in the scan against its source's cut. That table, a
row for each source, and the labels, a row for each labelled document, are broadcast up to ``MAX_SENT`` rows;
larger ones are joined so that a hot source or id is split. Numbering the sources and levelling their
targets gathers a row for each partition and for each of some thousand cells of ratios, not the sources.

Null sources form one source, the last. Null and empty texts have size 0 and are never
taken. Equal keys, which only equal ids have, are ordered by size, then by a hash of the row; of rows equal in
all that, as many are taken as fit. Texts of any length are counted whole. Empty
tables give empty results. Input columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegralType

from palate.llm.common import fresh, others, quoted, spaced_word_count, table
from palate.operators.ids import dense_index
from palate.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
CELLS = 1 << 14
#: Cells for each doubling of the ratio of a source's size to its weight.
RATIO_CELLS = 64
#: Rows of sources or labels that may be broadcast, some 50 bytes each.
MAX_SENT = 1 << 20
SEED = "mix-1"
RESULTS = ("size", "source_size", "target", "copies", "taken")
#: What orders the rows of a source; ``cell`` follows from ``key``.
FACT = ("cell", "key", "id", "size", "print")
#: Quality weight by label; unlabelled documents stand between.
QUALITY = {1: 1.0, 0: 0.2, None: 0.5}


def exponential_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """An Exp(weight) draw from 52 bits of a digest of the id."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13), 16, 10)
    uniform = (bits.cast("double") + 0.5) / float(1 << 52)
    return -F.log(uniform) / weight


def attached(rows: DataFrame, per_key: DataFrame, key: str, how: str = "left", max_sent: int = MAX_SENT) -> DataFrame:
    """``rows`` with the columns of ``per_key``, a written table with one row for each ``key``.

    A small table is broadcast. Beyond ``max_sent`` rows its key is computed anew, so that it comes from
    an exchange of its own and adaptive execution can split a hot key, null included.
    """
    if per_key.count() <= max_sent:
        return rows.join(F.broadcast(per_key), key, how)
    whole = isinstance(per_key.schema[key].dataType, IntegralType)
    again = F.col(key).bitwiseOR(0) if whole else F.concat(F.col(key).cast("string"), F.lit(""))
    return rows.join(per_key.select(again.alias(key), *(c for c in per_key.columns if c != key)), key, how)


def source_targets(sizes: DataFrame, budget: Column | None = None, weights: tuple[float, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(src, source_size, target)`` from ``(src, source_size)``, one row per source.

    Where the level L satisfies sum(min(cap, L * weight)) = budget, sources with
    cap / weight up to L are full and the others get L * weight. In the order of cap / weight
    the full ones come first, so L follows from two running sums: over cells of the ratio, of which
    there are ``RATIO_CELLS`` for each doubling, and over the distinct ratios within a cell.
    """
    place = F.pmod(F.col("index"), F.lit(len(weights))) + 1
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), place)
    ratio = F.col("cap") / F.col("w")
    caps = materialize(sizes.join(dense_index(sizes, "src"), "src")
                       .select("src", "source_size", weight.alias("w"), (F.col("source_size") * max_epochs).alias("cap"))
                       .withColumn("ratio", ratio))
    cell = F.when(F.col("ratio") > 0, F.floor(F.log2("ratio") * RATIO_CELLS)).otherwise(-(1 << 20))
    ratios = caps.groupBy("ratio").agg(F.sum("cap").alias("cap"), F.sum("w").alias("w")).withColumn("cell", cell)
    ratios = materialize(ratios)
    by_cell = Window.orderBy("cell")  # of at most RATIO_CELLS rows for each doubling, some 4,000
    before, after = (lambda w: w.rowsBetween(Window.unboundedPreceding, -1)), (lambda w: w.rowsBetween(0, Window.unboundedFollowing))
    cells = ratios.groupBy("cell").agg(F.sum("cap").alias("cap"), F.sum("w").alias("w"))
    cells = cells.select("cell", F.coalesce(F.sum("cap").over(before(by_cell)), F.lit(0)).alias("cap_before"),
                         (F.sum("w").over(after(by_cell)) - F.col("w")).alias("w_after"))
    within = Window.partitionBy("cell").orderBy("ratio")
    total = sizes.agg(F.sum("source_size")).scalar() if budget is None else budget
    levelled = (ratios.join(F.broadcast(cells), "cell")
                .withColumn("filled", F.col("cap_before") + F.coalesce(F.sum("cap").over(before(within)), F.lit(0)))
                .withColumn("share", F.col("w_after") + F.sum("w").over(after(within)))
                .select("ratio", ((total - F.col("filled")) / F.col("share")).alias("level")))
    level = levelled.filter(F.col("ratio") > F.col("level")).agg(F.min(F.struct("ratio", "level"))["level"]).first()[0]
    cap = F.col("cap").cast("double")
    target = cap if level is None else F.when(F.col("ratio") <= level, cap).otherwise(F.least(cap, F.lit(level) * F.col("w")))
    return caps.select("src", "source_size", target.alias("target"))


def _cuts(facts: DataFrame, weights: tuple[float, ...], max_sent: int) -> DataFrame:
    """``(src, source_size, target, epochs, cut, spare)``, written: rows before ``cut`` are taken once more.

    ``cut`` is the first row that is not, null where all are; of ``n`` rows equal to it ``spare`` are.
    The row on the edge is taken where that brings the source nearer to its target.
    """
    cells = materialize(facts.groupBy("src", "cell").agg(F.sum("size").alias("cell_size")))
    sizes = materialize(cells.groupBy("src").agg(F.sum("cell_size").alias("source_size")))
    before = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    planned = (source_targets(sizes, weights=weights).withColumn("epochs", epochs)
               .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    planned = materialize(planned)
    running = attached(cells.withColumn("before", F.coalesce(F.sum("cell_size").over(before), F.lit(0))), planned, "src", "inner", max_sent)
    # Rows of a cell that ends by the rest are all taken, rows of one that begins after it are not.
    open_ = materialize(running.filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("cell_size")))
                        .select("src", F.col("cell").alias("open"), "before", "rest"))
    held = attached(facts, open_, "src", "inner", max_sent).filter(F.col("cell") == F.col("open"))
    alike = held.groupBy("src", *FACT, "before", "rest").agg(F.count("*").alias("n"))
    order = Window.partitionBy("src").orderBy(*FACT).rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(order), F.lit(0))
    # The k-th of n equal rows is taken if at + (k - 1) * size + size / 2 <= rest.
    fitting = F.floor(F.try_divide(F.col("rest") - F.col("at"), F.col("size")) + 0.5).cast("long")
    taken = F.when(F.col("size") == 0, F.col("n")).otherwise(F.greatest(F.lit(0), F.least(F.col("n"), fitting)))
    first = (alike.withColumn("at", at).withColumn("spare", taken.cast("long")).filter(F.col("spare") < F.col("n"))
             .groupBy("src").agg(F.min(F.struct(*FACT, "spare")).alias("m")))
    # Where the last row of the open cell was still nearer taken, the cut is the next cell's beginning; nulls are least.
    nothing = [F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in FACT[1:]]
    next_cell = F.struct((F.col("open") + 1).alias("cell"), *nothing)
    cuts = open_.join(first, "src", "left").select(
        "src", F.when(F.col("m").isNull(), next_cell).otherwise(F.struct(*(F.col(f"m.{c}").alias(c) for c in FACT))).alias("cut"),
        F.coalesce("m.spare", F.lit(0)).cast("long").alias("spare"))
    # Without an open cell a source has no words.
    return materialize(planned.join(cuts, "src", "left").drop("rest"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        words: Column | None = None, weight: Column | None = None,
        weights: tuple[float, ...] = WEIGHTS, max_sent: int = MAX_SENT) -> DataFrame:
    """``docs`` with ``RESULTS``; ``copies`` is how often the mix takes the document.

    ``words`` is the document's size where it is known already, ``weight`` its quality
    weight, a positive column of ``docs``.
    """
    hashed = [quoted(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    src = F.when(quoted(source).isNull(), "1").otherwise(F.concat(F.lit("0"), quoted(source)))
    key = exponential_key(quoted(doc_id), F.lit(1.0) if weight is None else weight)
    size = spaced_word_count(quoted(text)) if words is None else words
    fact = F.struct(F.floor(key / (key + 1) * CELLS).cast("int").alias("cell"), key.alias("key"), quoted(doc_id).alias("id"),
                    size.cast("long").alias("size"), F.xxhash64(*hashed).alias("print"))
    hold, name = fresh("fact"), fresh("src")
    facts = docs.select(src.alias("src"), fact.alias("f")).select("src", "f.*")
    cuts = _cuts(facts, weights, max_sent)
    fields = ("source_size", "target", "epochs", "cut", "spare")
    named = {c: fresh(c) for c in fields}
    decided = attached(docs.withColumn(hold, fact).withColumn(name, src), cuts.withColumnsRenamed({"src": name, **named}), name, "inner", max_sent)
    cut, spare = F.col(named["cut"]), F.col(named["spare"])
    more = fresh("more")
    decided = decided.withColumn(more, F.when(cut.isNull() | (F.col(hold) < cut), 1).otherwise(0))
    if not cuts.filter("spare > 0").isEmpty():
        decided = _share(decided, F.col(hold) == cut, spare, name, more)
    size = F.col(f"{hold}.size")
    copies = F.when(size > 0, F.col(named["epochs"]) + F.col(more)).otherwise(0).cast("long")
    return decided.select(*others(docs, RESULTS), size.alias("size"), F.col(named["source_size"]).alias("source_size"),
                          F.col(named["target"]).alias("target"), copies.alias("copies"), (copies * size).alias("taken"))


def _share(rows: DataFrame, tied: Column, spare: Column, src: str, more: str) -> DataFrame:
    """``rows`` in which of the ``tied`` ones of a source as many as ``spare`` says get ``more``.

    Only the tied rows are written and numbered: within their partition, after the totals of the
    partitions before it, so that even a third of all rows being equal stay spread out.
    """
    part, place, total = fresh("part"), fresh("place"), fresh("total")
    some = F.coalesce(tied & (spare > 0), F.lit(False))
    own = materialize(rows.filter(some)).withColumn(place, F.monotonically_increasing_id())
    own = own.withColumn(part, F.shiftright(place, 33))
    earlier = Window.partitionBy(src).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = own.groupBy(src, part).agg(F.count("*").alias(total)).withColumn(total, F.coalesce(F.sum(total).over(earlier), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(src, part).orderBy(place))
    numbered = own.withColumn(place, rank).join(totals, [src, part])
    chosen = numbered.withColumn(more, F.when(F.col(total) + F.col(place) <= spare, 1).otherwise(0))
    return rows.filter(~some).unionByName(chosen.select(*rows.columns))


def with_quality(docs: DataFrame, labels: DataFrame, weight: str, doc_id: str = "doc_id", max_sent: int = MAX_SENT) -> DataFrame:
    """``docs`` with the column ``weight`` from the best label of each document."""
    key, label = fresh("label_id"), fresh("quality")
    best = materialize(labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.max("quality").alias(label)))
    joined = attached(docs.withColumn(key, quoted(doc_id)), best, key, "left", max_sent)
    value = F.when(F.col(label) == 1, QUALITY[1]).when(F.col(label) == 0, QUALITY[0]).otherwise(QUALITY[None])
    return joined.withColumn(weight, value).drop(key, label)


def mix_by_quality(docs: DataFrame, labels: DataFrame, words: Column | None = None, doc_id: str = "doc_id",
                   max_sent: int = MAX_SENT, **names: str) -> DataFrame:
    weight = fresh("weight")
    rated = with_quality(docs, labels, weight, doc_id, max_sent)
    return mix(rated, doc_id=doc_id, words=words, weight=F.col(weight), max_sent=max_sent, **names).drop(weight)


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed with weights 5, 2, 1 to 100 % of all words."""
    docs = table(spark, folder, "documents").select("doc_id", "source", spaced_word_count(F.col("text")).alias("words"))
    mixed = mix_by_quality(docs, table(spark, folder, "labels"), words=F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE_CTES = r"""
d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             -ln((('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
             / CASE quality WHEN 1 THEN 1.0 WHEN 0 THEN 0.2 ELSE 0.5 END AS k
      FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)),
s AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
c AS (SELECT *, 3 * source_size AS cap, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY src) - 1) % 3) + 1]::DOUBLE AS w FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / sum(w) OVER (ORDER BY cap / w, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
f AS (SELECT *, cap / w <= level AS is_full FROM l),
t AS (SELECT src, source_size, CASE WHEN is_full OR level1 IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, level1 * w) END AS target
      FROM f, (SELECT min_by(level, cap / w) FILTER (NOT is_full) AS level1 FROM f)),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
r AS (SELECT d.doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
             coalesce(sum(size) OVER (PARTITION BY src ORDER BY k, d.doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
      FROM d JOIN e USING (src))"""
QUERIES = {"op9_mixing": op9_mixing}
ORACLES = {"op9_mixing": f"""WITH {ORACLE_CTES}
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN pos + size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM r"""}
