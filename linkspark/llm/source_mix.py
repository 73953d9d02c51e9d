"""Mixing sources to target weights by systematic sampling, in built-in functions only.

Sources share the total size by weight; no target exceeds ``cap`` times its source's size, and what is
cut goes to the others by weight until none is above (solved in one pass: the common level of size per
weight at which the capped shares add up to the total).  Within a source every document expects
``target / source size`` copies.  Documents stand in order of (size, doc_id), their expected copies are
summed up from a random start, and a document is emitted once for each integer its stretch crosses.
Neighbours have like sizes, so the words taken stay within about one large document of the target.

The prefix sum needs no window over a source: documents are dealt out in ranges of (source, size,
doc_id), which split a hot source like any other, and a row's place is its place in the range plus the
counts of the ranges before.  One exchange of the rows; all else is one row per range and source.

Defined cases: a null text has size 0; a null source is one source, last in order; ids may be null or
repeated (repeated rows are separate documents); a source without words gets target 0; an empty table
gives an empty result; reruns agree, since the order is total up to equal rows and the start comes from
the seed and the source's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkspark.llm.common import WORD, materialise, read

WEIGHTS, CAP, SEED = (5, 2, 1), 3, "mix-1"
#: The table of ranges is broadcast up to so many rows, and joined by its keys beyond.
BROADCAST_ROWS = 100_000
MIX_COLUMNS = ("mix_size", "mix_source_size", "mix_target", "mix_copies")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size`` (one row per source) with each source's ``target``."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("_n", F.row_number().over(order)).withColumn(
        "_w", F.element_at(F.array(*(F.lit(x) for x in weights)), ((F.col("_n") - 1) % len(weights) + 1).cast("int")))
    w = w.withColumn("_most", F.col("source_size") * cap)
    filled = Window.orderBy(F.col("_most").cast("double") / F.col("_w"), "_n")
    before = F.coalesce(F.sum("_most").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = ((F.sum("source_size").over(Window.partitionBy()) - before).cast("double")
             / F.sum("_w").over(filled.rowsBetween(0, Window.unboundedFollowing)).cast("double"))
    w = w.withColumn("_level", level)
    fits = F.when(F.col("_level") <= F.col("_most").cast("double") / F.col("_w"), F.col("_level"))
    w = w.withColumn("_level", F.max(fits).over(Window.partitionBy()))
    most = F.col("_most").cast("double")
    return w.select("source", "source_size", F.coalesce(F.least(most, F.col("_level") * F.col("_w")), most).alias("target"))


def offset(source: Column, seed: str = SEED) -> Column:
    """The source's random start in [0, 1)."""
    name = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit(""))).cast("binary"))
    return F.conv(F.substring(name, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mixing_plan(docs: DataFrame, size: Column, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``source``) with ``mix_size, mix_source_size, mix_target`` and
    ``mix_copies``, the number of times the mix takes the document; columns of ``docs`` with these names
    are replaced."""
    plan, columns = _plan(docs, size, weights, cap, seed)
    return plan.select(*(v for c, v in columns.items() if c not in MIX_COLUMNS), *MIX_COLUMNS)


def _plan(docs: DataFrame, size: Column, weights: tuple[int, ...], cap: int, seed: str) -> tuple[DataFrame, dict[str, Column]]:
    """The rows of ``docs`` with ``MIX_COLUMNS``, and how to get each of the columns of ``docs`` back: all but
    the keys travel inside one struct, so that no name among them can clash."""
    keys = ("source", "mix_size", "doc_id")
    others = [c for c in docs.columns if c not in ("source", "doc_id")]
    columns = {c: F.col("_row").getField(c).alias(c) if c in others else F.col(c) for c in docs.columns}
    row = F.struct(*others) if others else F.lit(0)
    kept = docs.select("source", "doc_id", row.alias("_row"), size.alias("mix_size"))
    placed = materialise(kept.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("_at", F.monotonically_increasing_id()), "mix-ranges")
    rng = F.shiftright("_at", 33)
    ranges = materialise(placed.groupBy(rng.alias("_range"), "source").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"), F.sum("mix_size").alias("_words")), "mix-counts")
    sizes = ranges.groupBy("source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sizes, weights, cap).select(
        F.col("source").alias("_s"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    so_far = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    at = ranges.withColumn("_before", F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
    at = at.join(targets, F.col("source").eqNullSafe(F.col("_s"))).select(
        "_range", "_s", (F.col("_before") - F.col("_first") + 1).alias("_shift"), "mix_source_size", "mix_target")
    if ranges.count() <= BROADCAST_ROWS:
        at = F.broadcast(at)
    rows = placed.withColumn("_r", rng).join(at, (F.col("_r") == F.col("_range")) & F.col("source").eqNullSafe(F.col("_s")))
    each = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(0.0)
    place = (F.col("_at") + F.col("_shift")).cast("double")
    start = offset(F.col("source"), seed)
    crossed = F.floor(place * each + start) - F.floor((place - 1) * each + start)
    # expected copies never exceed cap, so this only guards against rounding of the products
    return rows.withColumn("mix_copies", F.least(crossed, F.lit(cap).cast("long"))), columns


def mix(docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as the plan takes it."""
    plan, columns = _plan(docs, n_words(F.col("text")) if size is None else size, weights, cap, seed)
    taken = plan.where("mix_copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select(*columns.values())


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    plan = mixing_plan(docs, F.col("size"))
    return plan.select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
                       (F.col("mix_copies") * F.col("size")).alias("taken"), F.col("mix_copies").alias("copies"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM s
), v AS (
  SELECT *, [5, 2, 1][(n - 1) % 3 + 1] AS weight, source_size * 3 AS most FROM w
), l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY CAST(most AS DOUBLE) / weight, n
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (ORDER BY CAST(most AS DOUBLE) / weight, n
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM v
), t AS (
  SELECT source, source_size, coalesce(least(CAST(most AS DOUBLE), weight *
    max(CASE WHEN level <= CAST(most AS DOUBLE) / weight THEN level END) OVER ()), CAST(most AS DOUBLE)) AS target,
    CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS start
  FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.start,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS each,
    CAST(row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST) AS DOUBLE) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, CAST(least(floor(place * each + start) - floor((place - 1) * each + start), 3) AS BIGINT) AS copies FROM p
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""
