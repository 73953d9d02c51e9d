"""Incremental ensemble as a Structured Streaming job.

Link rows of each voter arrive in files, in any order and number; an end record (``n_links`` set, no question)
says how many link rows its voter has sent in all.  A voter is present once its end record and that many
rows, valid or not, have arrived.  What is kept between epochs are the canonical votes themselves, which grow with the
questions; they lie in files beside the publications, so that no executor holds them in memory.

Every micro-batch writes the votes that came with it, as a delta of its epoch, and then a manifest: the last compacted
base, the deltas since, and how many rows each voter has sent.  Every ``compact_every`` epochs base and
deltas become a new base, in which each vote is once.  Readers follow the last manifest that was written whole, and count the
different voters of each identifier: they see the running *union* until all voters are present, then the final
mode.  An epoch that is run again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.canon import NO_COLUMN, SCOPE, catalog_columns, catalog_tables
from ..plans.joins import broadcast_if_small

LINK_SCHEMA = "question_id long, db_id string, voter int, tbl string, col string, n_links long"
MANIFEST = "epoch long, base long, deltas array<long>, mode string, voters map<int,struct<seen:long,sent:long>>"
STATE = "question_id long, voter int, tbl string, col string"
VOTES_A_PART = 300_000  # votes that a task merges or counts, about


def end_records(links: DataFrame) -> DataFrame:
    """The end record of each voter of ``links``."""
    return links.groupBy("voter").agg(F.count(F.lit(1)).alias("n_links")).select(
        F.lit(None).cast("long").alias("question_id"), F.lit(None).cast("string").alias("db_id"), F.col("voter").cast("int").alias("voter"),
        F.lit(None).cast("string").alias("tbl"), F.lit(None).cast("string").alias("col"), "n_links")


def canonical_stream(links: DataFrame, catalog: DataFrame, keys: Sequence[str] = ("question_id",),
                     scope: Sequence[str] = SCOPE) -> DataFrame:
    """Canonicalisation without an exchange (no de-duplication: voter sets absorb repeats): ``keys, voter, tbl, col`` of
    the links whose table is known, ``col`` null where they name no known column of it."""
    keys, scope = list(keys), list(scope)
    tables = broadcast_if_small(catalog_tables(catalog, scope))
    columns = broadcast_if_small(catalog_columns(catalog, scope))
    l = links.select(*dict.fromkeys([*keys, *scope]), "voter", F.lower("tbl").alias("tlc"), F.lower("col").alias("clc"))
    j = l.join(tables, [*scope, "tlc"]).join(columns, [*scope, "tlc", "clc"], "left")
    return j.select(*keys, "voter", F.col("tbl_c").alias("tbl"), F.col("col_c").alias("col"))


def sent_rows(links: DataFrame) -> DataFrame:
    """``voter, seen, sent``: how many link rows of each voter are there, valid or not, and what its end record says."""
    end = F.col("n_links").isNotNull()
    return links.where("voter is not null").groupBy("voter").agg(F.count(F.when(~end, 1)).alias("seen"), F.max("n_links").alias("sent"))


def _epochs(spark: SparkSession, path: str) -> list[int]:
    """The epochs below ``path`` that were written whole."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("epoch=")]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def manifest(spark: SparkSession, output_path: str, before: int | None = None) -> dict | None:
    """The last manifest, of those before epoch ``before`` if that is given."""
    epochs = [e for e in _epochs(spark, f"{output_path}/manifest") if before is None or e < before]
    return spark.read.schema(MANIFEST).parquet(f"{output_path}/manifest/epoch={epochs[-1]}").first().asDict(True) if epochs else None


def _votes(spark: SparkSession, output_path: str, base: int | None, deltas: Sequence[int]) -> DataFrame:
    """The votes of a base and deltas, as they came."""
    paths = [f"{output_path}/base/epoch={base}"] * (base is not None) + [f"{output_path}/delta/epoch={e}" for e in deltas]
    return spark.read.schema(STATE).parquet(*paths) if paths else spark.createDataFrame([], STATE)


def _parts(spark: SparkSession, voters: dict) -> int:
    """How many partitions hold the votes of a manifest's ``voters``."""
    return max(spark.sparkContext.defaultParallelism, -(-sum(v["seen"] for v in voters.values()) // VOTES_A_PART))


def _counted(last: dict, batch: Iterable[Row]) -> dict:
    """``voters`` of a manifest after a batch's :func:`sent_rows`."""
    voters = dict(last)
    for r in batch:
        had = voters.get(r["voter"], {"seen": 0, "sent": None})
        sent = [n for n in (had["sent"], r["sent"]) if n is not None]
        voters[r["voter"]] = {"seen": had["seen"] + r["seen"], "sent": max(sent, default=None)}
    return voters


def publish_fn(catalog: DataFrame, output_path: str, n_voters: int, final_mode: str = "maj2", compact_every: int = 8):
    def publish(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        canonical_stream(batch, catalog).write.mode("overwrite").parquet(f"{output_path}/delta/epoch={epoch}")
        last = manifest(spark, output_path, epoch) or {"base": None, "deltas": [], "voters": {}}
        voters = _counted(last["voters"], sent_rows(batch).collect())  # a row for each voter at most
        base, deltas = last["base"], [*last["deltas"], epoch]
        if len(deltas) >= compact_every:
            votes = _votes(spark, output_path, base, deltas).repartition(_parts(spark, voters), "question_id", "tbl", "col")
            votes.distinct().write.mode("overwrite").parquet(f"{output_path}/base/epoch={epoch}")
            base, deltas = epoch, []
        present = sum(v["sent"] is not None and v["seen"] >= v["sent"] for v in voters.values())
        mode = final_mode if present >= n_voters else "union"
        # _SUCCESS is written last: a manifest without it is not followed
        spark.createDataFrame([(epoch, base, deltas, mode, voters)], MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{output_path}/manifest/epoch={epoch}")
    return publish


def latest_publication(spark: SparkSession, output_path: str, lead_voter: int = 1) -> DataFrame:
    """``question_id, tbl, col, votes`` as the last whole manifest has them."""
    m = manifest(spark, output_path) or {"base": None, "deltas": [], "voters": {}, "mode": "union"}
    named = _votes(spark, output_path, m["base"], m["deltas"])
    # a vote for a column is one for its table, too
    levels = F.when(F.col("col").isNull(), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    rows = named.select("question_id", "voter", "tbl", "col", F.explode(levels).alias("of_column"))
    col = F.when(F.col("of_column"), F.col("col"))
    rows = rows.select("question_id", "voter", "tbl", col.alias("col"), F.lower("tbl").alias("tlc"), F.coalesce(F.lower(col), F.lit(NO_COLUMN)).alias("clc"))
    on = ["question_id", "tlc", "clc"]
    votes = rows.repartition(_parts(spark, m["voters"]), *on).groupBy(*on).agg(
        F.collect_set("voter").alias("voters"), F.min("tbl").alias("tbl"), F.min("col").alias("col"))
    n = F.size("voters")
    keep = {"maj2": n >= 2, "maj2_or_lead": (n >= 2) | F.array_contains("voters", lead_voter)}
    return votes.where(keep.get(m["mode"], F.lit(True))).select("question_id", "tbl", "col", n.alias("votes"))


def run_incremental_vote(spark: SparkSession, source_dir: str, catalog: DataFrame, output_path: str,
                         checkpoint: str, n_voters: int, final_mode: str = "maj2",
                         max_files_per_trigger: int = 1, compact_every: int = 8) -> None:
    """Drain ``source_dir`` (availableNow) and leave the publications below ``output_path``."""
    links = (spark.readStream.schema(LINK_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
             .parquet(source_dir))
    publish = publish_fn(catalog, output_path, n_voters, final_mode, compact_every)
    q = (links.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(publish).trigger(availableNow=True).start())
    q.awaitTermination()
