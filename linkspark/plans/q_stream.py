"""Streaming queries: replay the fixture tables as arriving files, drain with
``availableNow`` and return the published result (S1, S2).

Scratch data goes under the session's ``spark.checkpoint.dir`` (a shared folder on a
cluster), one fresh sub-folder per run.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import read_table
from ..streaming import metrics as SM
from ..streaming import votes as SV
from . import fixtures as fx
from .oracle_fixtures import define, with_views
from .registry import query
from .q_scoring import R


TRIGGERS = 8  # micro-batches that a replay of the votes takes at most


def _scratch(spark, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "linkspark", name, uuid.uuid4().hex)


@query("stream_votes", with_views("SELECT question_id, tbl, col FROM votes WHERE votes >= 2", "votes"))
def q_stream_votes(spark, d):
    """Votes arrive in files, a few per trigger, each voter's end record with them; the final publication equals the
    batch majority vote."""
    root = _scratch(spark, "stream_votes")
    src = os.path.join(root, "in")
    votes = fx.fx_votes(spark, d).withColumn("voter", F.col("voter").cast("int"))
    arriving = lambda rows: rows.withColumn("arrival", F.col("voter")).write.partitionBy("arrival").mode("append").parquet(src)
    arriving(votes.withColumn("n_links", F.lit(None).cast("long")))
    arriving(SV.end_records(spark.read.schema(SV.LINK_SCHEMA).parquet(src)))
    out = os.path.join(root, "out")
    # as many triggers whatever the number of files, since each one goes through the whole state
    files = len(spark.read.parquet(src).inputFiles())
    SV.run_incremental_vote(spark, os.path.join(src, "arrival=*"), fx.fx_catalog(spark, d), out,
                            os.path.join(root, "checkpoint"), n_voters=len(fx.VOTERS),
                            max_files_per_trigger=max(8, -(-files // TRIGGERS)), compact_every=4)
    return SV.latest_publication(spark, out).select("question_id", "tbl", "col")


# Events arrive in the order of their ids in eight slices; those with id % 50 = 7 come a quarter of the
# table later, and those with id % 20 = 3 come again a third of the table later.
N_SLICES = 8


def arrivals(events):
    """``events`` as they arrive, with the slice each row is in."""
    total = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    delayed = F.col("event_id") + F.when(F.col("event_id") % 50 == 7, total // 4).otherwise(0)
    again = F.when(F.col("event_id") % 20 == 3, F.col("event_id") + total // 3)
    e = events.withColumn("arrival", F.explode(F.array_compact(F.array(delayed, again))))
    return e.withColumn("slice", F.expr(f"cast(least(arrival, {total - 1}) * {N_SLICES} div {total} as int)")).drop("arrival")


define("arrived", (), f"""SELECT e.event_id, e.ts, e.event_type, e.value,
      CAST(least(a.arrival, t.total - 1) * {N_SLICES} // t.total AS INTEGER) AS slice
    FROM events e, (SELECT max(event_id) + 1 AS total FROM events) t,
      LATERAL (SELECT unnest(CASE WHEN e.event_id % 20 = 3 THEN [x, e.event_id + t.total // 3] ELSE [x] END) AS arrival
               FROM (SELECT e.event_id + CASE WHEN e.event_id % 50 = 7 THEN t.total // 4 ELSE 0 END AS x)) a""")
define("watermarks", ("arrived",), """SELECT slice, max(date_trunc('millisecond', max(ts))) OVER (ORDER BY slice
      ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 10 minute AS mark, max(ts) AS latest FROM arrived GROUP BY slice""")
define("arrived_late", ("arrived", "watermarks"), """SELECT a.*, time_bucket(INTERVAL 1 hour, a.ts) AS w, coalesce(a.ts <= m.mark, false) AS late
    FROM arrived a JOIN watermarks m ON m.slice = a.slice""")


@query("stream_run_metrics", with_views(f"""
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS metric,
      count(DISTINCT event_id) FILTER (NOT late) AS n, round(avg(value) FILTER (NOT late AND nth = 1), {R}) AS avg_value,
      count(*) FILTER (late) AS n_late
    FROM (SELECT *, row_number() OVER (PARTITION BY event_id, late ORDER BY slice) AS nth FROM arrived_late) a
    GROUP BY w, event_type
    HAVING w + INTERVAL 1 hour <= (SELECT date_trunc('millisecond', max(latest)) - INTERVAL 10 minute FROM watermarks)""",
    "arrived_late", "watermarks"))
def q_stream_run_metrics(spark, d):
    """The events are replayed slice by slice, a micro-batch each; closed windows are appended, late rows kept aside."""
    root = _scratch(spark, "stream_run_metrics")
    src, out, late = (os.path.join(root, x) for x in ("in", "out", "late"))
    SM.write_slices(arrivals(read_table(spark, d, "events")), "slice", N_SLICES, src)
    SM.run_windowed_metrics(spark, src, out, os.path.join(root, "checkpoint"))
    SM.run_late_rows(spark, src, late, os.path.join(root, "checkpoint-late"))
    windows = spark.read.schema("window_start timestamp, metric string, n long, avg_value double").parquet(out)
    res = SM.with_late(windows, SM.late_rows(spark, late))
    return res.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "metric",
                      "n", F.round("avg_value", R).alias("avg_value"), "n_late")
