"""Live run metrics - replayed in slices of arrival, de-duplicated within a watermark, averaged per
tumbling window, late rows kept aside.

``write_slices`` lays events out as one file per slice of their arrival order, with modification times in that
order, so the file source reads one slice per micro-batch whatever the layout of the input.  The windowed query
carries its state (events seen, open windows, watermark) from batch to batch.  A row is late when its time is not
after the largest time of the slices before the previous one, less the delay: this is the watermark by which
Spark drops rows in that batch (it is set from the batches before and applied one batch later).  A second
query over the same slices keeps those rows, per epoch, so a batch that is run again replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "event_id long, ts timestamp, event_type string, value double"
WINDOW, DELAY = "1 hour", "10 minutes"


def write_slices(events: DataFrame, slice_no: str, n_slices: int, path: str) -> None:
    """Write ``events`` (with the columns of ``EVENT_SCHEMA``) as one file for each value of ``slice_no``, from 0
    below ``n_slices``; a slice without rows has no file.  A slice is written by one task and read in splits."""
    spark = events.sparkSession
    cols = [F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in EVENT_SCHEMA.split(", ")]
    events.repartitionById(n_slices, F.col(slice_no).cast("int")).select(*cols).write.parquet(path)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = [(int(s.getPath().getName().split("-")[1]), s) for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    start = min((s.getModificationTime() for _, s in files), default=0) - 1000 * n_slices
    for number, status in files:  # one file a slice; the source reads files by their times
        fs.setTimes(status.getPath(), start + 1000 * number, -1)


def windowed_metrics(events: DataFrame, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Append-mode windows: a window is emitted once the watermark passes its end;
    replayed events (same ``event_id``) are dropped within the watermark."""
    # event time must be a session-zone TIMESTAMP for watermarks (sources may store NTZ)
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    return (e.groupBy(F.window("ts", window).alias("w"), F.col("event_type").alias("metric"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("avg_value"))
            .select(F.col("w.start").alias("window_start"), "metric", "n", "avg_value"))


def _slices(spark: SparkSession, source_dir: str) -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source_dir)


def run_windowed_metrics(spark: SparkSession, source_dir: str, output_path: str, checkpoint: str,
                         window: str = WINDOW, delay: str = DELAY) -> list[dict]:
    """Drain the slices below ``source_dir`` into closed windows; returns the progress of each micro-batch."""
    q = (windowed_metrics(_slices(spark, source_dir), window, delay).writeStream.outputMode("append").format("parquet")
         .option("path", output_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return list(q.recentProgress)


def run_late_rows(spark: SparkSession, source_dir: str, output_path: str, checkpoint: str, delay: str = DELAY) -> None:
    """Drain the slices below ``source_dir`` and keep the rows that the windowed query drops as late."""
    def keep(batch: DataFrame, epoch: int) -> None:
        batch.agg(F.max(F.date_trunc("millisecond", "ts")).alias("latest")).write.mode("overwrite").parquet(
            f"{output_path}/latest/epoch={epoch}")
        # the watermark of the batch before: at most one small row an epoch is read
        earlier = [f"{output_path}/latest/epoch={e}" for e in range(epoch - 1)]
        latest = batch.sparkSession.read.schema("latest timestamp").parquet(*earlier).agg(F.max("latest").alias("latest")) if earlier else None
        late = batch.where(F.lit(False)) if latest is None else batch.join(
            F.broadcast(latest), F.col("ts") <= F.col("latest") - F.expr(f"interval {delay}")).drop("latest")
        late.write.mode("overwrite").parquet(f"{output_path}/rows/epoch={epoch}")

    q = (_slices(spark, source_dir).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def late_rows(spark: SparkSession, output_path: str) -> DataFrame:
    return spark.read.schema(f"{EVENT_SCHEMA}, epoch int").parquet(f"{output_path}/rows")


def with_late(windows: DataFrame, late: DataFrame, window: str = WINDOW) -> DataFrame:
    """The closed windows with ``n_late``, the rows that came too late for each; a window that only late rows
    belong to has ``n`` 0."""
    counts = late.groupBy(F.window("ts", window).alias("w"), F.col("event_type").alias("metric")).agg(
        F.count(F.lit(1)).alias("n_late")).select(F.col("w.start").alias("window_start"), "metric", "n_late")
    zero = F.lit(0).cast("long")
    return windows.join(counts, ["window_start", "metric"], "full").select(
        "window_start", "metric", F.coalesce("n", zero).alias("n"), "avg_value", F.coalesce("n_late", zero).alias("n_late"))
