"""Training-run metrics: flatten nested run files, parse pipe-delimited logs, pick best
runs and checkpoints (A11, A12, D15, D16)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed layout of a log line: "ts | experiment | component | level | file:line | message".
LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:[.,]\d+)?) \| ([^|]*?) \| ([^|]*?) \| ([A-Z]+) \| ([^|]*?) \| (.*)$"


def last_values(metrics: DataFrame, keys: Sequence[str] = ("experiment", "run", "metric"),
                step: str = "step", value: str = "value") -> DataFrame:
    """Last value per (run, metric) by step (map-side combined ``max_by``)."""
    return metrics.groupBy(*keys).agg(F.max_by(value, step).alias("value"), F.max(step).alias("step"))


def nest_runs(metrics: DataFrame) -> DataFrame:
    """Build the nested run record ``(experiment, run, final_metrics MAP<metric, STRUCT<value, step>>)``.
    One group = one run's metrics (bounded by the number of metric names)."""
    last = last_values(metrics)
    return last.groupBy("experiment", "run").agg(F.map_from_entries(F.collect_list(
        F.struct("metric", F.struct("value", "step")))).alias("final_metrics"))


def flatten_runs(nested: DataFrame) -> DataFrame:
    """Nested run records -> one row per (experiment, run, metric)."""
    e = nested.select("experiment", "run", F.explode("final_metrics").alias("metric", "m"))
    return e.select("experiment", "run", "metric", F.col("m.value").alias("value"), F.col("m.step").alias("step"))


#: Layout of a run file: one experiment with its runs, their settings as text and the last value of each metric.
RUN_FILE = ("experiment_name string, num_runs int, runs array<struct<run_name:string, status:string, start_time_ms:long, "
            "end_time_ms:long, config:map<string,string>, final_metrics:map<string,struct<value:double,step:long>>>>")


def read_run_files(spark: SparkSession, path: str, one_to_a_line: bool = False) -> DataFrame:
    """Run files (one JSON object each, or with ``one_to_a_line`` many to a file) -> one row a run:
    ``experiment, run, status, start_time_ms, end_time_ms, config, final_metrics``.  Absent fields are null."""
    files = spark.read.schema(RUN_FILE).option("mode", "FAILFAST").option("multiLine", not one_to_a_line).json(path)
    return files.select(F.col("experiment_name").alias("experiment"), F.explode("runs").alias("r")).select(
        "experiment", F.col("r.run_name").alias("run"), "r.status", "r.start_time_ms", "r.end_time_ms", "r.config", "r.final_metrics")


def write_run_files(runs: DataFrame, path: str, chunk: str | None = None) -> None:
    """The run files behind :func:`read_run_files`, one object to a line; ``chunk`` names a column that cuts an
    experiment with many runs into several objects, since an object is built in one task."""
    by = ["experiment", *([chunk] if chunk else [])]
    run = F.struct(F.col("run").alias("run_name"), "status", "start_time_ms", "end_time_ms", "config", "final_metrics")
    (runs.groupBy(*by).agg(F.collect_list(run).alias("runs"))
     .select(F.col("experiment").alias("experiment_name"), F.size("runs").alias("num_runs"), "runs").write.json(path))


def run_settings(runs: DataFrame) -> DataFrame:
    """One row for each (experiment, run, setting)."""
    return runs.select("experiment", "run", "status", F.explode("config").alias("setting", "value"))


def best_runs(final: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """Best run per (experiment, metric) on the last value; ties -> lowest run id."""
    v = F.col("value") if higher_is_better else -F.col("value")
    pick = F.max(F.struct(v.alias("v"), (-F.col("run")).alias("neg_run"), F.col("value").alias("value")))
    return (final.where(~F.isnan("value")).groupBy("experiment", "metric")
            .agg(pick.alias("b"), F.count(F.lit(1)).alias("n_runs"))
            .select("experiment", "metric", (-F.col("b.neg_run")).alias("best_run"),
                    F.col("b.value").alias("best_value"), "n_runs"))


def best_checkpoint(history: DataFrame, run: str = "run", step: str = "step", loss: str = "value") -> DataFrame:
    """Step with the lowest loss per run; NaN never wins (ties -> earliest step)."""
    ok = history.where(F.col(loss).isNotNull() & ~F.isnan(loss))
    best = F.min(F.struct(F.col(loss).alias("loss"), F.col(step).alias("step")))
    return ok.groupBy(run).agg(best.alias("b")).select(
        run, F.col("b.step").alias("best_step"), F.col("b.loss").alias("best_loss"))


def parse_log_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Split pipe-delimited log lines; lines without the prefix are continuations."""
    t = F.col(text)
    ok = t.rlike(LOG_LINE)
    g = lambda i: F.when(ok, F.regexp_extract(t, LOG_LINE, i))
    return lines.select(
        F.to_timestamp(g(1)).alias("ts"), g(2).alias("experiment"), g(3).alias("component"),
        F.coalesce(g(4), F.lit("CONTINUATION")).alias("level"), g(5).alias("site"),
        F.when(ok, F.regexp_extract(t, LOG_LINE, 6)).otherwise(t).alias("message"))


# ---------------------------------------------------------------- records of several lines

_PIECES = "file string, at long, nth long, header boolean, last boolean, text string, n_lines long"


def log_pieces(lines: DataFrame) -> DataFrame:
    """``lines`` (``file, at, value``: the file, the start of the split and the line, as read) cut into pieces
    within each split: a header with its continuation lines, or the lines before the split's first header.
    ``last`` marks a split's last piece, whose record may go on in the next split."""
    import re

    head = re.compile(LOG_LINE.removesuffix("$") + r"\Z", re.S)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, nth, text, header = None, 0, [], False
        out: list[tuple] = []

        def close(last: bool) -> None:
            if text:
                out.append((*split, nth, header, last, "\n".join(text), len(text)))

        for batch in batches:
            for file, at, line in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "value"))):
                is_head = head.match(line) is not None
                if split != (file, at):
                    close(True)
                    split, nth, text, header = (file, at), 0, [], is_head
                elif is_head:
                    close(False)
                    nth, text, header = nth + 1, [], True
                text.append(line)
                if len(out) >= 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], _PIECE_NAMES)
                    out.clear()
        close(True)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], _PIECE_NAMES)

    return lines.select("file", "at", "value").mapInArrow(run, _PIECES)


_PIECE_NAMES = [c.split()[0] for c in _PIECES.split(", ")]


def join_pieces(pieces: DataFrame) -> DataFrame:
    """``file, text, n_lines`` of every record.  Only the pieces at a split's edges, two a split at most,
    are put in order and joined with the header before them; all others are whole."""
    edge = F.col("last") | ~F.col("header")
    whole = pieces.where(~edge).select("file", "text", "n_lines")
    order = Window.partitionBy("file").orderBy("at", "nth")
    edges = pieces.where(edge).withColumn("record", F.sum(F.col("header").cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("at", "nth", "text")))
    joined = edges.groupBy("file", "record").agg(parts.alias("p"), F.sum("n_lines").alias("n_lines")).select(
        "file", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"), "n_lines")
    return whole.unionByName(joined)


def read_log_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of log files: the fields of the header line, ``message`` with the continuation lines that
    follow it, and ``n_lines``.  Files are read in splits; a record that a split cuts is joined again.
    Lines before a file's first header are one record of level CONTINUATION."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    r = join_pieces(log_pieces(lines))
    first = F.substring_index("text", "\n", 1)
    r = r.select("file", "n_lines", first.alias("first"), F.expr("substring(text, length(substring_index(text, '\n', 1)) + 1)").alias("rest"))
    ok = F.col("first").rlike(LOG_LINE)
    g = lambda i: F.when(ok, F.regexp_extract("first", LOG_LINE, i))
    return r.select(
        "file", F.try_to_timestamp(F.replace(g(1), F.lit(","), F.lit("."))).alias("ts"), g(2).alias("experiment"), g(3).alias("component"),
        F.coalesce(g(4), F.lit("CONTINUATION")).alias("level"), g(5).alias("site"),
        F.concat(F.when(ok, F.regexp_extract("first", LOG_LINE, 6)).otherwise(F.col("first")), "rest").alias("message"), "n_lines")


def run_status(metrics: DataFrame, targets: DataFrame, keys: Sequence[str] = ("experiment", "run")) -> DataFrame:
    """How far each run came: ``reached`` (its last step), ``target`` and ``status`` - completed, partial, or
    unknown where no target is given.  A run of ``targets (keys, target)`` without any metric is partial at 0."""
    keys = list(keys)
    reached = metrics.groupBy(*keys).agg(F.max("step").alias("reached"))
    j = reached.join(targets.select(*keys, "target"), keys, "full")
    status = F.when(F.col("target").isNull(), "unknown").when(F.col("reached") >= F.col("target"), "completed").otherwise("partial")
    return j.select(*keys, F.coalesce("reached", F.lit(0).cast("long")).alias("reached"), "target", status.alias("status"))
