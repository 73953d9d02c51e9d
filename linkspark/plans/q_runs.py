"""Run-metric queries over ``fx_runs`` / ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import runs as RU
from ..sources.tables import read_table
from . import fixtures as fx
from .oracle_fixtures import define, with_views
from .q_stream import _scratch
from .registry import query

define("run_last", ("fx_runs",), """SELECT experiment, run, metric, max_by(value, step) AS value, max(step) AS step
    FROM fx_runs GROUP BY experiment, run, metric""")


@query("run_metrics_flat", with_views("SELECT experiment, run, metric, value, step FROM run_last", "run_last"))
def q_run_metrics_flat(spark, d):
    return RU.flatten_runs(RU.nest_runs(fx.fx_runs(spark, d)))


# The runs written as nested files, each with its settings, and read back.
define("run_cfg", ("fx_runs",), """SELECT DISTINCT concat('sweep', CAST(experiment AS VARCHAR)) AS experiment, CAST(run AS VARCHAR) AS run,
      CASE WHEN run % 4 = 0 THEN 'RUNNING' ELSE 'FINISHED' END AS status,
      concat('0.000', CAST(run % 4 + 1 AS VARCHAR)) AS rate, CAST(run % 3 * 16 AS VARCHAR) AS rank FROM fx_runs""")
RUNS_PER_OBJECT = 64


def run_files(spark, d):
    nested = RU.nest_runs(fx.fx_runs(spark, d))
    run = F.col("run")
    config = F.create_map(F.lit("training_args.learning_rate"), F.concat(F.lit("0.000"), (run % 4 + 1).cast("string")),
                          F.lit("peft_params.r"), (run % 3 * 16).cast("string"))
    files = nested.select(
        F.concat(F.lit("sweep"), F.col("experiment").cast("string")).alias("experiment"), run.cast("string").alias("run"),
        F.when(run % 4 == 0, "RUNNING").otherwise("FINISHED").alias("status"), (run * 1000).alias("start_time_ms"),
        F.when(run % 4 != 0, run * 1000 + 1).alias("end_time_ms"), config.alias("config"), "final_metrics",
        F.floor(run / (10 * RUNS_PER_OBJECT)).alias("chunk"))  # an experiment has every tenth run
    path = _scratch(spark, "run_files")
    RU.write_run_files(files, path, "chunk")
    return RU.read_run_files(spark, path, one_to_a_line=True)


@query("run_file_settings", with_views("""
    SELECT experiment, run, status, 'training_args.learning_rate' AS setting, rate AS value FROM run_cfg
    UNION ALL SELECT experiment, run, status, 'peft_params.r', rank FROM run_cfg""", "run_cfg"))
def q_run_file_settings(spark, d):
    return RU.run_settings(run_files(spark, d))


@query("run_file_metrics", with_views("""
    SELECT concat('sweep', CAST(experiment AS VARCHAR)) AS experiment, CAST(run AS VARCHAR) AS run, metric, value, step
    FROM run_last""", "run_last"))
def q_run_file_metrics(spark, d):
    return RU.flatten_runs(run_files(spark, d))


@query("best_run", with_views("""
    SELECT experiment, metric, arg_max(run, (value, -run)) AS best_run, max(value) AS best_value, count(*) AS n_runs
    FROM run_last WHERE NOT isnan(value) GROUP BY experiment, metric""", "run_last"))
def q_best_run(spark, d):
    final = RU.last_values(fx.fx_runs(spark, d))
    return RU.best_runs(final)


# The 'error' metric plays the evaluation loss of a run's checkpoints (steps).
@query("best_checkpoint", with_views("""
    SELECT run, arg_min(step, (value, step)) AS best_step, min(value) AS best_loss
    FROM fx_runs WHERE metric = 'error' AND value IS NOT NULL AND NOT isnan(value) GROUP BY run""", "fx_runs"))
def q_best_checkpoint(spark, d):
    h = fx.fx_runs(spark, d).where(F.col("metric") == "error")
    return RU.best_checkpoint(h)


# Events rendered as pipe-delimited log lines (every 9th line is a continuation
# of the previous message), parsed back and counted per level.
define("log_src", (), """SELECT event_id,
      CASE WHEN event_id % 9 = 8 THEN 'CONTINUATION'
           WHEN value >= 90 THEN 'ERROR' WHEN value >= 50 THEN 'WARNING' ELSE 'INFO' END AS level,
      'exp' || CAST(user_id % 10 AS VARCHAR) AS experiment, event_type AS component
    FROM events""")


@query("log_parse", with_views("""
    SELECT level, count(*) AS n_lines, count(DISTINCT experiment) FILTER (WHERE level <> 'CONTINUATION') AS n_experiments
    FROM log_src GROUP BY level""", "log_src"))
def q_log_parse(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    level = (F.when(F.col("value") >= 90, "ERROR").when(F.col("value") >= 50, "WARNING").otherwise("INFO"))
    line = F.concat_ws(" | ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"),
                       F.concat(F.lit("exp"), (F.col("user_id") % 10).cast("string")),
                       F.col("event_type"), level,
                       F.concat(F.lit("train.py:"), (F.col("event_id") % 300).cast("string")),
                       F.concat(F.lit("metric payload "), F.col("props")))
    text = F.when(F.col("event_id") % 9 == 8, F.concat(F.lit("    continued: "), F.col("props"))).otherwise(line)
    parsed = RU.parse_log_lines(ev.select(text.alias("value")))
    return parsed.groupBy("level").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_distinct(F.when(F.col("level") != "CONTINUATION", F.col("experiment"))).alias("n_experiments"))


def log_lines(spark, d):
    """``event_id, value``: the events as log lines, every ninth a continuation of the one before."""
    ev = read_table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    level = F.when(F.col("value") >= 90, "ERROR").when(F.col("value") >= 50, "WARNING").otherwise("INFO")
    line = F.concat_ws(" | ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"),
                       F.concat(F.lit("exp"), (F.col("user_id") % 10).cast("string")), F.col("event_type"), level,
                       F.concat(F.lit("train.py:"), (F.col("event_id") % 300).cast("string")),
                       F.concat(F.lit("metric payload "), F.col("props")))
    text = F.when(F.col("event_id") % 9 == 8, F.concat(F.lit("    continued: "), F.col("props"))).otherwise(line)
    return ev.select("event_id", text.alias("value"))


@query("log_records", with_views("""
    SELECT strftime(e.ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, 'exp' || CAST(e.user_id % 10 AS VARCHAR) AS experiment, e.event_type AS component,
      CASE WHEN e.value >= 90 THEN 'ERROR' WHEN e.value >= 50 THEN 'WARNING' ELSE 'INFO' END AS level,
      'train.py:' || CAST(e.event_id % 300 AS VARCHAR) AS site,
      'metric payload ' || e.props || coalesce(chr(10) || '    continued: ' || c.props, '') AS message,
      CASE WHEN c.event_id IS NULL THEN 1 ELSE 2 END AS n_lines
    FROM events e LEFT JOIN events c ON c.event_id = e.event_id + 1 AND c.event_id % 9 = 8
    WHERE e.event_id % 9 <> 8"""))
def q_log_records(spark, d):
    """The log written as files, each with whole records in order, and read back record by record."""
    path = _scratch(spark, "log")
    record = F.expr("event_id div 9")
    n = max(2, spark.sparkContext.defaultParallelism // 2)
    log_lines(spark, d).repartitionByRange(n, record).sortWithinPartitions("event_id").select("value").write.text(path)
    return RU.read_log_records(spark, path).select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"), "experiment", "component", "level", "site", "message", "n_lines")


# A run's target lies a little above nine tenths of its experiment's last step; runs of experiment 9 have none.
define("run_targets", ("fx_runs",), """SELECT experiment, run, CAST(90 * max(step) // 100 + run % 7 AS BIGINT) AS target FROM (
      SELECT experiment, run, max(step) OVER (PARTITION BY experiment) AS step FROM fx_runs WHERE experiment <> 9) x GROUP BY experiment, run""")


@query("run_status", with_views("""
    SELECT r.experiment, r.run, r.reached, coalesce(t.target, -1) AS target,
      CASE WHEN t.target IS NULL THEN 'unknown' WHEN r.reached >= t.target THEN 'completed' ELSE 'partial' END AS status
    FROM (SELECT experiment, run, max(step) AS reached FROM fx_runs GROUP BY experiment, run) r
    LEFT JOIN run_targets t ON t.experiment = r.experiment AND t.run = r.run""", "fx_runs", "run_targets"))
def q_run_status(spark, d):
    m = fx.fx_runs(spark, d)
    last = m.where("experiment <> 9").groupBy("experiment").agg(F.max("step").alias("last"))
    targets = m.where("experiment <> 9").select("experiment", "run").distinct().join(last, "experiment").select(
        "experiment", "run", F.expr("90 * last div 100 + run % 7").cast("long").alias("target"))
    return RU.run_status(m, targets).withColumn("target", F.coalesce("target", F.lit(-1).cast("long")))
