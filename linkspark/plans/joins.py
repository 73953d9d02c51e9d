"""Size-checked broadcast helpers.

A side is broadcast only when the optimizer's size estimate for it (an upper
bound derived from the scanned files and the operators above them) is below a
limit.  Beyond the limit the DataFrame is returned untouched: the join is then
planned as a shuffle join, and AQE may still switch it to a broadcast hash join
at runtime once the real size of the materialised side is known.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of ``df`` (None when unavailable)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))  # an int or a JVM object, by version
    except Exception:  # pragma: no cover - non-classic sessions
        return None


def broadcast_limit(df: DataFrame, default: int = DEFAULT_BROADCAST_LIMIT) -> int:
    raw = df.sparkSession.conf.get("linkspark.broadcast.maxBytes", None)
    return int(raw) if raw else default


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only if its estimated size is below the limit."""
    limit = max_bytes if max_bytes is not None else broadcast_limit(df)
    size = estimated_size_bytes(df)
    if size is not None and 0 <= size <= limit:
        return F.broadcast(df)
    return df


BROADCAST_ROWS = 500_000  # rows of a table that goes to all tasks


def by_rows(table: DataFrame) -> DataFrame:
    """``table`` marked for broadcast where it has few rows, else for a join by exchange.  Left to itself Spark goes by
    the bytes of the files, of which a million packed rows fill few, and builds their hash table on the driver."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table.hint("merge")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back: it is computed once however often it is used,
    and its size is that of its files instead of an estimate over joins."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/linkspark/{label}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_A_PART = 60_000  # rows of the driving table a partition holds, about


def parts_for(table: DataFrame, rows: int = ROWS_A_PART) -> int:
    """How many partitions hold ``table`` with about ``rows`` rows each, so that a task's memory does not grow with
    it.  The count reads no column."""
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // rows))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its scan has fewer splits than the cluster has cores: such an input is
    small (a split a core at most), and costly expressions above it would run in a few tasks."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
