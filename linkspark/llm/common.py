"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspark.session import ensure_checkpoint_dir

#: ASCII white space; a word is a maximal run of other characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, through Spark's reader (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the cluster's ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, and a lost
    executor costs a reread instead of a recomputation."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_materialised(dfs: Iterable[DataFrame]) -> None:
    """Delete the files behind ``materialise`` results that no later plan reads."""
    for df in dfs:
        jvm = df.sparkSession._jvm
        for file in df.inputFiles():
            path = jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
            break


def neutral_names(docs: DataFrame, kept: Iterable[str]) -> DataFrame:
    """``docs`` with all columns but ``kept`` named by their place, so that none clashes with a column an
    operator adds; ``toDF(*docs.columns)`` undoes it."""
    kept = set(kept)
    return docs.toDF(*(c if c in kept else f"given_{i}" for i, c in enumerate(docs.columns)))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the decimal id leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
