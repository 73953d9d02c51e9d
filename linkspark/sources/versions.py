"""Outputs that are replaced as a whole (A6): data in a folder of its own, then a manifest that names it.

A version's manifest is created only where none of that number is there yet, so of two writers that started from
the same version one is refused; readers follow the last manifest and never see a part.  The file system must
create files exclusively (HDFS and local ones do)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class VersionConflict(Exception):
    """Another writer has published the same version."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def latest_version(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """The number and the data folder of the last published version."""
    folder, fs = _fs(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    if not names:
        return None
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(folder, names[-1]))
    try:
        data = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return int(names[-1]), f"{path}/data/{data}"



def publish(df: DataFrame, path: str, base: int | None = None, fmt: str = "json") -> int:
    """Write ``df`` as the next version below ``path`` and return its number.  ``base`` is the version that the
    writer started from (default: the last one now); if that has been followed by another, nothing is published."""
    spark = df.sparkSession
    if base is None:
        last = latest_version(spark, path)
        base = last[0] if last else 0
    name = uuid.uuid4().hex
    df.write.format(fmt).save(f"{path}/data/{name}")
    target, fs = _fs(spark, f"{path}/manifest/{base + 1:09d}")
    try:
        out = fs.create(target, False)
    except Exception as e:  # noqa: BLE001 - the file system's own exception, seen through the gateway
        if fs.exists(target):
            raise VersionConflict(f"version {base + 1} of {path} is there already") from e
        raise
    out.write(bytearray(name.encode()))
    out.close()
    return base + 1


def read_version(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    """The last published version; empty where there is none."""
    last = latest_version(spark, path)
    return spark.read.schema(schema).format(fmt).load(last[1]) if last else spark.createDataFrame([], schema)
