"""Record files: question lists (A3), JSON lines (A5, A7, A10) and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jsonl(records: DataFrame, path: str, compression: str = "none") -> None:
    """One JSON object per record; fields that are null are left out and come back as null.  A part written with
    ``compression="gzip"`` is read by one task."""
    records.write.mode("overwrite").json(path, compression=compression)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``schema`` is given, so nothing is read to infer it; a line that is not JSON fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_csv(records: DataFrame, path: str) -> None:
    """Columns of plain types, with a header in every part."""
    records.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


QUESTION_SCHEMA = "question_id long, db_id string, question string"


def read_questions(spark: SparkSession, path: str, json_list: bool = False) -> DataFrame:
    """A3: the questions of one record to a line, or with ``json_list`` of files that are one JSON list
    each (such a file is one task's work).  Other fields are ignored, absent ones are null."""
    reader = spark.read.schema(QUESTION_SCHEMA).option("mode", "FAILFAST")
    return reader.option("multiLine", json_list).json(path)
