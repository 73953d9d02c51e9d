"""Prediction / gold link files (A4, A6): ``[{question_id, schema_links: {table: [cols]}}]``.

Reading keeps a table whose list is empty (``explode_outer``), credits the table
only when the value is not a list, takes the last value of a repeated table, and ignores
records whose links are not an object.  Writing packs the normal form back into one record per question.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.recover import parse_object
from ..operators.vote import pack_links

RECORD_SCHEMA = "question_id long, schema_links string"


def explode_links(records: DataFrame, links_col: str = "schema_links", keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """A4: records with a JSON-object text column -> raw link rows ``(keys, tbl, col)``."""
    v = parse_object(F.col(links_col))
    m = F.try_variant_get(v, "$", "map<string,variant>")
    e = records.select(*keys, F.explode(m).alias("tbl", "val"))
    cols = F.try_variant_get("val", "$", "array<string>")
    rows = e.select(*keys, "tbl", F.explode_outer(cols).alias("col"))
    return rows


def read_link_records(spark: SparkSession, path: str, json_list: bool = False) -> DataFrame:
    """``dataset, question_id, schema_links`` of prediction or gold files: question ids are unique within a file, so
    the file's name without its ending is the first key.  Links are kept as raw JSON text."""
    raw = spark.read.option("multiLine", json_list).schema(RECORD_SCHEMA).json(path)
    return raw.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("dataset"), "question_id", "schema_links")


def read_link_file(spark: SparkSession, path: str, json_list: bool = False, keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """Records one to a line, as ``write_link_file`` leaves them (and readable in splits), or with
    ``json_list`` files that are one JSON list each; with ``dataset`` among ``keys`` for several files at once."""
    return explode_links(read_link_records(spark, path, json_list), keys=keys)


def normal_form(rows: DataFrame, keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """Raw link rows -> ``keys, tlc, clc, tbl, col``, every table with its own row, without a catalog check."""
    keys = list(keys)
    one = rows.where("tbl is not null").select(*keys, F.lower("tbl").alias("tlc"), F.coalesce(F.lower("col"), F.lit("")).alias("clc"), "tbl", "col")
    table = one.select(*keys, "tlc", F.lit("").alias("clc"), "tbl", F.lit(None).cast("string").alias("col"))
    return one.where("clc != ''").unionByName(table).groupBy(*keys, "tlc", "clc").agg(F.min("tbl").alias("tbl"), F.min("col").alias("col"))


def write_link_file(links: DataFrame, path: str, questions: DataFrame | None = None) -> None:
    """One JSON record per question (columns sorted, empty lists kept), with ``questions``
    also for those without links.  An existing folder is replaced (``versions.publish`` replaces it as a whole)."""
    pack_links(links, questions=questions).write.mode("overwrite").json(path)
