"""Schema catalogs in the Spider layout.

``read_spider`` reads one multi-line JSON document per database;
``normalize_catalog`` flattens documents into

* ``columns(db_id, table_idx, tbl, column_idx, col, data_type, is_pk)`` and
* ``fks(db_id, from_table, from_column, to_table, to_column)``

with equi-joins on ``(db_id, position)`` only.  Alignment is correct by default:
``column_types`` has no entry for the synthetic ``[-1, "*"]`` column, and key
indexes address the star-less column list.  ``compat=True`` reproduces the
reference loader's shifted reading (types taken one position to the right, the
last column lost, key indexes read against the list that still holds the star).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPIDER_SCHEMA = T.StructType([
    T.StructField("db_id", T.StringType()),
    T.StructField("table_names_original", T.ArrayType(T.StringType())),
    T.StructField("column_names_original", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("column_types", T.ArrayType(T.StringType())),
    T.StructField("primary_keys", T.ArrayType(T.StringType())),   # int or [int, ...] per entry
    T.StructField("foreign_keys", T.ArrayType(T.ArrayType(T.IntegerType()))),
])


def read_spider(spark: SparkSession, path: str) -> DataFrame:
    """A1: Spider schema files (one JSON document per file)."""
    return spark.read.option("multiLine", True).schema(SPIDER_SCHEMA).json(path)


def db_file_key(db_id) -> F.Column:
    """A2: ``' '`` and ``'/'`` become ``'_'``, plus ``.json``."""
    c = F.col(db_id) if isinstance(db_id, str) else db_id
    return F.concat(F.translate(c, " /", "__"), F.lit(".json"))


def _positions(docs: DataFrame, compat: bool) -> DataFrame:
    """``db_id, pos, tidx, name, tbl, type`` of each column, pos = index in column_names_original (0 = star).  Table
    and type are looked up inside the document's row, so its arrays are not copied to each column."""
    # aligned: the column at list position p (star at 0) owns type p-1; compat: type p
    one = F.transform("column_names_original", lambda pair, i: F.struct(
        pair[0].cast("int").alias("tidx"), pair[1].alias("name"),
        F.get("table_names_original", pair[0].cast("int")).alias("tbl"),
        F.get("column_types", i if compat else i - 1).alias("type"), F.size("column_types").alias("n_types")))
    return docs.select("db_id", F.posexplode(one).alias("pos", "c")).select("db_id", "pos", "c.*")


def normalize_catalog(docs: DataFrame, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    j = _positions(docs, compat).where(F.col("tidx") >= 0)
    if compat:
        j = j.where(F.col("pos") <= F.col("n_types") - 1)  # zip() truncation drops the last column
    cols = j.select("db_id", F.col("tidx").alias("table_idx"), "tbl", (F.col("pos") - 1).alias("column_idx"), F.col("name").alias("col"),
                    F.upper(F.coalesce("type", F.lit("TEXT"))).alias("data_type"), "pos")
    # primary keys: an entry is an index or a list of indexes
    pk_raw = docs.select("db_id", F.explode("primary_keys").alias("k"))
    pk_idx = pk_raw.select("db_id", F.explode(
        F.when(F.col("k").startswith("["), F.from_json("k", "array<int>"))
        .otherwise(F.array(F.col("k").cast("int")))).alias("k"))
    offset = 0 if compat else 1
    pks = pk_idx.select("db_id", (F.col("k") + offset).alias("pos")).distinct().withColumn("is_pk", F.lit(True))
    cols = cols.join(pks, ["db_id", "pos"], "left").withColumn("is_pk", F.coalesce("is_pk", F.lit(False)))
    # foreign keys: pairs of indexes, both resolvable and not the star; fk_idx is the place in the list
    fk = (docs.select("db_id", F.posexplode("foreign_keys").alias("fk_idx", "p")).where(F.size("p") == 2)
          .select("db_id", "fk_idx", (F.col("p")[0] + offset).alias("from_pos"), (F.col("p")[1] + offset).alias("to_pos")))
    c = cols.select("db_id", "pos", "tbl", "col")
    fks = (fk.join(c.withColumnsRenamed({"pos": "from_pos", "tbl": "from_table", "col": "from_column"}),
                   ["db_id", "from_pos"])
           .join(c.withColumnsRenamed({"pos": "to_pos", "tbl": "to_table", "col": "to_column"}), ["db_id", "to_pos"])
           .select("db_id", "fk_idx", "from_table", "from_column", "to_table", "to_column"))
    return cols.drop("pos"), fks


def catalog_index(columns: DataFrame) -> DataFrame:
    """Tables and columns per database."""
    return columns.groupBy("db_id").agg(F.count_distinct("table_idx").alias("num_tables"),
                                        F.count(F.lit(1)).alias("num_columns"))
