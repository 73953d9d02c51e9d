"""Stand-in views over the driver's tables (the inputs shared by ``queries()`` and the oracles).

The mapping is fixed by the project's fixture definitions: a part brand plays a
catalog *table*, a part name a *column*; one order is one *question*; each
line item names one (table, column) link.  Every view is a plain DataFrame
built lazily from the parquet scans, so filters and projections applied by an
operator are pushed into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .joins import by_rows, parts_for, written

VOTERS = (1, 2, 3, 4)


def fx_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Catalog of three databases: brand = table, part name = column.  Database k lacks the
    tables whose last digit + k divides by 3; database 1 spells its tables in capitals.  Its distinct rows are
    written, so that joins know how small they are however large ``part`` is."""
    part = written(read_table(spark, d, "part").select("p_brand", "p_name").distinct(), "catalog")
    k = F.col("k")
    return (part.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
            .where((F.substring("p_brand", -1, 1).cast("int") + k) % 3 != 0)
            .select(F.concat(F.lit("db"), k.cast("string")).alias("db_id"),
                    F.when(k == 1, F.upper("p_brand")).otherwise(F.col("p_brand")).alias("tbl"),
                    F.col("p_name").alias("col")))


def question_db(question_id: str):
    """The database a question is asked of."""
    return F.concat(F.lit("db"), (F.col(question_id) % 3).cast("string")).alias("db_id")


def by_question(spark: SparkSession, d: str, df: DataFrame, key: str = "question_id") -> DataFrame:
    """``df`` partitioned by question, alike for all views, in as many parts as its lines of orders need."""
    return df.repartition(parts_for(read_table(spark, d, "lineitem")), key)


def fx_base(spark: SparkSession, d: str) -> DataFrame:
    """Rows are partitioned by question before voters multiply them, so what follows on a question stays in place."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = by_rows(read_table(spark, d, "part").select("p_partkey", "p_brand", "p_name"))
    b = (li.join(part, li.l_partkey == part.p_partkey)
         .select(F.col("l_orderkey").alias("question_id"), F.col("l_linenumber").alias("ln"),
                 F.col("l_partkey").alias("pk"), F.col("p_brand").alias("tbl"), F.col("p_name").alias("col")))
    return by_question(spark, d, b).select("question_id", question_db("question_id"), "ln", "pk", "tbl", "col")


def fx_questions_ids(spark: SparkSession, d: str) -> DataFrame:
    """The question set of the voting fixtures: every order that has a line item."""
    return by_question(spark, d, read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("question_id"))).distinct()


def fx_gold_ids(spark: SparkSession, d: str) -> DataFrame:
    """Questions with a gold record, also where none of its links is valid."""
    li = read_table(spark, d, "lineitem").where((F.col("l_orderkey") + F.col("l_partkey")) % 3 != 0)
    return by_question(spark, d, li.select(F.col("l_orderkey").alias("question_id"))).distinct()


def fx_vote_ids(spark: SparkSession, d: str) -> DataFrame:
    """``question_id, voter`` of every prediction record, also where none of its links is valid."""
    li = by_question(spark, d, read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber"), "l_orderkey").withColumn("voter", F.explode(F.array(*[F.lit(v) for v in VOTERS])))
    return (li.where((F.col("l_partkey") * F.col("voter") + F.col("l_orderkey") + F.col("l_linenumber")) % 5 > 1)
            .select(F.col("l_orderkey").alias("question_id"), "voter").distinct())


def fx_gold(spark: SparkSession, d: str) -> DataFrame:
    """Gold links; a NULL column means the table is used without a column."""
    b = fx_base(spark, d)
    return (b.where((F.col("question_id") + F.col("pk")) % 3 != 0)
            .select("question_id", "db_id", "tbl",
                    F.when(F.col("ln") == 7, F.lit(None).cast("string")).otherwise(F.col("col")).alias("col"))
            .distinct())


def fx_votes(spark: SparkSession, d: str, voters: tuple[int, ...] = VOTERS) -> DataFrame:
    """Noisy voters: dropped rows, invalid tables / columns, wrong case, NULL columns."""
    b = fx_base(spark, d).withColumn("voter", F.explode(F.array(*[F.lit(v) for v in voters])))
    s = F.col("pk") + F.col("voter")
    tbl = (F.when(s % 17 == 0, F.lit("Brand#99"))
           .when(s % 2 == 0, F.upper("tbl"))
           .otherwise(F.col("tbl")))
    col = (F.when(F.col("ln") == 7, F.lit(None).cast("string"))
           .when(s % 13 == 0, F.lit("no such column"))
           .when(s % 3 == 0, F.upper("col"))
           .otherwise(F.col("col")))
    keep = (F.col("pk") * F.col("voter") + F.col("question_id") + F.col("ln")) % 5 > 1
    return b.where(keep).select("question_id", "db_id", "voter", tbl.alias("tbl"), col.alias("col"))


def fx_docs(spark: SparkSession, d: str) -> DataFrame:
    """Retrieval corpus: source = database, document = table (in doc_id order)."""
    return read_table(spark, d, "documents").select(
        F.col("source").alias("db_id"), F.col("doc_id").alias("table_idx"), "text")


def fx_questions(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "benchmark").select(
        F.col("item_id").alias("question_id"),
        F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("db_id"),
        F.col("text").alias("question"))


def fx_vec(spark: SparkSession, d: str) -> DataFrame:
    """64-dim unit vectors; label = corpus; query vectors are vec_id % 25 = 0."""
    return read_table(spark, d, "embeddings").select(
        "vec_id", F.col("label").alias("db_id"), "embedding")


def fx_raw(spark: SparkSession, d: str) -> DataFrame:
    """Dirty model output wrapped around a known JSON object, six variants."""
    ev = read_table(spark, d, "events").select("event_id", "event_type", "user_id")
    arr = (F.when(F.col("user_id") % 7 == 0, F.lit("[]"))
           .when(F.col("user_id") % 11 == 0, F.lit("null"))
           .otherwise(F.concat(F.lit('["c'), (F.col("user_id") % 5).cast("string"), F.lit('"]'))))
    j = F.concat(F.lit('{"'), F.col("event_type"), F.lit('": '), arr, F.lit("}"))
    nl = F.lit("\n")
    m = F.col("event_id") % 6
    raw = (F.when(m == 0, j)
           .when(m == 1, F.concat(F.lit("```json"), nl, j, nl, F.lit("```")))
           .when(m == 2, F.concat(F.lit("Sure! Here you go:"), nl, j))
           .when(m == 3, F.concat(j, F.lit("<|im_end|>")))
           .when(m == 4, F.lit("no json here"))
           .otherwise(F.concat(F.lit("{bad} "), j)))
    return ev.select("event_id", raw.alias("raw"), "event_type", "user_id")


def fx_cand(spark: SparkSession, d: str) -> DataFrame:
    """Curation candidates with the parser's verdict already attached as columns."""
    docs = read_table(spark, d, "documents").select("doc_id", "source", "text")
    labels = read_table(spark, d, "labels").select("doc_id", "quality", "toxic")
    j = docs.join(labels, "doc_id", "left")
    return j.select(
        F.col("source").alias("db_id"), F.col("doc_id").alias("pos"),
        F.col("text").alias("question"),
        F.when(F.col("quality").isNull(), F.lit("")).otherwise(F.lit("select 1")).alias("gold_sql"),
        (F.coalesce(F.col("quality"), F.lit(0)) == 0).alias("parse_failed"),
        F.when(F.col("toxic") == 1, F.lit(0)).otherwise(F.lit(1)).alias("n_tables"))


def fx_runs(spark: SparkSession, d: str) -> DataFrame:
    """Run metrics: user = run, event type = metric, event id = step."""
    return read_table(spark, d, "events").select(
        (F.col("user_id") % 10).alias("experiment"), F.col("user_id").alias("run"),
        F.col("event_type").alias("metric"), F.col("event_id").alias("step"), "value")


def fx_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Extracted SQL mentions: alias -> table, column possibly unqualified, star on line 7.  Partitioned by query."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = by_rows(read_table(spark, d, "part").select("p_partkey", "p_brand", "p_name"))
    alias = F.concat(F.lit("t"), F.col("l_linenumber").cast("string"))
    m = by_question(spark, d, li.join(part, li.l_partkey == part.p_partkey).drop("l_partkey", "p_partkey"), "l_orderkey")
    return m.select(F.col("l_orderkey").alias("query_id"), question_db("l_orderkey"), alias.alias("alias"),
                    F.col("p_brand").alias("tbl"),
                    F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("string"))
                    .otherwise(alias).alias("col_alias"),
                    F.when(F.col("l_linenumber") == 7, F.lit("*"))
                    .otherwise(F.lower("p_name")).alias("col"))
