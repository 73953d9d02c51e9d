"""Recovery and resolution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import recover as RC
from ..operators import canon as C
from ..sources.tables import read_table
from . import fixtures as fx
from .oracle_fixtures import define, with_views
from .registry import query


# The expected links come from the columns the dirty text was generated from.
@query("recover_links", with_views("""
    SELECT event_id, event_type AS tbl, CAST(NULL AS VARCHAR) AS col FROM fx_raw WHERE event_id % 6 <> 4
    UNION ALL
    SELECT event_id, event_type AS tbl, 'c' || CAST(user_id % 5 AS VARCHAR) AS col FROM fx_raw
    WHERE event_id % 6 <> 4 AND user_id % 7 <> 0 AND user_id % 11 <> 0""", "fx_raw"))
def q_recover_links(spark, d):
    raw = fx.fx_raw(spark, d)
    links = raw.select("event_id", F.explode(RC.object_links(RC.recover_object(F.col("raw")))).alias("l"))
    return links.select("event_id", F.col("l.tbl").alias("tbl"), F.col("l.col").alias("col"))


# Objects that name a table twice (the last list counts) or hold NaN or Infinity, bare and inside a sentence.
@query("recover_repeated_keys", """
    SELECT event_id, event_type AS tbl, CAST(NULL AS VARCHAR) AS col FROM events
    UNION ALL
    SELECT event_id, event_type, 'c' || CAST(user_id % 5 AS VARCHAR) FROM events WHERE event_id % 4 <> 2
    UNION ALL
    SELECT event_id, 'other', CAST(NULL AS VARCHAR) FROM events WHERE event_id % 4 IN (0, 3)""")
def q_recover_repeated_keys(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "event_type", "user_id")
    key, col = F.concat(F.lit('"'), F.col("event_type"), F.lit('": ')), F.concat(F.lit('["c'), (F.col("user_id") % 5).cast("string"), F.lit('"]'))
    twice = F.concat(F.lit("{"), key, F.lit('["old", "older"], "other": [], '), key, col, F.lit("}"))
    number = F.concat(F.lit('{"n": [], '), key, F.lit("-Infinity, "), key, col, F.lit("}"))
    m = F.col("event_id") % 4
    raw = (F.when(m == 0, twice).when(m == 1, number).when(m == 2, F.concat(F.lit("{"), key, F.lit("NaN}")))
           .otherwise(F.concat(F.lit("The links are {these}: "), twice, F.lit(" {"))))
    links = ev.select("event_id", F.explode(RC.object_links(RC.recover_object(raw))).alias("l"))
    return links.where("l.tbl != 'n'").select("event_id", F.col("l.tbl").alias("tbl"), F.col("l.col").alias("col"))


# Generated lists arrive fenced, bare, or not as a list at all.
@query("recover_array", with_views("""
    SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 'not_a_list' ELSE 'ok' END AS status,
      CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS n_items
    FROM events"""))
def q_recover_array(spark, d):
    raw = fx.fx_raw(spark, d)
    obj = F.concat(F.lit('{"'), F.col("event_type"), F.lit('": '), F.lit('["c'),
                   (F.col("user_id") % 5).cast("string"), F.lit('"]}'))
    nl = F.lit("\n")
    m = F.col("event_id") % 3
    text = (F.when(m == 0, F.concat(F.lit("```json"), nl, F.lit("["), obj, F.lit("]"), nl, F.lit("```")))
            .when(m == 1, F.concat(F.lit("["), obj, F.lit(", "), obj, F.lit("]")))
            .otherwise(obj))
    arr = RC.recover_array(text, "variant")
    return raw.select("event_id",
                      F.when(arr.isNull(), F.lit("not_a_list")).otherwise(F.lit("ok")).alias("status"),
                      F.coalesce(F.size(arr), F.lit(0)).alias("n_items"))


# Stage A = the tables voter 1 named, stage B = the columns voter 2 named for them.
define("ts_a", ("fx_votes", "cat_t"), """SELECT DISTINCT v.question_id, t.tlc, t.tbl_c
    FROM fx_votes v JOIN cat_t t ON v.db_id = t.db_id AND lower(v.tbl) = t.tlc WHERE v.voter = 1""")
define("ts_b", ("fx_votes", "cat_c"), """SELECT DISTINCT v.question_id, c.tlc, c.col_c
    FROM fx_votes v JOIN cat_c c ON v.db_id = c.db_id AND lower(v.tbl) = c.tlc AND lower(v.col) = c.clc WHERE v.voter = 2""")


@query("two_stage_merge", with_views("""
    SELECT question_id, tbl_c AS tbl, CAST(NULL AS VARCHAR) AS col FROM ts_a
    UNION ALL
    SELECT a.question_id, a.tbl_c, b.col_c FROM ts_a a JOIN ts_b b ON a.question_id = b.question_id AND a.tlc = b.tlc""",
    "ts_a", "ts_b"))
def q_two_stage_merge(spark, d):
    from ..operators.canon import two_stage_merge
    v = fx.fx_votes(spark, d)
    stage_a = v.where(F.col("voter") == 1).select("question_id", "db_id", "tbl")
    stage_b = v.where(F.col("voter") == 2).select("question_id", "db_id", "tbl", "col")
    out = two_stage_merge(stage_a, stage_b, fx.fx_catalog(spark, d))
    return out.select("question_id", "tbl", "col")


# Resolve extracted SQL mentions (alias map, qualified / bare columns, stars).
define("mn_alias", ("fx_mentions",), """SELECT query_id, lower(alias) AS alias, lower(tbl) AS tlc FROM fx_mentions
    UNION SELECT query_id, lower(tbl), lower(tbl) FROM fx_mentions""")
define("mn_tables", ("fx_mentions", "cat_t"), """SELECT DISTINCT m.query_id, m.db_id, t.tlc, t.tbl_c FROM fx_mentions m
    JOIN cat_t t ON m.db_id = t.db_id AND lower(m.tbl) = t.tlc""")
define("mn_qual", ("fx_mentions", "mn_alias", "cat_c"), """SELECT DISTINCT m.query_id, m.db_id, a.tlc, c.clc
    FROM fx_mentions m JOIN mn_alias a ON m.query_id = a.query_id AND lower(m.col_alias) = a.alias
    JOIN cat_c c ON c.db_id = m.db_id AND c.tlc = a.tlc AND c.clc = lower(m.col)
    WHERE m.col_alias IS NOT NULL AND m.col <> '*'""")
define("mn_bare", ("fx_mentions", "mn_tables", "cat_c"), """SELECT query_id, db_id, clc, min(tlc) AS tlc FROM (
      SELECT DISTINCT m.query_id, m.db_id, c.clc, c.tlc FROM fx_mentions m JOIN mn_tables s ON s.query_id = m.query_id
      JOIN cat_c c ON c.db_id = s.db_id AND c.tlc = s.tlc AND c.clc = lower(m.col)
      WHERE m.col_alias IS NULL AND m.col <> '*') o GROUP BY query_id, db_id, clc HAVING count(*) = 1""")


@query("resolve_mentions", with_views("""
    SELECT query_id, tbl_c AS tbl, CAST(NULL AS VARCHAR) AS col FROM mn_tables
    UNION
    SELECT x.query_id, t.tbl_c, c.col_c FROM (SELECT query_id, db_id, tlc, clc FROM mn_qual
                                             UNION SELECT query_id, db_id, tlc, clc FROM mn_bare) x
    JOIN cat_t t ON t.db_id = x.db_id AND t.tlc = x.tlc JOIN cat_c c ON c.db_id = x.db_id AND c.tlc = x.tlc AND c.clc = x.clc""",
    "mn_tables", "mn_qual", "mn_bare", "cat_t", "cat_c"))
def q_resolve_mentions(spark, d):
    m = fx.fx_mentions(spark, d)
    out = C.resolve_mentions(m, fx.fx_catalog(spark, d))
    return out.select("query_id", "tbl", "col")


# C7 over a batch of queries, some of which the parser gave up on.
define("mn_queries", (), "SELECT o_orderkey AS query_id, o_orderkey % 13 = 0 AS parse_failed FROM orders")


@query("mention_records", with_views("""
    SELECT q.query_id, q.parse_failed, CASE WHEN q.parse_failed THEN '{}' ELSE coalesce(l.links, '{}') END AS schema_links
    FROM mn_queries q LEFT JOIN (
      SELECT query_id, '{' || string_agg('"' || tbl_c || '":[' || cols || ']', ',' ORDER BY tbl_c) || '}' AS links
      FROM (SELECT s.query_id, s.tbl_c, coalesce(string_agg('"' || c.col_c || '"', ',' ORDER BY c.col_c), '') AS cols
            FROM mn_tables s LEFT JOIN (
                 SELECT x.query_id, x.tlc, c.col_c FROM (SELECT query_id, db_id, tlc, clc FROM mn_qual
                                                        UNION SELECT query_id, db_id, tlc, clc FROM mn_bare) x
                 JOIN cat_c c ON c.db_id = x.db_id AND c.tlc = x.tlc AND c.clc = x.clc) c
              ON c.query_id = s.query_id AND c.tlc = s.tlc
            GROUP BY s.query_id, s.tlc, s.tbl_c) t GROUP BY query_id) l ON l.query_id = q.query_id""",
    "mn_queries", "mn_tables", "mn_qual", "mn_bare", "cat_c"))
def q_mention_records(spark, d):
    queries = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("query_id"), (F.col("o_orderkey") % 13 == 0).alias("parse_failed"))
    queries = fx.by_question(spark, d, queries, "query_id")  # as the mentions are
    out = C.mention_records(queries, fx.fx_mentions(spark, d), fx.fx_catalog(spark, d))
    return out.withColumn("schema_links", F.to_json("schema_links"))
