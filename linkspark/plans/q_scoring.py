"""Scoring and voting queries over the fixture views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import canon as C
from ..operators import evaluate as E
from ..operators import vote as V
from ..sources.tables import read_table
from . import fixtures as fx
from .oracle_fixtures import define, with_views
from .registry import query

R = 6  # digits kept for every reported double (both engines round the same way)


def canon_votes(spark: SparkSession, d: str) -> DataFrame:
    return C.canonicalize(fx.fx_votes(spark, d), fx.fx_catalog(spark, d),
                          keys=["question_id", "voter"], exchange=False)


def canon_gold(spark: SparkSession, d: str) -> DataFrame:
    return C.canonicalize(fx.fx_gold(spark, d), fx.fx_catalog(spark, d), keys=["question_id"], exchange=False)


def ensemble(spark: SparkSession, d: str, mode: str, k: int = 2) -> DataFrame:
    return V.ensemble(canon_votes(spark, d), mode=mode, k=k, lead_voter=fx.VOTERS[0])


def _links_out(df: DataFrame) -> DataFrame:
    return df.select("question_id", "tbl", "col")


# ---------------------------------------------------------------- canonicalise / vote

@query("canonicalize", with_views("SELECT question_id, voter, tbl, col FROM canon", "canon"))
def q_canonicalize(spark, d):
    return canon_votes(spark, d).select("question_id", "voter", "tbl", "col")


@query("vote_counts", with_views(
    "SELECT question_id, tbl, col, votes, lead FROM votes", "votes"))
def q_vote_counts(spark, d):
    return V.vote_counts(canon_votes(spark, d), lead_voter=fx.VOTERS[0]).select(
        "question_id", "tbl", "col", F.col("votes").cast("long").alias("votes"), "lead")


@query("vote_union", with_views("SELECT question_id, tbl, col FROM votes", "votes"))
def q_vote_union(spark, d):
    return _links_out(ensemble(spark, d, "union"))


@query("vote_maj2", with_views("SELECT question_id, tbl, col FROM votes WHERE votes >= 2", "votes"))
def q_vote_maj2(spark, d):
    return _links_out(ensemble(spark, d, "maj2"))


@query("vote_maj2_or_lead", with_views(
    "SELECT question_id, tbl, col FROM votes WHERE votes >= 2 OR lead", "votes"))
def q_vote_maj2_or_lead(spark, d):
    return _links_out(ensemble(spark, d, "maj2_or_lead"))


@query("vote_intersection", with_views(
    "SELECT question_id, tbl, col FROM votes WHERE votes >= 4", "votes"))
def q_vote_intersection(spark, d):
    return _links_out(ensemble(spark, d, "kofn", k=len(fx.VOTERS)))


# Self-consistency (D7): the voters play K sampled answers; each is canonicalised against its
# question's database before the union, so invented identifiers do not survive.
@query("self_consistency", with_views("SELECT question_id, tbl, col, votes AS n_samples FROM votes", "votes"))
def q_self_consistency(spark, d):
    return ensemble(spark, d, "union").select("question_id", "tbl", "col", F.col("votes").alias("n_samples"))


# ---------------------------------------------------------------- scoring

define("pred_maj2", ("votes",), "SELECT question_id, tlc, clc FROM votes WHERE votes >= 2")
define("flags", ("pred_maj2", "gold_n"), """SELECT coalesce(p.question_id, g.question_id) AS question_id,
      coalesce(p.clc, g.clc) AS clc, p.question_id IS NOT NULL AS in_pred, g.question_id IS NOT NULL AS in_gold
    FROM pred_maj2 p FULL OUTER JOIN gold_n g
      ON p.question_id = g.question_id AND p.tlc = g.tlc AND p.clc = g.clc""")


def _counts_sql(flags: str) -> str:
    def c(cond: str) -> str:
        return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"
    return f"""SELECT question_id,
      {c("clc = '' AND in_pred")} AS n_pred_t, {c("clc = '' AND in_gold")} AS n_gold_t,
      {c("clc = '' AND in_pred AND in_gold")} AS tp_t,
      {c("clc <> '' AND in_pred")} AS n_pred_c, {c("clc <> '' AND in_gold")} AS n_gold_c,
      {c("clc <> '' AND in_pred AND in_gold")} AS tp_c
    FROM {flags} GROUP BY question_id"""


def _prf_sql(tp: str, npred: str, ngold: str, suffix: str) -> str:
    p = f"(CASE WHEN {npred} = 0 THEN (CASE WHEN {ngold} = 0 THEN 1.0 ELSE 0.0 END) ELSE CAST({tp} AS DOUBLE) / {npred} END)"
    r = f"(CASE WHEN {ngold} = 0 THEN 1.0 ELSE CAST({tp} AS DOUBLE) / {ngold} END)"
    f1 = f"(CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"
    return f"CAST({p} AS DOUBLE) AS p_{suffix}, CAST({r} AS DOUBLE) AS r_{suffix}, CAST({f1} AS DOUBLE) AS f1_{suffix}"


define("counts", ("flags",), _counts_sql("flags"))
_COUNTS = ("n_pred_t", "n_gold_t", "tp_t", "n_pred_c", "n_gold_c", "tp_c")
_ZEROS = ", ".join(f"coalesce(c.{x}, 0) AS {x}" for x in _COUNTS)
define("per_q", ("counts", "gold_ids", "vote_ids"), f"""SELECT question_id, {_prf_sql('tp_t', 'n_pred_t', 'n_gold_t', 't')},
      {_prf_sql('tp_c', 'n_pred_c', 'n_gold_c', 'c')}, question_id NOT IN (SELECT question_id FROM vote_ids) AS missing_prediction
    FROM (SELECT g.question_id, {_ZEROS} FROM gold_ids g LEFT JOIN counts c ON c.question_id = g.question_id) s""")


def per_question(spark: SparkSession, d: str) -> DataFrame:
    return E.per_question_scores(ensemble(spark, d, "maj2"), canon_gold(spark, d),
                                 fx.fx_gold_ids(spark, d), predicted=fx.fx_vote_ids(spark, d))


@query("prf_tables", with_views(
    f"SELECT question_id, round(p_t, {R}) AS p_t, round(r_t, {R}) AS r_t, round(f1_t, {R}) AS f1_t FROM per_q",
    "per_q"))
def q_prf_tables(spark, d):
    return per_question(spark, d).select("question_id", *[F.round(c, R).alias(c) for c in ("p_t", "r_t", "f1_t")])


@query("prf_columns", with_views(
    f"SELECT question_id, round(p_c, {R}) AS p_c, round(r_c, {R}) AS r_c, round(f1_c, {R}) AS f1_c FROM per_q",
    "per_q"))
def q_prf_columns(spark, d):
    return per_question(spark, d).select("question_id", *[F.round(c, R).alias(c) for c in ("p_c", "r_c", "f1_c")])


LEADERBOARD_SQL = with_views(f"""
    SELECT n_questions, round(p_t, {R}) AS p_t, round(r_t, {R}) AS r_t, round(f1_t, {R}) AS f1_t,
      round(p_c, {R}) AS p_c, round(r_c, {R}) AS r_c, round(f1_c, {R}) AS f1_c,
      round(ts, {R}) AS table_score, round(cs, {R}) AS column_score, round(0.5 * ts + 0.5 * cs, {R}) AS leaderboard
    FROM (SELECT *, (p_t + r_t + f1_t) / 3.0 AS ts, (p_c + r_c + f1_c) / 3.0 AS cs
          FROM (SELECT count(*) AS n_questions, avg(p_t) AS p_t, avg(r_t) AS r_t, avg(f1_t) AS f1_t,
                       avg(p_c) AS p_c, avg(r_c) AS r_c, avg(f1_c) AS f1_c FROM per_q) a) b""", "per_q")


@query("leaderboard", LEADERBOARD_SQL)
def q_leaderboard(spark, d):
    """Flagship: majority-2 vote, canonicalised, scored against gold, macro-averaged."""
    return E.leaderboard(per_question(spark, d), R)


# The grader's semantics on every raw predictor: hallucinations kept as markers (C2) and the
# question set drives the scoring (C3): no prediction = empty, no gold record = skipped.
define("graded_raw", ("fx_votes", "cat_t", "cat_c"), """SELECT v.question_id, v.tbl AS tbl_in,
      t.tbl_c IS NULL AS bad_table, v.col IS NOT NULL AND (t.tbl_c IS NULL OR c.col_c IS NULL) AS bad_column,
      CASE WHEN t.tbl_c IS NOT NULL THEN t.tbl_c ELSE concat('__hallu__:', lower(v.tbl)) END AS tbl_g,
      CASE WHEN v.col IS NULL THEN NULL WHEN t.tbl_c IS NOT NULL AND c.col_c IS NOT NULL THEN c.col_c
           ELSE concat('__hallu__:', lower(v.col)) END AS col_g, v.voter
    FROM fx_votes v LEFT JOIN cat_t t ON v.db_id = t.db_id AND lower(v.tbl) = t.tlc
    LEFT JOIN cat_c c ON c.db_id = v.db_id AND c.tlc = lower(v.tbl) AND c.clc = lower(v.col)""")
define("graded_n", ("graded_raw",), """SELECT DISTINCT question_id, voter, lower(tbl_g) AS tlc, '' AS clc FROM graded_raw
    UNION SELECT DISTINCT question_id, voter, lower(tbl_g), lower(col_g) FROM graded_raw WHERE col_g IS NOT NULL""")
define("gold_v", ("gold_n",), "SELECT *, unnest([1, 2, 3, 4]) AS voter FROM gold_n")
define("flags_v", ("graded_n", "gold_v"), """SELECT coalesce(p.question_id, g.question_id) AS question_id, coalesce(p.voter, g.voter) AS voter,
      coalesce(p.clc, g.clc) AS clc, p.question_id IS NOT NULL AS in_pred, g.question_id IS NOT NULL AS in_gold
    FROM graded_n p FULL OUTER JOIN gold_v g
      ON p.question_id = g.question_id AND p.voter = g.voter AND p.tlc = g.tlc AND p.clc = g.clc""")
define("counts_v", ("flags_v",), _counts_sql("flags_v").replace("question_id", "question_id, voter"))


SCORE_SQL = with_views(f"""
    SELECT question_id, voter, round(p_t, {R}) AS p_t, round(r_t, {R}) AS r_t, round(f1_t, {R}) AS f1_t,
      round(p_c, {R}) AS p_c, round(r_c, {R}) AS r_c, round(f1_c, {R}) AS f1_c, missing_prediction
    FROM (SELECT question_id, voter, {_prf_sql('tp_t', 'n_pred_t', 'n_gold_t', 't')},
            {_prf_sql('tp_c', 'n_pred_c', 'n_gold_c', 'c')}, missing_prediction
          FROM (SELECT g.question_id, g.voter, {_ZEROS}, i.question_id IS NULL AS missing_prediction
                FROM (SELECT question_id, unnest([1, 2, 3, 4]) AS voter FROM gold_ids) g
                LEFT JOIN counts_v c ON c.question_id = g.question_id AND c.voter = g.voter
                LEFT JOIN vote_ids i ON i.question_id = g.question_id AND i.voter = g.voter) x) s""",
    "counts_v", "gold_ids", "vote_ids")


def _each(df: DataFrame) -> DataFrame:
    """``df`` once for every voter."""
    return df.withColumn("voter", F.explode(F.array(*[F.lit(v) for v in fx.VOTERS])))


@query("score_questions", SCORE_SQL)
def q_score_questions(spark, d):
    keys = ["question_id", "voter"]
    pred = C.graded_normal_form(C.graded_links(fx.fx_votes(spark, d), fx.fx_catalog(spark, d), keys), keys)
    pq = E.per_question_scores(pred, _each(canon_gold(spark, d)), _each(fx.fx_gold_ids(spark, d)), keys, fx.fx_vote_ids(spark, d))
    return pq.select(*keys, *[F.round(c, R).alias(c) for c in E.METRICS], "missing_prediction")


@query("hallucination_tally", with_views("""
    SELECT voter, count(DISTINCT CASE WHEN bad_table THEN concat(CAST(question_id AS VARCHAR), chr(1), tbl_in) END) AS bad_tables,
      CAST(sum(CASE WHEN bad_column THEN 1 ELSE 0 END) AS BIGINT) AS bad_columns
    FROM graded_raw GROUP BY voter""", "graded_raw"))
def q_hallucination_tally(spark, d):
    g = C.graded_links(fx.fx_votes(spark, d), fx.fx_catalog(spark, d), keys=["question_id", "voter"])
    return C.hallucination_tally(g, pred_keys=["question_id", "voter"], by=["voter"])


# The question list has questions of a database without a schema, and lacks some that were predicted.
define("asked", (), """SELECT o_orderkey AS question_id, CASE WHEN o_orderkey % 11 = 0 THEN 'no schema'
      ELSE concat('db', CAST(o_orderkey % 3 AS VARCHAR)) END AS db_id FROM orders WHERE o_orderkey % 7 <> 0""")
define("asked_status", ("asked", "fx_catalog", "gold_ids", "vote_ids"), """SELECT question_id, voter, db_id, status,
      status = 'scored' AND i IS NULL AS missing_prediction
    FROM (SELECT a.question_id, a.voter, a.db_id, v.question_id AS i,
            CASE WHEN a.db_id NOT IN (SELECT db_id FROM fx_catalog) THEN 'missing_schema'
                 WHEN a.question_id NOT IN (SELECT question_id FROM gold_ids) THEN 'missing_gold' ELSE 'scored' END AS status
          FROM (SELECT *, unnest([1, 2, 3, 4]) AS voter FROM asked) a
          LEFT JOIN vote_ids v ON v.question_id = a.question_id AND v.voter = a.voter) s""")


def asked_status(spark, d):
    id_ = F.col("o_orderkey")
    asked = read_table(spark, d, "orders").where(id_ % 7 != 0).select(
        id_.alias("question_id"), F.when(id_ % 11 == 0, "no schema").otherwise(fx.question_db("o_orderkey")).alias("db_id"))
    return E.question_status(_each(asked), fx.fx_catalog(spark, d), _each(fx.fx_gold_ids(spark, d)),
                             fx.fx_vote_ids(spark, d), ["question_id", "voter"])


@query("question_status", with_views("SELECT question_id, voter, db_id, status, missing_prediction FROM asked_status", "asked_status"))
def q_question_status(spark, d):
    return asked_status(spark, d).select("question_id", "voter", "db_id", "status", "missing_prediction")


@query("evaluation_report", with_views(f"""
    SELECT c.*, coalesce(x.n_extra, 0) AS n_extra, {", ".join(f"round({m}, {R}) AS {m}" for m in E.METRICS)},
      round((p_t + r_t + f1_t + p_c + r_c + f1_c) / 6.0, {R}) AS leaderboard
    FROM (SELECT voter, count(*) AS n_questions, count(*) FILTER (WHERE status = 'scored') AS n_scored,
            count(*) FILTER (WHERE status = 'missing_gold') AS n_missing_gold,
            count(*) FILTER (WHERE status = 'missing_schema') AS n_missing_schema,
            count(*) FILTER (WHERE missing_prediction) AS n_missing_prediction FROM asked_status GROUP BY voter) c
    LEFT JOIN (SELECT voter, {", ".join(f"avg({m}) AS {m}" for m in E.METRICS)} FROM scored GROUP BY voter) m ON m.voter = c.voter
    LEFT JOIN (SELECT voter, count(*) AS n_extra FROM vote_ids WHERE question_id NOT IN (SELECT question_id FROM asked)
               GROUP BY voter) x ON x.voter = c.voter""", "asked_status", "counts_v", "vote_ids", "asked", extra={
    "scored": f"""SELECT voter, {_prf_sql('tp_t', 'n_pred_t', 'n_gold_t', 't')}, {_prf_sql('tp_c', 'n_pred_c', 'n_gold_c', 'c')}
        FROM (SELECT g.voter, {_ZEROS} FROM asked_status g
              LEFT JOIN counts_v c ON c.question_id = g.question_id AND c.voter = g.voter WHERE g.status = 'scored') z"""}))
def q_evaluation_report(spark, d):
    keys = ["question_id", "voter"]
    pred = C.graded_normal_form(C.graded_links(fx.fx_votes(spark, d), fx.fx_catalog(spark, d), keys), keys)
    out = E.evaluation_report(pred, _each(canon_gold(spark, d)), asked_status(spark, d), fx.fx_vote_ids(spark, d), ["voter"])
    return out.withColumns({m: F.round(m, R) for m in (*E.METRICS, "leaderboard")})


# Question set of the prediction-file checks = the questions that have gold.
@query("extra_predictions", with_views("""
    SELECT DISTINCT question_id FROM fx_votes WHERE question_id NOT IN (SELECT question_id FROM fx_gold)""",
    "fx_votes", "fx_gold"))
def q_extra_predictions(spark, d):
    return E.extra_predictions(fx.fx_votes(spark, d), fx.fx_gold(spark, d))


@query("prediction_diff", with_views("""
    SELECT CAST(sum(CASE WHEN a.question_id IS NOT NULL AND b.question_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS only_left,
      CAST(sum(CASE WHEN a.question_id IS NULL AND b.question_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS only_right,
      CAST(sum(CASE WHEN a.question_id IS NOT NULL AND b.question_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS both
    FROM (SELECT question_id, tlc, clc FROM canon WHERE voter = 1) a
    FULL OUTER JOIN (SELECT question_id, tlc, clc FROM canon WHERE voter = 2) b
      ON a.question_id = b.question_id AND a.tlc = b.tlc AND a.clc = b.clc""", "canon"))
def q_prediction_diff(spark, d):
    c = canon_votes(spark, d)
    return E.prediction_diff(c.where(F.col("voter") == 1), c.where(F.col("voter") == 2))


@query("set_ops_check", with_views("""
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM (SELECT question_id, tlc, clc FROM pred_maj2
              INTERSECT SELECT question_id, tlc, clc FROM gold_n) x) AS tp,
           (SELECT CAST(count(*) AS BIGINT) FROM (SELECT question_id, tlc, clc FROM pred_maj2
              EXCEPT SELECT question_id, tlc, clc FROM gold_n) x) AS fp,
           (SELECT CAST(count(*) AS BIGINT) FROM (SELECT question_id, tlc, clc FROM gold_n
              EXCEPT SELECT question_id, tlc, clc FROM pred_maj2) x) AS fn""", "pred_maj2", "gold_n"))
def q_set_ops_check(spark, d):
    """tp / fp / fn over all link rows from the full-outer flags; the oracle uses the
    set operators."""
    pred = ensemble(spark, d, "maj2").select("question_id", "tlc", "clc")
    gold = canon_gold(spark, d).select("question_id", "tlc", "clc")
    f = E.prediction_diff(pred, gold)
    return f.select(F.col("both").alias("tp"), F.col("only_left").alias("fp"), F.col("only_right").alias("fn"))


# ---------------------------------------------------------------- pack, last-wins, profiles

PACK_SQL = with_views("""
    SELECT q.question_id, count(t.tlc) AS n_tables, CAST(coalesce(sum(n_cols), 0) AS BIGINT) AS n_columns,
      coalesce(string_agg(tbl || ':' || cols, ';' ORDER BY tbl), '') AS links_text
    FROM fx_qids q LEFT JOIN (SELECT question_id, tlc, min(tbl) AS tbl, count(col) AS n_cols,
            coalesce(string_agg(col, ',' ORDER BY col), '') AS cols
          FROM votes WHERE votes >= 2 GROUP BY question_id, tlc) t ON t.question_id = q.question_id
    GROUP BY q.question_id""", "votes", "fx_qids")


@query("links_pack", PACK_SQL)
def q_links_pack(spark, d):
    """Pack the majority vote into ``MAP<table, ARRAY<column>>`` per question; the
    map is also rendered as text so both engines can compare it."""
    return links_as_text(V.pack_links(ensemble(spark, d, "maj2"), questions=fx.fx_questions_ids(spark, d)))


def links_as_text(packed: DataFrame) -> DataFrame:
    entries = F.map_entries("schema_links")
    text = F.array_join(F.transform(entries, lambda e: F.concat(
        e["key"], F.lit(":"), F.array_join(e["value"], ","))), ";")
    return packed.select("question_id", F.size("schema_links").cast("long").alias("n_tables"),
                         F.aggregate(F.map_values("schema_links"), F.lit(0).cast("long"),
                                     lambda acc, v: acc + F.size(v)).alias("n_columns"),
                         text.alias("links_text"))


# The votes read as one prediction file whose records are written voter by voter;
# a question repeated in the file keeps its last record.
@query("last_wins", with_views("""
    SELECT question_id, max(voter) AS kept_record, count(DISTINCT voter) - 1 AS n_duplicates
    FROM fx_votes GROUP BY question_id""", "fx_votes"))
def q_last_wins(spark, d):
    records = fx.fx_votes(spark, d).select("question_id", F.col("voter").alias("kept_record")).distinct()
    return E.last_wins(records, ["kept_record"])


define("q_db", (), "SELECT o_orderkey AS question_id, o_orderstatus AS db_id FROM orders")


@query("miss_attribution", with_views(f"""
    SELECT q.db_id, count(*) AS missed_tables, round(count(*) / sum(count(*)) OVER (), {R}) AS share
    FROM gold_n g JOIN q_db q ON g.question_id = q.question_id
    WHERE g.clc = '' AND NOT EXISTS (SELECT 1 FROM pred_maj2 p WHERE p.question_id = g.question_id
                                     AND p.tlc = g.tlc AND p.clc = '')
    GROUP BY q.db_id""", "gold_n", "pred_maj2", "q_db"))
def q_miss_attribution(spark, d):
    groups = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("question_id"), F.col("o_orderstatus").alias("db_id"))
    return E.miss_attribution(ensemble(spark, d, "maj2"), canon_gold(spark, d), groups, "db_id")


@query("class_balance", with_views(f"""
    SELECT db_id, count(*) AS n_examples, CAST(sum(CASE WHEN wildcard THEN 1 ELSE 0 END) AS BIGINT) AS n_wildcard,
      round(count(*) / sum(count(*)) OVER (), {R}) AS share
    FROM (SELECT t.question_id, bool_or(t.n_cols = 0) AS wildcard
          FROM (SELECT question_id, tlc, count(*) FILTER (WHERE clc <> '') AS n_cols FROM gold_n
                GROUP BY question_id, tlc) t GROUP BY t.question_id) e
    JOIN q_db USING (question_id) GROUP BY db_id""", "gold_n", "q_db"))
def q_class_balance(spark, d):
    """Examples per database, examples with a column-less table ("wildcard"), share."""
    from ..operators.curate import class_balance
    groups = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("question_id"), F.col("o_orderstatus").alias("db_id"))
    return class_balance(canon_gold(spark, d), groups, "db_id", R)
