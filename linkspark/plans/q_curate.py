"""Curation queries over ``fx_cand``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import tokenize, tokenize_sql, word_count
from ..operators import curate as CU
from ..sources.tables import read_table
from . import fixtures as fx
from .oracle_fixtures import define, with_views
from .q_scoring import R, ensemble
from .q_stream import _scratch
from .registry import query

CAP = 5          # the limit asked for by the query cap_per_group; the others have none
FEWSHOT_K = 5
GAP = 700        # fixed id gap above the existing examples

_WS = r"'^\s+|\s+$'"


def _split(spark, d):
    c = fx.fx_cand(spark, d)
    return c.where(F.col("pos") % 10 == 0), c.where(F.col("pos") % 10 != 0)


define("cu_cand", ("fx_cand",), f"""SELECT *, lower(regexp_replace(coalesce(question, ''), {_WS}, '', 'g')) AS norm,
      (lower(regexp_replace(coalesce(question, ''), {_WS}, '', 'g')) = ''
       OR regexp_replace(coalesce(gold_sql, ''), {_WS}, '', 'g') = '') AS empty
    FROM fx_cand WHERE pos % 10 <> 0""")
define("cu_seen", ("fx_cand",), f"""SELECT DISTINCT lower(regexp_replace(coalesce(question, ''), {_WS}, '', 'g')) AS norm
    FROM fx_cand WHERE pos % 10 = 0""")
define("cu_first", ("cu_cand", "cu_seen"), """SELECT norm, min(pos) AS first_ok FROM cu_cand
    WHERE NOT empty AND NOT parse_failed AND n_tables > 0 AND norm NOT IN (SELECT norm FROM cu_seen) GROUP BY norm""")
define("cu_audit", ("cu_cand", "cu_first", "cu_seen"), """SELECT c.db_id, c.pos, c.question, CASE
      WHEN c.empty THEN 'empty_question_or_sql'
      WHEN c.norm IN (SELECT norm FROM cu_seen) THEN 'duplicate_question'
      WHEN f.first_ok IS NOT NULL AND c.pos > f.first_ok THEN 'duplicate_question'
      WHEN c.parse_failed THEN 'parse_error' WHEN c.n_tables <= 0 THEN 'zero_recognized_tables' ELSE 'ok' END AS status
    FROM cu_cand c LEFT JOIN cu_first f ON c.norm = f.norm""")
define("cu_capped", ("cu_audit",), f"""SELECT a.db_id, a.pos, a.question,
      CASE WHEN l.k = {CAP} AND a.pos > l.last THEN 'over_limit' ELSE a.status END AS status FROM cu_audit a LEFT JOIN (
      SELECT db_id, max(pos) AS last, count(*) AS k FROM (
        SELECT db_id, pos, row_number() OVER (PARTITION BY db_id ORDER BY pos) AS r FROM cu_audit WHERE status = 'ok') x
      WHERE r <= {CAP} GROUP BY db_id) l ON a.db_id = l.db_id""")
define("cu_new", ("cu_audit", "fx_cand"), f"""SELECT pos, db_id, question,
      (SELECT max(pos) FROM fx_cand WHERE pos % 10 = 0) + {GAP} + row_number() OVER (ORDER BY pos) - 1 AS question_id
    FROM cu_audit WHERE status = 'ok'""")


def audited(spark, d):
    existing, cand = _split(spark, d)
    return CU.validate_candidates(cand, existing)


def capped(spark, d):
    return CU.cap_per_group(audited(spark, d), CAP)


def new_examples(spark, d):
    existing, _ = _split(spark, d)
    kept = audited(spark, d).where(F.col("status") == CU.STATUS_OK)
    return CU.assign_ids(kept, existing.select(F.col("pos").alias("question_id")), GAP)


@query("validate_candidates", with_views("SELECT db_id, pos, status FROM cu_audit", "cu_audit"))
def q_validate_candidates(spark, d):
    return audited(spark, d).select("db_id", "pos", "status")


@query("cap_per_group", with_views("SELECT db_id, pos, status FROM cu_capped", "cu_capped"))
def q_cap_per_group(spark, d):
    return capped(spark, d).select("db_id", "pos", "status")


@query("assign_ids", with_views("SELECT pos, db_id, question_id FROM cu_new", "cu_new"))
def q_assign_ids(spark, d):
    return new_examples(spark, d).select("pos", "db_id", "question_id")


@query("merge_train", with_views("""
    SELECT pos AS question_id, db_id, question FROM fx_cand WHERE pos % 10 = 0
    UNION ALL SELECT question_id, db_id, question FROM cu_new""", "fx_cand", "cu_new"))
def q_merge_train(spark, d):
    existing, _ = _split(spark, d)
    old = existing.select(F.col("pos").alias("question_id"), "db_id", "question")
    return old.unionByName(new_examples(spark, d).select("question_id", "db_id", "question"))


@query("drop_reasons", with_views("SELECT status, count(*) AS n FROM cu_audit GROUP BY status", "cu_audit"))
def q_drop_reasons(spark, d):
    return CU.status_histogram(audited(spark, d))


define("fs_ex", ("fx_cand",), """SELECT db_id, regexp_replace(db_id, '[0-9]+$', '') AS family, pos,
      (pos * 2654435761) % 4294967296 AS h FROM fx_cand WHERE pos % 10 = 0""")


@query("fewshot_sample", with_views(f"""
    SELECT db_id, pos, slot FROM fs_own WHERE slot <= {FEWSHOT_K}
    UNION ALL SELECT db_id, pos, slot FROM fs_sib WHERE slot <= {FEWSHOT_K}""", "fs_ex", "fx_cand", extra={
    "fs_own": "SELECT db_id, family, pos, row_number() OVER (PARTITION BY db_id ORDER BY h, pos) AS slot FROM fs_ex",
    "fs_cnt": f"""SELECT g.db_id, g.family, count(o.pos) FILTER (WHERE o.slot <= {FEWSHOT_K}) AS n_own
                  FROM (SELECT DISTINCT db_id, regexp_replace(db_id, '[0-9]+$', '') AS family FROM fx_cand) g
                  LEFT JOIN fs_own o ON o.db_id = g.db_id GROUP BY g.db_id, g.family""",
    "fs_sib": f"""SELECT c.db_id, e.pos, c.n_own + row_number() OVER (PARTITION BY c.db_id ORDER BY e.h, e.pos) AS slot
                  FROM fs_cnt c JOIN fs_ex e ON e.family = c.family AND e.db_id <> c.db_id
                  WHERE c.n_own < {FEWSHOT_K}"""}))
def q_fewshot_sample(spark, d):
    existing, _ = _split(spark, d)
    family = F.regexp_replace("db_id", "[0-9]+$", "").alias("family")
    ex = existing.select("db_id", family, "pos")
    return CU.fewshot_sample(ex, FEWSHOT_K, targets=fx.fx_cand(spark, d).select("db_id", family)).select("db_id", "pos", F.col("slot").cast("long").alias("slot"))


# Length profile of the documents as training examples (chars, chars/4 tokens, share over a cap).
TOKEN_CAP = 3700


@query("length_profile", with_views(f"""
    SELECT count(*) AS n_examples, max(length(text)) AS max_chars,
      round(avg(length(text) / 4.0), {R}) AS avg_tokens_est,
      round(avg(CASE WHEN length(text) / 4.0 > {TOKEN_CAP} THEN 1.0 ELSE 0.0 END), {R}) AS share_over_cap
    FROM documents"""))
def q_length_profile(spark, d):
    docs = read_table(spark, d, "documents").select(F.length("text").alias("n"))
    return docs.agg(F.count(F.lit(1)).alias("n_examples"), F.max("n").cast("long").alias("max_chars"),
                    F.round(F.avg(F.col("n") / 4.0), R).alias("avg_tokens_est"),
                    F.round(F.avg(F.when(F.col("n") / 4.0 > TOKEN_CAP, 1.0).otherwise(0.0)), R).alias("share_over_cap"))


# Assistant turns are rationales; a conversation's "gold tables" are the long words
# (>= 7 letters) of its user turns.  Keep = non-empty, <= 80 words, mentions a gold table.
define("rt_gold", (), r"""SELECT DISTINCT conv_id, lower(w) AS t FROM (
      SELECT conv_id, unnest(regexp_extract_all(text, '[\p{L}]{7,}')) AS w FROM conversations WHERE role = 'user') x""")


@query("rationale_filter", with_views(r"""
    SELECT c.conv_id, c.turn,
      (regexp_replace(c.text, '^\s+|\s+$', '', 'g') <> ''
       AND len(string_split_regex(regexp_replace(c.text, '^\s+|\s+$', '', 'g'), '\s+')) <= 80
       AND EXISTS (SELECT 1 FROM rt_gold g WHERE g.conv_id = c.conv_id AND contains(lower(c.text), g.t))) AS keep
    FROM conversations c WHERE c.role = 'assistant'""", "rt_gold"))
def q_rationale_filter(spark, d):
    from ..operators.curate import rationale_filter
    conv = read_table(spark, d, "conversations")
    gold = (conv.where(F.col("role") == "user")
            .select("conv_id", F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}]{7,}"), 0)).alias("w"))
            .select("conv_id", F.lower("w").alias("t")).distinct())
    rat = conv.where(F.col("role") == "assistant").select("conv_id", "turn", "text")
    return rationale_filter(rat, gold, ["conv_id"]).select("conv_id", "turn", "keep")


# Predicted columns = the majority vote; question text = the order's part names.
define("ex_q", ("order_q",), f"""SELECT question_id, db_id, list_distinct(list_filter({tokenize_sql('question')},
      lambda t: length(t) >= 3 AND NOT list_contains(STOPWORDS_LIST, t))) AS qt FROM order_q""")
define("ex_cols", ("fx_catalog",), f"""SELECT db_id, lower(tbl) AS tlc, lower(col) AS clc, min(tbl) AS tbl, min(col) AS col,
      any_value(list_distinct(list_filter({tokenize_sql('col')},
        lambda t: length(t) >= 3 AND NOT list_contains(STOPWORDS_LIST, t)))) AS ct
    FROM fx_catalog GROUP BY db_id, lower(tbl), lower(col)""")
define("ex_pred", ("votes",), "SELECT question_id, tlc, clc, tbl, col FROM votes WHERE votes >= 2")


@query("expand_columns", with_views("""
    SELECT question_id, tbl, col FROM ex_pred
    UNION
    SELECT p.question_id, c.tbl, c.col FROM ex_pred p JOIN ex_q q ON q.question_id = p.question_id
    JOIN ex_cols c ON c.db_id = q.db_id AND p.tlc = c.tlc AND p.clc = ''
    WHERE len(c.ct) >= 2 AND len(q.qt) > 0 AND list_has_all(q.qt, c.ct)""", "ex_pred", "ex_cols", "ex_q")
    .replace("STOPWORDS_LIST", __import__("linkspark.functions.text", fromlist=["x"]).stopwords_sql()))
def q_expand_columns(spark, d):
    from .q_retrieval import order_questions
    cat = fx.fx_catalog(spark, d)
    cols = (cat.groupBy("db_id", F.lower("tbl").alias("tlc"), F.lower("col").alias("clc"))
            .agg(F.min("tbl").alias("tbl"), F.min("col").alias("col")))
    out = CU.expand_columns(ensemble(spark, d, "maj2"), order_questions(spark, d), cols)
    return out.select("question_id", "tbl", "col")


# E5 and E6 as one pass would take them: source by source in document order, a source closed after ADMIT kept ones.
ADMIT = 12


@query("sequential_admission", with_views(f"""
    , ad_new AS (SELECT *, md5(regexp_replace(lower(question), '^\\s+|\\s+$', '', 'g')) AS h,
        regexp_replace(lower(question), '^\\s+|\\s+$', '', 'g') = '' OR gold_sql = '' AS blank
      FROM fx_cand WHERE pos % 5 <> 0),
    ad_old AS (SELECT DISTINCT md5(regexp_replace(lower(question), '^\\s+|\\s+$', '', 'g')) AS h FROM fx_cand WHERE pos % 5 = 0),
    ad_seq AS (SELECT a.*, o.h IS NOT NULL AS old, row_number() OVER (ORDER BY db_id, pos) AS i FROM ad_new a LEFT JOIN ad_old o ON o.h = a.h),
    ad_run AS (
      SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS db_id, CAST(0 AS BIGINT) AS pos, CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS kept,
        CAST('' AS VARCHAR) AS status
      UNION ALL
      SELECT i, db_id, pos, n0 + CASE WHEN s = 'ok' THEN 1 ELSE 0 END, CASE WHEN s = 'ok' THEN list_append(kept, h) ELSE kept END, s FROM (
        SELECT c.i, c.db_id, c.pos, c.h, r.kept, CASE WHEN c.db_id = r.db_id THEN r.n ELSE 0 END AS n0,
          CASE WHEN c.db_id = r.db_id AND r.n >= {ADMIT} THEN 'over_limit' WHEN c.blank THEN 'empty_question_or_sql'
            WHEN c.old OR list_contains(r.kept, c.h) THEN 'duplicate_question' WHEN c.parse_failed THEN 'parse_error'
            WHEN c.n_tables <= 0 THEN 'zero_recognized_tables' ELSE 'ok' END AS s
        FROM ad_run r JOIN ad_seq c ON c.i = r.i + 1) x)
    SELECT db_id, pos, status FROM ad_run WHERE i > 0""", "fx_cand").replace("WITH ", "WITH RECURSIVE ", 1).replace("\n\n    ,", ",").replace("\n    , ad_new", ", ad_new"))
def q_sequential_admission(spark, d):
    cand = fx.fx_cand(spark, d)
    return CU.sequential_admission(cand.where("pos % 5 <> 0"), cand.where("pos % 5 = 0"), ADMIT, _scratch(spark, "admission")).select(
        "db_id", "pos", "status")
