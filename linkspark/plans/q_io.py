"""Files written and read back (A3-A8, A10) and the pluggable predictor."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.links import explode_links, write_link_file
from ..sources.records import read_csv, read_jsonl, read_questions, write_csv, write_jsonl
from ..functions.text import stopwords_sql, tokenize_sql
from ..operators import vote as V
from ..sources.versions import publish, read_version
from ..operators.predict import predict, predict_lexical
from . import fixtures as fx
from .joins import written
from .oracle_fixtures import with_views
from .registry import query
from .q_catalog import SFT_SQL, prepared, sft_columns, sft_records
from .q_curate import audited
from .q_scoring import PACK_SQL, SCORE_SQL, canon_votes, ensemble, links_as_text, q_score_questions
from .q_stream import _scratch


@query("links_explode", with_views("""
    SELECT question_id, tbl, CAST(NULL AS VARCHAR) AS col FROM votes WHERE votes >= 2 AND clc = ''
      AND NOT EXISTS (SELECT 1 FROM votes v2 WHERE v2.question_id = votes.question_id AND v2.tlc = votes.tlc
                      AND v2.clc <> '' AND v2.votes >= 2)
    UNION ALL SELECT question_id, tbl, col FROM votes WHERE votes >= 2 AND clc <> ''""", "votes"))
def q_links_explode(spark, d):
    """The majority vote packed into JSON records (A6) and read back into link rows (A4):
    a table with an empty list yields one row with a NULL column."""
    packed = V.pack_links(ensemble(spark, d, "maj2"))
    records = packed.select("question_id", F.to_json("schema_links").alias("schema_links"))
    return explode_links(records)


@query("link_file_round_trip", PACK_SQL)
def q_link_file_round_trip(spark, d):
    """A6 to a file and back: every question has its record, also without links."""
    path = _scratch(spark, "link_file")
    write_link_file(ensemble(spark, d, "maj2"), path, fx.fx_questions_ids(spark, d))
    return links_as_text(read_jsonl(spark, path, "question_id long, schema_links map<string,array<string>>"))


@query("link_versions_round_trip", PACK_SQL)
def q_link_versions_round_trip(spark, d):
    """Two versions published one after the other, first all voted links, then the majority's; readers get the last."""
    path, schema = _scratch(spark, "link_versions"), "question_id long, schema_links map<string,array<string>>"
    votes = written(V.vote_counts(canon_votes(spark, d), lead_voter=fx.VOTERS[0]), "votes")  # counted once for both
    for mode in ("union", "maj2"):
        publish(V.pack_links(fx.by_question(spark, d, V.vote_filter(votes, mode)), questions=fx.fx_questions_ids(spark, d)), path)
    return links_as_text(read_version(spark, path, schema))


@query("question_file_round_trip", with_views("SELECT question_id, db_id, question FROM fx_questions", "fx_questions"))
def q_question_file_round_trip(spark, d):
    """A3: the question list as a file and read from it."""
    path = _scratch(spark, "questions")
    write_jsonl(fx.fx_questions(spark, d), path)
    return read_questions(spark, path)


@query("sft_round_trip", SFT_SQL)
def q_sft_round_trip(spark, d):
    """A7 then A5: the chat records as JSON lines and back, packed, since prompts repeat their schema."""
    path = _scratch(spark, "sft")
    write_jsonl(sft_records(*prepared(spark, d)), path, "gzip")
    return sft_columns(read_jsonl(spark, path, "question_id long, messages array<struct<role:string,content:string>>"))


@query("score_csv_round_trip", SCORE_SQL)
def q_score_csv_round_trip(spark, d):
    """The per-question scores as CSV and back."""
    path = _scratch(spark, "scores")
    scores = q_score_questions(spark, d)
    write_csv(scores, path)
    return read_csv(spark, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scores.schema))


@query("audit_round_trip", with_views("SELECT db_id, pos, question, status FROM cu_audit", "cu_audit"))
def q_audit_round_trip(spark, d):
    """A10: the audit of all candidates as JSON lines and back."""
    path = _scratch(spark, "audit")
    write_jsonl(audited(spark, d).select("db_id", "pos", "question", "status"), path)
    return read_jsonl(spark, path, "db_id string, pos long, question string, status string")


@query("predict_mock", with_views("SELECT question_id, '{}' AS schema_links FROM fx_qids", "fx_qids"))
def q_predict_mock(spark, d):
    return predict(fx.fx_questions_ids(spark, d))


# The built-in predictor without a model, over the derived catalog: the best tables by BM25 and the columns
# whose words the question has.
LEXICAL_TABLES = 3


@query("predict_lexical", with_views(f"""
    SELECT q.question_id, coalesce(l.links, '{{}}') AS schema_links FROM ex_qs q LEFT JOIN (
      SELECT question_id, '{{' || string_agg(item, ',' ORDER BY tbl) || '}}' AS links FROM (
        SELECT question_id, tbl, '"' || tbl || '": [' || coalesce(string_agg('"' || col || '"', ',' ORDER BY col), '') || ']' AS item
        FROM (SELECT DISTINCT t.question_id, n.tbl, c.col FROM lx_top t
              JOIN cat_t2 n ON n.db_id = t.db_id AND n.table_idx = t.table_idx
              LEFT JOIN (SELECT a.question_id, b.db_id, b.table_idx, b.col FROM lx_top a2 JOIN lx_asked a USING (question_id)
                         JOIN lx_cols b ON b.db_id = a2.db_id AND b.table_idx = a2.table_idx
                         WHERE len(b.ct) >= 2 AND list_has_all(a.qt, b.ct)) c
                ON c.question_id = t.question_id AND c.db_id = t.db_id AND c.table_idx = t.table_idx) x
        GROUP BY question_id, tbl) y GROUP BY question_id) l ON l.question_id = q.question_id""",
    "ex_qs", "tb_sc", "cat_t2", "cat_cols", extra={
        "lx_top": f"""SELECT question_id, db_id, table_idx FROM (SELECT *, row_number() OVER (
            PARTITION BY question_id ORDER BY round(score, 9) DESC, table_idx) AS rank FROM tb_sc) r WHERE rank <= {LEXICAL_TABLES}""",
        "lx_asked": f"""SELECT question_id, list_distinct(list_filter({tokenize_sql('question')},
            lambda t: length(t) >= 3 AND NOT list_contains({stopwords_sql()}, t))) AS qt FROM ex_qs""",
        "lx_cols": f"""SELECT db_id, table_idx, col, list_distinct(list_filter({tokenize_sql('col')},
            lambda t: length(t) >= 3 AND NOT list_contains({stopwords_sql()}, t))) AS ct FROM cat_cols"""}))
def q_predict_lexical(spark, d):
    cols, questions, _ = prepared(spark, d)
    return predict_lexical(questions, cols.select("db_id", "table_idx", "tbl", "col"), LEXICAL_TABLES)
