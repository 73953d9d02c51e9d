"""Retrieval queries: tokeniser, BM25 over tables / pairs, top-k, cosine top-k, recall@k,
forced gold inclusion, contexts per voter (B1, D1, D2, D3, E1, D14, C5, U3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokenize, tokenize_sql
from ..operators import ranked as RK
from ..operators import retrieve as RT
from ..operators.canon import catalog_tables
from . import fixtures as fx
from .joins import written
from .oracle_fixtures import define, with_views
from .q_scoring import R, canon_gold, canon_votes, ensemble
from .q_stream import _scratch
from .registry import ORACLES, query

TOP_K = 20       # max_tables of the reference's filtered serialisation
COSINE_K = 10

define("dt", ("fx_docs",), f"SELECT db_id, table_idx, {tokenize_sql('text')} AS toks FROM fx_docs")
define("bm_st", ("dt",), "SELECT db_id, count(*) AS n_docs, avg(len(toks)) AS avgdl FROM dt GROUP BY db_id")
define("bm_tf", ("dt",), """SELECT db_id, table_idx, term, count(*) AS f, any_value(dl) AS dl
    FROM (SELECT db_id, table_idx, greatest(1, len(toks)) AS dl, unnest(toks) AS term FROM dt) x
    GROUP BY db_id, table_idx, term""")
define("bm_df", ("bm_tf",), "SELECT db_id, term, count(*) AS df FROM bm_tf GROUP BY db_id, term")
define("bm_qt", ("fx_questions",), f"""SELECT question_id, db_id, term, count(*) AS qf
    FROM (SELECT question_id, db_id, unnest({tokenize_sql('question')}) AS term FROM fx_questions) x
    GROUP BY question_id, db_id, term""")


def _bm25_sql(qt: str, tf: str, df: str, st: str, doc: str) -> str:
    return f"""SELECT q.question_id, q.db_id, t.{doc},
      sum(q.qf * ln(1 + (s.n_docs - d.df + 0.5) / (d.df + 0.5)) * (t.f * 2.5)
          / (t.f + 1.5 * (1 - 0.75 + 0.75 * t.dl / s.avgdl))) AS score
    FROM {qt} q JOIN {tf} t ON q.db_id = t.db_id AND q.term = t.term
    JOIN {df} d ON d.db_id = t.db_id AND d.term = t.term JOIN {st} s ON s.db_id = t.db_id
    GROUP BY q.question_id, q.db_id, t.{doc}"""


define("bm_sc", ("bm_qt", "bm_tf", "bm_df", "bm_st"), _bm25_sql("bm_qt", "bm_tf", "bm_df", "bm_st", "table_idx"))


def bm25_tables(spark: SparkSession, d: str) -> DataFrame:
    return RT.bm25(fx.fx_questions(spark, d), fx.fx_docs(spark, d))


@query("tokenize", with_views(f"""SELECT table_idx, CAST(len(toks) AS INTEGER) AS n_tokens,
    array_to_string(toks, ' ') AS tokens FROM dt""", "dt"))
def q_tokenize(spark, d):
    t = fx.fx_docs(spark, d).select("table_idx", tokenize("text").alias("toks"))
    return t.select("table_idx", F.size("toks").alias("n_tokens"), F.array_join("toks", " ").alias("tokens"))


@query("bm25_tables", with_views(f"SELECT question_id, db_id, table_idx, round(score, {R}) AS score FROM bm_sc",
                                 "bm_sc"))
def q_bm25_tables(spark, d):
    return bm25_tables(spark, d).select("question_id", "db_id", "table_idx", F.round("score", R).alias("score"))


@query("bm25_topk", with_views(f"""
    SELECT question_id, table_idx, rank, round(score, {R}) AS score FROM (
      SELECT q.question_id, x.table_idx, coalesce(s.score, 0.0) AS score,
        row_number() OVER (PARTITION BY q.question_id ORDER BY round(coalesce(s.score, 0.0), 9) DESC, x.table_idx) AS rank
      FROM fx_questions q JOIN fx_docs x ON q.db_id = x.db_id
      LEFT JOIN bm_sc s ON s.question_id = q.question_id AND s.table_idx = x.table_idx) r
    WHERE rank <= {TOP_K}""", "bm_sc", "fx_questions", "fx_docs"))
def q_bm25_topk(spark, d):
    return bm25_best(spark, d, bm25_tables(spark, d))


def bm25_best(spark, d, scores):
    top = RT.top_k_with_fill(scores, fx.fx_questions(spark, d), fx.fx_docs(spark, d), TOP_K)
    return top.select("question_id", "table_idx", F.col("rank").cast("long").alias("rank"),
                      F.round("score", R).alias("score"))


@query("bm25_ranked", ORACLES["bm25_topk"])
def q_bm25_ranked(spark, d):
    """The same ranking from an index of posting blocks, without scoring every match."""
    questions, docs = fx.fx_questions(spark, d), fx.fx_docs(spark, d)
    vocabulary = RT.question_terms(questions, "question_id", "db_id", "question").select("corpus", "term")
    index = RK.build_index(docs, _scratch(spark, "index"), vocabulary=vocabulary)
    scores = RK.ranked_scores(questions, index, TOP_K, _scratch(spark, "ranked"))
    top = RT.top_k_with_fill(scores, questions, docs, TOP_K)
    return top.select("question_id", "table_idx", F.col("rank").cast("long").alias("rank"), F.round("score", R).alias("score"))


define("order_q", ("fx_base",), """SELECT question_id, db_id, string_agg(col, ' ' ORDER BY ln, col) AS question
    FROM fx_base GROUP BY question_id, db_id""")

def order_questions(spark: SparkSession, d: str) -> DataFrame:
    """One question per order: its part names in line order (bounded: lines of one order)."""
    b = fx.fx_base(spark, d)
    return b.groupBy("question_id", "db_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ln", "col"))), lambda s: s["col"]), " ")
        .alias("question"))


# D3: every vector is a query against the vectors of its own corpus (label).
@query("cosine_topk", with_views(f"""
    SELECT qid, vec_id, rank, round(score, {R}) AS score FROM (
      SELECT q.vec_id AS qid, v.vec_id, s.score,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY round(s.score, 9) DESC, v.vec_id) AS rank
      FROM fx_vec q JOIN fx_vec v ON q.db_id = v.db_id,
      LATERAL (SELECT list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) AS score) s) r
    WHERE rank <= {COSINE_K}""", "fx_vec"))
def q_cosine_topk(spark, d):
    v = fx.fx_vec(spark, d)
    q = v.select(F.col("vec_id").alias("qid"), "db_id", "embedding")
    top = RT.cosine_top_k(q, v, COSINE_K)
    return top.select("qid", "vec_id", F.col("rank").cast("long").alias("rank"), F.round("score", R).alias("score"))


# D14 over the voting fixture: tables ranked per question by the number of voters
# (ties by name); share of gold tables inside the top 1 / 2 / 3.
@query("recall_at_k", with_views(f"""
    SELECT round(avg(CASE WHEN r.rank <= 1 THEN 1.0 ELSE 0.0 END), {R}) AS recall_at_1,
           round(avg(CASE WHEN r.rank <= 2 THEN 1.0 ELSE 0.0 END), {R}) AS recall_at_2,
           round(avg(CASE WHEN r.rank <= 3 THEN 1.0 ELSE 0.0 END), {R}) AS recall_at_3,
           count(*) AS n_gold
    FROM (SELECT question_id, tlc FROM gold_n WHERE clc = '') g
    LEFT JOIN (SELECT question_id, tlc, row_number() OVER (PARTITION BY question_id ORDER BY votes DESC, tlc) AS rank
               FROM votes WHERE clc = '') r ON g.question_id = r.question_id AND g.tlc = r.tlc""",
    "gold_n", "votes"))
def q_recall_at_k(spark, d):
    from pyspark.sql import Window
    from ..operators import vote as V
    votes = V.vote_counts(canon_votes(spark, d)).where(F.col("clc") == "")
    w = Window.partitionBy("question_id").orderBy(F.desc("votes"), F.asc("tlc"))
    ranked = votes.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 3)
    gold = canon_gold(spark, d).where(F.col("clc") == "")
    out = RT.recall_at_k(ranked, gold, [1, 2, 3], doc="tlc")
    return out.select(*[F.round(f"recall_at_{k}", R).alias(f"recall_at_{k}") for k in (1, 2, 3)], "n_gold")


@query("force_include", with_views("""
    SELECT question_id, tlc FROM votes WHERE votes >= 2 AND clc = ''
    UNION
    SELECT g.question_id, lower(g.tbl) FROM fx_gold g JOIN cat_t t ON t.db_id = g.db_id AND t.tlc = lower(g.tbl)""",
    "votes", "fx_gold", "cat_t"))
def q_force_include(spark, d):
    kept = ensemble(spark, d, "maj2").where(F.col("clc") == "")
    return RT.force_include(kept, fx.fx_gold(spark, d), catalog_tables(fx.fx_catalog(spark, d)))


# Question vector = the embedding with vec_id = question_id; document vector = the
# embedding with vec_id = doc_id (documents beyond the vector count have none).
RRF_TOP_K = 10


@query("rrf_topk", with_views(f"""
    SELECT question_id, table_idx, rank_bm25, rank_embed, round(fused, {R}) AS fused, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round(fused, 12) DESC, table_idx) AS rank FROM (
        SELECT question_id, table_idx, rank_bm25, rank_embed, 1.0 / (60 + rank_bm25) + 1.0 / (60 + rank_embed) AS fused
        FROM (
          SELECT g.question_id, g.table_idx,
            row_number() OVER (PARTITION BY g.question_id ORDER BY round(coalesce(s.score, 0.0), 9) DESC, g.table_idx) - 1 AS rank_bm25,
            CASE WHEN g.cos IS NULL THEN g.n_vec
                 ELSE row_number() OVER (PARTITION BY g.question_id, g.cos IS NULL ORDER BY round(g.cos, 9) DESC, g.table_idx) - 1 END AS rank_embed
          FROM (SELECT q.question_id, x.table_idx, n.n_vec,
                  list_dot_product(CAST(qe.embedding AS DOUBLE[]), CAST(de.embedding AS DOUBLE[])) AS cos
                FROM fx_questions q JOIN fx_docs x ON q.db_id = x.db_id
                LEFT JOIN embeddings qe ON qe.vec_id = q.question_id
                LEFT JOIN embeddings de ON de.vec_id = x.table_idx
                JOIN (SELECT d.db_id, count(e.vec_id) AS n_vec FROM fx_docs d LEFT JOIN embeddings e ON e.vec_id = d.table_idx
                      GROUP BY d.db_id) n ON n.db_id = q.db_id) g
          LEFT JOIN bm_sc s ON s.question_id = g.question_id AND s.table_idx = g.table_idx) r1) r2) r3
    WHERE rank <= {RRF_TOP_K}""", "bm_sc", "fx_questions", "fx_docs"))
def q_rrf_topk(spark, d):
    return rrf_best(spark, d, bm25_tables(spark, d))


def rrf_best(spark, d, scores):
    from ..sources.tables import read_table
    emb = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    qs = fx.fx_questions(spark, d)
    qv = qs.join(emb, qs.question_id == emb.vec_id, "left").select("question_id", "db_id", F.col("embedding").alias("qvec"))
    docs = fx.fx_docs(spark, d)
    dv = emb.select(F.col("vec_id").alias("table_idx"), F.col("embedding").alias("vec"))
    top = RT.rrf_top_k(scores, qv, docs.select("db_id", "table_idx"), dv, RRF_TOP_K)
    return top.select("question_id", "table_idx", F.col("rank_bm25").cast("long").alias("rank_bm25"),
                      F.col("rank_embed").cast("long").alias("rank_embed"), F.round("fused", R).alias("fused"),
                      F.col("rank").cast("long").alias("rank"))


# Four voters, of whom one names no retriever, over the two rankings above.
VOTER_SPEC, DEFAULT_RETRIEVER, CONTEXT_K = "v1:bm25, v2 : rrf,,v3, dir:v4:bm25", "rrf", 5


@query("voter_contexts", f"""
    SELECT r.question_id, v.voter, v.path, v.retriever, r.table_idx, r.rank
    FROM (VALUES (1, 'v1', 'bm25'), (2, 'v2', 'rrf'), (3, 'v3', 'rrf'), (4, 'dir:v4', 'bm25')) v(voter, path, retriever)
    JOIN (SELECT 'bm25' AS retriever, question_id, table_idx, rank FROM ({ORACLES['bm25_topk']}) b
          UNION ALL SELECT 'rrf', question_id, table_idx, rank FROM ({ORACLES['rrf_topk']}) f) r USING (retriever)
    WHERE r.rank <= {CONTEXT_K}""")
def q_voter_contexts(spark, d):
    rankings, scores = None, written(bm25_tables(spark, d), "scores")  # which both rankings start from
    for name, ranked in (("bm25", bm25_best), ("rrf", rrf_best)):
        r = ranked(spark, d, scores).select(F.lit(name).alias("retriever"), "question_id", "table_idx", "rank")
        rankings = r if rankings is None else rankings.unionByName(r)
    voters = RT.voter_retrievers(spark.range(1).select(F.lit(VOTER_SPEC).alias("spec")), DEFAULT_RETRIEVER)
    return RT.voter_contexts(voters, rankings, CONTEXT_K)


# D14 over the ranks of the retrievers themselves: gold are the question's documents with (table_idx + question_id) % 40 = 0.
CURVE_K = 10
_EMBED_SQL = f"""SELECT question_id, table_idx, rank FROM (
      SELECT q.question_id, x.table_idx, row_number() OVER (PARTITION BY q.question_id ORDER BY round(
        list_dot_product(CAST(qe.embedding AS DOUBLE[]), CAST(de.embedding AS DOUBLE[])), 9) DESC, x.table_idx) AS rank
      FROM fx_questions q JOIN fx_docs x ON q.db_id = x.db_id
      JOIN embeddings qe ON qe.vec_id = q.question_id JOIN embeddings de ON de.vec_id = x.table_idx) r WHERE rank <= {CURVE_K}"""


@query("recall_curve", with_views(f"""
    SELECT n.retriever, k, CAST(sum(CASE WHEN r.rank <= k THEN 1 ELSE 0 END) AS BIGINT) AS found, (SELECT count(*) FROM cv_gold) AS n_gold,
      round(sum(CASE WHEN r.rank <= k THEN 1 ELSE 0 END) / (SELECT count(*) FROM cv_gold), {R}) AS recall
    FROM (SELECT unnest(['bm25', 'embed', 'rrf']) AS retriever) n CROSS JOIN (SELECT unnest(range(1, {CURVE_K} + 1)) AS k) ks
    LEFT JOIN (SELECT c.retriever, c.rank FROM cv_ranked c JOIN cv_gold g USING (question_id, table_idx)) r ON r.retriever = n.retriever
    GROUP BY n.retriever, k""", "fx_questions", "fx_docs", extra={
        "cv_gold": """SELECT q.question_id, x.table_idx FROM fx_questions q JOIN fx_docs x ON x.db_id = q.db_id
                      WHERE (x.table_idx + q.question_id) % 40 = 0""",
        "cv_ranked": f"""SELECT 'bm25' AS retriever, question_id, table_idx, rank FROM ({ORACLES['bm25_topk']}) b
                         UNION ALL SELECT 'embed', question_id, table_idx, rank FROM ({_EMBED_SQL}) e
                         UNION ALL SELECT 'rrf', question_id, table_idx, rank FROM ({ORACLES['rrf_topk']}) f"""}))
def q_recall_curve(spark, d):
    from ..sources.tables import read_table
    questions, docs = fx.fx_questions(spark, d), fx.fx_docs(spark, d)
    emb = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    asked = questions.join(emb, questions.question_id == emb.vec_id).select("question_id", "db_id", "embedding")
    vectors = docs.join(emb, docs.table_idx == emb.vec_id).select("table_idx", "db_id", "embedding")
    near = RT.cosine_top_k(asked, vectors, CURVE_K, qid="question_id", doc="table_idx")
    cols = ["question_id", "table_idx", "rank"]
    ranked, scores = None, written(bm25_tables(spark, d), "scores")
    for name, r in (("bm25", bm25_best(spark, d, scores)), ("embed", near), ("rrf", rrf_best(spark, d, scores))):
        one = r.select(F.lit(name).alias("retriever"), *cols)
        ranked = one if ranked is None else ranked.unionByName(one)
    gold = questions.join(docs, "db_id").where((F.col("table_idx") + F.col("question_id")) % 40 == 0).select("question_id", "table_idx")
    return RT.recall_curve(ranked, gold, CURVE_K).withColumn("recall", F.round("recall", R))
