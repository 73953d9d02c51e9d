"""Catalog loading and rendering queries (A1, A2, A9, B3-B10, C5 at training time).

The Spider-layout documents are *derived* from ``part`` (database = brand, table =
part type, column = part name; type and keys follow fixed rules below), then
normalised by the same loader that reads schema files.  Examples are one per
(order, brand): the question is the part names of that order's lines of the brand,
the gold links are their (type, name) pairs.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.numbers import rounded
from ..functions.text import tokenize_sql
from ..operators import canon as C
from ..operators import render as RD
from ..operators.curate import length_percentiles
from ..operators import retrieve as RT
from ..sources import catalog as CAT
from ..sources.tables import read_table
from .joins import broadcast_if_small, by_rows, parts_for, written
from .oracle_fixtures import define, with_views
from .q_retrieval import _bm25_sql
from .q_scoring import R
from .registry import query

TOP_TABLES = 3   # what the filtered queries ask for; the caller chooses, never the schema's size


def _cat_parts(spark, d):
    return (read_table(spark, d, "part")
            .select(F.col("p_brand").alias("db_id"), F.col("p_type").alias("tbl"), F.col("p_name").alias("col"))
            .distinct())


def derived_spider(spark, d):
    """One Spider document per database, built per schema (bounded by its width)."""
    p = written(_cat_parts(spark, d), "parts")
    t = (p.select("db_id", "tbl").distinct()
         .withColumn("tidx", F.dense_rank().over(Window.partitionBy("db_id").orderBy("tbl")) - 1))
    c = (p.join(t, ["db_id", "tbl"])
         .withColumn("pos", F.row_number().over(Window.partitionBy("db_id").orderBy("tidx", "col")))
         .withColumn("dtype", F.when(F.length("col") % 2 == 0, "int").otherwise("text")))
    first = c.groupBy("db_id", "tidx").agg(F.min("pos").alias("fpos"))
    first0 = first.where(F.col("tidx") == 0).select("db_id", F.col("fpos").alias("f0"))
    pk = first.join(first0, "db_id").select(
        "db_id", "tidx",
        F.when(F.col("tidx") == 0, F.concat(F.lit("["), (F.col("fpos") - 1).cast("string"), F.lit(", "),
                                             F.col("fpos").cast("string"), F.lit("]")))
        .otherwise((F.col("fpos") - 1).cast("string")).alias("pk"),
        F.when(F.col("tidx") > 0, F.array(F.col("fpos") - 1, F.col("f0") - 1).cast("array<int>")).alias("fk"))
    tabs = t.groupBy("db_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("tidx", "tbl"))),
                                              lambda x: x["tbl"]).alias("table_names_original"))
    cols = c.groupBy("db_id").agg(F.array_sort(F.collect_list(F.struct("pos", "tidx", "col", "dtype"))).alias("cs"))
    cols = cols.select("db_id",
                       F.concat(F.array(F.array(F.lit("-1"), F.lit("*"))),
                                F.transform("cs", lambda x: F.array(x["tidx"].cast("string"), x["col"])))
                       .alias("column_names_original"),
                       F.transform("cs", lambda x: x["dtype"]).alias("column_types"))
    keys = pk.groupBy("db_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("tidx", "pk"))), lambda x: x["pk"]).alias("primary_keys"),
        F.filter(F.transform(F.array_sort(F.collect_list(F.struct("tidx", "fk"))), lambda x: x["fk"]),
                 lambda x: x.isNotNull()).alias("foreign_keys"))
    return tabs.join(cols, "db_id").join(keys, "db_id").select(*[f.name for f in CAT.SPIDER_SCHEMA.fields])


def catalog(spark, d):
    """Columns and foreign keys of the derived documents, which are built once for both."""
    return CAT.normalize_catalog(derived_spider(spark, d))


define("cat_p", (), "SELECT DISTINCT p_brand AS db_id, p_type AS tbl, p_name AS col FROM part")
define("cat_t2", ("cat_p",), """SELECT db_id, tbl, CAST(dense_rank() OVER (PARTITION BY db_id ORDER BY tbl) - 1 AS INTEGER) AS table_idx
    FROM (SELECT DISTINCT db_id, tbl FROM cat_p) x""")
define("cat_pos", ("cat_p", "cat_t2"), """SELECT c.db_id, t.table_idx, c.tbl, c.col,
      row_number() OVER (PARTITION BY c.db_id ORDER BY t.table_idx, c.col) AS pos
    FROM cat_p c JOIN cat_t2 t ON c.db_id = t.db_id AND c.tbl = t.tbl""")
define("cat_first", ("cat_pos",), "SELECT db_id, table_idx, min(pos) AS fpos FROM cat_pos GROUP BY db_id, table_idx")
define("cat_cols", ("cat_pos", "cat_first"), """SELECT c.db_id, c.table_idx, c.tbl, CAST(c.pos - 1 AS INTEGER) AS column_idx,
      c.col, CASE WHEN length(c.col) % 2 = 0 THEN 'INT' ELSE 'TEXT' END AS data_type,
      (c.pos = f.fpos OR (c.table_idx = 0 AND c.pos = f.fpos + 1)) AS is_pk
    FROM cat_pos c JOIN cat_first f ON c.db_id = f.db_id AND c.table_idx = f.table_idx""")
define("cat_fks", ("cat_cols",), """SELECT a.db_id, a.tbl AS from_table, a.col AS from_column, b.tbl AS to_table, b.col AS to_column
    FROM (SELECT * FROM cat_cols c WHERE column_idx = (SELECT min(column_idx) FROM cat_cols x
            WHERE x.db_id = c.db_id AND x.table_idx = c.table_idx) AND table_idx > 0) a
    JOIN (SELECT * FROM cat_cols c WHERE table_idx = 0 AND column_idx = (SELECT min(column_idx) FROM cat_cols x
            WHERE x.db_id = c.db_id AND x.table_idx = 0)) b ON a.db_id = b.db_id""")


@query("catalog_columns", with_views("SELECT db_id, table_idx, tbl, column_idx, col, data_type, is_pk FROM cat_cols",
                                     "cat_cols"))
def q_catalog_columns(spark, d):
    cols, _ = catalog(spark, d)
    return cols.select("db_id", "table_idx", "tbl", "column_idx", "col", "data_type", "is_pk")


@query("catalog_index", with_views("""SELECT db_id, count(DISTINCT table_idx) AS num_tables, count(*) AS num_columns
    FROM cat_cols GROUP BY db_id""", "cat_cols"))
def q_catalog_index(spark, d):
    cols, _ = catalog(spark, d)
    return CAT.catalog_index(cols)


@query("fk_resolve", with_views("SELECT db_id, from_table, from_column, to_table, to_column FROM cat_fks", "cat_fks"))
def q_fk_resolve(spark, d):
    _, fks = catalog(spark, d)
    return fks.drop("fk_idx")


@query("db_file_key", with_views("""SELECT n_nationkey, n_name AS db_id,
    translate(n_name, ' /', '__') || '.json' AS file_key FROM nation"""))
def q_db_file_key(spark, d):
    n = read_table(spark, d, "nation")
    return n.select("n_nationkey", F.col("n_name").alias("db_id"), CAT.db_file_key("n_name").alias("file_key"))


def _rendered(spark, d):
    cols, fks = catalog(spark, d)
    return RD.with_fk_targets(cols, fks)


define("cat_r", ("cat_cols", "cat_fks"), """SELECT c.*, f.to_table, f.to_column FROM cat_cols c
    LEFT JOIN cat_fks f ON f.db_id = c.db_id AND f.from_table = c.tbl AND f.from_column = c.col""")
_TK = """col || ' (' || lower(data_type) || ')' || CASE WHEN is_pk THEN '*' ELSE '' END
    || CASE WHEN to_table IS NOT NULL THEN '->' || to_table || '.' || to_column ELSE '' END"""


@query("render_columns", with_views(f"SELECT db_id, tbl, col, {_TK} AS rendered FROM cat_r", "cat_r"))
def q_render_columns(spark, d):
    return _rendered(spark, d).select("db_id", "tbl", "col", RD.render_column("types_keys").alias("rendered"))


def _serialize_sql(expr: str) -> str:
    return f"""SELECT db_id, string_agg(line, chr(10) ORDER BY table_idx) AS schema_text FROM (
      SELECT db_id, table_idx, tbl || ': ' || string_agg({expr}, ', ' ORDER BY column_idx) AS line
      FROM cat_r GROUP BY db_id, table_idx, tbl) l GROUP BY db_id"""


@query("serialize_compact", with_views(_serialize_sql("col"), "cat_r"))
def q_serialize_compact(spark, d):
    return RD.serialize(RD.table_lines(_rendered(spark, d), "compact"))


_TYPE = "col || ' (' || lower(data_type) || ')'"


@query("serialize_types", with_views(_serialize_sql(_TYPE), "cat_r"))
def q_serialize_types(spark, d):
    return RD.serialize(RD.table_lines(_rendered(spark, d), "types"))


@query("serialize_keys", with_views(_serialize_sql(_TK.replace(_TYPE, "col")), "cat_r"))
def q_serialize_keys(spark, d):
    return RD.serialize(RD.table_lines(_rendered(spark, d), "keys"))


@query("serialize_types_keys", with_views(_serialize_sql(_TK), "cat_r"))
def q_serialize_types_keys(spark, d):
    return RD.serialize(RD.table_lines(_rendered(spark, d), "types_keys"))


# ---------------------------------------------------------------- examples and prompts

EXAMPLE_ROWS = 150_000  # lines of orders a partition of examples holds, about
SCORED_ROWS = 60_000  # where their questions are scored against tables, which takes a row a match


def examples(spark, d, rows: int = EXAMPLE_ROWS):
    """Questions and their gold links.  Examples are built and written once, one row each; both sides come
    partitioned by ``question_id`` alike, so that no operator on a question's own rows exchanges them again."""
    lines = parts_for(read_table(spark, d, "lineitem"), EXAMPLE_ROWS)
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = by_rows(read_table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_name"))
    b = li.join(part, li.l_partkey == part.p_partkey).select(
        (F.col("l_orderkey") * 100 + F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long")).alias("question_id"),
        F.col("p_brand").alias("db_id"), F.col("l_linenumber").alias("ln"),
        F.col("p_type").alias("tbl"), F.col("p_name").alias("col"))
    q = b.repartition(lines, "question_id").groupBy("question_id", "db_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ln", "col"))), lambda x: x["col"]), " ")
        .alias("question"), F.collect_list(F.struct("tbl", "col")).alias("links"))
    q = written(q, "examples").repartition(lines * EXAMPLE_ROWS // rows, "question_id")
    return q.drop("links"), q.select("question_id", "db_id", F.inline("links"))


def prepared(spark, d, rows: int = SCORED_ROWS):
    """Columns, questions and gold links, each computed once for a whole query."""
    cols, _ = catalog(spark, d)
    return written(cols, "catalog"), *examples(spark, d, rows)


define("ex_base", (), """SELECT l_orderkey * 100 + CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT) AS question_id,
      p_brand AS db_id, l_linenumber AS ln, p_type AS tbl, p_name AS col
    FROM lineitem JOIN part ON l_partkey = p_partkey""")
define("ex_qs", ("ex_base",), """SELECT question_id, db_id, string_agg(col, ' ' ORDER BY ln, col) AS question
    FROM ex_base GROUP BY question_id, db_id""")
# Documents are the (table, column) pairs of a database, scored for that database's questions.
define("pr_docs", ("cat_cols",), "SELECT db_id, tbl || '.' || col AS pair, tbl || ' ' || col AS text FROM cat_cols")
define("pr_dt", ("pr_docs",), f"SELECT db_id, pair, {tokenize_sql('text')} AS toks FROM pr_docs")
define("pr_st", ("pr_dt",), "SELECT db_id, count(*) AS n_docs, avg(len(toks)) AS avgdl FROM pr_dt GROUP BY db_id")
define("pr_tf", ("pr_dt",), """SELECT db_id, pair, term, count(*) AS f, any_value(dl) AS dl
    FROM (SELECT db_id, pair, greatest(1, len(toks)) AS dl, unnest(toks) AS term FROM pr_dt) x GROUP BY db_id, pair, term""")
define("pr_df", ("pr_tf",), "SELECT db_id, term, count(*) AS df FROM pr_tf GROUP BY db_id, term")
define("pr_qt", ("ex_qs",), f"""SELECT question_id, db_id, term, count(*) AS qf
    FROM (SELECT question_id, db_id, unnest({tokenize_sql('question')}) AS term FROM ex_qs) x
    GROUP BY question_id, db_id, term""")
define("pr_sc", ("pr_qt", "pr_tf", "pr_df", "pr_st"), _bm25_sql("pr_qt", "pr_tf", "pr_df", "pr_st", "pair"))


@query("bm25_pairs", with_views(f"SELECT question_id, db_id, pair, round(score, {R}) AS score FROM pr_sc", "pr_sc"))
def q_bm25_pairs(spark, d):
    """Every positive score of a question's pairs (ranking them is E1)."""
    cols, q, _ = prepared(spark, d)
    docs = cols.select("db_id", F.concat_ws(".", "tbl", "col").alias("pair"), F.concat_ws(" ", "tbl", "col").alias("text"))
    return RT.bm25(q, docs, doc="pair", as_arrays=True).select("question_id", "db_id", "pair", rounded("score", R).alias("score"))


define("tb_docs", ("cat_cols",), """SELECT db_id, table_idx, tbl || ' ' || string_agg(col, ' ' ORDER BY column_idx) AS text
    FROM cat_cols GROUP BY db_id, table_idx, tbl""")
define("tb_dt", ("tb_docs",), f"SELECT db_id, table_idx, {tokenize_sql('text')} AS toks FROM tb_docs")
define("tb_st", ("tb_dt",), "SELECT db_id, count(*) AS n_docs, avg(len(toks)) AS avgdl FROM tb_dt GROUP BY db_id")
define("tb_tf", ("tb_dt",), """SELECT db_id, table_idx, term, count(*) AS f, any_value(dl) AS dl
    FROM (SELECT db_id, table_idx, greatest(1, len(toks)) AS dl, unnest(toks) AS term FROM tb_dt) x
    GROUP BY db_id, table_idx, term""")
define("tb_df", ("tb_tf",), "SELECT db_id, term, count(*) AS df FROM tb_tf GROUP BY db_id, term")
define("tb_qt", ("ex_qs",), f"""SELECT question_id, db_id, term, count(*) AS qf
    FROM (SELECT question_id, db_id, unnest({tokenize_sql('question')}) AS term FROM ex_qs) x
    GROUP BY question_id, db_id, term""")
define("tb_sc", ("tb_qt", "tb_tf", "tb_df", "tb_st"), """SELECT q.question_id, q.db_id, t.table_idx,
      sum(q.qf * ln(1 + (s.n_docs - d.df + 0.5) / (d.df + 0.5)) * (t.f * 2.5)
          / (t.f + 1.5 * (1 - 0.75 + 0.75 * t.dl / s.avgdl))) AS score
    FROM tb_qt q JOIN tb_tf t ON q.db_id = t.db_id AND q.term = t.term
    JOIN tb_df d ON d.db_id = t.db_id AND d.term = t.term JOIN tb_st s ON s.db_id = t.db_id
    GROUP BY q.question_id, q.db_id, t.table_idx""")
define("tb_top", ("ex_qs", "cat_t2", "tb_sc"), f"""SELECT question_id, db_id, table_idx FROM (
      SELECT q.question_id, q.db_id, t.table_idx, row_number() OVER (PARTITION BY q.question_id
        ORDER BY round(coalesce(s.score, 0.0), 9) DESC, t.table_idx) AS rank
      FROM ex_qs q JOIN cat_t2 t ON q.db_id = t.db_id
      LEFT JOIN tb_sc s ON s.question_id = q.question_id AND s.table_idx = t.table_idx) r WHERE rank <= {TOP_TABLES}""")
define("tb_lines", ("cat_cols",), """SELECT db_id, table_idx, tbl || ': ' || string_agg(col, ', ' ORDER BY column_idx) AS line
    FROM cat_cols GROUP BY db_id, table_idx, tbl""")
define("kept_all", ("ex_qs", "cat_t2"), """SELECT q.question_id, q.db_id, t.table_idx
    FROM ex_qs q JOIN cat_t2 t ON t.db_id = q.db_id""")
define("kept_train", ("tb_top", "ex_base", "cat_t2"), """SELECT question_id, db_id, table_idx FROM tb_top
    UNION SELECT DISTINCT b.question_id, b.db_id, t.table_idx FROM ex_base b
      JOIN cat_t2 t ON t.db_id = b.db_id AND lower(t.tbl) = lower(b.tbl)""")


def _ctx_sql(kept: str) -> str:
    return f"""SELECT k.question_id, count(*) AS n_tables, string_agg(l.line, chr(10) ORDER BY k.table_idx) AS context
      FROM {kept} k JOIN tb_lines l ON l.db_id = k.db_id AND l.table_idx = k.table_idx GROUP BY k.question_id"""


define("ctx_all", ("kept_all", "tb_lines"), _ctx_sql("kept_all"))
define("ctx_top", ("tb_top", "tb_lines"), _ctx_sql("tb_top"))
define("ctx_train", ("kept_train", "tb_lines"), _ctx_sql("kept_train"))
_USER = ("'Database: ' || q.db_id || chr(10) || 'Schema:' || chr(10) || c.context || chr(10) || chr(10) || "
         "'Question: ' || q.question || chr(10) || chr(10) || 'Output the schema_links JSON now.'")


def kept_tables(cols, q, gold, top: int, with_gold: bool = False):
    """B6 selection: the question's ``top`` tables by BM25 (zero-filled), plus gold tables at training time."""
    tdocs = cols.groupBy("db_id", "table_idx", "tbl").agg(
        F.array_sort(F.collect_list(F.struct("column_idx", "col"))).alias("c"))
    tdocs = tdocs.select("db_id", "table_idx", "tbl", F.concat_ws(" ", F.col("tbl"), F.array_join(
        F.transform("c", lambda x: x["col"]), " ")).alias("text"))
    tables = tdocs.select("db_id", "table_idx")
    kept = RT.top_k_with_fill(RT.bm25(q, tdocs), q, tables, top).select("question_id", "db_id", "table_idx")
    if with_gold:
        tnames = tdocs.select("db_id", "table_idx", F.lower("tbl").alias("tlc"))
        g = (gold.select("question_id", "db_id", F.lower("tbl").alias("tlc")).distinct()
             .join(broadcast_if_small(tnames), ["db_id", "tlc"]).select("question_id", "db_id", "table_idx"))
        kept = kept.unionByName(g)
    return kept.distinct()


def _lines(cols):
    return RD.table_lines(cols.withColumn("to_table", F.lit(None).cast("string"))
                          .withColumn("to_column", F.lit(None).cast("string")), "compact")


def contexts(cols, q, gold, top: int, with_gold: bool = False):
    return RD.context_for_questions(kept_tables(cols, q, gold, top, with_gold), _lines(cols))


def with_question(q, other):
    """``other`` joined to its questions, which are the smaller rows of a partition."""
    return other.join(q.hint("shuffle_hash"), "question_id")


def _md5_cols(text):
    return [F.length(text).cast("long").alias("n_chars"), F.md5(text).alias("md5")]


@query("prompt_context", with_views("SELECT question_id, n_tables, CAST(length(context) AS BIGINT) AS n_chars, "
                                    "md5(context) AS md5 FROM ctx_all", "ctx_all"))
def q_prompt_context(spark, d):
    """B6 with the whole schema: its text is assembled, and its digest taken, once for the databases of a question (one,
    unless ids of questions meet), not once a question."""
    cols, q, _ = prepared(spark, d)
    asked = q.groupBy("question_id").agg(F.array_sort(F.collect_set("db_id")).alias("dbs"))
    tables = cols.select("db_id", "table_idx").distinct()
    kept = written(asked.select("dbs").distinct(), "schemas").withColumn("db_id", F.explode("dbs")).join(broadcast_if_small(tables), "db_id")
    texts = RD.context_for_questions(kept, _lines(cols), ("dbs",))
    texts = written(texts.select("dbs", F.col("n_tables").cast("long").alias("n_tables"), *_md5_cols(F.col("context"))), "schema_texts")
    return asked.join(broadcast_if_small(texts), "dbs").select("question_id", "n_tables", "n_chars", "md5")


@query("prompt_context_topk", with_views("SELECT question_id, n_tables, context FROM ctx_top", "ctx_top"))
def q_prompt_context_topk(spark, d):
    """B6 with the best tables by BM25."""
    ctx = contexts(*prepared(spark, d), TOP_TABLES)
    return ctx.select("question_id", F.col("n_tables").cast("long").alias("n_tables"), "context")


@query("build_prompt", with_views(f"""SELECT q.question_id, {_USER} AS user_text
    FROM ex_qs q JOIN ctx_top c ON c.question_id = q.question_id""", "ex_qs", "ctx_top"))
def q_build_prompt(spark, d):
    cols, q, gold = prepared(spark, d)
    j = with_question(q, contexts(cols, q, gold, TOP_TABLES))
    user = RD.user_message(F.col("db_id"), F.col("question"), F.col("context"))
    return j.select("question_id", user.alias("user_text"))


def gold_targets(cols, gold):
    return RD.canonical_target(gold_links(cols, gold))


def gold_links(cols, gold):
    return C.canonicalize(gold.select("question_id", "db_id", "tbl", "col"), cols.select("db_id", "tbl", "col"), exchange=False)


define("ex_gold", ("ex_base",), "SELECT DISTINCT question_id, tbl, col FROM ex_base")
define("ex_target", ("ex_gold",), """SELECT question_id, '{' || string_agg(item, ',' ORDER BY tbl) || '}' AS target FROM (
      SELECT question_id, tbl, '"' || tbl || '": [' || string_agg('"' || col || '"', ',' ORDER BY col) || ']' AS item
      FROM ex_gold GROUP BY question_id, tbl) x GROUP BY question_id""")


@query("canonical_target", with_views("SELECT question_id, target FROM ex_target", "ex_target"))
def q_canonical_target(spark, d):
    cols, _, gold = prepared(spark, d)
    return gold_targets(cols, gold)


SFT_SQL = with_views(f"""SELECT q.question_id, 3 AS n_messages, {_USER} AS user_text, t.target
    FROM ex_qs q JOIN ctx_train c ON c.question_id = q.question_id JOIN ex_target t ON t.question_id = q.question_id""",
    "ex_qs", "ctx_train", "ex_target")


def sft_records(cols, q, gold):
    """[system, user (context with gold tables forced in), assistant = canonical target]."""
    ctx = contexts(cols, q, gold, TOP_TABLES, with_gold=True)
    j = with_question(q, ctx).join(gold_targets(cols, gold).hint("shuffle_hash"), "question_id")
    msgs = F.array(F.struct(F.lit("system").alias("role"), F.lit(RD.SYSTEM_PROMPT).alias("content")),
                   F.struct(F.lit("user").alias("role"),
                            RD.user_message(F.col("db_id"), F.col("question"), F.col("context")).alias("content")),
                   F.struct(F.lit("assistant").alias("role"), F.col("target").alias("content")))
    return j.select("question_id", msgs.alias("messages"))


def sft_columns(m):
    return m.select("question_id", F.size("messages").alias("n_messages"),
                    m.messages[1]["content"].alias("user_text"), m.messages[2]["content"].alias("target"))


@query("format_sft", SFT_SQL)
def q_format_sft(spark, d):
    return sft_columns(sft_records(*prepared(spark, d)))


@query("two_stage_a", with_views("""SELECT q.question_id, md5('Database: ' || q.db_id || chr(10) || 'Tables:' || chr(10)
      || t.tl || chr(10) || chr(10) || 'Question: ' || q.question || chr(10) || chr(10) || 'Output the tables JSON now.') AS md5
    FROM ex_qs q JOIN (SELECT db_id, string_agg('- ' || tbl, chr(10) ORDER BY table_idx) AS tl FROM cat_t2 GROUP BY db_id) t
      ON t.db_id = q.db_id""", "ex_qs", "cat_t2"))
def q_two_stage_a(spark, d):
    """B10 stage A (schemas here have at most 40 tables, so no table filter applies)."""
    cols, q, _ = prepared(spark, d)
    tl = cols.select("db_id", "table_idx", "tbl").distinct().groupBy("db_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("table_idx", "tbl"))), lambda x: x["tbl"]).alias("tl"))
    j = q.join(broadcast_if_small(tl), "db_id")
    return j.select("question_id", F.md5(RD.stage_a_user(F.col("db_id"), F.col("question"), F.col("tl"))).alias("md5"))


@query("two_stage_b", with_views("""SELECT q.question_id, g.tbl, md5('Database: ' || q.db_id || chr(10) || 'Table: ' || g.tbl
      || chr(10) || 'Columns: ' || c.cl || chr(10) || chr(10) || 'Question: ' || q.question || chr(10) || chr(10)
      || 'Output the columns JSON now.') AS md5
    FROM ex_qs q JOIN (SELECT DISTINCT question_id, tbl FROM ex_gold) g ON g.question_id = q.question_id
    JOIN (SELECT db_id, tbl, string_agg(col, ', ' ORDER BY column_idx) AS cl FROM cat_cols GROUP BY db_id, tbl) c
      ON c.db_id = q.db_id AND c.tbl = g.tbl""", "ex_qs", "ex_gold", "cat_cols"))
def q_two_stage_b(spark, d):
    """B10 stage B: one row per gold table of an example (explode gold x catalog columns)."""
    cols, q, gold = prepared(spark, d)
    cl = cols.groupBy("db_id", "tbl").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("column_idx", "col"))), lambda x: x["col"]).alias("cl"))
    g = gold.select("question_id", "tbl").distinct()
    j = with_question(q, g).join(broadcast_if_small(cl), ["db_id", "tbl"])
    return j.select("question_id", "tbl",
                    F.md5(RD.stage_b_user(F.col("db_id"), F.col("question"), F.col("tbl"), F.col("cl"))).alias("md5"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STAGE_KEYS = ("question_id", "db_id")


def turns(records):
    return records.select(*[c for c in records.columns if c != "messages"], *[
        records.messages[i]["content"].alias(name) for i, name in enumerate(("system_text", "user_text", "target"))])


@query("two_stage_a_records", with_views(f"""SELECT q.question_id, q.db_id, {_quoted(RD.STAGE_A_SYSTEM)} AS system_text,
      'Database: ' || q.db_id || chr(10) || 'Tables:' || chr(10) || t.tl || chr(10) || chr(10) || 'Question: ' || q.question
        || chr(10) || chr(10) || 'Output the tables JSON now.' AS user_text, g.target
    FROM ex_qs q JOIN (SELECT db_id, string_agg('- ' || tbl, chr(10) ORDER BY table_idx) AS tl FROM cat_t2 GROUP BY db_id) t ON t.db_id = q.db_id
    JOIN (SELECT question_id, '{{"tables": [' || string_agg('"' || tbl || '"', ',' ORDER BY tbl) || ']}}' AS target
          FROM (SELECT DISTINCT question_id, tbl FROM ex_gold) x GROUP BY question_id) g ON g.question_id = q.question_id""",
    "ex_qs", "cat_t2", "ex_gold"))
def q_two_stage_a_records(spark, d):
    """B10 stage A: the whole record, one per example."""
    cols, q, gold = prepared(spark, d)
    names = F.transform(F.array_sort(F.collect_set(F.struct("table_idx", "tbl"))), lambda x: x["tbl"])
    shown = cols.groupBy("db_id").agg(names.alias("tl"))
    wanted = gold.groupBy("question_id").agg(F.array_sort(F.collect_set("tbl")).alias("gold"))
    j = with_question(q.join(broadcast_if_small(shown), "db_id"), wanted)
    user = RD.stage_a_user(F.col("db_id"), F.col("question"), F.col("tl"))
    return turns(j.select(*STAGE_KEYS, RD.messages(RD.STAGE_A_SYSTEM, user, RD.named_list("tables", F.col("gold"))).alias("messages")))


@query("two_stage_b_records", with_views(f"""SELECT q.question_id, q.db_id, g.tbl, {_quoted(RD.STAGE_B_SYSTEM)} AS system_text,
      'Database: ' || q.db_id || chr(10) || 'Table: ' || g.tbl || chr(10) || 'Columns: ' || c.cl || chr(10) || chr(10) || 'Question: '
        || q.question || chr(10) || chr(10) || 'Output the columns JSON now.' AS user_text, g.target
    FROM ex_qs q JOIN (SELECT question_id, tbl, '{{"columns": [' || string_agg('"' || col || '"', ',' ORDER BY col) || ']}}' AS target
                       FROM ex_gold GROUP BY question_id, tbl) g ON g.question_id = q.question_id
    JOIN (SELECT db_id, tbl, string_agg(col, ', ' ORDER BY column_idx) AS cl FROM cat_cols GROUP BY db_id, tbl) c
      ON c.db_id = q.db_id AND c.tbl = g.tbl""", "ex_qs", "ex_gold", "cat_cols"))
def q_two_stage_b_records(spark, d):
    """B10 stage B: the whole record, one per gold table of an example."""
    cols, q, gold = prepared(spark, d)
    cl = cols.groupBy("db_id", "tbl").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("column_idx", "col"))), lambda x: x["col"]).alias("cl"))
    g = gold_links(cols, gold).groupBy("question_id", "tbl").agg(F.array_sort(F.collect_set("col")).alias("gold"))
    j = with_question(q, g).join(broadcast_if_small(cl), ["db_id", "tbl"])
    user = RD.stage_b_user(F.col("db_id"), F.col("question"), F.col("tbl"), F.col("cl"))
    return turns(j.select(*STAGE_KEYS, "tbl", RD.messages(RD.STAGE_B_SYSTEM, user, RD.named_list("columns", F.col("gold"))).alias("messages")))


# B9 with rationales: two examples in three have one, of which every fifth is blank.
define("ex_reasons", ("ex_qs",), """SELECT question_id, CASE WHEN question_id % 3 = 0 THEN NULL WHEN question_id % 5 = 0 THEN ''
      ELSE '  It asks of ' || CAST(length(question) AS VARCHAR) || ' letters. ' || chr(10) END AS reasoning FROM ex_qs""")


@query("format_sft_reasoning", with_views(f"""SELECT q.question_id, {_USER} AS user_text,
      regexp_replace(r.reasoning, '^\\s+|\\s+$', '', 'g') || chr(10) || t.target AS target
    FROM ex_qs q JOIN ctx_train c ON c.question_id = q.question_id JOIN ex_target t ON t.question_id = q.question_id
    JOIN ex_reasons r ON r.question_id = q.question_id WHERE r.reasoning <> ''""", "ex_qs", "ctx_train", "ex_target", "ex_reasons"))
def q_format_sft_reasoning(spark, d):
    """Examples without a rationale are left out, the others answer with it before the target."""
    cols, q, gold = prepared(spark, d)
    said = F.concat(F.lit("  It asks of "), F.length("question").cast("string"), F.lit(" letters. \n"))
    reasons = q.select("question_id", F.when(F.col("question_id") % 3 == 0, F.lit(None)).when(F.col("question_id") % 5 == 0, "").otherwise(said).alias("reasoning"))
    j = with_question(reasons, sft_columns(sft_records(cols, q, gold)))
    return j.withColumn("target", RD.reasoned(F.col("reasoning"), F.col("target"))).where(F.col("target").isNotNull()).select(
        "question_id", "user_text", "target")


# B16 over rendered examples: exact percentiles, from how often each length occurs, per database and over all.
@query("length_percentiles", with_views(f"""SELECT coalesce(db_id, '*') AS db_id, count(*) AS n_examples, max(n) AS max_chars,
      quantile_disc(n, 0.5) AS p50_chars, quantile_disc(n, 0.9) AS p90_chars, quantile_disc(n, 0.99) AS p99_chars
    FROM (SELECT q.db_id, length({_quoted(RD.SYSTEM_PROMPT)}) + length({_USER}) + length(t.target) AS n
          FROM ex_qs q JOIN ctx_train c ON c.question_id = q.question_id JOIN ex_target t ON t.question_id = q.question_id) x
    GROUP BY ROLLUP (db_id)""", "ex_qs", "ctx_train", "ex_target"))
def q_length_percentiles(spark, d):
    cols, q, gold = prepared(spark, d)
    records = with_question(q.select("question_id", "db_id"), sft_records(cols, q, gold))
    n = F.aggregate("messages", F.lit(0), lambda a, m: a + F.length(m["content"])).cast("long")
    return length_percentiles(records.select("db_id", n.alias("n")), "db_id", (0.5, 0.9, 0.99))
