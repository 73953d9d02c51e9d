"""What must not grow with the tables: broadcasts, passes over the documents, a task's rows."""

import hashlib
import random
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from linkspark.functions.numbers import rounded
from linkspark.operators import canon as C
from linkspark.operators import retrieve as RT
from linkspark.plans import fixtures as fx
from linkspark.plans import joins
from linkspark.plans import q_catalog as qc


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """The columns of each exchange by hash that an operator needed."""
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\), ENSURE", plan(df))]


def orders_and_parts(spark, folder):
    """Tables of six lines over four parts."""
    spark.createDataFrame([(k, f"Brand#{k % 2 + 1}", "SMALL", f"red gear{k}") for k in range(4)],
                          "p_partkey long, p_brand string, p_type string, p_name string").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 3, 1), (2, 0, 7), (3, 1, 1)],
                          "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_parts_of_many_rows_are_not_broadcast(spark, tmp_path, monkeypatch):
    d = orders_and_parts(spark, str(tmp_path))
    joined = lambda: [fx.fx_base(spark, d), fx.fx_mentions(spark, d)]
    few = [sorted(map(tuple, df.collect()), key=str) for df in joined()]
    asked = sorted(map(tuple, qc.examples(spark, d)[0].collect()))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 3)
    for df, rows in zip(joined(), few):
        # the files are far below Spark's own limit
        assert "Broadcast" not in plan(df)
        assert sorted(map(tuple, df.collect()), key=str) == rows
    assert sorted(map(tuple, qc.examples(spark, d)[0].collect())) == asked and len(asked) == 5


def corpus(spark, folder):
    """Questions, and documents on disk: an id that comes twice, a text without words, one that is null."""
    texts = ["red gear hot bolt", "red red bolt", "", None, "old gear", "unasked words only", "gear"]
    rows = [(f"d{i % 2}", i, t) for i, t in enumerate(texts)] + [("d0", 0, "red gear hot bolt"), ("d2", 9, None), ("d1", 11, "gear bolt " * 40)]
    spark.createDataFrame(rows, "db_id string, table_idx long, text string").write.parquet(f"{folder}/docs")
    asked = [(1, "d0", "red gear"), (2, "d1", "bolt bolt hot"), (3, "d1", "gear"), (4, "d2", "red"), (5, "d0", None)]
    spark.createDataFrame(asked, "question_id long, db_id string, question string").write.parquet(f"{folder}/asked")
    return spark.read.parquet(f"{folder}/asked"), spark.read.parquet(f"{folder}/docs")


def test_documents_are_tokenised_once(spark, tmp_path, monkeypatch):
    asked, docs = corpus(spark, str(tmp_path))
    scored = lambda df: sorted((r.question_id, r.db_id, r.table_idx, round(r.score, 12)) for r in df.collect())
    whole = scored(RT.bm25(asked, docs))
    monkeypatch.setattr(RT, "estimated_size_bytes", lambda df: 2**40 if "text" in df.columns else 1)
    by_vocabulary = RT.bm25(asked, docs)
    # the questions are read here; the documents' texts were counted and written before
    assert "text#" not in plan(by_vocabulary)
    assert scored(by_vocabulary) == whole and len(whole) == 6


def test_rankings_are_computed_once(spark, tmp_path):
    asked, docs = corpus(spark, str(tmp_path))
    docs = docs.dropDuplicates(["table_idx"])
    vec = F.array(F.col("table_idx").cast("double") + 1.0, F.lit(1.0))
    vectors = docs.where("table_idx <> 4").select("table_idx", vec.alias("vec"))
    q = asked.select("question_id", "db_id", F.array(F.lit(1.0), F.col("question_id").cast("double")).alias("qvec"))
    top = RT.rrf_top_k(RT.bm25(asked, docs), q, docs.select("db_id", "table_idx"), vectors, 2)
    assert plan(top).count("FlatMapCoGroupsInPandas") == 1  # the counts; the nearest vectors are written candidates
    best = {r.question_id: r.table_idx for r in top.where("rank = 1").collect()}
    assert best == {1: 6, 2: 11, 3: 11, 4: 9, 5: 0}
    ranked = top.select(F.sha2(F.lit("bm25"), 256).alias("retriever"), "question_id", "table_idx", "rank")
    curve = RT.recall_curve(ranked, top.select("question_id", "table_idx"), 2)
    ranked_again = plan(curve).count("FlatMapCoGroupsInPandas")
    assert ranked_again <= 2  # in the gold alone
    assert [r.found for r in curve.orderBy("k").collect()] == [5, top.count()]


def test_mentions_are_resolved_with_their_queries(spark, tmp_path):
    cat = [("d", "T", "a"), ("d", "T", "b"), ("d", "U", "a"), ("d", "U", "c"), ("e", "T", "z")]
    spark.createDataFrame(cat, "db_id string, tbl string, col string").write.parquet(str(tmp_path / "cat"))  # of known size
    cat = spark.read.parquet(str(tmp_path / "cat"))
    said = [(1, "d", "x", "t", "X", "A"), (1, "d", "y", "U", None, "a"), (1, "d", "y", "U", None, "c"),  # a has two owners here
            (2, "d", None, "T", "t", "B"), (2, "d", None, "T", None, "a"), (2, "d", "n", None, "n", "a"),
            (3, "d", "x", "no", "x", "a"), (3, "d", "x", "U", "x", "c"),  # x stands for both
            (4, "e", "q", "T", "q", "*"), (5, None, "q", "T", "q", "a"), (None, "d", "q", "T", "q", "a"), (6, "d", "q", "T", "q", None)]
    said = spark.createDataFrame(said, "query_id long, db_id string, alias string, tbl string, col_alias string, col string").repartition(8, "query_id")
    queries = spark.createDataFrame([(k, k == 6) for k in range(1, 8)], "query_id long, parse_failed boolean").repartition(8, "query_id")
    out = C.mention_records(queries, said, cat)
    assert not [x for x in exchanges(out) if "query_id," in x] and plan(out).count("Exchange hashpartitioning(query_id") == 6  # four of the queries, two of the mentions
    assert {r.query_id: r.schema_links for r in out.collect()} == {
        1: {"T": ["a"], "U": ["c"]}, 2: {"T": ["a", "b"]}, 3: {"U": ["a", "c"]}, 4: {"T": []}, 5: {}, 6: {}, 7: {}}
    links = C.resolve_mentions(said, cat).collect()
    assert sorted((r.tlc, r.clc) for r in links if r.query_id is None) == [("t", "")]
    assert sorted((r.query_id, r.tlc, r.clc) for r in links if r.query_id in (1, 6)) == [(1, "t", ""), (1, "t", "a"), (1, "u", ""), (1, "u", "c"), (6, "t", "")]


def test_a_schema_is_digested_once(spark, tmp_path):
    out = qc.q_prompt_context(spark, orders_and_parts(spark, str(tmp_path)))
    assert "md5(" not in plan(out)
    digest = lambda text: (1, len(text), hashlib.md5(text.encode()).hexdigest())
    one, two = digest("SMALL: red gear0, red gear2"), digest("SMALL: red gear1, red gear3")
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == {101: one, 102: two, 201: one, 202: two, 302: two}


def test_matches_are_added_up_as_arrays(spark, tmp_path):
    asked, docs = corpus(spark, str(tmp_path))
    odd = [(1, "d0", "bolt, red unknown"), (None, "d0", "gear"), (None, "d0", "gear"), (None, "d1", "hot"), (6, None, "gear"), (7, "d9", "gear"), (8, "d0", "")]
    asked = asked.unionByName(spark.createDataFrame(odd, asked.schema))
    docs = docs.unionByName(spark.createDataFrame([("d0", None, "old red gear"), (None, 3, "gear")], docs.schema))
    docs.write.parquet(str(tmp_path / "docs2"))  # of known size
    asked.write.parquet(str(tmp_path / "asked2"))
    asked, docs = (spark.read.parquet(str(tmp_path / x)) for x in ("asked2", "docs2"))
    scored = lambda df: sorted(((r.question_id, r.db_id, r.table_idx, round(r.score, 12)) for r in df.collect()), key=str)
    rows = scored(RT.bm25(asked, docs, as_arrays=True))
    assert rows == scored(RT.bm25(asked, docs)) and len(rows) == 11
    none = docs.where("false")
    none.write.parquet(str(tmp_path / "none"))
    assert RT.bm25(asked, spark.read.parquet(str(tmp_path / "none")), as_arrays=True).collect() == []


def test_pairs_are_not_grouped_match_by_match(spark, tmp_path):
    out = qc.q_bm25_pairs(spark, orders_and_parts(spark, str(tmp_path)))
    assert "sum(" not in plan(out) and "ArrowEvalPython" in plan(out)
    assert sorted((r.question_id, r.pair) for r in out.where("score > 0").collect()) == [
        (k * 100 + b, f"SMALL.red gear{i}") for k, b in ((1, 1), (1, 2), (2, 1), (2, 2), (3, 2)) for i in (b - 1, b + 1)]


def test_a_task_adds_up_few_questions_at_once(monkeypatch):
    monkeypatch.setattr(RT, "MATCHES", 3)
    index = ({("d", "a"): 0, ("d", "b"): 1}, np.array([0, 3, 5]), np.array([0, 1, 2, 1, 2], np.int32), np.array([1.0, 2.0, 3.0, 10.0, 20.0]))
    corpora, terms = ["d", "d", "e", None, "d", "d", "d"], [["a", "b", "a"], ["b", "x"], ["a"], ["a"], [], None, ["a"]]
    batches = [(pa.array(corpora), pa.array(terms)), (pa.array([], pa.string()), pa.array([], pa.list_(pa.string())))]
    parts = list(RT._add_up_batches(SimpleNamespace(value=index)).func(iter(batches)))
    assert [len(x) for x in parts] == [1, 5, 1]
    nothing = {"d": [], "score": []}
    assert [r for x in parts for r in x.to_pylist()] == [{"d": [0, 1, 2], "score": [2.0, 14.0, 26.0]}, {"d": [1, 2], "score": [10.0, 20.0]},
                                                         nothing, nothing, nothing, nothing, {"d": [0, 1, 2], "score": [1.0, 2.0, 3.0]}]


def test_rounding_is_that_of_spark(spark):
    some = random.Random(1)
    xs = [0.0, -0.0, 0.5, 1.0000005, -1.0000005, 2.4999995, 0.1234565, 1e-9, -1e-9, 5e-7, 1e6 + 0.3, 1e12 + 0.3, -1e15 - 0.3, 1e300, None,
          float("nan"), float("inf"), float("-inf"), *(some.uniform(-30, 30) for _ in range(2000)), *(round(some.uniform(0, 9), 7) for _ in range(2000))]
    out = spark.createDataFrame([(x,) for x in xs], "x double").select(rounded("x", 6).alias("a"), F.round("x", 6).alias("b")).collect()
    assert [repr(r.a) for r in out] == [repr(r.b) for r in out]
