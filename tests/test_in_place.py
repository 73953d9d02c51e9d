"""Operators on rows that are partitioned by question exchange nothing more; percentiles from counts; packed records."""

import glob
import re

from pyspark.sql import functions as F

from linkspark.operators import canon as C
from linkspark.operators import evaluate as E
from linkspark.operators import render as RD
from linkspark.operators import retrieve as RT
from linkspark.operators import vote as V
from linkspark.operators.curate import length_percentiles
from linkspark.sources.records import read_jsonl, write_jsonl


def exchanges(df):
    """The columns of each exchange by hash in the plan of ``df``."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)]


def wide(spark, path):
    words = ["red gear", "hot bolt", "old gear", "red red"]
    rows = [(i, f"d{i % 2}", words[i % 4]) for i in range(40)]
    # a join makes its size an estimate, as in the queries
    asked = spark.createDataFrame(rows, "question_id long, db_id string, question string")
    asked = asked.join(spark.range(40).hint("merge"), F.col("question_id") == F.col("id")).drop("id").repartition(4, "question_id")
    docs = spark.createDataFrame([("d0", 0, "red gear x"), ("d0", 1, "bolt"), ("d1", 0, "hot"), ("d1", 1, "old gear")],
                                 "db_id string, table_idx int, text string")
    docs.write.parquet(path)  # of known size
    return asked, spark.read.parquet(path)


def test_bm25_and_contexts_stay_with_their_questions(spark, tmp_path):
    asked, docs = wide(spark, str(tmp_path / "docs"))
    scores = RT.bm25(asked, docs)
    top = RT.top_k_with_fill(scores, asked, docs, 2)
    lines = docs.select("db_id", "table_idx", F.col("text").alias("line"))
    ctx = RD.context_for_questions(top.select("question_id", "db_id", "table_idx"), lines)
    assert [x for x in exchanges(ctx) if "question_id" in x and "," in x or x.startswith("qid")] == []
    got = {r.question_id: (r.n_tables, r.context) for r in ctx.collect()}
    assert len(got) == 40 and got[0] == (2, "red gear x\nbolt") and got[3] == (2, "hot\nold gear")


def test_votes_and_scores_stay_with_their_questions(spark, tmp_path):
    cat = spark.createDataFrame([("d", "T", "a"), ("d", "T", "b")], "db_id string, tbl string, col string")
    cat.write.parquet(str(tmp_path / "cat"))  # of known size
    cat = spark.read.parquet(str(tmp_path / "cat"))
    votes = spark.createDataFrame([(1, "d", 1, "t", "A"), (1, "d", 2, "T", "a"), (1, "d", 2, "T", "b"), (2, "d", 1, "no", "a"), (None, "d", 1, "T", "a")],
                                  "question_id long, db_id string, voter int, tbl string, col string").repartition(4, "question_id")
    gold = spark.createDataFrame([(1, "d", "T", "a"), (1, "d", "T", "b"), (3, "d", "T", None), (None, "d", "T", "a")],
                                 "question_id long, db_id string, tbl string, col string").repartition(4, "question_id")
    canon = C.canonicalize(votes, cat, ["question_id", "voter"], exchange=False)
    links = C.canonicalize(gold, cat, exchange=False)
    scores = E.per_question_scores(V.ensemble(canon, "union", lead_voter=1), links)
    assert set(exchanges(scores)) <= {"question_id", "db_id, tlc", "db_id, tlc, clc", "db_id, lower(tbl)", "db_id, _groupingexpression",
                                      "db_id, _groupingexpression, _groupingexpression"}
    got = {r.question_id: r for r in scores.collect()}
    assert set(got) == {1, 3, None}
    assert (got[1].p_c, got[1].r_c, got[3].missing_prediction, got[3].r_t) == (1.0, 1.0, True, 0.0)
    # a null id matches nothing, as in a join
    assert (got[None].missing_prediction, got[None].f1_t) == (True, 1.0)


def test_recall_counts_repeated_gold_and_no_null_ids(spark):
    ranked = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (None, 7, 1)], "question_id long, table_idx int, rank int").repartition(2, "question_id")
    gold = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (None, 7)], "question_id long, table_idx int").repartition(2, "question_id")
    out = RT.recall_at_k(ranked, gold, [1, 2])
    assert set(exchanges(out)) <= {"question_id"}
    assert tuple(out.first()) == (0.5, 0.75, 4)
    assert tuple(RT.recall_at_k(ranked, gold.where("false"), [1]).first()) == (None, 0)


def test_percentiles_come_from_counts(spark):
    rows = [("a", n) for n in range(1, 101)] + [("b", 7), ("b", None), (None, 3)]
    out = length_percentiles(spark.createDataFrame(rows, "db_id string, n long"), "db_id", (0.5, 0.99))
    # no group keeps all its lengths in one buffer
    assert "percentile" not in out._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.db_id, r.n_examples, r.max_chars, r.p50_chars, r.p99_chars) for r in out.collect())
    assert got == [("*", 1, 3, 3, 3), ("*", 103, 100, 49, 99), ("a", 100, 100, 50, 99), ("b", 2, 7, 7, 7)]


def test_packed_records(spark, tmp_path):
    path = str(tmp_path / "r")
    write_jsonl(spark.range(3).selectExpr("id", "repeat('x', 1000) AS text"), path, "gzip")
    assert glob.glob(f"{path}/*.json.gz")
    assert sorted((r.id, len(r.text)) for r in read_jsonl(spark, path, "id long, text string").collect()) == [(0, 1000), (1, 1000), (2, 1000)]


def test_sizes_are_known(spark):
    from linkspark.plans.joins import estimated_size_bytes
    assert estimated_size_bytes(spark.range(10)) > 0
