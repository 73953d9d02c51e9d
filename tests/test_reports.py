"""Literal cases: recovery by pieces of text, evaluation reports, records of parsed queries, nested run files."""

import json
import random
import time

from pyspark.sql import functions as F

from linkspark.functions import recover as RC
from linkspark.operators import canon as C
from linkspark.operators import evaluate as E
from linkspark.operators import runs as RU


def first_object(text):
    """The scan written out character by character."""
    depth, start, inside, escaped = 0, -1, False, False
    for i, ch in enumerate(text):
        if inside:
            if escaped:
                escaped = False
            elif ch == "\\":
                escaped = True
            elif ch == '"':
                inside = False
        elif ch == '"':
            inside = True
        elif ch == "{":
            start = i if depth == 0 else start
            depth += 1
        elif ch == "}":
            depth -= 1
            if depth == 0 and start >= 0:
                try:
                    found = json.loads(text[start:i + 1])
                    if len(found) == len(json.loads(text[start:i + 1], object_pairs_hook=list)):
                        return found
                except ValueError:
                    pass
                start = -1
    return None


def test_scan_by_pieces_equals_scan_by_characters(spark):
    rng = random.Random(3)
    parts = ["{", "}", '"', "\\", "a", '{"k": 1}', '{"t": ["}"]}', '"x\\"y"', "\n", " ", "{}", "é😀", '{"a": {"b": []}}', "{bad}", "```", ":"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 12))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.j for r in rows.select("i", F.to_json(RC.scanned_object(F.col("t"))).alias("j")).collect()}
    for i, t in enumerate(texts):
        want = first_object(t)
        assert (None if got[i] is None else json.loads(got[i])) == want, t


def test_scan_of_a_long_text(spark):
    answer = '{"t": ["c"]}'
    texts = ["{x} " * 100_000 + answer, '"' + "a\\n" * 100_000 + '" ' + answer, "word " * 100_000 + answer, "{" * 100_000, answer + " }" * 100_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(5)
    begun = time.time()
    got = {r.i: r.j for r in rows.select("i", F.to_json(RC.recover_object(F.col("t"))).alias("j")).collect()}
    assert [got[i] for i in range(5)] == ['{"t":["c"]}'] * 3 + [None, '{"t":["c"]}']
    assert time.time() - begun < 60


def test_report_counts_every_question_once(spark):
    asked = spark.createDataFrame([(1, "a", "d1"), (2, "a", "d1"), (3, "a", "gone"), (4, "a", "d1"), (5, "a", None)], "question_id int, dataset string, db_id string")
    catalog = spark.createDataFrame([("d1", "t", "c")], "db_id string, tbl string, col string")
    gold_ids = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (5, "a")], "question_id int, dataset string")
    predicted = spark.createDataFrame([(1, "a"), (3, "a"), (9, "a")], "question_id int, dataset string")
    links = "question_id int, dataset string, tlc string, clc string"
    gold = spark.createDataFrame([(1, "a", "t", ""), (2, "a", "t", ""), (3, "a", "t", "")], links)
    pred = spark.createDataFrame([(1, "a", "t", ""), (3, "a", "t", ""), (9, "a", "t", "")], links)
    status = E.question_status(asked, catalog, gold_ids, predicted, ["question_id", "dataset"])
    assert {r.question_id: (r.status, r.missing_prediction) for r in status.collect()} == {
        1: ("scored", False), 2: ("scored", True), 3: ("missing_schema", False), 4: ("missing_gold", False), 5: ("missing_schema", False)}
    r = E.evaluation_report(pred, gold, status, predicted).first()
    assert (r.n_questions, r.n_scored, r.n_missing_gold, r.n_missing_schema, r.n_missing_prediction, r.n_extra) == (5, 2, 1, 2, 1, 1)
    assert r.p_t == 0.5 and r.p_c == 1.0 and abs(r.leaderboard - 0.75) < 1e-12


def test_records_of_queries_that_did_not_parse(spark):
    queries = spark.createDataFrame([(1, False), (2, True), (3, None), (4, False), (4, True)], "query_id int, parse_failed boolean")
    m = "query_id int, db_id string, alias string, tbl string, col_alias string, col string"
    mentions = spark.createDataFrame([(1, "d", "x", "T", "X", "C"), (2, "d", None, "T", None, "c"), (4, "d", None, "T", None, "c")], m)
    catalog = spark.createDataFrame([("d", "t", "c")], "db_id string, tbl string, col string")
    got = {r.query_id: (r.parse_failed, r.schema_links) for r in C.mention_records(queries, mentions, catalog).collect()}
    assert got == {1: (False, {"t": ["c"]}), 2: (True, {}), 3: (False, {}), 4: (True, {})}


def test_nested_run_files(spark, tmp_path):
    runs = [{"run_name": "1", "status": "RUNNING", "start_time_ms": 5, "end_time_ms": None, "config": {"r": "16", "lr": "0.1"},
             "final_metrics": {"loss": {"value": 0.5, "step": 7}}}, {"run_name": "2", "config": {}, "final_metrics": {}}]
    for name, obj in (("a", {"experiment_name": "x", "mlflow_experiment_id": 8, "num_runs": 2, "runs": runs}), ("b", {"experiment_name": "y", "num_runs": 0, "runs": []})):
        (tmp_path / f"{name}.json").write_text(json.dumps(obj, indent=2))
    read = RU.read_run_files(spark, str(tmp_path))
    assert {(r.experiment, r.run, r.status) for r in read.collect()} == {("x", "1", "RUNNING"), ("x", "2", None)}
    assert {tuple(r) for r in RU.run_settings(read).collect()} == {("x", "1", "RUNNING", "r", "16"), ("x", "1", "RUNNING", "lr", "0.1")}
    assert [tuple(r) for r in RU.flatten_runs(read).collect()] == [("x", "1", "loss", 0.5, 7)]
    RU.write_run_files(read, str(tmp_path / "again"))
    again = RU.read_run_files(spark, str(tmp_path / "again"), one_to_a_line=True)
    assert sorted(map(str, again.collect())) == sorted(map(str, read.collect()))
