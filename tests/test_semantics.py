"""Literal cases for the rules that the oracles share with the Spark code."""

import json

from pyspark.sql import functions as F

from linkspark.operators import canon as C
from linkspark.operators import curate as CU
from linkspark.operators import evaluate as E
from linkspark.operators import render as RD
from linkspark.operators import retrieve as RT
from linkspark.operators import vote as V

TWO = [("db1", "INJURY", "AIS"), ("db2", "Orders", "id"), ("db2", "injury", "ais")]
LINK = "question_id long, db_id string, tbl string, col string"
NORMAL = "question_id long, tlc string, clc string, tbl string, col string"


def _two(spark):
    return spark.createDataFrame(TWO, "db_id string, tbl string, col string")


def test_lookup_stays_in_the_question_database(spark):
    links = spark.createDataFrame([(1, "db1", "Orders", "id"), (1, "db1", "Injury", "Ais"), (2, "db2", "INJURY", None)], LINK)
    got = sorted((r.question_id, r.tbl, r.col or "") for r in C.canonicalize(links, _two(spark)).collect())
    assert got == [(1, "INJURY", ""), (1, "INJURY", "AIS"), (2, "injury", "")]
    graded = C.graded_links(links, _two(spark))
    assert C.hallucination_tally(graded).first().bad_tables == 1
    merged = C.two_stage_merge(links, links, _two(spark))
    assert sorted((r.question_id, r.tbl) for r in merged.where("clc = ''").collect()) == [(1, "INJURY"), (2, "injury")]
    forced = RT.force_include(spark.createDataFrame([], NORMAL), links, C.catalog_tables(_two(spark)))
    assert sorted(map(tuple, forced.collect())) == [(1, "injury"), (2, "injury")]


def test_mentions_by_the_table_s_own_name(spark):
    m = spark.createDataFrame([(1, "db2", None, "Orders", "orders", "ID"), (1, "db2", "t", "injury", None, "ais"),
                               (2, "db1", None, "Orders", "orders", "id")],
                              "query_id long, db_id string, alias string, tbl string, col_alias string, col string")
    got = sorted((r.query_id, r.tbl, r.col or "") for r in C.resolve_mentions(m, _two(spark)).collect())
    assert got == [(1, "Orders", ""), (1, "Orders", "id"), (1, "injury", ""), (1, "injury", "ais")]


def test_lead_is_the_lowest_rank(spark):
    canon = spark.createDataFrame([(1, "b", "a", "", "A", None), (1, "c", "z", "", "Z", None)],
                                  "question_id long, voter string, tlc string, clc string, tbl string, col string")
    assert [r.tbl for r in V.ensemble(canon, "maj2_or_lead").collect()] == ["A"]
    assert [r.tbl for r in V.ensemble(canon, "maj2_or_lead", lead_voter="c").collect()] == ["Z"]


def test_empty_gold_is_scored_and_missing_means_no_record(spark):
    pred = spark.createDataFrame([(1, "a", "", "A", None)], NORMAL)
    gold = spark.createDataFrame([(3, "a", "", "A", None)], NORMAL)
    ids = spark.createDataFrame([(1,), (2,), (3,)], "question_id long")
    given = spark.createDataFrame([(1,), (2,)], "question_id long")
    got = {r.question_id: (r.p_t, r.r_t, r.f1_t, r.missing_prediction)
           for r in E.per_question_scores(pred, gold, ids, predicted=given).collect()}
    assert got == {1: (0.0, 1.0, 0.0, False), 2: (1.0, 1.0, 1.0, False), 3: (0.0, 0.0, 0.0, True)}


def test_search_has_every_cell(spark):
    canon = spark.createDataFrame([(1, 1, "a", ""), (1, 2, "b", ""), (1, 3, "a", "")], "question_id long, voter int, tlc string, clc string")
    gold = spark.createDataFrame([(1, "a", "")], "question_id long, tlc string, clc string")
    got = {(r.combo, r["mode"]): r.table_score for r in V.ensemble_search(canon, gold, [(2, 1), (1, 3)]).collect()}
    assert got == {("2+1", "union"): round((0.5 + 1 + 2 / 3) / 3, 6), ("2+1", "maj2"): 0.0, ("2+1", "maj2_or_lead"): 0.0,
                   ("1+3", "union"): 1.0, ("1+3", "maj2"): 1.0, ("1+3", "maj2_or_lead"): 1.0}


def test_one_record_per_question(spark):
    links = spark.createDataFrame([(1, "a", "", "A", None)], NORMAL)
    ids = spark.createDataFrame([(1,), (2,)], "question_id long")
    assert {r.question_id: r.schema_links for r in V.pack_links(links, questions=ids).collect()} == {1: {"A": []}, 2: {}}


def test_target_equals_json_dumps(spark):
    names = ["t\u00e9", "a\tb", 'q"\\', "\U0001f600", "\x7f\x01", "plain"]
    links = spark.createDataFrame([(i, n.lower(), "", n, None) for i, n in enumerate(names)], NORMAL)
    got = {r.question_id: r.target for r in RD.canonical_target(links).collect()}
    assert got == {i: json.dumps({n: []}, separators=(",", ": ")) for i, n in enumerate(names)}


def test_limit_keeps_the_rest_in_the_audit(spark):
    audit = spark.createDataFrame([("a", i, "ok") for i in range(4)] + [("b", 9, "ok")], "db_id string, pos long, status string")
    assert CU.cap_per_group(audit).collect() == audit.collect()
    got = {r.status: r.n for r in CU.status_histogram(CU.cap_per_group(audit, 2)).collect()}
    assert got == {"ok": 3, "over_limit": 2}


def test_ids_run_on_over_ranges(spark):
    kept = spark.createDataFrame([(p,) for p in (3, 7, 8, 21, 40, 41)], "pos long")
    ids = CU.assign_ids(kept, spark.createDataFrame([(10,)], "question_id long"), gap=5, width=8)
    assert {r.pos: r.question_id for r in ids.collect()} == {3: 15, 7: 16, 8: 17, 21: 18, 40: 19, 41: 20}
    none = CU.assign_ids(kept, spark.createDataFrame([], "question_id long"), gap=0, width=8)
    assert sorted(r.question_id for r in none.collect()) == list(range(6))


def test_group_without_examples_is_served_by_its_family(spark):
    ex = spark.createDataFrame([("s1", "s", 1), ("s1", "s", 2)], "db_id string, family string, pos long")
    targets = spark.createDataFrame([("s1", "s"), ("s2", "s"), ("x1", "x")], "db_id string, family string")
    got = CU.fewshot_sample(ex, 1, targets=targets).collect()
    assert sorted(r.db_id for r in got) == ["s1", "s2"]
