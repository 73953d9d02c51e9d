"""Literal cases and brute force for ranked retrieval, containment, predictors, log records, searches, admission,
published versions, records and percentiles."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from linkspark.operators import contain, evaluate, predict, ranked, render, runs, vote
from linkspark.operators import curate as CU
from linkspark.operators import retrieve as RT
from linkspark.sources import links as L
from linkspark.sources import versions

WORDS = [f"w{i}" for i in range(60)]


def corpus(spark, n_docs, n_questions, seed):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    docs = [(f"c{rng.random() < 0.3:d}", i, " ".join(rng.choices(WORDS, weights, k=rng.randrange(0, 40)))) for i in range(n_docs)]
    docs += [("c0", n_docs + 1, None), ("c0", n_docs + 2, docs[0][2]), ("empty", 1, "")]
    asked = [(i, f"c{i % 2}", " ".join(rng.choices(WORDS, k=rng.randrange(0, 9)))) for i in range(n_questions)]
    asked += [(900, "nowhere", "w1 w2"), (901, "c0", None), (902, "c0", "w1 w1 w59"), (903, "empty", "w1")]
    return (spark.createDataFrame(docs, "db_id string, table_idx long, text string"),
            spark.createDataFrame(asked, "question_id long, db_id string, question string"))


@pytest.mark.parametrize("k,seed_postings", [(1, 20), (5, 60), (400, 50)])
def test_ranked_scores_find_the_same_best(spark, tmp_path, monkeypatch, k, seed_postings):
    monkeypatch.setattr(ranked, "SEED", seed_postings)
    monkeypatch.setattr(ranked, "BLOCK", 8)
    docs, questions = corpus(spark, 400, 25, k)
    index = ranked.build_index(docs, str(tmp_path / "index"))
    got = ranked.ranked_scores(questions, index, k, str(tmp_path / "run"))
    best = lambda s: sorted((r.question_id, r["rank"], r.table_idx, round(r.score, 6)) for r in RT.best_of(s, k).collect())
    everything = RT.bm25(questions, docs)
    want = best(everything)
    assert best(got) == want and len(want) > 15
    if k == 1:
        matches = index.forward.join(RT.question_terms(questions, "question_id", "db_id", "question"), ["corpus", "term"]).count()
        assert ranked.postings_read(str(tmp_path / "run"), index) < matches / 2


def test_index_of_a_vocabulary(spark, tmp_path):
    docs, _ = corpus(spark, 60, 3, 9)
    whole = ranked.build_index(docs, str(tmp_path / "a")).forward
    some = spark.createDataFrame([("c0", "w3"), ("c0", "w3"), ("c1", "none")], "corpus string, term string")
    part = ranked.build_index(docs, str(tmp_path / "b"), vocabulary=some).forward
    rows = lambda df: sorted((r.corpus, r.doc, r.term, round(r.impact, 9)) for r in df.collect())
    assert rows(part) == [r for r in rows(whole) if r[0] == "c0" and r[2] == "w3"] and rows(part)


COLS = [("d", 0, "Person", "birthDate"), ("d", 0, "Person", "birth_place name"), ("d", 0, "Person", "id"), ("d", 1, "City", "place name"),
        ("e", 0, "Person", "birthDate")]


def test_containment(spark):
    cols = spark.createDataFrame(COLS, "db_id string, table_idx long, tbl string, col string")
    index = contain.containment_index(cols)
    assert sorted((r.db_id, r.col, r.anchor) for r in index.collect()) == [
        ("d", "birthDate", "date"), ("d", "birth_place name", "birth"), ("d", "place name", "name"), ("e", "birthDate", "birth")]
    asked = spark.createDataFrame([(1, "d", ["birth", "place", "name"]), (2, "d", []), (3, "d", ["birth"]), (4, "e", ["date", "birth", "x"])],
                                  "question_id long, db_id string, asked array<string>")
    got = sorted((r.question_id, r.col) for r in contain.contained(asked, index, ["db_id"]).collect())
    assert got == [(1, "birth_place name"), (1, "place name"), (4, "birthDate")]


def test_expansion_keeps_predicted_links_and_adds_contained_columns(spark):
    links = "question_id long, tlc string, clc string, tbl string, col string"
    pred = spark.createDataFrame([(1, "person", "", "Person", None), (1, "person", "id", "Person", "id"), (1, "person", "birthdate", "Person", "birthDate"),
                                  (2, "city", "", "City", None), (3, "city", "", "City", None), (4, "person", "", "Person", None)], links)
    asked = spark.createDataFrame([(1, "d", "birth date, or the name of the birth place?"), (2, "d", ""), (4, "e", "the date of birth")],
                                  "question_id long, db_id string, question string")
    cols = spark.createDataFrame([(d, t.lower(), c.lower(), t, c) for d, _, t, c in COLS], "db_id string, tlc string, clc string, tbl string, col string")
    got = sorted((r.question_id, r.tbl, r.col or "") for r in CU.expand_columns(pred, asked, cols).collect())
    assert got == [(1, "Person", ""), (1, "Person", "birthDate"), (1, "Person", "birth_place name"), (1, "Person", "id"),
                   (2, "City", ""), (3, "City", ""), (4, "Person", ""), (4, "Person", "birthDate")]
    single = CU.expand_columns(pred.where("question_id = 4"), asked, cols, min_tokens=1)
    assert sorted(r.col or "" for r in single.collect()) == ["", "birthDate"]


def test_lexical_predictor_gives_one_row_per_question(spark):
    cols = spark.createDataFrame(COLS, "db_id string, table_idx long, tbl string, col string")
    q = spark.createDataFrame([(1, "d", "Which city has a place name?"), (2, "d", "person by birth date"), (3, "d", ""), (4, "f", "person"), (5, "d", None)],
                              "question_id long, db_id string, question string")
    got = {r.question_id: r.schema_links for r in predict.predict_lexical(q, cols, 1).collect()}
    assert got == {1: '{"City": ["place name"]}', 2: '{"Person": ["birthDate"]}', 3: "{}", 4: "{}", 5: "{}"}
    assert predict.predict(q.select("question_id")).count() == 5


HEAD = "2024-01-02 03:04:05,678 | exp | part | INFO | a.py:7 | "


def test_log_records_do_not_depend_on_splits(spark, tmp_path):
    rng = random.Random(3)
    lines, want = ["orphan one", "orphan two"], [("CONTINUATION", "orphan one\norphan two", 2)]
    for i in range(400):
        message = [f"message {i} | with bars", *(f"   at frame {j} {'x' * rng.randrange(90)}" for j in range(rng.choice([0, 0, 1, 2, 30])))]
        lines += [HEAD + message[0], *message[1:]]
        want.append(("INFO", "\n".join(message), len(message)))
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.log").write_text("\n".join(lines) + "\n")
    (tmp_path / "log" / "b.log").write_text(HEAD + "only\n\ntail\n")
    want += [("INFO", "only\n\ntail", 3)]
    size = sum(len(line) + 1 for line in lines)
    conf = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for splits in (1, 16, 200):
        conf["spark.sql.files.maxPartitionBytes"] = str(size // splits + 1)
        before = {c: spark.conf.get(c, None) for c in conf}
        try:
            for c, v in conf.items():
                spark.conf.set(c, v)
            records = runs.read_log_records(spark, str(tmp_path / "log"))
            got = sorted((r.level, r.message, r.n_lines) for r in records.collect())
            stamps = {str(r.ts) for r in records.where("level = 'INFO'").collect()}
        finally:
            for c, v in before.items():
                spark.conf.unset(c) if v is None else spark.conf.set(c, v)
        assert got == sorted(want) and stamps == {"2024-01-02 03:04:05.678000"}


def test_run_status(spark):
    m = spark.createDataFrame([("e", 1, 10), ("e", 1, 50), ("e", 2, 40), ("e", 3, 1)], "experiment string, run long, step long")
    t = spark.createDataFrame([("e", 1, 50), ("e", 2, 50), ("e", 4, 9)], "experiment string, run long, target long")
    got = sorted((r.run, r.reached, r.status) for r in runs.run_status(m, t).collect())
    assert got == [(1, 50, "completed"), (2, 40, "partial"), (3, 1, "unknown"), (4, 0, "partial")]


def test_search_cells_against_sets(spark):
    rng = random.Random(4)
    voters, names = list(range(1, 13)), [("t1", ""), ("t1", "x"), ("t1", "y"), ("t2", ""), ("t2", "z")]
    votes = {(q, v): {n for n in names if rng.random() < 0.4} for q in range(12) for v in voters}
    gold = {q: {n for n in names if rng.random() < 0.5} for q in range(12)}
    schema = "question_id long, voter int, tlc string, clc string, tbl string, col string"
    canon = spark.createDataFrame([(q, v, t, c, t, c) for (q, v), ns in votes.items() for t, c in ns], schema)
    golds = spark.createDataFrame([(q, t, c) for q, ns in gold.items() for t, c in ns], "question_id long, tlc string, clc string")
    ids = spark.createDataFrame([(q,) for q in range(12)], "question_id long")
    combos = [(3, 1, 12), (1, 2), tuple(voters), (5, 4, 3, 2, 1)]

    def prf(p, g):
        tp = len(p & g)
        pr = tp / len(p) if p else float(not g)
        re = tp / len(g) if g else 1.0
        return pr + re + (2 * pr * re / (pr + re) if pr + re else 0.0)

    want = {}
    for c in combos:
        for mode in vote.MODES:
            scores = []
            for level in (True, False):
                total = 0.0
                for q in range(12):
                    n = {x: sum(x in votes[q, v] for v in c) for x in names}
                    kept = {x for x in names if (x[1] == "") == level and (n[x] >= (1 if mode == "union" else 2)
                                                                            or (mode == "maj2_or_lead" and x in votes[q, c[0]]))}
                    total += prf(kept, {x for x in gold[q] if (x[1] == "") == level})
                scores.append(total / 12 / 3)
            want["+".join(map(str, c)), mode] = round(0.5 * sum(scores), 6)
    got = {(r.combo, r["mode"]): r.leaderboard for r in vote.ensemble_search(canon, golds, combos, ids).collect()}
    assert got == pytest.approx(want)


def one_pass(cands, existing, n):
    seen, out, kept = set(existing), {}, {}
    for db, pos, q, sql, bad, tables in sorted(cands):
        norm = q.strip().lower()
        if kept.get(db, 0) >= n:
            out[pos] = "over_limit"
        elif not norm or not sql.strip():
            out[pos] = "empty_question_or_sql"
        elif norm in seen:
            out[pos] = "duplicate_question"
        elif bad:
            out[pos] = "parse_error"
        elif tables <= 0:
            out[pos] = "zero_recognized_tables"
        else:
            out[pos], kept[db] = "ok", kept.get(db, 0) + 1
            seen.add(norm)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_admission_is_that_of_one_pass(spark, tmp_path, seed):
    rng = random.Random(seed)
    cands = [(f"db{rng.randrange(5)}", i, rng.choice([" Q%d " % rng.randrange(9), "q%d" % rng.randrange(9), "", " "]), rng.choice(["s", "s", "s", " "]),
              rng.random() < 0.1, rng.choice([1, 1, 1, 0])) for i in range(120)]
    schema = "db_id string, pos long, question string, gold_sql string, parse_failed boolean, n_tables int"
    existing = spark.createDataFrame([("Q3 ",)], "question string")
    got = CU.sequential_admission(spark.createDataFrame(cands, schema), existing, 2, str(tmp_path))
    assert {r.pos: r.status for r in got.collect()} == one_pass(cands, {"q3"}, 2)


def test_published_versions(spark, tmp_path):
    path, schema = str(tmp_path / "out"), "k long"
    assert versions.read_version(spark, path, schema).collect() == []
    assert versions.publish(spark.range(3).toDF("k"), path) == 1
    with pytest.raises(Exception):  # a writer that fails half-way leaves the last version
        versions.publish(spark.range(50).select(F.when(F.col("id") > 40, F.raise_error(F.lit("torn"))).otherwise(F.col("id")).alias("k")), path)
    assert versions.read_version(spark, path, schema).count() == 3
    assert versions.publish(spark.range(5).toDF("k"), path, base=1) == 2
    with pytest.raises(versions.VersionConflict):  # started from version 1 as well
        versions.publish(spark.range(9).toDF("k"), path, base=1)
    assert versions.read_version(spark, path, schema).count() == 5 and versions.latest_version(spark, path)[0] == 2


def test_files_of_several_datasets(spark, tmp_path):
    for name, links in (("one", {"A": ["x"], "B": []}), ("two", {"A": "x", "C": [None]})):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"question_id": 1, "schema_links": links}]))
    rows = L.read_link_file(spark, str(tmp_path / "*.json"), json_list=True, keys=("dataset", "question_id"))
    got = sorted((r.dataset, r.question_id, r.tlc, r.clc) for r in L.normal_form(rows, ("dataset", "question_id")).collect())
    assert got == [("one", 1, "a", ""), ("one", 1, "a", "x"), ("one", 1, "b", ""), ("two", 1, "a", ""), ("two", 1, "c", "")]


def test_last_record_wins(spark):
    r = spark.createDataFrame([(1, 0, "a"), (1, 2, None), (1, 1, "b"), (2, 5, "c")], "question_id long, line long, links string")
    got = sorted(map(tuple, evaluate.last_wins(r, ["line"]).collect()))
    assert got == [(1, 2, None, 2), (2, 5, "c", 0)]


def test_records_with_a_rationale(spark):
    df = spark.createDataFrame([(" because \n", "{}"), ("", "{}"), (None, "{}")], "r string, t string")
    assert [x[0] for x in df.select(render.reasoned(F.col("r"), F.col("t"))).collect()] == ["because\n{}", None, None]
    one = spark.createDataFrame([(["A b", 'q"'],)], "x array<string>").select(render.named_list("tables", F.col("x"))).first()[0]
    assert json.loads(one) == {"tables": ["A b", 'q"']} and one == '{"tables": ["A b","q\\""]}'


def test_percentiles(spark):
    rng = random.Random(5)
    rows = [(f"d{i % 3}", rng.randrange(1000)) for i in range(997)]
    got = {r.g: r for r in CU.length_percentiles(spark.createDataFrame(rows, "g string, n long"), "g", (0.5, 0.99)).collect()}
    for g in ("d0", "d1", "d2", "*"):
        ns = sorted(n for d, n in rows if g in (d, "*"))
        assert (got[g].n_examples, got[g].max_chars) == (len(ns), ns[-1])
        assert [got[g].p50_chars, got[g].p99_chars] == [ns[math.ceil(q * len(ns)) - 1] for q in (0.5, 0.99)]


def test_recall_curve(spark):
    ranks = spark.createDataFrame([("a", 1, 10, 1), ("a", 1, 11, 3), ("a", 2, 20, 2), ("b", 1, 99, 1)], "retriever string, question_id long, table_idx long, rank int")
    gold = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (2, 21)], "question_id long, table_idx long")
    got = sorted((r.retriever, r.k, r.recall) for r in RT.recall_curve(ranks, gold, 3).collect())
    assert got == [("a", 1, 0.25), ("a", 2, 0.5), ("a", 3, 0.75), ("b", 1, 0.0), ("b", 2, 0.0), ("b", 3, 0.0)]


def test_the_last_listed_key_is_rendered(spark):
    from linkspark.sources.catalog import normalize_catalog

    docs = spark.createDataFrame([("d", ["Z", "A"], [["-1", "*"], ["0", "x"], ["0", "y"], ["1", "k"]], ["INT", None, "text"], ["0"], [[0, 2], [1, 1], [0, 1], [7, 0], [2]])],
                                 "db_id string, table_names_original array<string>, column_names_original array<array<string>>, "
                                 "column_types array<string>, primary_keys array<string>, foreign_keys array<array<int>>")
    cols, fks = normalize_catalog(docs)
    assert sorted((r.tbl, r.col, r.data_type, r.is_pk) for r in cols.collect()) == [("A", "k", "TEXT", False), ("Z", "x", "INT", True), ("Z", "y", "TEXT", False)]
    got = render.table_lines(render.with_fk_targets(cols, fks), "keys").collect()
    assert sorted(r.line for r in got) == ["A: k", "Z: x*->Z.y, y->Z.y"]
