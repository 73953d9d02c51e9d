"""Small literal cases (the project's fixture tables, section 2)."""

import json

from pyspark.sql import functions as F

from linkspark.functions.recover import object_links, recover_object
from linkspark.functions.text import tokenize
from linkspark.operators import canon as C
from linkspark.operators import evaluate as E
from linkspark.operators import retrieve as RT
from linkspark.operators import vote as V
from linkspark.sources import catalog as CAT

CATALOG = [("INJURY", "AIS"), ("INJURY", "REGION"), ("INJURY", "AGE"), ("TIRE", "CASEID"), ("TIRE", "PSI")]


def _cat(spark):
    return spark.createDataFrame([("db1", *c) for c in CATALOG], "db_id string, tbl string, col string")


def _links(spark, d):
    rows = []
    for t, cols in d.items():
        if isinstance(cols, list):
            rows += [(1, "db1", t, None)] + [(1, "db1", t, c) for c in cols]
        else:
            rows.append((1, "db1", t, None))
    return spark.createDataFrame(rows, "question_id long, db_id string, tbl string, col string")


def _as_map(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["tbl"], set())
        if r["col"] is not None:
            out[r["tbl"]].add(r["col"])
    return {k: sorted(v) for k, v in out.items()}


def test_canonicalize_cases(spark):
    cases = [
        ({"INJURY": []}, {"INJURY": []}),
        ({"INJURY": ["AIS", "REGION", "TOTALLY_FAKE_COL"], "TableThatDoesNotExist": ["x", "y"], "TIRE": ["CASEID"]},
         {"INJURY": ["AIS", "REGION"], "TIRE": ["CASEID"]}),
        ({"injury": ["ais", "region"]}, {"INJURY": ["AIS", "REGION"]}),
        ({"injury": ["ais"], "INJURY": ["region"]}, {"INJURY": ["AIS", "REGION"]}),
        ({"INJURY": "AIS"}, {"INJURY": []}),
    ]
    for given, expected in cases:
        out = C.canonicalize(_links(spark, given), _cat(spark))
        assert _as_map(out) == expected, given


def test_canonicalize_idempotent(spark):
    once = C.canonicalize(_links(spark, {"injury": ["ais", "nope"], "tire": []}), _cat(spark))
    twice = C.canonicalize(once.select("question_id", F.lit("db1").alias("db_id"), "tbl", "col"), _cat(spark))
    assert sorted(map(tuple, once.select("tlc", "clc").collect())) == sorted(map(tuple, twice.select("tlc", "clc").collect()))


def _prf_row(spark, pred, gold):
    p = spark.createDataFrame([(1, t, "") for t in pred] or [], "question_id long, tlc string, clc string")
    g = spark.createDataFrame([(1, t, "") for t in gold] or [], "question_id long, tlc string, clc string")
    c = E.set_counts(p, g).collect()
    if not c:
        return None
    r = c[0]
    pr, rc, f1 = E.prf(F.lit(r.tp_t), F.lit(r.n_pred_t), F.lit(r.n_gold_t))
    return tuple(round(x, 6) for x in spark.range(1).select(pr, rc, f1).first())


def test_prf_boundaries(spark):
    assert _prf_row(spark, [], ["a"]) == (0.0, 0.0, 0.0)
    assert _prf_row(spark, ["a"], []) == (0.0, 1.0, 0.0)
    assert _prf_row(spark, ["a", "b"], ["b", "c"]) == (0.5, 0.5, 0.5)
    assert _prf_row(spark, ["a"], ["b"]) == (0.0, 0.0, 0.0)
    # pred and gold both empty: (1, 1, 1)
    one = spark.range(1).select(*E.prf(F.lit(0), F.lit(0), F.lit(0))).first()
    assert tuple(one) == (1.0, 1.0, 1.0)


def test_graded_variant(spark):
    links = spark.createDataFrame([(1, "db1", "Fake", "x"), (1, "db1", "Fake", "x"), (1, "db1", "INJURY", "nope")],
                                  "question_id long, db_id string, tbl string, col string")
    g = C.graded_links(links, _cat(spark))
    tally = C.hallucination_tally(g).first()
    assert (tally.bad_tables, tally.bad_columns) == (1, 3)
    n = C.graded_normal_form(g)
    assert sorted(r.tbl for r in n.where("clc = ''").collect()) == ["INJURY", "__hallu__:fake"]
    assert n.where("clc <> ''").count() == 2


def test_votes(spark):
    rows = [(1, 1, "A", None), (1, 1, "A", "x"), (1, 1, "A", "y"), (1, 1, "B", None),
            (1, 2, "a", None), (1, 2, "a", "X"),
            (1, 3, "C", None), (1, 3, "C", "z"), (1, 3, "B", None), (1, 3, "B", "w")]
    links = spark.createDataFrame(rows, "question_id long, voter int, tbl string, col string").withColumn("db_id", F.lit("d"))
    cat = spark.createDataFrame([("d", "A", "x"), ("d", "A", "y"), ("d", "B", "w"), ("d", "C", "z")],
                                "db_id string, tbl string, col string")
    canon = C.canonicalize(links, cat, keys=["question_id", "voter"], partition_keys=["question_id"])
    res = {m: _as_map(V.ensemble(canon, m)) for m in V.MODES}
    assert res["union"] == {"A": ["x", "y"], "B": ["w"], "C": ["z"]}
    assert res["maj2"] == {"A": ["x"], "B": []}
    assert res["maj2_or_lead"] == {"A": ["x", "y"], "B": []}


def test_tokenizer(spark):
    df = spark.createDataFrame([("tblFieldData_UTMX",), ("GPSDatum2",), ("été ABCName x-y",)], "s string")
    got = [r[0] for r in df.select(tokenize("s")).collect()]
    assert got == [["tbl", "field", "data", "utmx"], ["gps", "datum2"], ["été", "abc", "name", "x", "y"]]


def test_model_output_recovery(spark):
    cases = [
        ('{"A": ["x"]}', {"A": ["x"]}),
        ('```json\n{"A":["x"]}\n```', {"A": ["x"]}),
        ('Sure! Here you go:\n{"A":["x"]}', {"A": ["x"]}),
        ('{"A":["x"]}<|im_end|>', {"A": ["x"]}),
        ('x {bad} y {"A":["}"]} z {"B":[]}', {"A": ["}"]}),
        ('} {"A":[]}', {}),
        ('{"A":["x"],"B":["b"],"A":["y"]}', {"A": ["y"], "B": ["b"]}),
        ('{"A":["x"],"A":null,"B":NaN,"C":["c"]}', {"A": [], "B": [], "C": ["c"]}),
        ('so {"A":Infinity,"A":["x"],"a":["z"]} {"B":[]}', {"A": ["x"], "a": ["z"]}),
        ('{"A":{"k":1,"k":2}}', {}),  # repeated in a nested object
        ("{'A':['x']}", {}),
        ("nope", {}),
        ("[1,2]", {}),
        (None, {}),
    ]
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(cases)], "i int, raw string")
    out = df.select("i", F.explode_outer(object_links(recover_object(F.col("raw")))).alias("l")).collect()
    got = {}
    for r in out:
        d = got.setdefault(r.i, {})
        if r.l is not None:
            d.setdefault(r.l.tbl, [])
            if r.l.col is not None:
                d[r.l.tbl].append(r.l.col)
    for i, (_, expected) in enumerate(cases):
        assert got.get(i, {}) == expected, cases[i]


def test_rrf_arithmetic():
    assert abs((1 / (RT.RRF_K + 0) + 1 / (RT.RRF_K + 2)) - (1 / 60 + 1 / 62)) < 1e-15


def test_key_resolution(spark, tmp_path):
    doc = {"db_id": "k", "table_names_original": ["ev", "lo"],
           "column_names_original": [[-1, "*"], [0, "id"], [0, "lo_id"], [1, "id"]],
           "column_types": ["int", "int", "text"], "primary_keys": [0, 2], "foreign_keys": [[1, 2]]}
    p = tmp_path / "k.json"
    p.write_text(json.dumps(doc, indent=2))
    docs = CAT.read_spider(spark, str(p))
    cols, fks = CAT.normalize_catalog(docs)
    got = sorted((r.tbl, r.col, r.data_type, r.is_pk) for r in cols.collect())
    assert got == [("ev", "id", "INT", True), ("ev", "lo_id", "INT", False), ("lo", "id", "TEXT", True)]
    assert [tuple(r) for r in fks.select("from_table", "from_column", "to_table", "to_column").collect()] == \
        [("ev", "lo_id", "lo", "id")]
    ccols, cfks = CAT.normalize_catalog(docs, compat=True)
    got_c = sorted((r.tbl, r.col, r.data_type, r.is_pk) for r in ccols.collect())
    assert got_c == [("ev", "id", "INT", False), ("ev", "lo_id", "TEXT", True)]
    assert [tuple(r) for r in cfks.select("from_table", "from_column", "to_table", "to_column").collect()] == \
        [("ev", "id", "ev", "lo_id")]


def test_mode_containment(spark):
    import __spark_entry__ as e
    d = "/root/testdata/sf0.001"
    q = e.queries()
    u = {tuple(r) for r in q["vote_union"](spark, d).collect()}
    l = {tuple(r) for r in q["vote_maj2_or_lead"](spark, d).collect()}
    m = {tuple(r) for r in q["vote_maj2"](spark, d).collect()}
    assert m <= l <= u
