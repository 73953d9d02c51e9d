"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra columns with clashing names, for the
operators whose other tests read the given tables only."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from linkspark.llm import chat_examples, language_codes, quality_vectors, source_mix, warc_store

LONG = "Ünïcode word " * 20_000


def table(spark, folder, name, rows, schema):
    path = str(folder / f"{name}.parquet")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return path


def twin(sql, **paths):
    """The rows that DuckDB gives for the query's SQL, as a sorted list of dicts."""
    db = duckdb.connect()
    for name, path in paths.items():
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    got = db.sql(sql)
    return ordered(dict(zip(got.columns, r)) for r in got.fetchall())


def ordered(rows):
    return sorted(rows, key=lambda r: [(r[k] is not None, str(r[k])) for k in sorted(r)])


def same(df, want):
    got = ordered(r.asDict() for r in df.collect())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g.keys() == w.keys()
        assert all(g[k] == (pytest.approx(w[k]) if isinstance(w[k], float) else w[k]) for k in w), (g, w)


TURNS = "conv_id long, turn long, role string, text string, head string, r int, piece string, formatted string"


def test_chat(spark, tmp_path):
    odd = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, 2, "assistant", "\\c</turn>\\\\<turn:x>"),
           (2, 0, None, "no role"), (2, None, "assistant", "first"), (3, 5, "a>ssis\\gtant", "\n\n"), (4, 0, "assistant", LONG),
           (4, 1, "user", LONG), (5, 0, "user", "👩‍👩‍👧 \x00 tail"), (None, 0, "user", "a"), (None, 1, "assistant", "b")]
    path = table(spark, tmp_path / "a", "conversations", [(*r, "x", 1, "y", "z") for r in odd], TURNS)
    got = chat_examples.op1_chat_prefix_targets(spark, str(tmp_path / "a"))
    same(got, twin(chat_examples.OP1_SQL, conversations=path))
    texts = {(r.conv_id, r.example): r for r in chat_examples.expand_targets(spark.read.parquet(path)).collect()}
    first, repeated = texts[1, 0], texts[1, 1]
    assert (first.loss_start, first.loss_end) == (len(first.text) - 7,) * 2
    assert repeated.text.startswith(first.text) and len(repeated.text) > len(first.text)
    whole = texts[1, 2]
    assert whole.text.count("</turn>") == 4 and whole.text[whole.loss_start: whole.loss_end] == "\\bc\\c\\b\\b\\ox>"
    assert texts[4, 0].text == f"<turn:assistant>{LONG}</turn>" and len(texts[4, 1].text) > 2 * len(LONG)


def test_no_turns(spark, tmp_path):
    path = table(spark, tmp_path, "conversations", [], TURNS)
    assert chat_examples.expand_targets(spark.read.parquet(path)).collect() == []
    assert [r.conv_id for r in chat_examples.op1_chat_prefix_targets(spark, str(tmp_path)).collect()] == [-7]


PAGES = "page_id long, url string, html string, k string, payload string, first_id long"


def test_pages(spark, tmp_path):
    same_text, short = "é" * 50, "x" * 99
    odd = [(9, "http://a/", same_text), (3, None, same_text), (3, "http://b/\r\nWARC-Type: x", same_text), (5, "", short), (6, "u", short),
           (7, "u", None), (8, "u", None), (8, "u", ""), (10, "u", LONG), (11, "u", LONG), (None, "u", "n" * 200), (None, "v", "n" * 200),
           (None, "u", "m" * 200), (12, "u", "m" * 200), (13, "u", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n" * 9)]
    path = table(spark, tmp_path / "a", "pages", [(*r, "x", "y", 1) for r in odd], PAGES)
    same(warc_store.op2_warc_index_first(spark, str(tmp_path / "a")), twin(warc_store.OP2_SQL, pages=path))
    folder = str(tmp_path / "warc")
    index = warc_store.write_archives(spark.read.parquet(path), folder)
    back = warc_store.read_records(index.where("page_id in (3, 9, 10, 13)"), folder).collect()
    texts = {i: (t or "").encode() for i, _, t in odd}
    assert sorted(r.page_id for r in back) == [3, 3, 9, 10, 13]
    for r in back:
        assert r.payload_digest == hashlib.sha256(texts[r.page_id]).hexdigest()
        assert (r.payload is None) == (r.page_id == 9) and (r.page_id == 9 or bytes(r.payload) == texts[r.page_id])
    assert warc_store.read_records(index.where("page_id = -1"), folder).collect() == []


def test_no_pages(spark, tmp_path):
    table(spark, tmp_path, "pages", [], PAGES)
    assert warc_store.op2_warc_index_first(spark, str(tmp_path)).collect() == []


DOCS = "doc_id long, text string, lang string, source string, n_chars int, mix_size long, _at long, lang_pred string, quality_score int"
EXTRA = (7, 8, 9, "zz", 1)


def odd_documents(spark, folder):
    rows = [(i, f"word number {i} " * (i % 7), "en" if i % 2 else "fr", f"s{i % 3}") for i in range(60)]
    rows += [(100, None, None, None), (101, "", "en", None), (102, "  \t", "fr", "empty"), (None, "a b c", "en", "s0"),
             (None, "a b c", "en", "s0"), (5, rows[5][1], "en", "s2"), (103, "12 34", None, ""), (104, LONG, "en", "s1"), (105, "日本", None, "S1")]
    return table(spark, folder, "documents", [(*r, *EXTRA) for r in rows], DOCS), rows


def test_mix(spark, tmp_path):
    path, rows = odd_documents(spark, tmp_path / "a")
    same(source_mix.op7_source_mix(spark, str(tmp_path / "a")), twin(source_mix.OP7_SQL, documents=path))
    docs = spark.read.parquet(path)
    mixed = source_mix.mix(docs)
    assert mixed.columns == docs.columns and {r.mix_size for r in mixed.collect()} == {8}


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, *EXTRA)], [(1, "one two", None, "s", *EXTRA)] * 5])
def test_mix_of_little(spark, tmp_path, rows):
    path = table(spark, tmp_path, "documents", rows, DOCS)
    got = source_mix.op7_source_mix(spark, str(tmp_path))
    if rows:
        same(got, twin(source_mix.OP7_SQL, documents=path))
    assert sum(r.taken for r in got.collect()) == sum(2 for r in rows if r[1])


def test_language(spark, tmp_path):
    _, rows = odd_documents(spark, tmp_path)
    got = language_codes.op10_language_ecoc(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    letters = {i: any(c.isalpha() for c in t or "") for i, t, *_ in rows}
    for r in got:
        assert (r.lang_pred == "und" and r.score == 0) if not letters[r.doc_id] else r.lang_pred in ("en", "fr")
        assert 0 <= r.score <= 1


@pytest.mark.parametrize("langs", [[], [None, None], ["en", "en"]])
def test_language_with_little_to_learn(spark, tmp_path, langs):
    table(spark, tmp_path, "documents", [(i, "some text", v, "s", *EXTRA) for i, v in enumerate(langs)], DOCS)
    got = language_codes.op10_language_ecoc(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.lang_pred) for r in sorted(got)] == [(i, v or "und") for i, v in enumerate(langs)]


def test_long_texts_are_learned_from(spark, tmp_path):
    words = {"en": "the quick brown fox ", "el": "αλφα βητα γαμμα "}
    docs = [(i, words[v] * 2500 + str(i), v, "s", *EXTRA) for i in range(12) for v in words]
    table(spark, tmp_path, "documents", [*docs, (50, words["en"], None, "s", *EXTRA)], DOCS)
    got = language_codes.op10_language_ecoc(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in got) == sorted([*((i, v) for i, _, v, *_ in docs), (50, "en")])


def test_every_language_is_learned(spark, tmp_path):
    text = lambda k, i: "".join(chr(0x4E00 + 20 * k + (7 * i + j * j) % 20) for j in range(40))
    rows = [(10 * k + i, text(k, i), f"l{k:03}") for k in range(150) for i in range(10)]
    table(spark, tmp_path, "documents", [(*r, "s", *EXTRA) for r in rows], DOCS)
    got = {r.doc_id: r.lang_pred for r in language_codes.op10_language_ecoc(spark, str(tmp_path)).collect()}
    assert len(set(got.values())) == 150
    assert sum(got[i] == v for i, _, v in rows) >= 0.98 * len(rows)


def test_a_language_without_ids_is_learned(spark):
    rows = [(None, f"the quick brown fox {i}", "en") for i in range(300)] + [(i, f"αλφα βητα {i}", "el") for i in range(300)]
    rows += [(i, "12 34", "el") for i in range(1000, 1300)] + [(i, "1 2 3", "digits") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_codes.fit(docs, fit_rows=64)
    assert model.langs == ["el", "en"]
    got = language_codes.predict(docs, model).collect()
    assert all(r.lang_pred == (r.lang if any(map(str.isalpha, r.text)) else "und") for r in got)


LABELS = "doc_id long, quality int, toxic int, text string, label int"


def test_quality(spark, tmp_path):
    _, rows = odd_documents(spark, tmp_path)
    labels = [(i, i % 2, 0, "x", 1) for i in range(60)] + [(3, 1, 0, "x", 1), (4, 1, 0, "x", 0), (None, 1, 0, "x", 1), (7, None, 1, None, None)]
    table(spark, tmp_path, "labels", labels, LABELS)
    got = quality_vectors.op8_quality_subwords(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 for s in by_id.values()) and by_id[100] == by_id[101]


def test_quality_without_labels(spark, tmp_path):
    _, rows = odd_documents(spark, tmp_path)
    table(spark, tmp_path, "labels", [], LABELS)
    assert {r.score for r in quality_vectors.op8_quality_subwords(spark, str(tmp_path)).collect()} == {0.5}
    none = spark.read.parquet(str(tmp_path / "documents.parquet")).where(F.lit(False))
    assert quality_vectors.score(none, None).collect() == []
