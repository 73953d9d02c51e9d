"""Every pipeline stage against what its contract says, on the small documents and on odd rows."""

from collections import Counter

import corpus_pipeline
from linkspark.llm import best_fit_packing, language_codes, pii_anchors
from linkspark.llm.common import materialise
from test_jaccard import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900001, "", "en", "src0", 0), (900002, "12 34", None, None, 5),
                                 (0, docs.where("doc_id = 0").first().text, "en", "other", 1)], docs.schema)
    docs = materialise(docs.unionByName(odd), "test-docs")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF), f"test-{name}")
        seen[name] = (docs.collect(), out.collect())
        if name != "packing":
            assert out.columns == columns
        docs = out
    before, after = seen["language"]
    letters = [r for r in before if r.text and any(c.isalpha() for c in r.text)]
    assert len(letters) - len(after) <= 0.01 * len(letters) and all(any(c.isalpha() for c in r.text) for r in after)
    before, after = seen["near_copies"]
    groups = {c for d, _, c in brute([(r.doc_id, r.text) for r in before], 5, 80)}
    assert sorted(str(r.doc_id) for r in after) == sorted(groups)
    before, after = seen["personal_data"]
    texts = {r.doc_id: r.text for r in before}
    assert len(after) == len(before)
    for r in after:
        assert r.text == pii_anchors.redacted(texts[r.doc_id], pii_anchors.find(texts[r.doc_id])) and r.n_chars == len(r.text)
    before, after = seen["source_mix"]
    rows = {r.doc_id: r for r in before}
    assert all(r == rows[r.doc_id] for r in after) and max(Counter(r.doc_id for r in after).values()) <= 3
    words = lambda rs: sum(len(r.text.split()) for r in rs)
    assert abs(words(after) / words(before) - 1) < 0.3
    before, after = seen["packing"]
    ids = best_fit_packing.word_ids(best_fit_packing.tokenizer_path())
    assert sum(r.length for r in after) == sum(len(ids.of(r.text)) // 4 + 1 for r in before)
    assert Counter(r.doc_id for r in after if r.piece == 0) == Counter(r.doc_id for r in before)


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), f"none-{name}")
        assert docs.count() == 0


def test_held_out_languages(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_codes.predict(docs, language_codes.fit(docs)).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    right = got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98


def test_clashing_columns(spark):
    names = ["_sid", "_id", "_keep", "_copies", "sid", "n", "s", "lang_pred", "lang_score", "lang_ambiguous", "mix_size", "mix_copies",
             "_at", "_r", "_row", "_copy", "_range", "given_0", "spans", "ids", "piece", "sequence_id"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", *(f"cast(doc_id as string) as {c}" for c in names))
    docs = docs.select(*reversed(docs.columns))
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF), f"clash-{name}")
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert out.count() and out.where(" or ".join(f"not {c} <=> cast(doc_id as string)" for c in names)).count() == 0
        docs = out


def test_a_corpus_without_languages_is_kept(spark):
    rows = [(i, f"plain text {i}", None, "s", 9) for i in range(50)] + [(60, "12 34", None, "s", 5), (61, None, None, "s", 0), (62, "", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.language(spark, docs, SF)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == list(range(50))
