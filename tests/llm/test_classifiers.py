"""The two classifiers: held-out accuracy, little or odd things to learn from, and scores taken the long way round."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkspark.llm import language_codes, quality_vectors
from linkspark.llm.common import held_out
from linkspark.llm.text_features import code_points, ngram_buckets
from test_odd_rows import DOCS, EXTRA, LABELS, table

SF = "/root/testdata/sf0.01"


def quality(spark, folder, docs, labels):
    table(spark, folder, "documents", [(i, t, "en", "s", *EXTRA) for i, t in docs], DOCS)
    table(spark, folder, "labels", [(i, q, 0, "x", 1) for i, q in labels], LABELS)
    return {r.doc_id: r for r in quality_vectors.op8_quality_subwords(spark, str(folder)).collect()}


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = quality_vectors.op8_quality_subwords(spark, SF).join(labels, "doc_id").where("held_out")
    right, n = got.select(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 50 and right >= 0.95


def test_long_texts_are_learned_from(spark, tmp_path):
    rng = np.random.default_rng(1)
    words = {1: [f"good{i}" for i in range(300)], 0: [f"junk{i}" for i in range(300)]}
    docs = [(i, " ".join(rng.choice(words[i % 2], 1700))) for i in range(60)]
    assert min(len(t) for _, t in docs) > 8_000
    got = quality(spark, tmp_path, docs, [(i, i % 2) for i, _ in docs])
    held = [r for r in got.values() if r.held_out]
    assert len(held) > 5 and all(r.predicted == r.doc_id % 2 for r in held)


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_only(spark, tmp_path, label):
    got = quality(spark, tmp_path, [(i, f"some text {i}") for i in range(40)], [(i, label) for i in range(40)])
    assert all((r.score > 0.7) if label else (r.score < 0.3) for r in got.values())


def test_unclear_labels_are_not_learned_from(spark, tmp_path):
    docs = [(i, f"text {i}") for i in range(40)]
    unclear = [(i, q) for i in range(40) for q in ((1, None) if i % 3 == 0 else (0, 1) if i % 3 == 1 else (1, 2))]
    assert {r.score for r in quality(spark, tmp_path, docs, unclear).values()} == {0.5}


def test_quality_score_is_the_softmax_of_averaged_vectors(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = quality_vectors.fit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    got = {r.doc_id: r for r in quality_vectors.score(docs, model).collect()}
    for r in docs.limit(40).collect():
        average = np.zeros(quality_vectors.DIM)
        buckets = quality_vectors.features(r.text)
        for b in buckets:
            average += model.vectors[b].astype(float) / len(buckets)
        z = [sum(float(a) * float(w) for a, w in zip(average, model.weights[:, k])) + float(model.bias[k]) for k in (0, 1)]
        want = math.exp(z[1]) / (math.exp(z[0]) + math.exp(z[1]))
        assert got[r.doc_id].quality_score == pytest.approx(want, abs=1e-4)


def test_language_is_the_codeword_with_the_least_loss(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_codes.fit(docs)
    got = {r.doc_id: r for r in language_codes.predict(docs.select("doc_id", "text"), model).collect()}
    for r in docs.limit(25).collect():
        letters = "".join(c if c.isalpha() else " " for c in r.text.lower())
        share = {}
        for n in language_codes.ORDERS:
            grams = ngram_buckets(code_points(letters), n, language_codes.BITS)
            for b in grams:
                share[b] = share.get(b, 0) + 1 / len(grams) / len(language_codes.ORDERS)
        margins = [float(model.bias[k]) + sum(math.sqrt(x) * float(model.weights[b, k]) for b, x in share.items()) for k in range(len(model.bias))]
        loss = [sum(model.trust[i, k] * math.log1p(math.exp(-model.code[i, k] * m)) for k, m in enumerate(margins)) for i in range(len(model.langs))]
        assert got[r.doc_id].lang_pred == model.langs[loss.index(min(loss))]
        likely = [math.exp(-x) for x in loss]
        assert got[r.doc_id].lang_score == pytest.approx(max(likely) / sum(likely), abs=1e-3)


def test_held_out_ids(spark):
    got = spark.createDataFrame([(0,), (None,), (5,)], "doc_id long").select(held_out(F.col("doc_id")).alias("h")).collect()
    import zlib
    assert [r.h for r in got] == [zlib.crc32(b"0") % 4 == 2, False, zlib.crc32(b"5") % 4 == 2]
