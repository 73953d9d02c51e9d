"""Language identification with error-correcting output codes.

Every language has a codeword of +1/-1 bits; one logistic classifier per bit, over hashed character
1- to 3-grams of the letters, predicts it.  Decoding adds up each bit's logistic loss, weighted by how
well that bit did for that language in training (loss-weighted decoding), and takes the codeword with the
smallest loss.  ``score`` is the winner's share when losses are read as negative log-likelihoods;
``ambiguous`` marks texts whose runner-up comes within ``AMBIGUOUS`` of it.

Every language with a labelled text that may be learned from is a class.  Learning uses a sample: an equal
quota for each language of ``FIT_ROWS`` texts in all, though never below ``LANG_ROWS`` a language, so the sample
grows with the languages and not with the rows; whole texts of any length, taken in order of a hash of id and
text.  Tasks turn them into bucket counts, and only those reach the driver.  Prediction reads every whole text
in one map-only pass.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with nothing to learn from
every text is ``und``; with one language every text with a letter gets it; rows with a null ``doc_id``
may be learned from; repeated rows are predicted alike; an empty table gives an empty result; columns
other than ``doc_id``, ``text`` and (for learning) ``lang`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from linkspark.llm.common import held_out, read
from linkspark.llm.text_features import code_points, is_letter, ngram_buckets

BITS, ORDERS = 13, (1, 2, 3)
FIT_ROWS, LANG_ROWS = 4000, 32
AMBIGUOUS = 0.2
EPOCHS, RATE, BATCH, DECAY = 12, 1.0, 32, 1e-6


def counts(text: str) -> np.ndarray | None:
    """Square roots of the n-gram frequencies over the hash buckets; None without a letter."""
    points = code_points(text.lower())
    letters = is_letter(points)
    if not letters.any():
        return None
    points = np.where(letters, points, np.uint32(32))
    x = np.zeros(1 << BITS)
    for n in ORDERS:
        b = ngram_buckets(points, n, BITS)
        if len(b):
            x += np.bincount(b, minlength=1 << BITS) / (len(b) * len(ORDERS))
    return np.sqrt(x).astype(np.float32)


def codewords(n: int, seed: int = 1) -> np.ndarray:
    """All distinct two-way splits for up to 7 classes; beyond, the random code with the largest
    least distance of 50 drawn."""
    if n <= 7:
        width = max(1, 2 ** (n - 1) - 1)
        bits = (np.arange(1, width + 1)[None, :] >> np.arange(max(n - 1, 1))[:, None]) & 1 if n > 1 else np.ones((1, 1), int)
        bits = np.vstack([np.zeros((1, width), int), bits]) if n > 1 else bits
        return bits * 2 - 1
    rng = np.random.default_rng(seed)
    width = math.ceil(15 * math.log2(n))
    best, least = None, -1
    for _ in range(50):
        code = rng.integers(0, 2, (n, width)) * 2 - 1
        exact, alike = code.astype(np.float32), -width
        for at in range(0, n, 1024):  # the products of n codewords with all n at once would not fit for large n
            agree = exact[at: at + 1024] @ exact.T
            agree[np.arange(len(agree)), np.arange(at, at + len(agree))] = -width
            alike = max(alike, int(agree.max()))
        if (width - alike) // 2 > least:
            best, least = code, (width - alike) // 2
    return best


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # language x bit, +1 or -1
    trust: np.ndarray  # language x bit, each row sums to the number of bits
    weights: np.ndarray  # bucket x bit
    bias: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row of features: the language's number, the score, and whether it is ambiguous."""
        margin = x @ self.weights + self.bias
        total = (np.logaddexp(0, -margin) @ (self.trust * (self.code > 0)).T
                 + np.logaddexp(0, margin) @ (self.trust * (self.code < 0)).T)
        like = np.exp(total.min(axis=1, keepdims=True) - total)
        share = like / like.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        top = np.sort(share, axis=1)
        close = top[:, -1] - (top[:, -2] if len(self.langs) > 1 else 0.0) < AMBIGUOUS
        return best, share[np.arange(len(x)), best].astype(float), close


def dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One row of features for each ``(buckets, values)``."""
    x = np.zeros((len(rows), 1 << BITS), np.float32)
    for row, (at, values) in zip(x, rows):
        row[at] = values
    return x


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, langs: list[str], seed: int = 7) -> Model:
    """Adaptive stochastic gradient descent on all bits at once."""
    rng, code = np.random.default_rng(seed), codewords(len(langs))
    w, b = np.zeros((1 << BITS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    gw, gb = np.full_like(w, 1e-6), np.full_like(b, 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            i = order[at: at + BATCH]
            x, bits = dense([rows[k] for k in i]), code[y[i]].astype(np.float32)
            pull = -bits / (1 + np.exp(np.clip(bits * (x @ w + b), -30, 30))) / len(i)
            dw, db = x.T @ pull + DECAY * w, pull.sum(axis=0)
            gw += dw * dw
            gb += db * db
            w -= RATE * dw / np.sqrt(gw)
            b -= RATE * db / np.sqrt(gb)
    right = np.zeros(code.shape)
    for at in range(0, len(rows), 512):
        k = y[at: at + 512]
        np.add.at(right, k, np.sign(dense(rows[at: at + 512]) @ w + b) == code[k])
    trust = np.maximum(right / np.bincount(y, minlength=len(langs))[:, None], 1e-3)
    return Model(langs, code, trust / trust.sum(axis=1, keepdims=True) * code.shape[1], w, b)


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model | None:
    """Learn from ``text`` and ``lang`` of rows that are not held out; None if there are none."""
    # a letter, or a character that Java does not know and Python may; which one it is, counts() tells
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"[\p{L}\p{Cn}]") & ~held_out(F.col("doc_id"))).select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("place"))
    found = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("least")).collect()
    if not found:
        return None
    quota = max(LANG_ROWS, fit_rows // len(found))
    # a hash threshold thins the rows to about twice the quota, and to one at least, before the window makes the bound exact
    last = docs.sparkSession.createDataFrame(
        [(r["lang"], max(r["least"], 2 * quota * (2**64 - 1) // max(r["n"], 2 * quota) - 2**63)) for r in found], "lang string, last long")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, place, text in zip(batch.column("lang").to_pylist(), batch.column("place").to_pylist(), batch.column("text")):
                if (x := counts(text.as_py())) is not None:
                    at = np.flatnonzero(x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([place]), pa.array([at.astype(np.uint16).tobytes()]), pa.array([x[at].tobytes()])],
                        ["lang", "place", "at", "x"])

    sample = (rows.join(F.broadcast(last), "lang").where("place <= last").select("lang", "place", "text")
              .mapInArrow(features, "lang string, place long, at binary, x binary"))
    nth = Window.partitionBy("lang").orderBy("place", "at", "x")
    got = sample.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= quota).select("lang", "at", "x").collect()
    got.sort(key=lambda r: (r["lang"], r["at"], r["x"]))
    if not got:
        return None
    langs = sorted({r["lang"] for r in got})
    number = {lang: k for k, lang in enumerate(langs)}
    return train([(np.frombuffer(r["at"], np.uint16), np.frombuffer(r["x"], np.float32)) for r in got],
                 np.array([number[r["lang"]] for r in got]), langs)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred, lang_score, lang_ambiguous`` added."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column("text")
            pred, conf, close = ["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)
            for first in range(0, len(texts) if m else 0, 128):
                feats = [(i, x) for i in range(first, min(first + 128, len(texts)))
                         if (t := texts[i].as_py()) is not None and (x := counts(t)) is not None]
                if feats:
                    for (i, _), k, s, c in zip(feats, *m.decode(np.stack([x for _, x in feats]))):
                        pred[i], conf[i], close[i] = m.langs[k], float(s), bool(c)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(conf, pa.float64()), pa.array(close, pa.bool_())],
                schema=pa.schema([*batch.schema, ("lang_pred", pa.string()), ("lang_score", pa.float64()), ("lang_ambiguous", pa.bool_())]))

    kept = docs.drop("lang_pred", "lang_score", "lang_ambiguous")
    schema = (StructType([*kept.schema.fields]).add("lang_pred", StringType())
              .add("lang_score", DoubleType()).add("lang_ambiguous", BooleanType()))
    return kept.mapInArrow(score, schema)


def with_letter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a letter, which are those with a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bool(is_letter(code_points((t.as_py() or "").lower())).any()) for t in batch.column("text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_language_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs.select("doc_id", "text"), fit(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred",
        F.col("lang_score").alias("score"), F.col("lang_ambiguous").alias("ambiguous"))
