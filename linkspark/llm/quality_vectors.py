"""A quality classifier on supervised subword embeddings.

Every word, every two neighbouring words and every character 2- to 4-gram is hashed to a bucket with a learned
vector; the text's vector is the average over all of them, and a softmax over two classes reads it.  Vectors and
output weights are learned together by numpy stochastic gradient descent.  Because the output is linear
in the average, scoring a text needs one number per bucket (its vector's product with the difference of
the two output weights), which gives the same score as the vectors themselves.

Learning uses a bounded sample of labelled rows: at most ``FIT_ROWS`` texts of any length, in order of a hash of
the id.  Tasks turn whole texts into bucket counts, and only those (six bytes for each of at most ``2**BITS``
buckets a text) reach the driver.  Scoring reads every whole text in one map-only pass.

Defined cases: null and empty texts have no features and get the bias alone; a document whose labels
disagree, or one of whose labels is null or neither 0 nor 1, is not learned from; of rows that repeat a labelled id
the smallest text is learned from; with labels of one class only every score leans to it; without labelled rows every
score is 0.5; repeated rows score alike; an empty table gives an empty result; only ``doc_id`` and ``text`` of
the documents and ``doc_id`` and ``quality`` of the labels are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from linkspark.llm.common import held_out, read
from linkspark.llm.text_features import code_points, mix, ngram_buckets, word_buckets

BITS, ORDERS, DIM = 16, (2, 3, 4), 16
FIT_ROWS = 3000
EPOCHS, RATE = 8, 2.0
THRESHOLD = 0.7
#: Keeps a pair of words apart from the same two the other way round.
PAIR = np.uint64(0x9E3779B97F4A7C15)


def features(text: str) -> np.ndarray:
    """Buckets of all words, of all pairs of neighbouring words and of all character n-grams."""
    points = code_points(text)
    words = word_buckets(points, 62)
    pairs = mix(words[:-1].astype(np.uint64) * PAIR + words[1:].astype(np.uint64)) >> np.uint64(64 - BITS)
    return np.concatenate([words >> (62 - BITS), pairs.astype(np.int64), *(ngram_buckets(points, n, BITS) for n in ORDERS)])


@dataclass
class Model:
    vectors: np.ndarray  # bucket x DIM
    weights: np.ndarray  # DIM x 2
    bias: np.ndarray  # 2

    def scorer(self) -> tuple[np.ndarray, float]:
        return (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 11) -> Model:
    """``rows``: buckets, their shares of the text's features, and the label."""
    rng = np.random.default_rng(seed)
    m = Model(rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32), np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32))
    steps, step = max(1, EPOCHS * len(rows)), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at, share, label = rows[k]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            hidden = share @ m.vectors[at]
            z = hidden @ m.weights + m.bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            pull = m.weights @ p
            m.weights -= rate * np.outer(hidden, p)
            m.bias -= np.float32(0.1) * rate * p
            m.vectors[at] -= (rate * len(at) ** 0.5) * share[:, None] * pull[None, :]
    return m


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model | None:
    """Learn from labelled documents that are not held out; None if there are none."""
    clear = F.coalesce(F.col("quality").isin(0, 1), F.lit(False))
    one = (labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id")
           .agg(F.min("quality").cast("int").alias("label"), F.max("quality").alias("most"), F.bool_and(clear).alias("clear"))
           .where("clear and label = most").select("doc_id", "label"))
    usable = docs.select("doc_id", "text").where(F.length("text") > 0)
    ids = usable.select("doc_id").join(one, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # the ids are bounded by fit_rows, a documented parameter
    sample = (usable.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, label, text in zip(batch.column("doc_id"), batch.column("label"), batch.column("text").to_pylist()):
                at, n = np.unique(features(text), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id.as_py()], pa.int64()), pa.array([label.as_py()], pa.int32()),
                     pa.array([at.astype(np.uint16).tobytes()]), pa.array([n.astype(np.int32).tobytes()])], ["doc_id", "label", "at", "n"])

    got = sample.mapInArrow(hashed, "doc_id long, label int, at binary, n binary").collect()
    rows = []
    for r in sorted(got, key=lambda r: r["doc_id"]):
        n = np.frombuffer(r["n"], np.int32)
        if len(n):
            rows.append((np.frombuffer(r["at"], np.uint16).astype(np.int32), (n / n.sum()).astype(np.float32), r["label"]))
    return train(rows) if rows else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``quality_score`` (probability of label 1) added."""
    shared = docs.sparkSession.sparkContext.broadcast(model.scorer() if model else (np.zeros(1 << BITS, np.float32), 0.0))
    kept = docs.drop("quality_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pull, bias = shared.value
        for batch in batches:
            out = []
            for t in batch.column("text"):
                f = features(t.as_py() or "")
                z = (float(pull[f].mean(dtype=np.float64)) if len(f) else 0.0) + bias
                out.append(1 / (1 + np.exp(-np.clip(z, -700, 700))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())],
                                             schema=pa.schema([*batch.schema, ("quality_score", pa.float64())]))

    return kept.mapInArrow(run, StructType([*kept.schema.fields]).add("quality_score", DoubleType()))


def op8_quality_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
