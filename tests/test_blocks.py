"""Rankings by embedding and by fusion do not depend on how documents and questions are cut into blocks."""

import numpy as np
from pyspark.sql import functions as F

from linkspark.operators import retrieve as RT

N_DOCS, N_ASKED, K = 60, 23, 4


def _tables(spark):
    rng = np.random.default_rng(5)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True))
    vecs, asked = unit(rng.integers(-2, 3, (N_DOCS, 4)) + 0.5), unit(rng.integers(-2, 3, (N_ASKED, 4)) + 0.5)
    # three quarters of all rows lie in one corpus; equal vectors make ties; every seventh document has no vector
    corpus = lambda i: "hot" if i % 4 else "other"
    docs = spark.createDataFrame([(corpus(i), i) for i in range(N_DOCS)], "db_id string, table_idx long")
    doc_vecs = spark.createDataFrame([(i, vecs[i].tolist()) for i in range(N_DOCS) if i % 7], "table_idx long, vec array<double>")
    q = spark.createDataFrame([(i, corpus(i), asked[i].tolist() if i % 5 else None) for i in range(N_ASKED)],
                              "question_id long, db_id string, qvec array<double>")
    hits = [(i, corpus(i), d, float(rng.integers(1, 5))) for i in range(N_ASKED) for d in range(N_DOCS)
            if corpus(d) == corpus(i) and rng.random() < 0.3]
    scores = spark.createDataFrame(hits, "question_id long, db_id string, table_idx long, score double")
    return docs, doc_vecs, q, scores, vecs, asked, corpus, hits


def test_cosine_blocks(spark):
    docs, doc_vecs, q, _, vecs, asked, corpus, _ = _tables(spark)
    have = docs.join(doc_vecs, "table_idx").withColumnRenamed("vec", "embedding")
    ask = q.where("qvec is not null").withColumnRenamed("qvec", "embedding")
    want = set()
    for i in range(N_ASKED):
        if i % 5:
            near = sorted((-round(float(asked[i] @ vecs[d]), 9), d) for d in range(N_DOCS) if d % 7 and corpus(d) == corpus(i))
            want |= {(i, d, r + 1) for r, (_, d) in enumerate(near[:K])}
    for block_rows, query_rows in ((4096, 4096), (7, 5), (1, 1)):
        top = RT.cosine_top_k(ask, have, K, qid="question_id", doc="table_idx", block_rows=block_rows, query_rows=query_rows)
        assert {(r.question_id, r.table_idx, r.rank) for r in top.collect()} == want


def test_no_group_grows_with_the_questions(spark):
    docs, doc_vecs, q, *_ = _tables(spark)
    named = lambda df, key: df.select(F.col("db_id").alias("corpus"), F.col(key).alias(key.replace("question_id", "qid").replace("table_idx", "doc")))
    ask, have = named(q, "question_id"), named(docs, "table_idx")
    left, right = RT._grid(ask, have, ask, 2, 8)
    meet = left.join(right, ["corpus", "block", "qblock"])
    want = {(r.qid, r.doc) for r in ask.join(have, "corpus").collect()}
    pairs = [(r.qid, r.doc) for r in meet.collect()]
    assert set(pairs) == want and len(pairs) == len(want)
    assert left.select("corpus", "qblock").distinct().count() > 6


def test_fusion_blocks(spark):
    docs, doc_vecs, q, scores, vecs, asked, corpus, hits = _tables(spark)
    want = set()
    for i in range(N_ASKED):
        here = [d for d in range(N_DOCS) if corpus(d) == corpus(i)]
        score = {d: s for j, _, d, s in hits if j == i}
        by_text = {d: r for r, d in enumerate(sorted(here, key=lambda d: (-score.get(d, 0), d)))}
        with_vec = [d for d in here if d % 7]
        by_vec = {d: r for r, d in enumerate(sorted(with_vec, key=lambda d: (-round(float(asked[i] @ vecs[d]), 9), d)))} if i % 5 else {}
        fused = {d: round(1 / (60 + by_text[d]) + 1 / (60 + by_vec.get(d, len(with_vec))), 12) for d in here}
        best = sorted(here, key=lambda d: (-fused[d], d))[:K]
        want |= {(i, d, by_text[d], by_vec.get(d, len(with_vec)), r + 1) for r, d in enumerate(best)}
    for block_rows, query_rows in ((4096, 256), (7, 3)):
        top = RT.rrf_top_k(scores, q, docs, doc_vecs, K, block_rows=block_rows, query_rows=query_rows)
        assert {(r.question_id, r.table_idx, r.rank_bm25, r.rank_embed, r.rank) for r in top.collect()} == want
