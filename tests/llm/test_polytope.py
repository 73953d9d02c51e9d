"""Links by cross-polytope hashing against all pairs."""

import numpy as np
import pytest

from linkspark.llm import cross_polytope as cp

SCHEMA = "vec_id long, embedding array<float>, label int, cid string, n int, same int, bucket int, copies string"
CLASH = ("c", 1, 2, 3, "d")


def answer(spark, rows):
    table = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], lab, *CLASH) for i, v, lab in rows], SCHEMA)
    got = cp.link_counts(table.repartition(3)).collect()
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


def brute(rows, least=0.98):
    n = len(rows)
    ok = [v is not None and lab is not None and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v, lab in rows]
    x = [np.asarray(v, np.float32).astype(float) if good else None for (_, v, _), good in zip(rows, ok)]
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= least:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    ids = {}
    for i, (vec_id, _, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(vec_id)
    least_id = {r: min((v for v in vs if v is not None), default=None) for r, vs in ids.items()}
    return sorted(((rows[i][0], links[i], least_id[find(i)]) for i in range(n)), key=str)


def families(rng, dim, sizes, cosine):
    """Vectors around common centres: two of a family lie at about ``cosine``."""
    out = []
    for size in sizes:
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        noise = rng.normal(size=(size, dim)) / dim**0.5
        out += list((centre + noise * (1 / cosine - 1) ** 0.5) * rng.uniform(0.1, 9, (size, 1)))
    return out


@pytest.mark.parametrize("dim,cosine", [(64, 0.99), (50, 0.981), (3, 0.995)])
def test_against_all_pairs(spark, dim, cosine):
    rng = np.random.default_rng(dim)
    vectors = families(rng, dim, [60, 30, 9, 5, 4, 3, 2, 2] + [1] * 60, cosine)
    rows = [(int(i), v, int(i) % 2) for i, v in zip(rng.permutation(1000), vectors)]
    got, want = answer(spark, rows), brute(rows)
    pairs, found = sum(r[1] for r in want), sum(r[1] for r in got)
    assert 0.99 * pairs <= found <= pairs
    if found == pairs:
        assert got == want


def test_hot_family_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(cp, "BLOCK", 40)
    monkeypatch.setattr(cp, "CHUNK", 16)
    rng = np.random.default_rng(2)
    vectors = families(rng, 16, [300], 0.999) + families(rng, 16, [1] * 100, 0.9)
    rows = [(i, v, 7) for i, v in enumerate(vectors)] + [(1000 + i, vectors[0], 7) for i in range(150)]
    assert answer(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, [1, 0], 1), (1, [1, 0], 1), (2, [1, 0.01], 1), (3, [5, 0], 1), (4, [1, 0], 2), (5, [1, 0], None), (6, None, 1), (7, [], 1),
            (8, [0, 0], 1), (9, [None, 1], 1), (10, [float("nan"), 1], 1), (11, [float("inf"), 1], 1), (12, [1, 0, 0], 1), (None, [0, 1], 1),
            (None, [0, 1], 1), (None, None, None), (13, [-0.0, 1], 2), (14, [0.0, 1], 2), (15, [1e-38, 0], 1), (16, [3e38, 1e30], 1), (17, [-1, 0], 1)]
    got = answer(spark, rows)
    assert got == brute(rows)
    assert (2, 5, 1) in got and (17, 0, 17) in got and (13, 1, 13) in got


def test_least_cosine_is_met_and_not_undercut(spark):
    angle = np.arccos(0.98)
    rows = [(0, [1, 0], 0), (1, [np.cos(angle * 0.999), np.sin(angle * 0.999)], 0), (2, [np.cos(angle * 1.001), -np.sin(angle * 1.001)], 0)]
    assert answer(spark, rows) == [(0, 1, 0), (1, 1, 0), (2, 0, 2)]


def test_no_rows(spark):
    assert answer(spark, []) == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    y = cp.hadamard(x)
    np.testing.assert_allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    np.testing.assert_allclose(cp.hadamard(y), x)


@pytest.mark.parametrize("dim,n", [(64, 500), (64, 60_000), (64, 10**7), (5, 10**6), (1, 10)])
def test_tables_meet_the_target(dim, n):
    h = cp.plan(dim, n)
    a, b = cp.pairs_at(0.98, dim, 3000, np.random.default_rng(99))
    met = np.zeros(3000, bool)
    for t in range(h.tables):
        of_a, of_b = h.buckets(a, t), h.buckets(b, t)
        met |= (of_a == of_b[:, :1]).any(axis=1) | (of_b == of_a[:, :1]).any(axis=1)
    assert met.mean() >= 0.99 and h.tables <= 24


def test_query_on_given_rows(spark):
    got = cp.op13_cross_polytope(spark, "/root/testdata/sf0.001")
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "bigint", "boolean"]
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding, r.label) for r in table])
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got.collect()), key=str) == want
