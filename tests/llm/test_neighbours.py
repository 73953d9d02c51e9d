"""Learned partitions against brute force."""

import numpy as np
import pytest

from linkspark.llm import learned_partitions as L


def brute(ids, v, k):
    out = {}
    for q in sorted({i for i in ids if i % 20 == 0}):
        mine = np.flatnonzero(ids == q)[0]
        s = (v * v[mine]).sum(axis=1)
        keep = np.flatnonzero(ids != q)
        out[q] = [(int(ids[j]), s[j]) for j in keep[np.lexsort((ids[keep], -s[keep]))][:k]]
    return out


@pytest.mark.parametrize("copies", [0, 700])
def test_recall_and_order(spark, tmp_path, monkeypatch, copies):
    monkeypatch.setattr(L, "PART_ROWS", 150)
    monkeypatch.setattr(L, "BLOCK_ROWS", 100)
    monkeypatch.setattr(L, "BLOCK_QUERIES", 20)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    v = (centres[rng.integers(0, 30, 2000)] + rng.normal(size=(2000, 16)) * 0.4).astype(np.float32)
    v[:copies] = v[0]
    ids = rng.permutation(2000)
    rows = [(int(i), [float(y) for y in x], 0) for i, x in zip(ids, v)]
    odd = [(20001, None), (20020, [0.0] * 16), (20040, [1.0, None] * 8), (20060, [float("nan")] * 16), (20080, [float("inf")] * 16), (20100, [1.0]), (None, [1.0] * 16)]
    spark.createDataFrame(rows + [(i, x, 0) for i, x in odd], "vec_id long, embedding array<float>, score int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {}
    for r in L.op3_learned_partitions(spark, str(tmp_path)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(ids, v.astype(np.float64), 20)
    assert set(got) == set(want)
    hit = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        vec = dict(zip(ids.tolist(), v.astype(np.float64)))
        assert all(s == (vec[q] * vec[i]).sum() for _, i, s in rows)
        least = want[q][-1][1]
        hit += sum(s >= least for _, _, s in rows)
    assert hit >= 0.9 * 20 * len(want)


def test_small_parts_are_topped_up(spark, monkeypatch):
    router = L.Router(8, 8, np.random.default_rng(0))
    router.w1, router.w2, router.mass = np.eye(8, L.HIDDEN), 50 * np.eye(L.HIDDEN, 8), 1e-9  # part i lies around axis i; one probe
    monkeypatch.setattr(L, "fit", lambda *_: router)
    rng = np.random.default_rng(1)
    rows = []
    for part, size in enumerate([2, 0, 9, 21, 15, 40]):
        rows += [(100 * part + i, [float(y) for y in np.eye(8)[part] + rng.random(8) * 0.2]) for i in range(size)]
    rows += [(0, rows[0][1])] * 30 + [(300, rows[-1][1])] * 5  # repeats of a query, in its part and in another
    table = spark.createDataFrame(rows, "vec_id long, v array<float>")
    got = {}
    for r in L.search(table, table.where("vec_id % 100 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(got) == {0, 200, 300, 400, 500}
    for q, found in got.items():
        assert sorted(n for n, _ in found) == list(range(1, 21)) and q not in {i for _, i in found}
    few = table.where("vec_id in (0, 1, 200, 201)")
    assert sorted((r.query_id, r.vec_id) for r in L.search(few, few.where("vec_id = 0"), 20).dropDuplicates().collect()) == [(0, 1), (0, 200), (0, 201)]


def test_few_rows(spark, tmp_path):
    for name, data in (("a", []), ("b", [(20, [1.0, 2.0])]), ("c", [(20, [1.0, 2.0]), (3, [1.0, 2.0]), (1, [1.0, 2.0]), (40, [-1.0, 0.0]), (40, [-1.0, 0.0])])):
        spark.createDataFrame(data, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / name / "embeddings.parquet"))
        got = [tuple(r) for r in L.op3_learned_partitions(spark, str(tmp_path / name)).collect()]
        if name == "c":
            assert sorted(got) == [(20, 1, 1, 5.0), (20, 2, 3, 5.0), (20, 3, 40, -1.0), (20, 4, 40, -1.0),
                                   (40, 1, 1, -1.0), (40, 2, 3, -1.0), (40, 3, 20, -1.0)]
        else:
            assert got == []


def test_large_parts_are_divided_again(spark, monkeypatch):
    """Beyond the most parts of one level a query still meets few rows, and finds them."""
    for name, value in {"MOST_PARTS": 8, "PART_ROWS": 64, "SPLIT_ROWS": 256, "FIT_ROWS": 1024, "BLOCK_ROWS": 500}.items():
        monkeypatch.setattr(L, name, value)
    routers = []
    made = L.Leaves.__init__
    monkeypatch.setattr(L.Leaves, "__init__", lambda self, *a: routers.append(self) or made(self, *a))
    rng = np.random.default_rng(4)
    # groups of groups, and a fifth of the rows one vector
    centres = (rng.normal(size=(12, 1, 16)) + rng.normal(size=(12, 10, 16)) * 0.5).reshape(-1, 16)
    v = (centres[rng.integers(0, 120, 6000)] + rng.normal(size=(6000, 16)) * 0.15).astype(np.float32).astype(np.float64)
    v[:1200] = v[0]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    ids = rng.permutation(6000)
    rows = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, v array<double>").repartition(4)
    found = L.search(rows, rows.where("vec_id % 20 = 0"), 10).collect()
    want, got = brute(ids, v, 10), {}
    for r in found:
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(want) and all(len(r) == 10 for r in got.values())
    assert sum(r.score >= want[q][-1][1] - 1e-12 for q, rs in got.items() for r in rs) >= 0.9 * 10 * len(want)
    leaves = routers[0]
    assert leaves.below and len(leaves) > 8
    home = leaves.home(v, leaves.top(v).argmax(axis=1))
    held = np.bincount(home, minlength=len(leaves))
    other = np.flatnonzero((ids % 20 == 0) & (np.arange(6000) >= 1200))
    row, leaf = leaves.probes(v[other], held, np.full(len(other), 11))
    assert len(set(zip(row.tolist(), leaf.tolist()))) == len(row)
    assert held[leaf].sum() / len(other) < 6000 / 4  # rows met by a query
    own = np.zeros((len(other), len(leaves)), bool)
    own[row, leaf] = True
    assert own[np.arange(len(other)), home[other]].mean() > 0.9
