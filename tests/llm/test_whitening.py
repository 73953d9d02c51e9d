"""Whitening against numpy on one matrix, and on odd rows."""

import numpy as np
import pytest

from linkspark.llm import block_whitening as bw

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, x string, row long, z int, part string, n int"
CLASH = (1, "x", 2, 3, "p", 4)


def write(spark, folder, vectors):
    rows = [(i, v, *CLASH) for i, v in vectors]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(folder / "embeddings.parquet"))
    return bw.op11_block_whitening(spark, str(folder)).toPandas()


def brute(vectors, most=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    exact = [[n * int(c) - int(t) for c, t in zip(row, s)] for row in x]
    centred = np.array(exact, float) / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return [sum(c * c for c in row) for row in exact], centred @ u / np.sqrt(e), e / np.trace(v)


def same(got, ids, vectors):
    deviation, whitened, explained = brute(vectors)
    k = whitened.shape[1]
    assert len(got) == len(ids) * k and set(got.n) == {len(ids)} and got.identity_error.nunique() == 1
    assert got.identity_error.iloc[0] < 1e-9
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    signs = np.sign((wide * whitened).sum(axis=0))
    assert list(range(1, k + 1)) == sorted(set(got.component))
    np.testing.assert_allclose(wide * signs, whitened, atol=1e-8)
    one = got[got.component == 1].set_index("vec_id").loc[ids]
    assert [int(d) for d in one.deviation] == deviation
    np.testing.assert_allclose(got.drop_duplicates("component").sort_values("component").explained, explained, rtol=1e-9)


def test_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    same(bw.op11_block_whitening(spark, SF).toPandas(), list(table.vec_id), table.embedding.tolist())


def test_several_blocks_and_few_dimensions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bw, "BLOCK_ROWS", 64)
    monkeypatch.setattr(bw, "BLOCKS", 5)
    monkeypatch.setattr(bw, "TASK_BLOCKS", 2)
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(700, 5)) * [9, 5, 3, 1, 0.2] + 4).tolist()
    same(write(spark, tmp_path, list(enumerate(vectors))), list(range(700)), vectors)


def test_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(4)
    good = [(i, v) for i, v in enumerate(rng.normal(size=(40, 3)).tolist())]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 0.0, 0.0]), (103, [float("-inf"), 0.0, 0.0]), (104, []),
           (105, [1.0]), (106, [1.0, 2.0, 2.0**40])]
    same(write(spark, tmp_path, good + bad), [i for i, _ in good], [v for _, v in good])


def test_repeated_and_null_ids(spark, tmp_path):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [3.0, 5.0]), (2, [0.0, 0.0])]
    got = write(spark, tmp_path, rows)
    assert len(got) == 8 and got.vec_id.isna().sum() == 2 and (got.vec_id == 1).sum() == 4 and set(got.n) == {4}


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_nothing_to_whiten(spark, tmp_path, vectors):
    got = write(spark, tmp_path, list(enumerate(vectors)))
    assert len(got) == 0 and list(got) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_one_direction_only(spark, tmp_path):
    got = write(spark, tmp_path, [(i, [float(i), 2.0 * i]) for i in range(9)])
    assert set(got.component) == {1} and abs(got.explained - 1).max() < 1e-9


def test_distances_beyond_a_long_are_null(spark, tmp_path):
    got = write(spark, tmp_path, [(0, [2.0**29, 0.0]), (1, [-(2.0**29), 1.0]), (2, [0.0, 5.0])])
    assert list(got.sort_values("vec_id").deviation.isna()) == [True, True, False] and got.identity_error.max() < 1e-6
