"""Paragraph sketches against plain sets."""

import base64
import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkspark.llm import paragraph_sketch as S

LINES = st.lists(st.sampled_from(["a", "b", "c.", "long line " * 40 + "end. more", "é", "", " "]) | st.text(max_size=20), max_size=60)


def bag_likeness(a, b):
    a, b = Counter(S.paragraphs(a)), Counter(S.paragraphs(b))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


@settings(max_examples=150, deadline=None)
@given(LINES.map("\n".join), LINES.map("\n".join))
def test_likeness_equals_sets(a, b):
    own, other = S.digests([a]), S.digests([b])
    fa, fb = S.fingerprints(*own, 1)[0], S.fingerprints(*other, 1)[0]
    assert abs(S.fingerprint_likeness(fa, fb) - bag_likeness(a, b)) < 1e-12
    assert (S.recover(fa) == np.sort(own[0])).all()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=8), st.integers(0, 2**32))
def test_folded_sketches_are_sketches_of_the_folded_size(sizes, seed):
    rng = np.random.default_rng(seed)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    d = rng.integers(1, 2**63, len(owner)).astype(np.uint64)
    s = S.sketches(d, owner, len(sizes))
    which = rng.permutation(len(sizes))
    small = s.size[which] >> rng.integers(0, 9, len(which))
    small = np.maximum(small, 1)
    got, want = s.folded(which, small), S.Sketches(small)
    place = np.argsort(which)
    want.add(d, place[owner] if len(d) else owner)
    for x, y in ((got.count, want.count), (got.key, want.key), (got.check, want.check)):
        assert (x == y).all()
    assert S.decode(S.encode(s)).totals().tolist() == sizes


def test_differences_of_few_and_of_all_paragraphs():
    rng = np.random.default_rng(5)
    base = rng.integers(1, 2**63, 5000).astype(np.uint64)
    sides = [base, base[10:], np.concatenate([base[:-3], rng.integers(1, 2**63, 40).astype(np.uint64)]),
             rng.integers(1, 2**63, 5000).astype(np.uint64), base[:7], base[:0]]
    s = S.sketches(np.concatenate(sides), np.repeat(np.arange(len(sides)), [len(x) for x in sides]), len(sides))
    i, j = (x.ravel() for x in np.indices((len(sides), len(sides))))
    want = [len(set(sides[x].tolist()) ^ set(sides[y].tolist())) for x, y in zip(i, j)]
    assert S.differences(s, i, s, j).tolist() == want


def test_a_damaged_fingerprint_is_refused():
    f = S.fingerprints(*S.digests(["one\ntwo\nthree"]), 1)[0]
    n, _, cells = f.partition(":")
    raw = bytearray(base64.b64decode(cells))
    raw[60] ^= 1
    with pytest.raises(ValueError):
        S.recover(f"{n}:" + base64.b64encode(bytes(raw)).decode())


def test_paragraphs_keep_the_text():
    text = "First line.\n" + "A sentence of some words. " * 60 + "\n\n" + "x" * 2000
    assert "".join("".join(S.paragraphs(text)).split()) == "".join(text.split())


def test_query_on_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "RANGE_CHARS", 40)
    texts = {5: "one two\nthree " * 9, 1: None, 9: "", 7: "é" * 33, 30: "z\n" * 5, 12: "a b c d"}
    rows = [(i, t, 0) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars int").write.parquet(str(tmp_path / "a" / "documents.parquet"))
    got = {r.doc_id: r for r in S.op4_paragraph_sketch(spark, str(tmp_path / "a")).collect()}
    ids = sorted(texts)
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        t, f = texts[i] or "", texts[nxt] or ""
        edited = t[: len(t) - len(t) // 4] + f[: len(t) // 4]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - bag_likeness(t, edited)) < 1e-12 and abs(r.near_next - bag_likeness(t, f)) < 1e-12
        assert r.fingerprint == S.fingerprints(*S.digests([t]), 1)[0]
        assert r.edited_fingerprint == S.fingerprints(*S.digests([edited]), 1)[0]
    odd = [(None, "a"), (3, "b"), (3, "b"), (3, "c"), (None, "d")]
    for name, data in (("b", odd), ("c", []), ("d", [(1, "only one here")])):
        spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / name / "documents.parquet"))
        res = S.op4_paragraph_sketch(spark, str(tmp_path / name)).collect()
        assert Counter(r.doc_id for r in res) == Counter(d[0] for d in data)
    assert res[0].near_next == 1.0


def check_neighbours(spark, rows, most):
    """Every row has the next one behind it, and no range holds more than ``most`` rows."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    parts = {}
    for r in S.with_neighbours(docs).withColumn("p", F.spark_partition_id()).collect():
        parts.setdefault((r.p, r.range), []).append(r)
    sizes = [sum(not r.tail for r in part) for part in parts.values()]
    assert sum(sizes) == len(rows) and max(sizes) <= most
    key = lambda doc_id, text: (S.NO_ID if doc_id is None else doc_id, text or "")
    follows = []
    for part in parts.values():
        follows += [(key(a.doc_id, a.text), key(b.doc_id, b.text)) for a, b in zip(part, part[1:]) if not a.tail]
        assert part[-1].tail or len(part) == 1
    assert sorted(a for a, _ in follows) == sorted(key(*r) for r in rows)
    assert sorted(b for _, b in follows) == sorted(key(*r) for r in rows)  # each is the next of exactly one
    assert sum(b[0] < a[0] for a, b in follows) <= 1  # ids fall once, from the last to the first


def test_ranges_follow_the_ids(spark, monkeypatch):
    monkeypatch.setattr(S, "RANGE_CHARS", 8000)
    even = [(i, "word " * 10) for i in range(3000)]
    outliers = even + [(10**15, "far"), (2**63 - 1, "last"), (-(2**63) + 1, None)]
    clustered = [(c * 10**14 + i, "word " * 10) for c in range(5) for i in range(600)]
    one_id = even + [(None, f"text {i}") for i in range(1500)] + [(7, f"text {i}") for i in range(1500)]
    long_text = even + [(1500, "x" * 200_000), (1500, "y" * 200_000)]
    for rows in (even, outliers, clustered, one_id, long_text):
        check_neighbours(spark, rows, 500)
    check_neighbours(spark, [(1, "same")] * 50 + [(None, None)] * 50, 100)


def test_range_numbers():
    starts = np.array([(-5, 3), (0, -9), (0, 4), (0, 8), (7, 1)])
    rows = [(k, t) for k in range(-5, 9) for t in range(-9, 10) if (k, t) >= (-5, 3)]
    want = [max(i for i, s in enumerate(starts.tolist()) if tuple(s) <= r) for r in rows]
    key, tie = np.array(rows).T
    assert S.range_numbers(starts, key, tie).tolist() == want
