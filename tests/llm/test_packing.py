"""Packing against the tokenizer's own ids, and against the fewest sequences possible."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkspark.llm import best_fit_packing as B


@pytest.fixture(scope="module")
def words():
    return B.word_ids(B.tokenizer_path())


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(
    ["<|endoftext|>", "it's", "Don'T", "ΑΣ", "é", "́", "a\x1cb", "\x85", " ", "\xa0", "ß", "İ", "12", "  ", "\n", "日本"]), max_size=9).map(" ".join))
def test_word_by_word_equals_whole_text(words, text):
    assert words.of(text) == words.encode(text)


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "x <|ENDOFTEXT|> <|endof text|>", "it's"])
def test_ids_are_those_of_the_tokenizer_as_loaded(spark, text):
    ids = Tokenizer.from_file(B.tokenizer_path()).encode(text, add_special_tokens=False).ids + [0]
    got = B.with_digest(B.pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), B.tokenizer_path())).collect()
    assert [(r.start, r.length, r.ids_crc32) for r in got] == [(0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=200), st.integers(1, 12))
def test_open_bins(sizes, most):
    closed = []
    bins = B.OpenBins(20, most, lambda b, done: closed.append(b))
    for i, s in enumerate(sizes):
        bins.put(s, (i, s))
        assert bins.n <= most and bins.n == sum(map(len, bins.by_free))
    bins.finish()
    assert sorted(item[0] for b in closed for _, item in b) == list(range(len(sizes)))
    for b in closed:
        at = 0
        for offset, (_, size) in b:
            assert offset == at
            at += size
        assert at <= 20


def test_query(spark, tmp_path, words):
    rng = np.random.default_rng(5)
    rows = [(int(i), " ".join(rng.choice(["the", "Quick,", "brownish", "fox's", "é", "42"], n)), "x")
            for i, n in enumerate(rng.integers(0, 900, 150))]
    rows += [(1000, "word " * 9000, None), (1001, None, None), (1001, "", None), (None, "a b", None), (3, rows[3][1], "x")]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(5).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    got = B.op6_best_fit_packing(spark, str(tmp_path / "a")).collect()
    want = []
    for i, t, _ in rows:
        ids = words.tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        want += [(i, k, a, len(ids[a: a + 2048]), zlib.crc32(np.array(ids[a: a + 2048], "<u4").tobytes()))
                 for k, a in enumerate(range(0, len(ids), 2048))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(want, key=key)
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 2048
    assert len(seqs) <= 1.03 * sum(r.length for r in got) / 2048 + 1
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert B.op6_best_fit_packing(spark, str(tmp_path / "b")).collect() == []
