"""The Jaccard join against all pairs."""

import re

import numpy as np
import pytest

from linkspark.llm import jaccard_join as J


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i: i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted((str(d), len(s), str(least.get(top(i)))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed):
    """Families of near copies around the threshold, exact copies, shared passages, short and odd texts."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdeE"), rng.integers(1, 5)))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.integers(5, 160))] + passage[: rng.integers(0, 60)]
        for _ in range(rng.integers(1, 14)):
            t = list(base)
            for _ in range(rng.integers(0, max(1, len(t) // 18) + 1)):
                t[rng.integers(0, len(t))] = word()
            if rng.random() < 0.3:
                t = t[: len(t) - rng.integers(0, 1 + len(t) // 12)]
            rows.append(" ".join(t) if rng.random() < 0.8 else "\n".join(t).upper())
    rows += [None, "", " \t\n", "one", "One", "two words", "a b c", "A b\tc", "a b c d", "a b c d e", "é ñ ü x", "é ñ ü x"]
    ids = rng.permutation(len(rows) * 2)[: len(rows)].tolist()
    return [*zip(ids, rows), (None, "one"), (None, ""), (ids[0], rows[0]), (ids[1], rows[2])]


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80)])
def test_components_equal_all_pairs(spark, seed, k, percent):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n string").repartition(3)
    got = sorted((str(r.doc_id), r.n, str(r.component_id)) for r in J.join_components(df, k, percent).collect())
    assert got == brute(rows, k, percent)


def test_no_rows_and_no_links(spark):
    for rows in ([], [(1, None)], [(1, "a b c d e f"), (2, "u v w x y z")]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert [r.component_id for r in J.join_components(df).orderBy("doc_id").collect()] == [r[0] for r in rows]
