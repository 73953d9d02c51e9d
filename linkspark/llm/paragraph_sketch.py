"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

A paragraph is a line; lines longer than ``SPLIT`` characters are cut at sentence ends behind that
length.  Repeated paragraphs are told apart by their number, so a text is a set of 64-bit digests.  Every
digest is added to one cell in each of three subtables; a cell holds a count, the sum of its digests and
the sum of their check values.  Sketches of one size subtract cell by cell, and peeling (take a cell that
holds one digest, remove it from its other cells, go on) recovers the digests in which two texts differ.
Sizes are powers of two.  A fingerprint has the smallest size from ``n / 2`` cells a subtable at which it
peels by itself, so it can be turned back into its digests.

Two fingerprints are folded to a common small size (a cell is picked by the low bits of a hash, so the cells of a
smaller sketch are sums of those of a larger one), subtracted and peeled.  Where peeling gets stuck, the pair is
folded less, up to the smaller fingerprint's own size; where their difference is larger than that can hold, both
give back their digests, which fill sketches of twice the size until one peels.

Likeness is the Jaccard similarity of the two digest sets, from their sizes and the recovered difference.

All texts of a batch are sketched and peeled together in numpy arrays.

Defined cases: null and empty texts have no paragraphs; two empty sets have likeness 1; rows are ordered by
(doc_id, hash of the text, text), null ids as the least long, so repeated ids and rows have a next document too (a
lone document is its own); only rows equal in id and text must share a range; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspark.llm.common import read
from linkspark.llm.text_features import mix

SPLIT, REST = 120, 240
TABLES = 3
LEAST = 4  # cells of a subtable
#: Documents are dealt out in ranges of ids of about so many characters, out of so many slots at most.
RANGE_CHARS, RANGES, ROW_CHARS = 4 << 20, 1 << 16, 64  # a row counts as ROW_CHARS beyond its text
NO_ID = -(1 << 63)  # rows without an id stand at the least id
CHUNK = 256

_PIECE = re.compile(rf"[^\n]{{{SPLIT}}}(?:[^\n]{{0,{REST}}}?[.!?](?= )|[^\n]{{0,{REST}}})|[^\n]+")
_SALT = [np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1) for k in range(TABLES + 2)]


def paragraphs(text: str) -> list[str]:
    return [p for p in map(str.strip, _PIECE.findall(text)) if p]


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The digests of all texts' paragraphs and, for each, the number of its text."""
    import xxhash

    each = [[xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")) for p in paragraphs(t)] for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(e) for e in each])
    d = np.fromiter((x for e in each for x in e), np.uint64, len(owner))
    order = np.lexsort((d, owner))
    d, owner = d[order], owner[order]
    fresh = np.ones(len(d), bool)
    fresh[1:] = (d[1:] != d[:-1]) | (owner[1:] != owner[:-1])
    number = np.arange(len(d)) - np.maximum.accumulate(np.where(fresh, np.arange(len(d)), 0))
    return mix(d + number.astype(np.uint64) * _SALT[TABLES]), owner


def check_value(d: np.ndarray) -> np.ndarray:
    return (mix(d ^ _SALT[TABLES + 1]) >> np.uint64(32)).astype(np.uint32)


class Sketches:
    """Sketches of many texts in flat arrays: text ``i`` has ``TABLES`` subtables of ``size[i]`` cells."""

    def __init__(self, size: np.ndarray):
        self.size = size.astype(np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size * TABLES)))
        n = int(self.start[-1])
        self.count, self.key, self.check = np.zeros(n, np.int32), np.zeros(n, np.uint64), np.zeros(n, np.uint32)
        self.owner = np.repeat(np.arange(len(size)), self.size * TABLES)
        self.table = (np.arange(n) - self.start[self.owner]) // np.maximum(self.size[self.owner], 1)

    def add(self, d: np.ndarray, owner: np.ndarray, sign: np.ndarray | int = 1) -> Sketches:
        sign = np.broadcast_to(np.asarray(sign, np.int32), d.shape)
        wide = sign.astype(np.int64).astype(np.uint64)  # -1 wraps, and so do the sums
        key, check = d * wide, check_value(d) * wide.astype(np.uint32)
        for k in range(TABLES):
            at = self.start[owner] + k * self.size[owner] + (mix(d ^ _SALT[k]) & (self.size[owner] - 1).astype(np.uint64)).astype(np.int64)
            np.add.at(self.count, at, sign)
            np.add.at(self.key, at, key)
            np.add.at(self.check, at, check)
        return self

    def totals(self) -> np.ndarray:
        """How many digests each sketch holds."""
        return np.bincount(self.owner, self.count, len(self.size)).astype(np.int64) // TABLES

    def folded(self, which: np.ndarray, size: np.ndarray) -> Sketches:
        """The sketches numbered ``which``, each folded to ``size`` cells a subtable, at most its own."""
        out = Sketches(size)
        n = self.size[which] * TABLES
        to = np.repeat(np.arange(len(which)), n)
        cell = np.arange(len(to)) - np.repeat(np.cumsum(n) - n, n)
        own, new, at = self.size[which][to], out.size[to], self.start[which][to] + cell
        into = out.start[to] + cell // own * new + (cell % own & new - 1)
        for mine, theirs in ((out.count, self.count), (out.key, self.key), (out.check, self.check)):
            np.add.at(mine, into, theirs[at])
        return out

    def minus(self, other: Sketches) -> Sketches:
        """Without the digests of ``other``, sketches of the same sizes."""
        self.count -= other.count
        self.key -= other.key
        self.check -= other.check
        return self

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Empty the sketches: recovered digests, their texts and signs, and which texts got stuck."""
        found: list[tuple] = []
        while True:
            before = len(found)
            for k in range(TABLES):  # a digest has one cell in a subtable, so none is taken twice
                at = np.flatnonzero((np.abs(self.count) == 1) & (self.table == k))
                sign = self.count[at]
                wide = sign.astype(np.int64).astype(np.uint64)
                d = self.key[at] * wide
                pure = check_value(d) == self.check[at] * wide.astype(np.uint32)
                if pure.any():
                    d, owner, sign = d[pure], self.owner[at[pure]], sign[pure]
                    self.add(d, owner, -sign)
                    found.append((d, owner, sign))
            if len(found) == before:
                break
        left = np.zeros(len(self.size), bool)
        left[self.owner[(self.count != 0) | (self.key != 0) | (self.check != 0)]] = True
        cat = lambda i, kind: np.concatenate([f[i] for f in found]) if found else np.empty(0, kind)
        return cat(0, np.uint64), cat(1, np.int64), cat(2, np.int32), left


def _power(n: np.ndarray) -> np.ndarray:
    return np.maximum(LEAST, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))


def sketches(d: np.ndarray, owner: np.ndarray, n_texts: int) -> Sketches:
    """The sketch of each text, of the smallest size that peels by itself."""
    size = _power(np.bincount(owner, minlength=n_texts) / 2)
    todo = np.arange(n_texts)
    while len(todo):  # retry larger until a sketch peels by itself
        place = np.full(n_texts, -1)
        place[todo] = np.arange(len(todo))
        mine = place[owner] >= 0
        stuck = Sketches(size[todo]).add(d[mine], place[owner[mine]]).peel()[3]
        todo = todo[stuck]
        size[todo] *= 2
    return Sketches(size).add(d, owner)


def encode(s: Sketches) -> list[str]:
    """Fingerprints: number of digests, then the cells in base64."""
    return [f"{n}:" + base64.b64encode(s.count[a:b].astype("<i4").tobytes() + s.key[a:b].astype("<u8").tobytes()
                                       + s.check[a:b].astype("<u4").tobytes()).decode()
            for n, a, b in zip(s.totals(), s.start[:-1], s.start[1:])]


def decode(fingerprints: list[str]) -> Sketches:
    """The sketches behind fingerprints."""
    raw = [base64.b64decode(f.partition(":")[2]) for f in fingerprints]
    s = Sketches(np.array([len(r) // (16 * TABLES) for r in raw]))
    for r, a, b in zip(raw, s.start[:-1], s.start[1:]):
        n = b - a
        s.count[a:b], s.key[a:b], s.check[a:b] = np.frombuffer(r, "<i4", n), np.frombuffer(r, "<u8", n, 4 * n), np.frombuffer(r, "<u4", n, 12 * n)
    return s


def fingerprints(d: np.ndarray, owner: np.ndarray, n_texts: int) -> list[str]:
    """The fingerprint of each text."""
    return encode(sketches(d, owner, n_texts))


def differences(a: Sketches, i: np.ndarray, b: Sketches, j: np.ndarray) -> np.ndarray:
    """How many digests sketch ``i`` of ``a`` and sketch ``j`` of ``b`` differ in, for each pair of them."""
    out, todo = np.zeros(len(i), np.int64), np.arange(len(i))
    most = np.minimum(a.size[i], b.size[j])
    size = np.minimum(most, LEAST * 2)
    full = [todo[:0]]  # pairs whose difference the smaller fingerprint cannot hold
    while len(todo):
        _, owner, _, stuck = a.folded(i[todo], size[todo]).minus(b.folded(j[todo], size[todo])).peel()
        out[todo] = np.bincount(owner, minlength=len(todo))
        todo = todo[stuck]
        full.append(todo[size[todo] == most[todo]])
        todo = todo[size[todo] < most[todo]]
        size[todo] *= 2
    todo = np.concatenate(full)
    if len(todo):
        (d, x, _, _), (e, y, _, _) = a.folded(i[todo], a.size[i[todo]]).peel(), b.folded(j[todo], b.size[j[todo]]).peel()
        size, left = most[todo] * 2, np.arange(len(todo))
        while len(left):
            place = np.full(len(todo), -1)
            place[left] = np.arange(len(left))
            mine, theirs = place[x] >= 0, place[y] >= 0
            both = Sketches(size[left]).add(d[mine], place[x[mine]]).add(e[theirs], place[y[theirs]], -1)
            _, owner, _, stuck = both.peel()
            out[todo[left]] = np.bincount(owner, minlength=len(left))
            left = left[stuck]
            size[left] *= 2
    return out


def likeness(n_a: np.ndarray, n_b: np.ndarray, differing: np.ndarray) -> np.ndarray:
    return np.where(n_a + n_b == 0, 1.0, (n_a + n_b - differing) / np.maximum(n_a + n_b + differing, 1))


def recover(fingerprint: str) -> np.ndarray:
    """The digests behind one fingerprint, sorted."""
    found, _, sign, stuck = decode([fingerprint]).peel()
    if stuck.any() or (sign < 0).any():
        raise ValueError("not a fingerprint")
    return np.sort(found)


def fingerprint_likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, from the strings alone."""
    s = decode([a, b])
    n, i, j = s.totals(), np.array([0]), np.array([1])
    return float(likeness(n[i], n[j], differences(s, i, s, j))[0])


def _order(docs: DataFrame) -> DataFrame:
    """``key, tie, text, doc_id``: documents follow one another by ``(key, tie, text)``."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), "text", "doc_id")


def range_starts(docs: DataFrame) -> np.ndarray:
    """The least ``(key, tie)`` of each range, sorted, as an array of two columns; empty for an empty table.  Ranges
    are those of Spark's range partitioning of the pairs alone, a pair standing there as many times as its
    text is long, so they hold about ``RANGE_CHARS`` wherever the ids lie.  At most ``RANGES`` rows."""
    keys = _order(docs).select("key", "tie", (F.coalesce(F.length("text"), F.lit(0)) + ROW_CHARS).cast("long").alias("weight"))
    rows, weight = keys.agg(F.count("*"), F.sum("weight")).first()
    if not rows:
        return np.empty((0, 2), np.int64)
    n = min(RANGES, max(1, -(-weight // RANGE_CHARS)))
    share = max(1, weight // rows)
    weighed = keys.select("key", "tie", F.explode(F.sequence(F.lit(0), F.floor(F.col("weight") / F.lit(share)))))  # at most 2-3 a row on average
    parts = weighed.select("key", "tie").repartitionByRange(n, "key", "tie")
    firsts = parts.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("key", "tie")).alias("first")).collect()
    return np.array(sorted(tuple(r["first"]) for r in firsts), np.int64)


def range_numbers(starts: np.ndarray, key: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """The number of the last start that is not above each ``(key, tie)``."""
    low, high = (np.searchsorted(starts[:, 0], key, side) for side in ("left", "right"))
    out = high - 1
    shared = np.flatnonzero(low < high)  # the key starts one or more ranges: the hash tells them apart
    for k in np.unique(key[shared]):
        at = shared[key[shared] == k]
        first, last = low[at[0]], high[at[0]]
        out[at] = first - 1 + np.searchsorted(starts[first:last, 1], tie[at], "right")
    return out


def with_neighbours(docs: DataFrame) -> DataFrame | None:
    """Rows ``range, tail, doc_id, text`` such that, sorted within a range, the next document of every row with
    ``tail`` 0 is the row behind it; the first document of a range is also sent to the end of the range
    before.  One exchange of the texts.  None for an empty table."""
    starts = range_starts(docs)
    if not len(starts):
        return None

    @F.pandas_udf("struct<range:int,first:boolean>")
    def place(key: pd.Series, tie: pd.Series) -> pd.DataFrame:
        key, tie = key.to_numpy(), tie.to_numpy()
        number = range_numbers(starts, key, tie)
        return pd.DataFrame({"range": number.astype(np.int32), "first": (starts[number] == np.stack([key, tie], 1)).all(1)})

    here = _order(docs).withColumn("place", place("key", "tie"))
    own = F.struct(F.col("place.range").alias("range"), F.lit(0).alias("tail"))
    back = F.struct(F.pmod(F.col("place.range") - 1, F.lit(len(starts))).alias("range"), F.lit(1).alias("tail"))
    sent = F.explode(F.when(F.col("place.first"), F.array(own, back)).otherwise(F.array(own)))
    return (here.withColumn("to", sent).select("to.range", "to.tail", "doc_id", "text", "key", "tie").repartition("range")
            .sortWithinPartitions("range", "tail", "key", "tie", "text").drop("key", "tie"))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _fingerprint_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def result(pairs: list[tuple]) -> pa.RecordBatch:
        texts, following = [p[1] for p in pairs], [p[2] for p in pairs]
        edited = [t[: len(t) - len(t) // 4] + f[: len(t) // 4] for t, f in zip(texts, following)]
        each = {t: i for i, t in enumerate(dict.fromkeys([*texts, *edited, *following]))}  # most next texts are texts, too
        own, new, nxt = (np.array([each[t] for t in x]) for x in (texts, edited, following))
        s = sketches(*digests(list(each)), len(each))
        n, code = s.totals(), encode(s)
        return pa.RecordBatch.from_arrays([
            pa.array([p[0] for p in pairs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]),
            pa.array([code[i] for i in own]), pa.array([code[i] for i in new]),
            pa.array(likeness(n[own], n[new], differences(s, own, s, new))),
            pa.array(likeness(n[own], n[nxt], differences(s, own, s, nxt))),
        ], [c.split()[0] for c in RESULT.split(", ")])

    pairs, last = [], None  # last: the range, id and text of the latest row that still needs its next one
    for batch in batches:
        for rng, tail, doc_id, text in zip(*(batch.column(c) for c in ("range", "tail", "doc_id", "text"))):
            rng, tail, text = rng.as_py(), tail.as_py(), text.as_py() or ""
            if last is not None and last[0] == rng:
                pairs.append((last[1], last[2], text))
            last = (rng, doc_id.as_py(), text) if tail == 0 else None
            if len(pairs) >= CHUNK:
                yield result(pairs)
                pairs = []
    if pairs:
        yield result(pairs)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they and the next document's are."""
    rows = with_neighbours(docs.select("doc_id", "text"))
    if rows is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(_fingerprint_pairs, RESULT)


def op4_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read(spark, sf_dir, "documents"))
