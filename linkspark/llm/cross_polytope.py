"""Near-duplicate vectors by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform; the hash is the nearest
corner of the cross-polytope: the number and sign of its largest coordinate.  ``width`` hashes and the label make a bucket.
In each table a vector lies in its own bucket and also probes the buckets in which the hashes nearest to a tie
take their second corner.  Two vectors are candidates where one lies in a bucket that the other lies in or
probes; every candidate pair is verified by its cosine in double precision.

``width`` follows from the number of vectors, so that buckets stay small.  The number of tables follows from a
simulation: random pairs at exactly the least cosine are hashed, and tables are added until ``TARGET`` of
them meet.  Neither depends on the vectors, and pairs above the least cosine meet more often.

Vectors that are equal in label and every component are one class from the start.  Only bucket numbers are
exchanged at first; vectors go to buckets in which a pair can meet.  A bucket is dealt out in blocks of about
``BLOCK`` vectors and each two blocks meet in a group of their own, so a bucket with a third of all vectors is
spread over many tasks.  A group passes on no pairs, only each vector's number of links and one vector it hangs
together with; a pair that meets in several buckets counts in the one with the smallest number.  All pairs of a
family of near copies are links, each of which is verified, so a family costs the square of its different vectors
in products, though not in rows.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component, or whose label is null, links with
nothing; vectors of different lengths never link; rows that repeat an id are vectors of their own; a null id is a
row like any other, and a component of null ids alone has a null ``component_id``; ``kept`` is whether the two are
equal, nulls included; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspark.llm.common import drop_materialised, materialise, read
from linkspark.llm.jaccard_join import components
from linkspark.llm.text_features import mix

LEAST = 0.98
TARGET, TRIALS, TRIAL_PAIRS, MOST_TABLES = 0.998, 4096, 256, 64
PROBES, ROUNDS = 3, 3
#: ``width`` is the least with so many vectors to a bucket at most, were they spread evenly over directions.
BUCKET_ROWS = 1
BLOCK, CHUNK = 2048, 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row, whose length is a power of two."""
    rows, n = x.shape
    half = 1
    while half < n:
        pair = x.reshape(rows, n // (2 * half), 2, half)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(rows, n)
        half *= 2
    return x / np.sqrt(n)


@dataclass
class Hashes:
    """``tables`` tables of ``width`` hashes of vectors with ``dim`` components."""

    dim: int
    width: int
    tables: int
    seed: int = 13

    def signs(self, table: int) -> np.ndarray:
        return np.random.default_rng((self.seed, self.dim, table)).choice([-1.0, 1.0], (self.width, ROUNDS, self.padded))

    @property
    def padded(self) -> int:
        return 1 << max(0, (self.dim - 1).bit_length())

    def buckets(self, x: np.ndarray, table: int, probes: int = PROBES) -> np.ndarray:
        """For each row its own bucket and the probed ones, as numbers that name the table, too."""
        first, second, gap = (np.empty((len(x), self.width), t) for t in (np.uint64, np.uint64, float))
        rows, wide = np.arange(len(x)), np.zeros((len(x), self.padded))
        for k, rounds in enumerate(self.signs(table)):
            wide[:, : x.shape[1]] = x
            turned = wide
            for signs in rounds:
                turned = hadamard(turned * signs)
            size = np.abs(turned)
            best = size.argmax(axis=1)
            top = size[rows, best]
            size[rows, best] = -1
            other = size.argmax(axis=1)
            gap[:, k] = top - np.maximum(size[rows, other], 0)
            for corner, at in ((first, best), (second, other)):
                corner[:, k] = (2 * at + (turned[rows, at] > 0)).astype(np.uint64)
        swaps = np.array(list(product((0, 1), repeat=self.width)), bool)[1:]  # which hashes take their second corner
        order = np.argsort((gap**2) @ swaps.T, axis=1, kind="stable")[:, :probes]
        out = [first, *(np.where(swaps[order[:, p]], second, first) for p in range(order.shape[1]))]
        number = np.full((len(x), len(out)), table + 1, np.uint64)
        for k in range(self.width):
            number = mix(number * np.uint64(4 * self.padded) + np.stack([c[:, k] for c in out], axis=1))
        return number


def pairs_at(cosine: float, dim: int, n: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """``n`` random pairs of unit vectors at this cosine."""
    a, b = rng.normal(size=(2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    norm = np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + (1 - cosine**2) ** 0.5 * b / np.where(norm > 1e-9, norm, 1)


def plan(dim: int, n: int, least: float = LEAST, target: float = TARGET) -> Hashes:
    """The hashes for ``n`` vectors of ``dim`` components."""
    h = Hashes(dim, 1, 0)
    while h.width < 4 and n > BUCKET_ROWS * (2 * h.padded) ** h.width:
        h.width += 1
    met = np.zeros((TRIALS // TRIAL_PAIRS, TRIAL_PAIRS), bool)
    while h.tables < MOST_TABLES and met.mean() < target:
        for at, row in enumerate(met):
            a, b = pairs_at(least, dim, TRIAL_PAIRS, np.random.default_rng((at, dim)))
            of_a, of_b = h.buckets(a, h.tables), h.buckets(b, h.tables)
            row |= (of_a == of_b[:, :1]).any(axis=1) | (of_b == of_a[:, :1]).any(axis=1)
        h.tables += 1
    return h


def unit(column: pa.Array) -> np.ndarray:
    """The vectors (all of one length) at length 1; scaled first, so that no square overflows or vanishes."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def classes(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows, ``vec_id, same`` (null where the row links with nothing), and the classes of equal rows,
    ``same, cid, label, copies, v``; both tables are written."""
    v, label = F.col("embedding"), F.col("label")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # + 0 makes -0.0 equal to 0.0
    usable = label.isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                        F.when(usable, F.transform(v, lambda x: x + F.lit(0).cast("float"))).alias("v"))
    kind = rows.schema["v"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column("v")
            flat, ends = values.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.array(values.value_lengths().fill_null(0)))
            out = [hashlib.blake2b(flat[end - n: end].tobytes(), digest_size=16, key=str(label).encode()).digest() if n else None
                   for end, n, label in zip(ends, values.value_lengths().to_pylist(), b.column("label").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], ["vec_id", "label", "v", "same"])

    rows = materialise(rows.mapInArrow(digest, f"vec_id long, label long, v {kind}, same binary"), "polytope-rows")
    number = materialise(rows.where(F.col("same").isNotNull()).groupBy("same").agg(
        F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v")).withColumn(
        "cid", F.monotonically_increasing_id()), "polytope-classes")
    return rows, number


def entries(each: DataFrame, hashes: dict[int, Hashes]) -> DataFrame:
    """``cid, bucket, home``: each class's own and probed buckets in all tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array(batch.column("v").value_lengths())
            for dim in np.unique(size):
                rows = batch.filter(pa.array(size == dim))
                for at in range(0, len(rows), 1024):
                    b, h = rows.slice(at, 1024), hashes[int(dim)]
                    x, salt = unit(b.column("v")), b.column("label").to_numpy().astype(np.uint64) * np.uint64(2**16) + np.uint64(dim)
                    for table in range(h.tables):
                        bucket = mix(h.buckets(x, table) ^ mix(salt)[:, None])
                        home = np.zeros(bucket.shape, bool)
                        home[:, 0] = True
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(b.column("cid").to_numpy(), bucket.shape[1])), pa.array(bucket.view(np.int64).ravel()),
                             pa.array(home.ravel())], ["cid", "bucket", "home"])

    return each.select("cid", "label", "v").mapInArrow(run, "cid long, bucket long, home boolean")


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` vertices the smallest one that the edges join it to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def meet(group: pa.Table, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``cid, links, root`` of one group: two blocks of a bucket, or one with itself."""
    bucket, i, j = (group[c][0].as_py() for c in ("bucket", "i", "j"))
    cid, copies, home, block = (group[c].to_numpy() for c in ("cid", "copies", "home", "block"))
    x = unit(group["v"].combine_chunks())
    # a class's other entries: its own buckets, and all
    homes, all_ = (group[c].combine_chunks() for c in ("homes", "buckets"))
    homes, all_ = (c.flatten().to_numpy().reshape(len(group), -1) for c in (homes, all_))
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    links, ends = np.zeros(len(group), np.int64), []
    for at in range(0, len(left), CHUNK):
        p = left[at: at + CHUNK]
        a, b = np.nonzero(x[p] @ x[right].T >= least)
        a, b = p[a], right[b]
        ok = (home[a] | home[b]) & ((a < b) if i == j else True)
        a, b = a[ok], b[ok]
        for lo in range(0, len(a), 1 << 16):  # the tests below hold several numbers for each pair
            u, w = a[lo: lo + (1 << 16)], b[lo: lo + (1 << 16)]
            earlier = np.zeros(len(u), bool)
            for one, two in ((u, w), (w, u)):
                for t in range(homes.shape[1]):
                    h = homes[one, t]
                    earlier |= (h < bucket) & (all_[two] == h[:, None]).any(axis=1)
            u, w = u[~earlier], w[~earlier]
            np.add.at(links, u, copies[w])
            np.add.at(links, w, copies[u])
            ends.append((u, w))
    if ends:
        u, w = (np.concatenate(e) for e in zip(*ends))
        joined = roots(len(group), u, w)
        some = np.flatnonzero(links)
        yield cid[some], links[some], cid[joined[some]]


LINKS = "cid long, links long, root long"


def found_links(met: DataFrame, least: float) -> DataFrame:
    """``cid, links, root`` of the groups (bucket, i, j) of ``met``, read in order one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def groups(table: pa.Table) -> Iterator[pa.RecordBatch]:
            keys = np.stack([table[c].to_numpy() for c in ("bucket", "i", "j")])
            cuts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [len(table)]])
            for start, end in zip(cuts[:-1], cuts[1:]):
                if end - start > 1:
                    for cols in meet(table.slice(start, end - start), least):
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["cid", "links", "root"])

        def last_group(b: pa.RecordBatch) -> int:
            same = np.ones(len(b), bool)
            for c in ("bucket", "i", "j"):
                k = b.column(c).to_numpy()
                same &= k == k[-1]
            return int(np.argmax(np.cumsum(~same[::-1]) > 0)) if not same.all() else len(b)

        for batch in batches:
            if not len(batch):
                continue
            if held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in ("bucket", "i", "j")):
                yield from groups(pa.Table.from_batches(held))
                held = []
            tail = last_group(batch)
            if tail < len(batch):
                yield from groups(pa.Table.from_batches([*held, batch.slice(0, len(batch) - tail)]))
                held = []
            held.append(batch.slice(len(batch) - tail))
        if held:
            yield from groups(pa.Table.from_batches(held))

    keys = ("bucket", "i", "j")
    return met.repartition(*keys).sortWithinPartitions(*keys, "cid").mapInArrow(run, LINKS)


def link_counts(table: DataFrame, least: float = LEAST, target: float = TARGET) -> DataFrame:
    """``vec_id, n_links, component_id`` of every row of ``table`` (``vec_id, embedding, label``)."""
    rows, each = classes(table)
    sizes = {r["dim"]: r["n"] for r in each.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}
    hashes = {dim: plan(dim, n, least, target) for dim, n in sizes.items()}
    all_ = materialise(entries(each, hashes), "polytope-entries")
    # buckets in which a pair can meet: somebody lies there, and somebody else lies there or probes it
    shared = all_.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("homes")).where("n > 1 and homes > 0")
    some = materialise(all_.join(shared.select("bucket", "n"), "bucket"), "polytope-shared")
    # what a class brings to each of its buckets: its vector and the shared buckets that it is in; the buckets of
    # its own come first in `buckets`, in all classes alike
    brought = some.groupBy("cid").agg(F.collect_set(F.when(F.col("home"), F.col("bucket"))).alias("homes"),
                                      F.collect_set("bucket").alias("buckets"))
    tables = max((h.tables for h in hashes.values()), default=1)
    fill = lambda c, n: F.slice(F.concat(F.col(c), F.array_repeat(F.lit(2**63 - 1), n)), 1, n).alias(c)
    brought = brought.select("cid", fill("homes", tables), fill("buckets", tables * (1 + PROBES)))
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("cid"), blocks)
    met = some.withColumn("blocks", blocks).withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "cid", "bucket", "home", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    met = met.join(brought, "cid").join(each.select("cid", "copies", "v"), "cid")
    found = materialise(found_links(met, least), "polytope-links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("cid").alias("a"), F.col("root").alias("b")).where("a != b").distinct()
    comp = components(edges).select(F.col("rid").alias("cid"), "comp")
    whole = (rows.select("vec_id", "same").join(each.select("same", "cid", "copies"), "same", "left")
             .join(counts, "cid", "left").join(comp, "cid", "left"))
    whole = materialise(whole.select("vec_id", F.coalesce("comp", "cid").alias("comp"),
                                     F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links")), "polytope-whole")
    drop_materialised([rows, each, all_, some, found])
    least_id = whole.where(F.col("comp").isNotNull()).groupBy("comp").agg(F.min("vec_id").alias("least_id"))
    return whole.join(least_id, "comp", "left").select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"),
        F.when(F.col("comp").isNull(), F.col("vec_id")).otherwise(F.col("least_id")).alias("component_id"))


def op13_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_counts(read(spark, sf_dir, "embeddings")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
