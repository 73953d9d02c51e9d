"""Approximate nearest neighbours by learned partitions.

On a bounded sample (``FIT_ROWS`` vectors in order of a hash of the id) the graph of nearest neighbours is
cut into balanced parts, and a small network with one hidden layer learns which part a vector, and its
neighbours, belong to.  Every row is indexed under its most probable part.  A query is sent to the most
probable parts until their probabilities add up to the mass that found ``TARGET`` of the true neighbours on
the sample, and on to further parts until they hold ``k`` rows besides those of its own id; its candidates are
reranked by the exact inner product in double precision.  The query's
``k``-th best score among the sample's rows in its parts goes along as a floor, so a block of a part passes
on no row that cannot be among the answers.

A part of more than ``SPLIT_ROWS`` rows is divided again in the same way: a sample of its own rows, its own
graph, parts and router, learned in a task.  Rows and queries then go to the leaves, ``MOST_PARTS`` squared at
most, so with twice the rows a query meets leaves of the same size and not larger parts.

Parts are searched in blocks: (part, block of rows, block of queries) groups hold at most about
``BLOCK_ROWS`` rows and ``BLOCK_QUERIES`` queries however large a part gets, so neither a part with a third
of all rows nor many copies of one vector meets in a task.  The driver sees the sample, one count per leaf and the
routers.

Defined cases: vectors that are null, zero, of another length than the commonest, or hold a null or
non-finite component take no part, nor do rows with a null id; a query's own id is no candidate; rows that
repeat an id are separate candidates and one query (the smallest vector); equal scores go by id; with nothing
to search the result is empty; other columns are ignored.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkspark.llm.common import materialise, read

FIT_ROWS, DEGREE, PART_ROWS, MOST_PARTS = 8192, 16, 2048, 256
SPLIT_ROWS = 16 * PART_ROWS
TARGET = 0.95
BLOCK_ROWS, BLOCK_QUERIES = 8192, 4096
HIDDEN, EPOCHS, RATE = 128, 30, 0.05


def nearest(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows with the largest inner product with each row, itself left out."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at: at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at: at + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, n_parts: int, rng: np.random.Generator, slack: float = 1.1) -> np.ndarray:
    """A part for each row: halving along the principal direction, then moves to the part that most
    neighbours (either way) are in, as far as no part outgrows its share by ``slack``."""
    part = np.zeros(len(x), np.int64)
    for _ in range(int(np.log2(n_parts))):
        part *= 2
        for p in np.unique(part):
            rows = np.flatnonzero(part == p)
            centred = x[rows] - x[rows].mean(axis=0)
            direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            part[rows[np.argsort(centred @ direction, kind="stable")[len(rows) // 2:]]] += 1
    most = int(np.ceil(len(x) / n_parts * slack))
    for _ in range(8):
        votes = np.zeros((len(x), n_parts))
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        size, to = np.bincount(part, minlength=n_parts), votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), to] - votes[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[to[i]] < most and rng.random() < 0.7:  # not all at once, or neighbours swap places
                size[part[i]] -= 1
                size[to[i]] += 1
                part[i] = to[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """Part probabilities from one hidden layer; inputs are scaled to unit length."""

    def __init__(self, dim: int, n_parts: int, rng: np.random.Generator):
        self.w1 = rng.normal(0, (2 / dim) ** 0.5, (dim, HIDDEN))
        self.b1, self.b2 = np.zeros(HIDDEN), np.zeros(n_parts)
        self.w2 = rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, n_parts))
        self.mass = 1.0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def learn(self, x: np.ndarray, target: np.ndarray, rng: np.random.Generator) -> None:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        params = [self.w1, self.b1, self.w2, self.b2]
        speed = [np.zeros_like(p) for p in params]
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 64):
                i = order[at: at + 64]
                h = np.maximum(x[i] @ self.w1 + self.b1, 0)
                z = h @ self.w2 + self.b2
                p = np.exp(z - z.max(axis=1, keepdims=True))
                dz = (p / p.sum(axis=1, keepdims=True) - target[i]) / len(i)
                dh = (dz @ self.w2.T) * (h > 0)
                for v, p_, g in zip(speed, params, (x[i].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):
                    v *= 0.9
                    v -= RATE * 10 * (1 - epoch / EPOCHS) * g
                    p_ += v

    def probes(self, x: np.ndarray, held: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, part), each row's most probable parts up to ``mass``, and on until they hold its
        ``least`` rows (``held`` has the rows of each part)."""
        p = self(x)
        order = np.argsort(-p, axis=1, kind="stable")
        sorted_p = np.take_along_axis(p, order, axis=1)
        take = np.cumsum(sorted_p, axis=1) - sorted_p < self.mass
        take |= np.cumsum(held[order], axis=1) - held[order] < least[:, None]
        row, place = np.nonzero(take)
        return row, order[row, place]


class Leaves:
    """The router of the parts and, for each large part, the router of its own parts.  A leaf is a part without
    a router, or a part within a part; leaves are numbered in the order of their parts."""

    def __init__(self, top: Router, below: dict[int, Router]):
        self.top, self.below = top, below
        n = [len(below[p].b2) if p in below else 1 for p in range(len(top.b2))]
        self.start = np.concatenate([[0], np.cumsum(n)])

    def __len__(self) -> int:
        return int(self.start[-1])

    def home(self, x: np.ndarray, part: np.ndarray) -> np.ndarray:
        """The leaf of each row, whose part is known."""
        leaf = self.start[part]
        for p in np.unique(part):
            if p in self.below:
                at = np.flatnonzero(part == p)
                leaf[at] += self.below[p](x[at]).argmax(axis=1)
        return leaf

    def probes(self, x: np.ndarray, held: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, leaf), as ``Router.probes`` has them: first the parts, then the leaves within each."""
        row, part = self.top.probes(x, np.add.reduceat(held, self.start[:-1]), least)
        large = np.isin(part, list(self.below))
        rows, leaves = [row[~large]], [self.start[part[~large]]]
        for p in np.unique(part[large]):
            at = row[part == p]
            r, leaf = self.below[p].probes(x[at], held[self.start[p]: self.start[p + 1]], least[at])
            rows.append(at[r])
            leaves.append(self.start[p] + leaf)
        return np.concatenate(rows), np.concatenate(leaves)


def fit(sample: np.ndarray, n_rows: int, k: int, target: float = TARGET, seed: int = 3, most: int | None = None,
        part_rows: int | None = None) -> Router:
    """A router for ``n_rows`` rows like those of the sample, of at most ``most`` parts of about ``part_rows``."""
    rng = np.random.default_rng(seed)
    n_parts, most, part_rows = 1, most or MOST_PARTS, part_rows or PART_ROWS
    while n_parts < most and n_parts * part_rows < n_rows and n_parts * 2 * 32 <= len(sample):
        n_parts *= 2
    router = Router(sample.shape[1], n_parts, rng)
    if n_parts == 1:
        return router
    graph = nearest(sample, min(DEGREE, len(sample) - 1))
    part = balanced_parts(sample, graph, n_parts, rng)
    near = np.zeros((len(sample), n_parts))
    np.add.at(near, (np.repeat(np.arange(len(sample)), graph.shape[1]), part[graph].ravel()), 0.5 / graph.shape[1])
    near[np.arange(len(sample)), part] += 0.5
    router.learn(sample, near, rng)
    # the least mass that reaches the target on the sample, whose rows lie where the router puts them
    p = router(sample)
    home, asked = p.argmax(axis=1), rng.permutation(len(sample))[:1024]
    truth = nearest(sample, min(k, len(sample) - 1))[asked]
    order = np.argsort(-p[asked], axis=1, kind="stable")
    ranked = np.take_along_axis(p[asked], order, axis=1)
    ahead = np.empty_like(ranked)  # probability of the parts before each part
    np.put_along_axis(ahead, order, np.cumsum(ranked, axis=1) - ranked, axis=1)
    needed = np.sort(np.take_along_axis(ahead, home[truth], axis=1).ravel())
    router.mass = float(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))))]) + 1e-9
    return router


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def valid_vectors(table: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    v = F.col("embedding")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common["n"] if common else 0))


def split(indexed: DataFrame, part_rows: dict[int, int], k: int, target: float) -> dict[int, Router]:
    """A router for each part of ``indexed`` (``part, vec_id, v``) with more than ``SPLIT_ROWS`` rows, learned in a task
    from ``FIT_ROWS`` of its rows.  The driver gets at most ``MOST_PARTS`` of them, of
    ``HIDDEN * (dimensions + MOST_PARTS)`` numbers each."""
    large = {part: n for part, n in part_rows.items() if n > SPLIT_ROWS}
    if not large:
        return {}
    settings = {"target": target, "most": MOST_PARTS, "part_rows": PART_ROWS}
    first = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64("vec_id"), "vec_id"))
    samples = indexed.where(F.col("part").isin(list(large))).withColumn("place", first).where(F.col("place") <= FIT_ROWS)

    def learn(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        return pa.table({"part": pa.array([part], pa.int32()),
                         "router": pa.array([pickle.dumps(fit(_matrix(rows["v"]), large[part], k, **settings))], pa.binary())})

    learned = samples.groupBy("part").applyInArrow(learn, "part int, router binary").collect()
    return {r["part"]: pickle.loads(r["router"]) for r in learned}


FOUND = "query_id long, vec_id long, score double"


def search(rows: DataFrame, queries: DataFrame, k: int, target: float = TARGET) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each of ``queries`` among ``rows``
    (both ``vec_id, v``)."""
    spark = rows.sparkSession
    n_rows = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).toArrow()
    if not n_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    known, known_ids = _matrix(sample["v"]), sample["vec_id"].to_numpy()
    # where the parts themselves will be split, each level may miss only its share
    router = spark.sparkContext.broadcast(fit(known, n_rows, k, target ** 0.5 if n_rows > MOST_PARTS * SPLIT_ROWS else target))
    kind = rows.schema["v"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                part = pa.array(router.value(_matrix(b.column("v"))).argmax(axis=1), pa.int32())
                yield pa.RecordBatch.from_arrays([part, *b.columns], ["part", "vec_id", "v"])

    def counted(df: DataFrame) -> dict[int, int]:
        return {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}

    indexed = materialise(rows.mapInArrow(index, f"part int, vec_id long, v {kind}"), "ann-index")
    part_rows = counted(indexed)
    leaves = spark.sparkContext.broadcast(Leaves(router.value, split(indexed, part_rows, k, target ** 0.5)))
    if leaves.value.below:
        def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if len(b):
                    leaf = leaves.value.home(_matrix(b.column("v")), b.column("part").to_numpy())
                    yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), b.column("vec_id"), b.column("v")], ["part", "vec_id", "v"])

        indexed = materialise(indexed.mapInArrow(refine, f"part int, vec_id long, v {kind}"), "ann-leaves")
        part_rows = counted(indexed)
    homes = leaves.value.home(known, router.value(known).argmax(axis=1))
    known = spark.sparkContext.broadcast((known, known_ids, homes))  # at most FIT_ROWS vectors

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 256):
                c = b.slice(at, 256)
                q, (v, ids, home) = _matrix(c.column("v")), known.value
                row, part = leaves.value.probes(q, held.value, k + c.column("own").to_numpy())
                s = q @ v.T
                asked = np.zeros((len(q), len(leaves.value)), bool)
                asked[row, part] = True
                s[(ids[None, :] == c.column("vec_id").to_numpy()[:, None]) | ~asked[:, home]] = -np.inf
                floor = np.partition(s, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(q), -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), *(c.column(n).take(pa.array(row)) for n in ("vec_id", "v")), pa.array(floor[row])],
                    ["part", "vec_id", "v", "floor"])

    held = spark.sparkContext.broadcast(np.array([part_rows.get(i, 0) for i in range(len(leaves.value))]))
    # the rows of a query's own id are no answers to it, wherever they lie
    own_rows = rows.groupBy("vec_id").agg(F.count("*").alias("own"))
    once = (queries.groupBy("vec_id").agg(F.min("v").alias("v")).join(own_rows, "vec_id", "left")
            .select("vec_id", "v", F.coalesce("own", F.lit(0)).alias("own")))
    routed = materialise(once.mapInArrow(route, f"part int, vec_id long, v {kind}, floor double"), "ann-queries")

    def blocks(part_rows: dict[int, int], most: int):
        n = [max(1, -(-part_rows.get(i, 0) // most)) for i in range(len(leaves.value))]
        return F.get(F.from_json(F.lit(json.dumps(n)), "array<int>"), F.col("part"))  # folded to one literal

    row_blocks, query_blocks = blocks(part_rows, BLOCK_ROWS), blocks(counted(routed), BLOCK_QUERIES)
    every = lambda n: F.explode(F.sequence(F.lit(0), n.cast("int") - 1))
    own = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(17)), n).cast("int")
    left = indexed.withColumn("rb", own(row_blocks)).withColumn("qb", every(query_blocks))
    right = routed.withColumn("rb", every(row_blocks)).withColumn("qb", own(query_blocks))

    def rerank(rows: pa.Table, asked: pa.Table) -> pa.Table:
        q_ids, ids = asked["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(q_ids) and len(ids):
            v, q, floor = _matrix(rows["v"]), _matrix(asked["v"]), asked["floor"].to_numpy()
            longest = np.linalg.norm(v, axis=1).max()
            for at in range(0, len(q), 256):
                s = q[at: at + 256] @ v.T
                s[ids[None, :] == q_ids[at: at + 256, None]] = -np.inf
                kth = np.partition(s, max(len(ids) - k, 0), axis=1)[:, max(len(ids) - k, 0)]
                for i, (line, least) in enumerate(zip(s, np.maximum(kth, floor[at: at + 256])), at):
                    # products of a block differ in the last bits from those of a pair: keep a margin, then rescore
                    c = np.flatnonzero((line > -np.inf) & (line >= least - 1e-12 * longest * np.linalg.norm(q[i])))
                    score = (q[i] * v[c]).sum(axis=1)
                    best = np.lexsort((ids[c], -score))[:k]
                    out.append((np.full(len(best), q_ids[i]), ids[c[best]], score[best]))
        cols = [np.concatenate([o[j] for o in out]) if out else np.empty(0, t) for j, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.table({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})

    keys = ("part", "rb", "qb")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rerank, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_vectors(read(spark, sf_dir, "embeddings"))
    return search(rows, rows.where(F.col("vec_id") % 20 == 0), 20)
