"""Embedding whitening on MLlib's distributed block matrices.

Vectors become whole numbers ``x = floor(1024 * c) + 100000``, so counts, sums and distances from the mean are
exact.  The centred rows are numbered from 0 without gaps and dealt into a ``BlockMatrix``; its transpose
times itself is the scatter matrix, whose eigenvectors (``eigh`` of one dimension x dimension matrix on the
driver), over the roots of the eigenvalues, make the whitening matrix; a second block product projects
the rows.  The product's middle dimension is cut so that a task multiplies ``TASK_BLOCKS`` blocks; a block has at
most ``BLOCK_BYTES``.  The driver sees one count for each partition of the input, block coordinates, and matrices
of the dimension's size.

Defined cases: a vector that is null, of another length than the commonest, or with an entry that is null,
not finite or at least 2**30 in size (whose ``x`` would not be exact) is dropped; rows that repeat an id are
rows of their own; a null id is kept; ``deviation`` is null where it does not fit a long; a component whose
eigenvalue is nothing but rounding (``NOISE`` of the largest) is left out, so equal vectors give no rows;
nothing left gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspark.llm.common import materialise, read

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK_ROWS, BLOCKS, BLOCK_BYTES = 1024, 1024, 32 << 20
TASK_BLOCKS = 4
NOISE = 1e-11
#: The number of a row within its partition, in ``monotonically_increasing_id``.
ROW_BITS = 33


def whole_vectors(table: DataFrame) -> DataFrame:
    """``vec_id, x, part, nth``: the vectors that take part as whole numbers, numbered within partitions."""
    v = F.col("embedding")
    usable = ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= float(2**30)))
    rows = table.where(v.isNotNull() & (F.size(v) > 0) & usable).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    number = F.monotonically_increasing_id()
    return rows.where(F.size("v") == (common["n"] if common else 0)).select(
        "vec_id", F.transform("v", lambda c: F.floor(c.cast("double") * SCALE) + SHIFT).alias("x"), number.alias("number")
    ).select("vec_id", "x", F.shiftright("number", ROW_BITS).alias("part"), F.col("number").bitwiseAND(2**ROW_BITS - 1).alias("nth"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``row``, from 0 without gaps, in place of ``part`` and ``nth``."""
    parts = sorted((r["part"], r["rows"]) for r in rows.groupBy("part").agg(F.count("*").alias("rows")).collect())
    first = np.concatenate([[0], np.cumsum([n for _, n in parts])])
    starts = rows.sparkSession.createDataFrame([(p, int(at)) for (p, _), at in zip(parts, first)], "part long, first long")
    # a row for each partition of the input
    return rows.join(F.broadcast(starts), "part").withColumn("row", F.col("first") + F.col("nth")).drop("part", "nth", "first")


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are, and the exact sum of each dimension."""
    each = rows.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(
        F.count("*").alias("n"), F.sum(F.col("c").cast("decimal(20,0)")).alias("s")).orderBy("at").collect()
    return (each[0]["n"], [int(r["s"]) for r in each]) if each else (0, [])


def distances(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """The exact ``n*x - s``, as Python integers where 64 bits might not do."""
    if int(np.abs(x).max()) * n + max(map(abs, s)) < 2**62:
        return x * n - np.array(s, np.int64)
    return x.astype(object) * n - np.array(s, object)


def deviations(d: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row, None beyond a long."""
    most = max(abs(int(d.max())), abs(int(d.min())))
    squares = (d.astype(object) if d.dtype == object or most * most * d.shape[1] >= 2**63 else d) ** 2
    return [t if t < 2**63 else None for t in map(int, squares.sum(axis=1))]


def centred(rows: DataFrame, n: int, s: list[int]) -> DataFrame:
    """``row, v`` (the vector less the mean, rounded once) of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                v = distances(matrix(b.column("x")), n, s).astype(float) / n
                ends = pa.array(np.arange(len(b) + 1, dtype=np.int32) * len(s))
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.ListArray.from_arrays(ends, pa.array(v.ravel()))], ["row", "v"])

    return rows.select("row", "x").mapInArrow(run, "row long, v array<double>")


def measured(rows: DataFrame, n: int, s: list[int]) -> DataFrame:
    """``row, vec_id, deviation`` of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                out = deviations(distances(matrix(b.column("x")), n, s))
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec_id"), pa.array(out, pa.int64())], ["row", "vec_id", "deviation"])

    return rows.select("row", "vec_id", "x").mapInArrow(run, "row long, vec_id long, deviation long")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def block_matrix(rows: DataFrame, n: int, dim: int) -> BlockMatrix:
    """``rows`` (``row, v``) as blocks as wide as a row."""
    per_block = min(max(BLOCK_ROWS, -(-n // BLOCKS)), max(BLOCK_ROWS, BLOCK_BYTES // (8 * dim)))
    indexed = rows.select(F.col("row").alias("index"), array_to_vector("v").alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(indexed, "vector"), n, dim).toBlockMatrix(per_block, dim)


def product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left * right`` with the middle dimension dealt to ``splits`` tasks: Python's ``multiply`` lacks this
    argument of the Scala method, and without it all blocks of a row and column meet in one task."""
    done = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(done, left.rowsPerBlock, right.colsPerBlock)


def scatter(x: BlockMatrix) -> np.ndarray:
    """The rows' transposed product with themselves."""
    got = product(x.transpose(), x, max(1, x.numRowBlocks // TASK_BLOCKS)).toLocalMatrix().toArray()
    return (got + got.T) / 2


def components(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and their unit vectors in columns, without those that are rounding."""
    e, vectors = np.linalg.eigh(v)
    e, vectors = e[::-1], vectors[:, ::-1]
    kept = min(most, int((e > NOISE * max(e[0], 0)).sum()))
    return e[:kept], vectors[:, :kept]


def identity_error(z: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the covariance of ``z`` (arrays of ``k``) minus the identity."""
    at = lambda i: F.element_at("z", i + 1)
    mean = z.agg(*(F.avg(at(i)).alias(f"m{i}") for i in range(k))).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = z.agg(*(F.sum((at(i) - mean[i]) * (at(j) - mean[j])).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(c / n - (i == j)) for c, (i, j) in zip(got, pairs))


def whiten(table: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """``vec_id, n, deviation, z`` (the whitened row), ``explained`` (each component's share of the variance) and
    ``identity_error`` of every vector that takes part."""
    spark = table.sparkSession
    nothing = spark.createDataFrame([], "vec_id long, n long, deviation long, z array<double>, explained array<double>, identity_error double")
    rows = materialise(whole_vectors(table), "whiten-rows")
    n, s = sums(rows)
    if not n:
        return nothing
    rows = numbered(rows)
    # read five times over; what a lost executor held is built again from the rows
    x = block_matrix(centred(rows, n, s), n, len(s)).persist(StorageLevel.MEMORY_AND_DISK)
    v = scatter(x) / n
    e, vectors = components(v, most)
    if not len(e):
        x._java_matrix_wrapper._java_model.blocks().unpersist(False)
        return nothing
    whitening = Matrices.dense(len(s), len(e), (vectors / np.sqrt(e)).ravel(order="F").tolist())
    w = BlockMatrix(spark.sparkContext.parallelize([((0, 0), whitening)], 1), len(s), len(e), len(s), len(e))
    projected = x.multiply(w).toIndexedRowMatrix()
    z = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model).select(
        F.col("index").alias("row"), vector_to_array("vector").alias("z"))
    z = materialise(z, "whiten-projected")
    x._java_matrix_wrapper._java_model.blocks().unpersist(False)
    error = identity_error(z, n, len(e))
    return measured(rows, n, s).join(z, "row").select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "z",
        F.lit([float(share) for share in e / np.trace(v)]).alias("explained"), F.lit(error).alias("identity_error"))


def op11_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings")).select(
        "vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("z", "explained")).alias("at", "c")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.z").alias("whitened"),
        F.col("c.explained").alias("explained"), "identity_error")
