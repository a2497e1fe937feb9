"""Whitening of embeddings with distributed block matrices.

*Integers.* An entry c becomes x = floor(64 c) + 1000000, so sums are exact. The fit list holds each distinct x vector
once (a group-by, reduced before its shuffle: copies cost one row a task, whatever their number).

*Covariance.* Rows of the fit list get consecutive indices from their place in the written partitions, are centred exactly
(whole part of the mean, then its remainder), and become a BlockMatrix of blocks of ``block`` rows. Its transpose times itself is the scatter. The middle
dimension is split, one part for each ``group`` blocks, so no task gets all blocks; partial products are added up.

*Projection.* The scatter (dimensions squared, whatever the number of rows) is decomposed on the driver. The blocks of the
fit list are multiplied by the whitening matrix; a row takes the result of its x vector. The covariance of the whitened
rows is again a product of blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, table

#: x = floor(SCALE * c) + SHIFT
SCALE, SHIFT = 64, 1_000_000
#: Components whose share of the largest eigenvalue is lower have no variance but rounding.
_NONE = 1e-12


@dataclass(frozen=True)
class Fit:
    """Rows of the fit list, sums, eigenvalues (falling) and unit eigenvectors (columns), trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def whole_vectors(embeddings: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """The ``keep`` columns and x, for rows whose vector has entries, none null or not finite. Left out as well: vectors of
    another length than most of them (ties: than the longer), which have no place in one matrix, and those with an entry
    so large (over 2^53) that 64 times it is no exact number."""
    c = F.col(f"`{vector}`").cast("array<double>")
    # (a null or NaN entry compares as null or as larger)
    ok = F.coalesce(F.forall(c, lambda e: F.coalesce(F.abs(e) * SCALE <= 2.0 ** 53, F.lit(False))), F.lit(False))
    x = F.when(ok, F.transform(c, lambda e: F.floor(F.when(F.abs(e) * SCALE <= 2.0 ** 53, e) * SCALE) + SHIFT))
    rows = embeddings.select(*keep, x.alias("x")).where("size(x) > 0")
    lengths = rows.groupBy(F.size("x").alias("d")).count().agg(F.max(F.struct("count", "d"))).first()[0]
    return rows.where(F.size("x") == (lengths.d if lengths else 0))


def fit_list(rows: DataFrame) -> DataFrame:
    """index (0, 1, …) and x of the distinct vectors, written."""
    rank = F.monotonically_increasing_id()  # partition number, then the place in it, in 33 bits
    stored = cut(rows.select("x").distinct().select("x", F.shiftright(rank, 33).alias("part"), rank.bitwiseAND((1 << 33) - 1).alias("at")))
    sizes = sorted((r.part, r["count"]) for r in stored.groupBy("part").count().collect())  # one row a partition
    first = np.cumsum([0] + [n for _, n in sizes]).tolist()
    starts = rows.sparkSession.createDataFrame([(p, f) for (p, _), f in zip(sizes, first)], "part long, first long")
    return stored.join(F.broadcast(starts), "part").select((F.col("first") + F.col("at")).alias("index"), "x")


def _times(left: BlockMatrix, right: BlockMatrix, parts: int) -> BlockMatrix:
    """left times right, the middle dimension in ``parts``: a task multiplies one part, the products are added."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, parts)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def _block_matrix(rows: DataFrame, block: int) -> BlockMatrix:
    """Rows (index, values array<double>) in blocks; vectors of over 1,024 entries take several blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("values").alias("vector")), "vector")
    return IndexedRowMatrix(vectors).toBlockMatrix(block, 1024)


def _parts(n: int, block: int, group: int) -> int:
    return max(1, -(-n // (block * group)))


def _scatter(matrix: BlockMatrix, n: int, block: int, group: int) -> np.ndarray:
    return _times(matrix.transpose(), matrix, _parts(n, block, group)).toLocalMatrix().toArray()


def sums_of(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums of x by dimension."""
    found = rows.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(
        F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n")).orderBy("d").collect()
    return (found[0].n, [int(r.s) for r in found]) if found else (0, [])


def _mean(n: int, sums: list[int]) -> tuple[Column, Column]:
    """Whole parts and remainders (below n) of the means."""
    return tuple(F.array(*[F.lit(v).cast("long") for v in part]) for part in ([s // n for s in sums], [s % n for s in sums]))


def _centred(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    whole, rest = _mean(n, sums)
    return rows.select("index", F.transform("x", lambda v, d: (
        (v - F.get(whole, d)).cast("double") - F.get(rest, d).cast("double") / n)).alias("values"))


def _deviation(x: Column, n: int, sums: list[int]) -> Column:
    """Sum of (n x - S)^2; null if it is beyond a long."""
    whole, rest = _mean(n, sums)
    away = F.transform(x, lambda v, d: (
        (v - F.get(whole, d)).cast("decimal(19,0)") * F.lit(n).cast("decimal(18,0)") - F.get(rest, d)).try_cast("decimal(18,0)"))
    return F.aggregate(away, F.lit(0).cast("decimal(38,0)"), lambda total, v: (
        total + v * v).cast("decimal(38,0)")).try_cast("long")


def eigen(scatter: np.ndarray, n: int, sums: list[int]) -> Fit:
    """The fit from the scatter of centred rows; components without variance are left out."""
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1]
    order = order[values[order] > max(values.max(), 0) * _NONE]
    return Fit(n, sums, values[order], vectors[:, order], float(np.trace(covariance)))


def whiten(
    embeddings: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",), most: int = 16,
    block: int = 1024, group: int = 8,
) -> DataFrame:
    """For each row with a whole vector the ``keep`` columns, n, deviation (sum of (n x - S)^2, exact; null where it is
    beyond a long), components (array of ``most`` whitened values at most), explained (array) and identity_error.

    Repeated rows get equal results. One distinct vector alone has no variance, hence no components; no rows give none.
    """
    rows = cut(whole_vectors(embeddings, vector, keep))
    fitted = cut(fit_list(rows))
    n, sums = sums_of(fitted)
    if not n:
        return rows.select(*keep, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"), *[
            F.array().cast("array<double>").alias(c) for c in ("components", "explained")],
            F.lit(0.0).alias("identity_error"))
    matrix = _block_matrix(_centred(fitted, n, sums), block)
    found = eigen(_scatter(matrix, n, block, group), n, sums)
    weights = found.vectors[:, :most] / np.sqrt(found.values[:most])
    d, k = weights.shape
    error, projected = 0.0, fitted.select("index", F.array().cast("array<double>").alias("components"))
    if k:
        context = rows.sparkSession.sparkContext
        local = BlockMatrix(context.parallelize([
            ((i, 0), DenseMatrix(len(part), k, part.ravel(order="F")))
            for i, part in enumerate(weights[at:at + 1024] for at in range(0, d, 1024))], 1), 1024, 1024, d, k)
        product = _times(matrix, local, 1).toIndexedRowMatrix()
        # the rows as a DataFrame of the JVM: .rows would pass each one through a Python worker
        projected = cut(callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model).select(
            "index", vector_to_array("vector").alias("components")))
        white = _scatter(_block_matrix(projected.withColumnRenamed("components", "values"), block), n, block, group) / n
        error = float(np.abs(white - np.eye(k)).max())
    by_vector = fitted.join(projected, "index").select(F.col("x").alias("_x"), "components")
    # rows of one vector may be a third of all: hashes of the vectors on both sides, so that their partition can be split
    by_vector = by_vector.withColumn("_hash", F.xxhash64("_x"))
    return rows.join(by_vector, (F.xxhash64("x") == F.col("_hash")) & (F.col("x") == F.col("_x"))).select(
        *[F.col(c) for c in keep], F.lit(n).cast("long").alias("n"), _deviation(F.col("x"), n, sums).alias("deviation"), "components",
        F.array(*[F.lit(float(v / found.trace)) for v in found.values[:most]]).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("components").alias("at", "whitened"))
    return found.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                        F.get("explained", "at").alias("explained"), "identity_error")
