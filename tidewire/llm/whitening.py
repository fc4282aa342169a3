"""Embedding whitening by distributed block matrices.

1. Entries become whole numbers, so the count and the sums by dimension are exact. Rows get numbers without gaps: what
   a stored partition holds, added up over the partitions before.
2. Centred rows go into the blocks of a ``BlockMatrix``. Its transpose times itself is the scatter matrix; the middle
   dimension is split, so partial products are summed in many tasks and only matrices of dimension x dimension meet.
3. The scatter matrix, whose size has nothing to do with the rows, is decomposed on the driver (``eigh``).
4. The blocks times the whitening matrix (eigenvectors over the root of their eigenvalues) are the projected rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches

#: Numbers in a block of rows (8 bytes each), and columns of a block at most.
BLOCK_NUMBERS, BLOCK_COLUMNS = 1_000_000, 1_024
#: Eigenvalues below this share of the largest are rounding errors of zero: such components do not exist.
NOTHING = 1e-12
RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)
CENTRED = "index long, vec_id long, deviation long, centred array<double>"


@dataclass(frozen=True)
class Whitening:
    """What was fitted: rows, sums by dimension, the eigenvalues taken, the share of each, dimension x components."""

    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    matrix: np.ndarray


def whole_entries(vector: Column) -> Column:
    """Entries as longs: floor(1024 c) + 100000."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * 1024) + F.lit(100_000))


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x): rows whose vector is there and holds finite entries only."""
    entry = F.col(vector)
    broken = F.exists(entry, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    kept = vectors.where(entry.isNotNull() & ~broken & (F.size(entry) > 0))
    return kept.select(F.col(vec_id).cast("long").alias("vec_id"), whole_entries(entry).alias("x"))


def numbered_rows(stored: DataFrame) -> DataFrame:
    """``stored`` (with ``uid`` from ``monotonically_increasing_id``) plus ``index``: 0, 1, 2, … without gaps."""
    part, place = F.shiftright("uid", 33), F.col("uid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # One row per input partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    joined = stored.withColumn("_part", part).join(starts, "_part")
    return joined.withColumn("index", F.col("_start") + place).drop("_part", "_start")


def centre(rows: DataFrame, n: int, sums: np.ndarray) -> DataFrame:
    """Rows less the mean, and the exact sum of (n x - S)² by row."""
    names = [c.split()[0] for c in CENTRED.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            spread = n * x - sums
            # Whole numbers modulo 2^64 are right where the true sum fits a long; where it does not, there is none.
            exact = (spread * spread).sum(axis=1)
            fits = (spread.astype(np.float64) ** 2).sum(axis=1) < 2.0**63
            flat = (spread / n).ravel()
            offsets = np.arange(0, len(flat) + 1, x.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("index"), batch.column("vec_id"), pa.array(exact, mask=~fits),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names
            )

    bounded_batches(rows.sparkSession)
    return rows.select("index", "vec_id", "x").mapInArrow(work, CENTRED)


def block_matrix(centred: DataFrame, n: int, width: int) -> BlockMatrix:
    """Rows in blocks of about :data:`BLOCK_NUMBERS` numbers. Made by the JVM from end to end."""
    vectors = centred.select("index", array_to_vector("centred").alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, width)
    return indexed.toBlockMatrix(max(1, BLOCK_NUMBERS // width), min(width, BLOCK_COLUMNS))


def scatter_matrix(blocks: BlockMatrix, n: int, width: int) -> np.ndarray:
    """Transpose times matrix. Without splits of the middle dimension all blocks of rows would meet in one task."""
    height = max(1, BLOCK_NUMBERS // width)
    splits = max(1, -(-n // height))
    wrapper = blocks._java_matrix_wrapper
    product = wrapper._java_model.transpose().multiply(wrapper._java_model, splits)
    local = product.toLocalMatrix()
    return np.array(local.toArray()).reshape(width, width, order="F")


def decompose(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, shares of the trace, eigenvectors as columns) of the covariance, the largest first."""
    covariance = (scatter + scatter.T) / (2 * n)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > NOTHING * max(values.max(), 0.0)]
    trace = float(np.trace(covariance))
    return values[order], values[order] / (trace or 1.0), axes[:, order]


def project(blocks: BlockMatrix, whitening: Whitening) -> DataFrame:
    """(index, whitened array): the blocks times the whitening matrix."""
    width, taken = whitening.matrix.shape
    step = min(width, BLOCK_COLUMNS)
    local = [
        ((i, 0), Matrices.dense(len(part), taken, part.ravel(order="F").tolist()))
        for i, part in enumerate(whitening.matrix[low : low + step] for low in range(0, width, step))
    ]
    sc = blocks.blocks.context
    factor = BlockMatrix(sc.parallelize(local, len(local)), step, taken, width, taken)
    product = blocks.multiply(factor).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("whitened"))


def identity_error(projected: DataFrame, taken: int) -> float:
    """The largest absolute entry of the projected rows' covariance minus the identity."""
    axis = [F.col("whitened")[i] for i in range(taken)]
    off = [
        F.abs(F.covar_pop(axis[i], axis[j]) - F.lit(1.0 if i == j else 0.0)).alias(f"e{i}_{j}")
        for i in range(taken)
        for j in range(i + 1)
    ]
    return max(projected.agg(*off).first())


def _whiten_width(rows: DataFrame, n: int, width: int, components: int) -> tuple[Whitening, DataFrame] | None:
    """All rows have ``width`` entries."""
    sums = rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("sum")).collect()
    total = np.array([s for _, s in sorted((r["pos"], r["sum"]) for r in sums)], np.int64)
    centred = materialize(centre(numbered_rows(rows), n, total), "centred")
    # Each product looks at the blocks more than once. Blocks of a lost executor are made again from the stored rows.
    blocks = block_matrix(centred, n, width).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        values, explained, axes = decompose(scatter_matrix(blocks, n, width), n, components)
        if not len(values):
            return None
        fitted = Whitening(n, total, values, explained, axes / np.sqrt(values))
        # Stored, as the error is read from it as well.
        projected = materialize(project(blocks, fitted), "projected")
    finally:
        blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)
    return fitted, centred.drop("centred").join(projected, "index")


def whiten(
    vectors: DataFrame, components: int = 8, vec_id: str = "vec_id", vector: str = "embedding"
) -> list[tuple[Whitening, DataFrame]]:
    """What was fitted, and (index, vec_id, deviation, whitened array) of each row it was fitted on.

    Vectors that are NULL, empty, or hold NULL or non-finite entries are left out. Vectors of different lengths
    live in different spaces: each length is fitted by itself, so there is one pair per length (usually one), the
    shortest first. Components without variance are left out: fewer than ``components`` come back if vectors are
    shorter or lie in a smaller space, and no pair at all for a single vector or equal ones. Repeated rows count each
    time, a NULL ``vec_id`` is passed on, an empty table gives an empty list. ``deviation`` is NULL if it does not fit
    a long.
    """
    uid = F.monotonically_increasing_id()
    rows = materialize(usable(vectors, vec_id, vector).withColumn("uid", uid), "whole-entries")
    # One row per length of a vector.
    lengths = sorted((r["width"], r["n"]) for r in rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).collect())
    found = []
    for width, n in lengths:
        own = rows
        if len(lengths) > 1:
            # Row numbers are without gaps only in a table of their own.
            own = materialize(rows.where(F.size("x") == width).select("vec_id", "x", uid.alias("uid")), f"width-{width}")
        found.append(_whiten_width(own, n, width, components))
    return [pair for pair in found if pair]


def whitened_components(vectors: DataFrame, components: int = 8) -> DataFrame:
    """One row per vector and component, numbered from 1; see :func:`whiten` for what is left out."""
    parts = []
    for fitted, rows in whiten(vectors, components):
        error = identity_error(rows, len(fitted.eigenvalues))
        shares = F.array(*[F.lit(float(s)) for s in fitted.explained])
        long = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("pos", "value"))
        parts.append(long.select(
            "vec_id", (F.col("pos") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"),
            "deviation", F.col("value").alias("whitened"), shares[F.col("pos")].alias("explained"),
            F.lit(error).alias("identity_error"),
        ))
    return reduce(DataFrame.unionByName, parts) if parts else vectors.sparkSession.createDataFrame([], RESULT)
