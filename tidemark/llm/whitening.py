"""Whitening of vectors through distributed block matrices.

Centred rows are indexed without gaps and laid out as a BlockMatrix. Its transpose times itself is
the scatter matrix, one small square of which the eigenvectors are found locally. The rows times
the scaled eigenvectors, again a BlockMatrix product, are the whitened rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import written

# Values of a block; a block has as many rows as fit, and as many columns as this at most.
BLOCK_VALUES = 1 << 19
BLOCK_COLUMNS = 256
# Values of both sides that one task of a product holds at once.
SPLIT_VALUES = 1 << 24

OUT = "n long, deviation long, component int, whitened double, explained double, identity_error double"


def _dense(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as a matrix."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _indexed(df: DataFrame, key: str, vector: str, scale: int, shift: int) -> DataFrame:
    """Written table ``key, x, index`` of the rows with a full finite vector, numbered from 0 on."""
    c = F.col(vector)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    x = F.transform(c, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long") + F.lit(shift).cast("long"))
    rows = df.where(c.isNotNull() & ~bad).select(F.col(key).alias("key"), x.alias("x"))
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()))
    # The upper bits of ``at`` are the task that wrote the row, the lower ones its place there.
    place = F.col("at") - F.shiftleft(F.shiftright("at", 33), 33)
    tasks = rows.groupBy(F.shiftright("at", 33).alias("task")).agg(F.count("*").alias("rows"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task that wrote.
    tasks = tasks.select("task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    numbered = rows.join(F.broadcast(tasks), F.shiftright("at", 33) == F.col("task"))
    return numbered.select("key", "x", (F.col("before") + place).alias("index"))


def _sums(rows: DataFrame, width: int, shift: int) -> np.ndarray:
    """The exact sum of every component, of tasks' sums. Missing components count as ``shift``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += (_dense_shifted(batch.column("x"), width, shift)).sum(0)
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(width), pa.int32()), "total": pa.array(total)})

    added = rows.select("x").mapInArrow(add, "place int, total long").groupBy("place").agg(F.sum("total").alias("total"))
    return np.array([r["total"] for r in added.orderBy("place").collect()], np.int64)


def _dense_shifted(column: pa.Array, width: int, shift: int) -> np.ndarray:
    present = np.arange(width)[None, :] < np.diff(column.offsets.to_numpy())[:, None]
    return np.where(present, _dense(column, width), shift)


def _centred(rows: DataFrame, n: int, sums: np.ndarray, shift: int) -> DataFrame:
    """``key, index, values, deviation``: x - S/n from whole numbers, and the sum of (n x - S)**2."""
    width = len(sums)

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _dense_shifted(batch.column("x"), width, shift)
            if len(x) and float(np.abs(x).max()) * n >= 2.0**62:
                raise OverflowError("components are too large for exact whole numbers")
            whole = n * x - sums
            if len(whole) and (whole.astype(float) ** 2).sum(1).max() >= 2.0**63 * (1 - 1e-9):
                raise OverflowError("a deviation is too large for a long")
            flat = pa.array((whole / n).ravel())
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key"),
                    "index": batch.column("index"),
                    "values": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), flat),
                    "deviation": pa.array((whole * whole).sum(1), pa.int64()),
                }
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(centre, f"key {kind}, index long, values array<double>, deviation long")


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left x right, the blocks along the common side dealt to ``splits`` tasks per result block.

    Without the split all blocks of a tall matrix would meet in the task of their one result block.
    """
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def _covariance(blocks: BlockMatrix, n: int, parallel: int) -> np.ndarray:
    """The scatter of centred rows over n, as a local matrix."""
    tall = -(-blocks.numRows() // blocks.rowsPerBlock)
    fits = max(1, SPLIT_VALUES // (2 * blocks.rowsPerBlock * blocks.colsPerBlock))
    splits = min(tall, max(parallel, -(-tall // fits)))
    scatter = _product(blocks.transpose(), blocks, splits).toLocalMatrix().toArray()
    return (scatter + scatter.T) / (2 * n)


def _local_blocks(spark: SparkSession, m: np.ndarray, rows: int, columns: int) -> BlockMatrix:
    """A small local matrix as blocks."""
    parts = [
        ((i // rows, j // columns), Matrices.dense(*p.shape, p.ravel(order="F").tolist()))
        for i in range(0, m.shape[0], rows)
        for j in range(0, m.shape[1], columns)
        for p in [m[i : i + rows, j : j + columns]]
    ]
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), rows, columns, *m.shape)


def whitened(
    df: DataFrame, key: str, vector: str, components: int = 32, scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """Every row on the ``components`` strongest axes, each with unit variance over all rows.

    Columns: the key, n, deviation, component (from 1), whitened, explained, identity_error. A
    component c of a vector counts as floor(scale * c) + shift. Rows without a full finite vector
    are left out; missing components of shorter vectors count as ``shift``, that is as zero. A null
    key is a key like others, and repeated rows each count and each come out. No rows, or vectors
    of no components only, give no rows.

    ``deviation`` is the sum over the components of (n x - S)**2, S being their sums; one over a
    long, or a component too large to be held exactly, is an error. A component whose eigenvalue is
    zero to rounding, as with a single row, is whitened to 0 and is no part of ``identity_error``,
    the largest entry by which the covariance of the whitened rows is off the identity. Each
    eigenvector points so that its largest entry is positive. Columns other than the two named are
    not read.

    A matrix of width x width is held by the driver, so vectors should have some thousand
    components at most. Everything else is in blocks of BLOCK_VALUES.
    """
    spark = df.sparkSession
    rows = _indexed(df, key, vector, scale, shift)
    kind = rows.schema["key"].dataType.simpleString()
    ends = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    n, width = ends["n"], ends["width"] or 0
    if not width:
        return spark.createDataFrame([], f"`{key}` {kind}, {OUT}")
    centred = _centred(rows, n, _sums(rows, width, shift), shift)
    vectors = MLUtils.convertVectorColumnsFromML(
        centred.select("index", array_to_vector("values").alias("vector")), "vector"
    )
    columns = min(width, BLOCK_COLUMNS)
    tall, parallel = max(1, BLOCK_VALUES // columns), spark.sparkContext.defaultParallelism
    blocks = IndexedRowMatrix(vectors, n, width).toBlockMatrix(tall, columns)

    covariance = _covariance(blocks, n, parallel)
    trace = float(np.trace(covariance))
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    spread = values > max(float(values[0]), 0) * width * np.finfo(float).eps
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    scaled = np.where(spread, axes / np.sqrt(np.where(spread, values, 1.0)), 0.0)

    projected = _product(blocks, _local_blocks(spark, scaled, columns, min(scaled.shape[1], BLOCK_COLUMNS)), 1)
    off = np.abs(_covariance(projected, n, parallel) - np.eye(len(values)))[np.ix_(spread, spread)]
    error = float(off.max()) if off.size else 0.0
    explained = np.where(spread, values / trace if trace > 0 else 0.0, 0.0)

    lines = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    lines = lines.select("index", vector_to_array("vector").alias("line"))
    of_component = F.array(*[F.lit(float(e)) for e in explained])
    return (
        centred.select("key", "index", "deviation")
        .join(lines, "index")
        .select("key", "deviation", F.posexplode("line").alias("place", "whitened"))
        .select(
            F.col("key").alias(key),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            (F.col("place") + 1).cast("int").alias("component"),
            "whitened",
            F.get(of_component, F.col("place")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
