"""Tables that carry state from one batch to the next.

Batch N reads what earlier batches wrote and overwrites only what is its own, so a batch that is
run again after a failure gives the same result. Folders are used in turns, so state that is no
longer needed is overwritten. ``commits/batch=N`` is written last and marks the batch as done;
readers take only batches up to the newest mark.

State has a row per key and is kept as changes: a batch writes the keys it touched, and now and
then all of them. Keys that have come to an end are told by a condition on their columns, which
readers and full writes apply; nothing is written for them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.sizes import fits_broadcast
from tidemark.operators.stretches import same_keys

# Batches from one full write of keyed state to the next.
SNAPSHOT_EVERY = 16
# Keys of a batch that are broadcast to look up their state; more are joined by shuffle.
BROADCAST_KEYS = 500_000
VERSION = "_version"

COMMIT = "done_batch BIGINT, max_ts BIGINT"


def write_batch(df: DataFrame, root: str, table: str, batch: int) -> None:
    """Results of one batch."""
    df.write.mode("overwrite").parquet(f"{root}/{table}/batch={batch}")


def _keyed_path(root: str, table: str, batch: int) -> str:
    return f"{root}/{table}/part={batch % (2 * SNAPSHOT_EVERY)}"


def _versions(spark: SparkSession, root: str, table: str, batch: int, schema: StructType) -> DataFrame:
    """The last full write and the changes after it, up to ``batch``."""
    numbers = range(batch - batch % SNAPSHOT_EVERY, batch + 1)
    parts = [
        spark.read.schema(schema).parquet(_keyed_path(root, table, n)).withColumn(VERSION, F.lit(n)) for n in numbers
    ]
    return reduce(DataFrame.unionByName, parts)


def _newest(versions: DataFrame, keys: Sequence[str], schema: StructType) -> DataFrame:
    values = [f.name for f in schema if f.name not in keys]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*values), VERSION).alias("_newest"))
    return newest.select(*keys, *[F.col(f"_newest.{v}").alias(v) for v in values])


def read_keyed(
    spark: SparkSession,
    root: str,
    table: str,
    batch: int,
    schema: StructType,
    keys: Sequence[str],
    touched: DataFrame,
    alive: Column | None = None,
    also: Column | None = None,
) -> DataFrame:
    """The state after ``batch`` of the keys in ``touched``, which has one row per key, and of those ``also``.

    The rest of the state is only scanned, without what is not ``alive``.
    """
    wanted = touched.select(*[F.col(k).alias(f"_wanted_{k}") for k in keys])
    wanted = F.broadcast(wanted) if fits_broadcast(wanted, BROADCAST_KEYS) else wanted
    held = _versions(spark, root, table, batch, schema)
    held = held if alive is None else held.where(alive)
    same = same_keys(keys, "_wanted_")
    if also is None:
        return _newest(held.join(wanted, same, "left_semi"), keys, schema)
    rest = held.where(~also).join(wanted, same, "left_semi")
    return _newest(held.where(also).unionByName(rest), keys, schema)


def read_all_keyed(
    spark: SparkSession, root: str, table: str, schema: StructType, keys: Sequence[str], alive: Column | None = None
) -> DataFrame:
    """The state of all keys after the newest finished batch."""
    last = last_commit(spark, root)
    if last is None:
        return spark.createDataFrame([], schema)
    held = _versions(spark, root, table, last, schema)
    return _newest(held if alive is None else held.where(alive), keys, schema)


def write_keyed(
    changed: DataFrame,
    root: str,
    table: str,
    batch: int,
    keys: Sequence[str],
    alive: Column | None = None,
    by: str | None = None,
) -> None:
    """Write the state of the keys a batch changed, or of all keys if a full write is due.

    A full write leaves out what is not ``alive``. The files are laid out by ranges of the column
    ``by``, so that conditions on it skip most of them.
    """
    if batch > 0 and batch % SNAPSHOT_EVERY == 0:
        held = _versions(changed.sparkSession, root, table, batch - 1, changed.schema)
        held = held if alive is None else held.where(alive)
        changed = _newest(held.unionByName(changed.withColumn(VERSION, F.lit(batch))), keys, changed.schema)
        changed = changed if alive is None else changed.where(alive)
    if by is not None:
        changed = changed.repartitionByRange(by).sortWithinPartitions(by)
    changed.write.mode("overwrite").parquet(_keyed_path(root, table, batch))


def commit(spark: SparkSession, root: str, batch: int, max_ts: int | None = None) -> None:
    mark = spark.range(1).coalesce(1).select(
        F.lit(batch).cast("long").alias("done_batch"), F.lit(max_ts).cast("long").alias("max_ts")
    )
    mark.write.mode("overwrite").parquet(f"{root}/commits/batch={batch}")


def read_commit(spark: SparkSession, root: str, batch: int):
    """The mark of one batch. A missing one is an error: its state cannot be trusted."""
    return spark.read.schema(COMMIT).parquet(f"{root}/commits/batch={batch}").first()


def last_commit(spark: SparkSession, root: str) -> int | None:
    """The newest finished batch, or None before the first."""
    try:
        marks = spark.read.schema(COMMIT).parquet(f"{root}/commits")
    except AnalysisException:
        return None
    return marks.agg(F.max("done_batch")).first()[0]


def read_batches(spark: SparkSession, root: str, table: str, schema: StructType) -> DataFrame:
    """The results of all finished batches, with their batch number."""
    last = last_commit(spark, root)
    with_batch = StructType([*schema.fields, StructField("batch", LongType())])
    if last is None:
        return spark.createDataFrame([], with_batch)
    return spark.read.schema(with_batch).parquet(f"{root}/{table}").where(F.col("batch") <= last)


