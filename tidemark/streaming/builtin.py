"""Event-time windows by Spark's own streaming aggregate, with those left open given out at the end.

The built-in aggregate decides lateness by batch and drops late rows without a trace; it keeps a
window in its state store until the watermark passes it. What the store still holds when the input
has ended is read back through the state data source, so no row has to be made up to push the
watermark on.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.operators.windows import tumble
from tidemark.streaming.runner import ONE_AGGREGATE, drop_late_at_once, finish, start_files


@contextmanager
def _newest_watermark(spark: SparkSession) -> Iterator[None]:
    """Late rows go by the newest watermark while a stream with one aggregate is started."""
    before = spark.conf.get(ONE_AGGREGATE)
    drop_late_at_once(spark)
    try:
        yield
    finally:
        spark.conf.set(ONE_AGGREGATE, before)


def append_windows(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    aggregates: Mapping[str, Column],
    name: str,
    root: str,
    timeout: float | None = None,
) -> StructType:
    """Run a stream with a watermark to the end of its input; closed windows go to the sink below ``root``.

    Returns the sink's columns. A run on the same ``root`` goes on where the last one ended.
    """
    closed = tumble(stream, ts, size, keys, aggregates)
    with _newest_watermark(stream.sparkSession):
        query = start_files(closed, name, f"{root}/{name}", f"{root}/checkpoint")
        finish(query, timeout)
    return closed.schema


def appended(
    spark: SparkSession, schema: StructType, keys: Sequence[str], name: str, root: str, end_of_input: str = "flush"
) -> DataFrame:
    """Windows closed by the watermark and, with "flush", those in the state store; ``emitted_by`` tells which.

    To be flushed, each aggregate must be kept as one value: a sum of whole numbers, a count, a
    minimum or a maximum.
    """
    if end_of_input not in ("flush", "hold"):
        raise ValueError(f"end_of_input must be 'flush' or 'hold', not {end_of_input!r}")
    closed = spark.read.schema(schema).parquet(f"{root}/{name}").withColumn("emitted_by", F.lit("watermark"))
    if end_of_input == "hold":
        return closed
    held = spark.read.format("statestore").load(f"{root}/checkpoint")
    values = [f for f in schema if f.name not in (*keys, "window_start", "window_end")]
    stored = held.schema["value"].dataType.fields
    if [f.dataType for f in stored] != [f.dataType for f in values]:
        raise TypeError("an aggregate is not kept as one value, so open windows can't be read back")
    # Fields of the store go by their places: keys, then the window; values in the order given.
    of_key = StructType(
        [*[StructField(k, schema[k].dataType) for k in keys], StructField("w", held.schema["key"].dataType.fields[-1].dataType)]
    )
    of_value = StructType([StructField(f.name, f.dataType) for f in values])
    rest = held.select(F.col("key").cast(of_key).alias("k"), F.col("value").cast(of_value).alias("v")).select(
        *[F.col("k")[k].alias(k) for k in keys],
        F.col("k.w.start").alias("window_start"),
        F.col("k.w.end").alias("window_end"),
        *[F.col("v")[f.name].alias(f.name) for f in values],
    )
    return closed.unionByName(rest.withColumn("emitted_by", F.lit("end_of_input")))
