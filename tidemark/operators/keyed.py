"""Keyed aggregation without windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.measures import Measure, running
from tidemark.operators.stretches import TARGET_ROWS


def key_by(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Bring everything with the same key into one task.

    Meant for pre-aggregated state (see ``partial_by_task``): raw rows of a hot key would all land
    in that task too.
    """
    if partitions is None:
        return df.repartition(*keys)
    return df.repartition(partitions, *keys)


def partial_by_task(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """One row per key and reading task, so that a key has at most as many rows as there are tasks."""
    task = F.spark_partition_id().alias("_task")
    return df.groupBy(*keys, task).agg(*[a.alias(n) for n, a in aggregates.items()]).drop("_task")


def colocation(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """Rows of each key, and over how many tasks its state is spread after keying (always 1)."""
    keyed = key_by(partial_by_task(df, keys, n=F.count("*")), keys, partitions)
    placed = keyed.withColumn("_task", F.spark_partition_id())
    return placed.groupBy(*keys).agg(
        F.size(F.collect_set("_task")).cast("long").alias("partitions"), F.sum("n").alias("n")
    )


def keyed_sum(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Final sum per key: summed in the reading tasks, then across them."""
    return df.groupBy(*keys).agg(F.sum(value).alias(value))


def keyed_aggregate(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum and count as the accumulator; the whole-number mean is drawn from it (floored)."""
    held = df.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    return held.withColumn("mean", floor_div(F.col("total"), F.col("n")))


def floor_div(total: Column, n: Column) -> Column:
    """Exact for whole numbers of either sign, unlike a division of doubles; null for no rows."""
    n = F.nullif(n, F.lit(0).cast("long"))
    return F.call_function("div", total - F.pmod(total, n), n)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """The sum so far, once per input row."""
    return running(df, keys, order, {out: Measure("sum", F.col(value))}, target_rows=target_rows)


def running_reduce(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Measure],
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """A reduce whose fields are sums, counts, minima, maxima or first values, once per input row."""
    return running(df, keys, order, measures, target_rows=target_rows)


def count_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    length: int,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Windows of ``length`` consecutive elements of a key; the unfinished last one is flagged."""
    numbered = running(df, keys, order, {"_nth": Measure("count", F.lit(1))}, target_rows=target_rows)
    window = F.call_function("div", F.col("_nth") - 1, F.lit(length).cast("long")).alias("window_no")
    return (
        numbered.groupBy(*keys, window)
        .agg(F.sum(value).alias(value), F.count("*").alias("_n"))
        .withColumn("complete", F.col("_n") == length)
        .drop("_n")
    )
