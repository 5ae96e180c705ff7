"""Tumbling windows, aligned to the epoch.

``tumble`` groups by the built-in window of a TIMESTAMP and works on a stream with a watermark.
The other functions take whole-number times (any unit) and do the same by arithmetic.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import order_key, window_end, window_start
from tidemark.operators.folds import Combine, reduce_groups
from tidemark.operators.keyed import floor_div
from tidemark.operators.stretches import TARGET_ROWS, same_keys
from tidemark.session import settle

# Groups whose first arrivals are broadcast.
BROADCAST_GROUPS = 200_000


def tumble(df: DataFrame, ts: str, size: str, keys: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregates per key and window of a timestamp, bounded or streamed."""
    return (
        df.groupBy(*keys, F.window(ts, size).alias("_window"))
        .agg(*[a.alias(n) for n, a in aggregates.items()])
        .select(
            *keys,
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *aggregates,
        )
    )


def with_window(df: DataFrame, ts: str, size: int) -> DataFrame:
    return df.withColumns({"window_start": window_start(ts, size), "window_end": window_end(ts, size)})


def tumbling_sum(df: DataFrame, keys: Sequence[str], ts: str, size: int, value: str) -> DataFrame:
    """Sum per key and window of ``ts``, which may be the event's own time or its arrival."""
    return df.groupBy(*keys, window_start(ts, size).alias("window_start")).agg(F.sum(value).alias(value))


def tumbling_mean(df: DataFrame, keys: Sequence[str], ts: str, size: int, value: str) -> DataFrame:
    """Count and floored whole-number mean per key and window."""
    held = df.groupBy(*keys, window_start(ts, size).alias("window_start")).agg(
        F.count("*").alias("n"), F.sum(value).alias("_total"), F.count(value).alias("_n")
    )
    return held.select(*keys, "window_start", "n", floor_div(F.col("_total"), F.col("_n")).alias("mean"))


def tumbling_reduce(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    size: int,
    value: str,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """Sum per key and window, with the time of the row that arrived first.

    With several order columns the first is aggregated by itself and the others only where it is
    smallest, as a minimum of several at once would sort all rows. More groups than can be
    broadcast take that way after all, sorted in the tasks that read the rows.
    """
    placed = df.withColumn("window_start", window_start(ts, size))
    groups = [*keys, "window_start"]
    plain = placed.groupBy(*groups).agg(F.sum(value).alias(value), F.min_by(ts, order_key(order)).alias(ts))
    if len(order) == 1:
        return plain
    sums = settle(placed.groupBy(*groups).agg(F.sum(value).alias("_sum"), F.min(order[0]).alias("_low")))
    if sums.count() > broadcast_groups:
        return plain
    small = F.broadcast(sums.select(*[F.col(c).alias(f"_of_{c}") for c in groups], "_sum", "_low"))
    tied = placed.join(small, same_keys(groups, "_of_")).where(F.col(order[0]) == F.col("_low"))
    return tied.groupBy(*groups).agg(F.first("_sum").alias(value), F.min_by(ts, order_key(order[1:])).alias(ts))


def tumbling_fold(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    size: int,
    values: Sequence[str],
    fn: Combine,
    target_rows: int = TARGET_ROWS,
    *,
    associative: bool,
) -> DataFrame:
    """A reduce per key and window given as a Python function."""
    placed = df.withColumn("window_start", window_start(ts, size))
    return reduce_groups(placed, [*keys, "window_start"], order, values, fn, target_rows, associative=associative)
