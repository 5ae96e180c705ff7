"""Late rows: told apart from the rest row by row, whatever the partitioning.

A row is late if its window was closed before it arrived, that is, if an earlier row had an event
time of at least the window's end plus the bound on disorder. So per window only one fact is
needed: the first arrival that closes it. That is an aggregate over the data and a running minimum
over the windows. No row has to be sorted or shuffled; each looks up its window's closing. With two
order columns the first is aggregated over all rows, the second over those the first leaves tied.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import order_key, window_end, window_start
from tidemark.operators.measures import Measure, Measures, running_over
from tidemark.operators.stretches import MAX_STRETCHES, STRETCH, TARGET_ROWS, Split
from tidemark.session import settle

# Windows whose closings are broadcast: three numbers each, so some tens of megabytes at most.
BROADCAST_WINDOWS = 500_000
# Windows per piece of the running minimum; up to as many need no pieces.
WINDOWS_PER_PIECE = 10_000
FACTS = ("first_row", "last_row", "rows")


@dataclass(frozen=True)
class WindowFacts:
    """Per window its ``rows``, the first and the last to arrive, and ``closed_by``, the arrival that closes it.

    ``closed_by`` is null for windows still open after the last row. There are at most ``bound``
    windows.
    """

    table: DataFrame
    bound: int


def _pairs(placed: DataFrame, order: Sequence[str], broadcast_windows: int) -> tuple[DataFrame, int]:
    """First row, last row and count per window and the window its rows close, and how many there are.

    A minimum of several columns at once would sort the rows. So the first order column is
    aggregated by itself, and the others only where it equals an extreme of its pair. Pairs too
    many to broadcast are found in one pass after all, sorted in the tasks that read the rows.
    """
    groups = ["window_end", "_closes"]
    ends = [F.min(order_key(order)).alias("first_row"), F.max(order_key(order)).alias("last_row")]
    if len(order) == 1:
        pairs = settle(placed.groupBy(*groups).agg(*ends, F.count("*").alias("rows")))
        return pairs, pairs.count()
    counted = settle(
        placed.groupBy(*groups).agg(
            F.min(order[0]).alias("_low"), F.max(order[0]).alias("_high"), F.count("*").alias("rows")
        )
    )
    bound = counted.count()
    if bound > broadcast_windows:
        return settle(placed.groupBy(*groups).agg(*ends, F.count("*").alias("rows"))), bound
    at, rest = F.col(order[0]), order_key(order[1:])
    tied = placed.join(F.broadcast(counted), groups).where((at == F.col("_low")) | (at == F.col("_high")))
    found = tied.groupBy(*groups).agg(
        F.first("_low").alias("_low"),
        F.first("_high").alias("_high"),
        F.first("rows").alias("rows"),
        F.min(F.when(at == F.col("_low"), rest)).alias("_first"),
        F.max(F.when(at == F.col("_high"), rest)).alias("_last"),
    )

    def key(first: str, rest: str) -> Column:
        others = [F.col(rest)] if len(order) == 2 else [F.col(f"{rest}.{c}") for c in order[1:]]
        return F.struct(F.col(first).alias(order[0]), *[o.alias(c) for o, c in zip(others, order[1:])])

    pairs = found.select(
        *groups, key("_low", "_first").alias("first_row"), key("_high", "_last").alias("last_row"), "rows"
    )
    return settle(pairs), bound


def window_facts(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    size: int,
    delay: int,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> WindowFacts:
    """One or two passes over the rows, then a running minimum over the windows.

    A pass leaves two rows per window at most: the rows of one window can close up to two
    different ones. Rows without event time are in no window and close none.
    """
    placed = df.where(F.col(ts).isNotNull()).select(
        window_end(ts, size).alias("window_end"),
        window_start(F.col(ts) - F.lit(delay).cast("long"), size).alias("_closes"),
        *order,
    )
    pairs, bound = _pairs(placed, order, broadcast_windows)
    # Each pair tells about two windows: the one its rows are in and the one they close.
    none = F.lit(None).cast(pairs.schema["first_row"].dataType)
    own = pairs.select("window_end", *FACTS, none.alias("closer"))
    closing = pairs.select(
        F.col("_closes").alias("window_end"),
        none.alias("first_row"),
        none.alias("last_row"),
        F.lit(0).cast("long").alias("rows"),
        F.col("first_row").alias("closer"),
    )
    windows = (
        own.unionByName(closing)
        .where(F.col("window_end").isNotNull())
        .groupBy("window_end")
        .agg(
            F.min("first_row").alias("first_row"),
            F.max("last_row").alias("last_row"),
            F.sum("rows").alias("rows"),
            F.min("closer").alias("closer"),
        )
    )
    return WindowFacts(_closed_by(windows, size, bound).where(F.col("rows") > 0), bound)


def _closed_by(windows: DataFrame, size: int, bound: int) -> DataFrame:
    """Whatever closes a later window closes this one too: a running minimum from the last window on."""
    columns = ["window_end", *FACTS]
    if bound <= WINDOWS_PER_PIECE:
        later = Window.orderBy(F.col("window_end").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return windows.select(*columns, F.min("closer").over(later).alias("closed_by"))
    from_last = windows.withColumn("_from_last", -F.col("window_end"))
    piece = F.lit(size * WINDOWS_PER_PIECE).cast("long")
    number = F.call_function("div", F.col("_from_last") - F.pmod(F.col("_from_last"), piece), piece)
    split = Split(from_last.withColumn(STRETCH, number + F.lit(2**62)), None, True)
    closed = running_over(split, [], ["_from_last"], Measures({"closed_by": Measure("min", F.col("closer"))}))
    return closed.select(*columns, "closed_by")


def late_split(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    size: int,
    delay: int,
    seen: int | None = None,
    broadcast_windows: int = BROADCAST_WINDOWS,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Add the row's window and ``is_late``.

    ``seen`` is the largest event time of earlier input, if this data continues a stream. A row
    without event time has no window and is not late; the main result has it under window null.
    The facts are found while the plan is built, so ``df`` must give the same rows each time.
    """
    facts = window_facts(df, ts, order, size, delay, broadcast_windows)
    placed = df.withColumns({"window_start": window_start(ts, size), "window_end": window_end(ts, size)})
    # Only windows with a row after their closing can have late rows; the others need no lookup.
    closings = facts.table.where(F.col("last_row") > F.col("closed_by")).select("window_end", "closed_by", "rows")
    if facts.bound <= broadcast_windows or closings.count() <= broadcast_windows:
        joined = placed.join(F.broadcast(closings.drop("rows")), "window_end", "left")
    else:
        joined = _salted_lookup(placed, closings, order, target_rows)
    late = F.coalesce(order_key(order) > F.col("closed_by"), F.lit(False))
    if seen is not None:
        late = late | F.coalesce(F.col("window_end") <= F.lit(seen - delay), F.lit(False))
    return joined.select(*df.columns, "window_start", "window_end", late.alias("is_late"))


def _salted_lookup(placed: DataFrame, closings: DataFrame, order: Sequence[str], target_rows: int) -> DataFrame:
    """Join rows to closings by shuffle. Windows with too many rows are spread over several tasks.

    The broadcast table has at most MAX_STRETCHES rows: each of its windows holds more than
    ``target`` of all rows.
    """
    rows = closings.agg(F.sum("rows")).first()[0] or 0
    target = max(target_rows, math.ceil(rows / MAX_STRETCHES))
    salts = F.ceil(F.col("rows") / target).cast("long")
    large = closings.where(F.col("rows") > target).select("window_end", salts.alias("_salts"))
    salted = placed.join(F.broadcast(large), "window_end", "left").withColumn(
        "_salt",
        F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*order), F.col("_salts"))).otherwise(
            F.lit(0).cast("long")
        ),
    )
    copies = closings.select(
        "window_end", "closed_by", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("_salt")
    )
    return salted.join(copies, ["window_end", "_salt"], "left").drop("_salt", "_salts")


def late_rows(split: DataFrame) -> DataFrame:
    """The side output: late rows as they came in."""
    return split.where("is_late").drop("window_start", "window_end", "is_late")


def on_time_windows(split: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """The main output: aggregates per key and window, without late rows."""
    return (
        split.where(~F.col("is_late"))
        .groupBy(*keys, "window_start")
        .agg(*[a.alias(n) for n, a in aggregates.items()])
    )


def late_report(split: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How many late rows each key has, and what they add up to."""
    return split.where("is_late").groupBy(*keys).agg(F.count("*").alias("n_late"), F.sum(value).alias(f"late_{value}"))


def late_correction(split: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key and window: the main result, what came late, and both together.

    One pass over the rows. ``main`` is null for a window with only late rows, ``late`` for one
    without any.
    """
    held = split.groupBy(*keys, "window_start").agg(
        F.sum(F.when(~F.col("is_late"), F.col(value))).alias("main"),
        F.sum(F.when(F.col("is_late"), F.col(value))).alias("late"),
    )
    return held.withColumn("corrected", F.coalesce("main", F.lit(0)) + F.coalesce("late", F.lit(0)))


def window_emission(facts: WindowFacts, order: Sequence[str], end_of_input: str = "flush") -> DataFrame:
    """When each window gives its result: at which arrival, or at the end of input.

    ``end_of_input`` is "flush" or "hold" for the windows still open then. A window that has
    only late rows gives none.
    """
    if end_of_input not in ("flush", "hold"):
        raise ValueError(f"end_of_input must be 'flush' or 'hold', not {end_of_input!r}")
    arrival = F.col("closed_by") if len(order) == 1 else F.col(f"closed_by.{order[0]}")
    emits = F.col("closed_by").isNull() | (F.col("first_row") < F.col("closed_by"))
    left = F.lit("end_of_input") if end_of_input == "flush" else F.lit(None).cast("string")
    return facts.table.where(emits).select(
        "window_end",
        arrival.alias("emit_arrival"),
        F.when(F.col("closed_by").isNotNull(), F.lit("watermark")).otherwise(left).alias("emitted_by"),
    )


def open_windows(df: DataFrame, keys: Sequence[str], ts: str, size: int, **aggregates: Column) -> DataFrame:
    """Without a watermark nothing closes: every window, marked as not emitted."""
    return (
        df.groupBy(*keys, window_start(ts, size).alias("window_start"))
        .agg(*[a.alias(n) for n, a in aggregates.items()])
        .withColumn("emitted", F.lit(False))
    )
