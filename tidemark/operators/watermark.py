"""Event time and watermarks.

The watermark is the largest event time that has arrived, less the bound on disorder. It is one
value for the whole input, not one per key. Where rows come from several inputs, each has its own
largest event time, and the slowest input counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.measures import Measure, running
from tidemark.operators.stretches import TARGET_ROWS


def with_event_time(df: DataFrame, ts_ms: str, delay_ms: int | None = None, out: str = "ts") -> DataFrame:
    """Name the event time (epoch milliseconds) and the bound on disorder.

    Without a bound there is no watermark, so on a stream no window ever closes.
    """
    timed = df.withColumn(out, F.timestamp_millis(F.col(ts_ms)))
    return timed if delay_ms is None else timed.withWatermark(out, f"{delay_ms} milliseconds")


def watermark_trace(
    df: DataFrame, ts: str, order: Sequence[str], delay: int, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """Add the watermark each row met on arrival; null for the first."""
    seen = running(df, [], order, {"_seen": Measure("max", F.col(ts))}, before=True, target_rows=target_rows)
    return seen.withColumn("watermark", F.col("_seen") - F.lit(delay).cast("long")).drop("_seen")


# Inputs that a watermark can be the smallest of: each takes two running values beside every row.
MOST_INPUTS = 200


def watermark_trace_inputs(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    source: str,
    delay: int,
    idle: int | None = None,
    inputs: Sequence | None = None,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Add the watermark each row met on arrival, where rows come from the inputs named by ``source``.

    It is the smallest of the inputs' largest event times so far, less the bound, and never goes
    back. Until every input has sent a row it is null. With ``idle`` an input does not count while
    its last row (or, before its first, the first row of all) arrived more than that before, by the
    first order column; with no input left that counts, the watermark stays. ``inputs`` are the
    inputs there are, else those found in the data. A row without an input counts for none, but
    meets a watermark.
    """
    if inputs is None:
        found = df.select(source).where(F.col(source).isNotNull()).distinct().limit(MOST_INPUTS + 1)
        inputs = sorted(r[0] for r in found.collect())
    if not 0 < len(inputs) <= MOST_INPUTS:
        if not inputs:
            return df.withColumn("watermark", F.lit(None).cast("long"))
        raise ValueError(f"more than {MOST_INPUTS} inputs")
    of = [F.col(source) == F.lit(i) for i in inputs]
    seen = {f"_seen_{n}": Measure("max", F.when(o, F.col(ts))) for n, o in enumerate(of)}
    came = {f"_came_{n}": Measure("max", F.when(o, F.col(order[0]))) for n, o in enumerate(of)} if idle is not None else {}
    begun = {"_begun": Measure("min", F.col(order[0]))} if idle is not None else {}
    met = running(df, [], order, {**seen, **came, **begun}, before=True, target_rows=target_rows)
    counted, waited_for = [], []
    for n in range(len(inputs)):
        counts = F.lit(True)
        if idle is not None:
            last = F.coalesce(f"_came_{n}", "_begun")
            counts = F.coalesce(F.col(order[0]) - last <= F.lit(idle), F.lit(True))
        counted.append(F.when(counts, F.col(f"_seen_{n}")))
        waited_for.append(counts & F.col(f"_seen_{n}").isNull())
    least = F.when(~F.array_contains(F.array(*waited_for), True), F.array_min(F.array(*counted)))
    met = met.withColumn("_least", least).select(*df.columns, "_least")
    kept = running(met, [], order, {"_kept": Measure("max", F.col("_least"))}, target_rows=target_rows)
    return kept.select(*df.columns, (F.col("_kept") - F.lit(delay).cast("long")).alias("watermark"))
