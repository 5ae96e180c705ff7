"""Windows on arrival that the clock closes, whether or not another row comes.

Rows are combined per window in the tasks that read them. What is left, a row per key, window and
task, goes to a stateful operator with a timer per window; the timer fires once the clock has
passed the window's end. Batches without input go on running for that.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.columns import window_start
from tidemark.operators.combine import HELD_GROUPS, hash_partials
from tidemark.operators.folds import Combine, _gather, _walk
from tidemark.streaming.runner import start_files

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
TIMERS_NEED = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVERY_SECOND = {"processingTime": "1 second"}


def clock_windows(
    stream: DataFrame,
    keys: Sequence[str],
    arrival: str,
    size: int,
    values: Sequence[str],
    fn: Combine,
    hold_ms: int = 0,
    held_groups: int = HELD_GROUPS,
) -> DataFrame:
    """Per key and window of ``arrival`` (epoch microseconds) the combined values, and ``closed_at``.

    ``fn`` must be associative and commutative. A window is given out when the clock is ``hold_ms``
    milliseconds past its end. Rows of a window that was over when they came, as on a replay of old
    arrivals, are held that long from when the first of them came. If more come after that, they make another
    row of the same window, with a later ``closed_at`` (epoch milliseconds); ``whole_windows`` puts
    such rows together. Rows without arrival are in no window and left out.
    """
    groups = [*keys, "window_start"]
    placed = stream.where(F.col(arrival).isNotNull()).withColumn("window_start", window_start(arrival, size))
    parts = hash_partials(placed, groups, values, fn, held_groups)
    schema = parts.schema
    held = StructType([schema[v] for v in values])
    out = StructType([*[schema[g] for g in groups], *held.fields, StructField("closed_at", LongType())])
    names, size_us = [f.name for f in out], size

    class Clock(StatefulProcessor):
        """Defined in here, so that workers need nothing installed."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.value = handle.getValueState("value", held)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            value = self.value.get() if self.value.exists() else None
            if value is None:
                end_ms = -(-(key[-1] + size_us) // 1000)
                self.handle.registerTimer(max(end_ms, timerValues.getCurrentProcessingTimeInMs()) + hold_ms)
            for frame in rows:
                for row in frame[list(values)].astype(object).itertuples(index=False, name=None):
                    row = tuple(None if pd.isna(v) else v for v in row)
                    value = row if value is None else tuple(fn(tuple(value), row))
            self.value.update(value)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            line = [*key, *self.value.get(), timerValues.getCurrentProcessingTimeInMs()]
            self.value.clear()
            yield pd.DataFrame([line], columns=names, dtype=object)

        def close(self) -> None:
            pass

    return parts.groupBy(*groups).transformWithStateInPandas(Clock(), out, "Append", "ProcessingTime")


@contextmanager
def _timers(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here keep their state where timers are possible."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, TIMERS_NEED)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def start_clock(
    windows: DataFrame, name: str, root: str, trigger: Mapping[str, str | bool] = EVERY_SECOND
) -> StreamingQuery:
    """Start writing windows to a file sink as the clock closes them."""
    with _timers(windows.sparkSession):
        return start_files(windows, name, f"{root}/{name}", f"{root}/{name}-checkpoint", trigger=trigger)


def run_out(query: StreamingQuery, timeout: float = 600.0) -> None:
    """Let a stream take what is there and wait until the clock has closed every window; then stop it.

    Such a stream never stands still, so it is judged by its progress: a batch planned after this
    call that found no input and left no window open.
    """
    try:
        first = query.lastProgress
        begun = -1 if first is None else first["batchId"]
        until = time.monotonic() + timeout
        while time.monotonic() < until:
            failed, last = query.exception(), query.lastProgress
            if failed is not None:
                raise failed
            # The next batch may have been planned before this call.
            if last is not None and last["batchId"] > begun + 1 and last["numInputRows"] == 0:
                if not any(o["numRowsTotal"] for o in last["stateOperators"]):
                    return
            time.sleep(0.2)
        raise TimeoutError(f"stream {query.name!r} still had open windows after {timeout} s")
    finally:
        query.stop()


def whole_windows(
    spark: SparkSession, windows: DataFrame, name: str, root: str, keys: Sequence[str], values: Sequence[str], fn: Combine
) -> DataFrame:
    """The windows given out so far; rows of one window are put together."""
    rows = spark.read.schema(windows.schema).parquet(f"{root}/{name}")
    groups = [*keys, "window_start"]
    return _walk(_gather(rows, groups, ["closed_at"], values), groups, values, fn, each_row=False)
