"""Event-time windows on a stream, late rows kept in an output of their own.

Built-in streaming aggregates drop late rows silently and decide per batch. Here each batch is
split row by row, going on from the largest event time of the batches before, so the result does
not depend on how the input is cut into batches. With ``granularity="batch"`` lateness is decided as
built-in aggregates do, by what the batches before have seen. Open windows are kept as partial aggregates, and
as changes: a batch reads and writes the windows its rows are in and those it closes. That a window
was closed needs no mark of its own, as the largest event time of each batch is kept with it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.functions.columns import window_start
from tidemark.operators.folds import Fold
from tidemark.operators.late import late_rows, late_split
from tidemark.operators.measures import Measures
from tidemark.operators.stretches import TARGET_ROWS
from tidemark.session import passing
from tidemark.streaming.runner import ALL_THERE_IS, finish, start_batches
from tidemark.streaming.state import (
    commit,
    last_commit,
    read_all_keyed,
    read_batches,
    read_commit,
    read_keyed,
    write_batch,
    write_keyed,
)

MAIN, LATE, OPEN = "main", "late", "open"
# What was given out per window so far, and the changes to it.
GIVEN, CHANGES = "given", "changes"
# What each batch had, for watching a stream while it runs.
LOG = "log"
LOG_SCHEMA = StructType([StructField(n, LongType()) for n in ("n_rows", "n_late", "max_ts")])

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LateWindows:
    """A reduce per key and window of ``size``, with late rows apart.

    ``granularity`` is "row" or "batch": whether a row is late by the rows, or by the batches, that
    came before it. With ``changes`` each batch also writes what it changes in the results.
    """

    schema: StructType
    keys: Sequence[str]
    ts: str
    order: Sequence[str]
    size: int
    delay: int
    reduce: Measures | Fold
    granularity: str = "row"
    changes: bool = False

    def __post_init__(self) -> None:
        if self.granularity not in ("row", "batch"):
            raise ValueError(f"granularity must be 'row' or 'batch', not {self.granularity!r}")

    @property
    def groups(self) -> list[str]:
        return [*self.keys, "window_start"]

    def _parts_schema(self, spark: SparkSession) -> StructType:
        """The columns a window is stored with, found without running anything."""
        rows = spark.createDataFrame([], StructType([*self.schema, StructField("window_start", LongType())]))
        if isinstance(self.reduce, Fold):
            return rows.select(*self.groups, *self.reduce.values).schema
        return self.reduce.parts(rows, self.groups, self.order).schema

    def _closed(self, max_ts: int | None) -> Column:
        """Whether a window is closed once ``max_ts`` was seen."""
        if max_ts is None:
            return F.lit(False)
        # A comparison of the bare column, which a scan of sorted files can use to skip them.
        return F.coalesce(F.col("window_start") <= F.lit(max_ts - self.delay - self.size).cast("long"), F.lit(False))

    def _split(self, rows: DataFrame, before: int | None, target_rows: int) -> DataFrame:
        """Rows with their window and whether they are late, where ``before`` was seen in earlier batches."""
        if self.granularity == "batch":
            placed = rows.withColumn("window_start", window_start(self.ts, self.size))
            return placed.withColumn("is_late", self._closed(before))
        return late_split(rows, self.ts, self.order, self.size, self.delay, seen=before, target_rows=target_rows)

    def _write_changes(
        self, closing: DataFrame, late: DataFrame, root: str, batch: int, target_rows: int
    ) -> list[DataFrame]:
        """Take back the old result of each window that late rows change, and give the new one.

        A window closes once and has late rows only after that, so what was given out before and
        what closes now are different windows. Returns the tables to unpersist.
        """
        spark = closing.sparkSession
        late_parts = self.reduce.parts(late, self.groups, self.order, target_rows).persist()
        earlier, old = closing, None
        if batch > 0:
            touched = self.reduce.groups(late_parts, self.groups)
            schema = self._parts_schema(spark)
            old = read_keyed(spark, root, GIVEN, batch - 1, schema, self.groups, touched).persist()
            earlier = closing.unionByName(old)
        new = self.reduce.merge(earlier, late_parts, self.groups).persist()
        changes = self.reduce.result(new, self.groups).withColumn("change", F.lit(1))
        if old is not None:
            changes = changes.unionByName(self.reduce.result(old, self.groups).withColumn("change", F.lit(-1)))
        write_batch(changes, root, CHANGES, batch)
        write_keyed(new, root, GIVEN, batch, self.groups, by="window_start")
        return [t for t in (late_parts, old, new) if t is not None]

    def _log(self, spark: SparkSession, root: str, batch: int, n_rows: int, n_late: int, newest: int | None) -> None:
        level = logging.WARNING if n_late else logging.INFO
        log.log(level, "%s, batch %d: %d of %d rows late", root, batch, n_late, n_rows)
        entry = spark.createDataFrame([(n_rows, n_late, newest)], LOG_SCHEMA)
        write_batch(entry.coalesce(1), root, LOG, batch)

    def batches(self, root: str, target_rows: int = TARGET_ROWS) -> Callable[[DataFrame, int], None]:
        """The batch function. A batch may be run again after a failure at any point."""

        def each(rows: DataFrame, batch: int) -> None:
            spark = rows.sparkSession
            before = read_commit(spark, root, batch - 1)["max_ts"] if batch > 0 else None
            rows = rows.persist()
            parts = held = None
            used: list[DataFrame] = []
            try:
                split = self._split(rows, before, target_rows)
                # Counted as they are written, so that nothing is read for it.
                counted = Observation()
                late_now = late_rows(split).observe(counted, F.count(F.lit(1)).alias("n"))
                write_batch(late_now, root, LATE, batch)
                on_time = split.where(~F.col("is_late"))
                parts = self.reduce.parts(on_time, self.groups, self.order, target_rows).persist()
                n_rows, newest = rows.agg(F.count("*"), F.max(self.ts)).first()
                newest = max((x for x in (before, newest) if x is not None), default=None)
                closed, open_before, open_now = self._closed(newest), ~self._closed(before), ~self._closed(newest)
                kept = None
                if batch > 0:
                    schema, touched = self._parts_schema(spark), self.reduce.groups(parts, self.groups)
                    kept = read_keyed(
                        spark, root, OPEN, batch - 1, schema, self.groups, touched, alive=open_before, also=closed
                    )
                held = self.reduce.merge(kept, parts, self.groups).persist()
                write_batch(held.where(closed), root, MAIN, batch)
                write_keyed(held.where(~closed), root, OPEN, batch, self.groups, alive=open_now, by="window_start")
                if self.changes:
                    late = split.where("is_late")
                    used = self._write_changes(held.where(closed), late, root, batch, target_rows)
                self._log(spark, root, batch, n_rows, counted.get.get("n", 0), newest)
                commit(spark, root, batch, newest)
            finally:
                for table in (rows, parts, held, *used):
                    if table is not None:
                        table.unpersist()

        def alone(rows: DataFrame, batch: int) -> None:
            with passing(rows.sparkSession):
                each(rows, batch)

        return alone

    def start(
        self,
        stream: DataFrame,
        name: str,
        root: str,
        target_rows: int = TARGET_ROWS,
        trigger: Mapping[str, str | bool] = ALL_THERE_IS,
    ) -> StreamingQuery:
        """Start the stream and return its handle; the outputs can be read while it runs."""
        each = self.batches(root, target_rows)
        return start_batches(stream, name, each, f"{root}/checkpoint", trigger=trigger)

    def run(
        self, stream: DataFrame, name: str, root: str, target_rows: int = TARGET_ROWS, timeout: float | None = None
    ) -> None:
        """Run to the end of the input; the outputs are read with ``main``, ``late`` and ``still_open``."""
        finish(self.start(stream, name, root, target_rows), timeout)

    def late(self, spark: SparkSession, root: str) -> DataFrame:
        """The late rows, as they came in."""
        return read_batches(spark, root, LATE, self.schema).drop("batch")

    def logged(self, spark: SparkSession, root: str) -> DataFrame:
        """Per finished batch its rows, how many of them were late, and the largest event time by then."""
        return read_batches(spark, root, LOG, LOG_SCHEMA)

    def corrected(self, spark: SparkSession, root: str, value: str, end_of_input: str = "flush") -> DataFrame:
        """Per key and window the sum given out, what came late, and both; ``value`` is a sum of this name."""
        late = self.late(spark, root).select(
            *self.keys, window_start(self.ts, self.size).alias("window_start"), F.col(value).alias("late")
        )
        main = self.main(spark, root, end_of_input).select(*self.groups, F.col(value).alias("main"))
        both = main.unionByName(late, allowMissingColumns=True)
        held = both.groupBy(*self.groups).agg(F.sum("main").alias("main"), F.sum("late").alias("late"))
        return held.withColumn("corrected", F.coalesce("main", F.lit(0)) + F.coalesce("late", F.lit(0)))

    def change_stream(self, spark: SparkSession, root: str) -> DataFrame:
        """The results as changes: ``change`` 1 gives a row, -1 takes one back that was given before.

        A window has at most one change of each kind per ``batch``, so a reader that keeps the newest
        batch it applied per window takes no change twice.
        """
        schema = self.reduce.result(spark.createDataFrame([], self._parts_schema(spark)), self.groups).schema
        return read_batches(spark, root, CHANGES, StructType([*schema, StructField("change", IntegerType())]))

    def still_open(self, spark: SparkSession, root: str) -> DataFrame:
        """Windows that no watermark has closed yet."""
        last = last_commit(spark, root)
        newest = None if last is None else read_commit(spark, root, last)["max_ts"]
        held = read_all_keyed(spark, root, OPEN, self._parts_schema(spark), self.groups, alive=~self._closed(newest))
        return self.reduce.result(held, self.groups)

    def main(self, spark: SparkSession, root: str, end_of_input: str = "flush") -> DataFrame:
        """Closed windows and, with "flush", those still open; ``emitted_by`` tells them apart."""
        if end_of_input not in ("flush", "hold"):
            raise ValueError(f"end_of_input must be 'flush' or 'hold', not {end_of_input!r}")
        closed = read_batches(spark, root, MAIN, self._parts_schema(spark))
        closed = self.reduce.result(closed, self.groups).withColumn("emitted_by", F.lit("watermark"))
        if end_of_input == "hold":
            return closed
        rest = self.still_open(spark, root).withColumn("emitted_by", F.lit("end_of_input"))
        return closed.unionByName(rest)
