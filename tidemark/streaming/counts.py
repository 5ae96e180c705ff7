"""Windows of a fixed number of elements per key, carried from batch to batch.

The state of a key is its last window: number, elements and sum. A batch numbers its rows on from
there, adds what the open window held, and gives out the windows that are full. Only keys of the
batch are shuffled and written. The result is that of ``keyed.count_windows`` over all rows, where
rows arrive in the order of the batches and by ``order`` inside one, whatever the cut into batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.measures import Measure, Measures
from tidemark.operators.stretches import TARGET_ROWS
from tidemark.session import passing
from tidemark.streaming.runner import ALL_THERE_IS, finish, start_batches
from tidemark.streaming.state import commit, read_all_keyed, read_batches, read_keyed, write_batch, write_keyed

FULL, LAST = "full", "last"


@dataclass(frozen=True)
class CountWindows:
    """The sum of ``value`` over every ``length`` consecutive elements of a key."""

    schema: StructType
    keys: Sequence[str]
    order: Sequence[str]
    value: str
    length: int

    def _windows_schema(self, spark: SparkSession) -> StructType:
        rows = spark.createDataFrame([], self.schema)
        total = rows.groupBy(*self.keys).agg(F.sum(self.value).alias(self.value)).schema
        counts = [StructField("window_no", LongType()), StructField("n", LongType())]
        return StructType([*total.fields[:-1], *counts, total.fields[-1]])

    def _typed(self, windows: DataFrame, schema: StructType) -> DataFrame:
        """Sums keep their type: one of sums of decimals would be wider."""
        return windows.select(*[F.col(f.name).cast(f.dataType) for f in schema])

    def batches(self, root: str, target_rows: int = TARGET_ROWS) -> Callable[[DataFrame, int], None]:
        """The batch function. A batch may be run again after a failure at any point."""
        number = Measures({"_nth": Measure("count", F.lit(1))})
        length = F.lit(self.length).cast("long")
        groups = [*self.keys, "window_no"]

        def each(rows: DataFrame, batch: int) -> None:
            spark = rows.sparkSession
            schema = self._windows_schema(spark)
            rows, windows = rows.persist(), None
            try:
                carried = last = None
                if batch > 0:
                    touched = rows.select(*self.keys).distinct()
                    last = read_keyed(spark, root, LAST, batch - 1, schema, self.keys, touched)
                    reached = F.col("window_no") * length + F.col("n")
                    carried = last.select(*self.keys, reached.alias(number.part_names[0]))
                nth = number.running(rows, self.keys, self.order, carried, target_rows)
                window = F.call_function("div", F.col("_nth") - 1, length)
                sums = nth.groupBy(*self.keys, window.alias("window_no")).agg(
                    F.count("*").alias("n"), F.sum(self.value).alias(self.value)
                )
                if last is not None:
                    begun = sums.unionByName(last.where(F.col("n") < length))
                    sums = begun.groupBy(*groups).agg(F.sum("n").alias("n"), F.sum(self.value).alias(self.value))
                windows = self._typed(sums, schema).persist()
                write_batch(windows.where(F.col("n") == length), root, FULL, batch)
                of_window = F.struct("n", self.value)
                newest = windows.groupBy(*self.keys).agg(
                    F.max("window_no").alias("window_no"), F.max_by(of_window, "window_no").alias("_of")
                )
                newest = newest.select(*groups, F.col("_of.n").alias("n"), F.col("_of")[self.value].alias(self.value))
                write_keyed(self._typed(newest, schema), root, LAST, batch, self.keys)
                commit(spark, root, batch)
            finally:
                rows.unpersist()
                if windows is not None:
                    windows.unpersist()

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
        """Start the stream and return its handle; the windows can be read while it runs."""
        return start_batches(stream, name, self.batches(root, target_rows), f"{root}/checkpoint", trigger=trigger)

    def run(
        self, stream: DataFrame, name: str, root: str, target_rows: int = TARGET_ROWS, timeout: float | None = None
    ) -> None:
        finish(self.start(stream, name, root, target_rows), timeout)

    def windows(self, spark: SparkSession, root: str) -> DataFrame:
        """Full windows and, flagged as not ``complete``, the one each key is filling."""
        schema = self._windows_schema(spark)
        full = read_batches(spark, root, FULL, schema).drop("batch").withColumn("complete", F.lit(True))
        filling = read_all_keyed(spark, root, LAST, schema, self.keys).where(F.col("n") < self.length)
        return full.unionByName(filling.withColumn("complete", F.lit(False))).drop("n")

