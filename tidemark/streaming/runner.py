"""Starting streams, running them to the end of their input, and named sinks.

Without a trigger a stream takes the input that is there and ends. With one, such as
``{"processingTime": "10 seconds"}``, it goes on until it is stopped or drained.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

ONE_AGGREGATE = "spark.sql.streaming.statefulOperator.allowMultiple"


ALL_THERE_IS = {"availableNow": True}


def start_files(
    stream: DataFrame,
    name: str,
    out: str,
    checkpoint: str,
    mode: str = "append",
    trigger: Mapping[str, str | bool] = ALL_THERE_IS,
) -> StreamingQuery:
    """Start writing a stream to a named file sink. Returns at once."""
    return (
        stream.writeStream.queryName(name)
        .format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(out)
    )


def start_batches(
    stream: DataFrame,
    name: str,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: Mapping[str, str | bool] = ALL_THERE_IS,
) -> StreamingQuery:
    """Start a stream whose batches go to a function. Returns at once."""
    return (
        stream.writeStream.queryName(name)
        .foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def finish(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait until the input present at the start is used up; a failure is raised here."""
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
        raise TimeoutError(f"stream {query.name!r} was still running after {timeout} s")


def drain(query: StreamingQuery) -> None:
    """Let a continuous stream take what is there, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def stop_after(query: StreamingQuery, batches: int, timeout: float = 3600) -> None:
    """Stop a continuous stream once it has done some batches; a failure is raised here."""
    until = time.monotonic() + timeout
    try:
        while (query.lastProgress or {"batchId": -1})["batchId"] + 1 < batches:
            if query.awaitTermination(0.1):
                return
            if time.monotonic() > until:
                raise TimeoutError(f"stream {query.name!r} had not done {batches} batches after {timeout} s")
    finally:
        query.stop()


def run_to_files(stream: DataFrame, name: str, root: str, timeout: float | None = None) -> DataFrame:
    """Run a stream to the end of its input and read its sink back."""
    out = f"{root}/{name}"
    finish(start_files(stream, name, out, f"{root}/{name}-checkpoint"), timeout)
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def drop_late_at_once(spark: SparkSession) -> None:
    """Let the built-in late filter use the newest watermark rather than the one before it.

    Right for streams with a single aggregate; leave it alone for chained ones.
    """
    spark.conf.set(ONE_AGGREGATE, "false")
