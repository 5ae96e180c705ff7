"""Typed reads of tables, bounded or streamed, and the arrival stream derived from events.

Schemas are always given, never inferred. ``ts`` is declared TIMESTAMP: the files hold it
without a zone, and this reads it as UTC whatever the session zone is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import cents

SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}

# How late an event may arrive after it happened, in seconds, and the step that spreads the delays.
ARRIVAL_SPREAD_SECONDS = 3600
ARRIVAL_STEP = 7919


def from_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str | StructType) -> DataFrame:
    """A bounded source of literal rows. ``seq`` holds the position: a DataFrame has no order."""
    numbered = [(seq, *row) for seq, row in enumerate(rows)]
    if isinstance(schema, StructType):
        schema = schema.simpleString()[len("struct<") : -1]
    return spark.createDataFrame(numbered, f"seq BIGINT, {schema}")


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, table: str, files_per_batch: int = 1000) -> DataFrame:
    """The same rows as a stream. The pattern lets a table be one file or a folder of files."""
    return stream_files(spark, f"{sf_dir}/{table}.parquet*", SCHEMAS[table], files_per_batch)


def stream_files(
    spark: SparkSession, path: str, schema: str | StructType, files_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def append_in_turns(rows: DataFrame, folder: str, by: str, turns: int = 3) -> Iterator[int]:
    """Append the rows to a folder in contiguous ranges of a whole number, one range at a time.

    Each row is in exactly one range. Gives the number of the range once it is written, so that a
    stream over the folder can be run, or started again, in between.
    """
    cuts = rows.approxQuantile(by, [i / turns for i in range(1, turns)], 0.01)
    turn = sum((F.coalesce(F.col(by) > cut, F.lit(False)).cast("int") for cut in cuts), F.lit(0))
    for i in range(turns):
        rows.where(turn == i).write.mode("append").parquet(folder)
        yield i


def append_by(rows: DataFrame, folder: str, turn: Column) -> Iterator[int]:
    """Append the rows to a folder by a whole number that says which go together, lowest first.

    The numbers that occur are collected, so there should be some hundred at most. Rows without
    one come in none of the turns.
    """
    turns = rows.select(turn.alias("turn")).where("turn is not null").distinct()
    for number in sorted(r["turn"] for r in turns.collect()):
        rows.where(turn == number).write.mode("append").parquet(folder)
        yield number


def stamp_arrival(stream: DataFrame, out: str = "arrival") -> DataFrame:
    """Add the time at which a row is taken in (epoch microseconds), for windows on the clock.

    One value per batch of a stream. It is logged with the batch, so a batch that is run again
    after a failure gets the same one.
    """
    return stream.withColumn(out, F.unix_micros(F.current_timestamp()))


def arrivals(events: DataFrame) -> DataFrame:
    """Events in the order they reach the system: ``arrival`` (then event_id) in epoch microseconds.

    ``t`` is when the event happened, ``arrival`` is up to an hour later, so rows are out of order.
    """
    t = F.unix_micros("ts")
    lag = (F.col("event_id") * ARRIVAL_STEP) % ARRIVAL_SPREAD_SECONDS
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        cents("value").alias("cents"),
        t.alias("t"),
        (t + lag * 1_000_000).alias("arrival"),
    )
