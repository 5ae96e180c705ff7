"""One query per operator, over whole tables. ``tidemark.plans.oracles`` has the SQL for each."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, is_even, square, window_start
from tidemark.operators import keyed, transforms, watermark, windows
from tidemark.operators.combine import tumbling_combined
from tidemark.operators.folds import Fold
from tidemark.operators.late import (
    late_correction,
    late_report,
    late_rows,
    late_split,
    on_time_windows,
    open_windows,
    window_emission,
    window_facts,
)
from tidemark.operators.measures import Measure, Measures
from tidemark.session import scratch_dir
from tidemark.sources.rows import lay_rows, stream_rows
from tidemark.sources.tables import append_by, append_in_turns, arrivals, read_table, stream_files
from tidemark.streaming.builtin import append_windows, appended
from tidemark.streaming.clock import clock_windows, run_out, start_clock, whole_windows
from tidemark.streaming.counts import CountWindows
from tidemark.streaming.keyed import running_stream, update_totals
from tidemark.streaming.late import LateWindows
from tidemark.streaming.runner import drain, run_to_files, start_files, stop_after

Query = Callable[[SparkSession, str], DataFrame]

HOUR = 3_600_000_000
LATE_BOUND = 900_000_000
WIDE_BOUND = 7_200_000_000
IDLE = 1_800_000_000
COUNT_WINDOW = 10
# Arrivals of five days make a batch where lateness goes by batches.
BATCH = 120 * HOUR
ORDER = ["arrival", "event_id"]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _money(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", "event_type", cents("value").alias("cents"))


def _timed(events: DataFrame) -> DataFrame:
    return events.select("event_id", "event_type", cents("value").alias("cents"), F.unix_micros("ts").alias("t"))


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals(_events(spark, sf_dir))


def _in_turns(rows: DataFrame, by: str, root: str, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stream over rows that come in several turns, started again on its checkpoint for each."""
    out = None
    for _ in append_in_turns(rows, f"{root}/in", by):
        out = run(stream_files(rows.sparkSession, f"{root}/in", rows.schema))
    return out


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_split(_arrivals(spark, sf_dir), "t", ORDER, HOUR, LATE_BOUND)


# Sources and sinks


def src_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(_events(spark, sf_dir))


def src_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "src_stream")
    rows = _money(_events(spark, sf_dir))
    return _in_turns(rows, "event_id", root, lambda stream: run_to_files(stream, "events_out", root))


def src_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a stream by row offsets, an eighth a batch, stopped and started again on the way."""
    root = scratch_dir(spark, "src_rows_stream")
    rows = _money(_events(spark, sf_dir))
    lay_rows(rows, ["event_id"], f"{root}/in")
    step = rows.count() // 8 + 1

    def start():
        stream = stream_rows(spark, f"{root}/in", rows.schema, f"{root}/progress", step)
        now = {"processingTime": "0 seconds"}
        return start_files(stream, "rows_out", f"{root}/out", f"{root}/checkpoint", trigger=now)

    stop_after(start(), 4)
    drain(start())
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


# Element-wise


def map_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.map_columns(_events(spark, sf_dir), ["event_id"], doubled=cents("value") * 2)


def map_square_filter_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    squared = transforms.map_columns(_events(spark, sf_dir), ["event_id"], squared=square("user_id"))
    return transforms.keep_rows(squared, is_even("squared"))


def map_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    def double(values: pd.Series) -> pd.Series:
        return values * 2

    rows = transforms.map_columns(_events(spark, sf_dir), ["event_id"], cents=cents("value"))
    return transforms.map_series(rows, "cents", double, "doubled", "bigint").drop("cents")


def flat_map_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.flat_map_words(read_table(spark, sf_dir, "documents"), ["doc_id"], "text")


def flat_map_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words again, by a function of the user from frame to frame."""

    def split(frame: pd.DataFrame) -> pd.DataFrame:
        listed = frame.assign(word=frame["text"].str.split(" ", regex=False))
        listed["pos"] = [list(range(len(w))) for w in listed["word"]]
        return listed[["doc_id", "pos", "word"]].explode(["pos", "word"]).astype({"pos": "int64"})

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").where("text is not null")
    return transforms.map_frames(docs, split, "doc_id BIGINT, pos BIGINT, word STRING")


def flat_map_subevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = transforms.count_up_to(F.col("event_id") % 3)
    return transforms.flat_map(_events(spark, sf_dir), ["event_id"], parts, "i")


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.word_count(read_table(spark, sf_dir, "documents"), "text")


# Keyed


def key_by_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return keyed.colocation(_events(spark, sf_dir), ["user_id"], tasks)


def keyed_sum_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.keyed_sum(_money(_events(spark, sf_dir)), ["event_type"], "cents")


def keyed_sum_update_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _money(_events(spark, sf_dir))
    root = scratch_dir(spark, "keyed_sum_update_stream")
    sums = {"cents": F.sum("cents")}
    return _in_turns(rows, "event_id", root, lambda s: update_totals(s, ["event_type"], sums, "totals", root))


def keyed_sum_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _money(_events(spark, sf_dir)).select("event_id", "event_type", "cents")
    return keyed.running_sum(rows, ["event_type"], ["event_id"], "cents", "running_cents").drop("cents")


def keyed_sum_rolling_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _money(_events(spark, sf_dir)).select("event_id", "event_type", "cents")
    root = scratch_dir(spark, "keyed_sum_rolling_stream")
    sums = Measures({"running_cents": Measure("sum", F.col("cents"))})

    def run(stream: DataFrame) -> DataFrame:
        return running_stream(stream, ["event_type"], ["event_id"], sums, "running", root)

    return _in_turns(rows, "event_id", root, run).drop("cents")


def keyed_reduce_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _money(_events(spark, sf_dir)).select("event_id", "event_type", "cents")
    fields = {
        "running_cents": Measure("sum", F.col("cents")),
        "first_event_id": Measure("first", F.col("event_id")),
    }
    return keyed.running_reduce(rows, ["event_type"], ["event_id"], fields).drop("cents")


def keyed_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.keyed_aggregate(_money(_events(spark, sf_dir)), ["user_id"], "cents")


# Windows


def tumble_arrival_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_sum(_arrivals(spark, sf_dir), ["event_type"], "arrival", HOUR, "cents")


def tumble_arrival_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows on the arrival of streamed rows; in that order no row is late."""
    rows = _arrivals(spark, sf_dir)
    root = scratch_dir(spark, "tumble_arrival_stream")
    sums = Measures({"cents": Measure("sum", F.col("cents"))})
    job = LateWindows(rows.schema, ["event_type"], "arrival", ORDER, HOUR, 0, sums)
    for _ in append_in_turns(rows, f"{root}/in", "arrival"):
        job.run(stream_files(spark, f"{root}/in", rows.schema), "tumble_arrival_stream", root)
    return job.main(spark, root).select("event_type", "window_start", "cents")


def tumble_arrival_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows, each given out by a timer, as no row comes after the last ones."""

    def add(first: tuple, second: tuple) -> tuple:
        return (first[0] + second[0],)

    rows = _arrivals(spark, sf_dir)
    name, root, query = "tumble_arrival_clock", scratch_dir(spark, "tumble_arrival_clock"), None
    for _ in append_in_turns(rows, f"{root}/in", "arrival"):
        if query is None:
            stream = stream_files(spark, f"{root}/in", rows.schema)
            given_out = clock_windows(stream, ["event_type"], "arrival", HOUR, ["cents"], add)
            query = start_clock(given_out, name, root)
    run_out(query)
    return whole_windows(spark, given_out, name, root, ["event_type"], ["cents"], add)


def tumble_event_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_sum(_timed(_events(spark, sf_dir)), ["event_type"], "t", HOUR, "cents")


def tumble_event_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows out of order, but within the bound, count in their own window."""
    split = late_split(_arrivals(spark, sf_dir), "t", ORDER, HOUR, WIDE_BOUND)
    return windows.tumbling_reduce(split.where(~F.col("is_late")), ["event_type"], "t", ORDER, HOUR, "cents")


def tumble_udaf_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    def add_cents(first: tuple, second: tuple) -> tuple:
        return (first[0] + second[0], first[1])

    rows = _arrivals(spark, sf_dir)
    return windows.tumbling_fold(rows, ["event_type"], "t", ORDER, HOUR, ["cents", "t"], add_cents, associative=True)


def tumble_udaf_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both reduces by user functions, folded before the shuffle: one in order, one in any order."""

    def add_cents(first: tuple, second: tuple) -> tuple:
        return (first[0] + second[0], first[1])

    def least(a: tuple, b: tuple) -> tuple:
        return (min(a[0], b[0]), max(a[1], b[1]))

    rows = _arrivals(spark, sf_dir).withColumns({"least": F.col("cents"), "most": F.col("cents")})
    ordered = tumbling_combined(rows, ["event_type"], "t", ORDER, HOUR, ["cents", "t"], add_cents)
    either = tumbling_combined(rows, ["event_type"], "t", ORDER, HOUR, ["least", "most"], least, commutative=True)
    return ordered.join(either, ["event_type", "window_start"])


def tumble_count_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_mean(_timed(_events(spark, sf_dir)), ["event_type"], "t", HOUR, "cents")


def count_window_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _money(_events(spark, sf_dir))
    return keyed.count_windows(rows, ["user_id"], ["event_id"], "cents", COUNT_WINDOW)


def count_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _money(_events(spark, sf_dir)).select("event_id", "user_id", "cents")
    root = scratch_dir(spark, "count_window_stream")
    job = CountWindows(rows.schema, ["user_id"], ["event_id"], "cents", COUNT_WINDOW)
    for _ in append_in_turns(rows, f"{root}/in", "event_id"):
        job.run(stream_files(spark, f"{root}/in", rows.schema), "count_window_stream", root)
    return job.windows(spark, root)


# Event time, watermarks, late rows


def timestamp_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = _events(spark, sf_dir).select("event_id", F.unix_millis("ts").alias("ts_ms"))
    timed = watermark.with_event_time(millis, "ts_ms")
    return timed.select("event_id", F.unix_millis("ts").alias("t_ms"))


def watermark_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _arrivals(spark, sf_dir).select("event_id", "t", "arrival")
    return watermark.watermark_trace(rows, "t", ORDER, LATE_BOUND).select("event_id", "watermark")


def watermark_trace_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type is an input of its own, released after half an hour without a row."""
    rows = _arrivals(spark, sf_dir).select("event_id", "event_type", "t", "arrival")
    traced = watermark.watermark_trace_inputs(rows, "t", ORDER, "event_type", LATE_BOUND, idle=IDLE)
    plain = watermark.watermark_trace_inputs(rows, "t", ORDER, "event_type", LATE_BOUND)
    held = plain.select("event_id", F.col("watermark").alias("without_release"))
    return traced.select("event_id", "watermark").join(held, "event_id")


def no_watermark_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_windows(_arrivals(spark, sf_dir), ["event_type"], "t", HOUR, n=F.count("*"))


def window_emission_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_emission(window_facts(_arrivals(spark, sf_dir), "t", ORDER, HOUR, LATE_BOUND), ORDER)


def late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_rows(_split(spark, sf_dir))


def late_main_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_time_windows(_split(spark, sf_dir), ["event_type"], n=F.count("*"), cents=F.sum("cents"))


def late_windows_fold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reduce on a stream that is not associative: the first value less all later ones."""

    def minus(first: tuple, second: tuple) -> tuple:
        return (first[0] - second[0], first[1])

    rows = _arrivals(spark, sf_dir)
    root = scratch_dir(spark, "late_windows_fold_stream")
    job = LateWindows(rows.schema, ["event_type"], "t", ORDER, HOUR, LATE_BOUND, Fold(("cents", "t"), minus, False))
    for _ in append_in_turns(rows, f"{root}/in", "arrival"):
        job.run(stream_files(spark, f"{root}/in", rows.schema), "late_windows_fold_stream", root)
    return job.main(spark, root).select("event_type", "window_start", "cents", "t")


def _late_windows(rows: DataFrame, name: str, root: str) -> LateWindows:
    """Run the rows in several turns; the job reads its outputs below ``root``."""
    sums = Measures({"n": Measure("count", F.lit(1)), "cents": Measure("sum", F.col("cents"))})
    job = LateWindows(rows.schema, ["event_type"], "t", ORDER, HOUR, LATE_BOUND, sums)
    for _ in append_in_turns(rows, f"{root}/in", "arrival"):
        job.run(stream_files(rows.sparkSession, f"{root}/in", rows.schema), name, root)
    return job


def _both_sinks(job: LateWindows, spark: SparkSession, root: str) -> DataFrame:
    """Sums of the main and of the late output."""
    groups = ["event_type", "window_start"]
    main = job.main(spark, root).select(*groups, "n", "cents")
    late = job.late(spark, root).withColumn("window_start", window_start("t", HOUR)).groupBy(*groups)
    late = late.agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))
    return main.select(F.lit("main").alias("sink"), "*").unionByName(late.select(F.lit("late").alias("sink"), "*"))


def tumble_event_built_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's own windows with a watermark; those open at the end come from its state store."""
    rows = _arrivals(spark, sf_dir)
    name, root = "tumble_event_built_in", scratch_dir(spark, "tumble_event_built_in")
    sums = {"n": F.count(F.lit(1)), "cents": F.sum("cents")}
    for _ in append_by(rows, f"{root}/in", F.call_function("div", F.col("arrival"), F.lit(BATCH))):
        stream = stream_files(spark, f"{root}/in", rows.schema).withColumn("ts", F.timestamp_micros("t"))
        stream = stream.withWatermark("ts", "15 minutes")
        schema = append_windows(stream, ["event_type"], "ts", "1 hour", sums, name, root)
    found = appended(spark, schema, ["event_type"], name, root)
    return found.select("event_type", F.unix_micros("window_start").alias("window_start"), "n", "cents")


def late_batch_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lateness by batches, but late rows are kept: they are the second sink."""
    rows = _arrivals(spark, sf_dir)
    root = scratch_dir(spark, "late_batch_stream")
    sums = Measures({"n": Measure("count", F.lit(1)), "cents": Measure("sum", F.col("cents"))})
    job = LateWindows(rows.schema, ["event_type"], "t", ORDER, HOUR, LATE_BOUND, sums, granularity="batch")
    for _ in append_by(rows, f"{root}/in", F.call_function("div", F.col("arrival"), F.lit(BATCH))):
        job.run(stream_files(spark, f"{root}/in", rows.schema), "late_batch_stream", root)
    return _both_sinks(job, spark, root)


def late_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch had, as it is logged while the stream runs."""
    rows = _arrivals(spark, sf_dir)
    root = scratch_dir(spark, "late_log_stream")
    sums = Measures({"cents": Measure("sum", F.col("cents"))})
    job = LateWindows(rows.schema, ["event_type"], "t", ORDER, HOUR, LATE_BOUND, sums)
    for _ in append_by(rows, f"{root}/in", F.call_function("div", F.col("arrival"), F.lit(BATCH))):
        job.run(stream_files(spark, f"{root}/in", rows.schema), "late_log_stream", root)
    return job.logged(spark, root)


def late_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left per window when all changes are applied, and how many results that is."""
    rows = _arrivals(spark, sf_dir)
    root = scratch_dir(spark, "late_changes_stream")
    sums = Measures({"n": Measure("count", F.lit(1)), "cents": Measure("sum", F.col("cents"))})
    job = LateWindows(rows.schema, ["event_type"], "t", ORDER, HOUR, LATE_BOUND, sums, changes=True)
    for _ in append_in_turns(rows, f"{root}/in", "arrival"):
        job.run(stream_files(spark, f"{root}/in", rows.schema), "late_changes_stream", root)
    opened = job.still_open(spark, root).withColumn("change", F.lit(1))
    changes = job.change_stream(spark, root).drop("batch").unionByName(opened)
    return changes.groupBy("event_type", "window_start").agg(
        F.sum(F.col("change") * F.col("n")).alias("n"),
        F.sum(F.col("change") * F.col("cents")).alias("cents"),
        F.sum("change").alias("results"),
    )


def late_correction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "late_correction_stream")
    job = _late_windows(_arrivals(spark, sf_dir), "late_correction_stream", root)
    return job.corrected(spark, root, "cents")


def late_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _arrivals(spark, sf_dir)
    root = scratch_dir(spark, "late_two_sinks")
    job = _late_windows(rows, "late_two_sinks", root)
    return _both_sinks(job, spark, root)


def late_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_report(_split(spark, sf_dir), ["event_type"], "cents")


def late_correction_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_correction(_split(spark, sf_dir), ["event_type"], "cents")


# The same operators with limits so low that keys are cut and windows joined by shuffle.

LOW_TARGET = 500


def keyed_sum_rolling_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _money(_events(spark, sf_dir)).select("event_id", "event_type", "cents")
    return keyed.running_sum(rows, ["event_type"], ["event_id"], "cents", "running_cents", LOW_TARGET).drop("cents")


def tumble_udaf_reduce_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    def add_cents(first: tuple, second: tuple) -> tuple:
        return (first[0] + second[0], first[1])

    rows = _arrivals(spark, sf_dir)
    return windows.tumbling_fold(
        rows, ["event_type"], "t", ORDER, HOUR, ["cents", "t"], add_cents, target_rows=2, associative=True
    )


def count_window_sum_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _money(_events(spark, sf_dir))
    return keyed.count_windows(rows, ["user_id"], ["event_id"], "cents", COUNT_WINDOW, target_rows=5)


def late_main_output_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _arrivals(spark, sf_dir)
    split = late_split(rows, "t", ORDER, HOUR, LATE_BOUND, broadcast_windows=0, target_rows=2)
    return on_time_windows(split, ["event_type"], n=F.count("*"), cents=F.sum("cents"))


QUERIES: dict[str, Query] = {
    "src_bounded": src_bounded,
    "src_stream": src_stream,
    "src_rows_stream": src_rows_stream,
    "map_double": map_double,
    "map_square_filter_even": map_square_filter_even,
    "map_udf": map_udf,
    "flat_map_words": flat_map_words,
    "flat_map_udf": flat_map_udf,
    "flat_map_subevents": flat_map_subevents,
    "word_count": word_count,
    "key_by_colocated": key_by_colocated,
    "keyed_sum_final": keyed_sum_final,
    "keyed_sum_update_stream": keyed_sum_update_stream,
    "keyed_sum_rolling": keyed_sum_rolling,
    "keyed_sum_rolling_stream": keyed_sum_rolling_stream,
    "keyed_reduce_rolling": keyed_reduce_rolling,
    "keyed_aggregate": keyed_aggregate,
    "tumble_arrival_sum": tumble_arrival_sum,
    "tumble_arrival_stream": tumble_arrival_stream,
    "tumble_arrival_clock": tumble_arrival_clock,
    "tumble_event_sum": tumble_event_sum,
    "tumble_event_reduce": tumble_event_reduce,
    "tumble_event_built_in": tumble_event_built_in,
    "tumble_udaf_reduce": tumble_udaf_reduce,
    "tumble_udaf_combined": tumble_udaf_combined,
    "tumble_count_avg": tumble_count_avg,
    "count_window_sum": count_window_sum,
    "count_window_stream": count_window_stream,
    "timestamp_assign": timestamp_assign,
    "watermark_trace": watermark_trace,
    "watermark_trace_inputs": watermark_trace_inputs,
    "no_watermark_open_windows": no_watermark_open_windows,
    "window_emission": window_emission_query,
    "late_side_output": late_side_output,
    "late_main_output": late_main_output,
    "late_two_sinks": late_two_sinks,
    "late_batch_stream": late_batch_stream,
    "late_log_stream": late_log_stream,
    "late_windows_fold_stream": late_windows_fold_stream,
    "late_report": late_report_query,
    "late_correction": late_correction_query,
    "late_correction_stream": late_correction_stream,
    "late_changes_stream": late_changes_stream,
    "keyed_sum_rolling_cut": keyed_sum_rolling_cut,
    "tumble_udaf_reduce_cut": tumble_udaf_reduce_cut,
    "count_window_sum_cut": count_window_sum_cut,
    "late_main_output_salted": late_main_output_salted,
}
