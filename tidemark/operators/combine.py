"""Reduces given as a Python function, combined where the rows are read.

A group is folded before anything is shuffled. If the function is commutative, a reading task folds
its rows as they come, in a table by group. If it is only associative, the task sorts its rows and
folds them in runs; a run may stand for its rows only if no other task has a row of the group between
its first and its last. Runs that others reach into are thrown away: just the rows of those stretches
of arrival are read again and put in order by a shuffle. So rows that come roughly in order of
arrival, as those of a log do, leave a row per group and task, and few others.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import order_key, window_start
from tidemark.operators.folds import Combine, _gather, _walk, group_begins, reduce_groups
from tidemark.operators.measures import Measure, running
from tidemark.operators.stretches import TARGET_ROWS, check_order, same_keys
from tidemark.session import settle, written

# Rows of a run at most, so that rows another task reaches into cost no more than one such run.
RUN_ROWS = 1 << 16
# Groups a task holds at once if the function is commutative; then their values are sent on.
HELD_GROUPS = 100_000
# Stretches to read again that are broadcast; more are joined by shuffle.
BROADCAST_STRETCHES = 100_000


def hash_partials(df: DataFrame, keys: Sequence[str], values: Sequence[str], fn: Combine, held: int) -> DataFrame:
    """A row per group and task, rows folded in the order they are read."""
    rows = df.select(*keys, *values)
    n = len(keys)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[tuple, tuple] = {}
        schema = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*[(*k, *v) for k, v in table.items()]))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            schema = batch.schema
            columns = [c.to_pylist() for c in batch.columns]
            for key, value in zip(zip(*columns[:n]) if n else [()] * batch.num_rows, zip(*columns[n:])):
                known = table.get(key)
                table[key] = value if known is None else fn(known, value)
            if len(table) >= held:
                yield out()
                table.clear()
        if table:
            yield out()

    return rows.mapInArrow(combine, rows.schema)


def run_partials(
    rows: DataFrame, keys: Sequence[str], by: Sequence[str], to: Sequence[str], values: Sequence[str],
    fn: Combine, run_rows: int,
) -> DataFrame:
    """Runs of a group in one task: folded values, with the first place (``by``) and the last (``to``)."""
    last_place = [F.col(b).alias(t) for b, t in zip(by, to)]
    rows = rows.sortWithinPartitions(*keys, *by).select(*keys, *by, *last_place, *values)
    names = rows.columns
    begins_of = group_begins([names.index(c) for c in keys])
    at_to, at_value = [names.index(c) for c in to], [names.index(c) for c in values]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the first row of a run that may go on, its last row, its value and its length

        def done(runs: list[tuple]) -> pa.RecordBatch:
            first = pa.concat_batches([r[0] for r in runs])
            arrays = list(first.columns)
            for i in at_to:
                arrays[i] = pa.concat_arrays([r[1].column(i) for r in runs])
            for i, column in zip(at_value, zip(*[r[2] for r in runs])):
                arrays[i] = pa.array(column, type=first.schema.field(i).type)
            return pa.RecordBatch.from_arrays(arrays, schema=first.schema)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = list(zip(*[batch.column(i).to_pylist() for i in at_value]))
            goes_on = held is not None and len(begins_of(pa.concat_batches([held[1], batch[:1]]))) == 1
            finished = []
            if held is not None and not goes_on:
                finished.append(held)
                held = None
            begins = begins_of(batch).tolist()
            for begin, end in zip(begins, [*begins[1:], batch.num_rows]):
                while begin < end:
                    if held is None:
                        stop = min(end, begin + run_rows)
                        value = functools.reduce(fn, rows[begin:stop])
                        held = batch[begin : begin + 1], batch[stop - 1 : stop], value, stop - begin
                    else:
                        stop = min(end, begin + run_rows - held[3])
                        value = functools.reduce(fn, rows[begin:stop], held[2])
                        held = held[0], batch[stop - 1 : stop], value, held[3] + stop - begin
                    begin = stop
                    if held[3] >= run_rows or (stop == end and end < batch.num_rows):
                        finished.append(held)
                        held = None
            if finished:
                yield done(finished)
        if held is not None:
            yield done([held])

    return rows.mapInArrow(walk, rows.schema)


def combined_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    fn: Combine,
    target_rows: int = TARGET_ROWS,
    *,
    commutative: bool = False,
    run_rows: int = RUN_ROWS,
    held_groups: int = HELD_GROUPS,
    broadcast_stretches: int = BROADCAST_STRETCHES,
) -> DataFrame:
    """One row per key with its values combined in arrival order, by an associative function.

    Shuffled are a row per key and reading task, a row per ``run_rows`` rows, and, unless the
    function is commutative, the rows of stretches of arrival that several tasks share. The order
    must be unique and never null. ``df`` is read twice if there are such stretches and must give
    the same rows each time. Missing keys are a key, no rows give no rows, and a single row passes
    as it is.
    """
    if commutative:
        partials = hash_partials(df, keys, values, fn, held_groups)
        return _walk(_gather(partials, keys, [], values), keys, values, fn, each_row=False).select(*keys, *values)
    check_order(df, order)
    by, to = [f"_by_{i}" for i in range(len(order))], [f"_to_{i}" for i in range(len(order))]
    rows = df.select(*keys, *[F.col(c).alias(b) for c, b in zip(order, by)], *[F.col(c) for c in values])
    runs = written(run_partials(rows, keys, by, to, values, fn, run_rows))
    # A run is reached into if it begins before an earlier one has ended; such runs make a stretch.
    first, last = order_key(by), order_key(to)
    met = running(
        runs.select(*keys, *by, *to), keys, by, {"_before": Measure("max", last)}, before=True, target_rows=target_rows
    )
    begins = F.col("_before").isNull() | (first > F.col("_before"))
    placed = running(
        met.withColumn("_begins", F.when(begins, first)), keys, by, {"_stretch_from": Measure("max", F.col("_begins"))},
        target_rows=target_rows,
    )
    stretches = placed.groupBy(*keys, "_stretch_from").agg(F.max(last).alias("_stretch_to"), F.count("*").alias("_runs"))
    shared = settle(stretches.where("_runs > 1").select(*keys, "_stretch_from", "_stretch_to"))
    n_shared = shared.count()
    if n_shared:
        named = shared.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_stretch_from", "_stretch_to")
        named = F.broadcast(named) if n_shared <= broadcast_stretches else named
        same = same_keys(keys, "_of_") if keys else F.lit(True)
        inside = same & (first >= F.col("_stretch_from")) & (first <= F.col("_stretch_to"))
        at = [f"_at_{i}" for i in range(len(by))]
        begin = [F.col("_stretch_from") if len(by) == 1 else F.col(f"_stretch_from.{b}") for b in by]
        again = rows.join(named, inside).select(*keys, *by, *[c.alias(a) for c, a in zip(begin, at)], *values)
        again = reduce_groups(again, [*keys, *at], by, values, fn, target_rows, associative=True)
        again = again.select(*keys, *[F.col(a).alias(b) for a, b in zip(at, by)], *values)
        runs = runs.join(named, inside, "left_anti").select(*keys, *by, *values).unionByName(again)
    return reduce_groups(runs, keys, by, values, fn, target_rows, associative=True)


def tumbling_combined(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    size: int,
    values: Sequence[str],
    fn: Combine,
    target_rows: int = TARGET_ROWS,
    *,
    commutative: bool = False,
) -> DataFrame:
    """A reduce per key and window, combined where the rows are read."""
    placed = df.withColumn("window_start", window_start(ts, size))
    return combined_groups(placed, [*keys, "window_start"], order, values, fn, target_rows, commutative=commutative)
