"""Reduces given as a Python function.

Used where sum, count, min, max and first cannot express the combination. The function takes two
tuples of values, the earlier one first, and returns one. The caller says whether it is
associative. If so, rows of a hot key are combined in pieces, the pieces in arrival order. If not,
no key is ever cut, so each must fit one task (without keys: all rows), and results are those of
arrival order at any size. An aggregate with its own accumulator is the same after a ``select``
that turns each row into an accumulator.

Spark shuffles and sorts the rows; a task walks its sorted rows once and holds one value.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.measures import carried_by_size
from tidemark.operators.stretches import IS_ROW, STRETCH, TARGET_ROWS, Split, check_order, split_hot_keys, uncut

Combine = Callable[[tuple, tuple], tuple]
# Order columns of rows that stand for themselves.
PLACE = "_place_"


def group_begins(at_group: Sequence[int]) -> Callable[[pa.RecordBatch], np.ndarray]:
    """A function that tells where groups begin in sorted rows, by the columns at these places."""

    def starts(batch: pa.RecordBatch) -> np.ndarray:
        """Where a group begins. Missing equals missing, and NaN equals NaN."""
        changed = np.zeros(batch.num_rows, dtype=bool)
        changed[:1] = True
        for i in at_group:
            left, right = batch.column(i)[:-1], batch.column(i)[1:]
            differ = pc.fill_null(pc.not_equal(left, right), False)
            if pa.types.is_floating(left.type):
                both_nan = pc.fill_null(pc.and_(pc.is_nan(left), pc.is_nan(right)), False)
                differ = pc.and_(differ, pc.invert(both_nan))
            differ = pc.or_(differ, pc.not_equal(pc.is_null(left), pc.is_null(right)))
            changed[1:] |= differ.to_numpy(zero_copy_only=False)
        return np.flatnonzero(changed)

    return starts


def _walk(df: DataFrame, groups: Sequence[str], values: Sequence[str], fn: Combine, each_row: bool) -> DataFrame:
    """Combine consecutive rows of a group; give the last value, or the value at every row.

    What runs in the tasks is all defined in here, so that workers need nothing installed.
    """
    names = df.columns
    at_group = [names.index(c) for c in groups]
    at_value = [names.index(c) for c in values]

    starts = group_begins(at_group)

    def with_values(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        arrays = list(batch.columns)
        for i, column in zip(at_value, zip(*rows)):
            arrays[i] = pa.array(column, type=batch.schema.field(i).type)
        return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None  # the last row so far, and the value of its group
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = list(zip(*[batch.column(i).to_pylist() for i in at_value]))
            begins = starts(batch).tolist()
            ends = [*begins[1:], batch.num_rows]
            goes_on = last is not None and len(starts(pa.concat_batches([last, batch[:1]]))) == 1
            if last is not None and not goes_on and not each_row:
                yield with_values(last, [held])
            done = []
            for begin, end in zip(begins, ends):
                run = rows[begin:end]
                if begin == 0 and goes_on:
                    run[0] = fn(held, run[0])
                if each_row:
                    done.extend(accumulate(run, fn))
                    held = done[-1]
                else:
                    held = functools.reduce(fn, run)
                    done.append(held)
            last = batch[-1:]
            if each_row:
                yield with_values(batch, done)
            elif len(done) > 1:
                yield with_values(batch.take(pa.array(begins[:-1])), done[:-1])
        if last is not None and not each_row:
            yield with_values(last, [held])

    return df.mapInArrow(walk, df.schema)


def _gather(df: DataFrame, groups: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows of a group in one task and in order, with the columns a walk over groups needs."""
    # Without groups there is one row per stretch or task left by now.
    gathered = df.repartition(*groups) if groups else df.repartition(1)
    by = [*groups, *order]
    return (gathered.sortWithinPartitions(*by) if by else gathered).select(*groups, *values)


def _place(order: Sequence[str]) -> list[Column]:
    """The order under other names, as its columns may be among the values that are combined."""
    return [F.col(c).alias(f"_by_{c}") for c in order]


def _split(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], associative: bool, target_rows: int
) -> Split:
    check_order(df, order)
    return split_hot_keys(df, keys, order, target_rows) if associative else uncut(df)


def reduce_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    fn: Combine,
    target_rows: int = TARGET_ROWS,
    *,
    associative: bool,
) -> DataFrame:
    """One row per key with its values combined in arrival order. A single row passes as it is."""
    split = _split(df.select(*dict.fromkeys([*keys, *order, *values])), keys, order, associative, target_rows)
    groups = [*keys, STRETCH]
    by = [f"_by_{c}" for c in order]
    rows = split.rows.select(*groups, *_place(order), *values)
    pieces = _walk(_gather(rows, groups, by, values), groups, values, fn, each_row=False)
    if split.any_hot:
        pieces = _walk(_gather(pieces, keys, [STRETCH], values), keys, values, fn, each_row=False)
    return pieces.select(*keys, *values)


def running_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    fn: Combine,
    carried: DataFrame | None = None,
    target_rows: int = TARGET_ROWS,
    *,
    associative: bool,
) -> DataFrame:
    """One row per input row, its values replaced by those of its key combined so far.

    ``carried`` has, per key, the combined values of everything before this data.
    """
    split = _split(df.select(*dict.fromkeys([*keys, *order, *values])), keys, order, associative, target_rows)
    groups = [*keys, STRETCH]
    by = [f"_by_{c}" for c in order]
    rows = split.rows.select(*groups, *_place(order), *values, F.lit(1).alias(IS_ROW))
    whole, cut = carried_by_size(carried, split, keys)
    opening = [] if whole is None else [whole]
    if split.any_hot:
        hot = rows.where(F.col(STRETCH) > 0).drop(IS_ROW)
        pieces = _walk(_gather(hot, groups, by, values), groups, values, fn, each_row=False)
        if cut is not None:
            pieces = pieces.unionByName(cut)
        so_far = _walk(_gather(pieces, keys, [STRETCH], [STRETCH, *values]), keys, values, fn, each_row=True)
        follows = F.lead(STRETCH).over(Window.partitionBy(*keys).orderBy(STRETCH))
        opening.append(so_far.withColumn(STRETCH, follows).where(F.col(STRETCH).isNotNull()))
    for extra in opening:
        rows = rows.unionByName(extra.withColumn(IS_ROW, F.lit(0)), allowMissingColumns=True)
    walked = _walk(_gather(rows, groups, [IS_ROW, *by], [*by, IS_ROW, *values]), groups, values, fn, each_row=True)
    kept = [F.col(f"_by_{c}").alias(c) for c in order if c not in keys and c not in values]
    return walked.where(F.col(IS_ROW) == 1).select(*keys, *kept, *values)


@dataclass(frozen=True)
class Fold:
    """A function over named values, with the same methods as ``Measures``.

    Parts of a group are one row with its values combined. If the function is not associative, the
    rows of a batch cannot be combined by themselves: their parts are the rows, which are walked
    after the value of the batches before. As rows arrive in the order of the batches, that value
    is all that has to be kept.
    """

    values: tuple[str, ...]
    fn: Combine
    associative: bool

    @property
    def part_names(self) -> list[str]:
        return list(self.values)

    def parts(
        self, rows: DataFrame, groups: Sequence[str], order: Sequence[str], target_rows: int = TARGET_ROWS
    ) -> DataFrame:
        if not self.associative:
            check_order(rows, order)
            return rows.select(*groups, *[F.col(c).alias(f"{PLACE}{i}") for i, c in enumerate(order)], *self.values)
        return reduce_groups(rows, groups, order, self.values, self.fn, target_rows, associative=True)

    def groups(self, parts: DataFrame, groups: Sequence[str]) -> DataFrame:
        """The groups there are parts of, each once."""
        return parts if self.associative else parts.select(*groups).distinct()

    def merge(
        self, earlier: DataFrame | None, later: DataFrame, groups: Sequence[str], target_rows: int = TARGET_ROWS
    ) -> DataFrame:
        """If associative, two rows per group at most, so nothing can be hot."""
        places = [c for c in later.columns if c.startswith(PLACE)]
        if earlier is None and not places:
            return later
        both = later.withColumn(IS_ROW, F.lit(1))
        if earlier is not None:
            both = both.unionByName(earlier.withColumn(IS_ROW, F.lit(0)), allowMissingColumns=True)
        gathered = _gather(both, groups, [IS_ROW, *places], self.values)
        return _walk(gathered, groups, self.values, self.fn, each_row=False)

    def result(self, parts: DataFrame, groups: Sequence[str]) -> DataFrame:
        return parts.select(*groups, *self.values)

    def running(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        carried: DataFrame | None = None,
        target_rows: int = TARGET_ROWS,
    ) -> DataFrame:
        return running_groups(
            rows, keys, order, self.values, self.fn, carried, target_rows, associative=self.associative
        )

    def running_schema(self, rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> StructType:
        return rows.select(*dict.fromkeys([*keys, *order, *self.values])).schema
