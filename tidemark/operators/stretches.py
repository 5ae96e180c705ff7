"""Splitting hot keys into stretches of arrival order.

Anything that needs the rows of a key in order would, in the plain form, put a whole key into one
task. Here a key with too many rows is cut into stretches that follow each other in arrival order,
each small enough for a task.

Which keys are hot and where the cuts lie is taken from a sample, which keeps the preparation to a
count and one pass without a shuffle. Both only decide how even the work is: they are fixed by the
time the plan is built, every row is kept, and any choice gives the same results.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tidemark.session import settle

# Rows one task may hold of one key. Keys above it are cut.
TARGET_ROWS = 1_000_000
# Upper bound on stretches; the target rises with the data to keep it.
MAX_STRETCHES = 100_000
# Sampled rows per TARGET_ROWS rows. A key with half of them counts as hot.
SAMPLES_PER_STRETCH = 64
# Whole numbers below this are exact as doubles.
EXACT = 2.0**53
# Bytes of a text, after those all rows share, that its number is made of.
TEXT_BYTES = 6

STRETCH = "_stretch"
IS_ROW = "_is_row"


@dataclass(frozen=True)
class Cuts:
    """Cut points in the first order column and, inside its heavily repeated values, in the second."""

    first: list[float] = field(default_factory=list)
    repeated: list[float] = field(default_factory=list)
    second: list[float] = field(default_factory=list)
    shared: Mapping[str, int] = field(default_factory=dict)


def _is_text(kind: DataType) -> bool:
    # Texts under another collation are not ordered by their bytes.
    return isinstance(kind, StringType) and kind.simpleString() == "string"


def check_order(df: DataFrame, order: Sequence[str]) -> None:
    """Refuse order columns that could not be cut, whether or not the data is large enough to be."""
    for column in order[:2]:
        kind = df.schema[column].dataType
        if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)) and not _is_text(kind):
            raise TypeError(f"order column {column!r} must be a number, time or text, not {kind.simpleString()}")


def _shared_bytes(low: str | None, high: str | None) -> int:
    """Leading bytes that the smallest and the largest text have in common, and so all between."""
    a, b = (low or "").encode(), (high or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _count(df: DataFrame, order: Sequence[str]) -> tuple[int, dict[str, int]]:
    """Rows, and the leading bytes shared by the texts of an order column; one pass."""
    texts = [c for c in order[:2] if _is_text(df.schema[c].dataType)]
    if not texts:
        return df.count(), {}
    ends = [f(c) for c in texts for f in (F.min, F.max)]
    total, *found = df.agg(F.count("*"), *ends).first()
    return total, {c: _shared_bytes(*found[2 * i : 2 * i + 2]) for i, c in enumerate(texts)}


def _number(df: DataFrame, column: str, shared: Mapping[str, int]) -> Column:
    """An order column as a double; never decreases where the column increases."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, DateType):
        value = F.unix_date(value)
    elif isinstance(kind, TimestampNTZType):
        # By its parts, as a clock without a zone has no gaps that a session zone would bring.
        seconds = F.hour(value) * 3600 + F.minute(value) * 60 + F.extract(F.lit("SECOND"), value)
        value = F.unix_date(value.cast("date")).cast("double") * 86_400_000_000 + seconds * 1_000_000
    elif _is_text(kind):
        part = F.substring(value.cast("binary"), shared.get(column, 0) + 1, TEXT_BYTES)
        value = F.conv(F.rpad(F.hex(part), 2 * TEXT_BYTES, "0"), 16, 10)
    return value.cast("double")


def _quantiles(df: DataFrame, column: str, pieces: int, shared: Mapping[str, int]) -> list[float]:
    if pieces < 2:
        return []
    shares = [i / pieces for i in range(1, pieces)]
    return df.select(_number(df, column, shared).alias("x")).approxQuantile("x", shares, 1.0 / (4 * pieces))


def find_cuts(
    sample: DataFrame, order: Sequence[str], pieces: int, shared: Mapping[str, int] | None = None
) -> Cuts:
    """Cut points that divide rows like the sampled ones into about ``pieces`` stretches.

    A value that fills more than one piece by itself is set apart and cut by the second order
    column. As that column tells rows apart, no stretch stays large. Texts are told apart by six
    bytes after those that all share (``shared``); those that differ later stay together.
    """
    shared = shared or {}
    found = _quantiles(sample, order[0], pieces, shared)
    repeated = sorted({x for x, y in zip(found, found[1:]) if x == y})
    edges = sorted(set(found) | {math.nextafter(x, math.inf) for x in repeated})
    # Different values that look equal as doubles stay in one stretch, where their order counts.
    kind = sample.schema[order[0]].dataType
    inexact = isinstance(kind, DecimalType) or _is_text(kind)
    repeated = [] if inexact else [x for x in repeated if abs(x) < EXACT]
    second: list[float] = []
    if repeated and len(order) > 1:
        tied = sample.where(_number(sample, order[0], shared).isin(repeated))
        second = sorted(set(_quantiles(tied, order[1], pieces, shared)))
    return Cuts(edges, repeated, second, shared)


def _position(df: DataFrame, column: str, edges: list[float], out: str, shared: Mapping[str, int]) -> DataFrame:
    if not edges:
        return df.withColumn(out, F.lit(0).cast("long"))
    placed = Bucketizer(
        splits=[-math.inf, *edges, math.inf], inputCol=f"{out}_in", outputCol=f"{out}_at", handleInvalid="keep"
    ).transform(df.withColumn(f"{out}_in", _number(df, column, shared)))
    # A missing value sorts first.
    at = F.coalesce(F.col(f"{out}_at").cast("long"), F.lit(0))
    return placed.withColumn(out, at).drop(f"{out}_in", f"{out}_at")


def with_stretch(df: DataFrame, order: Sequence[str], cuts: Cuts) -> DataFrame:
    """Number the stretches from 1 in arrival order."""
    placed = _position(df, order[0], cuts.first, STRETCH, cuts.shared)
    if not cuts.second:
        return placed.withColumn(STRETCH, F.col(STRETCH) + 1)
    inside = "_inside"
    placed = _position(placed, order[1], cuts.second, inside, cuts.shared)
    tied = _number(df, order[0], cuts.shared).isin(cuts.repeated)
    offset = F.when(tied, F.col(inside)).otherwise(0)
    return placed.withColumn(STRETCH, F.col(STRETCH) * (len(cuts.second) + 1) + offset + 1).drop(inside)


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Equality of keys with those under prefixed names; a missing key equals a missing key."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def mark_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_hot``. The table of hot keys has at most two rows per stretch, so it is broadcast."""
    small = F.broadcast(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot")))
    return df.join(small, same_keys(keys, "_hot_"), "left").drop(*[f"_hot_{k}" for k in keys])


@dataclass(frozen=True)
class Split:
    """Rows with their stretch: 0 for keys that fit a task, from 1 for pieces of hot keys."""

    rows: DataFrame
    hot: DataFrame | None
    any_hot: bool


def uncut(df: DataFrame) -> Split:
    """Every key whole, however many rows it has."""
    return Split(df.withColumn(STRETCH, F.lit(0).cast("long")), None, False)


def split_hot_keys(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], target_rows: int = TARGET_ROWS
) -> Split:
    """Cut keys with more than about ``target_rows`` rows.

    Without keys, all rows form one sequence and are always cut, at least once per task slot.
    Counts, samples and cuts are found while the plan is built: ``df`` is evaluated up to four
    times and must give the same rows each time.
    """
    check_order(df, order)
    whole = uncut(df)
    total, shared = _count(df, order)
    target = max(target_rows, math.ceil(total / MAX_STRETCHES))
    pieces = math.ceil(total / target)
    if not keys:
        pieces = max(pieces, df.sparkSession.sparkContext.defaultParallelism)
        sample = _sample(df.select(*order), total, pieces)
        return Split(with_stretch(df, order, find_cuts(sample, order, pieces, shared)), None, True)
    if total <= target:
        return whole

    sample = settle(_sample(df.select(*dict.fromkeys([*keys, *order])), total, pieces))
    share = min(1.0, SAMPLES_PER_STRETCH * pieces / total)
    hot = sample.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > share * target / 2)
    hot = settle(hot)
    sampled = hot.agg(F.sum("_rows")).first()[0]
    if not sampled:
        return whole
    pieces = max(2, math.ceil(sampled / (share * target)))
    cuts = find_cuts(mark_hot(sample, hot, keys).where("_hot"), order, pieces, shared)
    placed = with_stretch(mark_hot(df, hot, keys), order, cuts)
    placed = placed.withColumn(STRETCH, F.when(F.col("_hot"), F.col(STRETCH)).otherwise(F.lit(0).cast("long")))
    return Split(placed.drop("_hot"), hot, True)


def _sample(df: DataFrame, rows: int, pieces: int) -> DataFrame:
    """Some tens of rows per piece, so its size is bounded by the number of pieces."""
    share = SAMPLES_PER_STRETCH * pieces / max(rows, 1)
    return df if share >= 1.0 else df.sample(share, seed=17)
