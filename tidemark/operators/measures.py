"""Values that grow as rows arrive: sum, count, min, max and first.

Each can be merged from parts, so a group is summed up where it is read before anything is
shuffled, and a running value can go on from what came before. For running values every stretch
of a key gets one extra row at its start that holds what came before it; all rows are shuffled
once, however many rows a key has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from tidemark.functions.columns import order_key
from tidemark.operators.stretches import IS_ROW, STRETCH, TARGET_ROWS, Split, mark_hot, split_hot_keys


@dataclass(frozen=True)
class Measure:
    """One value over a column; ``kind`` is sum, count, min, max or first (to arrive)."""

    kind: str
    column: Column

    def start(self) -> Column:
        """The part a single row contributes."""
        if self.kind == "count":
            return F.when(self.column.isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
        return F.struct(self.column.alias("v")) if self.kind == "first" else self.column

    def merge(self, parts: Column, order: Column) -> Column:
        """The part of a group of parts."""
        if self.kind == "first":
            return F.min_by(parts, order)
        return self._combine(parts)

    def over(self, parts: Column, window) -> Column:
        """The part for everything met so far."""
        if self.kind == "first":
            return F.first(parts, ignorenulls=True).over(window)
        return self._combine(parts).over(window)

    def _combine(self, parts: Column) -> Column:
        return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[self.kind](parts)

    def finish(self, part: Column) -> Column:
        return part["v"] if self.kind == "first" else part


def _part(name: str) -> str:
    return f"_part_{name}"


@dataclass(frozen=True)
class Measures:
    """Named measures of a group. Parts of a group are columns that can be stored and merged."""

    named: Mapping[str, Measure]

    @property
    def part_names(self) -> list[str]:
        return [_part(n) for n in self.named]

    def started(self) -> list[Column]:
        return [m.start().alias(_part(n)) for n, m in self.named.items()]

    def merged(self, position: Column) -> list[Column]:
        return [m.merge(F.col(_part(n)), position).alias(_part(n)) for n, m in self.named.items()]

    def over(self, window) -> list[Column]:
        return [m.over(F.col(_part(n)), window).alias(_part(n)) for n, m in self.named.items()]

    def finished(self) -> list[Column]:
        return [m.finish(F.col(_part(n))).alias(n) for n, m in self.named.items()]

    def parts(
        self, rows: DataFrame, groups: Sequence[str], order: Sequence[str], target_rows: int = TARGET_ROWS
    ) -> DataFrame:
        """One row of parts per group."""
        started = rows.select(*dict.fromkeys([*groups, *order]), *self.started())
        return started.groupBy(*groups).agg(*self.merged(order_key(order)))

    def groups(self, parts: DataFrame, groups: Sequence[str]) -> DataFrame:
        """The groups there are parts of, each once."""
        return parts

    def merge(
        self, earlier: DataFrame | None, later: DataFrame, groups: Sequence[str], target_rows: int = TARGET_ROWS
    ) -> DataFrame:
        """Parts of a group from before and after, as one."""
        if earlier is None:
            return later
        both = later.withColumn(IS_ROW, F.lit(1)).unionByName(earlier.withColumn(IS_ROW, F.lit(0)))
        # Merging must not change the types, as a sum of decimals would.
        return _typed(both.groupBy(*groups).agg(*self.merged(F.col(IS_ROW))), later.schema)

    def result(self, parts: DataFrame, groups: Sequence[str]) -> DataFrame:
        return parts.select(*groups, *self.finished())

    def running(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        carried: DataFrame | None = None,
        target_rows: int = TARGET_ROWS,
    ) -> DataFrame:
        """One row per input row with the measures so far; ``carried`` has the parts from before."""
        check_exact(rows, self.named)
        return running_over(split_hot_keys(rows, keys, order, target_rows), keys, order, self, carried=carried)

    def running_schema(self, rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> StructType:
        return _plain(rows, keys, order, self).schema


def running_over(
    split: Split,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Measures,
    before: bool = False,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Running values per key over rows that already have their stretch.

    ``before`` leaves the row itself out of its value.
    """
    columns = [c for c in split.rows.columns if c != STRETCH]
    rows = split.rows.select(*columns, STRETCH, F.lit(1).alias(IS_ROW), *measures.started())
    whole, cut = carried_by_size(carried, split, keys)

    opening = [] if whole is None else [whole]
    if split.any_hot:
        totals = (
            rows.where(F.col(STRETCH) > 0).groupBy(*keys, STRETCH).agg(*measures.merged(order_key(order)))
        )
        if cut is not None:
            totals = totals.unionByName(cut)
        earlier = Window.partitionBy(*keys).orderBy(STRETCH).rowsBetween(Window.unboundedPreceding, -1)
        opening.append(totals.select(*keys, STRETCH, *measures.over(earlier)).where(F.col(STRETCH) > 0))

    for extra in opening:
        rows = rows.unionByName(extra.withColumn(IS_ROW, F.lit(0)), allowMissingColumns=True)
    window = (
        Window.partitionBy(*keys, *([STRETCH] if split.any_hot else []))
        .orderBy(*([IS_ROW] if opening else []), *order)
        .rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    )
    parts = rows.select(*columns, IS_ROW, *measures.over(window))
    done = parts.where(F.col(IS_ROW) == 1).select(*columns, *measures.finished())
    return _typed(done, _plain(split.rows.select(*columns), keys, order, measures).schema) if opening else done


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def _plain(rows: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Measures) -> DataFrame:
    """The same columns without stretches or carried parts: tells their types, is not run."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = rows.select("*", *measures.started()).select(*rows.columns, *measures.over(window))
    return parts.select(*rows.columns, *measures.finished())


def carried_by_size(
    carried: DataFrame | None, split: Split, keys: Sequence[str]
) -> tuple[DataFrame | None, DataFrame | None]:
    """Carried rows of keys that are whole, and of keys that are cut; both stand before stretch 1."""
    if carried is None:
        return None, None
    first = F.lit(0).cast("long")
    if not split.any_hot:
        return carried.withColumn(STRETCH, first), None
    if split.hot is None:
        return None, carried.withColumn(STRETCH, first)
    marked = mark_hot(carried, split.hot, keys).withColumn(STRETCH, first)
    return marked.where(F.col("_hot").isNull()).drop("_hot"), marked.where("_hot").drop("_hot")


def check_exact(rows: DataFrame, named: Mapping[str, Measure]) -> None:
    """Refuse running sums of floating numbers: they would depend on where a key is cut."""
    for name, measure in named.items():
        if measure.kind == "sum":
            kind = rows.select(F.sum(measure.column).alias("s")).schema["s"].dataType
            if isinstance(kind, (FloatType, DoubleType)):
                raise TypeError(f"running sum {name!r} needs whole numbers or decimals, not {kind.simpleString()}")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Measure],
    before: bool = False,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """One output row per input row, with the measures of its key so far. ``order`` must be unique."""
    check_exact(df, measures)
    split = split_hot_keys(df, keys, order, target_rows)
    return running_over(split, keys, order, Measures(measures), before)
