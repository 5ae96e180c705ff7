"""Keyed totals on streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from tidemark.operators.folds import Fold
from tidemark.operators.measures import Measures
from tidemark.operators.stretches import TARGET_ROWS
from tidemark.session import passing
from tidemark.streaming.runner import finish, start_batches
from tidemark.streaming.state import commit, read_all_keyed, read_batches, read_keyed, write_batch, write_keyed


def update_totals(
    stream: DataFrame,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    name: str,
    root: str,
    timeout: float | None = None,
) -> DataFrame:
    """Totals per key, kept up to date: each batch gives the keys it changed, the newest counts.

    Spark keeps the totals in its state store. A batch only writes the keys it changed; all keys
    are brought together when they are read, and now and then by a full write.
    """
    totals = stream.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])

    def upsert(changed: DataFrame, batch: int) -> None:
        write_keyed(changed, root, "newest", batch, keys)
        commit(changed.sparkSession, root, batch)

    finish(start_batches(totals, name, upsert, f"{root}/checkpoint", mode="update"), timeout)
    return read_all_keyed(stream.sparkSession, root, "newest", totals.schema, keys)


def running_batches(
    keys: Sequence[str],
    order: Sequence[str],
    reduce: Measures | Fold,
    root: str,
    target_rows: int = TARGET_ROWS,
) -> Callable[[DataFrame, int], None]:
    """A batch function: a row with the running values per input row, the totals carried along.

    Rows arrive in the order of the batches and, inside one, by ``order``. Hot keys are cut inside
    each batch as they are in bounded data.
    """

    def each(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        rows, parts = rows.persist(), None
        try:
            with passing(spark):
                parts = reduce.parts(rows, keys, order, target_rows).persist()
                carried, touched = None, reduce.groups(parts, keys)
                if batch > 0:
                    schema = parts.select(*keys, *reduce.part_names).schema
                    carried = read_keyed(spark, root, "totals", batch - 1, schema, keys, touched)
                write_batch(reduce.running(rows, keys, order, carried, target_rows), root, "running", batch)
                write_keyed(reduce.merge(carried, parts, keys), root, "totals", batch, keys)
                commit(spark, root, batch)
        finally:
            rows.unpersist()
            if parts is not None:
                parts.unpersist()

    return each


def running_stream(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    reduce: Measures | Fold,
    name: str,
    root: str,
    target_rows: int = TARGET_ROWS,
    timeout: float | None = None,
) -> DataFrame:
    """Run to the end of the input; one row per input row with the values of its key so far."""
    each = running_batches(keys, order, reduce, root, target_rows)
    finish(start_batches(stream, name, each, f"{root}/checkpoint"), timeout)
    schema = reduce.running_schema(stream, keys, order)
    return read_batches(stream.sparkSession, root, "running", schema).drop("batch")
