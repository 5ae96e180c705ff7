"""Reduces by a function, folded before the shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from tests import brute
from tidemark.operators import combine
from tidemark.operators.combine import combined_groups, run_partials, tumbling_combined
from tidemark.sources.tables import from_rows

PAIRS = "key STRING, v STRING"


@pytest.fixture
def joined():
    return lambda a, b: (a[0] + "," + b[0],)


def _plain(rows):
    last = {}
    for (key, _), value in zip(rows, brute.running(rows, lambda a, b: a + "," + b)):
        last[key] = value
    return last


def _rows(n, seed, keys=(None, "hot", "hot", "a", "b")):
    rng = random.Random(seed)
    return [(rng.choice(keys), str(rng.randrange(99))) for _ in range(n)]


@pytest.mark.parametrize("run_rows", [1, 7, 1000])
@pytest.mark.parametrize("spread", ["clustered", "overlapping", "interleaved"])
def test_any_layout_gives_arrival_order(spark, run_rows, spread, joined):
    rows = _rows(400, 3)
    df = from_rows(spark, rows, PAIRS)
    if spread == "clustered":
        df = df.repartitionByRange(6, "seq")
    elif spread == "overlapping":
        df = df.repartitionByRange(6, F.col("seq") + F.col("seq") * 7919 % 40)
    else:
        df = df.repartition(6, "seq")
    got = combined_groups(df, ["key"], ["seq"], ["v"], joined, run_rows=run_rows).collect()
    assert {r["key"]: r["v"] for r in got} == _plain(rows)


@pytest.mark.parametrize("limits", [{}, {"broadcast_stretches": 0, "target_rows": 20}])
def test_two_order_columns_and_no_keys(spark, limits, joined):
    rows = _rows(200, 5, ("only",))
    df = from_rows(spark, rows, PAIRS).withColumns({"at": F.floor(F.col("seq") / 9)}).repartition(5, "seq")
    got = combined_groups(df, [], ["at", "seq"], ["v"], joined, run_rows=16, **limits).collect()
    assert [r["v"] for r in got] == [_plain(rows)["only"]]
    got = combined_groups(df, ["key"], ["at", "seq"], ["v"], joined, run_rows=16, **limits).collect()
    assert [r["v"] for r in got] == [_plain(rows)["only"]]


def test_clustered_rows_leave_a_row_per_group_and_task(spark, monkeypatch, joined):
    """What is shuffled on input in the order of arrival: no row is read again."""
    df = from_rows(spark, _rows(600, 9), PAIRS).repartitionByRange(6, "seq").withColumnRenamed("seq", "_by_0")
    runs = run_partials(df, ["key"], ["_by_0"], ["_to_0"], ["v"], joined, combine.RUN_ROWS)
    assert runs.count() == 6 * 4
    again = []
    monkeypatch.setattr(combine, "reduce_groups", lambda df, keys, *a, **k: again.append(keys) or df)
    combined_groups(df, ["key"], ["_by_0"], ["v"], joined)
    assert again == [["key"]]


def test_only_shared_stretches_are_read_again(spark, monkeypatch, joined):
    """Two tasks reach into each other around one row; the runs far from it stay."""
    df = from_rows(spark, [("k", str(i)) for i in range(1000)], PAIRS)
    task = F.when(F.col("seq") == 499, 1).when(F.col("seq") == 501, 0).otherwise(F.floor(F.col("seq") / 500))
    df = df.withColumn("task", task).repartitionByRange(2, "task")
    seen = {}
    plain = combine.reduce_groups

    def counted(rows, keys, *args, **more):
        seen[len(keys)] = rows.count()
        return plain(rows, keys, *args, **more)

    monkeypatch.setattr(combine, "reduce_groups", counted)
    got = combined_groups(df, ["key"], ["seq"], ["v"], joined, run_rows=10).collect()
    assert got[0]["v"] == ",".join(map(str, range(1000)))
    assert seen[2] <= 40 and seen[1] <= 105


@pytest.mark.parametrize("held_groups", [1, 3, 100_000])
def test_commutative_functions_in_any_order(spark, held_groups):
    rows = [(k, int(v)) for k, v in _rows(300, 7)]
    df = from_rows(spark, rows, "key STRING, v INT").repartition(5)
    add = lambda a, b: (a[0] + b[0],)
    got = combined_groups(df, ["key"], ["seq"], ["v"], add, commutative=True, held_groups=held_groups).collect()
    assert {r["key"]: r["v"] for r in got} == {k: sum(v for x, v in rows if x == k) for k, _ in rows}
    total = combined_groups(df, [], ["seq"], ["v"], add, commutative=True).collect()
    assert [r["v"] for r in total] == [sum(v for _, v in rows)]


def test_not_a_number_is_one_key_and_no_rows_are_none(spark):
    df = spark.createDataFrame([(i, float("nan"), 1) for i in range(6)], "seq long, key double, v int").repartition(3)
    add = lambda a, b: (a[0] + b[0],)
    for commutative in (False, True):
        assert [r["v"] for r in combined_groups(df, ["key"], ["seq"], ["v"], add, commutative=commutative).collect()] == [6]
        none = combined_groups(df.where("v > 1"), ["key"], ["seq"], ["v"], add, commutative=commutative)
        assert none.columns == ["key", "v"] and none.count() == 0


def test_windows_whose_values_are_order_columns(spark):
    df = from_rows(spark, [("a", 5), ("a", 7), ("b", 1), ("a", 12)], "key STRING, t BIGINT")
    first = lambda a, b: a
    got = tumbling_combined(df, ["key"], "t", ["seq"], 10, ["seq", "t"], first).collect()
    assert sorted(map(tuple, got)) == [("a", 0, 0, 5), ("a", 10, 3, 12), ("b", 0, 2, 1)]
