import random

import pytest
from pyspark.sql import functions as F

from tests import brute
from tests.data import PAIRS, WORD_ONES, WORD_SUMS, WORD_SUMS_SO_FAR
from tidemark.operators import keyed
from tidemark.operators.folds import reduce_groups, running_groups
from tidemark.operators.measures import Measure, running
from tidemark.operators.stretches import STRETCH, find_cuts, split_hot_keys, with_stretch
from tidemark.sources.tables import from_rows


def skewed(n=600, seed=3):
    """A third of the rows has one key; values may be negative."""
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}", rng.randrange(-50, 100)) for _ in range(n)
    ]


def test_final_sum(spark):
    df = from_rows(spark, WORD_ONES, PAIRS)
    got = {r["key"]: r["value"] for r in keyed.keyed_sum(df, ["key"], "value").collect()}
    assert got == WORD_SUMS


@pytest.mark.parametrize("target_rows", [1_000_000, 2, 1])
def test_running_sum(spark, target_rows):
    df = from_rows(spark, WORD_ONES, PAIRS)
    out = keyed.running_sum(df, ["key"], ["seq"], "value", "so_far", target_rows).orderBy("seq").collect()
    assert [r["so_far"] for r in out] == WORD_SUMS_SO_FAR
    assert [(r["key"], r["value"]) for r in out] == WORD_ONES


@pytest.mark.parametrize("target_rows", [1_000_000, 50, 7])
def test_running_measures_on_a_hot_key(spark, target_rows):
    rows = skewed()
    df = from_rows(spark, rows, PAIRS).repartition(7)
    measures = {
        "total": Measure("sum", F.col("value")),
        "n": Measure("count", F.col("value")),
        "low": Measure("min", F.col("value")),
        "high": Measure("max", F.col("value")),
        "first": Measure("first", F.col("value")),
    }
    out = running(df, ["key"], ["seq"], measures, target_rows=target_rows).orderBy("seq").collect()

    def grow(a, b):
        return (a[0] + b[0], a[1] + b[1], min(a[2], b[2]), max(a[3], b[3]), a[4])

    expected = brute.running([(k, (v, 1, v, v, v)) for k, v in rows], grow)
    assert [(r["total"], r["n"], r["low"], r["high"], r["first"]) for r in out] == expected


def test_running_values_with_missing_keys_and_values(spark):
    rows = [(None, 1), ("a", None), (None, 2), ("a", 3), (None, None), ("a", 4)] * 5
    df = from_rows(spark, rows, PAIRS)
    measures = {"n": Measure("count", F.col("value")), "first": Measure("first", F.col("value"))}
    for target_rows in (1000, 4):
        out = running(df, ["key"], ["seq"], measures, target_rows=target_rows).orderBy("seq").collect()
        seen, expected = {}, []
        for key, value in rows:
            held = seen.setdefault(key, [0, value])
            held[0] += value is not None
            expected.append(tuple(held))
        assert [(r["n"], r["first"]) for r in out] == expected


def test_running_without_a_key_leaving_the_row_out(spark):
    rows = skewed(200)
    df = from_rows(spark, rows, PAIRS)
    out = running(df, [], ["seq"], {"high": Measure("max", F.col("value"))}, before=True, target_rows=20)
    values = [v for _, v in rows]
    expected = [None] + [max(values[:i]) for i in range(1, len(values))]
    assert [r["high"] for r in out.orderBy("seq").collect()] == expected


def test_last_running_sum_is_the_final_sum(spark):
    df = from_rows(spark, skewed(), PAIRS)
    final = {r["key"]: r["value"] for r in keyed.keyed_sum(df, ["key"], "value").collect()}
    out = keyed.running_sum(df, ["key"], ["seq"], "value", "so_far", 30)
    last = out.groupBy("key").agg(F.max_by("so_far", "seq").alias("value"))
    assert {r["key"]: r["value"] for r in last.collect()} == final


def test_stretches_follow_the_order_and_stay_small(spark):
    # Two thirds of the rows arrive at the same moment.
    rows = [(5 if i % 3 else i,) for i in range(900)]
    df = from_rows(spark, rows, "at BIGINT")
    cuts = find_cuts(df, ["at", "seq"], 18)
    placed = with_stretch(df, ["at", "seq"], cuts).orderBy("at", "seq").collect()
    stretches = [r[STRETCH] for r in placed]
    assert stretches == sorted(stretches)
    sizes = [stretches.count(s) for s in set(stretches)]
    assert max(sizes) <= 2 * 900 / 18


def test_large_order_numbers_that_are_equal_as_doubles(spark):
    base = 2**60
    rows = [("k", i) for i in range(300)]
    df = from_rows(spark, rows, PAIRS).withColumn("at", F.lit(base) + F.col("seq")).withColumn("tie", -F.col("seq"))
    out = running(df, ["key"], ["at", "tie"], {"s": Measure("sum", F.col("value"))}, target_rows=20)
    assert [r["s"] for r in out.orderBy("seq").collect()] == [sum(range(i + 1)) for i in range(300)]


def test_ties_in_the_order_are_broken_by_the_second_column(spark):
    rows = skewed(300)
    df = from_rows(spark, rows, PAIRS).withColumn("at", F.lit(1).cast("long"))
    out = running(df, ["key"], ["at", "seq"], {"s": Measure("sum", F.col("value"))}, target_rows=10)
    assert [r["s"] for r in out.orderBy("seq").collect()] == brute.running(rows, lambda a, b: a + b)


def test_only_hot_keys_are_cut(spark):
    df = from_rows(spark, skewed(), PAIRS)
    split = split_hot_keys(df, ["key"], ["seq"], 60)
    cut = split.rows.groupBy("key").agg(F.min(STRETCH).alias("low"), F.count_distinct(STRETCH).alias("n"), F.count("*").alias("rows"))
    for row in cut.collect():
        if row["rows"] > 120:
            assert row["low"] >= 1 and row["n"] > 1
        elif row["rows"] < 30:
            assert row["low"] == 0 and row["n"] == 1


def test_a_sample_is_enough_to_find_hot_keys(spark):
    df = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50_000).alias("key"),
        F.col("id").alias("seq"),
        F.lit(1).alias("value"),
    )
    split = split_hot_keys(df, ["key"], ["seq"], 10_000)
    sizes = split.rows.groupBy("key", STRETCH).count()
    assert [r["key"] for r in split.hot.collect()] == [-1]
    assert sizes.agg(F.max("count")).first()[0] < 20_000
    out = running(df, ["key"], ["seq"], {"n": Measure("count", F.col("value"))}, target_rows=10_000)
    assert out.where("key = -1").agg(F.max("n"), F.sum("n")).first() == (133_334, 133_334 * 133_335 // 2)
    assert out.count() == 400_000


@pytest.mark.parametrize("target_rows", [1_000_000, 40])
def test_count_windows(spark, target_rows):
    rows = skewed()
    out = keyed.count_windows(from_rows(spark, rows, PAIRS), ["key"], ["seq"], "value", 10, target_rows)
    got = {(r["key"], r["window_no"]): (r["value"], r["complete"]) for r in out.collect()}
    assert got == brute.count_windows(rows, 10)


def test_aggregate_with_floored_mean(spark):
    df = from_rows(spark, [("a", -3), ("a", 0), ("b", 7), ("c", None)], PAIRS)
    got = {r["key"]: (r["total"], r["n"], r["mean"]) for r in keyed.keyed_aggregate(df, ["key"], "value").collect()}
    assert got == {"a": (-3, 2, -2), "b": (7, 1, 7), "c": (None, 0, None)}


def test_each_key_is_on_one_partition(spark):
    df = from_rows(spark, skewed(), PAIRS).repartition(8)
    out = keyed.colocation(df, ["key"], 8).collect()
    assert {r["partitions"] for r in out} == {1}
    assert sum(r["n"] for r in out) == 600


def join_text():
    """Associative, but not commutative: shows up any change of order."""
    return lambda a, b: (a[0] + "," + b[0],)


@pytest.mark.parametrize("target_rows", [1_000_000, 25])
def test_reduce_function_keeps_arrival_order(spark, target_rows):
    rows = [(k, str(v)) for k, v in skewed(400)]
    df = from_rows(spark, rows, "key STRING, v STRING").repartition(5)
    got = {r["key"]: r["v"] for r in reduce_groups(df, ["key"], ["seq"], ["v"], join_text(), target_rows, associative=True).collect()}
    expected = {}
    for key, v in rows:
        expected[key] = expected[key] + "," + v if key in expected else v
    assert got == expected


@pytest.mark.parametrize("target_rows", [1_000_000, 25])
def test_running_reduce_function(spark, target_rows):
    rows = [(k, str(v)) for k, v in skewed(400)]
    df = from_rows(spark, rows, "key STRING, v STRING").repartition(5)
    out = running_groups(df, ["key"], ["seq"], ["v"], join_text(), target_rows=target_rows, associative=True).orderBy("seq")
    assert [r["v"] for r in out.collect()] == brute.running(rows, lambda a, b: a + "," + b)


def test_single_row_group_never_calls_the_function(spark):
    def fail(a, b):
        raise AssertionError("called")

    df = from_rows(spark, [("a", None), ("b", 2)], PAIRS)
    got = {r["key"]: r["value"] for r in reduce_groups(df, ["key"], ["seq"], ["value"], fail, associative=True).collect()}
    assert got == {"a": None, "b": 2}


@pytest.mark.parametrize("target_rows", [1_000_000, 5])
def test_types_do_not_depend_on_cutting(spark, target_rows):
    df = from_rows(spark, [("k", i) for i in range(30)], PAIRS).withColumn("d", F.col("value").cast("decimal(10,2)"))
    measures = {"i": Measure("sum", F.col("value")), "d_sum": Measure("sum", F.col("d"))}
    out = running(df, ["key"], ["seq"], measures, target_rows=target_rows)
    assert (out.schema["i"].dataType.simpleString(), out.schema["d_sum"].dataType.simpleString()) == (
        "bigint", "decimal(20,2)",
    )


def test_groups_that_span_batches_and_odd_keys(spark):
    nan = float("nan")
    rows = [(k, str(i)) for i in range(40) for k in (None, nan, 1.0, 2.0)]
    df = from_rows(spark, rows, "key DOUBLE, v STRING")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted(r["v"] for r in reduce_groups(df, ["key"], ["seq"], ["v"], join_text(), associative=True).collect())
        assert got == [",".join(map(str, range(40)))] * 4
        out = running_groups(df, ["key"], ["seq"], ["v"], join_text(), associative=True).orderBy("seq").collect()
        assert [r["v"] for r in out] == [",".join(map(str, range(i + 1))) for i in range(40) for _ in range(4)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_aggregate_with_an_accumulator_of_its_own(spark):
    df = from_rows(spark, skewed(), PAIRS).withColumns({"total": F.col("value").cast("long"), "n": F.lit(1)})
    held = reduce_groups(df, ["key"], ["seq"], ["total", "n"], lambda a, b: (a[0] + b[0], a[1] + b[1]), 50, associative=True)
    got = {r["key"]: (r["total"], r["n"]) for r in held.collect()}
    expected = keyed.keyed_aggregate(df, ["key"], "value").collect()
    assert got == {r["key"]: (r["total"], r["n"]) for r in expected}


def test_empty_input(spark):
    df = from_rows(spark, [], PAIRS)
    for keys in ([], ["key"]):
        assert running(df, keys, ["seq"], {"s": Measure("sum", F.col("value"))}).count() == 0
    assert reduce_groups(df, ["key"], ["seq"], ["value"], lambda a, b: a, associative=True).count() == 0
    assert keyed.count_windows(df, ["key"], ["seq"], "value", 3).count() == 0


ORDERS = {
    "text": lambda: F.format_string("event-%05d", F.col("seq") * 7),
    "any_text": lambda: F.concat(F.conv(F.col("seq"), 10, 36), F.lit("x")),
    "date": lambda: F.date_add(F.lit("1969-06-01").cast("date"), F.col("seq").cast("int")),
    "ntz": lambda: (F.lit("2024-03-10 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("seq").cast("int"))),
    "decimal": lambda: F.col("seq").cast("decimal(30,10)"),
}


@pytest.mark.parametrize("kind", ORDERS)
def test_any_order_gives_the_same_at_any_size(spark, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = from_rows(spark, skewed(300), PAIRS).withColumn("at", ORDERS[kind]())
        for keys in (["key"], []):
            for order in (["at"], ["at", "seq"], ["seq", "at"]):
                sums = {"s": Measure("sum", F.col("value"))}
                whole, cut = (
                    sorted(map(tuple, running(df, keys, order, sums, target_rows=n).select("seq", "s").collect()))
                    for n in (1_000_000, 10)
                )
                assert whole == cut
                rows = sorted(df.collect(), key=lambda r: [r[c] for c in order])
                so_far, expected = {}, []
                for r in rows:
                    key = r["key"] if keys else None
                    so_far[key] = so_far.get(key, 0) + r["value"]
                    expected.append((r["seq"], so_far[key]))
                assert whole == sorted(expected)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("kind", ["text", "date", "ntz"])
def test_hot_keys_are_cut_by_any_order(spark, kind):
    df = from_rows(spark, [("k", i) for i in range(300)], PAIRS).withColumn("at", ORDERS[kind]())
    sizes = split_hot_keys(df, ["key"], ["at"], 20).rows.groupBy(STRETCH).count()
    assert sizes.agg(F.max("count")).first()[0] <= 40


@pytest.mark.parametrize("target_rows", [1_000_000, 10])
def test_what_cannot_be_cut_is_refused_at_any_size(spark, target_rows):
    df = from_rows(spark, skewed(50), PAIRS).withColumn("at", F.col("seq") % 2 == 0)
    for keys in ([], ["key"]):
        with pytest.raises(TypeError, match="must be a number"):
            running(df, keys, ["at"], {"s": Measure("sum", F.col("value"))}, target_rows=target_rows)
        with pytest.raises(TypeError, match="whole numbers or decimals"):
            running(df, keys, ["seq"], {"s": Measure("sum", F.col("value") / 2)}, target_rows=target_rows)


@pytest.mark.parametrize("target_rows", [1_000_000, 10])
def test_a_function_that_is_not_associative_keeps_arrival_order(spark, target_rows):
    df = from_rows(spark, [("k", i) for i in range(40)], PAIRS).repartition(3)
    minus = lambda a, b: (a[0] - b[0],)
    held = reduce_groups(df, ["key"], ["seq"], ["value"], minus, target_rows, associative=False)
    assert [r["value"] for r in held.collect()] == [-780]
    out = running_groups(df, ["key"], ["seq"], ["value"], minus, target_rows=target_rows, associative=False)
    assert [r["value"] for r in out.orderBy("seq").collect()] == [-i * (i + 1) // 2 for i in range(40)]
    with pytest.raises(TypeError):
        reduce_groups(df, ["key"], ["seq"], ["value"], minus, target_rows)
