"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import keyed, late, watermark, windows
from tidemark.operators.late import late_rows, late_split, on_time_windows
from tidemark.plans.queries import HOUR, LATE_BOUND, ORDER, QUERIES
from tidemark.session import settle
from tidemark.sources.tables import arrivals, read_table

DATA = "/root/testdata/sf0.01"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan_paths(plan: str) -> list[list[str]]:
    """For every scan the nodes its rows go through, nearest first."""
    path, found = [], []
    for line in plan.splitlines():
        node = re.search(r"[A-Za-z].*", re.sub(r"\*\(\d+\) ", "", line))
        if not node:
            continue
        depth = line.index(node.group()[:12])
        path = [(d, n) for d, n in path if d < depth] + [(depth, node.group())]
        if node.group().startswith("FileScan"):
            found.append([above for _, above in reversed(path)])
    return found


def row_exchanges(plan: str) -> list[str]:
    """Exchanges that scanned rows reach without an aggregate on the way."""
    found = []
    for path in scan_paths(plan):
        for above in path:
            if "Aggregate(" in above:
                break
            if above.startswith("Exchange"):
                found.append(above)
                break
    return found


def sorted_rows(plan: str) -> list[str]:
    """Sorts between a scan and the first exchange above it."""
    found = []
    for path in scan_paths(plan):
        for above in path:
            if above.startswith("Exchange"):
                break
            if above.startswith("Sort"):
                found.append(above)
    return found


@pytest.fixture
def rows(spark):
    return arrivals(read_table(spark, DATA, "events"))


ELEMENT_WISE = [
    "src_bounded", "map_double", "map_square_filter_even", "map_udf", "flat_map_words", "flat_map_subevents",
    "timestamp_assign",
]


@pytest.mark.parametrize("name", ELEMENT_WISE)
def test_element_wise_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, DATA))


@pytest.mark.parametrize(
    "name",
    [
        "word_count", "keyed_sum_final", "keyed_aggregate", "key_by_colocated", "tumble_arrival_sum",
        "tumble_event_sum", "tumble_event_reduce", "tumble_count_avg", "no_watermark_open_windows",
        "late_main_output", "late_report", "late_correction", "late_side_output",
    ],
)
def test_rows_are_aggregated_before_they_are_shuffled(spark, name):
    assert row_exchanges(plan_of(QUERIES[name](spark, DATA))) == []


def test_scans_read_only_the_columns_in_use(spark):
    plan = plan_of(QUERIES["keyed_sum_final"](spark, DATA))
    assert "ReadSchema: struct<event_type:string,value:double>" in plan
    assert "ReadSchema: struct<text:string>" in plan_of(QUERIES["word_count"](spark, DATA))


def test_filters_on_source_columns_reach_the_scan(spark):
    df = read_table(spark, DATA, "events").where("user_id = 7 AND event_type = 'click'").select("value")
    plan = plan_of(df)
    assert "EqualTo(user_id,7)" in plan and "EqualTo(event_type,click)" in plan


def test_late_rows_are_found_without_shuffling_rows(rows):
    split = late_split(rows, "t", ORDER, HOUR, LATE_BOUND)
    for df in (late_rows(split), on_time_windows(split, ["event_type"], n=F.count("*"))):
        plan = plan_of(df)
        assert "BroadcastHashJoin" in plan and row_exchanges(plan) == []


@pytest.mark.parametrize(
    "name",
    [
        "tumble_event_reduce", "window_emission", "late_side_output", "late_main_output", "late_report",
        "late_correction",
    ],
)
def test_rows_are_not_sorted_to_find_what_came_first(spark, name, monkeypatch):
    """Neither in the plan of the query nor in those of the tables it settles on the way."""
    plans = []
    for module in (late, windows):
        monkeypatch.setattr(module, "settle", lambda df: plans.append(plan_of(df)) or settle(df))
    plans.append(plan_of(QUERIES[name](spark, DATA)))
    assert len(plans) >= 3
    assert any(scan_paths(p) for p in plans) and not [found for p in plans for found in sorted_rows(p)]


@pytest.mark.parametrize("broadcast_windows", [500_000, 0])
def test_ties_in_the_first_order_column(spark, broadcast_windows):
    """Rows that arrive at the same moment around the one that closes a window."""
    rows = [(t, at, i) for i, (t, at) in enumerate([(5, 1), (21, 2), (4, 2), (22, 2), (9, 2), (3, 3), (31, 3), (15, 3)])]
    df = spark.createDataFrame([*rows, (None, 2, 99)], "t BIGINT, at BIGINT, seq BIGINT")
    split = late.late_split(df, "t", ["at", "seq"], 10, 5, broadcast_windows=broadcast_windows)
    got = sorted(r["seq"] for r in split.where("is_late").collect())
    expected = [i for t, at, i in rows if any(u - 5 >= t - t % 10 + 10 and (b, j) < (at, i) for u, b, j in rows)]
    assert got == expected and expected
    firsts = windows.tumbling_reduce(df.where("t is not null").withColumn("v", F.lit(1)), [], "t", ["at", "seq"], 10, "v", broadcast_windows)
    want = {}
    for t, at, i in sorted(rows, key=lambda r: r[1:]):
        held = want.setdefault(t - t % 10, [0, t])
        held[0] += 1
    assert {r["window_start"]: [r["v"], r["t"]] for r in firsts.collect()} == want


def test_many_windows_are_not_broadcast(rows, no_small_tables):
    split = late_split(rows, "t", ORDER, HOUR, LATE_BOUND, broadcast_windows=0, target_rows=1000)
    exchanges = row_exchanges(plan_of(late_rows(split)))
    assert exchanges and all("_salt" in e for e in exchanges)


@pytest.mark.parametrize("target_rows", [1_000_000, 300])
def test_running_values_shuffle_rows_once_and_never_to_one_task(rows, target_rows):
    running = keyed.running_sum(rows, ["event_type"], ["event_id"], "cents", "so_far", target_rows)
    traced = watermark.watermark_trace(rows, "t", ORDER, LATE_BOUND, target_rows)
    for df in (running, traced):
        exchanges = row_exchanges(plan_of(df))
        assert len(exchanges) == 1
        assert "SinglePartition" not in exchanges[0]
    if target_rows == 300:
        assert "_stretch" in row_exchanges(plan_of(running))[0]


def test_hot_keys_are_the_only_broadcast_of_running_values(rows):
    plan = plan_of(keyed.running_sum(rows, ["event_type"], ["event_id"], "cents", "so_far", 300))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_python_outside_user_functions(spark):
    for name in QUERIES.keys() - {"map_udf", "tumble_udaf_reduce", "tumble_udaf_reduce_cut"}:
        if not name.endswith("stream") and name != "late_two_sinks":
            plan = plan_of(QUERIES[name](spark, DATA))
            assert "Python" not in plan and "InArrow" not in plan, name
