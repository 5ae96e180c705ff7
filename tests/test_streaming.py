import random
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests import brute
from tests.data import (
    DELAY,
    LAG,
    OUT_OF_ORDER,
    OUT_OF_ORDER_WINDOWS,
    PAIRS,
    SENSORS,
    SIZE,
    TRIPLES,
    WITH_LATE,
    WITH_LATE_WINDOWS,
    WORD_ONES,
    WORD_SUMS,
    WORD_SUMS_SO_FAR,
)
from tests.test_windows import shuffled_rows
from tidemark.operators.folds import Fold
from tidemark.operators.measures import Measure, Measures
from tidemark.operators.transforms import flat_map_words
from tidemark.operators.watermark import with_event_time
from tidemark.operators.windows import tumble
from tidemark.sources.tables import from_rows, stamp_arrival, stream_files
from tidemark.streaming import clock, state
from tidemark.streaming.keyed import running_batches, running_stream, update_totals
from tidemark.streaming.late import LateWindows
from tidemark.streaming.runner import (
    ONE_AGGREGATE,
    drain,
    drop_late_at_once,
    finish,
    run_to_files,
    start_batches,
    start_files,
)

TIMED = f"seq BIGINT, {TRIPLES}"
KEYED = f"seq BIGINT, {PAIRS}"


@pytest.fixture
def sum_and_first(spark):
    return Measures({"value": Measure("sum", F.col("value")), "ts_ms": Measure("first", F.col("ts_ms"))})


@pytest.fixture
def sum_and_first_fold():
    return Fold(("value", "ts_ms"), lambda a, b: (a[0] + b[0], a[1]), True)


def window_job(spark, reduce, delay=DELAY):
    schema = spark.createDataFrame([], TIMED).schema
    return LateWindows(schema, ["key"], "ts_ms", ["seq"], SIZE, delay, reduce)


def windows_of(df):
    return {(r["key"], r["window_start"], r["value"], r["ts_ms"], r["emitted_by"]) for r in df.collect()}


def test_stream_gives_the_bounded_rows(spark, to_files, tmp_path):
    df = from_rows(spark, WORD_ONES, PAIRS)
    stream = stream_files(spark, to_files(df, "seq", 4), KEYED, files_per_batch=1)
    out = run_to_files(stream, "copy", str(tmp_path / "run"), timeout=120)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_one_transform_for_bounded_and_streamed_input(spark, to_files, tmp_path):
    df = from_rows(spark, [("a  b",), ("",), ("c d",)], "s STRING")
    stream = stream_files(spark, to_files(df, "seq", 3), "seq BIGINT, s STRING", files_per_batch=1)
    out = run_to_files(flat_map_words(stream, ["seq"], "s"), "words", str(tmp_path / "run"), timeout=120)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, flat_map_words(df, ["seq"], "s").collect()))


def test_started_stream_returns_at_once_and_is_named(spark, to_files, tmp_path):
    df = from_rows(spark, WORD_ONES, PAIRS)
    stream = stream_files(spark, to_files(df, "seq", 2), KEYED)
    query = stream.writeStream.queryName("named").format("parquet").option(
        "checkpointLocation", str(tmp_path / "cp")
    ).start(str(tmp_path / "out"))
    assert query.name == "named" and query.isActive
    drain(query)
    assert not query.isActive
    assert spark.read.schema(KEYED).parquet(str(tmp_path / "out")).count() == len(WORD_ONES)


def test_failure_in_a_batch_is_raised(spark, to_files, tmp_path):
    stream = stream_files(spark, to_files(from_rows(spark, WORD_ONES, PAIRS), "seq", 1), KEYED)

    def fail(rows, batch):
        raise RuntimeError("no room")

    with pytest.raises(Exception, match="no room"):
        finish(start_batches(stream, "fails", fail, str(tmp_path / "cp")), 120)


def test_restarted_file_sink_neither_loses_nor_doubles_rows(spark, to_files, tmp_path):
    df = from_rows(spark, WORD_ONES, PAIRS)
    folder = to_files(df, "seq", 8)
    stream = stream_files(spark, folder, KEYED, files_per_batch=1)
    for _ in range(2):
        finish(start_files(stream, "again", str(tmp_path / "out"), str(tmp_path / "cp")), 120)
    out = spark.read.schema(KEYED).parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("files_per_batch, snapshot_every", [(1, 3), (100, 16)])
def test_totals_kept_up_to_date(spark, to_files, tmp_path, monkeypatch, files_per_batch, snapshot_every):
    monkeypatch.setattr(state, "SNAPSHOT_EVERY", snapshot_every)
    stream = stream_files(spark, to_files(from_rows(spark, WORD_ONES, PAIRS), "seq", 8), KEYED, files_per_batch)
    out = update_totals(stream, ["key"], {"value": F.sum("value")}, "totals", str(tmp_path / "run"), 120)
    assert {r["key"]: r["value"] for r in out.collect()} == WORD_SUMS


def test_totals_go_on_after_a_failure(spark, to_files, tmp_path, monkeypatch):
    stream = stream_files(spark, to_files(from_rows(spark, WORD_ONES, PAIRS), "seq", 4), KEYED, 1)
    root = str(tmp_path / "run")
    failed = []

    def commit_once_lost(session, where, batch):
        if batch == 2 and not failed:
            failed.append(batch)
            raise RuntimeError("lost before its mark")
        state.commit(session, where, batch)

    monkeypatch.setattr("tidemark.streaming.keyed.commit", commit_once_lost)
    with pytest.raises(Exception, match="lost before"):
        update_totals(stream, ["key"], {"value": F.sum("value")}, "first", root, 120)
    out = update_totals(stream, ["key"], {"value": F.sum("value")}, "second", root, 120)
    assert failed == [2]
    assert {r["key"]: r["value"] for r in out.collect()} == WORD_SUMS


@pytest.mark.parametrize("files_per_batch, snapshot_every, broadcast_keys", [(1, 2, 500_000), (1, 3, 0), (100, 16, 0)])
def test_running_sum_on_a_stream(
    spark, to_files, tmp_path, monkeypatch, files_per_batch, snapshot_every, broadcast_keys
):
    monkeypatch.setattr(state, "SNAPSHOT_EVERY", snapshot_every)
    monkeypatch.setattr(state, "BROADCAST_KEYS", broadcast_keys)
    stream = stream_files(spark, to_files(from_rows(spark, WORD_ONES, PAIRS), "seq", 8), KEYED, files_per_batch)
    sums = Measures({"so_far": Measure("sum", F.col("value"))})
    out = running_stream(stream, ["key"], ["seq"], sums, "running", str(tmp_path / "run"), timeout=120)
    assert [r["so_far"] for r in out.orderBy("seq").collect()] == WORD_SUMS_SO_FAR


@pytest.mark.parametrize("target_rows", [1_000_000, 15])
def test_running_values_on_a_stream_with_a_hot_key(spark, to_files, tmp_path, target_rows):
    rng = random.Random(11)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(9)}", rng.randrange(-9, 99)) for _ in range(240)]
    df = from_rows(spark, rows, PAIRS)
    stream = stream_files(spark, to_files(df, "seq", 6), KEYED, 2)
    held = Measures({"so_far": Measure("sum", F.col("value")), "first": Measure("first", F.col("seq"))})
    out = running_stream(stream, ["key"], ["seq"], held, "running", str(tmp_path / "run"), target_rows, 120)
    out = out.orderBy("seq").collect()
    assert [r["so_far"] for r in out] == brute.running(rows, lambda a, b: a + b)
    assert [r["first"] for r in out] == brute.running([(k, i) for i, (k, _) in enumerate(rows)], lambda a, b: a)


@pytest.mark.parametrize("target_rows", [1_000_000, 10])
def test_running_reduce_function_on_a_stream(spark, to_files, tmp_path, target_rows):
    rng = random.Random(12)
    keys = [None, "hot", "hot", *(f"k{i}" for i in range(5))]
    rows = [(rng.choice(keys), str(rng.randrange(99))) for _ in range(120)]
    df = from_rows(spark, rows, "key STRING, v STRING")
    stream = stream_files(spark, to_files(df, "seq", 4), "seq BIGINT, key STRING, v STRING", 2)
    fold = Fold(("v",), lambda a, b: (a[0] + "," + b[0],), True)
    out = running_stream(stream, ["key"], ["seq"], fold, "running", str(tmp_path / "run"), target_rows, 120)
    assert [r["v"] for r in out.orderBy("seq").collect()] == brute.running(rows, lambda a, b: a + "," + b)


@pytest.mark.parametrize("failing_batch", [1, 2, 3])
def test_running_sum_goes_on_after_a_failure(spark, to_files, tmp_path, monkeypatch, failing_batch):
    monkeypatch.setattr(state, "SNAPSHOT_EVERY", 2)
    stream = stream_files(spark, to_files(from_rows(spark, WORD_ONES, PAIRS), "seq", 8), KEYED, 2)
    sums = Measures({"so_far": Measure("sum", F.col("value"))})
    root = str(tmp_path / "run")
    each = running_batches(["key"], ["seq"], sums, root)

    def fail_late(rows, batch):
        each(rows, batch)
        if batch == failing_batch:
            raise RuntimeError("lost after its commit")

    with pytest.raises(Exception, match="lost after"):
        finish(start_batches(stream, "first", fail_late, f"{root}/checkpoint"), 120)
    out = running_stream(stream, ["key"], ["seq"], sums, "second", root, timeout=120)
    assert [r["so_far"] for r in out.orderBy("seq").collect()] == WORD_SUMS_SO_FAR


@pytest.mark.parametrize(
    "kind, files_per_batch",
    [("sum_and_first", 1), ("sum_and_first", 100), ("sum_and_first_fold", 3), ("sum_and_first_fold", 100)],
)
@pytest.mark.parametrize(
    "rows, windows, late",
    [(WITH_LATE, WITH_LATE_WINDOWS, [4]), (OUT_OF_ORDER, OUT_OF_ORDER_WINDOWS, [])],
    ids=["late", "out_of_order"],
)
def test_window_fixtures_on_a_stream(spark, to_files, tmp_path, request, rows, windows, late, kind, files_per_batch):
    job = window_job(spark, request.getfixturevalue(kind))
    stream = stream_files(spark, to_files(from_rows(spark, rows, TRIPLES), "seq", len(rows)), TIMED, files_per_batch)
    root = str(tmp_path / "run")
    job.run(stream, "windows", root, timeout=200)
    assert windows_of(job.main(spark, root)) == windows
    assert [r["seq"] for r in job.late(spark, root).collect()] == late
    held = {w for w in windows if w[4] == "watermark"}
    assert windows_of(job.main(spark, root, end_of_input="hold")) == held


@pytest.mark.parametrize("files_per_batch", [1, 2, 100])
def test_late_by_the_row_before_whatever_the_batches(spark, to_files, tmp_path, sum_and_first, files_per_batch):
    job = window_job(spark, sum_and_first)
    stream = stream_files(spark, to_files(from_rows(spark, LAG, TRIPLES), "seq", len(LAG)), TIMED, files_per_batch)
    root = str(tmp_path / "run")
    job.run(stream, "lag", root, timeout=120)
    assert ("k", 0, 1, 1000, "watermark") in windows_of(job.main(spark, root))
    assert [r["seq"] for r in job.late(spark, root).collect()] == [2]


@pytest.mark.parametrize("files_per_batch, target_rows", [(1, 1_000_000), (3, 20), (100, 1_000_000)])
def test_windows_do_not_depend_on_the_batches(spark, to_files, tmp_path, sum_and_first, files_per_batch, target_rows):
    rows = shuffled_rows(300)
    late, main, closed_at = brute.late_windows(rows, SIZE, DELAY)
    job = window_job(spark, sum_and_first)
    stream = stream_files(spark, to_files(from_rows(spark, rows, TRIPLES), "seq", 7), TIMED, files_per_batch)
    root = str(tmp_path / "run")
    job.run(stream, "parity", root, target_rows, timeout=300)
    assert sorted(r["seq"] for r in job.late(spark, root).collect()) == late
    assert windows_of(job.main(spark, root)) == {
        (k, s, v, t, "watermark" if s + SIZE in closed_at or _closed_by_last(rows, s) else "end_of_input")
        for (k, s), (v, t) in main.items()
    }


def _closed_by_last(rows, start):
    return max(t for *_, t in rows) - DELAY >= start + SIZE


@pytest.mark.parametrize("step", ["late", "main", "open", "commit", "done"])
def test_windows_after_a_failure_at_any_step(spark, to_files, tmp_path, sum_and_first, monkeypatch, step):
    rows = shuffled_rows(200, seed=8)
    late, main, _ = brute.late_windows(rows, SIZE, DELAY)
    job = window_job(spark, sum_and_first)
    stream = stream_files(spark, to_files(from_rows(spark, rows, TRIPLES), "seq", 3), TIMED, 1)
    root = str(tmp_path / "run")
    each = job.batches(root)
    failing = {"on": True}

    def fail_before(write):
        def wrapped(df_or_spark, where, *args, **more):
            name = args[0] if isinstance(args[0], str) else "commit"
            at = args[1] if isinstance(args[0], str) else args[0]
            if failing["on"] and name == step and at == 1:
                raise RuntimeError("lost")
            return write(df_or_spark, where, *args, **more)

        return wrapped

    for name in ("write_batch", "write_keyed", "commit"):
        monkeypatch.setattr(f"tidemark.streaming.late.{name}", fail_before(getattr(state, name)))

    def run(rows, batch):
        each(rows, batch)
        if failing["on"] and step == "done" and batch == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        finish(start_batches(stream, "first", run, f"{root}/checkpoint"), 200)
    if step != "done":
        assert state.last_commit(spark, root) == 0
    failing["on"] = False
    job.run(stream, "second", root, timeout=200)
    assert sorted(r["seq"] for r in job.late(spark, root).collect()) == late
    got = {(k, s): (v, t) for k, s, v, t, _ in windows_of(job.main(spark, root))}
    assert got == main


def _written_rows(spark, path):
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return 0


@pytest.mark.parametrize("kind", ["sum_and_first", "sum_and_first_fold"])
def test_a_batch_writes_only_the_windows_it_touches_or_closes(spark, tmp_path, monkeypatch, request, kind):
    """40 keys stay open in one far window; each batch has one row of another key."""
    monkeypatch.setattr(state, "SNAPSHOT_EVERY", 3)
    rows = [(f"far{i}", 1, i) for i in range(40)]
    job = window_job(spark, request.getfixturevalue(kind), delay=200_000)
    root = str(tmp_path / "run")
    each = job.batches(root)
    each(from_rows(spark, rows, TRIPLES), 0)
    for batch in range(1, 5):
        each(from_rows(spark, [("near", 1, 3000 * batch)], TRIPLES).withColumn("seq", F.lit(100 + batch).cast("long")), batch)
        opened = _written_rows(spark, f"{root}/open/part={batch % 6}")
        assert opened == (1 if batch != 3 else 43)
        assert _written_rows(spark, f"{root}/main/batch={batch}") == 0
    # The watermark goes to 8,000: the far windows and the near ones at 2,000 and 6,000 are closed.
    each(from_rows(spark, [("near", 1, 208_000)], TRIPLES).withColumn("seq", F.lit(200).cast("long")), 5)
    assert _written_rows(spark, f"{root}/main/batch=5") == 40 + 2
    assert _written_rows(spark, f"{root}/open/part=5") == 1
    assert job.still_open(spark, root).count() == 3
    assert job.main(spark, root).agg(F.sum("value")).first()[0] == 45


def test_batches_leave_no_folders_behind(spark, tmp_path, sum_and_first, monkeypatch):
    monkeypatch.setattr("tidemark.session.shared_dir", lambda spark: str(tmp_path / "shared"))
    job, root = window_job(spark, sum_and_first), str(tmp_path / "run")
    each = job.batches(root)
    counts = []
    for batch in range(6):
        rows = [("k", 1, 1000 * batch + i) for i in range(4)]
        each(from_rows(spark, rows, TRIPLES).withColumn("seq", F.col("seq") + batch * 10), batch)
        counts.append(len([p for p in (tmp_path / "shared").rglob("*") if p.is_dir()]))
    assert len(set(counts)) == 1


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_a_fold_that_is_not_associative(spark, to_files, tmp_path, batches):
    """Differences in arrival order, whatever the batches: a - b - c is not a - (b - c)."""
    rows = shuffled_rows(60, seed=4)
    late, _, _ = brute.late_windows(rows, SIZE, DELAY)
    expected = {}
    for at, (key, value, ts) in enumerate(rows):
        if at not in late:
            group = key, ts // SIZE * SIZE
            expected[group] = expected[group] - value if group in expected else value
    job = window_job(spark, Fold(("value",), lambda a, b: (a[0] - b[0],), False))
    root = str(tmp_path / "run")
    each = job.batches(root)
    size = -(-len(rows) // batches)
    df = from_rows(spark, rows, TRIPLES).repartition(3)
    for batch in range(batches):
        each(df.where((F.col("seq") >= batch * size) & (F.col("seq") < (batch + 1) * size)), batch)
    got = {(r["key"], r["window_start"]): r["value"] for r in job.main(spark, root).collect()}
    assert got == expected
    assert sorted(r["seq"] for r in job.late(spark, root).collect()) == late


@pytest.mark.parametrize("files_per_batch", [1, 3])
def test_running_fold_that_is_not_associative(spark, to_files, tmp_path, files_per_batch):
    rng = random.Random(3)
    rows = [(rng.choice(["a", None, "b"]), rng.randrange(50)) for _ in range(40)]
    stream = stream_files(spark, to_files(from_rows(spark, rows, PAIRS), "seq", 4), KEYED, files_per_batch)
    fold = Fold(("value",), lambda a, b: (a[0] - b[0],), False)
    out = running_stream(stream, ["key"], ["seq"], fold, "minus", str(tmp_path / "run"), timeout=120)
    assert [r["value"] for r in out.orderBy("seq").collect()] == brute.running(rows, lambda a, b: a - b)


def test_continuous_late_windows(spark, to_files, tmp_path, sum_and_first):
    folder = to_files(from_rows(spark, WITH_LATE, TRIPLES), "seq", 2)
    job, root = window_job(spark, sum_and_first), str(tmp_path / "run")
    stream = stream_files(spark, folder, TIMED, 1)
    query = job.start(stream, "continuous", root, trigger={"processingTime": "0 seconds"})
    drain(query)
    assert not query.isActive
    bounded = str(tmp_path / "bounded")
    job.run(stream, "bounded", bounded)
    for read in (job.main, job.late):
        assert sorted(map(tuple, read(spark, root).collect())) == sorted(map(tuple, read(spark, bounded).collect()))
    fixed = job.corrected(spark, root, "value").agg(F.sum("corrected")).first()[0]
    assert fixed == sum(row[1] for row in WITH_LATE)


def test_empty_input(spark, tmp_path, sum_and_first):
    job = window_job(spark, sum_and_first)
    (tmp_path / "in").mkdir()
    root = str(tmp_path / "run")
    job.run(stream_files(spark, str(tmp_path / "in"), TIMED), "empty", root, timeout=120)
    assert job.main(spark, root).count() == 0 and job.late(spark, root).count() == 0


def test_windows_on_the_clock(spark, to_files, tmp_path):
    df = from_rows(spark, SENSORS, PAIRS)
    stream = stamp_arrival(stream_files(spark, to_files(df, "seq", 3), KEYED, 1))
    sums = Measures({"value": Measure("sum", F.col("value")), "n": Measure("count", F.lit(1))})
    job = LateWindows(stream.schema, ["key"], "arrival", ["arrival", "seq"], 5_000_000, 0, sums)
    root = str(tmp_path / "run")
    started = time.time() * 1e6
    job.run(stream, "clock", root, timeout=120)
    out = job.main(spark, root).collect()
    # Windows depend on the clock, what they add up to does not.
    assert all(started - 5_000_000 < r["window_start"] <= time.time() * 1e6 for r in out)
    assert all(r["window_start"] % 5_000_000 == 0 for r in out)
    for key in ("sensor_1", "sensor_2"):
        assert sum(r["value"] for r in out if r["key"] == key) == sum(v for k, v in SENSORS if k == key)
    assert job.late(spark, root).count() == 0


def test_built_in_windows_one_row_per_batch(spark, to_files, tmp_path):
    """The built-in aggregate agrees at that batch size, for the windows it closes."""
    before = spark.conf.get(ONE_AGGREGATE)
    drop_late_at_once(spark)
    try:
        folder = to_files(from_rows(spark, [*WITH_LATE, ("key1", 0, 20000)], TRIPLES), "seq", 8)
        stream = with_event_time(stream_files(spark, folder, TIMED, 1), "ts_ms", DELAY)
        grouped = tumble(stream, "ts", "2 seconds", ["key"], {"value": F.sum("value")})
        out = run_to_files(grouped, "built_in", str(tmp_path / "run"), timeout=200)
        got = {(r["key"], r["start"], r["value"]) for r in
               out.select("key", F.unix_millis("window_start").alias("start"), "value").collect()}
        assert got == {w[:3] for w in WITH_LATE_WINDOWS}
    finally:
        spark.conf.set(ONE_AGGREGATE, before)


def _clocked(spark, folder, root, size_us, hold_ms=0):
    add = lambda a, b: (a[0] + b[0],)
    stream = stamp_arrival(stream_files(spark, folder, KEYED, 1))
    given_out = clock.clock_windows(stream, ["key"], "arrival", size_us, ["value"], add, hold_ms)
    query = clock.start_clock(given_out, "clock", root)
    return query, lambda: clock.whole_windows(spark, given_out, "clock", root, ["key"], ["value"], add)


def test_the_clock_closes_the_last_window(spark, to_files, tmp_path):
    """No further row comes, and the windows come out all the same."""
    rows = [*SENSORS, (None, 7), (None, 8)]
    query, windows = _clocked(spark, to_files(from_rows(spark, rows, PAIRS), "seq", 2), str(tmp_path / "run"), 3_000_000)
    clock.run_out(query, 120)
    out = windows().collect()
    assert all(r["window_start"] % 3_000_000 == 0 for r in out)
    for key in ("sensor_1", "sensor_2", None):
        assert sum(r["value"] for r in out if r["key"] == key) == sum(v for k, v in rows if k == key)


def test_windows_are_held_until_they_end(spark, to_files, tmp_path):
    folder, root = to_files(from_rows(spark, SENSORS, PAIRS), "seq", 1), str(tmp_path / "run")
    query, windows = _clocked(spark, folder, root, 3_600_000_000, hold_ms=7_200_000)
    with pytest.raises(TimeoutError, match="open windows"):
        clock.run_out(query, 25)
    assert windows().count() == 0
