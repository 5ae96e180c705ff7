"""Count windows, change streams and lateness by batches on streams."""

import pytest
from pyspark.sql import functions as F

from tests import brute
from tests.data import DELAY, PAIRS, SIZE, TRIPLES
from tests.test_streaming import KEYED, TIMED, window_job
from tests.test_windows import shuffled_rows
from tidemark.operators.measures import Measure, Measures
from tidemark.sources.tables import append_by, from_rows, stream_files
from tidemark.streaming import state
from tidemark.streaming.builtin import append_windows, appended
from tidemark.streaming.counts import CountWindows
from tidemark.streaming.late import LateWindows
from tidemark.streaming.runner import finish, start_batches


def in_batches(df, rows, batches, each):
    size = -(-rows // batches)
    for batch in range(batches):
        each(df.where((F.col("seq") >= batch * size) & (F.col("seq") < (batch + 1) * size)), batch)


def count_rows():
    """A key with most rows, one with a few, a null key, and null values."""
    keys = ["hot"] * 7 + ["b", None, "c"]
    return [(keys[(i * 7) % 10], None if i % 11 == 3 else i) for i in range(90)]


@pytest.fixture
def keyed_schema(spark):
    return spark.createDataFrame([], KEYED).schema


@pytest.mark.parametrize("batches, target_rows", [(1, 1_000_000), (3, 8), (20, 1_000_000)])
def test_count_windows_do_not_depend_on_the_batches(spark, tmp_path, monkeypatch, keyed_schema, batches, target_rows):
    monkeypatch.setattr(state, "SNAPSHOT_EVERY", 4)
    rows = count_rows()
    key, value = keyed_schema.names[1:]
    job, root = CountWindows(keyed_schema, [key], ["seq"], value, 4), str(tmp_path / "run")
    df = from_rows(spark, rows, PAIRS).repartition(3)
    in_batches(df, len(rows), batches, job.batches(root, target_rows))
    expected = brute.count_windows([(k, v or 0) for k, v in rows], 4)
    got = {(r[key], r["window_no"]): (r[value] or 0, r["complete"]) for r in job.windows(spark, root).collect()}
    assert got == expected


@pytest.mark.parametrize("step", ["full", "last", "commit"])
def test_count_windows_after_a_failure(spark, to_files, tmp_path, monkeypatch, keyed_schema, step):
    rows = [(k, v or 0) for k, v in count_rows()]
    key, value = keyed_schema.names[1:]
    job, root = CountWindows(keyed_schema, [key], ["seq"], value, 4), str(tmp_path / "run")
    stream = stream_files(spark, to_files(from_rows(spark, rows, PAIRS), "seq", 3), KEYED, 1)
    failing = {"on": True}

    def fail_before(write):
        def wrapped(df_or_spark, where, *args, **more):
            name = args[0] if isinstance(args[0], str) else "commit"
            if failing["on"] and name == step and (args[1] if name != "commit" else args[0]) == 1:
                raise RuntimeError("lost")
            return write(df_or_spark, where, *args, **more)

        return wrapped

    for name in ("write_batch", "write_keyed", "commit"):
        monkeypatch.setattr(f"tidemark.streaming.counts.{name}", fail_before(getattr(state, name)))
    with pytest.raises(Exception, match="lost"):
        finish(start_batches(stream, "counts", job.batches(root), f"{root}/checkpoint"), 200)
    failing["on"] = False
    job.run(stream, "counts_again", root, timeout=200)
    got = {(r[key], r["window_no"]): (r[value], r["complete"]) for r in job.windows(spark, root).collect()}
    assert got == brute.count_windows(rows, 4)


def test_count_windows_without_rows_and_of_decimals(spark, tmp_path):
    schema = "seq BIGINT, k STRING, v DECIMAL(5,2)"
    job = CountWindows(spark.createDataFrame([], schema).schema, ["k"], ["seq"], "v", 2)
    each, root = job.batches(str(tmp_path / "run")), str(tmp_path / "run")
    assert job.windows(spark, root).count() == 0
    df = spark.sql("SELECT id AS seq, 'a' AS k, CAST(1.25 AS DECIMAL(5,2)) AS v FROM range(5)")
    for batch, rows in enumerate((df.where("false"), df.where("seq < 3"), df.where("seq >= 3"))):
        each(rows, batch)
    got = sorted((r["window_no"], float(r["v"]), r["complete"]) for r in job.windows(spark, root).collect())
    assert got == [(0, 2.5, True), (1, 2.5, True), (2, 1.25, False)]
    assert job.windows(spark, root).schema["v"].dataType.simpleString() == "decimal(15,2)"


@pytest.fixture
def sums():
    return Measures({"n": Measure("count", F.lit(1)), "value": Measure("sum", F.col("value"))})


def changing(spark, reduce):
    schema = spark.createDataFrame([], TIMED).schema
    return LateWindows(schema, ["key"], "ts_ms", ["seq"], SIZE, DELAY, reduce, changes=True)


@pytest.mark.parametrize("batches", [1, 4, 19])
def test_changes_add_up_to_all_rows(spark, tmp_path, monkeypatch, sums, batches):
    monkeypatch.setattr(state, "SNAPSHOT_EVERY", 4)
    rows = shuffled_rows(200, seed=3)
    late, main, _ = brute.late_windows(rows, SIZE, DELAY)
    assert late
    job, root = changing(spark, sums), str(tmp_path / "run")
    in_batches(from_rows(spark, rows, TRIPLES), len(rows), batches, job.batches(root))
    held = {}
    changes = job.change_stream(spark, root).orderBy("batch", "change").collect()
    for r in changes:
        group, result = (r["key"], r["window_start"]), (r["n"], r["value"])
        if r["change"] == -1:
            # What is taken back is what was given last.
            assert held.pop(group) == result
        else:
            assert group not in held
            held[group] = result
    keys = [(r["key"], r["window_start"], r["batch"], r["change"]) for r in changes]
    assert len(keys) == len(set(keys))
    opened = {(r["key"], r["window_start"]): (r["n"], r["value"]) for r in job.still_open(spark, root).collect()}
    assert not held.keys() & opened.keys()
    expected = {}
    for key, value, ts in rows:
        n, total = expected.get((key, ts // SIZE * SIZE), (0, 0))
        expected[key, ts // SIZE * SIZE] = (n + 1, total + value)
    assert held | opened == expected


def test_changes_of_a_batch_run_again_are_the_same(spark, tmp_path, sums):
    rows = shuffled_rows(120, seed=6)
    job, root = changing(spark, sums), str(tmp_path / "run")
    each, df = job.batches(root), from_rows(spark, rows, TRIPLES)
    each(df.where("seq < 60"), 0)
    each(df.where("seq >= 60"), 1)
    first = sorted(map(tuple, job.change_stream(spark, root).collect()))
    each(df.where("seq >= 60").repartition(5), 1)
    assert sorted(map(tuple, job.change_stream(spark, root).collect())) == first


def test_a_batch_without_late_rows_changes_only_what_closes(spark, tmp_path, sums):
    job, root = changing(spark, sums), str(tmp_path / "run")
    each = job.batches(root)
    for batch in range(4):
        df = from_rows(spark, [("k", 1, 2000 * batch)], TRIPLES).withColumn("seq", F.lit(batch).cast("long"))
        each(df, batch)
    got = [(r["window_start"], r["batch"], r["change"]) for r in job.change_stream(spark, root).collect()]
    # The window at 2,000 n is closed by the row at 2,000 (n + 2), as the bound is 500.
    assert sorted(got) == [(0, 2, 1), (2000, 3, 1)]


def by_batch(job_rows, cut):
    """Row by row, but a row is late by what the batches before have seen."""
    seen = before = None
    late, main, at = [], {}, None
    for seq, (key, value, ts) in enumerate(job_rows):
        if seq // cut != at:
            at, before = seq // cut, seen
        start = ts // SIZE * SIZE
        if before is not None and start + SIZE <= before - DELAY:
            late.append(seq)
        else:
            n, total = main.get((key, start), (0, 0))
            main[key, start] = (n + 1, total + value)
        seen = ts if seen is None else max(seen, ts)
    return late, main


@pytest.mark.parametrize("cut", [20, 50])
def test_late_by_batches_equals_the_built_in_windows(spark, tmp_path, sums, cut):
    rows = shuffled_rows(120, seed=9)
    late, main = by_batch(rows, cut)
    assert late
    df = from_rows(spark, rows, TRIPLES)
    schema = spark.createDataFrame([], TIMED).schema
    job = LateWindows(schema, ["key"], "ts_ms", ["seq"], SIZE, DELAY, sums, granularity="batch")
    root, built_in, folder = str(tmp_path / "own"), str(tmp_path / "built_in"), str(tmp_path / "in")
    aggregates = {"n": F.count(F.lit(1)), "value": F.sum("value")}
    for _ in append_by(df, folder, F.floor(F.col("seq") / cut).cast("long")):
        stream = stream_files(spark, folder, schema)
        job.run(stream, "own", root, timeout=200)
        timed = stream.withColumn("ts", F.timestamp_millis("ts_ms")).withWatermark("ts", f"{DELAY} milliseconds")
        out = append_windows(timed, ["key"], "ts", f"{SIZE} milliseconds", aggregates, "built", built_in, 200)
    assert sorted(r["seq"] for r in job.late(spark, root).collect()) == late
    own = {(r["key"], r["window_start"], r["n"], r["value"], r["emitted_by"]) for r in job.main(spark, root).collect()}
    assert {(k, s): (n, v) for k, s, n, v, _ in own} == main
    start = F.unix_millis("window_start").alias("window_start")
    for end, keep in (("flush", {"watermark", "end_of_input"}), ("hold", {"watermark"})):
        got = appended(spark, out, ["key"], "built", built_in, end).select("key", start, "n", "value", "emitted_by")
        assert set(map(tuple, got.collect())) == {w for w in own if w[4] in keep}


def test_an_aggregate_of_several_values_is_not_flushed(spark, tmp_path):
    df = from_rows(spark, shuffled_rows(20), TRIPLES)
    folder, root = str(tmp_path / "in"), str(tmp_path / "run")
    df.write.parquet(folder)
    stream = stream_files(spark, folder, df.schema).withColumn("ts", F.timestamp_millis("ts_ms"))
    timed = stream.withWatermark("ts", "1 second")
    schema = append_windows(timed, ["key"], "ts", "2 seconds", {"mean": F.avg("value")}, "mean", root, 200)
    assert appended(spark, schema, ["key"], "mean", root, "hold").count() > 0
    with pytest.raises(TypeError, match="not kept as one value"):
        appended(spark, schema, ["key"], "mean", root)


def test_unknown_granularity(spark, sums):
    job = window_job(spark, sums)
    with pytest.raises(ValueError, match="granularity"):
        LateWindows(job.schema, ["key"], "ts_ms", ["seq"], SIZE, DELAY, sums, granularity="hour")


def test_late_rows_are_logged_while_running(spark, tmp_path, sums, caplog):
    rows = shuffled_rows(90, seed=2)
    late, _, _ = brute.late_windows(rows, SIZE, DELAY)
    job, root = window_job(spark, sums), str(tmp_path / "run")
    each, seen = job.batches(root), []
    df = from_rows(spark, rows, TRIPLES)

    def watched(rows, batch):
        each(rows, batch)
        seen.append(job.logged(spark, root).count())

    with caplog.at_level("INFO", "tidemark.streaming.late"):
        for batch, some in enumerate((df.where("seq < 30"), df.where("false"), df.where("seq >= 30"))):
            watched(some, batch)
    assert seen == [1, 2, 3]
    got = {r["batch"]: (r["n_rows"], r["n_late"]) for r in job.logged(spark, root).collect()}
    early = sum(at < 30 for at in late)
    assert got == {0: (30, early), 1: (0, 0), 2: (60, len(late) - early)}
    assert job.logged(spark, root).agg(F.max("max_ts")).first()[0] == max(t for *_, t in rows)
    assert [r.levelname for r in caplog.records] == ["WARNING" if early else "INFO", "INFO", "WARNING"]
