"""A bounded collection as a stream by row offsets."""

import pytest
from pyspark.sql import functions as F

from tests.data import PAIRS, WORD_ONES
from tidemark.sources.rows import lay_rows, stream_rows
from tidemark.sources.tables import from_rows
from tidemark.streaming.runner import drain, start_batches, start_files, stop_after

NOW = {"processingTime": "0 seconds"}


def batches_of(spark, rows, order, tmp_path, rows_per_batch, rows_per_file=1_000_000, fail_at=None):
    """Lists of rows, one a batch; the stream is started again after a batch that failed."""
    lay_rows(rows, order, str(tmp_path / "rows"), rows_per_file)
    got, failed = {}, []

    def keep(batch, number):
        if number == fail_at and not failed:
            failed.append(number)
            raise RuntimeError("lost")
        got[number] = [tuple(r) for r in batch.collect()]

    for _ in range(2 if fail_at is not None else 1):
        stream = stream_rows(spark, str(tmp_path / "rows"), rows.schema, str(tmp_path / "progress"), rows_per_batch)
        query = start_batches(stream, "rows", keep, str(tmp_path / "cp"), trigger=NOW)
        if fail_at is not None and not failed:
            with pytest.raises(Exception, match="lost"):
                drain(query)
        else:
            drain(query)
    assert len(failed) == (fail_at is not None)
    return [got[n] for n in sorted(got)]


@pytest.mark.parametrize("rows_per_batch", [1, 3, 1_000])
@pytest.mark.parametrize("rows_per_file", [2, 1_000_000])
def test_batches_are_runs_of_the_order(spark, tmp_path, rows_per_batch, rows_per_file):
    df = from_rows(spark, WORD_ONES, PAIRS)
    got = batches_of(spark, df, ["seq"], tmp_path, rows_per_batch, rows_per_file)
    every = [tuple(r) for r in df.orderBy("seq").collect()]
    assert [sorted(b) for b in got] == [every[i : i + rows_per_batch] for i in range(0, len(every), rows_per_batch)]


def test_a_failed_batch_comes_again(spark, tmp_path):
    df = spark.range(50).select(F.col("id"), F.concat(F.lit("v"), "id").alias("v"))
    got = batches_of(spark, df, ["id"], tmp_path, 10, 7, fail_at=2)
    assert [r[0] for b in got for r in sorted(b)] == list(range(50))
    assert [len(b) for b in got] == [10] * 5


def test_a_restart_goes_on_where_it_stopped(spark, tmp_path):
    df = spark.range(40).select("id")
    lay_rows(df, ["id"], str(tmp_path / "rows"), 16)

    def run():
        stream = stream_rows(spark, str(tmp_path / "rows"), df.schema, str(tmp_path / "progress"), 15)
        return start_files(stream, "out", str(tmp_path / "out"), str(tmp_path / "cp"), trigger=NOW)

    for _ in range(2):
        drain(run())
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(40))


def test_a_stream_that_was_stopped_goes_on(spark, tmp_path):
    df = spark.range(60).select("id")
    lay_rows(df, ["id"], str(tmp_path / "rows"), 7)

    def run():
        stream = stream_rows(spark, str(tmp_path / "rows"), df.schema, str(tmp_path / "progress"), 6)
        return start_files(stream, "out", str(tmp_path / "out"), str(tmp_path / "cp"), trigger=NOW)

    stop_after(run(), 3, timeout=120)
    drain(run())
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(60))


def test_types_nulls_and_empty(spark, tmp_path):
    schema = "seq BIGINT, s STRING, t TIMESTAMP, d DATE, x DOUBLE, l ARRAY<BIGINT>, m DECIMAL(10,2)"
    row = "2, '', timestamp'1969-12-31 23:59:59.000001', date'2020-02-29', double('nan'), array(1, null), 1.50"
    df = spark.sql(f"SELECT * FROM VALUES ({row}), (1, null, null, null, null, null, null)")
    df = df.toDF("seq", "s", "t", "d", "x", "l", "m")
    df = df.select(*[F.col(f.name).cast(f.dataType) for f in spark.createDataFrame([], schema).schema])
    got = batches_of(spark, df, ["seq"], tmp_path, 1)
    assert [list(map(str, b)) for b in got] == [[str(tuple(r))] for r in df.orderBy("seq").collect()]


def test_no_rows(spark, tmp_path):
    assert not any(batches_of(spark, spark.range(0).select("id"), ["id"], tmp_path, 5))


def test_progress_behind_the_checkpoint_is_an_error(spark, tmp_path):
    df = spark.range(30).select("id")
    lay_rows(df, ["id"], str(tmp_path / "rows"))
    for progress in ("one", "other"):
        stream = stream_rows(spark, str(tmp_path / "rows"), df.schema, str(tmp_path / progress), 10)
        query = start_files(stream, "out", str(tmp_path / "out"), str(tmp_path / "cp"), trigger=NOW)
        if progress == "one":
            drain(query)
        else:
            with pytest.raises(Exception, match="behind the checkpoint"):
                drain(query)
