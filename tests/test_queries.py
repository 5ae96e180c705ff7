import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.plans import queries
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES

DATA = "/root/testdata"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("events", "documents"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/sf0.01/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_gives_what_the_sql_gives(spark, duck, name):
    got = QUERIES[name](spark, f"{DATA}/sf0.01")
    expected = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)

    def key(row):
        return tuple((v is None, v) for v in row)

    rows = sorted(map(tuple, got.select(columns).collect()), key=key)
    assert rows == sorted(expected.select(*columns).fetchall(), key=key)


def test_streams_take_their_rows_in_several_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}")
    for name in ("src_stream", "keyed_sum_update_stream", "keyed_sum_rolling_stream", "late_two_sinks"):
        QUERIES[name](spark, f"{DATA}/sf0.001")
        commits = [c for c in (tmp_path / name).rglob("commits/*") if c.name.isdigit()]
        assert len(commits) >= 3, name


def test_entry(spark):
    out = entry_points.entry(spark)
    assert out.columns == ["event_type", "window_start", "n", "cents"]
    assert out.count() > 0


def test_results_do_not_depend_on_the_session_zone(spark, duck):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("tumble_event_sum", "late_report", "timestamp_assign"):
            test_query_gives_what_the_sql_gives(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
