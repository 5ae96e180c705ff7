from __future__ import annotations

import os
import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import SHARED, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark__ui__enabled": "false", "spark__sql__shuffle__partitions": "8", "spark__driver__memory": "6g"}
    session = build_session("tidemark-tests", "local[8]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set(SHARED, str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def no_small_tables(spark):
    """Keep Spark from broadcasting a table because the test data is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def to_files(tmp_path):
    """Write rows as a folder of files that a stream reads in the given order."""

    def write(df, order: str, chunks: int, name: str = "in") -> str:
        folder = tmp_path / name
        folder.mkdir()
        table = df.orderBy(order).toArrow()
        step = -(-len(table) // chunks)
        for i in range(0, len(table), step):
            target = folder / f"{i:08d}.parquet"
            pq.write_table(table.slice(i, step), target)
            when = 1_700_000_000 + 10 * i
            os.utime(target, (when, when))
        return str(folder)

    return write
