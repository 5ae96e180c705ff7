"""Session set-up and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and a UTC clock; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Keyed totals of streams are kept on disk rather than in executor memory.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        # Settled tables are removed from the shared folder once nothing refers to them.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Where a session without spark.checkpoint.dir keeps its folder; unlike that one it can be set later.
SHARED = "spark.tidemark.shared.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.tidemark.shared.dir, else spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder: on a cluster one would be lost
    with its machine.
    """
    named = spark.conf.get(SHARED, None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(SHARED, made)
    return made


def _jvm_path(spark: SparkSession, path: str):
    """A path and the file system it is on."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for one run, below the shared one. It is removed when the driver ends."""
    path = f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    jvm_path, system = _jvm_path(spark, path)
    system.deleteOnExit(jvm_path)
    return path


# The folder that tables settled inside ``passing`` go to.
_PASSING: ContextVar[str | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables settled in here are removed at the end, as a batch of a stream is done with them by then."""
    path = f"{shared_dir(spark)}/tidemark/passing-{uuid.uuid4().hex}"
    token = _PASSING.set(path)
    try:
        yield
    finally:
        _PASSING.reset(token)
        jvm_path, system = _jvm_path(spark, path)
        system.delete(jvm_path, True)


def settle(df: DataFrame) -> DataFrame:
    """Compute a small derived table once and read it from the shared folder from then on."""
    folder = _PASSING.get()
    if folder:
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Compute a derived table of any size once, as Parquet below the shared folder."""
    spark = df.sparkSession
    path = scratch_dir(spark, "written")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
