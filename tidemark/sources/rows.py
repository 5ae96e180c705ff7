"""A bounded collection as a stream by row offsets: every batch takes the next n rows in a given order.

The rows are written once, sorted, as Parquet files with a table of how many rows each holds. An
offset is a number of rows from the start. Tasks read the ranges of files a batch is made of; the
driver sees only the names and row counts of the files.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS_PER_FILE = 1_000_000


class Stretch(InputPartition):
    """Some rows of one file, counted from its start."""

    def __init__(self, path: str, first: int, end: int):
        self.path, self.first, self.end = path, first, end


class RowsReader(DataSourceStreamReader):
    """Hands out the rows in steps. How far it has got is kept as the name of an empty file.

    That mark is set before a batch is planned: after a failure in between, the next batch has the
    rows of two.
    """

    def __init__(self, schema: StructType, folder: str, progress: str, rows_per_batch: int):
        self.schema = to_arrow_schema(schema)
        self.folder, self.progress, self.rows_per_batch = folder, progress, rows_per_batch
        system, at = fs.FileSystem.from_uri(f"{folder}/index")
        held = pq.read_table(at, filesystem=system).sort_by("place").to_pylist()
        self.files, self.total = [], 0
        for file in held:
            self.files.append((file["name"], self.total, self.total + file["n"]))
            self.total += file["n"]
        self.marks, self.at = fs.FileSystem.from_uri(progress)
        self.marks.create_dir(self.at, recursive=True)
        names = [f.base_name for f in self.marks.get_file_info(fs.FileSelector(self.at))]
        self.given = max((int(n) for n in names if n.isdigit()), default=0)

    def initialOffset(self) -> dict:
        return {"rows": 0}

    def latestOffset(self) -> dict:
        if self.given < self.total:
            self.given = min(self.total, self.given + self.rows_per_batch)
            self.marks.open_output_stream(f"{self.at}/{self.given}").close()
        return {"rows": self.given}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        first, last = start["rows"], end["rows"]
        if last < first:
            raise ValueError(f"{self.progress} is behind the checkpoint of this stream: {last} rows, not {first}")
        return [
            Stretch(f"{self.folder}/rows/{name}", max(first, lo) - lo, min(last, hi) - lo)
            for name, lo, hi in self.files
            if lo < last and first < hi
        ]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        system, at = fs.FileSystem.from_uri(partition.path)
        with system.open_input_file(at) as opened:
            file, passed = pq.ParquetFile(opened), 0
            for group in range(file.num_row_groups):
                n = file.metadata.row_group(group).num_rows
                if passed + n > partition.first and passed < partition.end:
                    at_row = passed
                    for batch in file.iter_batches(row_groups=[group]):
                        lo, hi = max(partition.first - at_row, 0), min(partition.end - at_row, batch.num_rows)
                        at_row += batch.num_rows
                        if lo < hi:
                            yield batch.slice(lo, hi - lo).cast(self.schema)
                passed += n

    def commit(self, end: dict) -> None:
        """Marks before the committed one are of no more use."""
        for mark in self.marks.get_file_info(fs.FileSelector(self.at)):
            if mark.base_name.isdigit() and int(mark.base_name) < end["rows"]:
                self.marks.delete_file(mark.path)


class RowsSource(DataSource):
    """Options: ``folder`` (see ``lay_rows``), ``progress`` (a folder of its own), ``rowsPerBatch``."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_rows"

    def streamReader(self, schema: StructType) -> RowsReader:
        o = self.options
        return RowsReader(schema, o["folder"], o["progress"], int(o["rowsPerBatch"]))


def _uri(path: str) -> str:
    return f"file://{path}" if path.startswith("/") else path


def lay_rows(rows: DataFrame, order: Sequence[str], folder: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write rows in a given order, with a table of the files' places in it and row counts.

    Rows that tie in ``order`` come in any order, but always the same one once they are written.
    """
    spark = rows.sparkSession
    rows.orderBy(*order).write.option("maxRecordsPerFile", rows_per_file).parquet(f"{folder}/rows")
    held = spark.read.schema(rows.schema).parquet(f"{folder}/rows").select(F.col("_metadata.file_name").alias("name"))
    # Tasks write in order, and each numbers its files: part-<task>-<run>-c<file>.
    numbers = [F.regexp_extract("name", p, 1).cast("long") for p in (r"^part-(\d+)-", r"-c(\d+)\.")]
    index = held.groupBy("name").agg(F.count("*").alias("n")).withColumn("place", F.struct(*numbers))
    index = index.select("name", "n", (F.col("place.col1") * F.lit(1_000_000) + F.col("place.col2")).alias("place"))
    index.coalesce(1).write.parquet(f"{folder}/index")


def stream_rows(
    spark: SparkSession, folder: str, schema: StructType, progress: str, rows_per_batch: int
) -> DataFrame:
    """The rows of ``lay_rows`` as a stream, ``rows_per_batch`` a batch.

    ``progress`` belongs to one checkpoint: a stream that starts anew needs a new one. Run it with a
    trigger by time and ``drain`` it; ``availableNow`` takes one batch only. The folders must be on
    a file system that pyarrow reaches.
    """
    if rows_per_batch < 1:
        raise ValueError("rows_per_batch must be at least 1")
    spark.dataSource.register(RowsSource)
    return (
        spark.readStream.format("tidemark_rows")
        .schema(schema)
        .option("folder", _uri(folder))
        .option("progress", _uri(progress))
        .option("rowsPerBatch", rows_per_batch)
        .load()
    )
