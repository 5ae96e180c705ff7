"""Element-wise operators. None shuffles; all but the Python ones stay in one code stage.

Every function takes a bounded or a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import words

# Characters, bytes and array elements of the rows a user function gets at once.
FRAME_SIZE = 1 << 20


def map_columns(df: DataFrame, keep: list[str], **computed: Column) -> DataFrame:
    """Element to element: the kept columns plus the computed ones."""
    return df.select(*keep, *[expr.alias(name) for name, expr in computed.items()])


def keep_rows(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition)


def flat_map(df: DataFrame, keep: list[str], items: Column, item: str, position: str | None = None) -> DataFrame:
    """One row to as many rows as ``items`` has elements; none for an empty array."""
    if position is None:
        return df.select(*keep, F.explode(items).alias(item))
    exploded = df.select(*keep, F.posexplode(items).alias(position, item))
    return exploded.withColumn(position, F.col(position).cast("long"))


def flat_map_words(df: DataFrame, keep: list[str], text: str, separator: str = " ") -> DataFrame:
    return flat_map(df, keep, words(text, separator), "word", "pos")


def count_up_to(n: Column) -> Column:
    """The array 1..n, empty for n below 1 (a bare sequence would count downwards)."""
    return F.when(n > 0, F.sequence(F.lit(1).cast("long"), n)).otherwise(F.array().cast("array<bigint>"))


def map_series(df: DataFrame, column: str, fn: Callable[[pd.Series], pd.Series], out: str, out_type: str) -> DataFrame:
    """A user function on one column, a batch of values at a time."""
    return df.withColumn(out, F.pandas_udf(fn, out_type)(F.col(column)))


def map_frames(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, frame_size: int = FRAME_SIZE
) -> DataFrame:
    """A user function from frame to frame; it may change the number of rows.

    It is given rows whose texts, bytes and arrays have about ``frame_size`` elements together, or
    one row that has more, so what it makes of a frame does not grow with the batches it came in.
    """

    def pieces(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        start, held = 0, 0
        sizes = [0] * len(frame)
        for column in frame.select_dtypes(exclude=["number", "bool", "datetime", "timedelta"]).columns:
            sizes = [n + (len(v) if hasattr(v, "__len__") else 0) for n, v in zip(sizes, frame[column])]
        for at, size in enumerate(sizes):
            if at > start and held + size > frame_size:
                yield frame.iloc[start:at].reset_index(drop=True)
                start, held = at, 0
            held += size
        yield frame if start == 0 else frame.iloc[start:].reset_index(drop=True)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for piece in pieces(frame):
                yield fn(piece)

    return df.mapInPandas(each, schema)


def word_count(df: DataFrame, text: str, separator: str = " ") -> DataFrame:
    """Words are counted where they are read; only one row per word and task is shuffled."""
    listed = df.select(F.explode(words(text, separator)).alias("word"))
    return listed.groupBy("word").agg(F.count("*").alias("n"))
