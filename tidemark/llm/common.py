"""Helpers the training-data operators share: reading tables, checked broadcasts, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemark.session import written

# A side of a join is broadcast only up to this size, as its rows and the elements of its arrays make it.
BROADCAST_BYTES = 64 << 20
_VALUE_BYTES = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_or_not(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, marked for broadcast if it is counted to be small, else joined by shuffle.

    Counted are its values: one for each column of a row, and the fields of each array element.
    """
    values = F.lit(0)
    for field in df.schema:
        if isinstance(field.dataType, ArrayType):
            inner = field.dataType.elementType
            width = len(inner) if isinstance(inner, StructType) else 1
            values = values + width * F.coalesce(F.size(field.name), F.lit(0))
        else:
            values = values + 1
    size = df.agg(F.sum(values.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size * _VALUE_BYTES <= most else df


def components(edges: DataFrame) -> DataFrame:
    """The smallest id reachable for every id of ``edges (a, b)``: columns ``id, component``.

    Every round links each id's larger neighbours, then its smaller ones, to the smallest id it
    knows, so chains shrink to stars in about log(length) rounds. All rounds are joins and
    aggregates on written tables; nothing but a count of changes reaches the driver.
    """
    links = written(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi != lo").distinct()
    )
    while True:
        both = links.select("hi", "lo").unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m"))
        # Large star: larger neighbours go to the smallest of the neighbourhood, the id included.
        large = (
            both.where("lo > hi")
            .join(least, "hi")
            .select(F.col("lo").alias("hi"), F.least("m", "hi").alias("lo"))
            .distinct()
        )
        large = written(large)
        # Small star: smaller neighbours and the id go to the smallest neighbour.
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(smallest, "hi")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .where("hi != lo")
            .unionByName(smallest.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        new = written(small)
        changed = new.exceptAll(links).limit(1).count() + links.exceptAll(new).limit(1).count()
        links = new
        if not changed:
            return links.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
