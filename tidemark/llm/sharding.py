"""Sharding in Hilbert-curve order: shards are runs of the curve, so each holds a small box of metadata.

Several metadata columns are quantised to the same number of bits and folded into one index along
a Hilbert curve. Rows are sorted by it and cut into runs. A file of such a run has narrow minima
and maxima in every column at once, which lets a reader prune by any of them.

Everything is DataFrame expressions. No row goes through a single task: rows are range-partitioned
by the index with a unique tail, so a hot cell or a hot text is split, and ranks come from a running
sum over the partitions' counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tidemark.session import written

BITS = 6
LAWS = ("rows", "bytes")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def hilbert_index(coordinates: list[Column], bits: int) -> Column:
    """Position on the Hilbert curve through the grid with ``2**bits`` cells a side, as a long.

    The coordinates' bits are brought to transposed form by exchanging or inverting the low bits,
    from the highest bit down, then Gray-coded and interleaved.
    """
    n = len(coordinates)
    if n * bits > 62:
        raise ValueError("dimensions times bits must be at most 62")
    one = F.lit(1).cast("long")
    axes = F.array(*[c.cast("long") for c in coordinates])
    steps = F.array(
        *[
            F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i"))
            for b in range(bits - 1, 0, -1)
            for i in range(n)
        ]
    )

    def undo(x: Column, s: Column) -> Column:
        low = s["q"] - one
        at, first = F.get(x, s["i"]), F.get(x, F.lit(0))
        set_ = at.bitwiseAND(s["q"]) != 0
        swap = first.bitwiseXOR(at).bitwiseAND(low)
        return F.transform(
            x,
            lambda v, j: F.when(j == 0, F.when(set_, v.bitwiseXOR(low)).otherwise(v.bitwiseXOR(swap)))
            .when((j == s["i"]) & ~set_, v.bitwiseXOR(swap))
            .otherwise(v),
        )

    turned = F.aggregate(steps, axes, undo) if bits > 1 else axes

    def gray(x: Column) -> Column:
        # Each axis is exclusive-ored with the ones before it, so a prefix fold gives them all.
        return F.aggregate(
            x,
            F.array().cast("array<bigint>"),
            lambda done, v: F.concat(
                done, F.array(v.bitwiseXOR(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0).cast("long"))))
            ),
        )

    def interleave(x: Column) -> Column:
        places = F.array(
            *[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)]
        )
        return F.aggregate(
            places,
            F.lit(0).cast("long"),
            lambda h, p: h * 2 + F.get(x, p["i"]).bitwiseAND(F.call_function("shiftleft", one, p["b"])).cast("boolean").cast("long"),
        )

    def finish(x: Column) -> Column:
        last = F.get(x, F.lit(n - 1))
        flips = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)])
        t = F.aggregate(
            flips, F.lit(0).cast("long"), lambda acc, q: F.when(last.bitwiseAND(q) != 0, acc.bitwiseXOR(q - one)).otherwise(acc)
        )
        return interleave(F.transform(x, lambda v: v.bitwiseXOR(t)))

    # One-element arrays bind each step's result once, so expressions don't multiply.
    bound = F.transform(F.array(turned), gray) if n else None
    return F.element_at(F.transform(bound, finish), 1)


def quantised(df: DataFrame, dimensions: list[str], bits: int = BITS) -> list[Column]:
    """Each column as a whole number below ``2**bits``; null is 0.

    Numbers are scaled between their extremes, by logarithm if none is negative; NaN counts as
    null. Other types count as text: with at most ``2**bits - 1`` values by rank, so that order is
    kept, else by hash. One pass takes the extremes and at most that many values.
    """
    cells = 1 << bits
    numbers, stats = {}, []
    for name in dimensions:
        if isinstance(df.schema[name].dataType, NumericType):
            x = F.col(name).cast("double")
            numbers[name] = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
            stats += [F.min(numbers[name]).alias(f"lo_{name}"), F.max(numbers[name]).alias(f"hi_{name}")]
    found = df.agg(*stats).first().asDict() if stats else {}
    out = []
    for name in dimensions:
        if name in numbers:
            lo, hi = found[f"lo_{name}"], found[f"hi_{name}"]
            if lo is None or lo == hi:
                out.append(F.lit(0))
                continue
            scale = (lambda c: F.log1p(c)) if lo >= 0 else (lambda c: c)
            low, high = scale(F.lit(lo)), scale(F.lit(hi))
            place = F.floor((scale(numbers[name]) - low) / (high - low) * cells).cast("int")
            out.append(F.coalesce(F.greatest(F.lit(0), F.least(place, F.lit(cells - 1))), F.lit(0)))
        else:
            text = F.col(name).cast(StringType())
            values = sorted(r[0] for r in df.select(text.alias("v")).where("v is not null").distinct().limit(cells).collect())
            if len(values) < cells:
                rank = F.array_position(F.array(*map(F.lit, values)), text) if values else F.lit(0)
                step = cells / (len(values) + 1)
                out.append(F.coalesce(F.floor(rank * step).cast("int"), F.lit(0)))
            else:
                out.append(F.coalesce((F.xxhash64(text).bitwiseAND(cells - 1)).cast("int"), F.lit(0)))
    return out


def hilbert_shards(
    df: DataFrame, key: str, dimensions: list[str], sizes: Mapping[str, Column], shards: int, law: str = "rows", bits: int = BITS
) -> DataFrame:
    """``key``, the columns of ``sizes`` (``size`` among them), ``curve``, ``rank``, ``shard``, ``slot``.

    ``rows`` cuts the sorted rows into shards whose counts differ by one at most, ``bytes`` where
    the running ``size`` passes equal shares. Equal curve positions are ordered by ``text_crc32``
    if that is given, then by key, then by a hash of the row; rows equal in all of it may take each
    other's place. Null keys sort first. An empty table gives no rows.
    """
    if law not in LAWS:
        raise ValueError(f"law must be one of {LAWS}, not {law!r}")
    spark = df.sparkSession
    curve = hilbert_index(quantised(df, dimensions, bits), bits)
    tail = ["text_crc32"] if "text_crc32" in sizes else []
    order = ["curve", *tail, key, "_row"]
    placed = df.select(
        F.col(key), *[c.alias(n) for n, c in sizes.items()], curve.alias("curve"), F.xxhash64(*df.columns).alias("_row")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The partition's number is written down: later reads must not depend on how it came about.
    sorted_parts = written(placed.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    # One row per partition, so the running sum in one task stays small.
    counts = sorted_parts.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("size").alias("_bytes"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.sum("_n").over(everywhere).alias("_rows"),
        F.sum("_bytes").over(everywhere).alias("_all_bytes"),
    )
    within = Window.partitionBy("_part").orderBy(*order)
    ranked = sorted_parts.join(F.broadcast(starts), "_part").select(
        "*",
        (F.row_number().over(within) - 1 + F.col("_rows_before")).alias("rank"),
        (F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))).alias("_own_before"),
    )
    if law == "rows":
        shard = F.call_function("div", F.col("rank") * shards, F.col("_rows"))
        first = F.call_function("div", shard * F.col("_rows") + shards - 1, F.lit(shards).cast("long"))
        ranked = ranked.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("rank") - first)
    else:
        at = F.coalesce("_own_before", F.lit(0)) + F.col("_bytes_before")
        shard = F.call_function("div", at * shards, F.greatest("_all_bytes", F.lit(1)))
        ranked = written(ranked.withColumn("shard", F.least(shard, F.lit(shards - 1)).cast("int")))
        firsts = ranked.groupBy("shard").agg(F.min("rank").alias("_first"))
        ranked = ranked.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("rank") - F.col("_first"))
    return ranked.select(key, *sizes, "curve", "rank", "shard", "slot")
