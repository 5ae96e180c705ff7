"""Exact top-k inner products through a vector-approximation file.

Vectors are quantised component by component into cells. A scan of the cells alone bounds every
score from below and above; the k-th best lower bound over all candidates tells which ones can
still be among the best. Only their exact vectors are read, best upper bound first, until the k-th
score found is better than any bound left.

Equal vectors share one entry with their smallest ids: at most k of them can be in a result.
Queries are broadcast in blocks of a fixed number, so each scan task holds one block and one batch
of cells. A query's survivors are cut to k bounds in every scan task before they meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written

# A cell number takes a byte.
CELL_BITS = 8
# Queries in one broadcast: with 1,000 components of 8 bytes, 16 MB.
QUERY_BLOCK = 2_048
# Candidate rows bounded at once.
CELL_ROWS = 2_048


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int = 1024) -> DataFrame:
    """``id`` and ``v``, every component as floor(scale * x); rows without a full finite vector are left out."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return df.where(x.isNotNull() & ~bad & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("v"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of lists as a matrix; short lists are filled with zeros."""
    out = np.zeros((len(column), width))
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat):
        rows = np.repeat(np.arange(len(column)), lengths)
        out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def top_k(rows: DataFrame, queries: Column, k: int = 10, cell_bits: int = CELL_BITS) -> DataFrame:
    """The k best inner products of every query: ``query_id, rank, vec_id, score``.

    ``rows`` has whole-number vectors (``id, v``) as ``whole_vectors`` makes them; ``queries`` tells
    which of them are queries. Candidates are all rows but those with the query's own id. Ties go
    to the smaller id; fewer candidates give fewer rows. Missing components of shorter vectors
    count as zero. Repeated rows of one id and vector count once; an id with several vectors brings
    each as a query and as a candidate, so its lists share one ``query_id``. Sums of products that
    could reach 2**53, where doubles are no longer exact, are an error.
    """
    spark = rows.sparkSession
    rows = written(rows.distinct())
    # Equal vectors: the k + 1 smallest ids, one more as a query skips its own.
    same = Window.partitionBy("v").orderBy("id")
    firsts = rows.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1)
    entries = written(firsts.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    width = entries.agg(F.max(F.size("v"))).first()[0] or 0
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    places = [F.coalesce(F.get("v", F.lit(d)), F.lit(0)) for d in range(width)]
    ends = entries.agg(
        F.array(*[F.min(p) for p in places]).alias("lo"), F.array(*[F.max(p) for p in places]).alias("hi")
    ).first()
    low, high = np.array(ends["lo"], float), np.array(ends["hi"], float)
    largest = float((np.maximum(np.abs(low), np.abs(high)) ** 2).sum())
    if largest >= 2.0**53:
        raise OverflowError(f"inner products may reach {largest:.3g}; those from 2**53 on would not be exact")
    if not 1 <= cell_bits <= 8:
        raise ValueError("cells have 1 to 8 bits")
    cells = 1 << cell_bits
    # Whole-number cell edges: cell c of a component holds [low + c * step, low + (c + 1) * step - 1].
    step = np.maximum(1.0, np.ceil((high - low + 1) / cells))

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column("v"), width)
            codes = ((m - low) // step).astype(np.uint8)
            packed = [c.tobytes() for c in codes]
            yield pa.RecordBatch.from_pydict(
                {"entry": batch.column("entry"), "ids": batch.column("ids"), "cells": pa.array(packed, pa.binary())}
            )

    # An entry is known by its smallest id: ids belong to one vector each, or the row is told apart by it.
    entries = written(entries.withColumn("entry", F.xxhash64("v", F.get("ids", F.lit(0)))))
    va_file = written(entries.mapInArrow(approximate, "entry long, ids array<long>, cells binary"))
    asked = written(rows.where(queries).select("id", "v", F.xxhash64("id", "v").alias("query")))
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod("query", F.lit(n_blocks))
    found = [_block_survivors(va_file, asked.where(block == b), k, width, low, step) for b in range(n_blocks)]
    survivors = written(reduce(DataFrame.unionByName, found))
    # A query's k-th best lower bound over all tasks; the bounds of k candidates per task are kept.
    best = Window.partitionBy("query").orderBy(F.col("lower").desc(), "entry")
    certain = (
        survivors.withColumn("_n", F.row_number().over(best))
        .where(F.col("_n") <= k + 1)
        .groupBy("query")
        .agg(F.min("lower").alias("_least"), F.count("*").alias("_have"))
    )
    kept = survivors.join(certain, "query").where((F.col("_have") < k + 1) | (F.col("upper") >= F.col("_least")))
    exact = (
        kept.join(entries.select("entry", "v"), "entry")
        .join(asked.select("query", F.col("id").alias("query_id"), F.col("v").alias("q")), "query")
        .select("query", "query_id", "q", "upper", "ids", "v")
    )
    return exact.groupBy("query").applyInArrow(
        lambda t: _read_in_order(t, k, width), "query_id long, rank int, vec_id long, score long"
    )


def _block_survivors(
    va_file: DataFrame, asked: DataFrame, k: int, width: int, low: np.ndarray, step: np.ndarray
) -> DataFrame:
    """Per query of the block: the candidates a scan task can't rule out against its own k-th bound."""
    spark = va_file.sparkSession
    got = asked.select("query", "v").limit(2 * QUERY_BLOCK + 1).toArrow().combine_chunks()
    ids = got.column("query").to_numpy()
    if len(ids) > 2 * QUERY_BLOCK:
        raise ValueError("a query block is over its size")
    q = _matrix(got.column("v").combine_chunks(), width) if len(ids) else np.zeros((0, width))
    shared = spark.sparkContext.broadcast((ids, q))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        held: list[tuple[np.ndarray, ...]] = []
        at_least = np.full(len(ids), -np.inf)
        tops = np.full((len(ids), k + 1), -np.inf)
        entries = []
        base = 0
        for batch in batches:
            for start in range(0, batch.num_rows, CELL_ROWS):
                part = batch.slice(start, CELL_ROWS)
                codes = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, width)
                lo = low + codes * step
                hi = lo + step - 1
                upper = plus @ hi.T + minus @ lo.T
                lower = plus @ lo.T + minus @ hi.T
                both = np.concatenate([tops, lower], axis=1)
                tops = -np.partition(-both, k, axis=1)[:, : k + 1]
                at_least = tops.min(axis=1)
                a, b = np.nonzero(upper >= at_least[:, None])
                held.append((a, b + base, upper[a, b], lower[a, b]))
                used = np.unique(b)
                chosen = part.take(pa.array(used))
                entries.append((used + base, chosen.column("entry"), chosen.column("ids")))
                base += part.num_rows
        if not held or not len(ids):
            return
        a, b, upper, lower = (np.concatenate(x) for x in zip(*held))
        keep = upper >= at_least[a]
        a, b, upper, lower = a[keep], b[keep], upper[keep], lower[keep]
        places = np.concatenate([e[0] for e in entries])
        entry = pa.concat_arrays([e[1] for e in entries])
        lists = pa.concat_arrays([e[2] for e in entries])
        index = np.searchsorted(places, b)
        for s in range(0, len(a), 10_000):
            i = pa.array(index[s : s + 10_000])
            yield pa.RecordBatch.from_pydict(
                {
                    "query": pa.array(ids[a[s : s + 10_000]]),
                    "entry": entry.take(i),
                    "ids": lists.take(i),
                    "upper": pa.array(upper[s : s + 10_000]),
                    "lower": pa.array(lower[s : s + 10_000]),
                }
            )

    return va_file.mapInArrow(scan, "query long, entry long, ids array<long>, upper double, lower double")


def _read_in_order(t: pa.Table, k: int, width: int) -> pa.Table:
    """Exact scores of one query's survivors, best upper bound first, until k are certain."""
    query = t.column("query_id")[0].as_py()
    q = _matrix(t.column("q").slice(0, 1).combine_chunks(), width)[0]
    order = np.argsort(-t.column("upper").to_numpy(), kind="stable")
    upper = t.column("upper").to_numpy()[order]
    vectors, lists = t.column("v").combine_chunks(), t.column("ids").combine_chunks()
    best: list[tuple[int, int]] = []
    for start in range(0, len(order), 64):
        if len(best) >= k and upper[start] < -best[k - 1][0]:
            break
        some = pa.array(order[start : start + 64])
        scores = _matrix(vectors.take(some), width) @ q
        for score, ids in zip(scores.astype(np.int64).tolist(), lists.take(some).to_pylist()):
            best += [(-score, i) for i in ids if i != query]
        best = sorted(best)[:k]
    n = len(best)
    return pa.table(
        {
            "query_id": pa.array([query] * n, pa.int64()),
            "rank": pa.array(range(1, n + 1), pa.int32()),
            "vec_id": pa.array([i for _, i in best], pa.int64()),
            "score": pa.array([-s for s, _ in best], pa.int64()),
        }
    )
