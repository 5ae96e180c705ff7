"""Whitening against numpy, and with nulls, ties, ragged vectors, empty tables and odd columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import LLM_QUERIES, whitening

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, key string, x int, index int, place int, deviation int"


def _rows(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "k", 1, 2, 3, 4) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def _plain(vectors, components=32):
    """Whole numbers, their deviations, and the whitened rows by numpy."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(int) + 1_000_000
    n, sums = len(x), [sum(map(int, c)) for c in x.T]
    deviations = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
    centred = x - np.array(sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return deviations, centred @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def _collected(df):
    return df.orderBy("vec_id", "component").toPandas()


def test_query_gives_what_numpy_gives(spark):
    got = _collected(LLM_QUERIES["op11_block_whitening"](spark, SMALL))
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").toPandas()
    deviations, lines, explained = _plain(table.embedding.tolist())
    n = len(table)
    assert got.n.eq(n).all() and got.component.tolist() == [*range(1, 33)] * n
    assert got.vec_id.tolist() == np.repeat(table.vec_id, 32).tolist()
    assert got.deviation.tolist() == np.repeat(np.array(deviations), 32).tolist()
    mine = got.whitened.to_numpy().reshape(n, 32)
    assert np.allclose(mine * np.sign(mine[0]), lines * np.sign(lines[0]), atol=1e-9)
    assert np.allclose(got.explained[:32], explained, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_many_blocks_and_columns_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 12)
    monkeypatch.setattr(whitening, "SPLIT_VALUES", 48)
    vectors = np.random.default_rng(5).normal(size=(41, 8)).astype(np.float32).tolist()
    got = _collected(whitening.whitened(_rows(spark, enumerate(vectors)).repartition(5), "vec_id", "embedding", 5))
    deviations, lines, _ = _plain(vectors, 5)
    mine = got.whitened.to_numpy().reshape(41, 5)
    assert np.allclose(mine * np.sign(mine[0]), lines * np.sign(lines[0]), atol=1e-9)
    assert got.deviation[::5].tolist() == deviations and got.identity_error[0] < 1e-9


def test_nulls_repeats_short_vectors_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    full = rng.normal(size=(9, 4)).astype(np.float32).tolist()
    odd = [(20, None), (21, [1, None, 1, 1]), (22, [float("nan"), 1, 1, 1]), (23, [float("inf"), 1, 1, 1])]
    kept = [*enumerate(full), (0, full[0]), (None, full[3]), (30, full[4][:2]), (31, [])]
    got = whitening.whitened(_rows(spark, kept + odd), "vec_id", "embedding").toPandas()
    assert len(got) == 4 * len(kept) and got.n.eq(len(kept)).all()
    whole = [v + [0.0] * (4 - len(v)) for _, v in kept]
    deviations, lines, _ = _plain(whole)
    by_id = {i: d for (i, _), d in zip(kept, deviations)}
    assert all(d == by_id[None if np.isnan(i) else int(i)] for i, d in zip(got.vec_id, got.deviation))
    assert got.identity_error[0] < 1e-9


def test_components_without_variance_are_zero(spark):
    got = _collected(whitening.whitened(_rows(spark, [(1, [1, 2, 5]), (2, [2, 4, 5]), (3, [3, 6, 5])]), "vec_id", "embedding"))
    assert got[got.component > 1].whitened.eq(0).all() and got[got.component > 1].explained.eq(0).all()
    assert np.allclose(got[got.component == 1].whitened.abs(), [1.5**0.5, 0, 1.5**0.5]) and got.identity_error[0] < 1e-9
    one = whitening.whitened(_rows(spark, [(1, [1, 2])]), "vec_id", "embedding").collect()
    assert [(r.component, r.whitened, r.explained, r.deviation) for r in sorted(one)] == [(1, 0, 0, 0), (2, 0, 0, 0)]


def test_no_rows_and_numbers_that_are_too_large(spark):
    none = whitening.whitened(_rows(spark, [(1, None), (2, [])]), "vec_id", "embedding")
    assert none.count() == 0 and none.columns[:2] == ["vec_id", "n"]
    assert whitening.whitened(_rows(spark, []), "vec_id", "embedding").schema == none.schema
    large = _rows(spark, [(1, [3e16]), (2, [1.0])])
    with pytest.raises(Exception, match="too large"):
        whitening.whitened(large, "vec_id", "embedding").collect()


def test_only_the_two_columns_are_read(spark):
    got = whitening.whitened(spark.range(6).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double")).alias("embedding")), "vec_id", "embedding")
    assert got.count() == 6
