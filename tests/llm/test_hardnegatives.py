"""Hard negatives against brute force, and with nulls, ties, repeated rows and ids, empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hardnegatives

SCHEMA = "vec_id long, embedding array<double>, label int, id int, v int, row int, cluster int, norm int, part int"


def _rows(spark, rows):
    df = spark.createDataFrame([(i, v, y, 1, 1, 1, 1, 1, 1) for i, v, y in rows], SCHEMA)
    return hardnegatives.labelled_vectors(df, "vec_id", "embedding", F.col("label"), scale=1)


def _plain(rows, is_anchor, k=5):
    rows = sorted({(i, y, tuple(map(int, np.floor(v)))) for i, v, y in rows})
    width = max((len(v) for *_, v in rows), default=0)
    rows = [(i, y, v + (0,) * (width - len(v))) for i, y, v in rows]
    out = []
    for a, y, u in rows:
        if not is_anchor(a):
            continue
        score = lambda v: sum(p * q for p, q in zip(u, v))
        same = sorted((-score(v), i) for i, z, v in rows if z == y and i != a)[:k]
        other = sorted((-score(v), i) for i, z, v in rows if z != y)
        for p, positive in same:
            fits = [(n, i) for n, i in other if 80 * -p <= 100 * -n <= 100 * -p][:k]
            out += [(a, positive, r, i, -p, -n) for r, (n, i) in enumerate(fits, 1)]
    return sorted(out)


def _mined(rows, anchors, **more):
    return sorted(map(tuple, hardnegatives.hard_negatives(rows, anchors, **more).collect()))


@pytest.mark.parametrize("batch_bytes", [hardnegatives.BATCH_BYTES, 200])
def test_random_rows_with_ties_equal_brute_force(spark, monkeypatch, batch_bytes):
    monkeypatch.setattr(hardnegatives, "STEP", 7)
    monkeypatch.setattr(hardnegatives, "TOGETHER", 3)
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist(), int(rng.integers(3))) for i in range(180)]
    rows += [(200 + i, rows[0][1], i % 3) for i in range(40)]
    got = _mined(_rows(spark, rows).repartition(4), F.col("id") % 9 == 0, batch_bytes=batch_bytes)
    assert got == _plain(rows, lambda i: i % 9 == 0) and len(got) > 100


def test_nulls_zeros_short_vectors_repeats_and_one_label(spark):
    nan = float("nan")
    odd = [(None, [1.0, 1.0], 1), (50, None, 1), (51, [1.0, None], 1), (52, [nan, 1.0], 1), (53, [1.0, 2.0], None)]
    rows = [
        (0, [2.0, 1.0], 1), (1, [2.0, 1.0], 1), (2, [2.0], 0), (3, [], 0), (4, [0.0, 0.0], 1), (10, [0.0, 0.0], 1),
        (5, [2.0, 0.0], 2), (5, [2.0, 0.0], 2), (20, [-5.0, 1.0], 7), (30, [1.0, 2.0], 1), (30, [2.0, 1.5], 0),
    ]
    got = _mined(_rows(spark, rows + odd), F.col("id") % 10 == 0)
    assert got == _plain(rows, lambda i: i % 10 == 0) and got
    assert _mined(_rows(spark, [(0, [1.0], 1), (1, [1.0], 1)]), F.lit(True)) == []


def test_no_rows_no_anchors_and_large_numbers(spark):
    assert _mined(_rows(spark, []), F.lit(True)) == []
    assert _mined(_rows(spark, [(1, [1.0], 1)]), F.lit(False)) == []
    assert _mined(_rows(spark, [(1, [], 1)]), F.lit(True)) == []
    # Above 2**53: whole numbers, not doubles.
    big = 2.0**29
    rows = [(0, [big, 1.0], 1), (1, [big, 0.0], 1), (2, [big, -1.0], 2), (3, [big, -2.0], 2), (4, [big - 1, 0.0], 2)]
    assert _mined(_rows(spark, rows), F.col("id") == 0) == _plain(rows, lambda i: i == 0)
    with pytest.raises(OverflowError):
        _mined(_rows(spark, [(0, [2.0**32], 1), (1, [1.0], 1)]), F.lit(True))


def test_no_bound_is_below_a_score():
    """The list's order times an anchor's length bounds each product from above."""
    rng = np.random.default_rng(2)
    members, vectors = rng.normal(size=(30, 6)) + 1, rng.normal(size=(400, 6)) * rng.gamma(2, size=(400, 1))
    centre = members.mean(0) / np.linalg.norm(members.mean(0))
    norms = np.linalg.norm(members, axis=1)
    widest = np.arccos((members @ centre / norms).clip(-1, 1)).max()
    lengths = np.linalg.norm(vectors, axis=1)
    angles = np.arccos((vectors @ centre / lengths).clip(-1, 1)) - widest - hardnegatives.SLACK
    assert (members @ vectors.T <= norms[:, None] * (lengths * np.cos(np.maximum(angles, 0)))[None, :] + 1e-9).all()
