import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neardup

ARRAYS = "a array<long>, b array<long>, n long, similarity double"


def pair(rng, size, shared):
    """Two sets of ``size`` shingles that have ``shared`` of them in common."""
    values = rng.integers(0, 1 << 63, 2 * size - shared, dtype=np.uint64)
    return values[:size], np.concatenate([values[:shared], values[size:]])


@pytest.mark.parametrize("size", [1, 7, 40, 300, 1_000, 5_000, neardup.WHOLE_SHINGLES])
def test_whole_sketches_let_all_pairs_at_the_threshold_through(spark, size):
    rng = np.random.default_rng(size)
    # The least intersection that reaches the threshold, and one far from it.
    least = -(-2 * size * neardup.PERCENT // (100 + neardup.PERCENT))
    rows = []
    for shared in [least] * 200 + [size // 2] * 20:
        a, b = pair(rng, size, shared)
        similarity = shared / (2 * size - shared)
        sketches = [neardup.whole_sketch(s).tolist() for s in (a, b)]
        rows.append((*sketches, 2 * size, similarity))
    df = spark.createDataFrame(rows, ARRAYS)
    let = neardup.whole_may_link(F.col("a"), F.col("b"), F.col("n"))
    got = df.select(let.alias("let"), "similarity").collect()
    assert all(r["let"] for r in got if 100 * r["similarity"] >= neardup.PERCENT)
    if size >= 40:
        assert not any(r["let"] for r in got if r["similarity"] < 0.5)


def test_sets_of_similar_size_have_a_kind_of_sketch_in_common(spark):
    edge = neardup.WHOLE_SHINGLES
    for n in range(edge // 2, 2 * edge, 97):
        for m in (n, -(-4 * n // 3) - 1, 4 * n // 3):
            whole = max(n, m) <= edge
            fine = 4 * min(n, m) >= 3 * edge
            assert whole or fine or 100 * n < neardup.PERCENT * m
