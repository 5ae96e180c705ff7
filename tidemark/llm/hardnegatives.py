"""Hard negatives by exact search over candidate lists that the anchors of a cluster share.

Anchors are clustered by direction. No inner product of a cluster's anchor u with a candidate i is
above |u| |i| cos(max(0, angle(centre, i) - widest)), widest being the largest angle of an anchor to
the centre. Candidates sorted by |i| cos(...) make one list for all anchors of the cluster. Each
walks it until the bound of the next candidate, times |u|, is below what it still looks for.

The lists are kept by slices of the candidates: a task sorts the slice at hand once for every
cluster, the anchors walk it, and go into the next slice with the best they have found. Anchors
are broadcast in batches of a fixed number of bytes, one job a batch. Positives are found first,
as the negatives of a pair are bounded from both sides by its score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir, written

# Most clusters of anchors: their centres and the lists of one slice are held by a task.
CLUSTERS = 256
# Bytes of anchors' vectors in one broadcast.
BATCH_BYTES = 32 << 20
# Bytes of a slice of candidates, and candidates an anchor looks at in one step of its walk.
SLICE_BYTES = 8 << 20
STEP = 512
# Anchors of a cluster whose scores a task holds at once, for one step.
TOGETHER = 2_048
# Added to the widest angle: more than the rounding of an angle found from its cosine.
SLACK = 1e-6

LOWEST, HIGHEST = -(2**63), 2**63 - 1
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def labelled_vectors(df: DataFrame, key: str, vector: str, label: Column, scale: int = 256) -> DataFrame:
    """``id, label, v``, each component as floor(scale * x), of rows with a key, a label and a full finite vector."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return df.where(x.isNotNull() & ~bad & F.col(key).isNotNull() & label.isNotNull()).select(
        F.col(key).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("v"),
    )


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    out = np.zeros((len(column), width), kind)
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class Best:
    """The k first (score falling, id rising) of many groups."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.score = np.full((groups, k), np.iinfo(np.int64).min)
        self.id = np.full((groups, k), np.iinfo(np.int64).max)
        self.found = np.zeros((groups, k), bool)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched, group = np.unique(group, return_inverse=True)
        held = self.found[touched]
        group = np.concatenate([group, np.nonzero(held)[0]])
        score = np.concatenate([score, self.score[touched][held]])
        ids = np.concatenate([ids, self.id[touched][held]])
        # Scores are negated only where the smallest long is no score.
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        first = place < self.k
        at = touched[group[first]], place[first]
        self.score[at], self.id[at], self.found[at] = score[first], ids[first], True

    def least(self) -> np.ndarray:
        """The k-th score of each group, the smallest long where there are fewer."""
        return self.score[:, -1]


@dataclass(frozen=True)
class Wanted:
    """What each of a cluster's anchors looks for: groups of scores from ``low`` to ``high``."""

    cluster: int
    centre: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    widest: float
    labels: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    # One column per group of an anchor; low over high where nothing can match.
    low: np.ndarray
    high: np.ndarray


def _walk(
    wanted: Wanted, best: Best, base: int, same: bool, slice_: tuple, slack: float, step: int, together: int
) -> None:
    """All anchors of a cluster over the cluster's list of one slice."""
    ids, labels, vectors, norms = slice_
    cosines = np.divide(vectors @ wanted.centre, norms, out=np.ones(len(norms)), where=norms > 0)
    angles = np.arccos(np.clip(cosines, -1, 1)) - wanted.widest - SLACK
    bounds = norms * np.cos(np.maximum(angles, 0))
    order = np.argsort(-bounds, kind="stable")
    bounds = bounds[order]
    groups = wanted.low.shape[1]
    first = base + np.arange(len(wanted.rows)) * groups
    kth = np.stack([best.least()[first + g] for g in range(groups)], axis=1)
    for at in range(0, len(order), step):
        # An anchor goes on while a candidate with the next bound could still come in somewhere.
        needed = np.where(wanted.low <= wanted.high, np.maximum(wanted.low, kth).astype(float), np.inf).min(axis=1)
        reach = wanted.norms * bounds[at]
        going = np.nonzero(reach + np.abs(reach) * 1e-9 + slack >= needed)[0]
        if not len(going):
            return
        some = order[at : at + step]
        for start in range(0, len(going), together):
            walking = going[start : start + together]
            scores = (wanted.vectors[walking] @ vectors[some].T).astype(np.int64)
            equal = wanted.labels[walking][:, None] == labels[some][None, :]
            allowed = equal & (wanted.ids[walking][:, None] != ids[some][None, :]) if same else ~equal
            for g in range(groups):
                low, high = np.maximum(wanted.low[walking, g], kth[walking, g]), wanted.high[walking, g]
                a, b = np.nonzero(allowed & (scores >= low[:, None]) & (scores <= high[:, None]))
                if len(a):
                    best.add(first[walking[a]] + g, scores[a, b], ids[some[b]])
                    kth[walking, g] = best.least()[first[walking] + g]


def _search(
    candidates: DataFrame, wanted: list[Wanted], k: int, same: bool, width: int, exact: type, path: str
) -> None:
    """Write ``anchor, part, id, score``: per task the k best of every group of every anchor."""
    bases = np.concatenate([[0], np.cumsum([w.low.size for w in wanted])])
    shared = candidates.sparkSession.sparkContext.broadcast(wanted)
    rows_at_once = max(STEP, SLICE_BYTES // (8 * width))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        best = Best(int(bases[-1]), k)
        for batch in batches:
            for start in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(start, rows_at_once)
                vectors = _matrix(part.column("v"), width, exact)
                norms = np.sqrt((vectors.astype(float) ** 2).sum(1))
                slice_ = (part.column("id").to_numpy(), part.column("label").to_numpy(), vectors, norms)
                for w, base in zip(wanted, bases):
                    _walk(w, best, int(base), same, slice_, 1e-6 * width, STEP, TOGETHER)
        group, place = np.nonzero(best.found)
        anchors = np.concatenate([np.repeat(w.rows, w.low.shape[1]) for w in wanted])
        parts = np.concatenate([np.tile(np.arange(w.low.shape[1]), len(w.rows)) for w in wanted])
        for s in range(0, len(group), 10_000):
            g, p = group[s : s + 10_000], place[s : s + 10_000]
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": pa.array(anchors[g]),
                    "part": pa.array(parts[g], pa.int32()),
                    "id": pa.array(best.id[g, p]),
                    "score": pa.array(best.score[g, p]),
                }
            )

    candidates.select("id", "label", "v").mapInArrow(scan, "anchor long, part int, id long, score long").write.parquet(path)
    shared.unpersist()


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k first of all tasks' results."""
    order = Window.partitionBy("anchor", "part").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _clustered(anchors: DataFrame, clusters: int, width: int, seed: int) -> tuple[DataFrame, np.ndarray]:
    """Written anchors with their ``cluster``, and the centres' directions.

    Vectors of zeros have no direction and go to the first cluster: their bounds are zero anyway.
    """
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    turned = written(anchors.withColumn("norm", F.sqrt(square)))
    whole = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
    unit = array_to_vector(F.transform(whole, lambda c: c.cast("double") / F.col("norm")))
    some = turned.where("norm > 0").withColumn("unit", unit)
    if not some.limit(1).count():
        return written(turned.withColumn("cluster", F.lit(0))), np.zeros((1, width))
    model = KMeans(
        k=clusters, featuresCol="unit", predictionCol="cluster", distanceMeasure="cosine", maxIter=8, seed=seed
    ).fit(some)
    placed = model.transform(some).drop("unit").unionByName(
        turned.where("norm = 0").withColumn("cluster", F.lit(0))
    )
    return written(placed), np.array(model.clusterCenters())


def _batches(spark: SparkSession, anchors: DataFrame, centres: np.ndarray, width: int, exact: type, batch_bytes: int):
    """Clusters of anchors, in lists of at most ``batch_bytes``; larger clusters come in pieces."""
    most = max(1, batch_bytes // (8 * width))
    sizes = {r["cluster"]: r["count"] for r in anchors.groupBy("cluster").count().collect()}
    taken, held = [], 0
    pieces = [(c, p, -(-n // most), n) for c, n in sorted(sizes.items()) for p in range(-(-n // most))]
    for i, (cluster, piece, parts, n) in enumerate(pieces):
        taken.append((F.col("cluster") == cluster) & (F.pmod(F.xxhash64("row"), F.lit(parts)) == piece))
        held += -(-n // parts)
        if i + 1 == len(pieces) or held + -(-pieces[i + 1][3] // pieces[i + 1][2]) > most:
            some = taken[0]
            for t in taken[1:]:
                some = some | t
            yield _members(anchors.where(some), centres, width, exact)
            taken, held = [], 0


def _members(anchors: DataFrame, centres: np.ndarray, width: int, exact: type) -> list[Wanted]:
    table = anchors.orderBy("cluster", "row").toArrow().combine_chunks()
    vectors = _matrix(table.column("v").combine_chunks(), width, exact)
    clusters, norms = table.column("cluster").to_numpy(), table.column("norm").to_numpy()
    low, high = (_matrix(table.column(c).combine_chunks(), len(table.column(c)[0]), np.int64) for c in ("low", "high"))
    out = []
    for c in np.unique(clusters):
        at = np.nonzero(clusters == c)[0]
        centre = centres[c] / (np.linalg.norm(centres[c]) or 1.0)
        cosines = np.divide(vectors[at] @ centre, norms[at], out=np.ones(len(at)), where=norms[at] > 0)
        columns = [table.column(x).to_numpy()[at] for x in ("label", "id", "row")]
        widest = float(np.arccos(np.clip(cosines, -1, 1)).max()) + SLACK
        out.append(Wanted(int(c), centre, vectors[at], norms[at], widest, *columns, low[at], high[at]))
    return out


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    least: tuple[int, int] = (80, 100),
    seed: int = 17,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of other labels scored in a band below the positive.

    ``rows`` is ``id, label, v`` as ``labelled_vectors`` makes it, ``anchors`` tells which rows are
    anchors. Scores are inner products; higher ones come first, ties by the smaller id. Positives are
    the first rows of the anchor's label that have another id. A negative's score n is at most the
    positive's p, with least[1] * n >= least[0] * p; so a positive below zero has none.

    Fewer positives or negatives give fewer rows. Rows repeated whole count once. An id with several
    different rows: each row counts, and as an anchor each has its own positives and negatives, all
    under that id. Missing components of shorter vectors count as zero. Scores are exact: products of
    lengths from 2**53 on are worked out in whole numbers, from 2**62 on they are an error.
    """
    spark = rows.sparkSession
    rows = written(rows.distinct().withColumn("row", F.monotonically_increasing_id()))
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    ends = rows.agg(F.max(F.size("v")).alias("width"), F.max(square).alias("square")).first()
    asked = rows.where(anchors)
    n_anchors = asked.count()
    if not ends["width"] or not n_anchors:
        return spark.createDataFrame([], OUT)
    width, largest = ends["width"], ends["square"]
    if largest >= 2.0**62:
        raise OverflowError("scores of these vectors may be too large for a long")
    exact = float if largest < 2.0**52 else np.int64
    clustered, centres = _clustered(asked, min(CLUSTERS, max(2, round(n_anchors**0.5))), width, seed)

    def search(asking: DataFrame, k: int, same: bool) -> DataFrame:
        path = scratch_dir(spark, "walks")
        for b, wanted in enumerate(_batches(spark, asking, centres, width, exact, batch_bytes)):
            _search(rows, wanted, k, same, width, exact, f"{path}/batch={b}")
        found = spark.read.schema("anchor long, part int, id long, score long").parquet(f"{path}/batch=*")
        return written(_first(found, k))

    anything = [F.array(F.lit(LOWEST)).alias("low"), F.array(F.lit(HIGHEST)).alias("high")]
    first = search(clustered.select("*", *anything), positives, same=True).select(
        "anchor", (F.col("rank") - 1).alias("part"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    a, b = least
    score = F.col("positive_score")
    # The least whole number n with b * n >= a * score, without a product over a long.
    quotient = F.call_function("div", score - F.pmod(score, F.lit(b)), F.lit(b))
    lowest = quotient * a + F.ceil(F.pmod(score, F.lit(b)) * a / b)
    ranges = first.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("part", lowest.alias("low"), score.alias("high")))).alias("r")
    )

    def padded(field: str, missing: int) -> Column:
        """Anchors with fewer positives get groups that nothing can match."""
        have = F.transform("r", lambda x: x[field].cast("long"))
        return F.concat(have, F.array_repeat(F.lit(missing), F.lit(positives) - F.size("r"))).alias(field)

    asking = clustered.join(ranges, clustered["row"] == ranges["anchor"])
    asking = asking.select(*clustered.columns, padded("low", HIGHEST), padded("high", LOWEST))
    second = search(written(asking), negatives, same=False).select(
        "anchor", "part", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    names = clustered.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        second.join(first, ["anchor", "part"])
        .join(names, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
