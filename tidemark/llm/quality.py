"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

Texts are counted as terms: trigrams of byte classes (letters, digits, space, kinds of
punctuation), trigrams of bytes by hash, and words equal to the word before. Term weights are
root shares times inverse document frequency; a truncated singular value decomposition of labelled
documents gives the latent space. Every document is compared with every labelled vector: batches
of documents times the whole labelled matrix, exact cosines, and the labels of the nearest vote
with their similarity.

The labelled rows are a bounded sample, so model and vectors are broadcast whatever the input's
size. Scoring reads each text once, whole, in the task that reads its row; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# Labelled documents of each class, at most; those with the smallest hash of their id.
SAMPLE_PER_CLASS = 1_000
DIMENSIONS = 64
NEIGHBOURS = 15
# Power of the similarity that a neighbour votes with.
SHARPNESS = 8
# Weight of the classes' prior, against a neighbour's weight of at most 1: decides for texts unlike any.
PRIOR_WEIGHT = 1e-3
HASHED = 1_024
# Documents compared at once, and bytes of one text counted at once.
BLOCK = 256
CHUNK = 1 << 20

_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r\t", ".", ",;:", "!", "?", "|", "%#$&*@^~", "'\"`", "()[]{}<>/\\", "-_+="]
_N = len(_CLASSES) + 2
_CLASS_OF = np.full(256, _N - 2, np.uint16)
_CLASS_OF[128:] = _N - 1
for _i, _members in enumerate(_CLASSES):
    _CLASS_OF[list(_members.encode())] = _i
SHAPES = _N**3
TERMS = SHAPES + HASHED + 2


def term_counts(text: str | None) -> np.ndarray:
    """Root shares of the terms of a whole text, each kind of term by itself; zeros for an empty text."""
    out = np.zeros(TERMS, np.float32)
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data) - 2
    if n > 0:
        for start in range(0, n, CHUNK):
            piece = data[start : min(start + CHUNK, n) + 2]
            c = _CLASS_OF[piece]
            shape = (c[:-2] * _N + c[1:-1]) * _N + c[2:]
            out[:SHAPES] += np.bincount(shape, minlength=SHAPES)
            b = piece.astype(np.uint32)
            mixed = (b[:-2] * 0x9E3779B1 + b[1:-1] * 0x85EBCA6B + b[2:] * 0xC2B2AE35) >> 16
            out[SHAPES : SHAPES + HASHED] += np.bincount(mixed % HASHED, minlength=HASHED)
        out[: SHAPES + HASHED] /= n
    words = (text or "").split()
    if len(words) > 1:
        same = sum(map(str.__eq__, words, words[1:]))
        out[-2] = same / (len(words) - 1)
        out[-1] = 1.0 - out[-2]
    return np.sqrt(out)


@dataclass(frozen=True)
class Model:
    """Term weights, the projection to the latent space, and the labelled unit vectors in it."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(counts * self.weights) @ self.projection)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled vectors, weighted by a power of their cosine."""
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return np.full(len(counts), self.prior)
        cosines = self.latent(counts) @ self.vectors.T
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosines, nearest, axis=1), 0, 1).astype(float) ** SHARPNESS
        votes = (weight * self.labels[nearest]).sum(1) + PRIOR_WEIGHT * self.prior
        return np.clip(votes / (weight.sum(1) + PRIOR_WEIGHT), 0, 1).round(6)


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return (m / np.where(length > 0, length, 1)).astype(np.float32)


def _projection(m: np.ndarray, dimensions: int, seed: int = 7) -> np.ndarray:
    """Right singular vectors of the largest values, by subspace iteration."""
    k = min(dimensions + 16, *m.shape)
    basis = np.random.default_rng(seed).standard_normal((m.shape[1], k)).astype(np.float32)
    for _ in range(5):
        basis, _ = np.linalg.qr(m.T @ (m @ basis))
    _, _, right = np.linalg.svd(m @ basis, full_matrices=False)
    return (basis @ right.T)[:, :dimensions].astype(np.float32)


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS
) -> Model:
    """Learn from at most ``per_class`` labelled documents of each class.

    ``labels`` has doc_id and the 0/1 ``label``; a document labelled both ways counts as what most
    of its rows say, as 1 in a tie. Null labels and ids are left out. Without labelled documents
    every score is the prior, 0.5 then.
    """
    agreed = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = [agreed.where(F.col("_label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    shares = agreed.agg(F.avg("_label")).first()[0]
    chosen = F.broadcast(sample[0].unionByName(sample[1]))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates(["doc_id"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [term_counts(t).astype(np.float16).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("doc_id"), "y": batch.column("_label"), "counts": pa.array(counts, pa.binary())}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    # Two bounded samples: some ten MB reach the driver.
    got = rows.mapInArrow(count, f"id {kind}, y int, counts binary").toArrow().sort_by("id")
    if not got.num_rows:
        none = np.zeros((0, DIMENSIONS), np.float32)
        return Model(np.zeros(TERMS, np.float32), np.zeros((TERMS, DIMENSIONS), np.float32), none, np.zeros(0), 0.5)
    counts = np.stack([np.frombuffer(c, np.float16) for c in got.column("counts").to_pylist()]).astype(np.float32)
    seen = (counts > 0).sum(0)
    weights = (np.log((len(counts) + 1) / (seen + 1)) + 0.05).astype(np.float32)
    counts *= weights
    weighted = _unit(counts)
    del counts
    projection = _projection(weighted, DIMENSIONS)
    y = got.column("y").to_numpy().astype(float)
    return Model(weights, projection, _unit(weighted @ projection), y, float(shares))


def scored(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of the whole text, 0 to 1.

    A null or empty text is like none of the labelled ones and gets the prior. Scores depend on
    the text alone; they are rounded to six places, as sums differ in their last digits by block.
    """
    if column in docs.columns:
        raise ValueError(f"there is a column {column!r} already")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                some = batch.slice(start, BLOCK)
                counts = np.stack([term_counts(t) for t in some.column(at).to_pylist()])
                values = pa.array(shared.value.scores(counts), pa.float64())
                names = [*some.schema.names, column]
                yield pa.RecordBatch.from_arrays([*some.columns, values], names=names)

    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return docs.mapInArrow(score, schema)
