"""Near-duplicate documents by MinHash bands and odd sketches, confirmed on full shingle sets.

Every text is read once. Its set of word shingles gives MinHash samples; runs of them are band
keys. All samples are also folded into a bitmap of parities, the odd sketch: the exclusive or of
two bitmaps has as many ones as the samples differ in, which tells high similarities closely from a
few words of memory. Documents that share a band key are candidates; those whose bitmaps look far
from similar are not looked at again; the others are confirmed on their full sets.

Equal sets are one entry from the start, so copies cost nothing. Each entry is first compared with
one other only: the smallest of a bucket, of those the one it shares most bands with. Entries that
are not linked by that are compared with the smallest and the largest of all their buckets.
Connected entries need no further comparison. Only in buckets that still hold several components
are the entries outside the largest one compared with those of other components, by larger odd
sketches too, and of those pairs only the ones let through become rows. The larger sketches hold
the parities of all shingles of a set, or of more samples if it is very large. Buckets with many
entries left are divided by a second band first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import components, small_or_not
from tidemark.session import written

WORDS = 5
# 100 * intersection >= PERCENT * union.
PERCENT = 75
# With 32 bands of 4 samples a pair of similarity 0.75 shares no band once in 190,000 times.
BANDS = 32
ROWS = 4
SAMPLES = BANDS * ROWS
# Bits of the odd sketch.
BITS = 512
# Estimates have a deviation of about 0.045 at 0.75; below this a pair is not confirmed.
LEAST_ESTIMATE = 0.52
# Samples and bits of the finer sketch of entries that are left: a deviation of about 0.017.
FINE_SAMPLES = 1_024
FINE_BITS = 4_096
LEAST_FINE = 0.66
# Sets up to this size are left with the parities of all their shingles instead, which tell the
# difference of two such sets to 0.006 of similarity at 1,000 shingles, 0.009 at the most. Sizes
# of sets at the threshold differ by a third at most, so from three quarters of it sets have both.
WHOLE_SHINGLES = 8_192
# A pair is ruled out beyond so many deviations of the ones that sets at the threshold differ in.
WHOLE_DEVIATIONS = 6
# Buckets with more entries left are compared in blocks of about so many with all the others.
LARGE_BUCKET = 2_000
REMEMBERED = 400_000

_U = np.uint64
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(WORDS)], _U)
_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 1 << 63, FINE_SAMPLES, dtype=np.uint64) * _U(2) + _U(1)
_SALTS = _rng.integers(1, 1 << 63, FINE_SAMPLES, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Distinct shingles of a text as sorted 64-bit numbers, with a memory of word hashes."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        try:
            hashes = [known[w] for w in words]
        except KeyError:
            hashes = []
            for w in words:
                h = known.get(w)
                if h is None:
                    h = xxhash.xxh3_64_intdigest(w)
                    if len(known) < REMEMBERED:
                        known[w] = h
                hashes.append(h)
        h = np.array(hashes, _U)
        if not len(h):
            return h
        if len(h) < WORDS:
            return _mixed((h * _POWERS[: len(h)]).sum(keepdims=True) + _U(len(h)))
        n = len(h) - WORDS + 1
        total = np.zeros(n, _U)
        for i in range(WORDS):
            total += h[i : i + n] * _POWERS[i]
        return np.unique(_mixed(total))


def samples(shingles: np.ndarray, count: int = SAMPLES) -> np.ndarray:
    """The smallest value of each of ``count`` sampling functions over a set."""
    out = np.full(count, np.iinfo(np.uint64).max, _U)
    step = 262_144 // count
    for start in range(0, len(shingles), step):
        part = shingles[start : start + step]
        np.minimum(out, (part[None, :] * _FACTORS[:count, None]).min(axis=1), out=out)
    return out


def odd_sketch(minima: np.ndarray, n_bits: int = BITS) -> np.ndarray:
    """Parities of how many samples fall on each bit, as 64-bit words."""
    at = (_mixed(minima ^ _SALTS[: len(minima)]) % _U(n_bits)).astype(np.int64)
    bits = np.bincount(at, minlength=n_bits) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def whole_sketch(shingles: np.ndarray, n_bits: int = FINE_BITS) -> np.ndarray:
    """Parities of how many shingles of a set fall on each bit, as 64-bit words."""
    at = (_mixed(shingles) % _U(n_bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=n_bits) & 1).astype(np.uint8)).view(np.int64)


def band_keys(minima: np.ndarray) -> np.ndarray:
    rows = minima.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=_U) * _U(0xD6E8FEB86659FD93)
    for i in range(ROWS):
        key = _mixed(key ^ rows[:, i])
    return key.view(np.int64)


def _ones(a: Column, b: Column) -> Column:
    """The ones in the exclusive or of two odd sketches."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, c: n + c)


def whole_may_link(a: Column, b: Column, shingles: Column, n_bits: int = FINE_BITS) -> Column:
    """Whether sets behind two whole sketches can reach the threshold; ``shingles``: their sizes' sum.

    At the threshold sets differ in a known share of that sum. Each bit of the exclusive or is the
    parity of how many of those shingles fall on it, which gives the mean and variance of the ones.
    """
    differ = shingles * F.lit((100 - PERCENT) / (100 + PERCENT))
    one, two = F.pow(F.lit(1 - 2 / n_bits), differ), F.pow(F.lit(1 - 4 / n_bits), differ)
    mean = n_bits / 2 * (1 - one)
    variance = (n_bits + n_bits * (n_bits - 1) * two - n_bits * n_bits * one * one) / 4
    return _ones(a, b) <= mean + WHOLE_DEVIATIONS * F.sqrt(F.greatest(variance, F.lit(1.0)))


def similarity_estimate(a: Column, b: Column, n_bits: int = BITS, count: int = SAMPLES) -> Column:
    """Similarity of the sets behind two odd sketches, from the ones in their exclusive or."""
    ones = _ones(a, b)
    share = F.least(2 * ones / F.lit(n_bits), F.lit(0.999))
    return 1 - (-F.lit(n_bits / 2) * F.log(1 - share)) / (2 * count)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows a few hundred at a time, so that what is made of them stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            yield batch.slice(start, 512)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands, odd``; equal sets have equal keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in _slices(batches):
            sizes, keys, bands, odds = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingler(text)
                sizes.append(len(s))
                if not len(s):
                    keys.append(b"")
                    bands.append([])
                    odds.append([])
                    continue
                minima = samples(s)
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                bands.append(band_keys(minima))
                odds.append(odd_sketch(minima))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "set_key": pa.array(keys, pa.binary()),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                    "odd": pa.array(odds, pa.list_(pa.int64())),
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles long, set_key binary, bands array<long>, odd array<long>"
    return docs.select("doc_id", "text").mapInArrow(sketch, schema)


def with_set_keys(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, then ``_set_key`` as ``sketches`` has it."""
    at = docs.columns.index("text")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in _slices(batches):
            sets = [shingler(t) for t in batch.column(at).to_pylist()]
            own = pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"" for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, "_set_key"])

    return docs.mapInArrow(keys, docs.select("*", F.lit(b"").alias("_set_key")).schema)


def _sets(docs: DataFrame, entries: DataFrame, ids: DataFrame) -> DataFrame:
    """Full shingle sets of some entries: ``id, shingles``, sorted 64-bit numbers.

    The texts of their documents are read again. A document may have several texts, so the sets are
    told apart by their keys.
    """
    wanted = entries.select("id", "doc_id", "set_key").join(small_or_not(ids), "id", "left_semi")
    wanted = small_or_not(written(wanted))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in _slices(batches):
            sets = [shingler(t).tobytes() for t in batch.column("text").to_pylist()]
            keys = [xxhash.xxh3_128_digest(s) for s in sets]
            yield pa.RecordBatch.from_pydict(
                {"set_key": pa.array(keys, pa.binary()), "shingles": pa.array(sets, pa.binary())}
            )

    texts = docs.select("doc_id", "text").join(wanted.select("doc_id"), "doc_id", "left_semi")
    found = texts.mapInArrow(collect, "set_key binary, shingles binary").dropDuplicates(["set_key"])
    return written(found.join(wanted.select("id", "set_key"), "set_key").select("id", "shingles"))


def _fine_sketches(docs: DataFrame, entries: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, whole, fine``: larger odd sketches of some entries, of all shingles or of samples, by size."""
    kind = pa.list_(pa.int64())

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = [np.frombuffer(s.as_buffer(), _U) for s in batch.column("shingles")]
            whole = [whole_sketch(s) if len(s) <= WHOLE_SHINGLES else None for s in sets]
            fine = [
                odd_sketch(samples(s, FINE_SAMPLES), FINE_BITS) if 4 * len(s) >= 3 * WHOLE_SHINGLES else None
                for s in sets
            ]
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "whole": pa.array(whole, kind), "fine": pa.array(fine, kind)}
            )

    return written(_sets(docs, entries, ids).mapInArrow(sketch, "id long, whole array<long>, fine array<long>"))


def _confirmed(docs: DataFrame, entries: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs (a, b)`` whose full sets reach the threshold."""
    pairs = written(pairs.select("a", "b"))
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    sets = _sets(docs, entries, ids)
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("s")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("t")), "b"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            linked = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                x, y = np.frombuffer(s.as_buffer(), _U), np.frombuffer(t.as_buffer(), _U)
                common = len(x) + len(y) - len(np.union1d(x, y))
                linked.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return written(both.select("a", "b", "s", "t").mapInArrow(compare, "a long, b long"))


def _similar_size(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _close(pairs: DataFrame, light: DataFrame) -> DataFrame:
    """``a, b, estimate`` of the pairs whose sizes and odd sketches don't rule them out."""
    named = [[F.col(c).alias(f"{c}_{s}") if c != "id" else F.col(c).alias(s) for c in light.columns] for s in "ab"]
    return (
        pairs.join(light.select(*named[0]), "a")
        .join(light.select(*named[1]), "b")
        .where(_similar_size("n_shingles_a", "n_shingles_b"))
        .select("a", "b", similarity_estimate(F.col("odd_a"), F.col("odd_b")).alias("estimate"))
        .where(F.col("estimate") >= LEAST_ESTIMATE)
    )


def _fine_may_link() -> Column:
    """Whether the larger sketches let a pair of similar size through; it has one kind in common."""
    whole = whole_may_link(F.col("whole_a"), F.col("whole_b"), F.col("n_shingles_a") + F.col("n_shingles_b"))
    fine = similarity_estimate(F.col("fine_a"), F.col("fine_b"), FINE_BITS, FINE_SAMPLES) >= LEAST_FINE
    return F.coalesce(whole, fine)


def near_duplicates(docs: DataFrame, large_bucket: int = LARGE_BUCKET) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row for every row of ``docs``.

    Words stand between ASCII white space, A-Z lower-cased; a set has the distinct runs of five, or
    the whole text if it is shorter. Linked are sets with 100 * intersection >= 75 * union.
    ``component_id`` is the smallest doc_id reachable. Null, empty and blank texts have no set and
    are linked with nothing, nor are rows without doc_id; these are kept. Repeated rows of one
    doc_id count as one document; if their texts differ, each text brings its links.
    """
    return classified(docs, large_bucket).drop("set_key")


def classified(docs: DataFrame, large_bucket: int = LARGE_BUCKET) -> DataFrame:
    """``near_duplicates`` with the ``set_key`` of every row."""
    sketched = written(sketches(docs))
    entries = (
        sketched.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "odd")])
    )
    # An entry is a set of shingles. A doc_id can be the smallest of several, so each has a number.
    entries = written(entries.withColumn("id", F.monotonically_increasing_id()))
    keyed = entries.select("id", F.explode("bands").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = written(keyed.join(shared, "bucket"))
    # The hub of a bucket is the entry that shares bands with most: of copies with changes the least changed one.
    met = members.groupBy("id").agg(F.sum("size").alias("met"))
    ends = members.join(met, "id").groupBy("bucket").agg(F.max(F.struct("met", "id")).alias("hub"), F.min("id").alias("lo"))
    members = written(members.join(ends.select("bucket", F.col("hub.id").alias("hub"), "lo"), "bucket"))
    light = entries.select("id", "n_shingles", "odd")
    # First each entry with the hub it shares most bands with.
    most_shared = members.where("id != hub").groupBy("id", "hub").agg(F.count("*").alias("n"))
    first = most_shared.groupBy("id").agg(F.max(F.struct("n", "hub")).alias("best"))
    links = _confirmed(docs, entries, _close(first.select(F.col("id").alias("a"), F.col("best.hub").alias("b")), light))
    # Entries not linked by that, with the most similar of their buckets' hubs and first entries.
    linked = written(links.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    left = members.join(linked, "id", "left_anti")
    ends = left.select(F.col("id").alias("a"), F.explode(F.array("hub", "lo")).alias("b")).where("a != b").distinct()
    nearest = _close(ends, light).groupBy("a").agg(F.max(F.struct("estimate", "b")).alias("best"))
    links = written(links.unionByName(_confirmed(docs, entries, nearest.select("a", "best.b"))))
    found = components(links)
    # Then entries of different components in the buckets that still have several.
    placed = members.select("bucket", "id").join(found, "id", "left")
    placed = written(placed.withColumn("component", F.coalesce("component", "id")))
    # The largest component of a bucket needs no look inside: only the other entries are compared, with all.
    open_buckets = (
        placed.groupBy("bucket", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("components"), F.sum("n").alias("size"))
        .where("components > 1")
        .select(
            "bucket",
            F.col("most.component").alias("largest"),
            F.ceil((F.col("size") - F.col("most.n")) / large_bucket).cast("int").alias("blocks"),
        )
    )
    rest = placed.join(open_buckets, "bucket").withColumn("apart", F.col("component") != F.col("largest"))
    rest = written(rest.drop("largest"))
    fine = _fine_sketches(docs, entries, written(rest.select("id").distinct()))
    rest = rest.join(entries.select("id", "n_shingles", "bands", "odd").join(fine, "id"), "id")
    # Entries of different components meet in every bucket they share; the first of them is enough.
    earlier = F.slice("bands", F.lit(1), (F.array_position("bands", F.col("bucket")) - 1).cast("int"))
    rest = written(rest.withColumn("earlier", earlier).drop("bands"))
    facts = ("component", "apart", "n_shingles", "odd", "whole", "fine", "earlier")
    in_block = {"a": F.pmod(F.hash("id"), "blocks"), "b": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))}
    a, b = [
        rest.select("bucket", in_block[s].alias("block"), F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in facts])
        for s in "ab"
    ]
    crossing = (
        a.where("apart_a")
        .join(b, ["bucket", "block"])
        .where("component_a != component_b and (a < b or not apart_b)")
        .where(_similar_size("n_shingles_a", "n_shingles_b"))
        .where(~F.arrays_overlap("earlier_a", "earlier_b"))
        .where(similarity_estimate(F.col("odd_a"), F.col("odd_b")) >= LEAST_ESTIMATE)
        .where(_fine_may_link())
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    links = links.unionByName(_confirmed(docs, entries, crossing))
    # A doc_id with several texts holds its entries together.
    own = sketched.where("n_shingles > 0 and doc_id is not null").select("doc_id", "set_key").distinct()
    several = written(own.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    own = written(own.join(small_or_not(several), "doc_id", "left_semi"))
    own = written(entries.select("set_key", "id").join(small_or_not(own), "set_key").select("doc_id", "id"))
    firsts = own.groupBy("doc_id").agg(F.min("id").alias("first"))
    several = own.join(small_or_not(written(firsts)), "doc_id").select(F.col("id").alias("a"), F.col("first").alias("b"))
    found = components(links.unionByName(several.where("a != b")))
    placed = entries.select("set_key", "doc_id", "id").join(found, "id", "left")
    placed = written(placed.select("set_key", "doc_id", F.coalesce("component", "id").alias("component")))
    least = written(placed.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    classes = written(placed.join(small_or_not(least), "component").select("set_key", "component_id"))
    out = sketched.select("doc_id", "n_shingles", "set_key").join(small_or_not(classes), "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        "set_key",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
