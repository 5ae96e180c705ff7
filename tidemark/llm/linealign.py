"""Line dedup by aligning overlapping documents.

Documents are found to overlap through shared lines. A rare line links all documents that have it;
a frequent one links each to its first holder, so links grow with the lines and no line makes all
pairs. Each shortest run of neighbouring lines with enough words links a document to the run's first
holder as well; every block that an earlier document holds is made of such runs. A linked pair is
aligned by patience diff: lines that occur once in either document are matched along their longest
common order, matches grow over equal neighbours, and the gaps between are aligned the same way.
Aligned common blocks with enough words are deleted from the later
document; blank lines neither break nor make a block.

Only hashes of lines are shuffled and aligned; texts are read again where the blocks are cut out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_or_not
from tidemark.session import written

# Documents with a line, up to which it counts as rare and links every pair of them.
RARE = 8
# Words an aligned block must have to be deleted: what many documents say briefly is left alone.
LEAST_WORDS = 20


def _longest_rise(values: Sequence[int]) -> list[int]:
    """Positions of a longest strictly rising subsequence, by patience piles."""
    tops: list[int] = []
    at: list[int] = []
    behind: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        behind.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = behind[i]
    return out[::-1]


def patience_matches(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of aligned positions, rising in both."""
    matched: list[tuple[int, int]] = []
    open_ranges = [(0, len(a), 0, len(b))]
    while open_ranges:
        a0, a1, b0, b1 = open_ranges.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        counts_a, counts_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        in_b = {v: i for i, v in enumerate(b[b0:b1], b0) if counts_b[v] == 1}
        single = [(i, in_b[v]) for i, v in enumerate(a[a0:a1], a0) if counts_a[v] == 1 and v in in_b]
        if not single:
            continue
        at_a, at_b = a0, b0
        for i, j in [*(single[k] for k in _longest_rise([j for _, j in single])), (a1, b1)]:
            # A gap before a match grows the match backwards when it is worked on.
            open_ranges.append((at_a, i, at_b, j))
            if i < a1:
                matched.append((i, j))
            at_a, at_b = i + 1, j + 1
    return sorted(matched)


def common_blocks(a: Sequence[int], b: Sequence[int], words: Sequence[int], least: int) -> list[tuple[int, int]]:
    """Ranges of lines of ``b``, aligned without a gap in either text, with ``least`` words or more.

    Blank lines, 0, are no gaps: those of ``b`` inside a block go with it, and those at its ends as
    far as ``a`` has them too.
    """
    at_a, at_b = ([i for i, line in enumerate(lines) if line] for lines in (a, b))
    blocks: list[list] = []
    last = None
    for i, j in patience_matches([a[i] for i in at_a], [b[j] for j in at_b]):
        if last == (i - 1, j - 1):
            blocks[-1][1:] = i, j
        else:
            blocks.append([(i, j), i, j])
        last = (i, j)
    # Bounds of the blank lines before the first and after the last line.
    at_a, at_b = [-1, *at_a, len(a)], [-1, *at_b, len(b)]
    ranges = []
    for (i, j), k, m in blocks:
        before = min(at_a[i + 1] - at_a[i], at_b[j + 1] - at_b[j]) - 1
        after = min(at_a[k + 2] - at_a[k + 1], at_b[m + 2] - at_b[m + 1]) - 1
        ranges.append((at_b[j + 1] - before, at_b[m + 1] + 1 + after))
    return [(s, e) for s, e in ranges if sum(words[s:e]) >= least]


def _key() -> list[Column]:
    return [F.col("doc_id"), F.hash("text").alias("mark")]


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, lines, words``: a hash and a word count for each line of a text.

    Lines are compared without white space at their ends and with single spaces inside; blank ones
    are 0.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            lines, counts = [], []
            for text in batch.column("text").to_pylist():
                parts = [line.split() for line in text.split("\n")]
                hashes = [digest(" ".join(p).encode("utf-8", "surrogatepass")) if p else 0 for p in parts]
                lines.append(np.array(hashes, np.uint64).view(np.int64))
                counts.append([len(p) for p in parts])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "mark": batch.column("mark"),
                    "lines": pa.array(lines, pa.list_(pa.int64())),
                    "words": pa.array(counts, pa.list_(pa.int32())),
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.where("doc_id is not null and text is not null").select(*_key(), "text")
    return rows.mapInArrow(split, f"doc_id {kind}, mark int, lines array<long>, words array<int>")


def shortest_runs(lines: Sequence[int], words: Sequence[int], least: int) -> set[bytes]:
    """Runs of two or more lines with ``least`` words that lose them without their last or first line.

    Blank lines are passed over. A line of any longer run is in a shortest run within it: one that can't
    be cut at either end without losing the line or the words ends, or starts, as short as it can.
    """
    lines, words = np.asarray(lines, np.int64), np.asarray(words, np.int64)
    lines, words = lines[words > 0], words[words > 0]
    sums = np.concatenate([[0], np.cumsum(words)])
    ends = np.searchsorted(sums, sums[:-1] + least)
    starts = np.searchsorted(sums, sums[1:] - least, "right") - 1
    spans = {(s, e) for s, e in enumerate(ends.tolist()) if e < len(sums)}
    spans |= {(s, e) for e, s in enumerate(starts.tolist(), 1) if s >= 0}
    return {lines[s:e].tobytes() for s, e in spans if e - s > 1}


def _run_links(lines: DataFrame, least_words: int) -> DataFrame:
    """``earlier, later``: each document with the first holder of each of its shortest runs."""
    kind = lines.schema["doc_id"].dataType.simpleString()

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, (own, words) in enumerate(zip(batch.column("lines").to_pylist(), batch.column("words").to_pylist())):
                digests = [xxhash.xxh3_64_intdigest(run) for run in shortest_runs(own, words, least_words)]
                rows += [i] * len(digests)
                found += digests
            ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "run"])

    held = written(lines.select("doc_id", "lines", "words").mapInArrow(runs, f"doc_id {kind}, run long"))
    firsts = held.groupBy("run").agg(F.min("doc_id").alias("earlier"), F.max("doc_id").alias("last"))
    firsts = small_or_not(written(firsts.where("earlier != last").select("run", "earlier")))
    links = held.join(firsts, "run").where("doc_id != earlier")
    return links.select("earlier", F.col("doc_id").alias("later")).distinct()


def linked_pairs(lines: DataFrame, least_words: int = LEAST_WORDS, rare: int = RARE) -> DataFrame:
    """``earlier, later``: ids that share lines of ``least_words`` words in all, through the links of each.

    A single line with as many words links its holders here, a run of shorter ones in ``_run_links``.
    """
    spread = (
        lines.select("doc_id", F.explode(F.arrays_zip("lines", "words")).alias("l"))
        .select("doc_id", "l.*")
        .where("words > 0")
        .groupBy("lines", "doc_id")
        .agg(F.sum("words").cast("long").alias("words"))
    )
    spread = written(spread)
    holders = spread.groupBy("lines").agg(F.count("*").alias("holders"), F.min("doc_id").alias("first")).where("holders > 1")
    held = written(spread.join(holders, "lines"))
    firsts = held.where("doc_id != first").select("lines", F.col("first").alias("earlier"), F.col("doc_id").alias("later"), "words")
    # Groups of at most `rare` ids.
    among = held.where(F.col("holders") <= rare)
    others = among.groupBy("lines").agg(F.collect_list("doc_id").alias("ids"))
    rest = (
        among.join(others, "lines")
        .select("lines", F.explode("ids").alias("earlier"), F.col("doc_id").alias("later"), "words", "first")
        .where("earlier < later and earlier != first")
        .drop("first")
    )
    links = firsts.unionByName(rest).groupBy("earlier", "later").agg(F.sum("words").alias("words"))
    links = links.where(F.col("words") >= least_words).select("earlier", "later")
    return links.unionByName(_run_links(lines, least_words)).distinct()


def repeated_blocks(docs: DataFrame, least_words: int = LEAST_WORDS, rare: int = RARE) -> DataFrame:
    """``doc_id, mark, blocks``: ranges of lines to delete, as (start, end); they may overlap.

    ``mark`` is a hash of the text, as rows may share a doc_id.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    lines = written(_lines(docs).dropDuplicates(["doc_id", "mark"]))
    pairs = written(linked_pairs(lines, least_words, rare))
    # The later side has few pairs to each id; a first holder's many pairs are split by the join.
    later = lines.select(F.col("doc_id").alias("later"), "mark", F.col("lines").alias("b"), "words")
    earlier = lines.select(F.col("doc_id").alias("earlier"), F.col("lines").alias("a"))
    both = pairs.join(later, "later").join(earlier, "earlier").select("later", "mark", "a", "b", "words")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"start": s, "end": e} for s, e in common_blocks(a, b, w, least_words)]
                for a, b, w in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "words")))
            ]
            blocks = pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), blocks], names=["doc_id", "mark", "blocks"])

    block = "struct<start: int, end: int>"
    aligned = both.mapInArrow(align, f"doc_id {kind}, mark int, blocks array<{block}>").where(F.size("blocks") > 0)
    different = aligned.select("doc_id", "mark", F.explode("blocks").alias("block")).distinct()
    return different.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list("block")).alias("blocks"))


def without_blocks(docs: DataFrame, least_words: int = LEAST_WORDS, rare: int = RARE) -> DataFrame:
    """All columns of ``docs`` with the blocks cut from ``text``, then ``_lines`` and ``_removed``.

    ``_lines`` counts the lines of the whole text, ``_removed`` those deleted. Of two documents the
    one with the larger doc_id is the later; both are judged as they came in. Null texts and ids
    keep their rows as they are. Repeated rows of one doc_id are one document: they lose the same
    lines and never those they share with each other only.
    """
    blocks = small_or_not(written(repeated_blocks(docs, least_words, rare)))
    blocks = blocks.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("blocks").alias("_blocks"))
    joined = docs.join(blocks, (F.col("doc_id") == F.col("_id")) & (F.hash("text") == F.col("_mark")), "left")
    joined = joined.drop("_id", "_mark")
    at = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1_024):
                some = batch.slice(start, 1_024)
                texts, totals, removed = [], [], []
                for text, found in zip(some.column(at).to_pylist(), some.column(some.num_columns - 1).to_pylist()):
                    lines = [] if text is None else text.split("\n")
                    gone = {i for r in found or () for i in range(r["start"], r["end"])}
                    kept = "\n".join(line for i, line in enumerate(lines) if i not in gone)
                    texts.append(text if not gone else kept)
                    totals.append(len(lines))
                    removed.append(len(gone))
                arrays = [*some.columns[:-1], pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
                arrays[at] = pa.array(texts, some.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(arrays, names=[*some.schema.names[:-1], "_lines", "_removed"])

    schema = docs.select("*", F.lit(0).cast("long").alias("_lines"), F.lit(0).cast("long").alias("_removed")).schema
    return joined.mapInArrow(cut, schema)
