"""Removal of long byte strings that occur more than once, by suffix arrays of candidate groups.

A string of ``length`` bytes is known by its anchor, the k-gram of the smallest hash in it. Equal
strings have equal anchors, so only strings around an anchor that occurs again can be repeated.
Spark groups anchors by hash; the content of one is the text that holds all its strings. A content
that occurs again is repeated throughout. Where an anchor has several contents, they are cut into
cells of strings that start near each other and so hold a common core. Equal cells are repeated
throughout, cells whose core stands once are not. The suffix array of the different cells of a core
tells which strings they share: suffixes with a common prefix of a string's length are neighbours in it.

The suffix array is built by linear grouping. Suffixes are grouped by first byte; groups are
processed in descending order. Each suffix of a group looks, along previous-smaller pointers, for
the suffix of a lower group whose known Lyndon prefix ends where it starts; those suffixes have
their prefix lengthened by the group's and move to a new group behind their old one. Once all are
done, suffixes are grouped and ordered by their longest Lyndon prefix, and the order inside each
group follows from emitting them in rising order; nothing is renamed or sorted again.

A core with more cells than one task should hold has them cut into smaller cells with longer cores, in
the end into single strings.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_or_not
from tidemark.session import written

LENGTH = 200
ANCHOR = 100
# Different cells of one core that a suffix array is built over.
CONTENTS = 48
# Strings that start within so many bytes of each other are looked at together first. Smaller cells are quarters.
CELL = 16
# Bytes hashed at once; positions inside must fit the low bits of a key.
CHUNK = 1 << 18
_PLACE = 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def suffix_array(s: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``s`` in lexicographic order, in linear time."""
    n = len(s)
    order = sorted(range(n), key=s.__getitem__)
    group, place, ends = [0] * n, [0] * n, [0] * (n + 1)
    known = [1] * (n + 1)
    start = 0
    for at, i in enumerate(order):
        if at and s[i] != s[order[at - 1]]:
            ends[start] = at
            start = at
        group[i] = start
        place[i] = at
    ends[start] = n
    previous = [-1] * n
    end = n
    while end:
        current = group[order[end - 1]]
        members = order[current:end]
        longer = []
        for i in members:
            j = i - 1
            while j >= 0 and group[j] > current:
                j = previous[j]
            previous[i] = j
            if j >= 0 and group[j] < current:
                longer.append(j)
        added = known[current]
        while longer:
            by_group: dict[int, list[int]] = {}
            for j in longer:
                by_group.setdefault(group[j], []).append(j)
            for old, moved in by_group.items():
                stop = ends[old]
                new = stop - len(moved)
                known[new] = known[old] + added
                if new == old:
                    continue
                for at, j in enumerate(moved, 1):
                    to, origin = stop - at, place[j]
                    other = order[to]
                    order[to], order[origin] = j, other
                    place[j], place[other] = to, origin
                for j in moved:
                    group[j] = new
                ends[old], ends[new] = new, stop
            # A prefix is lengthened once for each time the group's word follows again.
            following = []
            for j in longer:
                after = j + known[group[j]]
                if after < n and group[after] == current:
                    following.append(j)
            longer = following
        end = current
    out = [-1] * n
    free = list(range(n))
    done = [False] * n
    i = n
    rank = 0
    while True:
        j = i - 1
        while j >= 0 and not done[j]:
            own = group[j]
            if j + known[own] == i:
                out[free[own]] = j
                free[own] += 1
                done[j] = True
            j = previous[j]
        if rank == n:
            return out
        i = out[rank]
        rank += 1


def shared_starts(contents: list[bytes], length: int = LENGTH) -> list[list[int]]:
    """For each content the starts of its strings that also start elsewhere in the contents."""
    joined: list[int] = []
    origin: list[tuple[int, int]] = []
    for n, content in enumerate(contents):
        # A separator of its own after each, lower than any byte.
        joined += [b + len(contents) for b in content] + [n]
        origin += [(n, i) for i in range(len(content) + 1)]
    found: list[set[int]] = [set() for _ in contents]
    before, key = None, None
    for at in suffix_array(joined):
        n, i = origin[at]
        piece = contents[n][i : i + length]
        if len(piece) == length:
            if key is not None and piece == key:
                found[n].add(i)
                found[before[0]].add(before[1])
            before, key = (n, i), piece
        else:
            before, key = None, None
    return [sorted(f) for f in found]


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbouring keys, from running minima of blocks."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, _U)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    rising = np.minimum.accumulate(blocks, axis=1).ravel()
    falling = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(falling[: n - width + 1], rising[width - 1 : n])


class Anchors:
    """Anchors of a text: hash, place, and first and last start of the strings that have it."""

    def __init__(self, length: int = LENGTH, anchor: int = ANCHOR):
        self.length, self.anchor = length, anchor
        size = CHUNK + length + 1
        with np.errstate(over="ignore"):
            self.powers = np.multiply.accumulate(np.full(size, _BASE, _U)) * _U(_INVERSE)
            self.inverses = np.multiply.accumulate(np.full(size, _INVERSE, _U)) * _U(_BASE)

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        length, anchor = self.length, self.anchor
        strings = len(data) - length + 1
        if strings <= 0:
            return np.zeros(0, _U), *(np.zeros(0, np.int32) for _ in range(3))
        every = np.frombuffer(data, np.uint8)
        hashes, places, firsts = [], [], []
        for start in range(0, strings, CHUNK):
            count = min(CHUNK, strings - start)
            b = every[start : start + count + length - 1].astype(_U) + _U(1)
            sums = np.concatenate([np.zeros(1, _U), np.cumsum(b * self.powers[: len(b)], dtype=_U)])
            h = (sums[anchor:] - sums[:-anchor]) * self.inverses[: len(b) - anchor + 1]
            h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
            h ^= h >> _U(29)
            keys = (h >> _U(_PLACE) << _U(_PLACE)) | np.arange(len(h), dtype=_U)
            chosen = (_least(keys, length - anchor + 1) & _U((1 << _PLACE) - 1)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
            hashes.append(h[chosen[first]])
            places.append(chosen[first] + start)
            firsts.append(first + start)
        h, at, lo = np.concatenate(hashes), np.concatenate(places), np.concatenate(firsts)
        # The same anchor on both sides of a chunk's edge.
        new = np.concatenate([[True], at[1:] != at[:-1]])
        h, at, lo = h[new], at[new], lo[new]
        hi = np.concatenate([lo[1:] - 1, [strings - 1]])
        return h, at.astype(np.int32), lo.astype(np.int32), hi.astype(np.int32)


def _key() -> list[Column]:
    return [F.col("doc_id"), F.hash("text").alias("mark")]


def _as_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


# Anchors told apart in a task at once.
TOGETHER = 1 << 20


def _occurrences(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """``key, content, n, doc_id, mark, at``: every anchor with a hash of all its strings' text.

    Where a content stands several times in a batch, one row has their number as ``n`` and its hash as
    ``key``. The others are known to be repeated: they have n = 0 and keys of their own, so that a
    frequent anchor does not meet in one task.
    """

    def rows_of(batch: pa.RecordBatch, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, content, at, which = (np.concatenate([p[i] for p in parts]) for i in range(4))
        order = np.lexsort((content, h))
        h, content, at, which = h[order], content[order], at[order], which[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (content[1:] != content[:-1])])
        firsts = np.flatnonzero(new)
        n = np.zeros(len(h), np.int32)
        n[firsts] = np.diff(np.concatenate([firsts, [len(h)]]))
        with np.errstate(over="ignore"):
            h[~new] += (at[~new].astype(_U) + which[~new].astype(_U) + _U(1)) * _U(_BASE)
        # Rows in the order of the texts are smaller in a shuffle.
        back = np.argsort(order)
        for start in range(0, len(h), 1 << 16):
            some = back[start : start + (1 << 16)]
            taken = pa.array(which[some])
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(h[some].view(np.int64)),
                    "content": pa.array(content[some].view(np.int64)),
                    "n": pa.array(n[some]),
                    "doc_id": batch.column("doc_id").take(taken),
                    "mark": batch.column("mark").take(taken),
                    "at": pa.array(at[some]),
                }
            )

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Anchors(length, anchor)
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            parts, held = [], 0
            for start in range(0, batch.num_rows, 256):
                for i, text in enumerate(batch.column("text").slice(start, 256).to_pylist(), start):
                    data = _as_bytes(text)
                    h, place, lo, hi = find(data)
                    contents = [digest(data[a : b + length]) for a, b in zip(lo.tolist(), hi.tolist())]
                    at = _packed(*(x.astype(np.int64) for x in (place, lo, hi)))
                    parts.append((h, np.array(contents, _U), at, np.full(len(h), i, np.int64)))
                    held += len(h)
                if held >= TOGETHER:
                    yield from rows_of(batch, parts)
                    parts, held = [], 0
            if held:
                yield from rows_of(batch, parts)

    if length - anchor >= 1 << 16:
        raise ValueError("strings may be longer than anchors by at most 65,535 bytes")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.where(F.octet_length("text") >= length).select(*_key(), "text")
    return rows.mapInArrow(anchors, f"key long, content long, n int, doc_id {kind}, mark int, at long")


def _packed(place: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """First start, and the distances from it to the anchor and to the last start, as one number."""
    return lo << 32 | (place - lo) << 16 | (hi - lo)


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["mark"] == b["mark"])


def _split(
    h: int, core: int, left: bytes, right: bytes, first: int, cell: int, size: int
) -> Iterator[tuple[int, bytes, bytes, int, int]]:
    """The cells of ``size`` strings of a larger cell: ``core, left, right, first, cell`` of each.

    A cell has strings that start 0 to cell - 1 bytes before its core, and all hold the core. ``left`` and
    ``right`` are the bytes around it that belong to its strings.
    """
    for low in range(0, cell, size):
        high = min(low + size, cell)
        # Bytes of the larger cell's right side that all strings here hold.
        inner = cell - high
        if low > len(left) or inner > len(right):
            continue
        at = len(left) - low
        around = left[at:] + right[:inner]
        key = xxhash.xxh3_64_intdigest(b"%d %d %d " % (h, core, low) + around)
        start = max(0, len(left) - high + 1)
        yield key - (1 << 63), left[start:at], right[inner : cell - 1 - low], first + start, high - low


_CELL = "h long, core long, n long, doc_id {kind}, mark int, first long, cell int, left binary, right binary"


def _cells_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), kind, pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    names = ["h", "core", "n", "doc_id", "mark", "first", "cell", "left", "right"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 9, kinds)], names=names)


def _cells_of(docs: DataFrame, wanted: DataFrame, length: int, anchor: int, size: int) -> DataFrame:
    """Contents ``wanted (h, n, doc_id, mark, at)`` as cells around their anchor."""
    lists = wanted.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("h", "n", "at")).alias("items"))
    lists = small_or_not(written(lists))
    rows = docs.where(F.octet_length("text") >= length).select(*_key(), "text")
    joined = rows.join(lists, _same_row(rows, lists)).select(rows["doc_id"], rows["mark"], "text", "items")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out = []
                some = batch.slice(start, 256)
                for doc_id, mark, text, items in zip(*(some.column(c).to_pylist() for c in range(4))):
                    data = _as_bytes(text)
                    for item in items:
                        h, lo = item["h"], item["at"] >> 32
                        place, hi = lo + (item["at"] >> 16 & 0xFFFF), lo + (item["at"] & 0xFFFF)
                        left, right = data[lo:place], data[place + anchor : hi + length]
                        for core, a, b, first, cell in _split(h, 0, left, right, lo, length - anchor + 1, size):
                            out.append((h, core, item["n"], doc_id, mark, first, cell, a, b))
                yield _cells_batch(out, batch.schema.field("doc_id").type)

    return joined.mapInArrow(cut, _CELL.format(kind=docs.schema["doc_id"].dataType.simpleString()))


def _smaller(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            out = []
            for r in batch.slice(start, 4096).to_pylist():
                for core, left, right, first, cell in _split(
                    r["h"], r["core"], r["left"], r["right"], r["first"], r["cell"], size
                ):
                    out.append((r["h"], core, r["total"], r["doc_id"], r["mark"], first, cell, left, right))
            yield _cells_batch(out, batch.schema.field("doc_id").type)


def _array_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared strings of cells that occur once, from different cells in the order of their cores.

    Cells of one core differ beside it only, so it is one symbol of their suffix array.
    """
    held: list[dict] = []

    def decided() -> list[tuple]:
        contents = [(*r["left"], 256, *r["right"]) for r in held]
        out = []
        for r, found in zip(held, shared_starts(contents, held[0]["cell"])):
            if r["total"] == 1 and found:
                edges = np.flatnonzero(np.diff(found) > 1)
                runs = zip([found[0], *(found[e + 1] for e in edges)], [*(found[e] for e in edges), found[-1]])
                out += [(r["doc_id"], r["mark"], r["first"] + a, r["first"] + b) for a, b in runs]
        return out

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held and (held[0]["h"], held[0]["core"]) != (row["h"], row["core"]):
                out += decided()
                held = []
            held.append(row)
        kind = batch.schema.field("doc_id").type
        yield _ranges_batch(out, kind)
    if held:
        yield _ranges_batch(decided(), kind)


def _ranges_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = (kind, pa.int32(), pa.int64(), pa.int64())
    arrays = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "mark", "first", "last"])


def _counted(rows: DataFrame, group: list[str], content: list[str], order: list[str]) -> DataFrame:
    """Adds ``total``, the sum of ``n`` over rows of equal content; ``one``, true for one row of them;
    ``kinds``, the contents of the group; ``alone``, whether one of them has a total of 1."""
    same = Window.partitionBy(*group, *content)
    whole = Window.partitionBy(*group)
    rows = rows.repartition(*group).withColumn("one", F.row_number().over(same.orderBy(*order)) == 1)
    every = same.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("total", F.sum("n").over(every))
    kinds = F.sum(F.col("one").cast("long")).over(whole)
    return rows.withColumns({"kinds": kinds, "alone": F.max(F.col("total") == 1).over(whole)})


def repeated_ranges(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, contents: int = CONTENTS
) -> DataFrame:
    """``doc_id, mark, first, last``: starts of repeated strings, as ranges.

    ``mark`` is a hash of the text, as rows may share a doc_id.
    """
    everything = _counted(_occurrences(docs, length, anchor), ["key"], ["content"], ["doc_id", "mark", "at"])
    # A content that occurs again needs no look; it is evidence for contents that occur once.
    looked_at = F.col("one") & (F.col("kinds") > 1) & F.col("alone")
    held = everything.where((F.col("total") != 1) | looked_at).select(
        "doc_id", "mark", "at", F.when(looked_at, F.col("key")).alias("h"), F.col("total").alias("n")
    )
    held = written(held)
    first = F.shiftright("at", 32)
    found = held.where("n != 1").select(
        "doc_id", "mark", first.alias("first"), (first + F.col("at").bitwiseAND(0xFFFF)).alias("last")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, mark int, first long, last long"
    cells = _cells_of(docs, held.where("h is not null"), length, anchor, CELL)
    size = CELL
    while True:
        # Equal cells recur as a whole. Where a core has different ones, they are looked at further.
        cells = _counted(cells, ["h", "core"], ["left", "right"], ["doc_id", "mark", "first"])
        differ = F.col("one") & (F.col("kinds") > 1) & F.col("alone")
        cells = written(cells.where(differ | (F.col("total") > 1) & (F.col("n") == 1)).withColumn("differ", differ))
        last = F.col("first") + F.length("left") + F.length("right") - F.col("cell") + 1
        again = cells.where("total > 1 and n = 1").select("doc_id", "mark", "first", last.alias("last"))
        # A core here has a bounded number of different cells, so its rows fit the task that holds them.
        few = cells.where(F.col("differ") & (F.col("kinds") <= contents))
        few = few.repartition("h", "core").sortWithinPartitions("h", "core")
        found = found.unionByName(again).unionByName(few.mapInArrow(_array_ranges, schema))
        many = cells.where(F.col("differ") & (F.col("kinds") > contents))
        if size == 1 or many.isEmpty():
            return found
        # More of them share less: smaller cells have longer cores. A cell of one string has nothing beside it.
        size = max(1, size // 4)
        cells = many.mapInArrow(lambda batches, size=size: _smaller(batches, size), _CELL.format(kind=kind))


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(r) for r in out]


def without_repeats(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, contents: int = CONTENTS
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, spans`` for every row.

    Removed are the bytes of all strings of ``length`` bytes that also start elsewhere in the
    texts as they came in, in the same document or another. ``kept`` is what is left, as bytes, and
    ``spans`` the removed runs as (start, end). Null counts as empty; texts shorter than ``length``
    lose nothing. Repeated rows repeat each other's strings, so they lose all of them.
    """
    ranges = repeated_ranges(docs, length, anchor, contents)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"start": a, "end": b} for a, b in _merged([(r["first"], r["last"] + length) for r in ranges])]
                for ranges in batch.column("ranges").to_pylist()
            ]
            kept = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), kept], names=["doc_id", "mark", "spans"])

    lists = ranges.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    spans = lists.mapInArrow(merge, f"doc_id {kind}, mark int, spans array<struct<start: long, end: long>>")
    spans = small_or_not(written(spans))
    rows = docs.select(*_key(), "text")
    joined = rows.join(spans, _same_row(rows, spans), "left").select(rows["doc_id"], "text", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, counts, kept = [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data = _as_bytes(text)
                at, left = 0, []
                for span in spans or ():
                    left.append(data[at : span["start"]])
                    at = span["end"]
                left.append(data[at:])
                kept.append(b"".join(left))
                sizes.append(len(data))
                removed.append(len(data) - len(kept[-1]))
                counts.append(len(spans or ()))
            arrays = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(counts, pa.int64()),
                "kept": pa.array(kept, pa.binary()),
                "spans": batch.column("spans"),
            }
            yield pa.RecordBatch.from_pydict(arrays)

    schema = (
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, "
        "spans array<struct<start: long, end: long>>"
    )
    return joined.mapInArrow(remove, schema)
