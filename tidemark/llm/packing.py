"""Packing token sequences with a controlled mixture.

Every source is a queue of documents in reading order. Each window is filled by deficit
round-robin: a source earns its share of the window, sends whole tokens, and carries what it is
owed into the next window. As the credit is a running one, the tokens a source has sent after w
windows depend on w alone. So every task works out any window by itself, with the deficits of all
windows before it, wherever the partitions were cut; nothing is passed along between tasks.

With the default targets, the sources' own shares, all queues end together and every token is
placed. With other targets a queue may run dry; from there on the rest share its part.

Token counts per source and reading task are the only thing that is shuffled.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_or_not
from tidemark.session import written

SEQUENCE = 1024
# Queues: sources beyond the largest share queues by hash, so a task's table of them is bounded.
QUEUES = 1_024
# Units of text remembered in a task, of each kind. Others are encoded each time they occur.
REMEMBERED = 400_000
# Documents cut at once.
CUT_ROWS = 512

END_ID = 0
_ODD_SPACE = re.compile(r"\s\s|[\x1c-\x1f\x85]|<\|")


class Remembered(dict):
    """Ids of units by their text, worked out where they are met first; ``lead`` stands before each."""

    def __init__(self, encode: Callable[[str], bytes], lead: str = ""):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, unit: str) -> bytes:
        ids = self.encode(self.lead + unit)
        if len(self) < REMEMBERED:
            self[unit] = ids
        return ids


class Encoder:
    """Ids of whole texts, equal to those of the tokenizer file, with a memory of frequent words.

    The byte-level pre-tokenizer never joins a space to what stands before it, nor text across a
    line end. A text without runs of white space therefore splits before each space and around
    each line end into units with ids of their own. Other texts, and those with anything like a
    special token, are encoded whole by the tokenizer.
    """

    def __init__(self, path: str, ranks_path: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        words = self._ranks(ranks_path) if ranks_path else self._whole
        self.line_end = self._whole("\n")
        # Units that begin a line, and the others, which follow a space.
        self.first, self.spaced = Remembered(words), Remembered(words, " ")

    @staticmethod
    def _ranks(path: str):
        """The same vocabulary as ranks: faster for the single units, with equal ids."""
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encode = tiktoken.Encoding(
            "units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        return lambda unit: np.array(encode(unit), "<u2").tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 16-bit numbers."""
        if _ODD_SPACE.search(text):
            return self._whole(text)
        out = []
        for line in text.split("\n"):
            units = iter(line.split(" "))
            out += (self.line_end, self.first[next(units)])
            out += map(self.spaced.__getitem__, units)
        # The first line has no line end before it.
        out[0] = b""
        return b"".join(out)


def encoded(docs: DataFrame, tokenizer: str, ranks: str | None = None, queues: int = QUEUES) -> DataFrame:
    """Written table ``doc_id, queue, part, before, n, ids``: each document's ids with the end id.

    ``before`` counts the tokens of its queue earlier in the same reading task.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("source", F.lit("")).alias("source"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks)
        sent: dict[str, int] = {}
        end = np.array([END_ID], "<u2").tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                some = batch.slice(start, 512)
                ids = [encoder(t) + end for t in some.column("text").to_pylist()]
                counts = [len(i) // 2 for i in ids]
                before = []
                for q, n in zip(some.column("source").to_pylist(), counts):
                    before.append(sent.get(q, 0))
                    sent[q] = before[-1] + n
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": some.column("doc_id"),
                        "source": some.column("source"),
                        "before": pa.array(before, pa.int64()),
                        "n": pa.array(counts, pa.int64()),
                        "ids": pa.array(ids, pa.binary()),
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(
        rows.mapInArrow(encode, f"doc_id {kind}, source string, before long, n long, ids binary").withColumn(
            "part", F.spark_partition_id()
        )
    )


class Mixture:
    """How many tokens each queue has sent after any number of windows.

    Queue s with T tokens and weight p sends token j when the common clock reaches (j + 1/2) / p,
    and a window closes when enough tokens were sent. That is deficit round-robin with a quantum
    of one token: no queue is ever a whole token off what it is owed, plus one from closing a
    window. Queues that have run dry stand still, so the rest share their part.
    """

    def __init__(self, totals: np.ndarray, weights: np.ndarray, window: int):
        self.totals = totals.astype(np.int64)
        self.rates = weights / weights.sum()
        self.window = window
        self.all = int(self.totals.sum())
        self.windows = -(-self.all // window)

    def _sent(self, clock: np.ndarray) -> np.ndarray:
        return np.minimum(np.floor(clock[:, None] * self.rates[None, :] + 0.5).astype(np.int64), self.totals)

    def after(self, windows: np.ndarray) -> np.ndarray:
        """Tokens sent by each queue (columns) after each number of windows (rows)."""
        goal = np.minimum(windows.astype(np.int64) * self.window, self.all)
        low = np.zeros(len(goal))
        high = np.full(len(goal), float(np.max((self.totals + 1) / self.rates)))
        for _ in range(200):
            mid = (low + high) / 2
            if np.all((mid <= low) | (mid >= high)):
                break
            over = self._sent(mid).sum(1) > goal
            high, low = np.where(over, mid, high), np.where(over, low, mid)
        sent = self._sent(low)
        # Tokens due at the same instant go out in the order of the queues.
        due = self._sent(high) - sent
        due[goal == self.all] = (self.totals - sent)[goal == self.all]
        owed = (goal - sent.sum(1))[:, None]
        ahead = np.cumsum(due, axis=1) - due
        return sent + np.clip(owed - ahead, 0, due)


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    sequence: int = SEQUENCE,
    targets: Mapping[str, float] | None = None,
    queues: int = QUEUES,
) -> DataFrame:
    """Pieces of documents with their places: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source, ids``.

    A document's ids are those of its text (null: none) and the end id; it is cut wherever a
    window's share of its source ends. Each sequence of ``sequence`` tokens is one window; only
    the last one can be short. ``targets`` are relative weights by source; a source not named
    there, like all of them by default, weighs what its tokens are of all. Null sources are the
    source "". Repeated rows are packed each; an empty table gives no rows. ``ids`` are
    little-endian unsigned 16-bit numbers.
    """
    table = encoded(docs, tokenizer, ranks)
    parts = written(table.groupBy("source", "part").agg(F.sum("n").alias("n")))
    totals = parts.groupBy("source").agg(F.sum("n").alias("n"))
    largest = totals.orderBy(F.col("n").desc(), "source").limit(queues - 1)
    named = [r["source"] for r in largest.collect()]
    # The largest sources have queues of their own, the others share one.
    queue = F.coalesce(F.array_position(F.array(*map(F.lit, named)), F.col("source")), F.lit(0)).cast("int")
    if not named:
        queue = F.lit(0)
    before = Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("queue", queue).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sums = {r["queue"]: r["n"] for r in starts.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    present = sorted(sums)
    counts = np.array([sums[q] for q in present] or [0], np.int64)
    shares = counts / max(1, counts.sum())
    weights = np.array([(targets or {}).get(named[q - 1] if q else None, s) for q, s in zip(present, shares)] or [1.0])
    if (weights <= 0).any():
        raise ValueError("target weights must be positive")
    at = {q: i for i, q in enumerate(present)}
    firsts = small_or_not(written(starts.select("source", "part", "queue", "first")))
    placed = table.join(firsts, ["source", "part"]).select(
        "doc_id", "source", "queue", (F.col("first") + F.col("before")).alias("first"), "n", "ids"
    )
    shared = docs.sparkSession.sparkContext.broadcast((at, counts, weights))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "source string, ids binary"
    )
    return placed.mapInArrow(lambda batches: _cut(batches, shared.value, sequence), schema)


def _cut(batches: Iterator[pa.RecordBatch], shared: tuple, window: int) -> Iterator[pa.RecordBatch]:
    at, counts, weights = shared
    mixture = Mixture(counts, weights, window)
    # States of neighbouring windows, worked out a stretch at a time.
    stretch = 256
    memory: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def states(block: int) -> tuple[np.ndarray, np.ndarray]:
        """What the queues have sent after each window of a stretch, from its start to its end, and
        the tokens that stand before each queue's in its windows."""
        if block not in memory:
            if len(memory) >= 64:
                memory.pop(next(iter(memory)))
            first = block * stretch
            sent = mixture.after(np.arange(first, min(first + stretch, mixture.windows) + 1))
            shares = np.diff(sent, axis=0)
            # Queue by queue in memory, as a document looks at one.
            memory[block] = np.asfortranarray(sent), np.asfortranarray(np.cumsum(shares, axis=1) - shares)
        return memory[block]

    def window_of(token: int, q: int) -> int:
        """The window that the queue's token goes to: a guess by share, then bisection over stretches."""
        low, high = 0, (mixture.windows - 1) // stretch
        block = min(high, int(token / max(1, counts[q]) * mixture.windows) // stretch)
        tries = 0
        while True:
            sent = states(block)[0][:, q]
            if token < sent[0]:
                high, near = block - 1, block - 1
            elif token >= sent[-1]:
                low, near = block + 1, block + 1
            else:
                return block * stretch + int(np.searchsorted(sent, token, side="right")) - 1
            # Neighbours first, as the guess is seldom far off.
            tries += 1
            block = near if tries < 3 else (low + high) // 2

    def pieces(token: int, n: int, q: int) -> tuple[list[np.ndarray], ...]:
        """Windows, ends (from ``token``) and offsets of the n tokens of a queue that begin at ``token``."""
        w, done, found = window_of(token, q), 0, ([], [], [])
        while done < n:
            block, i = divmod(w, stretch)
            sent, ahead = states(block)
            own = sent[i:, q]
            last = min(len(own) - 1, int(np.searchsorted(own, token + n, side="left")))
            ends = np.minimum(own[1 : last + 1] - token, n)
            # Where the queue's tokens of a window begin: after those of the queues before it.
            begins = ahead[i : i + last, q].copy()
            begins[0] += max(0, token + done - int(own[0]))
            some = np.flatnonzero(np.diff(ends, prepend=done))
            for table, values in zip(found, (w + some, ends[some], begins[some])):
                table.append(values)
            w, done = (block + 1) * stretch, int(ends[-1])
        return found

    for batch in batches:
        for start in range(0, batch.num_rows, CUT_ROWS):
            yield _cut_rows(batch.slice(start, CUT_ROWS), at, pieces)


def _cut_rows(batch: pa.RecordBatch, at: dict[int, int], pieces) -> pa.RecordBatch:
    """The pieces of a few documents. As they follow each other, their ids are those of the documents."""
    texts = batch.column("ids").to_pylist()
    counts = batch.column("n").to_numpy()
    found: tuple[list[np.ndarray], ...] = ([], [], [])
    per_row, sums = np.zeros(len(texts), np.int64), []
    for row, (q, token, n, ids) in enumerate(
        zip(batch.column("queue").to_pylist(), batch.column("first").to_pylist(), counts.tolist(), texts)
    ):
        got = pieces(token, n, at[q])
        for table, values in zip(found, got):
            table += values
        wide = memoryview(np.frombuffer(ids, "<u2").astype("<u4").tobytes())
        begin = 0
        for ends in got[1]:
            for end in (4 * ends).tolist():
                sums.append(zlib.crc32(wide[begin:end]))
                begin = end
            per_row[row] += len(ends)
    windows, ends, offsets = (np.concatenate(t) if t else np.zeros(0, np.int64) for t in found)
    rows = np.repeat(np.arange(len(texts)), per_row)
    starts = np.zeros(len(ends), np.int64)
    starts[1:] = np.where(rows[1:] == rows[:-1], ends[:-1], 0)
    lengths = ends - starts
    cuts = np.concatenate([[0], np.cumsum(lengths)]) * 2
    ids = pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(b"".join(texts))]
    )
    taken = pa.array(rows)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch.column("doc_id").take(taken),
            "start": pa.array(starts),
            "length": pa.array(lengths),
            "ids_crc32": pa.array(sums, pa.int64()),
            "doc_tokens": pa.array(counts[rows]),
            "sequence_id": pa.array(windows),
            "offset": pa.array(offsets),
            "source": batch.column("source").take(taken),
            "ids": ids.cast(pa.binary()),
        }
    )
