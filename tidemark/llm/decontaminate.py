"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item may occur in a document with up to k edits. Cut into k + 1 pieces, at least one
piece then occurs unchanged. One automaton over the pieces of all items finds these hits; each
says where the item would lie. There Myers' bit-parallel distance, one machine step per character
for the whole item, tells whether it lies there within the budget.

Items are broadcast in chunks of bounded size, one pass over the documents per chunk. Each document
is searched whole where it is read; nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

# Edits allowed per character of an item.
BUDGET = 0.08
# Shorter items, in normalised characters, would be found in clean texts with edits or inside words:
# they are searched without edits and between word boundaries.
SHORTEST = 32
# Characters of items in one broadcast.
CHUNK_CHARS = 2_000_000


def normalise(text: str) -> str:
    """Lower case with single spaces: what benchmark and documents are compared in."""
    return " ".join(text.lower().split())


class Pattern:
    """An item with its error budget, pieces, and bit masks per character."""

    def __init__(self, text: str, budget: float = BUDGET):
        self.text = text
        self.length = len(text)
        self.budget = math.floor(budget * self.length) if self.length >= SHORTEST else 0
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def pieces(self) -> Iterator[tuple[int, str]]:
        """Budget plus one pieces of nearly equal length, with their offsets."""
        n = self.budget + 1
        for i in range(n):
            start, end = i * self.length // n, (i + 1) * self.length // n
            yield start, self.text[start:end]

    def best_in(self, window: str) -> tuple[int, int]:
        """Fewest edits between the item and a stretch of the window, and where the first such ends."""
        every = (1 << self.length) - 1
        last = 1 << (self.length - 1)
        more, less, score = every, 0, self.length
        best, best_end = score, 0
        masks = self.masks
        for i, c in enumerate(window):
            eq = masks.get(c, 0)
            down = eq | less
            across = (((eq & more) + more) ^ more) | eq
            up = less | (every & ~(across | more))
            fall = more & across
            if up & last:
                score += 1
            elif fall & last:
                score -= 1
            up = (up << 1) & every
            more = ((fall << 1) & every) | (every & ~(down | up))
            less = up & down
            if score < best:
                best, best_end = score, i + 1
        return best, best_end


def between_words(text: str, start: int, end: int) -> bool:
    """Whether neither end of the stretch cuts a run of letters and digits."""
    return not any(text[at - 1].isalnum() and text[at].isalnum() for at in (start, end) if 0 < at < len(text))


class Matcher:
    """Finds every item of one chunk in a text."""

    def __init__(self, items: list[tuple[int, str]], budget: float):
        import ahocorasick

        self.patterns = [Pattern(text, budget) for _, text in items]
        where: dict[str, list[tuple[int, int]]] = {}
        for n, pattern in enumerate(self.patterns):
            for offset, piece in pattern.pieces():
                where.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), tuple(places)))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(item number, fewest edits, occurrences, end of the best)`` in normalised characters."""
        if self.empty:
            return []
        starts: dict[int, set[int]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for n, offset in places:
                starts.setdefault(n, set()).add(end - length + 1 - offset)
        found = []
        for n, at in starts.items():
            pattern = self.patterns[n]
            if pattern.length < SHORTEST:
                at = {start for start in at if between_words(text, start, start + pattern.length)}
            k, reach = pattern.budget, pattern.length + pattern.budget
            # Hits whose windows overlap are looked at together.
            windows: list[list[int]] = []
            for start in sorted(at):
                if windows and start - k <= windows[-1][1]:
                    windows[-1][1] = start + reach
                else:
                    windows.append([start - k, start + reach])
            best, times, where = k + 1, 0, 0
            for low, high in windows:
                low = max(0, low)
                edits, end = pattern.best_in(text[low : max(low, high)])
                if edits <= k:
                    times += 1
                    if edits < best:
                        best, where = edits, low + end
            if times:
                found.append((n, best, times, where))
        return found


def contaminated(
    docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """``doc_id, item_id, edits, occurrences, ends_at``: every item found in a whole document.

    ``edits`` is the fewest over its occurrences, ``occurrences`` counts the separate places,
    ``ends_at`` is where the best of them ends in the normalised text. Null texts and items hold
    nothing; items under 32 normalised characters are found without edits and as whole words only.
    Items with equal texts are found each; repeated rows of documents or items give repeated
    results.
    """
    spark = docs.sparkSession
    kinds = [docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, edits int, occurrences int, ends_at long"
    items = benchmark.select("item_id", "text").where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(chars / chunk_chars))
    rows = docs.select("doc_id", "text").where("text is not null")
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)

    def one_pass(chunk: int) -> DataFrame:
        got = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == chunk).collect()
        texts = [(r["item_id"], normalise(r["text"])) for r in got]
        texts = [(i, t) for i, t in texts if t]
        shared = spark.sparkContext.broadcast(texts)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher, known = Matcher(shared.value, budget), shared.value
            for batch in batches:
                out: dict[str, list] = {n: [] for n in ("doc_id", "item_id", "edits", "occurrences", "ends_at")}
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    for n, edits, times, end in matcher.find(normalise(text)):
                        for name, value in zip(out, (doc_id, known[n][0], edits, times, end)):
                            out[name].append(value)
                arrays = [
                    pa.array(out["doc_id"], batch.schema.field("doc_id").type),
                    pa.array(out["item_id"], item_type),
                    pa.array(out["edits"], pa.int32()),
                    pa.array(out["occurrences"], pa.int32()),
                    pa.array(out["ends_at"], pa.int64()),
                ]
                if out["doc_id"]:
                    yield pa.RecordBatch.from_arrays(arrays, names=list(out))

        return rows.mapInArrow(search, schema)

    return reduce(DataFrame.unionByName, [one_pass(c) for c in range(chunks)])
