"""Token counts by a linear longest-match automaton.

Greedy word pieces: from the left, a word gives its longest prefix in the vocabulary, again and
again. The automaton is a trie of the vocabulary. Where a node has no child for the next byte, its
failure link leads to the node of what is left after the pieces that are certain by then, and the
number of those pieces is stored beside the link. So a word is read once, byte by byte, and its
count is a sum of stored numbers; no piece is ever built.

Words are counted where their text is read. Frequent words are remembered up to a bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REMEMBERED = 400_000
# A vocabulary is broadcast, so its size is checked: bytes of all pieces.
VOCABULARY_BYTES = 64 << 20


class LongestMatch:
    """Counts greedy pieces. ``unknown`` is the count of a word that can't be cut into pieces."""

    def __init__(self, vocabulary: Iterable[bytes], unknown: int = 1):
        self.unknown = unknown
        self.children: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in vocabulary:
            at = 0
            for byte in piece:
                following = self.children[at].get(byte)
                if following is None:
                    following = self.children[at][byte] = len(self.children)
                    self.children.append({})
                    ends.append(False)
                at = following
            ends[at] = at != 0
        # Breadth first: a link never leads deeper, so those it is made from are there.
        self.link = [-1] * len(ends)
        self.popped = [0] * len(ends)
        level = [0]
        while level:
            below = []
            for node in level:
                for byte, child in self.children[node].items():
                    below.append(child)
                    if ends[child]:
                        self.link[child], self.popped[child] = 0, 1
                        continue
                    to, count = self.link[node], self.popped[node]
                    while to >= 0 and byte not in self.children[to]:
                        count += self.popped[to]
                        to = self.link[to]
                    if to >= 0:
                        self.link[child], self.popped[child] = self.children[to][byte], count
            level = below

    def count(self, word: bytes) -> int:
        children, link, popped = self.children, self.link, self.popped
        at = count = 0
        for byte in word:
            following = children[at].get(byte)
            while following is None:
                count += popped[at]
                at = link[at]
                if at < 0:
                    return self.unknown
                following = children[at].get(byte)
            at = following
        while at > 0:
            count += popped[at]
            at = link[at]
        return count if at == 0 else self.unknown


def token_counts(docs: DataFrame, vocabulary: list[bytes], start: bytes = b" ") -> DataFrame:
    """``doc_id, n_bytes, n_words, n_tokens`` of every whole text.

    Words are what stands between ASCII white space; ``start`` is put before each, as the
    vocabulary marks the start of a word. Null and empty texts have zero of all. Repeated rows are
    counted each; other columns play no part.
    """
    if sum(map(len, vocabulary)) > VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to be broadcast")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = LongestMatch(shared.value), {}
        for batch in batches:
            sizes, words_in, tokens_in = [], [], []
            for text in batch.column("text").to_pylist():
                data = (text or "").encode("utf-8", "surrogatepass")
                words = data.split()
                tokens = 0
                for word in words:
                    n = known.get(word)
                    if n is None:
                        n = automaton.count(start + word)
                        if len(known) < REMEMBERED:
                            known[word] = n
                    tokens += n
                sizes.append(len(data))
                words_in.append(len(words))
                tokens_in.append(tokens)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(sizes, pa.int64()),
                    "n_words": pa.array(words_in, pa.int64()),
                    "n_tokens": pa.array(tokens_in, pa.int64()),
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_words long, n_tokens long")
