"""Token ids in Arrow stream files of equal-length sequences, for zero-copy random access.

Documents are dealt by ranges of their order, encoded, and written one after the other into files of
bounded size. A file is an Arrow stream of record batches with two columns of fixed-size lists:
``ids`` (uint16 if the vocabulary fits, else uint32) and ``mask`` (bits, true where a token is). All
batches but the last hold the same number of sequences, so all take the same number of bytes: the
place of any sequence follows from its number, and a memory map gives it without a copy. A second
stream beside it lists the documents: doc_id, start (in the file) and n_tokens.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written

END_ID = 1
LENGTH = 1024
# Sequences of a record batch: with 1,024 ids of 2 bytes and the mask, 0.6 MB.
BATCH_SEQUENCES = 256
# A file ends with the document that takes it over so many tokens.
FILE_TOKENS = 1 << 23
# Bytes of text dealt to one task.
TASK_BYTES = 64 << 20
# Remembered parts of words in a task. Others are encoded each time they occur.
REMEMBERED = 600_000

# Latin characters and signs, which have no other normal form; "İ" has two in lower case.
_LATIN = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x250)) if c != 0x130]
_PLAIN = re.compile(f"[ \\n\\t{re.escape(''.join(_LATIN))}]*").fullmatch


def _parts() -> re.Pattern[str]:
    """How the tokenizer file cuts lower-case text, for plain characters."""
    letters = re.escape("".join(c for c in _LATIN if unicodedata.category(c)[0] == "L"))
    numbers = re.escape("".join(c for c in _LATIN if unicodedata.category(c)[0] == "N"))
    # Fixed values of the tokenizer file.
    endings = "'s|'t|'re|'ve|'m|'ll|'d"
    return re.compile(f"{endings}|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+")


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabets show a byte that has no sign of its own as the next letter from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + n for n, b in enumerate(others)}


class WordEncoder:
    """Ids of whole texts, equal to those of the tokenizer file, with a memory of frequent words.

    For tokenizer files that take lower case, cut as ``_parts`` does and let no token span white
    space. Plain text is cut here and its parts given to the file's model; other words are encoded
    by the whole tokenizer, and so are texts with anything like a special token.
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.code = Tokenizer.from_file(path), np.dtype(kind).char
        self.model = self.tokenizer.model
        self.parts = _parts().findall
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        shown = part.encode().decode("latin1").translate(self.letters)
        ids = array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()
        if len(self.known) < REMEMBERED:
            self.known[part] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        """Ids as unsigned numbers."""
        if "<|" in text:
            return self._whole(text)
        if not _PLAIN(text):
            words = text.replace("\n", " ").replace("\t", " ").split(" ")
            return b"".join([self(w) if _PLAIN(w) else self._whole(w) for w in words])
        parts, known = self.parts(text.lower()), self.known
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            return b"".join([known[p] if p in known else self._part(p) for p in parts])


def narrowest(tokenizer: str, end_id: int) -> str:
    """The type that holds every id: 16 bits if they do."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def sequence_schema(length: int, kind: str) -> pa.Schema:
    ids = pa.from_numpy_dtype(np.dtype(kind))
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


class _Writer:
    """One file and its list of documents. Both get their names when they are complete."""

    def __init__(self, folder: str, name: str, attempt: str, length: int, doc_id: pa.DataType, kind: str, at_once: int):
        self.system, place = _place(folder)
        self.system.create_dir(place, recursive=True)
        self.path, self.name, self.attempt = f"{place}/{name}", name, attempt
        self.at_once = at_once
        self.length, self.kind, self.schema = length, np.dtype(kind), sequence_schema(length, kind)
        self.docs_schema = pa.schema([("doc_id", doc_id), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = self.system.open_output_stream(f"{self.path}.ids.{attempt}")
        self.stream = pa.ipc.new_stream(self.out, self.schema)
        self.docs_out = self.system.open_output_stream(f"{self.path}.docs.{attempt}")
        self.docs_stream = pa.ipc.new_stream(self.docs_out, self.docs_schema)
        self.held: list[bytes] = []
        self.n_held = self.tokens = self.documents = 0
        self.listed: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        n = len(ids) // self.kind.itemsize
        self.listed.append((doc_id, self.tokens, n))
        self.held.append(ids)
        self.n_held += n
        self.tokens += n
        self.documents += 1
        full = self.length * self.at_once
        if self.n_held >= full:
            whole = np.frombuffer(b"".join(self.held), self.kind)
            self.n_held = len(whole) % full
            for start in range(0, len(whole) - self.n_held, full):
                self._batch(whole[start : start + full])
            self.held = [whole[len(whole) - self.n_held :].tobytes()]
        if len(self.listed) >= 10_000:
            self._list()

    def _batch(self, ids: np.ndarray) -> None:
        mask = np.ones(len(ids), bool)
        missing = -len(ids) % self.length
        if missing:
            ids, mask = (np.concatenate([a, np.zeros(missing, a.dtype)]) for a in (ids, mask))
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(a), self.length) for a in (ids, mask)]
        self.stream.write_batch(pa.record_batch(columns, schema=self.schema))

    def _list(self) -> None:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*self.listed), self.docs_schema)]
        self.docs_stream.write_batch(pa.record_batch(columns, schema=self.docs_schema))
        self.listed = []

    def close(self) -> None:
        if self.n_held:
            self._batch(np.frombuffer(b"".join(self.held), self.kind))
        if self.listed:
            self._list()
        for stream, out, kind in ((self.stream, self.out, "ids"), (self.docs_stream, self.docs_out, "docs")):
            stream.close()
            out.close()
            # A task that is run again writes the same file and puts it in the same place.
            self.system.move(f"{self.path}.{kind}.{self.attempt}", f"{self.path}.{kind}.arrows")


def write_sequences(
    docs: DataFrame,
    tokenizer: str,
    out: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write all texts in ascending doc_id order as files below ``out``; returns one row per file.

    Columns: ``path`` (without the endings .ids.arrows and .docs.arrows), ``start`` (tokens in the
    files before it), ``n_tokens``, ``n_docs``. A null text counts as empty; every document has at
    least its end id. Rows without doc_id come first; rows of one doc_id come in the order of a
    hash of their texts, repeated ones each. No rows give no files. Long texts are never cut between
    files, so a file may be longer than ``file_tokens`` by one document. Other columns are not read.

    ``out`` is a folder all executors reach, by a plain path or any address pyarrow knows.
    """
    spark = docs.sparkSession
    kind = narrowest(tokenizer, end_id)
    text = F.coalesce("text", F.lit(""))
    # The last column tells equal rows apart, so that no key is too large for a range.
    order = {"h": F.xxhash64(text), "u": F.monotonically_increasing_id()}
    rows = docs.select("doc_id", text.alias("text"), *[c.alias(k) for k, c in order.items()])
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(-(-size // TASK_BYTES), spark.sparkContext.defaultParallelism)
    dealt = rows.repartitionByRange(n, "doc_id", *order).sortWithinPartitions("doc_id", *order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), f"{context.taskAttemptId()}"
        encoder, end = WordEncoder(tokenizer, kind), np.array([end_id], kind).tobytes()
        done, writer = [], None

        def finish():
            writer.close()
            done.append((f"{out}/{writer.name}", part, len(done), writer.tokens, writer.documents))

        for batch in batches:
            texts = batch.column("text")
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                if writer is None:
                    name = f"part-{part:06d}-{len(done):05d}"
                    id_type = batch.schema.field("doc_id").type
                    writer = _Writer(out, name, attempt, length, id_type, kind, BATCH_SEQUENCES)
                writer.add(doc_id, encoder(texts[i].as_py()) + end)
                if writer.tokens >= file_tokens:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        if done:
            columns = zip(("path", "part", "file", "n_tokens", "n_docs"), zip(*done))
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns})

    files = written(dealt.mapInArrow(write, "path string, part long, file long, n_tokens long, n_docs long"))
    # One row per file.
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start")
    return files.select("path", start, "n_tokens", "n_docs")


def _buffer(path: str) -> pa.Buffer:
    """The bytes of a file: mapped if it is local, else read."""
    system, place = _place(path)
    if isinstance(system, fs.LocalFileSystem):
        with pa.memory_map(place) as mapped:
            return mapped.read_buffer()
    with system.open_input_file(place) as whole:
        return whole.read_buffer()


class SequenceFile:
    """Sequences of one file by number, as views on the file's bytes."""

    def __init__(self, path: str):
        self._bytes = _buffer(f"{path}.ids.arrows")
        source = pa.BufferReader(self._bytes)
        self.schema = pa.ipc.read_schema(source)
        self.length = self.schema.field("ids").type.list_size
        self._first, self._per_batch, self._stride, self._last = source.tell(), 0, 0, 0
        first = self._batch_at(self._first)
        if first is not None:
            self._per_batch = first[0].num_rows
            self._stride = first[1] - self._first
            # Eight bytes end a stream. All batches before the last one are as long as the first.
            self._last = (self._bytes.size - 8 - self._first - 1) // self._stride
        self._held: tuple = (None, None)
        self._size = self._per_batch * self._last + (len(self._batch(self._last)[0]) if first else 0)

    def _batch_at(self, place: int):
        source = pa.BufferReader(self._bytes)
        source.seek(place)
        try:
            message = pa.ipc.read_message(source)
        except EOFError:
            return None
        return pa.ipc.read_record_batch(message, self.schema), source.tell()

    def _batch(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if self._held[0] != number:
            batch, _ = self._batch_at(self._first + number * self._stride)
            ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True).reshape(-1, self.length)
            self._held = number, (ids, batch.column("mask").flatten())
        return self._held[1]

    def __len__(self) -> int:
        return self._size

    def __getitem__(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """The ids and the mask of one sequence: a view of the ids, a slice of the mask's bits."""
        if not 0 <= number < self._size:
            raise IndexError(number)
        ids, mask = self._batch(number // self._per_batch)
        at = number % self._per_batch
        return ids[at], mask.slice(at * self.length, self.length)

    def tokens(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from one place of the file to another, batch by batch."""
        per_batch = self._per_batch * self.length
        while n:
            ids = self._batch(start // per_batch)[0].reshape(-1)[start % per_batch :][:n]
            yield ids
            start, n = start + len(ids), n - len(ids)


def read_documents(files: DataFrame, doc_id: str = "long") -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``, each file read in one task.

    The checksum is that of the ids as little-endian unsigned 32-bit numbers.
    ``doc_id`` is its type. The number of tasks follows the number of files.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                sequences = SequenceFile(path)
                for listed in pa.ipc.open_stream(_buffer(f"{path}.docs.arrows")):
                    starts, counts = (listed.column(c).to_numpy() for c in ("start", "n_tokens"))
                    sums = []
                    for s, n in zip(starts.tolist(), counts.tolist()):
                        crc = 0
                        for ids in sequences.tokens(s, n):
                            crc = zlib.crc32(ids.astype("<u4"), crc)
                        sums.append(crc)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": listed.column("doc_id"),
                            "start": pa.array(starts + before),
                            "n_tokens": listed.column("n_tokens"),
                            "ids_crc32": pa.array(sums, pa.int64()),
                        }
                    )

    spread = files.select("path", "start").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(read, f"doc_id {doc_id}, start long, n_tokens long, ids_crc32 long")
