"""Sequence files: exact round trips, views without copies, nulls, repeated ids, long and empty texts."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import LLM_QUERIES, sequencefiles
from tidemark.llm.queries import tokenizer_path
from tidemark.session import scratch_dir

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, h string, u string, path string, start string, n_tokens string"
TOKENIZER = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(TOKENIZER))


def _ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def _written(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, "h", "u", "p", "s", "n") for i, t in rows], SCHEMA)
    return sequencefiles.write_sequences(docs, tokenizer_path(TOKENIZER), scratch_dir(spark, "sequences"), **more)


def test_query_gives_what_the_tokenizer_gives(spark, tokenizer):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    expected, start = [], 0
    for doc_id, text in docs:
        ids = _ids(tokenizer, text)
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = LLM_QUERIES["op13_arrow_sequences"](spark, SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected


def test_encoder_equals_the_tokenizer_file(tokenizer):
    encode = sequencefiles.WordEncoder(tokenizer_path(TOKENIZER), "<u2")
    texts = [
        "", " ", "It's WE'LL they'D don'T 's'S", "a  b\tc\nd\r\ne f g", "x<|endoftext|>y <|a", "12345 ½²", "a_b-c!!..?",
        "Ångström İstanbul ΣΑΣ Σ ß ǅ ŉ", "é ́ cafés", "日本語テキスト", "naïve🙂🙂 ok", "\x1c\x85 \x00", "ª º µ ÿ Ɏ",
    ]
    for text in [*texts, " ".join(texts), "".join(texts[2:])]:
        assert np.frombuffer(encode(text), "<u2").tolist() == _ids(tokenizer, text)[:-1], text


def test_sequences_are_of_one_length_and_views(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(sequencefiles, "BATCH_SEQUENCES", 4)
    rows = [(i, "word " * (i * 7 % 90)) for i in range(60)] + [(60, "long text, " * 4000)]
    files = _written(spark, rows, length=16, file_tokens=150).orderBy("start").collect()
    assert len(files) > 8 and sum(f.n_docs for f in files) == 61
    stream = []
    for f in files:
        file = sequencefiles.SequenceFile(f.path)
        sequences = [file[i] for i in range(len(file))]
        assert all(len(ids) == len(mask) == 16 for ids, mask in sequences)
        assert all(not ids.flags.owndata for ids, _ in sequences)
        kept = np.concatenate([ids[mask.to_numpy(zero_copy_only=False)] for ids, mask in sequences])
        assert len(kept) == f.n_tokens and f.start == len(stream)
        assert all(all(mask.to_pylist()) for _, mask in sequences[:-1])
        # Any reader of Arrow streams sees the same.
        with pa.ipc.open_stream(f"{f.path}.ids.arrows") as plain:
            table = plain.read_all()
        assert len(table) == len(file) and table.schema.field("ids").type == pa.list_(pa.uint16(), 16)
        with pytest.raises(IndexError):
            file[len(file)]
        stream += kept.tolist()
    assert stream == [i for _, t in rows for i in _ids(tokenizer, t)]


def test_null_and_repeated_ids_and_texts(spark, tokenizer):
    rows = [(None, "first"), (None, None), (2, "b"), (2, "b"), (2, "other text"), (-5, ""), (7, None), (3, "\n \t")]
    files = _written(spark, rows)
    got = sorted(map(tuple, sequencefiles.read_documents(files).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, -5, 2, 2, 2, 3, 7]
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got[:-1]]]).tolist()
    crc = lambda t: zlib.crc32(np.array(_ids(tokenizer, t), "<u4").tobytes())
    assert sorted((str(r[0]), r[3]) for r in got) == sorted((str(i), crc(t)) for i, t in rows)


def test_no_rows_and_ids_as_texts(spark):
    files = _written(spark, [])
    assert files.count() == 0 and sequencefiles.read_documents(files).count() == 0
    docs = spark.createDataFrame([("b", "x"), ("a", "y")], "doc_id string, text string")
    files = sequencefiles.write_sequences(docs, tokenizer_path(TOKENIZER), scratch_dir(spark, "sequences"))
    got = sequencefiles.read_documents(files, "string").orderBy("start").collect()
    assert [r.doc_id for r in got] == ["a", "b"]


def test_a_file_written_again_replaces_the_first(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    out = scratch_dir(spark, "sequences")
    first, second = (sequencefiles.write_sequences(docs, tokenizer_path(TOKENIZER), out).collect() for _ in range(2))
    assert first == second
