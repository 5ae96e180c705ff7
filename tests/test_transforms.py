import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.data import SENTENCES, WORDS
from tidemark.functions.columns import is_even, square, words
from tidemark.operators import transforms
from tidemark.sources.tables import from_rows


def ints(spark, n):
    return from_rows(spark, [(i,) for i in range(1, n + 1)], "x INT")


def column(df, name, order="seq"):
    return [row[name] for row in df.orderBy(order).collect()]


def test_identity_keeps_type_and_rows(spark):
    df = ints(spark, 5)
    assert df.schema["x"].dataType.simpleString() == "int"
    assert column(df, "x") == [1, 2, 3, 4, 5]


def test_double(spark):
    assert column(transforms.map_columns(ints(spark, 5), ["seq"], y=F.col("x") * 2), "y") == [2, 4, 6, 8, 10]


def test_square_then_even(spark):
    squared = transforms.map_columns(ints(spark, 10), ["seq"], y=square("x"))
    assert column(transforms.keep_rows(squared, is_even("y")), "y") == [4, 16, 36, 64, 100]


def test_square_of_large_int_does_not_overflow(spark):
    df = from_rows(spark, [(2_000_000_000,)], "x INT")
    assert df.select(square("x")).first()[0] == 4 * 10**18


def test_even_test_holds_for_negative_numbers(spark):
    df = from_rows(spark, [(-4,), (-3,), (0,)], "x INT")
    assert column(transforms.keep_rows(df, is_even("x")), "x") == [-4, 0]


def test_flat_map_words(spark):
    df = from_rows(spark, [(s,) for s in SENTENCES], "s STRING")
    out = transforms.flat_map_words(df, ["seq"], "s").orderBy("seq", "pos")
    assert [r["word"] for r in out.collect()] == WORDS


@pytest.mark.parametrize("text", ["a  b ", " a", "", " ", "a", "x\ty\n z"])
def test_words_split_as_python_does(spark, text):
    assert spark.createDataFrame([(text,)], "s STRING").select(words("s")).first()[0] == text.split(" ")


@pytest.mark.parametrize("separator", [".", "|", "+", "--"])
def test_separator_is_literal(spark, separator):
    text = f"a{separator}b.c|d"
    out = spark.createDataFrame([(text,)], "s STRING").select(words("s", separator)).first()[0]
    assert out == text.split(separator)


def test_flat_map_to_sub_events_drops_rows_with_none(spark):
    df = spark.range(5).withColumnRenamed("id", "n")
    out = transforms.flat_map(df, ["n"], transforms.count_up_to(F.col("n") % 3), "i")
    assert sorted((r["n"], r["i"]) for r in out.collect()) == [(1, 1), (2, 1), (2, 2), (4, 1)]


def test_word_count(spark):
    df = from_rows(spark, [(s,) for s in SENTENCES], "s STRING")
    got = {r["word"]: r["n"] for r in transforms.word_count(df, "s").collect()}
    assert got == {w: WORDS.count(w) for w in WORDS}


def test_user_functions_on_series_and_frames(spark):
    df = ints(spark, 5)
    assert column(transforms.map_series(df, "x", lambda s: s * 2, "y", "bigint"), "y") == [2, 4, 6, 8, 10]

    def keep_odd(frame: pd.DataFrame) -> pd.DataFrame:
        return frame[frame["x"] % 2 == 1]

    assert column(transforms.map_frames(df, keep_odd, "seq BIGINT, x INT"), "x") == [1, 3, 5]


def test_user_functions_get_frames_of_a_bounded_size(spark):
    rows = [(i, None if i % 50 == 7 else "x" * (3_000_000 if i == 120 else 10_000)) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, s string").coalesce(1)

    def sizes(frame):
        assert list(frame.index) == list(range(len(frame)))
        texts = frame["s"].dropna()
        return pd.DataFrame({"first": frame["i"].iloc[:1], "n": len(frame), "chars": sum(len(s) for s in texts)})

    got = transforms.map_frames(df, sizes, "first long, n long, chars long").collect()
    assert sum(r["n"] for r in got) == 300 and sum(r["chars"] for r in got) == 293 * 10_000 + 3_000_000
    assert [r["n"] for r in got if r["chars"] > 1 << 20] == [1]
    assert len(got) < 12
