"""The training-data operators against brute force, and with nulls, ties, empty tables, odd columns."""

import hashlib
import itertools
import random
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import LLM_ORACLES, LLM_QUERIES, decontaminate, html, linealign, neardup, packing, quality
from tidemark.llm import sharding, suffixdedup, tokencounts, vafile
from tidemark.llm.common import components
from tidemark.llm.queries import tokenizer_path

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, lang string, n_chars long, mark string, score double"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()


def _prose(seed, n):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty, blank, repeated and long texts; columns whose names the operators use inside."""
    long = "\n".join(_prose(s, 30) for s in range(120))
    base = _prose(1, 80)
    rows = [
        (1, base), (2, base), (3, base + " extra"), (4, None), (5, ""), (6, " \n\t "), (7, "tiny text"), (8, "tiny text"),
        (9, long), (10, long[:5000] + "\n" + _prose(77, 60)), (11, "x" * 5000), (None, base), (12, _prose(5, 90)), (12, _prose(5, 90)),
    ]
    return spark.createDataFrame([(i, t, None if i == 3 else f"s{i}", "en", 1, "m", 0.5) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


# SQL


@pytest.mark.parametrize("name", LLM_ORACLES)
def test_query_gives_what_the_sql_gives(spark, name):
    with duckdb.connect() as duck:
        for t in ("documents", "embeddings"):
            duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
        got = LLM_QUERIES[name](spark, SMALL)
        columns = sorted(got.columns)
        expected = duck.sql(LLM_ORACLES[name])
        assert columns == sorted(expected.columns)
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(expected.select(*columns).fetchall())


# 1


def _edit_distance_anywhere(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (p != t))
    return min(row)


@pytest.mark.parametrize("kind", ["int", "smallint", "string", "long"])
def test_item_ids_of_any_type(spark, kind):
    text = _prose(9, 60)
    docs = spark.createDataFrame([(1, "x " + text + " y"), (None, text)], "doc_id int, text string")
    items = spark.createDataFrame([(5, text), (None, text)], "item_id int, text string")
    items = items.select(F.col("item_id").cast(kind), "text")
    got = decontaminate.contaminated(docs, items)
    five = "5" if kind == "string" else 5
    found = sorted(((r["doc_id"], r["item_id"]) for r in got.collect()), key=str)
    assert found == sorted([(1, five), (1, None), (None, five), (None, None)], key=str)


def test_bit_parallel_distance_is_the_edit_distance():
    rng = random.Random(3)
    for _ in range(200):
        p = "".join(rng.choices("abc", k=rng.randint(1, 80)))
        t = "".join(rng.choices("abc", k=rng.randint(0, 90)))
        assert decontaminate.Pattern(p).best_in(t)[0] == _edit_distance_anywhere(p, t)


def test_contaminated_finds_all_within_the_budget_and_no_clean_text(spark, odd_docs):
    item = _prose(500, 30)
    rng = random.Random(4)
    texts = {}
    for n in range(40):
        edited = list(item)
        for _ in range(n // 2):
            edited[rng.randrange(len(edited))] = rng.choice("qwz")
        texts[n] = f"{_prose(n, 40)} {''.join(edited).upper()}  \n {_prose(n + 900, 40)}"
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, "short")], "item_id long, text string")
    got = {r["doc_id"]: r["edits"] for r in decontaminate.contaminated(docs, items, chunk_chars=50).collect()}
    budget = decontaminate.Pattern(item).budget
    normal = decontaminate.normalise
    expected = {i: _edit_distance_anywhere(normal(item), normal(t)) for i, t in texts.items()}
    assert got == {i: e for i, e in expected.items() if e <= budget}
    assert 0 < len(got) < 40
    assert decontaminate.contaminated(odd_docs, items).count() == 0
    assert decontaminate.contaminated(docs, items.where("false")).count() == 0


def test_short_items_are_found_word_for_word(spark):
    texts = {1: "So WHAT is \n 2+2? Four.", 2: "what is 2+3?", 3: "somewhat is 2+2?", 4: "what is 2+2?", 5: "what is 2+2? and what is 2+2?x", 6: "a pig", 7: "a pigeon"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = spark.createDataFrame([(1, "What is 2+2?"), (2, "a pig"), (3, " ")], "item_id long, text string")
    got = {tuple(r) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 1, 0, 1, 15), (4, 1, 0, 1, 12), (5, 1, 0, 2, 12), (6, 2, 0, 1, 5)}


# 2


def _check_pieces(rows, ids, window):
    pieces = sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    for doc_id, own in itertools.groupby(pieces, key=lambda p: p[0]):
        at = 0
        for _, start, length, crc in own:
            assert start == at
            assert crc == zlib.crc32(np.array(ids[doc_id][at : at + length], "<u4").tobytes())
            at += length
        assert at == len(ids[doc_id])
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    sizes = []
    for s in sorted(by_sequence):
        at = 0
        for offset, length in sorted(by_sequence[s]):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(s == window for s in sizes[:-1]) and sizes[-1] <= window


def test_packing_places_every_id_once_and_mixes_by_share(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = ["a  b", " lead", "trail \n", "x\n\ny", "tab\tq", " nbsp", "a\x1cb", "<|endoftext|> a", None, "", "日本 語\n é"]
    extra = spark.createDataFrame([(10_000 + i, t, None) for i, t in enumerate(odd)], "doc_id long, text string, source string")
    docs = docs.select("doc_id", "text", "source").unionByName(extra)
    rows = packing.pack(docs, path, tokenizer_path("byte_bpe_50k.tiktoken"), sequence=256).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts.items()}
    _check_pieces(rows, ids, 256)
    total = sum(map(len, ids.values()))
    share = Counter()
    for r in rows:
        share[r["source"]] += r["length"]
    # The credit of a source is never off by more than a token or two, at any window's end.
    sent = Counter()
    for s, own in itertools.groupby(sorted(rows, key=lambda r: r["sequence_id"]), key=lambda r: r["sequence_id"]):
        for r in own:
            sent[r["source"]] += r["length"]
        done = min(total, (s + 1) * 256)
        assert all(abs(sent[q] - done * share[q] / total) <= 2 for q in share)


def test_packing_with_targets_and_without_rows(spark, no_docs):
    path = tokenizer_path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(i, _prose(i, 200), "ab"[i % 2]) for i in range(40)], "doc_id long, text string, source string")
    rows = packing.pack(docs, path, sequence=128, targets={"a": 3.0, "b": 1.0}, queues=8).collect()
    first = Counter()
    for r in rows:
        if r["sequence_id"] < 20:
            first[r["source"]] += r["length"]
    assert abs(first["a"] - 3 * first["b"]) <= 8
    assert sum(r["length"] for r in rows) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}.values())
    assert packing.pack(no_docs, path).count() == 0
    shared = packing.pack(docs, path, sequence=128, queues=1).collect()
    assert sum(r["length"] for r in shared) == sum(r["length"] for r in rows)


# 3


def test_quality_is_learnt_and_held_out_rows_are_not_seen(spark):
    sf = "/root/testdata/sf0.01"
    rows = LLM_QUERIES["op3_neighbour_quality"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = rows.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*"))
    accuracy, n = judged.first()
    assert n > 50 and accuracy > 0.95
    assert rows.where("held_out != (crc32(cast(doc_id as string)) % 3 = 1)").count() == 0


def test_quality_scores_odd_texts(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (9, 0, 1), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(odd_docs, labels)
    with pytest.raises(ValueError):
        quality.scored(odd_docs, model)
    rows = quality.scored(odd_docs, model, "_s").collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["_s"] <= 1 for r in rows)
    empty = {r["_s"] for r in rows if not (r["text"] or "").strip("\n\t ")}
    assert empty and all(abs(s - model.prior) < 0.51 for s in empty)
    equal = [r["_s"] for r in rows if r["text"] == rows[0]["text"]]
    assert len(equal) == 3 and max(equal) - min(equal) < 1e-5
    untaught = quality.fit(odd_docs, labels.where("false"))
    assert {r["_s"] for r in quality.scored(odd_docs, untaught, "_s").collect()} == {0.5}
    assert quality.scored(no_docs, model, "_s").count() == 0


# 4


def _article(source):
    return html.Page(source).text()


def test_main_text_of_single_pages():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header>H</header><nav><a>m</a></nav>
    <div class="cookie-notice">c</div><main><article><h1>A &amp; B</h1><p>one <b>two</b><br>three<p>four &lt;x&gt;
    <div class=ad>no</div><script>var a="</p>";</script><form>f</form><ul><li>i<li>j</ul></article></main>
    <section id="comments">r</section><footer>z</footer></body></html>"""
    assert _article(page) == "A & B\none two three\nfour <x>\ni\nj"
    assert _article("plain <b>text") == "plain text"
    assert _article("<!-- a") == "" and _article("<p>a</q></p></p>b") == "a\nb"
    assert _article('<p title="a>b">x</p> 1 < 2') == "x\n1 < 2"


def test_names_inside_an_article_count_as_whole_words():
    page = """<div id="top-banner">no</div><article><h1>T</h1><section id="related-work">a</section>
    <p class="search-algorithms notice-period">b</p><div class="box sidebar">no</div><p role="note">c</p></article>"""
    assert _article(page) == "T\na\nb\nc"


@pytest.mark.parametrize("page", ["<div>x", "<b>", "<p>x</q>", "<ul><li>x", "</b>", "<table><tr><td>"])
def test_deeply_nested_pages_take_time_in_proportion(page):
    def taken(n):
        begun = time.process_time()
        read = html.Page("<article>" + page * n + "<p>end")
        assert read.text().endswith("end") and read.countable()
        return time.process_time() - begun

    taken(2_000)
    assert taken(32_000) < 40 * max(taken(4_000), 0.005)


def test_site_templates_are_deleted_and_copies_are_not_templates(spark):
    rows = [(i, f"http://Site.example/{i}", f"<div><p>shared strip</p><p>own {i}</p></div>") for i in range(20)]
    rows += [(100 + i, "http://copy.example/a", "<div><p>an article</p><p>its end</p></div>") for i in range(20)]
    rows += [(200, None, "<p>q</p>"), (201, "http://site.example/x", None), (202, "nonsense", ""), (None, "http://a.b", "<p>n</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x"))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.main_text(pages).collect()}
    assert got[3] == ("own 3", 5) and got[100] == ("an article\nits end", 18)
    assert got[200] == ("q", 1) and got[201] == ("", 0) and got[202] == ("", 0) and got[None] == ("n", 1)
    assert html.main_text(pages.where("false")).count() == 0


# 5


def test_token_counts_are_those_of_greedy_matching(spark, odd_docs, no_docs):
    rng = random.Random(8)
    vocabulary = {"".join(rng.choices("abc ", k=rng.randint(1, 5))).encode() for _ in range(60)}
    automaton = tokencounts.LongestMatch(vocabulary, unknown=99)

    def greedy(word):
        at = n = 0
        while at < len(word):
            end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
            if end is None:
                return 99
            at, n = end, n + 1
        return n

    for _ in range(3000):
        word = "".join(rng.choices("abcd ", weights=[9, 9, 9, 1, 3], k=rng.randint(0, 12))).encode()
        assert automaton.count(word) == greedy(word)
    every = [bytes([b]) for b in range(256)]
    rows = tokencounts.token_counts(odd_docs, every).collect()
    assert len(rows) == odd_docs.count()
    for r, d in zip(sorted(rows, key=str), sorted(odd_docs.collect(), key=str)):
        assert r["n_tokens"] >= r["n_words"] >= 0
    assert {(r["n_words"], r["n_tokens"]) for r in rows if r["doc_id"] in (4, 5, 6)} == {(0, 0)}
    assert {(r["n_words"], r["n_tokens"]) for r in rows if r["doc_id"] == 7} == {(2, 10)}
    assert tokencounts.token_counts(no_docs, every).count() == 0


# 6


def test_suffix_array():
    rng = random.Random(5)
    for _ in range(1500):
        s = [rng.randint(0, rng.choice([1, 2, 6])) for _ in range(rng.randint(0, 40))]
        assert suffixdedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def _without_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("contents", [1, 48])
def test_repeats_are_removed_as_by_brute_force(spark, contents):
    rng = random.Random(9)
    pool = [_prose(s, 60) for s in range(6)]
    texts = [None, "", "é" * 300, "short", pool[0], pool[0], "ab" * 200]
    for n in range(60):
        a, b = rng.choice(pool), rng.choice(pool)
        cut = rng.randrange(len(a))
        texts.append(_prose(1000 + n, 12) + a[cut : cut + rng.randint(150, 300)] + _prose(2000 + n, 9) + b[: rng.randint(100, 250)])
    docs = spark.createDataFrame([(None if i == 6 else i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, h string")
    rows = suffixdedup.without_repeats(docs, contents=contents).collect()
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in rows)
    assert got == sorted(_without_repeats(texts, 200))
    assert suffixdedup.without_repeats(docs.where("false")).count() == 0


@pytest.mark.parametrize("contents", [1, 6, 48])
def test_frequent_passages_are_cut_into_cells_not_strings(spark, contents):
    """A passage in more texts than an array is built over, with few different bytes beside it."""
    rng = random.Random(12)
    passage = _prose(77, 60)
    texts = ["ab" * 900, "ab" * 300 + "c" + "ab" * 300]
    for n in range(130):
        near = "".join(rng.choice("xy") for _ in range(rng.randint(1, 6)))
        after = "".join(rng.choice("xy") for _ in range(rng.randint(0, 6)))
        texts.append(_prose(3000 + n, 8) + near + passage[rng.choice([0, 0, 0, 40]) :] + after + _prose(5000 + n, rng.randint(0, 30)))
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = suffixdedup.without_repeats(docs, contents=contents).collect()
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in rows)
    assert got == sorted(_without_repeats(texts, 200))
    ranges = suffixdedup.repeated_ranges(docs, contents=contents)
    assert "Generate" not in ranges._jdf.queryExecution().toString()


def test_rows_of_a_repeated_content_do_not_meet(spark):
    """Of a batch, one row stands for a content's occurrences; the others are known to be repeated."""
    text = _prose(3, 80)
    docs = spark.createDataFrame([(i, text) for i in range(80)], "doc_id long, text string").coalesce(1)
    found = suffixdedup._occurrences(docs, 200, 100).collect()
    assert Counter(r["n"] for r in found).keys() == {0, 80}
    assert max(Counter(r["key"] for r in found).values()) == 1


# 7


@pytest.mark.parametrize("copies", [1, 40])
def test_top_k_is_exact_with_ties_nulls_and_short_vectors(spark, copies):
    rng = random.Random(10)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.0]) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 6) for i in range(copies)]
    rows += [(400, None), (500, [float("nan")] * 6), (600, [1.0, None]), (700, [0.5, 0.5]), (800, []), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r[0], r[1]): (r[2], r[3]) for r in vafile.top_k(vafile.whole_vectors(df, "vec_id", "embedding"), F.col("id") % 50 == 0).collect()}
    good = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and i not in (400, 500, 600)]
    for q, v in [g for g in good if g[0] % 50 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:10]
        assert [got[q, r] for r in range(1, 11)] == [(i, -s) for s, i in scores]
    assert vafile.top_k(vafile.whole_vectors(df.where("false"), "vec_id", "embedding"), F.lit(True)).count() == 0


def test_top_k_refuses_sums_that_doubles_do_not_hold(spark):
    df = spark.createDataFrame([(i, [2.0**20 + i, 1.0]) for i in range(3)], "vec_id long, embedding array<double>")
    with pytest.raises(OverflowError, match="inner products"):
        vafile.top_k(vafile.whole_vectors(df, "vec_id", "embedding"), F.lit(True))


# 8


def test_patience_matches_rise_and_are_equal():
    rng = random.Random(11)
    for _ in range(500):
        a, b = ([rng.randint(0, 12) for _ in range(rng.randint(0, 15))] for _ in range(2))
        found = linealign.patience_matches(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))
    assert linealign.patience_matches([1, 2, 3], [0, 1, 2, 3]) == [(0, 1), (1, 2), (2, 3)]


@pytest.mark.parametrize("rare", [2, 100])
def test_later_documents_lose_aligned_blocks(spark, odd_docs, no_docs, rare):
    passage = [_prose(s, 30) for s in (41, 42)]
    own = {i: [_prose(100 + i, 25), "All rights reserved."] for i in range(6)}
    texts = {i: "\n".join([own[i][0], *passage, own[i][1]]) for i in own}
    docs = spark.createDataFrame([(i, t, "b") for i, t in texts.items()], "doc_id long, text string, blocks string")
    rows = {r["doc_id"]: r for r in linealign.without_blocks(docs, rare=rare).collect()}
    # The last line is next to the passage in all of them, so it belongs to the block.
    assert rows[0]["text"] == texts[0] and rows[0]["_removed"] == 0
    assert all(rows[i]["text"] == own[i][0] and rows[i]["_removed"] == 3 and rows[i]["blocks"] == "b" for i in range(1, 6))
    odd = linealign.without_blocks(odd_docs, rare=rare).collect()
    assert len(odd) == odd_docs.count()
    by_id = {r["doc_id"]: r["text"] for r in odd}
    assert by_id[4] is None and by_id[5] == "" and by_id[2] == "" and by_id[1] == by_id[None] and by_id[12]
    assert linealign.without_blocks(no_docs).count() == 0


def test_shortest_runs_hold_every_line_of_longer_ones():
    rng = random.Random(13)
    for _ in range(300):
        n = rng.randint(1, 9)
        words = [rng.choice([0, 3, 5, 8, 12, 25]) for _ in range(n)]
        lines = [i + 1 if w else 0 for i, w in enumerate(words)]
        runs = [set(np.frombuffer(r, np.int64).tolist()) for r in linealign.shortest_runs(lines, words, 20)]
        assert all(sum(words[i - 1] for i in r) >= 20 for r in runs)
        for s, e in itertools.combinations(range(n + 1), 2):
            block = {x for x in lines[s:e] if x}
            if sum(words[s:e]) >= 20:
                single = {x for x in block if words[x - 1] >= 20}
                assert set().union(single, *(r for r in runs if r <= block)) == block


def test_blank_lines_neither_break_nor_make_a_block(spark):
    passage = [_prose(70 + i, 11) for i in range(5)]
    texts = {1: "\n".join([_prose(80, 25), *passage]), 2: "\n\n".join([*passage, _prose(81, 25)]), 3: f"{passage[0]}\n\n\n{_prose(82, 25)}"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in linealign.without_blocks(docs).collect()}
    assert rows == {1: texts[1], 2: "\n" + _prose(81, 25), 3: texts[3]}
    # Blank lines at the ends go as far as both texts have them.
    assert linealign.common_blocks([0, 1, 2, 0], [3, 0, 0, 1, 0, 2, 0, 0, 4], [1, 0, 0, 10, 0, 10, 0, 0, 1], 20) == [(2, 7)]
    assert linealign.common_blocks([1, 0, 0, 2], [1, 0, 0, 3], [19, 0, 0, 19], 20) == []


@pytest.mark.parametrize("rare", [2, 8])
def test_blocks_of_frequent_lines_with_different_first_holders_are_found(spark, rare):
    block = [_prose(60, 8), _prose(61, 7), _prose(62, 12)]
    own = {i: _prose(200 + i, 25) for i in range(16)}
    texts = {i: f"{own[i]}\n{block[i]}" for i in range(3)} | {i: "\n".join([own[i], *block]) for i in range(3, 16)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in linealign.without_blocks(docs, rare=rare).collect()}
    assert rows == {i: texts[i] if i <= 3 else own[i] for i in texts}


# 9


def _near(texts):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in texts}
    links = [(a, b) for a, b in itertools.combinations(texts, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in texts:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return {i: (len(sets[i]), least[i]) for i in texts}


@pytest.mark.parametrize("large", [1, 2_000])
def test_near_duplicates_are_those_of_full_sets(spark, large):
    rng = random.Random(12)
    texts, n = {}, 0
    for family in range(6):
        words = _prose(family, 120).split()
        for _ in range(12):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 99)}"
            texts[n], n = " ".join(copy), n + 1
    texts |= {900: "a b", 901: "A  b", 902: None, 903: "", 904: " ", 905: "a b c"}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, bucket int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, large).collect()}
    assert got == _near(texts)


def test_a_pair_with_one_band_in_common_is_found_in_a_large_bucket(spark):
    """All other entries share that one bucket as well, so neither of the two is first compared with the other."""
    rng = random.Random(3700)
    first = [f"w{rng.randrange(10**6)}" for _ in range(39)]
    second = first[:-5] + [f"x{rng.randrange(10**6)}" for _ in range(5)]
    shingler = neardup.Shingler()

    def bands(words):
        return neardup.band_keys(neardup.samples(shingler(" ".join(words))))

    common = set(bands(first)) & set(bands(second))
    assert len(common) == 1
    texts = {100: " ".join(first), 101: " ".join(second)}
    while len(texts) < 42:
        # Far from both and from each other.
        other = first[:-16] + [f"y{rng.randrange(10**6)}" for _ in range(16)]
        if common <= set(bands(other)):
            texts[len(texts) + 100] = " ".join(other)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for large in (5, 2_000):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, large).collect()}
        assert got == _near(texts) and got[101] == (35, 100) and got[102][1] == 102


def test_near_duplicates_of_odd_rows(spark, odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"] and by_id[3]["component_id"] == 1
    assert by_id[4]["kept"] and by_id[None]["kept"] and by_id[None]["component_id"] is None
    assert by_id[8]["component_id"] == 7 and by_id[12]["kept"]
    assert neardup.near_duplicates(no_docs).count() == 0


def test_each_text_of_a_repeated_id_brings_its_links(spark):
    rows = []
    for i in range(12):
        first, second = _prose(100 + i, 80), _prose(200 + i, 80)
        near = (first if i % 2 else second) + " more"
        rows += [(i, first), (i, second), (100 + i, near), (200 + i, second + " again" if i % 3 == 0 else _prose(300 + i, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()}
    for i in range(12):
        assert {(i, i), (100 + i, i), (200 + i, i if i % 3 == 0 else 200 + i)} <= got
    assert len(got) == 36


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 130)}


# 10


@pytest.mark.parametrize("dimensions", [2, 3])
def test_curve_visits_every_cell_and_moves_one_step(spark, dimensions):
    bits = 3
    cells = spark.createDataFrame(list(itertools.product(range(8), repeat=dimensions)), [f"c{i}" for i in range(dimensions)])
    rows = cells.select("*", sharding.hilbert_index([F.col(c) for c in cells.columns], bits).alias("d")).collect()
    path = [tuple(r)[:-1] for r in sorted(rows, key=lambda r: r["d"])]
    assert sorted(r["d"] for r in rows) == list(range(8**dimensions))
    assert all(sum(abs(x - y) for x, y in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards_obey_their_law(spark, odd_docs, no_docs, law):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sizes = {"size": sharding.text_bytes(F.col("text")) + 16, "text_crc32": F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))}
    for table in (docs, odd_docs):
        rows = sharding.hilbert_shards(table, "doc_id", ["source", "lang", "n_chars"], sizes, 7, law).collect()
        assert len(rows) == table.count()
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if law == "rows":
            assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
        elif table is docs:
            held = Counter()
            for r in rows:
                held[r["shard"]] += r["size"]
            assert max(held.values()) - min(held.values()) <= 2 * max(r["size"] for r in rows)
    assert sharding.hilbert_shards(no_docs, "doc_id", ["source", "n_chars"], sizes, 7, law).count() == 0


# Pipeline


def test_pipeline_stages_keep_the_columns_and_do_their_work(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < counts[0]
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(component == i for i, (_, component) in _near(kept).items())
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert decontaminate.contaminated(docs, items).count() == 0
    whole = corpus_pipeline.run(spark, SMALL)
    assert {r["doc_id"] for r in whole.select("doc_id").distinct().collect()} == kept.keys()


def test_pipeline_takes_odd_rows(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() > 0


def test_pipeline_keeps_equal_texts_once(spark):
    texts = [_prose(300 + i, 60) for i in range(5)]
    near = texts[3] + " extra"
    rows = [
        (1, texts[0]), (1, texts[0]), (1, texts[1]), (2, texts[0]), (None, texts[0].upper()), (None, texts[2]), (None, texts[2]),
        (3, texts[3]), (4, near), (None, near), (5, texts[4]), (6, None), (None, None), (None, ""),
    ]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    got = corpus_pipeline.without_near_duplicates(spark, docs, SMALL)
    assert got.columns == docs.columns
    expected = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (3, texts[3]), (5, texts[4]), (6, None), (None, None), (None, "")]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(expected)
