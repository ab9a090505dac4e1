"""Spelling variants, hard negatives and token counts against plain versions, and their queries."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayweave.llm import negatives, queries, spelling, token_counts
from tests.oracle import connection, difference

from . import odd

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", ["op11_spelling", "op12_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connection(SF), queries.SQL[name]) is None


# --- spelling variants -------------------------------------------------------------------


def is_edit(a: str, b: str) -> bool:
    """One inserted, deleted or replaced character, from the definition."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts: dict[str, int], ratio: int) -> list[tuple]:
    forms, near = {}, {}
    for w, n in counts.items():
        others = [(-m, v) for v, m in counts.items() if is_edit(w, v)]
        near[w] = len(others)
        if others and -min(others)[0] >= ratio * n:
            forms[w] = min(others)[1]
    out = []
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, n, near[w], counts.get(forms.get(w))))
    return sorted(out, key=repr)


def variants(spark, rows, **options):
    frame = spark.createDataFrame(rows, "word string, n bigint, cls int, unit string, best string")
    return sorted(map(tuple, spelling.variants(frame, **options).collect()), key=repr)


@pytest.mark.parametrize(("letters", "block"), [("ab", 4), ("abcä\U0001f600", 1024), ("abc", 16)])
def test_variants_equal_a_plain_version(spark, letters, block):
    rng = random.Random(len(letters))
    counts = Counter()
    for _ in range(400):
        counts["".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))] += rng.choice([1, 1, 2, 7, 50, 300])
    counts["x" * 70_000] = 3
    counts["x" * 69_999 + "y"] = 15
    counts["x" * 69_999] = 2
    found = variants(spark, [(w, n, 1, "u", "b") for w, n in counts.items()], ratio=2, block=block)
    assert found == plain_variants(counts, 2)
    if block == 4:
        assert max(len({w, f, r}) for w, f, r, *_ in found) == 3  # chains of forms are met


def test_variants_of_odd_tables(spark):
    assert variants(spark, []) == []
    rows = [("word", 2, 1, "u", "b"), ("word", 3, 1, "u", "b"), ("ward", 1, 1, "u", "b"), (None, 4, 1, "u", "b"), ("", 9, 1, "u", "b"), ("wild", None, 1, "u", "b"), ("wold", 0, 1, "u", "b")]
    assert variants(spark, rows) == [("ward", "word", "word", 1, 1, 5), ("word", None, "word", 5, 1, None)]
    tied = [("cat", 10, 1, "u", "b"), ("cut", 10, 1, "u", "b"), ("cot", 1, 1, "u", "b")]
    assert ("cot", "cat", "cat", 1, 2, 10) in variants(spark, tied)
    with pytest.raises(ValueError):
        variants(spark, [], ratio=1)


def test_word_counts_equal_a_plain_version(spark):
    rows = [*odd.rows(), (12, "ÀÉîdx× ÷÷÷÷ Straße STRASSE straße naïveté_naïveté ŒUVREœuvre", "en", "a", 3, 1, "p", 2, 0.5, "r", 3, "f", "c", 4, "l", "", 5, 6, 7, "k", 8, 9)]
    want = Counter()
    for doc_id, text, *_ in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 3 == 0 else run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 4 and n >= 2}
    found = spelling.word_counts(odd.docs(spark, rows), least_length=4, least_count=2, slip=3)
    assert {r.word: r.n for r in found.collect()} == want and want
    assert spelling.word_counts(odd.empty(spark)).count() == 0


# --- hard negatives ----------------------------------------------------------------------


def plain_negatives(rows, anchor, positives, negatives_, share):
    """By sorting all rows for each anchor."""
    out = []
    last = 1 << 63

    def score(a, b):
        return int(sum(x * y for x, y in zip(a, b)))

    def order(item):
        return -item[0], last if item[1] is None else item[1]

    for i, (a_id, a_label, a) in enumerate(rows):
        if not anchor(a_id):
            continue
        scored = [(score(a, v), v_id, label) for j, (v_id, label, v) in enumerate(rows) if j != i]
        for p_score, p_id, _ in sorted((s for s in scored if s[2] == a_label), key=order)[:positives]:
            due = [s for s in scored if s[2] != a_label and share[0] * p_score <= share[1] * s[0] <= share[1] * p_score]
            for rank, (n_score, n_id, _) in enumerate(sorted(due, key=order)[:negatives_], 1):
                out.append((a_id, p_id, rank, n_id, p_score, n_score))
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, label bigint, vector array<double>, key int, grp int")
    return sorted(map(tuple, negatives.hard_negatives(frame, **options).collect()), key=repr)


@pytest.mark.parametrize(("dims", "spread"), [(3, 2), (20, 30), (64, 100)])
def test_negatives_equal_a_plain_version(spark, dims, spread):
    rng = np.random.default_rng(dims)
    centre = rng.integers(-spread, spread, (4, dims))
    rows = []
    for i in range(160):
        label = int(rng.integers(4))
        vector = np.round(centre[rng.integers(4) if i % 5 == 0 else label] + rng.normal(0, spread / 3, dims))
        rows.append((i, label, vector[: dims - (i % 7 == 3)].tolist()))
    rows += [rows[7], (7, 1, rows[8][2]), (None, 2, rows[9][2]), (20, 3, []), (10, 0, [0.0] * dims)]
    want = plain_negatives(rows, lambda i: i is not None and i % 10 == 0, 3, 4, (80, 100))
    options = {"is_anchor": F.col("vec_id") % 10 == 0, "positives": 3, "negatives": 4}
    assert mined(spark, rows, **options) == want and len(want) > 20
    assert mined(spark, rows, **options, block=7, anchors_per_group=4, levels=(8, 1)) == want


def test_negatives_of_odd_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 2, [5.0])]) == []  # no positive
    assert mined(spark, [(0, 1, [2.0]), (1, 1, [-3.0]), (2, 2, [-3.0])]) == []  # a positive below zero has no room below it
    assert mined(spark, [(0, 1, [0.0]), (1, 1, [3.0]), (2, 2, [4.0])]) == [(0, 1, 1, 2, 0, 0)]
    big = float(1 << 31)
    assert mined(spark, [(0, 1, [big, 1.0]), (1, 1, [big, 3.0]), (2, 2, [big, 2.0])]) == [(0, 1, 1, 2, 2**62 + 3, 2**62 + 2)]
    with pytest.raises(Exception, match="40 bits"):
        mined(spark, [(0, 1, [2.0**50]), (1, 1, [1.0])])
    with pytest.raises(ValueError, match="whole segments"):
        mined(spark, [], levels=(3, 2))


def test_usable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001], 3), (7, [1.0], 9), (None, [1.0], 9), (2, None, 1), (3, [1.0], None), (4, [1.0, None], 1), (5, [nan], 1), (6, [-inf], 1), (14, [], 4)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    found = {(r.vec_id, r.label, tuple(r.vector)) for r in negatives.usable(frame).collect()}
    assert found == {(1, 3, (128.0, -1.0)), (7, 0, (256.0,)), (None, 9, (256.0,)), (14, 5, ())}


@given(st.lists(st.lists(st.integers(-1000, 1000), min_size=8, max_size=8), min_size=2, max_size=6), st.sampled_from([1, 1000, 10**6]))
@settings(max_examples=150, deadline=None)
def test_bounds_hold_scores(vectors, factor):
    rows = np.array(vectors, np.float64) * factor
    v = negatives.Vectors(rows, *negatives.summaries(rows, (8, 4, 2, 1)))
    exact = rows @ rows.T
    widths = []
    for level in range(4):
        low, high = negatives.bounds(v, v, level)
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).sum())
    assert all(b <= a * 1.001 + 100 for a, b in zip(widths, widths[1:]))  # levels refine


def test_bounds_rule_rows_out():
    rng = np.random.default_rng(0)
    rows = np.repeat(rng.integers(-90, 90, (300, 8)), 8, axis=1) + rng.integers(-9, 9, (300, 64))
    v = negatives.Vectors(rows.astype(float), *negatives.summaries(rows.astype(float), (16, 8)))
    low = np.sort(rows @ rows.T, axis=1)[:, -10].astype(float)
    scored = []
    exact, negatives.exact_scores = negatives.exact_scores, lambda a, b, i, j: scored.append(len(i)) or exact(a, b, i, j)
    try:
        i, j, _ = negatives.between(v, v, np.ones((300, 300), bool), low, np.full(300, np.inf))
    finally:
        negatives.exact_scores = exact
    assert len(i) >= 3000 and scored[0] < 0.2 * 300 * 300


# --- token counts ------------------------------------------------------------------------


@lru_cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def expected(texts) -> list[int]:
    return [len(e.ids) for e in library().encode_batch(list(texts), add_special_tokens=False)]


@lru_cache
def compiled() -> token_counts.Counter:
    return token_counts.Counter(TOKENIZER)


PARTS = ["a", "s", "t", "'", "'s", "'re", "'ll", "'ve", " ", "  ", "\n", "\t ", "1", "23", "é", "東京", "!", "..", "-" * 40, "e", "r", "v", "l", "m", "d", "\U0001f642", "́", "ñ", "<|endoftext|>", "<|endof", "text|>", "the", "ing", "\x85", "\x1c", "٣", "　", "ſ", "A", "\x00"]


@given(st.lists(st.text(max_size=30) | st.lists(st.sampled_from(PARTS), max_size=30).map("".join), max_size=12))
@settings(max_examples=300, deadline=None)
def test_counts_equal_the_library(texts):
    assert compiled()(texts).tolist() == expected(texts)


def test_counts_of_many_and_long_pieces():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(0, 400))) for _ in range(300)]
    texts += [c * n for c in "-a= \n0東" for n in (0, 1, 2, 3, 17, 127, 128, 129, 255, 256, 257, 1000, 5001)]
    texts += ["ab" * 30_000, "x" * 50_000, odd.LONG, "=" * 100 + "-" * 200]
    want = expected(texts)
    assert compiled()(texts).tolist() == want
    small = token_counts.Merger({bytes([b]): b for b in range(256)} | {t: 0 for t in compiled().merger.made}, list(compiled().merger.rank), states=50)
    whole, kept = compiled(), compiled().merger
    try:  # a table that is emptied all the time counts the same
        whole.merger = small
        assert whole(texts[:40]).tolist() == want[:40] and whole(texts[-4:]).tolist() == want[-4:]
    finally:
        whole.merger = kept


def test_documents_count_like_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.op13_token_counts(spark, SF).collect()}
    want = expected([r.text or "" for r in docs])
    assert [found[r.doc_id].n_tokens for r in docs] == want
    assert all(found[r.doc_id].over_limit == (n > 1024) and found[r.doc_id].n_bytes == len((r.text or "").encode()) for r, n in zip(docs, want))


@given(st.lists(st.integers(0, len(token_counts.CLASSES) - 1), max_size=60), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_chunk_maps_compose_to_one_pass(classes, chunk):
    border = token_counts.CLASSES.index("border")
    classes = np.array([border, *classes, border], np.uint8)
    split = token_counts.Splitter()
    state, starts = 0, set()
    for i, c in enumerate(classes.tolist()):
        begun = int(split.begun[c, state])
        starts |= ({i} if begun & 1 else set()) | ({i - 1} if begun & 2 else set())
        state = int(split.step[c, state])
    assert split(classes, chunk).tolist() == sorted(starts)


def test_character_classes_are_the_librarys():
    split = library().pre_tokenizer.pre_tokenize_str
    names = np.array(token_counts.CLASSES)[compiled().classes]
    for c in [*range(0x300), *(c for c in range(0x300, 0x110000, 97) if not 0xD800 <= c < 0xE000), 0x1C89, 0x31350, 0x16D40]:
        kinds = [k for k, x in (("letter", "a"), ("number", "1"), ("other", "!")) if len(split(x + chr(c) + x)) == 1]
        name = {"stmd": "letter", "r": "letter", "v": "letter", "l": "letter", "e": "letter", "apostrophe": "other", "blank": "white"}.get(names[c], names[c])
        assert name == (kinds[0] if kinds else "white"), hex(c)


def test_long_texts_are_cut_where_pieces_begin():
    text = "one 's two  three\n four " * 50 + "<|endoftext|> end"
    parts = token_counts.cut(text, 40)
    assert "".join(parts) == text and len(parts) > 10
    assert sum(expected(parts)) == expected([text])[0] == int(compiled()(parts).sum())
    assert token_counts.cut("x" * 100, 10) == ["x" * 100]


def test_token_counts_of_odd_tables(spark):
    docs = odd.docs(spark).withColumn("n_tokens", F.lit("clash"))
    found = token_counts.count_tokens(docs, TOKENIZER)
    assert sorted(found.columns) == sorted(docs.columns)
    want = sorted((str(r[0]), r[1] or "", n) for r, n in zip(odd.rows(), expected([r[1] or "" for r in odd.rows()])))
    assert sorted((str(r.doc_id), r.text or "", r.n_tokens) for r in found.collect()) == want
    assert token_counts.count_tokens(odd.empty(spark), TOKENIZER, keep_text=False).columns == [c for c in odd.docs(spark).columns if c != "text"] + ["n_tokens"]
    assert token_counts.count_tokens(odd.empty(spark), TOKENIZER).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Counter(public_tokenizers.path("word_bpe_49k.json"))
