"""SimHash, near copies, decontamination and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayweave.llm import common, decontaminate, recompression, simhash
from assayweave.llm.textnp import words

from . import odd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width):
    own = WORD.findall(lowered(text))
    return [" ".join(own[i : i + width]) for i in range(max(1, len(own) - width + 1))] if own else []


def plain_fingerprint(text):
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, 3)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(50)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in common.connected_components(df, salts=3).collect()}
    want = components(400, edges)
    assert got == {n: want[n] for n in {x for e in edges if e[0] != e[1] for x in e}}
    assert common.connected_components(df.limit(0)).count() == 0


@pytest.mark.parametrize(("most", "budget"), [(1 << 16, 3), (5, 3), (3, 2), (4, 1)])
def test_links_connect_all_fingerprints_within_the_budget(spark, most, budget):
    rng = random.Random(most + budget)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = set(base)
    for b in base:
        for _ in range(15):
            x = b
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4, 6])):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    pairs = simhash.links(df, budget, most).collect()
    at = {x: i for i, x in enumerate(fps)}
    near = [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= budget]
    assert components(len(fps), [(at[r.a], at[r.b]) for r in pairs]) == components(len(fps), near)


def test_trie_pairs_are_all_pairs():
    rng = np.random.default_rng(3)
    rest = np.sort(rng.integers(0, 64, 40).astype(np.uint64))
    got = sorted(tuple(sorted(p)) for a, b in simhash.trie_pairs(np.zeros(40, np.int64), rest, 6, 2) for p in zip(a.tolist(), b.tolist()))
    want = sorted((i, j) for i in range(40) for j in range(i + 1, 40) if int(rest[i] ^ rest[j]).bit_count() <= 2)
    assert got == want


def test_near_duplicates_of_odd_rows(spark):
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd.docs(spark)).collect())
    texts = [(r[0], r[1]) for r in odd.rows()]
    fps = [plain_fingerprint(t) for _, t in texts]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    label = components(len(fps), near)
    least = {c: min((i for (i, _), d in zip(texts, label) if d == c and i is not None), default=None) for c in label}
    want = sorted((i if i is not None else -1, f"{f:016x}", least[c]) for (i, _), f, c in zip(texts, fps, label))
    assert got == want
    assert simhash.near_duplicates(odd.empty(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    of = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    got = kept.collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, c in of.items() if d == c) and len(got) < len(of)
    texts = {r.doc_id: r.text for r in df.collect()}
    assert all(r.text == texts[r.doc_id] for r in got)


def test_groups_of_odd_rows(spark):
    kept = simhash.deduplicate(odd.docs(spark).withColumn("number", F.lit("clash")))
    assert kept.columns == [*odd.docs(spark).columns, "number"]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in kept.collect())
    # 1 and 2 are copies, 3 to 5 have no words, 8 has two rows of one text and one of another, 10 is a word longer than 1
    assert [g[0] for g in got] == [-1, 1, 3, 6, 7, 8, 8, 9, 10, 9007199254740993]
    assert simhash.deduplicate(odd.empty(spark)).count() == 0


def items_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string, doc_id int, n_item string")


@pytest.mark.parametrize("block_chars", [8_000_000, 60])
def test_containment_equals_brute_force(spark, block_chars):
    rng = random.Random(9)
    vocabulary = [f"V{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 9, 20, 40])))) for i in range(12)] + [(50, None), (51, "  "), (52, "V1 v2")]
    docs = []
    for d in range(40):
        own = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 30, 200]))]
        if d % 2:
            piece = rng.choice(items[:12])[1].lower().split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                piece[rng.randrange(len(piece))] = "changed"
            own[len(own) // 2 : len(own) // 2] = piece
        docs.append((d, " ".join(own)))
    docs += [(100, None), (101, ""), (102, "v1 V2"), (102, "v1 V2")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, item_id string")
    want = []
    for d, t in docs:
        own = set(shingles(t, 5))
        for i, item in items:
            wanted = set(shingles(item, 5))
            if wanted and len(own & wanted) >= 0.8 * len(wanted):
                want.append((d, i, len(wanted), len(own & wanted)))
    frame = items_frame(spark, [(*i, 1, "n") for i in items])
    got = decontaminate.contained_items(df, frame, block_chars=block_chars).collect()
    assert sorted((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got) == sorted(want) and want
    kept = decontaminate.decontaminate(df, frame, block_chars=block_chars)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in {w[0] for w in want})


def test_containment_of_odd_and_empty_tables(spark):
    items = items_frame(spark, [(1, "ONE two three four five six seven", 1, "n"), (2, None, 1, "n")])
    found = decontaminate.contained_items(odd.docs(spark), items).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 10] and {r.containment for r in found} == {1.0}
    assert decontaminate.contained_items(odd.empty(spark), items).count() == 0
    assert decontaminate.contained_items(odd.docs(spark), items.limit(0)).count() == 0
    assert decontaminate.decontaminate(odd.docs(spark), items).count() == len(odd.rows()) - 3


@given(size=st.integers(1, 300), threshold=st.sampled_from([0.5, 0.8, 0.9, 1.0]))
@settings(max_examples=60, deadline=None)
def test_a_sketch_cannot_be_missed(size, threshold):
    import math

    missing = size - math.ceil(threshold * size)
    assert missing < decontaminate.sketch_length(size, threshold) <= size


def removed_by_rule(rows, window):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), []
    for i in order:
        own = WORD.findall(rows[i][1] or "")
        gone = [False] * len(own)
        for at in range(len(own) - window + 1):
            key = tuple(own[at : at + window])
            if key in seen:
                gone[at : at + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        out.append((rows[i][0] if rows[i][0] is not None else -1, len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted(
        (r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in df.collect()
    )


@pytest.mark.parametrize(("window", "rounds", "chunks"), [(20, 3, 5), (6, 2, 3), (4, 3, 1), (20, 1, 4)])
def test_repeats_equal_brute_force(spark, window, rounds, chunks):
    rng = random.Random(window)
    passages = [[rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.choice([5, 25, 60]))] for _ in range(5)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.choice([0, 1, 3])):
            own += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(12))]
            kind = rng.random()
            own += rng.choice(passages) if kind < 0.5 else ["la"] * rng.randrange(60) if kind < 0.7 else ["la", "lo", "li"] * rng.randrange(15) if kind < 0.8 else []
        rows.append((i if i % 7 else i // 2, " ".join(own) if own else rng.choice([None, "", " "])))
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, chunk int")
    assert result(recompression.without_repeats(df, window, rounds, chunks)) == removed_by_rule(rows, window)


def test_repeats_in_odd_rows(spark):
    assert result(recompression.without_repeats(odd.docs(spark))) == removed_by_rule([r[:2] for r in odd.rows()], 20)
    assert recompression.without_repeats(odd.empty(spark)).count() == 0


def test_rows_of_one_id_are_many_chunks(spark, monkeypatch):
    """A third of the rows have no id and another third are equal; neither is one chunk, and the result is that of the rule."""
    monkeypatch.setattr(recompression, "CHUNK_BYTES", 2000)
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(30))

    def own(i: int) -> str:
        return " ".join(f"w{i}x{rng.randrange(9)}" for _ in range(25))

    rows = [(None, f"{own(i)} {passage if i % 3 == 0 else own(i + 1000)}") for i in range(60)]
    rows += [(7, passage + " end")] * 60
    rows += [(100 + i, f"{own(i + 2000)} {passage}" if i % 4 == 0 else own(i + 3000)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    bounds = recompression._chunk_bounds(df.withColumn("doc_id", F.coalesce("doc_id", F.lit(common.FIRST_KEY))), 4)
    assert sum(b[0] == common.FIRST_KEY for b in bounds) > 3 and sum(b[0] == 7 for b in bounds) > 3
    assert result(recompression.without_repeats(df, 20, 3)) == removed_by_rule(rows, 20)


@given(st.lists(st.sampled_from(["a", "b", "ab", "c"]), max_size=80), st.integers(0, 20))
@settings(max_examples=150, deadline=None)
def test_equal_windows_have_equal_anchors(own, gap):
    """Anchors depend on the window alone, wherever it stands."""
    text = " ".join([*own, *["x"] * gap, *own])
    w = words([text])
    starts, name, place = recompression.anchors(w, 8, 3)
    tokens = text.split()
    found = {}
    for s, n, p in zip(starts.tolist(), name.tolist(), place.tolist()):
        key = tuple(tokens[s : s + 8])
        offset = (n, p - s) if p >= 0 else None
        assert found.setdefault(key, offset) == offset
