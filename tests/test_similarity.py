"""The similarity joins against brute force, with copies, hot elements and blocks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from assayweave.operators import marts, similarity

WIDTH = 128


def jaccard(a, b):
    shared = len(a & b)
    return shared / (len(a) + len(b) - shared) if a or b else 0.0


def random_sets(seed: int, n: int = 60, width: int = WIDTH) -> dict[int, set[int]]:
    rng = random.Random(seed)
    out: dict[int, set[int]] = {}
    for i in range(n):
        kind = rng.random()
        if out and kind < 0.25:  # exact copy
            out[i] = set(rng.choice(list(out.values())))
        elif out and kind < 0.6:  # near copy
            base = set(rng.choice(list(out.values())))
            for _ in range(rng.randint(1, 3)):
                base ^= {rng.randrange(width)}
            out[i] = base
        else:
            out[i] = set(rng.sample(range(width), rng.randint(0, 20))) | {7}  # 7 is a hot bit
    out[n] = set()
    out[n + 1] = set()
    return out


def frame(spark, sets):
    rows = [(i, sorted(s)) for i, s in sets.items()]
    return spark.createDataFrame(rows, "id bigint, bits array<int>").repartition(3)


def entity_pairs(spark, df, threshold, universe, block_rows):
    sets = similarity.distinct_sets(df, "bits", universe)
    pairs = similarity.similar_classes(sets, threshold, universe, block_rows).collect()
    return sorted((min(r["cls_a"], r["cls_b"]), max(r["cls_a"], r["cls_b"]), r["similarity"]) for r in pairs)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.75, 0.9, 1.0])
@pytest.mark.parametrize("universe,block_rows", [(WIDTH, 4096), (None, 4096), (WIDTH, 3), (None, 3)])
def test_similar_classes_equal_brute_force(spark, threshold, universe, block_rows):
    sets = random_sets(int(threshold * 100))
    df = frame(spark, sets)
    names = {
        tuple(r["bits"]): r["cls"] for r in df.select("bits", similarity.set_class("bits").alias("cls")).collect()
    }
    distinct = sorted({tuple(sorted(s)) for s in sets.values() if s})
    expected = []
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            t = jaccard(set(a), set(b))
            if t >= threshold:
                expected.append((*sorted((names[a], names[b])), t))
    assert entity_pairs(spark, df, threshold, universe, block_rows) == sorted(expected)


@pytest.mark.parametrize("delta", [0.0, 0.1, 0.5, 1.0])
@pytest.mark.parametrize("block_rows", [2, 4096])
def test_cliffs_equal_brute_force(spark, delta, block_rows):
    sets = random_sets(5, 40)
    rng = random.Random(9)
    rows = [
        (g, i, round(rng.uniform(4, 6), 1), sorted(s)) for i, s in sets.items() for g in ("x", "y") if rng.random() < 0.8
    ]
    df = spark.createDataFrame(rows, "grp string, id bigint, v double, bits array<int>")
    members = df.where(F.size("bits") > 0).select("grp", "id", "v", similarity.set_class("bits").alias("cls"))
    pairs = similarity.class_pairs(frame(spark, sets), "bits", 0.6, WIDTH, block_rows)
    found = similarity.cliffs_of_pairs(members, pairs, "grp", "id", "v", delta, block_rows)
    actual = sorted(
        (r["grp"], r["a"]["id"], r["b"]["id"], r["similarity"], r["delta"]) for r in found.collect()
    )
    expected = []
    for g, i, v, s in rows:
        for h, j, w, u in rows:
            t = jaccard(set(s), set(u))
            if g == h and i < j and t >= 0.6 and abs(v - w) >= delta:
                expected.append((g, i, j, t, abs(v - w)))
    assert actual == sorted(expected)


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_neighbors_all_equal_brute_force(spark, k):
    sets = random_sets(11, 50)
    found = similarity.nearest_neighbors_all(frame(spark, sets), "id", "bits", k, 0.4, WIDTH, 5)
    actual = sorted((r["id"], r["rank"], r["neighbor"], r["similarity"]) for r in found.collect())
    expected = []
    for i, a in sets.items():
        near = sorted((-jaccard(a, b), j) for j, b in sets.items() if j != i and a and b and jaccard(a, b) >= 0.4)
        expected += [(i, r + 1, j, -t) for r, (t, j) in enumerate(near[:k])]
    assert actual == sorted(expected)


def test_containing_sets_equal_brute_force(spark):
    sets = random_sets(3)
    queries = {0: {7}, 1: set(sorted(sets[4])[:3]), 2: {7, 999}, 3: set()}
    q = spark.createDataFrame([(i, sorted(s)) for i, s in queries.items()], "q bigint, want array<int>")
    found = similarity.containing_sets(frame(spark, sets), "id", "bits", q, "q", "want")
    expected = sorted((i, j) for i, w in queries.items() for j, s in sets.items() if w and w <= s)
    assert sorted((r["q"], r["id"]) for r in found.collect()) == expected


def test_threshold_zero_is_refused(spark):
    with pytest.raises(ValueError):
        similarity.similar_classes(frame(spark, {0: {1}}), 0.0)


def test_golden_cliffs(spark):
    """A cliff (T 0.885, delta 2.5, SALI 21.7), an identical pair, and a dissimilar one."""
    a, b = set(range(24)), set(range(1, 26))  # 23 shared of 26
    rows = [
        (6, "M6", sorted(a), "s"),
        (7, "M7", sorted(b), None),
        (8, "M8", [100, 101], "r"),
        (9, "M9", [100, 101], "r"),
        (4, "M4", [50, 51, 52], None),
        (5, "M5", [52, 53, 54], None),
    ]
    fp = spark.createDataFrame(
        rows, "compound_key bigint, molecule_chembl_id string, ecfp4_onbits array<int>, murcko_scaffold_smiles string"
    )
    sar = spark.createDataFrame(
        [(1, 6, 8.0), (1, 7, 5.5), (1, 8, 7.5), (1, 9, 6.0), (1, 4, 9.0), (1, 5, 5.0)],
        "target_key bigint, compound_key bigint, median_pchembl double",
    )
    targets = spark.createDataFrame([(1, "Tubulin")], "target_key bigint, pref_name string")
    out = {r["compound_key_a"]: r for r in marts.activity_cliff(sar, fp, targets).collect()}
    assert sorted(out) == [6, 8]
    assert (out[6]["tanimoto"], out[6]["delta_pchembl"], out[6]["sali"]) == (0.885, 2.5, 21.67)
    assert out[6]["is_identical_fp"] is False and out[6]["same_scaffold"] is None
    assert out[8]["is_identical_fp"] is True and out[8]["sali"] is None and out[8]["same_scaffold"] is True


def test_hot_copies_do_not_blow_up(spark):
    """4000 copies of one set with equal values: no pairs are formed among them."""
    df = spark.range(4000).select(
        F.lit("g").alias("grp"), "id", F.when(F.col("id") == 0, 9.0).otherwise(5.0).alias("v"), F.expr("array(1, 2, 3)").alias("bits")
    )
    members = df.select("grp", "id", "v", similarity.set_class("bits").alias("cls"))
    pairs = similarity.class_pairs(df, "bits", 0.75, 64, 100)
    found = similarity.cliffs_of_pairs(members, pairs, "grp", "id", "v", 1.0, 100)
    assert found.count() == 3999


@pytest.mark.parametrize("threshold,delta", [(0.3, 0.5), (0.6, 1.0), (0.6, 0.0)])
@pytest.mark.parametrize("universe", [64, None])
def test_group_pairs_give_the_cliffs_of_all_pairs(spark, threshold, delta, universe):
    """Few bits at a low threshold, copies, NULL groups and values, sets without members."""
    sets = random_sets(21, 50, 64)
    rng = random.Random(4)
    rows = [
        (rng.choice(["x", "y", None]), i, rng.choice([4.0, 4.4, 5.0, 6.1, None]), sorted(s))
        for i, s in sets.items()
        for _ in range(rng.randint(0, 3))
    ]
    df = spark.createDataFrame(rows, "grp string, id bigint, v double, bits array<int>")
    members = df.where(F.size("bits") > 0).select("grp", "id", "v", similarity.set_class("bits").alias("cls"))
    out = []
    for pairs in (
        similarity.group_pairs(frame(spark, sets), "bits", threshold, members, "grp", "v", delta, universe, 4),
        similarity.class_pairs(frame(spark, sets), "bits", threshold, universe, 4),
    ):
        found = similarity.cliffs_of_pairs(members, pairs, "grp", "id", "v", delta, 4).collect()
        out.append(sorted((r["grp"], *sorted([tuple(r["a"]), tuple(r["b"])]), r["similarity"], r["delta"]) for r in found))
    assert out[0] == out[1] and out[0]


def test_sets_that_share_few_rare_elements_are_not_fetched(spark, monkeypatch):
    """Each two of these share a rare element within their prefixes, but no two are similar."""
    own = lambda i: {f"p{min(i, j)}-{max(i, j)}" for j in range(30) if j != i}
    rows = [(i, sorted(own(i) | {f"common{k}" for k in range(71)})) for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, words array<string>")
    written = {}
    kept = similarity.materialize

    def materialize(frame, purpose):
        written[purpose] = kept(frame, purpose)
        return written[purpose]

    monkeypatch.setattr(similarity, "materialize", materialize)
    assert similarity.similar_classes(similarity.distinct_sets(df, "words"), 0.75).count() == 0
    assert written["prefixes"].count() > 0 and written["candidates"].count() == 0


@pytest.mark.parametrize("threshold,delta", [(0.3, 0.5), (0.5, 0.3), (0.6, 0.0), (1.0, 1.0)])
@pytest.mark.parametrize("block_rows", [1, 4096])
def test_cliffs_in_tiles_equal_brute_force(spark, threshold, delta, block_rows):
    """Several tiles or one; copies, NULL groups and values, sets without members."""
    sets = random_sets(23, 60, 64)
    rng = random.Random(6)
    rows = [
        (rng.choice(["x", "y", "z", None]), 10 * i + k, rng.choice([4.0, 4.4, 4.5, 5.0, 6.1, None]), sorted(s), rng.choice(["q", None]))
        for i, s in sets.items()
        for k in range(rng.randint(0, 3))
    ]
    df = spark.createDataFrame(rows, "grp string, id bigint, v double, bits array<int>, more string")
    members = df.where(F.size("bits") > 0).select("grp", "id", "v", "more", similarity.set_class("bits").alias("cls"))
    packed = similarity.distinct_sets(frame(spark, sets), "bits", 64)
    found = similarity.cliffs_in_tiles(members, packed, threshold, 64, "grp", "id", "v", delta, block_rows).collect()
    expected = []
    for g, i, v, s, m in rows:
        for h, j, w, u, o in rows:
            t = jaccard(set(s), set(u))
            if g is not None and g == h and i < j and None not in (v, w) and t >= threshold and abs(v - w) >= delta:
                expected.append((g, t, (i, v, m), (j, w, o), abs(v - w)))
    told = [(r["grp"], r["similarity"], tuple(r["a"]), tuple(r["b"]), r["delta"]) for r in found]
    assert sorted(told, key=repr) == sorted(expected, key=repr) and told


def test_cliffs_of_few_bits_score_members_of_a_group_only(spark, monkeypatch):
    """Compounds of other targets do not meet: before, all classes met in blocks."""
    rng = random.Random(8)
    fp = [(i, f"M{i}", sorted(rng.sample(range(64), 32)), "s") for i in range(60)]
    fp += [(60 + i, f"M{60 + i}", fp[i][2], "s") for i in range(5)]
    prints = spark.createDataFrame(
        fp, "compound_key bigint, molecule_chembl_id string, ecfp4_onbits array<int>, murcko_scaffold_smiles string"
    )
    sar = [(i % 3, i, rng.choice([4.0, 4.6, 5.3])) for i in range(65)]
    measured = spark.createDataFrame(sar, "target_key bigint, compound_key bigint, median_pchembl double")
    monkeypatch.setattr(similarity, "_meet", lambda *_: pytest.fail("all classes meet"))
    found = marts.cliff_pairs(measured, prints, 0.3, 0.5, 64).collect()
    bits = {i: set(b) for i, _, b, _ in fp}
    expected = [
        (g, i, j, jaccard(bits[i], bits[j]))
        for g, i, v in sar
        for h, j, w in sar
        if g == h and i < j and abs(v - w) >= 0.5 and jaccard(bits[i], bits[j]) >= 0.3
    ]
    assert sorted((r["target_key"], r["a"]["compound_key"], r["b"]["compound_key"], r["similarity"]) for r in found) == sorted(expected)
    wrong = prints.withColumn("ecfp4_onbits", F.expr("array(1, 70)"))
    with pytest.raises(Exception, match="not in"):
        marts.cliff_pairs(measured, wrong, 0.3, 0.5, 64)


@pytest.mark.parametrize("threshold", [0.3, 0.6, 1.0])
def test_token_sets_meet_in_blocks_and_are_scored_in_parts(spark, monkeypatch, threshold):
    """Families of near copies, NULL elements, many blocks and parts; before, every meeting in a word was sent as a pair."""
    monkeypatch.setattr(similarity, "_meet", lambda *_: pytest.fail("meetings are sent"))
    monkeypatch.setattr(similarity, "MEETINGS", 40)
    monkeypatch.setattr(similarity, "TOLD", 5)
    rng = random.Random(12)
    words = lambda s: sorted(f"w{e}" if e else "" for e in s)
    sets = random_sets(31, 90, 400)
    family = set(range(40, 70))
    sets |= {200 + i: family ^ {rng.randrange(400)} ^ {rng.randrange(400)} for i in range(40)}
    rows = [(i, words(s) + ([None] if i % 9 == 0 else [])) for i, s in sets.items()]
    df = spark.createDataFrame(rows, "id bigint, words array<string>")
    names = {tuple(r["words"]): r["cls"] for r in df.select("words", similarity.set_class("words").alias("cls")).collect()}
    # A class is a text of elements, which leaves NULL out: one row of each.
    distinct = list({names[tuple(w)]: (w, names[tuple(w)]) for _, w in rows if w}.values())
    frame_ = spark.createDataFrame([(w,) for w, _ in distinct], "words array<string>")
    expected = []
    for i, (a, x) in enumerate(distinct):
        for b, y in distinct[i + 1 :]:
            t = jaccard(set(a), set(b))
            if t >= threshold:
                expected.append((*sorted((x, y)), t))
    for block_rows in (1, 4096):
        pairs = similarity.similar_classes(similarity.distinct_sets(frame_, "words"), threshold, None, block_rows).collect()
        assert sorted((r["cls_a"], r["cls_b"], r["similarity"]) for r in pairs) == sorted(expected)
    assert expected or threshold == 1.0


def test_a_size_block_meets_all_blocks_of_sizes_that_can_be_similar():
    counts = {1: 3, 2: 40, 3: 1, 4: 2, 7: 9, 8: 5, 30: 1}
    for threshold in (0.3, 0.75, 1.0):
        cut = similarity._size_blocks(counts, threshold, 10)
        at = {n: int((cut["size"] <= n).sum()) - 1 for n in counts}
        of = {n: range(int(cut["first"][k]), int(cut["first"][k] + cut["blocks"][k])) for n, k in at.items()}
        assert len(of[2]) == 4
        for a in counts:
            for b in counts:
                if a <= b and a >= threshold * b:
                    assert all(cut["from"][y] <= x <= cut["to"][y] and cut["from"][x] <= y <= cut["to"][x] for x in of[a] for y in of[b])
