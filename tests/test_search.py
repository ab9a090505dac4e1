"""Search structures: the popcount index, containment by signatures, and dumps that one task inflates."""

from __future__ import annotations

import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayweave.operators import fingerprints, neighbors, serving, similarity
from assayweave.sources import mapping

NBITS = 128


def prints(rng, n):
    """Hex fingerprints of all sizes, with copies, near copies, empty and missing ones."""
    out = []
    for i in range(n):
        bits = set(rng.sample(range(NBITS), rng.choice([1, 5, 20, 60, 110])))
        if i % 3 == 0 and out:
            bits = {b for b in out[rng.randrange(len(out))] or {1} if rng.random() > 0.1}
        out.append(None if i % 17 == 5 else bits)
    return out


def hexed(bits):
    return None if bits is None else "".join(f"{int(''.join('1' if 4 * i + j in bits else '0' for j in range(4)), 2):x}" for i in range(NBITS // 4))


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    sets = prints(random.Random(1), 400)
    rows = [(i, f"M{i * 7919 % 1000:03d}", hexed(s)) for i, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "compound_key int, molecule_chembl_id string, ecfp4_hex string")
    path = str(tmp_path_factory.mktemp("index") / "popcount")
    return sets, rows, table, neighbors.write_popcount_index(table, path, nbits=NBITS)


@pytest.mark.parametrize(("k", "least", "own"), [(1, 0.0, True), (10, 0.0, False), (10, 0.6, False), (400, 0.0, True), (7, 0.25, False)])
def test_the_index_finds_what_brute_force_finds(spark, indexed, k, least, own):
    sets, rows, _, index = indexed
    for q in (0, 3, 5, 9, 100, 399):

        def like(a, b):
            return len(a & b) / len(a | b) if a and b else 0.0

        scored = [(r[0], r[1], like(sets[q], s)) for r, s in zip(rows, sets) if own or r[0] != q]
        want = sorted((s for s in scored if s[2] >= least), key=lambda s: (-s[2], s[1]))[:k]
        found = neighbors.nearest_in_index(index, index.where(F.col("compound_key") == q), k, least, exclude=None if own else q, nbits=NBITS)
        assert list(map(tuple, found.orderBy(F.desc("similarity"), "molecule_chembl_id").collect())) == want
    assert neighbors.nearest_in_index(index, index.limit(0), 3).count() == 0


def test_rings_cover_every_count_once():
    for own in range(0, 40):
        for least in (0.0, 0.2, 0.5, 0.77, 1.0):
            seen = []
            for bound, ranges in neighbors.rings(own, least, 64):
                for low, high in ranges:
                    seen += range(low, high + 1)
                best = [min(own, n) / max(own, n) if own and n else 0.0 for n in range(65) if n not in seen]
                assert max(best, default=0.0) <= bound
            assert len(seen) == len(set(seen))
            assert {n for n in range(65) if (min(own, n) / max(own, n) if own and n else 0.0) >= least} <= set(seen)


def test_the_count_reaches_the_scan(spark, indexed):
    index = indexed[3]
    plan = index.where(F.col("n_bits").between(50, 60))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(n_bits,50)" in plan and "LessThanOrEqual(n_bits,60)" in plan


def test_serving_by_index_equals_serving_by_scan(spark, indexed):
    _, rows, table, index = indexed
    catalog = spark.createDataFrame([(r[0], f"n{r[0]}", r[0] / 10, "T") for r in rows[::2]], "compound_key int, pref_name string, best_pchembl double, best_target string")
    for key in (4, 5, 7777):
        scan = serving.nearest_neighbors(key, table, catalog, 8, 0.1, nbits=NBITS).collect()
        assert serving.nearest_neighbors(key, table, catalog, 8, 0.1, nbits=NBITS, index=index).collect() == scan


# --- containment -------------------------------------------------------------------------


@pytest.mark.parametrize("block_rows", [4096, 8])
def test_containment_equals_brute_force(spark, block_rows):
    rng = random.Random(block_rows)
    words = [f"w{i}" for i in range(60)]
    sets = [(i, sorted({*rng.sample(words, rng.choice([0, 1, 4, 30])), *(["hot"] if i % 3 == 0 else [])})) for i in range(150)] + [(900, None)]
    queries = [(q, rng.sample(words, rng.choice([1, 2, 3]))) for q in range(40)]
    queries += [(100, ["hot"]), (101, ["hot", "w1"]), (102, ["hot", "nowhere"]), (103, []), (104, None), (105, ["w1", "w1"]), (106, ["w2", None])]
    df = spark.createDataFrame(sets, "id int, have array<string>")
    asked = spark.createDataFrame(queries, "q int, want array<string>")
    got = sorted(map(tuple, similarity.containing_sets(df, "id", "have", asked, "q", "want", block_rows).collect()))
    want = sorted((q, i) for q, w in queries if w and None not in w for i, h in sets if h is not None and set(w) <= set(h))
    assert got == want and len(want) > 100


def test_signatures_of_subsets_are_subsets(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(50):
        whole = [f"e{rng.randrange(500)}" for _ in range(40)]
        rows.append((whole, whole[: rng.randrange(40)]))
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    of = [c.alias(f"{s}{w}") for s in "ab" for w, c in enumerate(similarity.set_signature(s))]
    for r in df.select(*of).collect():
        assert all(r[f"a{w}"] & r[f"b{w}"] == r[f"b{w}"] for w in range(4))
        assert sum((r[f"a{w}"] % 2**64).bit_count() for w in range(4)) > 20


def test_a_hot_element_is_dealt_over_blocks(spark):
    rows = [(i, ["hot", f"x{i}"]) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, have array<string>")
    asked = spark.createDataFrame([(1, ["hot"])], "q int, want array<string>")
    found = similarity.containing_sets(df, "id", "have", asked, "q", "want", block_rows=100)
    assert found.count() == 3000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_block" in plan


# --- dumps -------------------------------------------------------------------------------


def test_a_compressed_dump_becomes_splits(spark, tmp_path):
    lines = ["From\tTo", *[f"M{i}\tX{i}" for i in range(1000)], "bad", "a\tb\tc", "", 'M1\t"q"', "M2\t"]
    with gzip.open(tmp_path / "one.tsv.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    (tmp_path / "two.tsv").write_text("\n".join(lines) + "\n")
    written = mapping.splittable_lines(spark, f"{tmp_path}/one.tsv.gz", 100)
    assert len(written.inputFiles()) == 11 and written.count() == len(lines)
    ids = spark.createDataFrame([(f"M{i}",) for i in range(0, 1000, 2)] + [("M1",)], "molecule_chembl_id string")

    def read(name):
        found = mapping.read_bulk_mapping(spark, str(tmp_path), {"s": name, "gone": "absent.gz"}, ids, rows_per_file=100)
        return sorted(map(tuple, found.collect()), key=repr)

    assert read("one.tsv.gz") == read("two.tsv") and len(read("two.tsv")) == 503


# --- projection --------------------------------------------------------------------------


def test_coordinates_equal_a_plain_projection(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 5
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(999, None)]
    found = fingerprints.project_2d(spark.createDataFrame(rows, "id int, v array<double>"), "id", "v")
    got = np.array([[r.x, r.y] for r in found.orderBy("id").collect()])
    centred = data - data.mean(axis=0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    leading = vectors[:, ::-1][:, :2]
    leading *= np.sign(leading[np.abs(leading).argmax(axis=0), [0, 1]])
    assert np.allclose(got, centred @ leading, atol=1e-8)
