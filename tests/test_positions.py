from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from assayweave.operators import marts, positions
from assayweave.operators.staging import dedupe


@pytest.mark.parametrize("ranges", [1, 7, None])
def test_dense_key_numbers_in_order(spark, ranges):
    keys = [f"M{i}" for i in range(500)]
    random.Random(0).shuffle(keys)
    df = spark.createDataFrame([(k, 1, 2) for k in keys], "k string, _rank int, v int").repartition(5)
    got = [(r["n"], r["k"]) for r in positions.dense_key(df, "k", "n", ranges).collect()]
    assert sorted(got) == [(i + 1, k) for i, k in enumerate(sorted(keys))]
    assert positions.dense_key(df.limit(0), "k", "n", ranges).columns == ["n", "k", "_rank", "v"]
    assert positions.dense_key(df.limit(0), "k", "n", ranges).count() == 0


def test_positions_of_composite_and_descending_keys(spark):
    rows = [(i % 7, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, i int")
    got = {(r["g"], r["i"]): r["n"] for r in positions.global_position(df, [-F.col("g"), "i"], "n", 5).collect()}
    assert got == {r: n + 1 for n, r in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}


@pytest.mark.parametrize("per_range", [10, 100_000])
def test_group_rank_with_a_hot_group_and_nulls(spark, per_range):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"g{i % 7}", i, rng.choice([None, 1.0, 2.0, 3.0])) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, id bigint, v double")
    order = [F.coalesce(-F.col("v"), F.lit(float("inf"))), "id"]
    got = {(r["g"], r["id"]): r["rank"] for r in positions.group_rank(df, "g", order, "rank", per_range).collect()}
    for group in {g for g, _, _ in rows}:
        ranked = sorted((i for g, i, _ in rows if g == group), key=lambda i: (-(rows[i][2] or float("-inf")), i))
        assert [got[(group, i)] for i in ranked] == list(range(1, len(ranked) + 1))


def test_numbers_are_a_projection_of_one_written_file(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(2000).select(F.col("id").alias("k")).mapInArrow(seen, "k bigint").groupBy("k").count().select("k")
    plan = positions.dense_key(df, "k", "n", 9)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan
    assert reads.value == 2000  # the input's scan ran once


def test_dedupe_is_independent_of_order_and_limits_groups_early(spark):
    rows = [(i % 5, i, float(i % 3)) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, a int, b double")
    one = sorted(map(tuple, dedupe(df, ["k"]).collect()))
    two = sorted(map(tuple, dedupe(df.orderBy(F.desc("a")).repartition(7), ["k"]).collect()))
    assert one == two and len(one) == 5
    plan = dedupe(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("per_range", [9, 100_000])
def test_exact_quantiles_equal_the_builtin(spark, per_range):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 5}", rng.choice([None, rng.random(), float(rng.randint(0, 3))])) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in positions.exact_quantiles(df, ["g"], "v", ps, "q", per_range).collect()}
    want = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.percentile("v", ps).alias("q")).collect() if r["q"]}
    assert got.keys() == want.keys()
    assert all(got[g] == pytest.approx(want[g]) for g in want)


def test_marts_over_open_values_equal_the_builtin_quantiles(spark):
    rng = random.Random(4)
    facts = [(f"M{i % 40}", "T0" if i % 3 else f"T{i % 4}", rng.choice([None, rng.random() * 9, float(rng.randint(4, 8))]), f"A{i % 7}") for i in range(2000)]
    fact = spark.createDataFrame(facts, "molecule_chembl_id string, target_chembl_id string, pchembl_value double, assay_chembl_id string")
    compounds = spark.createDataFrame([(i, f"M{i}") for i in range(40)], "compound_key bigint, molecule_chembl_id string")
    targets = spark.createDataFrame([(i, f"T{i}", f"t{i}", "x" if i % 2 else None) for i in range(4)], "target_key bigint, target_chembl_id string, pref_name string, payload_class string")
    prints = compounds.withColumn("scaffold_key", (F.col("compound_key") % 3).cast("bigint"))
    scaffolds = spark.createDataFrame([(i, f"s{i}", "g", 0) for i in range(3)], "scaffold_key bigint, murcko_scaffold_smiles string, murcko_generic_smiles string, n_compounds bigint")

    def near(a, b):
        return all(x == pytest.approx(y) if isinstance(x, float) else x == y for x, y in zip(a, b))

    assert not marts.on_grid(fact, "pchembl_value") and marts.on_grid(fact.where("pchembl_value = floor(pchembl_value) or pchembl_value is null"), "pchembl_value")
    sar = marts.target_sar(fact, compounds, targets)
    for run in (
        lambda gridded: marts.target_sar(fact, compounds, targets, gridded),
        lambda gridded: marts.chemical_series(prints, sar, scaffolds, gridded),
        lambda gridded: marts.class_profile(sar, gridded),
    ):
        one, two = (sorted(map(tuple, run(g).collect()), key=repr) for g in (True, False))
        assert one and len(one) == len(two) and run(True).columns == run(False).columns
        assert all(near(a, b) for a, b in zip(sorted(one, key=lambda r: repr(r[:2])), sorted(two, key=lambda r: repr(r[:2]))))
