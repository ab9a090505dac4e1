"""Golden cases for values that rounding, scripts, ties and rows without a counterpart once got wrong."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from assayweave import functions as fn
from assayweave.functions.scalar import one_decimal
from assayweave.operators import history, profiling, serving, similarity, staging
from assayweave.sources import raw
from assayweave.sources.schemas import Rule


def test_words_of_any_script_stay_whole(spark):
    texts = ["Crème brûlée, déjà-vu!", "Привет мир", "東京 タワー 123", "naïve NAÏVE", "...", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(fn.word_set("t")).collect()]
    assert got[:4] == [["brûlée", "crème", "déjà", "vu"], ["мир", "привет"], ["123", "タワー", "東京"], ["naïve"]]
    assert got[4:] == [[], None]


def test_no_letter_of_the_documents_is_lost(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    letters = F.array_distinct(F.split(F.regexp_replace(F.lower("text"), r"[^\\p{L}]", ""), ""))
    kept = F.array_distinct(F.split(F.array_join(fn.word_set("text"), ""), ""))
    assert docs.where(F.size(F.array_except(F.array_remove(letters, ""), kept)) > 0).count() == 0


@pytest.mark.parametrize(
    ("value", "digits", "want"),
    [(1e13, 6, 1e13), (math.inf, 6, math.inf), (-math.inf, 2, -math.inf), (0.49999999999999994, 0, 0.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (1.005, 2, 1.0)],
)
def test_round_fp_at_the_ends(spark, value, digits, want):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(fn.round_fp("x", digits)).first()[0] == want


def test_integers_stay_exact(spark):
    df = spark.createDataFrame([("9007199254740993", 1), ("5.0", 2), ("x", 3)], "a string, b int")
    assert [r[0] for r in df.select(fn.try_int("a", "bigint")).collect()] == [9007199254740993, 5, None]
    checked = raw.enforce_schema(df.where("b < 3"), [Rule("a", "bigint", False)])
    assert [r["a"] for r in checked.orderBy("b").collect()] == [9007199254740993, 5]


def test_one_decimal_equals_the_exact_formatting(spark):
    values = [1.25, 1.95, 0.85, 0.25, 0.35, 0.75, 2.5, 2.45, 1.05, 3.0, 0.0, 9.949999, 12.05, -1.25, 100.15, 0.05, 0.15]
    values += [i / 200 for i in range(0, 2000, 7)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(one_decimal("x")).collect()] == [f"{v:.1f}" for v in values]


def test_best_potency_is_the_largest_measurement(spark):
    sar = spark.createDataFrame([(1, 10, 5.0, 7.5), (1, 11, 6.0, 6.0)], "target_key int, compound_key int, median_pchembl double, max_pchembl double")
    targets = spark.createDataFrame([(1, "T", "SINGLE")], "target_key int, pref_name string, target_type string")
    row = serving.target_summary(sar, targets).first()
    assert (row["median_pchembl"], row["best_pchembl"], row["n_pairs"]) == (5.5, 7.5, 2)


def test_pair_budget_counts_comparable_rows_only(spark):
    sar = spark.createDataFrame(
        [(1, "T", i, 5.0) for i in range(4)] + [(1, "T", 9, None), (2, "T", 0, 5.0)],
        "target_key int, target_pref_name string, compound_key int, median_pchembl double",
    )
    fps = spark.createDataFrame([(0, "aa"), (1, "ab"), (2, None), (9, "ff")], "compound_key int, ecfp4_hex string")
    got = [tuple(r) for r in profiling.pair_budget(sar, fps).collect()]
    assert got == [(1, "T", 2, 1), (2, "T", 1, 0)]


def test_members_rank_by_unrounded_potency(spark):
    members = spark.createDataFrame([(1, "A", 5.005), (1, "B", 5.01), (1, "C", None)], "scaffold_key int, molecule_chembl_id string, potency double")
    series = spark.createDataFrame([(1, 5.01, 5.0)], "scaffold_key int, max_pchembl double, median_pchembl double")
    ranks = {r["molecule_chembl_id"]: (r["rank"], r["best_pchembl"]) for r in serving.member_rank(members, series).collect()}
    assert ranks["B"][0] == 1 and ranks["A"][0] == 2 and ranks["C"] == (3, None)


def test_unreadable_potency_is_no_measurement(spark):
    schema = (
        "activity_id string, molecule_chembl_id string, target_chembl_id string, assay_chembl_id string, standard_type string, "
        "standard_relation string, standard_value string, standard_units string, pchembl_value string, "
        "data_validity_comment string, document_chembl_id string"
    )
    rows = [("1", "M", "T", "A", "IC50", "=", "1", "nM", p, None, "D") for p in ("6.5", "high", None)]
    assert staging.stage_activities(spark.createDataFrame(rows, schema), ["IC50"]).count() == 1


def test_a_batch_with_one_id_twice_is_loaded_once(spark):
    loaded = spark.createDataFrame([(1, "a")], "id bigint, v string")
    batch = spark.createDataFrame([(2, "x"), (2, "b"), (1, "z")], "id bigint, v string")
    assert sorted(map(tuple, history.incremental_append(loaded, batch, "id").collect())) == [(1, "a"), (2, "b")]
    assert sorted(map(tuple, history.incremental_upsert(loaded, batch, "id").collect())) == [(1, "z"), (2, "b")]
    assert history.key_range(loaded, batch, "id").count() == 1
    assert history.key_range(loaded, batch.limit(0), "id").count() == 0


def test_bits_outside_the_universe_are_refused(spark):
    df = spark.createDataFrame([(1, [1, 70]), (2, [1, 2])], "k int, bits array<int>")
    with pytest.raises(Exception, match="not in"):
        similarity.similar_classes(similarity.distinct_sets(df, "bits", 64), 0.5, 64).collect()


@pytest.mark.parametrize("hot", [0, 3, 10_000])
def test_hot_and_cold_tokens_give_the_same_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(similarity, "HOT_TOKEN", hot)
    sets = {i: sorted({"the", f"w{i % 5}", f"v{i % 3}", f"u{i % 2}"}) for i in range(30)}
    df = spark.createDataFrame(list(sets.items()), "k int, words array<string>")
    distinct = similarity.distinct_sets(df, "words")
    got = similarity.similar_classes(distinct, 0.6).count()
    unique = {tuple(s) for s in sets.values()}
    want = sum(len(set(a) & set(b)) >= 0.6 * len(set(a) | set(b)) for a in unique for b in unique if a < b)
    assert got == want


def test_declared_checks_name_what_is_broken(spark):
    from assayweave.plans import catalog, checks
    from assayweave.plans.analogs import warehouse

    w = warehouse(spark, "/root/testdata/sf0.001")
    models = ["stg_targets", "dim_target", "dim_compound"]
    good = {r["check"] for r in checks.warehouse_checks(w, models=models).where("not passed").collect()}
    bad = type(w)(w.raw, w.config)
    targets = w.dim_target
    bad.__dict__.update(
        dim_target=targets.union(targets.limit(1)).withColumn("payload_class", F.lit("unheard_of")),
        dim_compound=w.dim_compound.withColumn("canonical_smiles", F.lit(None).cast("string")),
        stg_targets=w.stg_targets.withColumn("target_type", F.lit("ORGANISM")),
    )
    found = {r["check"] for r in checks.warehouse_checks(bad, models=models).where("not passed").collect()}
    assert "dim_target.target_key unique" not in good and "stg_targets.target_type accepted" not in good
    assert found >= {
        "dim_target.target_key unique",
        "dim_target.target_chembl_id unique",
        "dim_target.payload_class known",
        "dim_compound.canonical_smiles null_rate",
        "stg_targets.target_type accepted",
    }
    assert catalog.REGISTRY["warehouse_checks"]


def test_landing_step(spark, tmp_path):
    schema = "target_chembl_id string, pref_name string, extra struct<a: int, b: array<string>>"
    records = spark.createDataFrame([("T1", "x", (1, ["p", "q"])), ("T2", None, None)], schema)
    path = raw.land(records, "targets", str(tmp_path), "36", "2024-01-01T00:00:00Z")
    rows = {r["target_chembl_id"]: r for r in spark.read.parquet(path).collect()}
    assert rows["T1"]["extra.b"] == '["p","q"]' and rows["T1"]["_chembl_version"] == "36" and rows["T2"]["extra.a"] is None
    unreadable = records.select(F.lit("x").alias("pchembl_value"), "target_chembl_id")
    with pytest.raises(ValueError, match="missing column"):
        raw.land(unreadable, "activities", str(tmp_path), "36", "2024-01-01T00:00:00Z")


def test_scope_files(tmp_path):
    import json

    from assayweave.config import default_target_set, load_target_set

    scope = {
        "chembl_version": 36,
        "organism": "Homo sapiens",
        "targets": [{"chembl_id": "T1", "payload_class": "c1"}, {"chembl_id": "T2", "payload_class": "c2"}],
        "activity": {"standard_types": ["Ki"], "min_confidence_score": 5},
        "reference_payloads": [{"molecule_chembl_id": "M", "name": "n", "payload_class": "c1"}],
        "cell_activity": {"standard_types": ["IC50"], "assay_type": "F"},
    }
    path = tmp_path / "scope.json"
    path.write_text(json.dumps(scope))
    loaded = load_target_set(path)
    assert loaded.target_ids() == ["T1", "T2"] and loaded.release == "36" and loaded.cell_types == ("IC50",)
    assert loaded.fingerprint_bits == default_target_set().fingerprint_bits
    (tmp_path / "scope.yml").write_text(json.dumps(scope))  # JSON is YAML
    pytest.importorskip("yaml")
    assert load_target_set(tmp_path / "scope.yml") == loaded
    for broken in (
        {k: v for k, v in scope.items() if k != "organism"},
        scope | {"targets": []},
        scope | {"targets": scope["targets"] * 2},
        scope | {"activity": {"standard_types": ["Ki"]}},
        scope | {"reference_payloads": [{"molecule_chembl_id": "M", "name": "n", "payload_class": "other"}]},
    ):
        path.write_text(json.dumps(broken))
        with pytest.raises(ValueError):
            load_target_set(path)


def test_a_later_release_may_bring_a_column(spark, tmp_path):
    from assayweave.streaming import incremental_stream

    first = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    second = spark.createDataFrame([(2, "B", 5), (3, "c", 6)], "id bigint, v string, more int")
    for frame, part in ((first, "one"), (second, "two")):
        frame.write.mode("append").parquet(f"{tmp_path}/in")
        incremental_stream(spark, f"{tmp_path}/in", frame.schema, f"{tmp_path}/out", f"{tmp_path}/check", "id").awaitTermination()
    got = spark.read.option("mergeSchema", True).parquet(f"{tmp_path}/out").drop("_batch")
    assert sorted(tuple(r[c] for c in ("id", "v", "more")) for r in got.collect()) == [(1, "a", None), (2, "b", None), (3, "c", 6)]
