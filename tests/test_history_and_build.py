"""Change over time, quality checks, serving goldens, the layered build and the stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from assayweave.config import default_target_set
from assayweave.operators import history, quality, serving, similarity
from assayweave.plans import warehouse
from assayweave.sources.raw import write_entity
from assayweave.sources.schemas import RAW_SCHEMAS
from assayweave.streaming import incremental_stream

TARGET, ASSAY = "CHEMBL2095182", "CHEMBLA2"


def ts(text):
    return F.lit(text).cast("timestamp")


def test_append_is_idempotent_and_ignores_reemitted_ids(spark):
    loaded = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    batch = spark.createDataFrame([(2, "B", 9), (3, "c", 9), (None, "x", 9)], "id bigint, v string, extra int")
    once = history.incremental_append(loaded, batch, "id")
    assert sorted(map(tuple, once.collect())) == [(1, "a", None), (2, "b", None), (3, "c", 9)]
    assert history.new_rows(once, batch, "id").count() == 0
    upserted = history.incremental_upsert(loaded, batch, "id").select("id", "v")
    assert sorted(map(tuple, upserted.collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_scd2_windows(spark):
    schema = "id string, phase double, name string"
    one = spark.createDataFrame([("M1", 1.0, "x"), ("M2", 2.0, None), ("M3", 3.0, "z")], schema)
    two = spark.createDataFrame([("M1", 1.0, "x"), ("M2", 4.0, None), ("M4", 1.0, "n")], schema)
    first = history.scd2_initial(one, "id", ts("2024-01-01"))
    second = history.scd2_apply(first, two, "id", ["phase", "name"], ts("2024-02-01"))
    rows = sorted(
        (r["id"], r["phase"], r["valid_from"].strftime("%m"), r["valid_to"] and r["valid_to"].strftime("%m"))
        for r in second.collect()
    )
    assert rows == [
        ("M1", 1.0, "01", None),
        ("M2", 2.0, "01", "02"),
        ("M2", 4.0, "02", None),
        ("M3", 3.0, "01", "02"),
        ("M4", 1.0, "02", None),
    ]
    again = history.scd2_apply(second, two, "id", ["phase", "name"], ts("2024-03-01"))
    assert sorted(map(str, again.collect())) == sorted(map(str, second.collect()))
    assert quality.check_one_open_window(again, "id").count() == 0
    assert {r["id"] for r in history.scd2_as_of(again, ts("2024-01-15")).collect()} == {"M1", "M2", "M3"}


# --- a miniature release, landed and built twice -----------------------------------------


def land(spark, folder, entity, rows):
    schema = RAW_SCHEMAS[entity]()
    stamps = {"_fetch_ts": "t", "_source_endpoint": "e", "_chembl_version": "36", "_row_hash": "h", "_source": "s"}
    full = [tuple({**stamps, **r}.get(n) for n in schema.names) for r in rows]
    write_entity(spark.createDataFrame(full, schema), folder, entity)


def activity(i, molecule, potency, **more):
    base = {
        "activity_id": i,
        "molecule_chembl_id": molecule,
        "target_chembl_id": TARGET,
        "assay_chembl_id": ASSAY,
        "standard_type": "IC50",
        "standard_relation": "=",
        "standard_value": 1.0,
        "standard_units": "nM",
        "pchembl_value": potency,
    }
    return {**base, **more}


def release(spark, folder, second=False):
    a, b = list(range(24)), list(range(1, 26))
    fps = {"M1": [1000], "M2": [1001], "M6": a, "M7": b, "M8": [90, 91], "M9": [90, 91]}
    scaffold = {"M6": "benzene", "M7": "benzene", "M8": "benzene", "M9": "benzene"}
    acts = [
        activity(1, "M6", 8.0),
        activity(2, "M7", 5.5),
        activity(3, "M8", 7.5),
        activity(4, "M9", 6.0),
        activity(4, "M9", 6.0),
        activity(5, "M1", 6.5, standard_relation=">"),
        activity(6, "M1", 6.5, assay_chembl_id="LOW"),
        activity(7, "M2", 6.0),
        activity(8, "GONE", 6.0),
    ]
    if second:
        acts += [activity(13, "M6", 7.0), activity(14, "M7", 6.8, standard_type="EC50"), activity(1, "M6", 1.0)]
    land(spark, folder, "activities", acts)
    mols = [
        {
            "molecule_chembl_id": m,
            "pref_name": m.lower(),
            "max_phase": (4.0 if second else 2.0) if m == "M2" else 1.0,
            "cross_references": '[{"xref_src":"PDBe","xref_id":"LIG"}]' if m == "M6" else None,
        }
        for m in fps
    ]
    land(spark, folder, "molecules", mols)
    land(
        spark,
        folder,
        "targets",
        [
            {"target_chembl_id": TARGET, "pref_name": "Tubulin", "organism": "Homo sapiens", "target_type": "C"},
            {"target_chembl_id": "T2", "pref_name": "Rat", "organism": "Rattus norvegicus", "target_type": "C"},
        ],
    )
    land(
        spark,
        folder,
        "assays",
        [
            {"assay_chembl_id": ASSAY, "confidence_score": "7"},
            {"assay_chembl_id": "LOW", "confidence_score": "4"},
        ],
    )
    land(
        spark,
        folder,
        "compound_cheminfo",
        [
            {
                "molecule_chembl_id": m,
                "ecfp4_onbits": bits,
                "n_onbits": len(bits),
                "heavy_atom_count": 9,
                "murcko_scaffold_smiles": scaffold.get(m),
            }
            for m, bits in fps.items()
        ],
    )
    land(spark, folder, "compound_embedding", [{"molecule_chembl_id": "M1", "umap_x": 1.0, "umap_y": 2.0}])
    land(spark, folder, "xref_unichem", [{"molecule_chembl_id": "M6", "source": "newDb", "xref_id": "7"}])
    land(spark, folder, "pdbe_structures", [{"xref_id": "LIG", "pdb_id": "1abc"}])
    land(spark, folder, "pdbe_summary", [{"pdb_id": "1ABC", "title": "T", "year": "2004", "resolution": "x"}])
    cells = [
        {"activity_id": i, "molecule_chembl_id": "P", "reference_name": "Camptothecin", "payload_class": "topo1_inhibitor"}
        | {"target_chembl_id": line, "target_pref_name": line, "standard_type": "IC50"}
        | {"standard_relation": rel, "standard_units": unit, "standard_value": value}
        for i, line, rel, unit, value in [
            (1, "HeLa", "=", "nM", 44.0),
            (2, "HeLa", "=", "nM", 60.0),
            (3, "A549", "=", "uM", 1.0),
            (4, "A549", ">", "nM", 1.0),
            (5, "A549", "=", "ug/mL", 1.0),
        ]
    ]
    land(spark, folder, "cell_activities", cells)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("wh")
    config = default_target_set()
    steps = []
    for n, second in enumerate((False, False, True)):
        raw_dir, out = str(folder / f"raw{n}"), str(folder / "out")
        release(spark, raw_dir, second)
        w = warehouse.build(spark, raw_dir, out, config, f"2024-0{n + 1}-01T00:00:00Z", check=n == 2)
        fact = {r["activity_id"]: r["pchembl_value"] for r in w.fact_activity.collect()}
        status = sorted(map(str, warehouse.compound_status(spark, out).collect()))
        steps.append((fact, status))
    return w, steps, warehouse.compound_status(spark, out)


def test_release_two_adds_exactly_the_new_activities(built):
    _, steps, _ = built
    first, repeat, second = (s[0] for s in steps)
    assert sorted(first) == [1, 2, 3, 4, 7] and repeat == first
    assert set(second) - set(first) == {13, 14} and second[1] == 8.0
    assert steps[0][1] == steps[1][1]


def test_status_history(built):
    history_ = built[2]
    windows = {}
    for r in history_.orderBy("valid_from").collect():
        windows.setdefault(r["molecule_chembl_id"], []).append((r["max_phase"], r["is_approved_drug"], r["valid_to"] is None))
    assert windows["M2"] == [(2.0, False, False), (4.0, True, True)]
    assert windows["M1"] == [(1.0, False, True)]
    assert quality.check_one_open_window(history_, "molecule_chembl_id").count() == 0


def test_built_marts(built):
    w = built[0]
    series = w.mart_chemical_series.collect()
    assert len(series) == 1 and series[0]["n_compounds"] == 4 and series[0]["top_compound"] == "M6"
    cliffs = {(r["molecule_chembl_id_a"], r["molecule_chembl_id_b"]): r for r in w.mart_activity_cliff.collect()}
    assert cliffs[("M8", "M9")]["is_identical_fp"] and cliffs[("M6", "M7")]["tanimoto"] == 0.885
    sel = {r["molecule_chembl_id"]: r for r in w.mart_compound_selectivity.collect()}
    assert sel["M6"]["selectivity_index"] is None and sel["M6"]["pchembl_spread"] == 0.0
    xref = {r["source"]: r for r in w.mart_compound_xref.collect()}
    assert xref["newDb"]["display_name"] == "NewDb" and xref["newDb"]["url"] is None
    assert xref["pdbe"]["url"].endswith("/show/LIG")
    pdb = w.mart_compound_pdb.collect()
    assert [(r["pdb_id"], r["year"], r["resolution"]) for r in pdb] == [("1abc", 2004, None)]
    catalog = {r["molecule_chembl_id"]: r for r in w.mart_compound_catalog.collect()}
    assert "M1" not in catalog and catalog["M6"]["has_pdb"] and not catalog["M7"]["has_pdb"]
    cyto = {r["cell_line"]: r for r in w.mart_compound_cytotoxicity.collect()}
    assert cyto["HeLa"]["n_measurements"] == 2 and cyto["A549"]["max_p_cyto"] == 6.0
    row = serving.compound_row(w.mart_compound_catalog, w.dim_compound, "M1").collect()
    assert len(row) == 1 and row[0]["selectivity_index"] is None
    assert serving.compound_row(w.mart_compound_catalog, w.dim_compound, "NOPE").count() == 0


def test_cliff_plan_has_no_all_pairs_join(built):
    w = built[0]
    sets = similarity.distinct_sets(w.mart_compound_fingerprint, "ecfp4_onbits", 2048)
    plan = similarity.similar_classes(sets, 0.75, 2048)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


# --- serving -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scoped(spark):
    sar = spark.createDataFrame(
        [(1, "A", 3), (1, "B", 2), (2, "A", 2), (3, "B", 1)], "compound_key bigint, target_pref_name string, n_measurements bigint"
    )
    catalog = spark.createDataFrame(
        [(1, True, 8.0, True, 2), (2, False, 6.5, False, 1), (3, False, None, True, 1)],
        "compound_key bigint, is_approved_drug boolean, best_pchembl double, has_pdb boolean, n_targets bigint",
    )
    return sar, catalog


@pytest.mark.parametrize(
    "scope,expected",
    [
        (serving.Scope(), {1, 2, 3}),
        (serving.Scope(targets=("A",)), {1, 2}),
        (serving.Scope(approval="approved"), {1}),
        (serving.Scope(approval="research"), {2, 3}),
        (serving.Scope(min_pchembl=6.0), {1, 2}),
        (serving.Scope(structure_only=True), {1, 3}),
    ],
)
def test_scope_facets(scoped, scope, expected):
    sar, catalog = scoped
    assert {r[0] for r in serving.resolve_scope(sar, catalog, scope).collect()} == expected


def test_scope_without_structure_column_and_overview(scoped):
    sar, catalog = scoped
    bare = catalog.drop("has_pdb")
    assert serving.resolve_scope(sar, bare, serving.Scope(structure_only=True)).count() == 3
    got = {r["metric"]: r["value"] for r in serving.overview_metrics(sar, catalog, serving.Scope()).collect()}
    assert got == {"compounds": 3, "activities": 8, "targets": 2, "pairs": 4, "multi_target": 1, "approved": 1}
    one = {r["metric"]: r["value"] for r in serving.overview_metrics(sar, catalog, serving.Scope(targets=("A",))).collect()}
    assert (one["compounds"], one["activities"]) == (2, 5)


def test_nearest_neighbors(spark):
    pad = lambda h: h.rjust(16, "0")
    fp = spark.createDataFrame(
        [(1, "A", pad("ff")), (2, "B", pad("0f")), (3, "C", pad("ff")), (4, "D", pad("f00"))],
        "compound_key bigint, molecule_chembl_id string, ecfp4_hex string",
    )
    catalog = spark.createDataFrame(
        [(1, "a", 8.0, "t"), (2, "b", 7.0, "t"), (3, "c", 6.0, "t")],
        "compound_key bigint, pref_name string, best_pchembl double, best_target string",
    )
    find = lambda **kw: [
        (r["molecule_chembl_id"], r["tanimoto"], r["delta_pchembl"])
        for r in serving.nearest_neighbors(kw.pop("key", 1), fp, catalog, nbits=64, **kw).collect()
    ]
    assert find() == [("C", 1.0, -2.0), ("B", 0.5, -1.0), ("D", 0.0, None)]
    assert find(min_similarity=0.6) == [("C", 1.0, -2.0)]
    assert find(k=1, include_self=True) == [("A", 1.0, 0.0)]
    assert find(key=99) == []


def test_filter_cliffs_and_rank(spark):
    cliffs = spark.createDataFrame(
        [(1, 1, 2, "a", "b", 0.8, 2.0, False, 10.0), (1, 1, 3, "a", "c", 1.0, 3.0, True, None), (1, 2, 3, "b", "c", 0.9, 1.0, False, 9.0)],
        "target_key int, compound_key_a int, compound_key_b int, molecule_chembl_id_a string, molecule_chembl_id_b string,"
        " tanimoto double, delta_pchembl double, is_identical_fp boolean, sali double",
    )
    assert serving.filter_cliffs(cliffs, 0.8, 2.0).count() == 2
    assert serving.filter_cliffs(cliffs, 0.8, 2.0, include_identical=False).count() == 1
    ranked = {r["_row"]: r["pair"] for r in serving.ranked_cliffs(cliffs, ranges=3).collect()}
    assert ranked == {0: "a ⇄ b", 1: "b ⇄ c", 2: "a ⇄ c"}


def test_cytotox_and_labels(spark):
    cyto = spark.createDataFrame(
        [("Exatecan", "topo1_inhibitor", 9.2, "c1"), ("Exatecan", "topo1_inhibitor", 8.0, "c2"), ("MMAE", "x", 9.0, "c1")],
        "reference_name string, payload_class string, median_p_cyto double, cell_line_chembl_id string",
    )
    rolled = serving.label_class(serving.cytotox_by_payload(cyto), "payload_class", default_target_set().class_labels)
    assert [tuple(r) for r in rolled.collect()] == [("Exatecan", "Topoisomerase-I inhibitor", 9.2, 2), ("MMAE", "x", 9.0, 1)]


# --- quality: every check fires and stays quiet --------------------------------------------


def test_checks_fire_and_stay_quiet(spark):
    bad = spark.createDataFrame(
        [(1, "a", 99.0, 1, 2), (1, "z", 5.0, 2, 1), (2, None, None, 2, 2)], "k int, c string, v double, a int, b int"
    )
    good = spark.createDataFrame([(1, "a", 5.0, 1, 2), (2, "b", 6.0, 1, 3)], "k int, c string, v double, a int, b int")
    parent = spark.createDataFrame([(1,)], "k int")
    checks = {
        "unique": lambda d: quality.check_unique(d, "k"),
        "not_null": lambda d: quality.check_not_null(d, "c"),
        "accepted": lambda d: quality.check_accepted(d, "c", ["a", "b"]),
        "known": lambda d: quality.check_known_class(d, "c", ["a", "b"]),
        "grain": lambda d: quality.check_grain(d, ["k"]),
        "order": lambda d: quality.check_pair_order(d, "k", "a", "b"),
        "floor": lambda d: quality.check_thresholds(d, {"v": 5.0, "a": 1.0, "b": 2.0}),
        "range": lambda d: quality.check_range(d, ["v"], 0.0, 14.0),
        "nulls": lambda d: quality.check_null_rate(d, "c", 0.2),
        "mean": lambda d: quality.check_mean_band(d, "v", 3.0, 10.0),
        "rows": lambda d: quality.check_row_floor({"t": d.where("v < 14")}, 2),
        "sum": lambda d: quality.check_reconciles(d, F.sum("k"), good, F.sum("k")),
    }
    for name, check in checks.items():
        assert check(bad).count() > 0, name
        assert check(good).count() == 0, name
    assert quality.check_relationship(bad, "k", parent, "k").count() == 1
    assert quality.check_relationship(good.where("k = 1"), "k", parent, "k").count() == 0
    suite = quality.check_suite({n: c(bad) for n, c in checks.items()}, [(bad, {"v_high": F.col("v") > 14})])
    assert suite.where("not passed").count() == len(checks) + 1


@pytest.mark.parametrize("now,status", [("2024-02-01", "pass"), ("2024-06-01", "warn"), ("2040-01-01", "error")])
def test_freshness(spark, now, status):
    df = spark.createDataFrame([("2024-01-01T00:00:00+00:00",)], "t string")
    assert quality.freshness(df, F.col("t"), F.lit(now)).first()["status"] == status


def test_freshness_of_an_empty_table(spark):
    assert quality.freshness(spark.createDataFrame([], "t string"), F.col("t"), F.lit("2024-01-01")).first()["status"] == "error"


# --- stream ------------------------------------------------------------------------------


def test_stream_equals_batch_append(spark, tmp_path):
    schema = spark.createDataFrame([], "id bigint, v string").schema
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [[(1, "a"), (2, "b"), (2, "b2")], [(2, "B"), (3, "c"), (None, "x")], [(1, "A"), (3, "C")]]
    loaded = None
    for rows in batches:
        frame = spark.createDataFrame(rows, schema)
        frame.coalesce(1).write.mode("append").parquet(source)
        incremental_stream(spark, source, schema, target, str(tmp_path / "cp"), "id").awaitTermination()
    loaded = sorted(map(tuple, spark.read.parquet(target).drop("_batch").collect()))
    assert loaded == [(1, "a"), (2, "b"), (3, "c")]


def test_entries_are_dealt_anew_before_they_are_compared(spark):
    """One ligand's rows stand in one task; no task may collect them all as distinct rows."""
    columns = "compound_key long, ligand_code string, pdb_id string, title string, method string, year int, resolution double"
    pdb = spark.createDataFrame([(1, "L1", f"P{i % 50}", "t", "m", None, 1.5) for i in range(100)], columns).coalesce(1)
    found = serving.pdb_entries(pdb, spark.createDataFrame([(1,)], "compound_key long"))
    assert found.count() == 50
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression")
