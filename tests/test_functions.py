from __future__ import annotations

import random

from pyspark.sql import functions as F

from assayweave import functions as fn
from assayweave.operators import fingerprints, landing, profiling, serving
from assayweave.sources import mapping, raw
from assayweave.sources.schemas import RAW_SCHEMAS, RULES, Rule

import pytest


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_round_fp_is_binary_rounding(spark):
    cases = {1.005: 1.0, 2.675: 2.68, 6.445: 6.45, -0.125: -0.13, 0.285: 0.28, 1.115: 1.11}
    for value, expected in cases.items():
        got = one(spark, fn.round_fp(F.lit(value), 2))[0]
        assert abs(got - expected) < 0.0101, (value, got)
    assert one(spark, fn.round_fp(F.lit(2.675), 2))[0] == 2.68
    assert one(spark, fn.round_fp(F.lit(None).cast("double"), 2))[0] is None


def test_try_int(spark):
    row = one(spark, fn.try_int(F.lit("5.0")), fn.try_int(F.lit("7")), fn.try_int(F.lit("n/a")))
    assert tuple(row) == (5, 7, None)


def test_fingerprint_forms_agree(spark):
    rng = random.Random(1)
    for width in (64, 2048):
        bits = sorted(rng.sample(range(width), 30))
        hexed = format(int("".join("1" if i in bits else "0" for i in range(width)), 2), f"0{width // 4}x")
        df = spark.createDataFrame([(bits, hexed)], "bits array<int>, hex string")
        row = df.select(
            fn.bits_to_hex("bits", width),
            fn.hex_to_bits("hex", width),
            fn.bits_to_words("bits", width) == fn.hex_to_words("hex", width),
            fn.popcount_words(fn.hex_to_words("hex", width)),
        ).first()
        assert tuple(row) == (hexed, bits, True, 30)
    empty = spark.createDataFrame([([], None)], "bits array<int>, hex string")
    assert tuple(empty.select(fn.bits_to_hex("bits", 64), fn.hex_to_bits("hex", 64)).first()) == ("0" * 16, None)


def test_tanimoto_hex_cases(spark):
    cases = [("ff", "ff", 1.0), ("f0", "0f", 0.0), ("ff", "0f", 0.5), ("", "ff", 0.0), ("00", "00", 0.0), (None, "ff", 0.0)]
    pad = lambda h: h and h.rjust(16, "0")
    df = spark.createDataFrame([(pad(a), pad(b), t) for a, b, t in cases], "a string, b string, t double")
    got = df.select(fn.tanimoto_words(fn.hex_to_words("a", 64), fn.hex_to_words("b", 64)), "t").collect()
    assert all(g == t for g, t in got)


def test_display_name_keeps_the_tail(spark):
    assert one(spark, fn.display_name(F.lit("newDb")))[0] == "NewDb"


def test_row_hash_ignores_column_order_and_marks_null(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (1, "\\N")], "a int, b string")
    ab = [r[0] for r in df.select(raw.row_hash(df)).collect()]
    ba = [r[0] for r in df.select("b", "a").select(raw.row_hash(df.select("b", "a"))).collect()]
    assert ab == ba and len(set(ab)) == 3


def test_flatten_and_stringify(spark):
    df = spark.sql("select 1 as id, named_struct('b', named_struct('c', 2), 'd', array(1, 2)) as a")
    flat = raw.flatten_nested(df)
    assert flat.columns == ["id", "a.b.c", "a.d"]
    assert tuple(raw.stringify_nested(flat).first()) == (1, 2, "[1,2]")


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1", None, "x"), ("z", "k", "y")], "n string, k string, extra string")
    rules = [Rule("n", "int"), Rule("k", "string", False)]
    counts = {(r["column"], r["rule"]): r["violations"] for r in raw.schema_violations(df, rules).collect()}
    assert counts == {("n", "type"): 1, ("k", "type"): 0, ("k", "not_null"): 1}
    with pytest.raises(ValueError, match="not_null"):
        raw.enforce_schema(df, rules)
    with pytest.raises(ValueError, match="missing"):
        raw.enforce_schema(df, [Rule("gone", "int")])
    good = raw.enforce_schema(df.where("k = 'k'").withColumn("n", F.lit("4")), rules)
    assert good.first().asDict() == {"n": 4, "k": "k", "extra": "y"}


def test_raw_schemas_cover_the_rules(spark):
    for entity, rules in RULES.items():
        declared = {f.name for f in RAW_SCHEMAS[entity]().fields}
        assert {r.column for r in rules} <= declared, entity


def test_bulk_mapping_drops_header_unknown_ids_and_absent_files(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "src1src5.txt.gz", "wt") as out:
        out.write("From src:'1'\tTo src:'5'\nM1\tABC\nM9\tZZZ\n")
    ids = spark.createDataFrame([("M1",), ("M2",)], "molecule_chembl_id string")
    files = {"pdbe": "src1src5.txt.gz", "drugbank": "src1src2.txt.gz"}
    got = mapping.read_bulk_mapping(spark, str(tmp_path), files, ids, partitions=2)
    assert [tuple(r) for r in got.collect()] == [("M1", "pdbe", "ABC")]
    assert mapping.read_bulk_mapping(spark, str(tmp_path), {"x": "no"}, ids).count() == 0


def test_resolve_capped(spark):
    rows = [
        ("ABC", '[{"pdb_id":"2XYZ"},{"pdb_id":"1abc"},{"pdb_id":"1ABC"},"3def",""]'),
        ("BIG", "[" + ",".join(f'"p{i:03}"' for i in range(100)) + "]"),
        ("OBJ", '{"pdb_id":"1abc"}'),
        ("NUL", None),
        ("", '["1abc"]'),
    ]
    df = spark.createDataFrame(rows, "code string, payload string")
    got = landing.resolve_capped(df, "code", "payload", 10).orderBy("ligand_code", "pdb_id").collect()
    assert [r["pdb_id"] for r in got if r["ligand_code"] == "ABC"] == ["1abc", "2xyz", "3def"]
    assert [r["pdb_id"] for r in got if r["ligand_code"] == "BIG"] == [f"p{i:03}" for i in range(10)]
    assert {r["ligand_code"] for r in got} == {"ABC", "BIG"}


def test_merge_entry_metadata(spark):
    ids = spark.createDataFrame([("1OXR",), ("1oxr",), ("9zzz",), ("",)], "pdb_id string")
    summary = spark.createDataFrame(
        [("1oxr", " Aspirin ", ["X-ray diffraction", "NMR"], "20040101"), ("9yyy", "", [], "soon")],
        "pdb_id string, title string, experimental_method array<string>, release_date string",
    )
    experiment = spark.createDataFrame([("1oxr", 2.0)], "pdb_id string, resolution double")
    got = {r["pdb_id"]: tuple(r)[1:] for r in landing.merge_entry_metadata(ids, summary, experiment).collect()}
    assert got == {"1oxr": ("Aspirin", "X-ray diffraction", "2004", 2.0), "9zzz": (None, None, None, None)}


def test_projection_is_centred_ordered_and_skipped_when_small(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 3), rng.gauss(0, 1), rng.gauss(0, 0.1)]) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = fingerprints.project_2d(df, "id", "v")
    s = got.agg(F.avg("x"), F.avg("y"), F.var_pop("x"), F.var_pop("y"), F.count("*")).first()
    assert abs(s[0]) < 1e-9 and abs(s[1]) < 1e-9 and s[2] > s[3] > 0 and s[4] == 200
    again = {r["id"]: r["x"] for r in fingerprints.project_2d(df.repartition(5), "id", "v").collect()}
    assert all(abs(r["x"] - again[r["id"]]) < 1e-6 for r in got.collect())
    assert fingerprints.project_2d(df.limit(3), "id", "v").count() == 0


def test_cliff_grid_and_top(spark):
    pairs = spark.createDataFrame([(1.0, 3.0, 1), (0.5, 3.0, 2)], "similarity double, delta double, p int")
    grid = {(r[0], r[1]): r[2] for r in profiling.cliff_grid(pairs, (0.5, 0.9), (1.0, 2.0)).collect()}
    assert grid == {(0.5, 1.0): 2, (0.5, 2.0): 2, (0.9, 1.0): 1, (0.9, 2.0): 1}
    assert [r["sali"] for r in profiling.top_cliffs(pairs, 5, ["p"]).collect()] == [float("inf"), 6.0]


def test_ro5_and_efficiency(spark):
    df = spark.createDataFrame(
        [(451.0, 6.9, 1, 4, 7.3, 20), (None, None, None, None, None, 0)],
        "mw_freebase double, alogp double, hbd int, hba int, best_pchembl double, heavy_atoms int",
    )
    a, b = serving.ro5_breakdown(df).orderBy(F.desc_nulls_last("mw_freebase")).collect()
    assert (a["violations"], a["logp_ok"], a["mw_ok"]) == (1, False, True)
    assert (b["violations"], b["logp_ok"]) == (0, None)
    scored = serving.efficiency(df).collect()
    assert scored[0]["ligand_efficiency"] == pytest.approx(1.37 * 7.3 / 20)
    assert scored[0]["lipophilic_efficiency"] == pytest.approx(0.4)
    assert scored[1]["ligand_efficiency"] is None and scored[1]["lipophilic_efficiency"] is None


def test_entry_label(spark):
    rows = [
        ("1abc", "Title", "Electron Microscopy", 2020, 2.5),
        ("2xyz", None, None, None, None),
        ("3pqr", "", "Other", 1999, None),
    ]
    df = spark.createDataFrame(rows, "pdb_id string, title string, method string, year int, resolution double")
    labels = {r["pdb_id"]: r["label"] for r in serving.entry_label(df).collect()}
    assert labels == {"1abc": "1ABC - Title · cryo-EM 2.5 Å · 2020", "2xyz": "2XYZ", "3pqr": "3PQR · Other · 1999"}
