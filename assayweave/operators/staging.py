"""Typed, filtered and deduplicated staging frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import MOLAR_FACTORS, molar_potency, try_int

REFERENCE_JSON = "array<struct<xref_src:string,xref_id:string,xref_name:string>>"


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key, chosen by a total order (default: all other columns, ascending).

    ``row_number() = 1`` is planned as a group limit on both sides of the shuffle, so a
    key holding a large share of all rows sends one row per map task.
    """
    order = order_by or [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys]
    if not order:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def stage_activities(raw: DataFrame, standard_types: Sequence[str]) -> DataFrame:
    """Exact, valid, whitelisted measurements; one per activity id."""
    kept = raw.where(
        F.col("pchembl_value").try_cast("double").isNotNull()  # what cannot be read is not a measurement
        & (F.col("standard_relation") == "=")
        & F.col("data_validity_comment").isNull()
        & F.col("standard_type").isin(list(standard_types))
    )
    typed = kept.select(
        F.col("activity_id").try_cast("bigint").alias("activity_id"),
        "molecule_chembl_id",
        "target_chembl_id",
        "assay_chembl_id",
        "standard_type",
        "standard_relation",
        F.col("standard_value").try_cast("double").alias("standard_value"),
        "standard_units",
        F.col("pchembl_value").try_cast("double").alias("pchembl_value"),
        "document_chembl_id",
    )
    return dedupe(typed, ["activity_id"])


def stage_molecules(raw: DataFrame) -> DataFrame:
    """One row per molecule with its structure and property columns under plain names."""

    def nested(group: str, name: str) -> Column:
        return F.col(f"`molecule_{group}.{name}`")

    def real(name: str) -> Column:
        return nested("properties", name).try_cast("double")

    def whole(name: str) -> Column:
        return try_int(nested("properties", name))

    phase = F.col("max_phase").try_cast("double")
    typed = raw.select(
        "molecule_chembl_id",
        "pref_name",
        phase.alias("max_phase"),
        F.coalesce(phase >= 4, F.lit(False)).alias("is_approved_drug"),
        "molecule_type",
        nested("structures", "canonical_smiles").alias("canonical_smiles"),
        nested("structures", "standard_inchi_key").alias("inchi_key"),
        real("mw_freebase").alias("mw_freebase"),
        real("alogp").alias("alogp"),
        whole("hba").alias("hba"),
        whole("hbd").alias("hbd"),
        real("psa").alias("psa"),
        whole("rtb").alias("rotatable_bonds"),
        whole("num_ro5_violations").alias("num_ro5_violations"),
        nested("properties", "ro3_pass").alias("ro3_pass"),
        whole("aromatic_rings").alias("aromatic_rings"),
        real("qed_weighted").alias("qed_weighted"),
    )
    return dedupe(typed, ["molecule_chembl_id"])


def stage_targets(raw: DataFrame, organism: str) -> DataFrame:
    """One row per target of the organism."""
    kept = raw.where(F.col("organism") == organism)
    return dedupe(
        kept.select(
            "target_chembl_id", "pref_name", "organism", "target_type", try_int("tax_id", "bigint").alias("tax_id")
        ),
        ["target_chembl_id"],
    )


def stage_assays(raw: DataFrame, floor: int) -> DataFrame:
    """One row per assay whose (textual) confidence score reaches the floor."""
    typed = raw.select(
        "assay_chembl_id",
        "description",
        "assay_type",
        try_int("confidence_score").alias("confidence_score"),
        "target_chembl_id",
    )
    return dedupe(typed.where(F.col("confidence_score") >= floor), ["assay_chembl_id"])


def stage_cell_activities(raw: DataFrame, standard_types: Sequence[str] = ("GI50", "IC50")) -> DataFrame:
    """Exact cellular readouts in a known unit, with potency on the -log10 molar scale."""
    value = F.col("standard_value").try_cast("double")
    kept = raw.where(
        (F.col("standard_relation") == "=")
        & F.col("standard_type").isin(list(standard_types))
        & F.col("standard_units").isin(list(MOLAR_FACTORS))
        & (value > 0)
    )
    typed = kept.select(
        F.col("activity_id").try_cast("bigint").alias("activity_id"),
        "molecule_chembl_id",
        "molecule_pref_name",
        "canonical_smiles",
        "payload_class",
        "reference_name",
        F.col("target_chembl_id").alias("cell_line_chembl_id"),
        F.col("target_pref_name").alias("cell_line"),
        "assay_chembl_id",
        "standard_type",
        "standard_relation",
        value.alias("standard_value"),
        "standard_units",
    )
    return dedupe(typed, ["activity_id"]).withColumn("p_cyto", molar_potency("standard_value", "standard_units"))


def stage_cheminfo(raw: DataFrame) -> DataFrame:
    """One fingerprint and scaffold row per molecule."""
    return dedupe(
        raw.select(
            "molecule_chembl_id",
            "canonical_smiles",
            "ecfp4_hex",
            "ecfp4_onbits",
            try_int("n_onbits").alias("n_onbits"),
            try_int("heavy_atom_count").alias("heavy_atom_count"),
            "murcko_scaffold_smiles",
            "murcko_generic_smiles",
        ),
        ["molecule_chembl_id"],
    )


def stage_embedding(raw: DataFrame) -> DataFrame:
    """One coordinate pair per molecule."""
    return dedupe(
        raw.select(
            "molecule_chembl_id",
            F.col("umap_x").try_cast("double").alias("umap_x"),
            F.col("umap_y").try_cast("double").alias("umap_y"),
        ),
        ["molecule_chembl_id"],
    )


def explode_json_refs(df: DataFrame, key: str, json: str) -> DataFrame:
    """JSON array of references to rows; a JSON object, 'null', NULL and [] give no rows."""
    is_array = F.ltrim(F.col(json)).startswith("[")
    refs = df.where(is_array).select(
        F.col(key), F.explode(F.from_json(F.col(json), REFERENCE_JSON)).alias("_ref")
    )
    return refs.select(
        F.col(key),
        F.lower("_ref.xref_src").alias("source"),
        F.col("_ref.xref_id").alias("xref_id"),
        F.col("_ref.xref_name").alias("xref_name"),
    ).where(F.col("source").isNotNull() & F.col("xref_id").isNotNull())


def stage_mapping(raw: DataFrame) -> DataFrame:
    """Bulk references with both keys present."""
    return raw.select("molecule_chembl_id", "source", "xref_id").dropna(subset=["molecule_chembl_id", "xref_id"])


def rename_key(raw: DataFrame, source: str, target: str, keep: Sequence[str]) -> DataFrame:
    """Give a landed key its layer name and drop rows lacking any key."""
    return raw.select(F.col(source).alias(target), *keep).dropna(subset=[target, *keep])


def stage_entry_summary(raw: DataFrame) -> DataFrame:
    """Entry metadata with tolerant casts.

    Deduplicated on the entry id, so that the joins reading it cannot fan out.
    """
    typed = raw.where(F.col("pdb_id").isNotNull()).select(
        F.lower("pdb_id").alias("pdb_id"),
        "title",
        "method",
        try_int("year").alias("year"),
        F.col("resolution").try_cast("double").alias("resolution"),
    )
    return dedupe(typed, ["pdb_id"])
