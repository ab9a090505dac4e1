"""Star schema: dimensions and the activity fact.

The stored fact carries natural keys. Dense keys belong to one build of a dimension and
shift when a new member sorts early, so they are attached when the fact is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import dense_key

COMPOUND_COLUMNS = (
    "molecule_chembl_id",
    "pref_name",
    "canonical_smiles",
    "inchi_key",
    "mw_freebase",
    "alogp",
    "hba",
    "hbd",
    "psa",
    "rotatable_bonds",
    "num_ro5_violations",
    "ro3_pass",
    "aromatic_rings",
    "qed_weighted",
    "max_phase",
    "is_approved_drug",
    "molecule_type",
)


def dim_compound(molecules: DataFrame, ranges: int | None = None) -> DataFrame:
    return dense_key(molecules.select(*COMPOUND_COLUMNS), "molecule_chembl_id", "compound_key", ranges)


def dim_target(
    targets: DataFrame, payload_classes: Sequence[tuple[str, str]], ranges: int | None = None
) -> DataFrame:
    """Targets with the class from the configured list (as long as the target set)."""
    keyed = dense_key(
        targets.select("target_chembl_id", "pref_name", "target_type", "organism"),
        "target_chembl_id",
        "target_key",
        ranges,
    )
    classes = targets.sparkSession.createDataFrame(
        list(payload_classes), "target_chembl_id string, payload_class string"
    )
    return keyed.join(classes, "target_chembl_id", "left").select(
        "target_key", "target_chembl_id", "pref_name", "target_type", "organism", "payload_class"
    )


def dim_assay(assays: DataFrame, ranges: int | None = None) -> DataFrame:
    return dense_key(
        assays.select("assay_chembl_id", "description", "assay_type", "confidence_score"),
        "assay_chembl_id",
        "assay_key",
        ranges,
    )


def dim_scaffold(cheminfo: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per scaffold; the representative generic form is the smallest one."""
    grouped = (
        cheminfo.where(F.col("murcko_scaffold_smiles").isNotNull())
        .groupBy("murcko_scaffold_smiles")
        .agg(
            F.min("murcko_generic_smiles").alias("murcko_generic_smiles"),
            F.count_distinct("molecule_chembl_id").alias("n_compounds"),
        )
    )
    return dense_key(grouped, "murcko_scaffold_smiles", "scaffold_key", ranges)


def fact_activity(
    activities: DataFrame, compounds: DataFrame, targets: DataFrame, assays: DataFrame
) -> DataFrame:
    """Measurements whose compound, target and assay are all in the dimensions.

    The dimensions are unique on their natural key, so semi joins give the same rows as
    inner joins without carrying dimension columns. Small sides become broadcast joins by
    their measured size; a hot key on a large side is split by the skew-join rule.
    """
    out = activities
    for dim, key in ((targets, "target_chembl_id"), (assays, "assay_chembl_id"), (compounds, "molecule_chembl_id")):
        out = in_dimension(out, dim, key)
    return out


def in_dimension(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a dimension."""
    return rows.join(dimension.select(key), key, "left_semi").select(*rows.columns)


def fact_star(fact: DataFrame, compounds: DataFrame, targets: DataFrame, assays: DataFrame) -> DataFrame:
    """The fact with the current dense keys in place of the natural ones."""
    return (
        fact.join(targets.select("target_key", "target_chembl_id"), "target_chembl_id")
        .join(assays.select("assay_key", "assay_chembl_id"), "assay_chembl_id")
        .join(compounds.select("compound_key", "molecule_chembl_id"), "molecule_chembl_id")
        .select(
            "activity_id",
            "compound_key",
            "target_key",
            "assay_key",
            "standard_type",
            "standard_relation",
            "standard_value",
            "standard_units",
            "pchembl_value",
            "document_chembl_id",
        )
    )
