"""The declared data tests of the warehouse: which checks hold for which model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import quality
from .warehouse import Warehouse

# Keys, required columns, references, accepted values and bands of the models.
UNIQUE = (
    ("stg_activities", "activity_id"),
    ("stg_molecules", "molecule_chembl_id"),
    ("stg_targets", "target_chembl_id"),
    ("stg_assays", "assay_chembl_id"),
    ("stg_compound_cheminfo", "molecule_chembl_id"),
    ("stg_compound_embedding", "molecule_chembl_id"),
    ("dim_compound", "compound_key"),
    ("dim_compound", "molecule_chembl_id"),
    ("dim_target", "target_key"),
    ("dim_target", "target_chembl_id"),
    ("dim_assay", "assay_key"),
    ("dim_assay", "assay_chembl_id"),
    ("dim_scaffold", "scaffold_key"),
    ("dim_scaffold", "murcko_scaffold_smiles"),
    ("fact_activity", "activity_id"),
    ("mart_compound_selectivity", "compound_key"),
    ("mart_chemical_space", "compound_key"),
    ("mart_compound_catalog", "compound_key"),
    ("mart_compound_fingerprint", "compound_key"),
    ("mart_chemical_series", "scaffold_key"),
    ("mart_payload_class_profile", "payload_class"),
)
NOT_NULL = {
    "stg_activities": ("activity_id", "pchembl_value"),
    "stg_molecules": ("molecule_chembl_id",),
    "stg_targets": ("target_chembl_id",),
    "stg_assays": ("assay_chembl_id", "confidence_score"),
    "stg_compound_cheminfo": ("molecule_chembl_id", "ecfp4_hex"),
    "stg_compound_embedding": ("molecule_chembl_id",),
    "dim_compound": ("compound_key", "molecule_chembl_id"),
    "dim_target": ("target_key", "target_chembl_id"),
    "dim_assay": ("assay_key", "assay_chembl_id"),
    "dim_scaffold": ("scaffold_key", "murcko_scaffold_smiles"),
    "fact_activity": ("activity_id", "pchembl_value", "molecule_chembl_id", "target_chembl_id", "assay_chembl_id"),
    "mart_target_sar": ("median_pchembl", "max_pchembl", "n_measurements"),
    "mart_compound_selectivity": ("compound_key", "n_targets"),
    "mart_chemical_space": ("compound_key",),
    "mart_compound_catalog": ("compound_key", "molecule_chembl_id", "best_pchembl", "n_targets", "has_pdb", "n_pdb_entries"),
    "mart_compound_xref": ("compound_key", "source", "xref_id"),
    "mart_compound_pdb": ("compound_key", "ligand_code", "pdb_id"),
    "mart_compound_fingerprint": ("compound_key", "ecfp4_hex"),
    "mart_activity_cliff": ("tanimoto", "delta_pchembl"),
    "mart_chemical_series": ("scaffold_key", "n_compounds"),
    "mart_payload_class_profile": ("payload_class", "n_compounds", "median_pchembl"),
    "mart_compound_cytotoxicity": ("molecule_chembl_id", "payload_class", "median_p_cyto"),
}
# (model, column, parent, parent's column). The fact is stored with natural keys.
REFERENCES = (
    ("stg_activities", "molecule_chembl_id", "stg_molecules", "molecule_chembl_id"),
    ("stg_activities", "target_chembl_id", "stg_targets", "target_chembl_id"),
    ("stg_assays", "target_chembl_id", "stg_targets", "target_chembl_id"),
    ("fact_activity", "molecule_chembl_id", "dim_compound", "molecule_chembl_id"),
    ("fact_activity", "target_chembl_id", "dim_target", "target_chembl_id"),
    ("fact_activity", "assay_chembl_id", "dim_assay", "assay_chembl_id"),
    ("mart_target_sar", "compound_key", "dim_compound", "compound_key"),
    ("mart_target_sar", "target_key", "dim_target", "target_key"),
    ("mart_chemical_space", "compound_key", "dim_compound", "compound_key"),
    ("mart_compound_catalog", "compound_key", "dim_compound", "compound_key"),
    ("mart_compound_xref", "compound_key", "dim_compound", "compound_key"),
    ("mart_compound_pdb", "compound_key", "dim_compound", "compound_key"),
    ("mart_compound_fingerprint", "compound_key", "dim_compound", "compound_key"),
    ("mart_compound_fingerprint", "scaffold_key", "dim_scaffold", "scaffold_key"),
    ("mart_activity_cliff", "compound_key_a", "dim_compound", "compound_key"),
    ("mart_activity_cliff", "compound_key_b", "dim_compound", "compound_key"),
    ("mart_chemical_series", "scaffold_key", "dim_scaffold", "scaffold_key"),
)
TARGET_TYPES = ("SINGLE PROTEIN", "PROTEIN COMPLEX GROUP", "PROTEIN FAMILY")
GRAINS = (
    ("mart_target_sar", ("compound_key", "target_key")),
    ("mart_compound_xref", ("compound_key", "source", "xref_id")),
    ("mart_compound_pdb", ("compound_key", "ligand_code", "pdb_id")),
    ("mart_compound_cytotoxicity", ("molecule_chembl_id", "cell_line_chembl_id")),
)
BANDS = (
    ("stg_activities", "pchembl_value", 0.0, 14.0),
    ("mart_target_sar", "median_pchembl", 0.0, 14.0),
    ("mart_target_sar", "max_pchembl", 0.0, 14.0),
    ("mart_compound_cytotoxicity", "median_p_cyto", 2.0, 13.0),
    ("mart_compound_selectivity", "selectivity_index", 0.0, None),
)
FLOORED = ("stg_activities", "dim_compound", "fact_activity")


@dataclass(frozen=True)
class Limits:
    """Anomaly limits a deployment may set."""

    min_rows: int = 3
    max_null_rate: float = 0.20
    mean_low: float = 3.0
    mean_high: float = 10.0


def _outside(column: str, low: float | None, high: float | None) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < F.lit(low))
    if high is not None:
        bad = bad | (F.col(column) > F.lit(high))
    return F.coalesce(bad, F.lit(False))


def warehouse_checks(
    w: Warehouse, history: DataFrame | None = None, limits: Limits = Limits(), models: Sequence[str] | None = None
) -> DataFrame:
    """(check, violations, passed) of every declared check; ``models`` restricts it to checks of those models.

    Give it a written warehouse: conditions on rows of one model are counted in one scan, but keys,
    references and grains each read their model again.
    """

    def wanted(*names: str) -> bool:
        return models is None or all(n in models for n in names)

    checks: dict[str, DataFrame] = {}
    rows: dict[str, dict[str, Column]] = {}
    for model, columns in NOT_NULL.items():
        if wanted(model):
            rows.setdefault(model, {}).update({f"{model}.{c} not_null": F.col(c).isNull() for c in columns})
    for model, column, low, high in BANDS:
        if wanted(model):
            rows.setdefault(model, {})[f"{model}.{column} in_band"] = _outside(column, low, high)
    accepted = (("stg_activities", "standard_type", w.config.standard_types), ("stg_targets", "target_type", TARGET_TYPES))
    for model, column, values in accepted:
        if wanted(model):
            bad = F.coalesce(~F.col(column).isin(list(values)), F.lit(False))
            rows.setdefault(model, {})[f"{model}.{column} accepted"] = bad
    if wanted("dim_target"):
        classes = sorted({c for _, c in w.config.payload_classes})
        known = F.coalesce(F.col("payload_class").isin(classes), F.lit(False))
        rows["dim_target"]["dim_target.payload_class known"] = ~known
    if wanted("mart_activity_cliff"):
        under = (F.col("tanimoto") < w.config.cliff_min_tanimoto) | (F.col("delta_pchembl") < w.config.cliff_min_delta)
        rows["mart_activity_cliff"]["mart_activity_cliff thresholds"] = F.coalesce(under, F.lit(False))
        checks["mart_activity_cliff grain"] = quality.check_pair_order(
            w.mart_activity_cliff, "target_key", "compound_key_a", "compound_key_b"
        )
    for model, column in UNIQUE:
        if wanted(model):
            checks[f"{model}.{column} unique"] = quality.check_unique(getattr(w, model), column)
    for child, fk, parent, pk in REFERENCES:
        if wanted(child, parent):
            checks[f"{child}.{fk} references {parent}"] = quality.check_relationship(
                getattr(w, child).select(fk), fk, getattr(w, parent), pk
            )
    for model, columns in GRAINS:
        if wanted(model):
            checks[f"{model} grain"] = quality.check_grain(getattr(w, model), columns)
    floored = {m: getattr(w, m) for m in FLOORED if wanted(m)}
    if floored:
        checks["row floors"] = quality.check_row_floor(floored, limits.min_rows)
    if wanted("dim_compound"):
        checks["dim_compound.canonical_smiles null_rate"] = quality.check_null_rate(
            w.dim_compound, "canonical_smiles", limits.max_null_rate
        )
    if wanted("fact_activity"):
        checks["fact_activity.pchembl_value mean"] = quality.check_mean_band(
            w.fact_activity, "pchembl_value", limits.mean_low, limits.mean_high
        )
    if wanted("mart_chemical_series", "mart_compound_fingerprint"):
        scaffolded = w.mart_compound_fingerprint.where(F.col("scaffold_key").isNotNull())
        checks["mart_chemical_series reconciles"] = quality.check_reconciles(
            w.mart_chemical_series, F.coalesce(F.sum("n_compounds"), F.lit(0)), scaffolded, F.count_distinct("compound_key")
        )
    if history is not None:
        checks["compound_status one_open_window"] = quality.check_one_open_window(history, "molecule_chembl_id")
        checks["compound_status grain"] = quality.check_grain(history, ["molecule_chembl_id", "valid_from"])
    return quality.check_suite(checks, [(getattr(w, model), rules) for model, rules in rows.items()])
