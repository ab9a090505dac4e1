"""Declared schemas of the raw entities and the rules checked before landing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PROVENANCE = ("_fetch_ts", "_source_endpoint", "_chembl_version", "_row_hash")


def _schema(ddl: str, provenance: tuple[str, ...] = PROVENANCE) -> T.StructType:
    fields = [part.strip().rsplit(" ", 1) for part in ddl.split(",")]
    fields += [[p, "int" if p.endswith("_seed") else "string"] for p in provenance]
    return T.StructType([T.StructField(n, T._parse_datatype_string(t), True) for n, t in fields])


def _ddl(ddl: str, provenance: tuple[str, ...] = PROVENANCE):
    return lambda: _schema(ddl, provenance)


_STRUCTURE = "molecule_structures."
_PROPERTY = "molecule_properties."

# Lazily built, because parsing a type string needs an active session.
RAW_SCHEMAS = {
    "activities": _ddl(
        "activity_id bigint, molecule_chembl_id string, target_chembl_id string, assay_chembl_id string,"
        " standard_type string, standard_relation string, standard_value double, standard_units string,"
        " pchembl_value double, data_validity_comment string, document_chembl_id string"
    ),
    "cell_activities": _ddl(
        "activity_id bigint, molecule_chembl_id string, molecule_pref_name string, canonical_smiles string,"
        " payload_class string, reference_name string, target_chembl_id string, target_pref_name string,"
        " assay_chembl_id string, standard_type string, standard_relation string, standard_value double,"
        " standard_units string"
    ),
    "molecules": _ddl(
        "molecule_chembl_id string, pref_name string, max_phase double, molecule_type string,"
        f" cross_references string, {_STRUCTURE}canonical_smiles string, {_STRUCTURE}standard_inchi_key string,"
        f" {_PROPERTY}mw_freebase double, {_PROPERTY}alogp double, {_PROPERTY}hba int, {_PROPERTY}hbd int,"
        f" {_PROPERTY}psa double, {_PROPERTY}rtb int, {_PROPERTY}num_ro5_violations int,"
        f" {_PROPERTY}ro3_pass string, {_PROPERTY}aromatic_rings int, {_PROPERTY}qed_weighted double"
    ),
    "targets": _ddl(
        "target_chembl_id string, pref_name string, organism string, target_type string, tax_id bigint"
    ),
    "assays": _ddl(
        "assay_chembl_id string, description string, assay_type string, confidence_score string,"
        " target_chembl_id string"
    ),
    "xref_unichem": _ddl("molecule_chembl_id string, source string, xref_id string"),
    "pdbe_structures": _ddl("xref_id string, pdb_id string"),
    "pdbe_summary": _ddl("pdb_id string, title string, method string, year string, resolution string"),
    "compound_cheminfo": _ddl(
        "molecule_chembl_id string, canonical_smiles string, ecfp4_hex string, ecfp4_onbits array<int>,"
        " n_onbits int, heavy_atom_count int, murcko_scaffold_smiles string, murcko_generic_smiles string",
        ("_fetch_ts", "_source", "_rdkit_version", "_row_hash"),
    ),
    "compound_embedding": _ddl(
        "molecule_chembl_id string, umap_x double, umap_y double",
        ("_fetch_ts", "_source", "_umap_version", "_embedding_seed", "_row_hash"),
    ),
}


@dataclass(frozen=True)
class Rule:
    """One declared column: its type and whether NULL is allowed."""

    column: str
    type: str
    nullable: bool = True


_STAMPS = tuple(Rule(c, "string", False) for c in PROVENANCE)


def _text(*columns: str) -> tuple[Rule, ...]:
    return tuple(Rule(c, "string") for c in columns)


RULES: dict[str, tuple[Rule, ...]] = {
    "activities": _text("molecule_chembl_id", "target_chembl_id", "assay_chembl_id", "standard_type")
    + (Rule("pchembl_value", "double"),)
    + _STAMPS,
    "cell_activities": _text(
        "molecule_chembl_id",
        "target_chembl_id",
        "assay_chembl_id",
        "standard_type",
        "payload_class",
        "reference_name",
    )
    + _STAMPS,
    "molecules": _text("molecule_chembl_id") + _STAMPS,
    "targets": _text("target_chembl_id") + _STAMPS,
    "assays": _text("assay_chembl_id") + _STAMPS,
    "compound_cheminfo": (
        Rule("molecule_chembl_id", "string", False),
        Rule("ecfp4_hex", "string", False),
        Rule("ecfp4_onbits", "array<int>", False),
        Rule("n_onbits", "int", False),
        Rule("heavy_atom_count", "int", False),
        Rule("murcko_scaffold_smiles", "string"),
        Rule("murcko_generic_smiles", "string"),
        Rule("_fetch_ts", "string", False),
        Rule("_source", "string", False),
        Rule("_rdkit_version", "string", False),
        Rule("_row_hash", "string", False),
    ),
    "compound_embedding": (
        Rule("molecule_chembl_id", "string", False),
        Rule("umap_x", "double", False),
        Rule("umap_y", "double", False),
        Rule("_fetch_ts", "string", False),
        Rule("_source", "string", False),
        Rule("_umap_version", "string", False),
        Rule("_embedding_seed", "int", False),
        Rule("_row_hash", "string", False),
    ),
}
