"""Driver-side configuration: which targets, endpoints and lookups are in scope."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class TargetSet:
    """Scope and thresholds of one warehouse build."""

    release: str
    organism: str
    standard_types: tuple[str, ...]
    min_confidence: int
    payload_classes: tuple[tuple[str, str], ...]
    reference_payloads: tuple[tuple[str, str, str], ...] = ()
    cell_types: tuple[str, ...] = ("GI50", "IC50")
    cell_assay_type: str = "F"
    xref_sources: tuple[tuple[str, str, str], ...] = ()
    cliff_min_tanimoto: float = 0.75
    cliff_min_delta: float = 1.0
    fingerprint_bits: int = 2048
    class_labels: tuple[tuple[str, str], ...] = field(default=())

    def target_ids(self) -> list[str]:
        return [t for t, _ in self.payload_classes]


# The published target set, endpoint types, payload classes and link
# templates. They must equal the public definitions for results to agree.
PAYLOAD_CLASSES = (
    ("CHEMBL2095182", "tubulin_inhibitor"),
    ("CHEMBL3832942", "tubulin_inhibitor"),
    ("CHEMBL1781", "topo1_inhibitor"),
    ("CHEMBL1806", "topo2_inhibitor"),
)
CLASS_LABELS = (
    ("tubulin_inhibitor", "Tubulin inhibitor"),
    ("topo1_inhibitor", "Topoisomerase-I inhibitor"),
    ("topo2_inhibitor", "Topoisomerase-II inhibitor"),
)
STANDARD_TYPES = ("IC50", "GI50", "Ki", "Kd", "EC50")
REFERENCE_PAYLOADS = (
    ("CHEMBL65", "Camptothecin", "topo1_inhibitor"),
    ("CHEMBL1743143", "SN-38", "topo1_inhibitor"),
    ("CHEMBL1614650", "Exatecan", "topo1_inhibitor"),
    ("CHEMBL84", "Topotecan", "topo1_inhibitor"),
    ("CHEMBL481", "Irinotecan", "topo1_inhibitor"),
    ("CHEMBL2111084", "Belotecan", "topo1_inhibitor"),
    ("CHEMBL4082989", "MMAE", "tubulin_inhibitor"),
    ("CHEMBL5184029", "MMAF", "tubulin_inhibitor"),
    ("CHEMBL4802230", "Mertansine (DM1)", "tubulin_inhibitor"),
    ("CHEMBL292702", "Maytansine", "tubulin_inhibitor"),
)
XREF_SOURCES = (
    ("pubchem", "PubChem", "https://pubchem.ncbi.nlm.nih.gov/compound/{id}"),
    ("drugbank", "DrugBank", "https://go.drugbank.com/drugs/{id}"),
    ("pdbe", "PDBe", "https://www.ebi.ac.uk/pdbe-srv/pdbechem/chemicalCompound/show/{id}"),
    (
        "bindingdb",
        "BindingDB",
        "https://www.bindingdb.org/rwd/bind/chemsearch/marvin/MolStructure.jsp?monomerid={id}",
    ),
    ("zinc", "ZINC", "https://zinc20.docking.org/substances/{id}/"),
    ("surechembl", "SureChEMBL", "https://www.surechembl.org/chemical/{id}"),
    ("wikipedia", "Wikipedia", "https://en.wikipedia.org/wiki/{id}"),
    ("ema", "EMA", "https://www.ema.europa.eu/en/medicines/{id}"),
    ("dailymed", "DailyMed", "https://dailymed.nlm.nih.gov/dailymed/search.cfm?query={id}"),
)
# Bulk mapping dumps by source name -> number in the dump's file name.
BULK_SOURCES = {"pubchem": 22, "drugbank": 2, "pdbe": 5, "bindingdb": 31, "surechembl": 15}


def default_target_set() -> TargetSet:
    """The public release-36 scope."""
    return TargetSet(
        release="36",
        organism="Homo sapiens",
        standard_types=STANDARD_TYPES,
        min_confidence=5,
        payload_classes=PAYLOAD_CLASSES,
        reference_payloads=REFERENCE_PAYLOADS,
        xref_sources=XREF_SOURCES,
        class_labels=CLASS_LABELS,
    )


def target_set(scope: Mapping) -> TargetSet:
    """The scope a mapping describes: release, organism, targets with classes, activity and cell filters, payloads.

    Raises ValueError on a missing key, a repeated target or a payload of an unknown class.
    """

    def need(where: Mapping, *path: str):
        for key in path:
            if not isinstance(where, Mapping) or key not in where:
                raise ValueError(f"the scope has no {'.'.join(path)}")
            where = where[key]
        return where

    targets = tuple((str(need(t, "chembl_id")), str(need(t, "payload_class"))) for t in need(scope, "targets"))
    ids = [t for t, _ in targets]
    if not ids or len(set(ids)) < len(ids):
        raise ValueError("targets are missing or repeated")
    payloads = tuple(
        (str(need(p, "molecule_chembl_id")), str(need(p, "name")), str(need(p, "payload_class")))
        for p in scope.get("reference_payloads") or ()
    )
    unknown = {c for _, _, c in payloads} - {c for _, c in targets}
    if unknown:
        raise ValueError(f"payloads of classes without a target: {', '.join(sorted(unknown))}")
    cell = scope.get("cell_activity") or {}
    base = default_target_set()
    return TargetSet(
        release=str(need(scope, "chembl_version")),
        organism=str(need(scope, "organism")),
        standard_types=tuple(need(scope, "activity", "standard_types")),
        min_confidence=int(need(scope, "activity", "min_confidence_score")),
        payload_classes=targets,
        reference_payloads=payloads,
        cell_types=tuple(cell.get("standard_types", base.cell_types)),
        cell_assay_type=str(cell.get("assay_type", base.cell_assay_type)),
        xref_sources=base.xref_sources,
        class_labels=base.class_labels,
    )


def load_target_set(path: str | Path) -> TargetSet:
    """The scope written in a JSON or YAML file; YAML needs the ``yaml`` package."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return target_set(json.loads(text))
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading YAML needs the yaml package; JSON works without it") from missing
    return target_set(yaml.safe_load(text))
