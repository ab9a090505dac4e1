"""The layered warehouse: every model as a lazy frame, optionally written layer by layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TargetSet
from ..operators import dimensions as dims
from ..operators import marts, staging
from ..operators.history_store import HistoryStore
from ..operators.keyed import KeyedTable
from ..sources.raw import read_raw
from ..sources.schemas import RAW_SCHEMAS

STATUS_COLUMNS = ("max_phase", "is_approved_drug", "pref_name")

# Dependency order of a full build.
MODELS = (
    "stg_activities",
    "stg_cell_activities",
    "stg_molecules",
    "stg_targets",
    "stg_assays",
    "stg_compound_cheminfo",
    "stg_compound_embedding",
    "stg_compound_xref",
    "stg_compound_xref_unichem",
    "stg_pdbe_structure",
    "stg_pdbe_summary",
    "dim_compound",
    "dim_target",
    "dim_assay",
    "dim_scaffold",
    "fact_activity",
    "mart_target_sar",
    "mart_compound_selectivity",
    "mart_compound_fingerprint",
    "mart_chemical_space",
    "mart_chemical_series",
    "mart_activity_cliff",
    "mart_compound_xref",
    "mart_compound_pdb",
    "mart_compound_catalog",
    "mart_payload_class_profile",
    "mart_compound_cytotoxicity",
)


class Warehouse:
    """Models over raw frames. Each attribute is a lazy frame, built once."""

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        config: TargetSet,
        ranges: int | None = None,
    ) -> None:
        self.raw = raw
        self.config = config
        self.ranges = ranges
        #: Whether potencies keep to their grid; a build measures it on the fact it has stored.
        self.gridded = True
        self.report: DataFrame | None = None

    # staging
    @cached_property
    def stg_activities(self) -> DataFrame:
        return staging.stage_activities(self.raw["activities"], self.config.standard_types)

    @cached_property
    def stg_cell_activities(self) -> DataFrame:
        return staging.stage_cell_activities(self.raw["cell_activities"], self.config.cell_types)

    @cached_property
    def stg_molecules(self) -> DataFrame:
        return staging.stage_molecules(self.raw["molecules"])

    @cached_property
    def stg_targets(self) -> DataFrame:
        return staging.stage_targets(self.raw["targets"], self.config.organism)

    @cached_property
    def stg_assays(self) -> DataFrame:
        return staging.stage_assays(self.raw["assays"], self.config.min_confidence)

    @cached_property
    def stg_compound_cheminfo(self) -> DataFrame:
        return staging.stage_cheminfo(self.raw["compound_cheminfo"])

    @cached_property
    def stg_compound_embedding(self) -> DataFrame:
        return staging.stage_embedding(self.raw["compound_embedding"])

    @cached_property
    def stg_compound_xref(self) -> DataFrame:
        return staging.explode_json_refs(self.raw["molecules"], "molecule_chembl_id", "cross_references")

    @cached_property
    def stg_compound_xref_unichem(self) -> DataFrame:
        return staging.stage_mapping(self.raw["xref_unichem"])

    @cached_property
    def stg_pdbe_structure(self) -> DataFrame:
        return staging.rename_key(self.raw["pdbe_structures"], "xref_id", "ligand_code", ["pdb_id"])

    @cached_property
    def stg_pdbe_summary(self) -> DataFrame:
        return staging.stage_entry_summary(self.raw["pdbe_summary"])

    # star schema
    @cached_property
    def dim_compound(self) -> DataFrame:
        return dims.dim_compound(self.stg_molecules, self.ranges)

    @cached_property
    def dim_target(self) -> DataFrame:
        return dims.dim_target(self.stg_targets, self.config.payload_classes, self.ranges)

    @cached_property
    def dim_assay(self) -> DataFrame:
        return dims.dim_assay(self.stg_assays, self.ranges)

    @cached_property
    def dim_scaffold(self) -> DataFrame:
        return dims.dim_scaffold(self.stg_compound_cheminfo, self.ranges)

    @cached_property
    def fact_activity(self) -> DataFrame:
        """Natural-key fact; staging frames suffice to decide membership."""
        return dims.fact_activity(self.stg_activities, self.stg_molecules, self.stg_targets, self.stg_assays)

    def _activities(self, needs_assay: bool) -> DataFrame:
        """The stored fact, or staged activities for consumers that join the dimensions anyway.

        Their inner joins keep just the rows the fact has, so the fact's semi joins would be work done twice.
        """
        if "fact_activity" in self.__dict__:
            return self.fact_activity
        return dims.in_dimension(self.stg_activities, self.stg_assays, "assay_chembl_id") if needs_assay else self.stg_activities

    @cached_property
    def fact_star(self) -> DataFrame:
        return dims.fact_star(self._activities(False), self.dim_compound, self.dim_target, self.dim_assay)

    # marts
    @cached_property
    def mart_target_sar(self) -> DataFrame:
        return marts.target_sar(self._activities(True), self.dim_compound, self.dim_target, self.gridded)

    @cached_property
    def mart_compound_selectivity(self) -> DataFrame:
        return marts.selectivity(self.mart_target_sar)

    @cached_property
    def mart_compound_fingerprint(self) -> DataFrame:
        return marts.fingerprint_mart(self.stg_compound_cheminfo, self.dim_compound, self.dim_scaffold)

    @cached_property
    def mart_chemical_space(self) -> DataFrame:
        return marts.chemical_space(
            self.dim_compound, self.mart_compound_selectivity, self.mart_compound_fingerprint, self.stg_compound_embedding
        )

    @cached_property
    def mart_chemical_series(self) -> DataFrame:
        return marts.chemical_series(self.mart_compound_fingerprint, self.mart_target_sar, self.dim_scaffold, self.gridded)

    @cached_property
    def mart_activity_cliff(self) -> DataFrame:
        return marts.activity_cliff(
            self.mart_target_sar,
            self.mart_compound_fingerprint,
            self.dim_target,
            self.config.cliff_min_tanimoto,
            self.config.cliff_min_delta,
            self.config.fingerprint_bits,
        )

    @cached_property
    def xref_lookup(self) -> DataFrame:
        spark = self.raw["molecules"].sparkSession
        return spark.createDataFrame(
            list(self.config.xref_sources), "source string, display_name string, url_template string"
        )

    @cached_property
    def mart_compound_xref(self) -> DataFrame:
        return marts.compound_xref(
            self.stg_compound_xref, self.stg_compound_xref_unichem, self.dim_compound, self.xref_lookup
        )

    @cached_property
    def mart_compound_pdb(self) -> DataFrame:
        return marts.compound_pdb(
            self.stg_compound_xref,
            self.stg_compound_xref_unichem,
            self.stg_pdbe_structure,
            self.stg_pdbe_summary,
            self.dim_compound,
        )

    @cached_property
    def mart_compound_catalog(self) -> DataFrame:
        return marts.compound_catalog(
            self.mart_compound_selectivity, self.dim_compound, self.mart_compound_pdb, self.dim_target
        )

    @cached_property
    def mart_payload_class_profile(self) -> DataFrame:
        return marts.class_profile(self.mart_target_sar, self.gridded)

    @cached_property
    def mart_compound_cytotoxicity(self) -> DataFrame:
        return marts.cytotoxicity(self.stg_cell_activities)


def raw_frames(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """All raw entities of a folder."""
    return {entity: read_raw(spark, raw_dir, entity) for entity in RAW_SCHEMAS}


def _status(spark: SparkSession, out_dir: str) -> HistoryStore:
    return HistoryStore(spark, f"{out_dir}/compound_status", "molecule_chembl_id", STATUS_COLUMNS)


def compound_status(spark: SparkSession, out_dir: str, version: int | None = None) -> DataFrame | None:
    """The Type-2 status history as of a finished version, by default the last, or None before the first build."""
    return _status(spark, out_dir).read(version)


def expire_versions(spark: SparkSession, out_dir: str, keep: int = 2) -> list[int]:
    """Forget history versions older than the ``keep`` newest finished ones; returns their numbers.

    The open windows are written together first, so that what older versions had opened can go; closed windows stay.
    """
    store = _status(spark, out_dir)
    store.compact()
    return store.expire(keep)


def facts(spark: SparkSession, out_dir: str) -> KeyedTable:
    """The stored fact: files by buckets of the activity id, with sketches of their ids."""
    return KeyedTable(spark, f"{out_dir}/fact_activity", "activity_id")


def build(
    spark: SparkSession, raw_dir: str, out_dir: str, config: TargetSet, now: str, check: bool = False
) -> Warehouse:
    """Build every model into ``out_dir`` and return the warehouse reading from there.

    Each model is written once and read back by its consumers, which also cuts lineage.
    The fact only gets the activity ids it does not hold yet; the status history gets a new
    version; everything else is replaced. With ``check`` the declared checks run over what was
    written, and their (check, violations, passed) rows are the warehouse's ``report``.
    """
    warehouse = Warehouse(raw_frames(spark, raw_dir), config)
    for model in MODELS:
        if model == "fact_activity":
            # Unseen ids first, so that only they meet the dimensions.
            stored = facts(spark, out_dir)
            unseen = stored.unseen(warehouse.stg_activities)
            stored.append_unseen(dims.fact_activity(unseen, warehouse.stg_molecules, warehouse.stg_targets, warehouse.stg_assays))
            written = stored.read()
            written = unseen.limit(0) if written is None else written
            warehouse.gridded = marts.on_grid(written, "pchembl_value")
        else:
            path = f"{out_dir}/{model}"
            getattr(warehouse, model).write.mode("overwrite").parquet(path)
            written = spark.read.parquet(path)
        # The property is cached per instance: consumers built later read the written layer.
        warehouse.__dict__[model] = written
    current = warehouse.stg_molecules.select("molecule_chembl_id", *STATUS_COLUMNS)
    _status(spark, out_dir).apply(current, F.lit(now).cast("timestamp"))
    if check:
        from .checks import warehouse_checks

        warehouse.report = warehouse_checks(warehouse, compound_status(spark, out_dir))
    return warehouse
