"""Analytical marts.

Exact percentiles keep one counter per distinct value of a group. Potencies live on a
0.01 grid between 0 and 14 (medians on a 0.005 grid), which bounds that state to a few
thousand counters per group whatever the number of rows. ``on_grid`` tells whether a table keeps to
it; where it does not, ``gridded=False`` takes quantiles from ranges of ranked value counts, so that no
task holds the values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import display_name, round_fp
from ..session import materialize
from .positions import exact_quantiles
from .similarity import BLOCK_ROWS, cliffs_in_tiles, cliffs_of_pairs, distinct_sets, group_pairs, prefixes_are_dense, set_class


def on_grid(df: DataFrame, value: str, digits: int = 2) -> bool:
    """Whether all values of a column are 0 to 14 with ``digits`` decimals, so that their number is bounded."""
    v = F.col(value)
    off = (v < 0) | (v > 14) | F.isnan(v) | (F.abs(v - F.round(v, digits)) > 1e-9)
    return df.where(off).limit(1).isEmpty()


def _summary(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], aggregates: Sequence[Column], gridded: bool
) -> DataFrame:
    """The aggregates of every group and the exact quantiles of its values (``_q``)."""
    if gridded:
        return df.groupBy(*keys).agg(F.percentile(value, list(probabilities)).alias("_q"), *aggregates)
    quantiles = exact_quantiles(df, keys, value, probabilities, "_q")
    return df.groupBy(*keys).agg(*aggregates).join(quantiles, list(keys), "left")


def target_sar(fact: DataFrame, compounds: DataFrame, targets: DataFrame, gridded: bool = True) -> DataFrame:
    """Potency summary per (compound, target).

    ``fact`` is the natural-key fact. It is aggregated on its two short keys first (with
    map-side combine, and the distinct assays split over their own key), then the much
    smaller result is joined to the dimensions.
    """
    aggregates = [
        F.max("pchembl_value").alias("max_pchembl"),
        F.count(F.lit(1)).alias("n_measurements"),
        F.count_distinct("assay_chembl_id").alias("n_assays"),
    ]
    summary = _summary(fact, ["molecule_chembl_id", "target_chembl_id"], "pchembl_value", [0.5], aggregates, gridded)
    summary = summary.withColumn("median_pchembl", F.col("_q")[0])
    described = targets.select(
        "target_key", "target_chembl_id", F.col("pref_name").alias("target_pref_name"), "payload_class"
    )
    return (
        summary.join(described, "target_chembl_id")
        .join(compounds.select("compound_key", "molecule_chembl_id"), "molecule_chembl_id")
        .select(
            "compound_key",
            "target_key",
            "molecule_chembl_id",
            "target_chembl_id",
            "target_pref_name",
            "payload_class",
            "median_pchembl",
            "max_pchembl",
            "n_measurements",
            "n_assays",
        )
    )


def selectivity(sar: DataFrame) -> DataFrame:
    """Best, second-best and worst target of every compound and the gaps between them.

    Two partially aggregating passes on one key: totals, and the two best targets
    (a group limit before the shuffle), joined without a further exchange.
    """
    totals = sar.groupBy("compound_key", "molecule_chembl_id").agg(
        F.count(F.lit(1)).alias("n_targets"),
        F.max("median_pchembl").alias("best_pchembl"),
        F.min("median_pchembl").alias("_worst"),
    )
    order = Window.partitionBy("compound_key").orderBy(F.desc("median_pchembl"), "target_chembl_id")
    top = (
        sar.select("compound_key", "target_chembl_id", "median_pchembl")
        .withColumn("_rn", F.row_number().over(order))
        .where("_rn <= 2")
        .groupBy("compound_key")
        .agg(
            F.max(F.when(F.col("_rn") == 1, F.col("target_chembl_id"))).alias("best_target"),
            F.max(F.when(F.col("_rn") == 2, F.col("median_pchembl"))).alias("second_best_pchembl"),
        )
    )
    return totals.join(top, "compound_key").select(
        "compound_key",
        "molecule_chembl_id",
        "n_targets",
        "best_pchembl",
        "best_target",
        "second_best_pchembl",
        (F.col("best_pchembl") - F.col("second_best_pchembl")).alias("selectivity_index"),
        (F.col("best_pchembl") - F.col("_worst")).alias("pchembl_spread"),
    )


def compound_potency(sar: DataFrame) -> DataFrame:
    """Best median and number of targets per compound."""
    return sar.groupBy("compound_key").agg(
        F.max("median_pchembl").alias("best_pchembl"), F.count(F.lit(1)).alias("n_targets")
    )


def chemical_space(
    compounds: DataFrame, selective: DataFrame, fingerprints: DataFrame, embedding: DataFrame
) -> DataFrame:
    """Compound profile with potency, scaffold and coordinates where known.

    The potency columns come with the selectivity mart, which already holds one row per
    measured compound, so the pair table is not aggregated a second time.
    """
    potency = selective.select("compound_key", "best_pchembl", "n_targets", "best_target")
    scaffold = fingerprints.select("compound_key", "murcko_scaffold_smiles")
    return (
        compounds.join(potency, "compound_key", "left")
        .join(scaffold, "compound_key", "left")
        .join(embedding.select("molecule_chembl_id", "umap_x", "umap_y"), "molecule_chembl_id", "left")
        .select(
            "compound_key",
            "molecule_chembl_id",
            "pref_name",
            "mw_freebase",
            "alogp",
            "hba",
            "hbd",
            "psa",
            "rotatable_bonds",
            "num_ro5_violations",
            "aromatic_rings",
            "qed_weighted",
            "is_approved_drug",
            "best_pchembl",
            F.coalesce("n_targets", F.lit(0)).alias("n_targets"),
            "best_target",
            "murcko_scaffold_smiles",
            "umap_x",
            "umap_y",
        )
    )


def fingerprint_mart(cheminfo: DataFrame, compounds: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """Fingerprints keyed to compounds and, for cyclic ones, to their scaffold."""
    return (
        cheminfo.join(compounds.select("compound_key", "molecule_chembl_id"), "molecule_chembl_id")
        .join(scaffolds.select("scaffold_key", "murcko_scaffold_smiles"), "murcko_scaffold_smiles", "left")
        .select(
            "compound_key",
            "molecule_chembl_id",
            "ecfp4_hex",
            "ecfp4_onbits",
            "n_onbits",
            "heavy_atom_count",
            "murcko_scaffold_smiles",
            "scaffold_key",
        )
    )


def chemical_series(fingerprints: DataFrame, sar: DataFrame, scaffolds: DataFrame, gridded: bool = True) -> DataFrame:
    """Size, potency spread and target reach of every scaffold series.

    Ties for the most potent member go to the smallest molecule id.
    """
    members = fingerprints.where(F.col("scaffold_key").isNotNull()).select(
        "scaffold_key", "compound_key", "molecule_chembl_id"
    )
    profile = members.join(compound_potency(sar), "compound_key", "left")
    best = F.col("best_pchembl")
    strongest = F.min(F.when(best.isNotNull(), F.struct((-best).alias("p"), F.col("molecule_chembl_id").alias("id"))))
    aggregates = [
        F.count_distinct("compound_key").alias("n_compounds"),
        F.count_distinct(F.when(best.isNotNull(), F.col("compound_key"))).alias("n_measured_compounds"),
        F.max(best).alias("_max"),
        F.min(best).alias("_min"),
        strongest.getField("id").alias("top_compound"),
    ]
    summary = _summary(profile, ["scaffold_key"], "best_pchembl", [0.5], aggregates, gridded).withColumn("_median", F.col("_q")[0])
    reach = (
        members.join(sar.select("compound_key", "target_key"), "compound_key")
        .groupBy("scaffold_key")
        .agg(F.count_distinct("target_key").alias("_targets"))
    )
    return (
        scaffolds.drop("n_compounds")
        .join(summary, "scaffold_key")
        .join(reach, "scaffold_key", "left")
        .select(
            "scaffold_key",
            "murcko_scaffold_smiles",
            "murcko_generic_smiles",
            "n_compounds",
            "n_measured_compounds",
            F.coalesce("_targets", F.lit(0)).alias("n_targets"),
            round_fp("_median", 2).alias("median_pchembl"),
            round_fp("_max", 2).alias("max_pchembl"),
            round_fp("_min", 2).alias("min_pchembl"),
            round_fp(F.col("_max") - F.col("_min"), 2).alias("pchembl_range"),
            "top_compound",
        )
    )


def cliff_pairs(
    sar: DataFrame,
    fingerprints: DataFrame,
    min_tanimoto: float,
    min_delta: float,
    nbits: int | None = 2048,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Unrounded cliffs: target_key, similarity, a, b, delta (see ``cliffs_of_pairs``).

    Similar structures are found once over all compounds with a potency, which carry their ranges of potency by target, so a
    pair measured on many targets is scored once and leaves the join for the targets where it can be a cliff. Where few bits and
    a low threshold let rare bits rule out little, compounds of a target meet in tiles instead, those of close potency left out.
    """
    structure = fingerprints.where(F.size("ecfp4_onbits") > 0).select(
        "compound_key", "molecule_chembl_id", set_class("ecfp4_onbits").alias("cls"), "murcko_scaffold_smiles"
    )
    measured = materialize(sar.select("target_key", "compound_key", "median_pchembl").join(structure, "compound_key"), "measured")
    if nbits is not None:
        sets = distinct_sets(fingerprints, "ecfp4_onbits", nbits)
        if prefixes_are_dense(sets, min_tanimoto, nbits):
            return cliffs_in_tiles(
                measured, sets, min_tanimoto, nbits, "target_key", "compound_key", "median_pchembl", min_delta, block_rows
            )
    pairs = group_pairs(
        fingerprints, "ecfp4_onbits", min_tanimoto, measured, "target_key", "median_pchembl", min_delta, nbits, block_rows
    )
    return cliffs_of_pairs(measured, pairs, "target_key", "compound_key", "median_pchembl", min_delta, block_rows)


def activity_cliff(
    sar: DataFrame,
    fingerprints: DataFrame,
    targets: DataFrame,
    min_tanimoto: float = 0.75,
    min_delta: float = 1.0,
    nbits: int | None = 2048,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Structurally similar pairs with a large potency gap on one target.

    Thresholds apply to unrounded values, outputs are rounded. SALI is undefined (NULL)
    for identical fingerprints.
    """
    raw = cliff_pairs(sar, fingerprints, min_tanimoto, min_delta, nbits, block_rows)
    similarity, delta = F.col("similarity"), F.col("delta")
    return raw.join(targets.select("target_key", F.col("pref_name").alias("target_pref_name")), "target_key").select(
        "target_key",
        "target_pref_name",
        F.col("a.compound_key").alias("compound_key_a"),
        F.col("b.compound_key").alias("compound_key_b"),
        F.col("a.molecule_chembl_id").alias("molecule_chembl_id_a"),
        F.col("b.molecule_chembl_id").alias("molecule_chembl_id_b"),
        round_fp("a.median_pchembl", 2).alias("pchembl_a"),
        round_fp("b.median_pchembl", 2).alias("pchembl_b"),
        round_fp(delta, 2).alias("delta_pchembl"),
        round_fp(similarity, 3).alias("tanimoto"),
        (similarity >= 1.0).alias("is_identical_fp"),
        (F.col("a.murcko_scaffold_smiles") == F.col("b.murcko_scaffold_smiles")).alias("same_scaffold"),
        F.when(similarity < 1.0, round_fp(delta / (1.0 - similarity), 2)).alias("sali"),
    )


def compound_xref(refs: DataFrame, mapping: DataFrame, compounds: DataFrame, lookup: DataFrame) -> DataFrame:
    """Distinct cross-references with display name and link.

    Duplicates are removed on the three key columns before names and links are added.
    """
    columns = ["molecule_chembl_id", "source", "xref_id"]
    keyed = refs.select(*columns).unionByName(mapping.select(*columns)).distinct()
    return (
        keyed.join(compounds.select("compound_key", "molecule_chembl_id"), "molecule_chembl_id")
        .join(lookup, "source", "left")
        .select(
            "compound_key",
            "molecule_chembl_id",
            "source",
            F.coalesce("display_name", display_name("source")).alias("display_name"),
            "xref_id",
            F.replace("url_template", F.lit("{id}"), "xref_id").alias("url"),
        )
    )


def compound_pdb(
    refs: DataFrame, mapping: DataFrame, structures: DataFrame, summary: DataFrame, compounds: DataFrame
) -> DataFrame:
    """Co-crystal entries per compound and ligand code, with entry metadata."""
    columns = ["molecule_chembl_id", F.col("xref_id").alias("ligand_code")]
    codes = (
        refs.where(F.col("source") == "pdbe")
        .select(*columns)
        .unionByName(mapping.where(F.col("source") == "pdbe").select(*columns))
        .distinct()
    )
    entries = structures.select("ligand_code", "pdb_id").distinct()
    return (
        codes.join(compounds.select("compound_key", "molecule_chembl_id"), "molecule_chembl_id")
        .join(entries.join(summary, "pdb_id", "left"), "ligand_code")
        .select(
            "compound_key", "molecule_chembl_id", "ligand_code", "pdb_id", "title", "method", "year", "resolution"
        )
    )


def compound_catalog(selective: DataFrame, compounds: DataFrame, pdb: DataFrame, targets: DataFrame) -> DataFrame:
    """Identity, properties, potency and structure coverage of every measured compound."""
    coverage = pdb.groupBy("compound_key").agg(F.count_distinct("pdb_id").alias("_entries"))
    best_class = targets.select(F.col("target_chembl_id").alias("best_target"), "payload_class")
    potency = selective.select("compound_key", "n_targets", "best_pchembl", "best_target", "selectivity_index")
    entries = F.coalesce("_entries", F.lit(0))
    return (
        potency.join(compounds, "compound_key")
        .join(coverage, "compound_key", "left")
        .join(best_class, "best_target", "left")
        .select(
            *compounds.columns,
            "n_targets",
            "best_pchembl",
            "best_target",
            "payload_class",
            "selectivity_index",
            entries.alias("n_pdb_entries"),
            (entries > 0).alias("has_pdb"),
        )
    )


def class_profile(sar: DataFrame, gridded: bool = True) -> DataFrame:
    """Potency profile of every payload class (the class comes with the pair table)."""
    aggregates = [
        F.count_distinct("compound_key").alias("n_compounds"),
        F.sum("n_measurements").alias("n_measurements"),
        F.max("max_pchembl").alias("_max"),
        F.count_distinct(F.when(F.col("max_pchembl") >= 9, F.col("compound_key"))).alias("n_sub_nanomolar"),
    ]
    classed = sar.where(F.col("payload_class").isNotNull())
    return _summary(classed, ["payload_class"], "median_pchembl", [0.25, 0.5, 0.75], aggregates, gridded).select(
        "payload_class",
        "n_compounds",
        "n_measurements",
        round_fp(F.col("_q")[1], 3).alias("median_pchembl"),
        round_fp("_max", 3).alias("max_pchembl"),
        round_fp(F.col("_q")[0], 3).alias("p25_pchembl"),
        round_fp(F.col("_q")[2], 3).alias("p75_pchembl"),
        "n_sub_nanomolar",
    )


def cytotoxicity(cell: DataFrame) -> DataFrame:
    """Cellular potency per (payload, cell line); representative names are the smallest.

    Computed potencies are on no fixed grid, so the median comes from ranked value counts
    rather than from a per-group buffer. Rounding to 6 places first makes it independent of
    how the logarithm's last bit comes out.
    """
    keys = ["molecule_chembl_id", "cell_line_chembl_id"]
    rounded = cell.withColumn("_p", round_fp("p_cyto", 6))
    summary = rounded.groupBy(*keys).agg(
        F.min("molecule_pref_name").alias("molecule_pref_name"),
        F.min("reference_name").alias("reference_name"),
        F.min("payload_class").alias("payload_class"),
        F.min("cell_line").alias("cell_line"),
        F.count(F.lit(1)).alias("n_measurements"),
        F.max("_p").alias("_max"),
    )
    medians = exact_quantiles(rounded, keys, "_p", [0.5], "_q")
    return summary.join(medians, keys).select(
        "molecule_chembl_id",
        "cell_line_chembl_id",
        "molecule_pref_name",
        "reference_name",
        "payload_class",
        "cell_line",
        "n_measurements",
        round_fp(F.col("_q")[0], 3).alias("median_p_cyto"),
        round_fp("_max", 3).alias("max_p_cyto"),
    )
