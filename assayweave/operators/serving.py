"""Queries behind the pages of a serving layer. Only small final pages get collected.

``keys`` arguments are frames with the key column: one job answers any number of
entities. Ordered results carry a total order, so pages are reproducible.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import contains_all, hex_to_words, tanimoto_words
from ..functions.scalar import (
    heavy_atom_efficiency,
    lipophilic_efficiency,
    lookup_label,
    one_decimal,
    round_fp,
)
from ..session import materialize
from .marts import compound_potency
from .neighbors import nearest_in_index
from .positions import ROWS_PER_RANGE, global_position, group_rank

# Rule-of-five limits, and method names with their short forms.
RO5_LIMITS = (("mw", "mw_freebase", 500.0), ("logp", "alogp", 5.0), ("hbd", "hbd", 5.0), ("hba", "hba", 10.0))
METHOD_SHORT = (
    ("X-ray diffraction", "X-ray"),
    ("Electron Microscopy", "cryo-EM"),
    ("Solution NMR", "NMR"),
    ("Solid-state NMR", "ss-NMR"),
    ("Neutron Diffraction", "neutron"),
)


@dataclass(frozen=True)
class Scope:
    """Facets a user has chosen; empty or zero means not restricted."""

    targets: tuple[str, ...] = ()
    approval: str = "all"
    min_pchembl: float = 0.0
    structure_only: bool = False


def _by_keys(df: DataFrame, column: str, keys: DataFrame | int | str) -> DataFrame:
    if isinstance(keys, DataFrame):
        return df.join(keys.select(column).distinct(), column, "left_semi")
    return df.where(F.col(column) == F.lit(keys))


# --- lookups for one or many entities -----------------------------------------------


def series_members(
    fingerprints: DataFrame, compounds: DataFrame, sar: DataFrame, keys: DataFrame | int
) -> DataFrame:
    """Members of scaffold series with their unrounded best potency (``potency``) and number of targets."""
    members = _by_keys(fingerprints, "scaffold_key", keys).select("scaffold_key", "compound_key")
    # Restrict the pair table to the wanted compounds before it is aggregated.
    potency = compound_potency(sar.join(members.select("compound_key"), "compound_key", "left_semi"))
    identity = compounds.select("compound_key", "molecule_chembl_id", "pref_name", "canonical_smiles")
    return (
        members.join(identity, "compound_key")
        .join(potency, "compound_key", "left")
        .select(
            "scaffold_key",
            "molecule_chembl_id",
            "pref_name",
            "canonical_smiles",
            F.col("best_pchembl").alias("potency"),
            F.coalesce("n_targets", F.lit(0)).alias("n_targets"),
        )
    )


def scaffold_members(
    fingerprints: DataFrame, compounds: DataFrame, sar: DataFrame, keys: DataFrame | int
) -> DataFrame:
    """Members of scaffold series with best potency and number of targets, most potent first.

    Shown rounded, ordered by the unrounded value.
    """
    return (
        series_members(fingerprints, compounds, sar, keys)
        .orderBy("scaffold_key", F.desc_nulls_last("potency"), "molecule_chembl_id")
        .select(
            "scaffold_key",
            "molecule_chembl_id",
            "pref_name",
            "canonical_smiles",
            round_fp("potency", 2).alias("best_pchembl"),
            "n_targets",
        )
    )


def compound_row(catalog: DataFrame, compounds: DataFrame, keys: DataFrame | str) -> DataFrame:
    """Catalog record per molecule id; unmeasured ones fall back to the dimension."""
    measured = _by_keys(catalog, "molecule_chembl_id", keys)
    wanted = _by_keys(compounds, "molecule_chembl_id", keys)
    unmeasured = wanted.join(measured.select("molecule_chembl_id"), "molecule_chembl_id", "left_anti")
    return measured.unionByName(unmeasured.select(*compounds.columns), allowMissingColumns=True)


def target_profile(sar: DataFrame, keys: DataFrame | int) -> DataFrame:
    """Per-target potency of compounds, most potent first by the unrounded median."""
    return (
        _by_keys(sar, "compound_key", keys)
        .orderBy("compound_key", F.desc("median_pchembl"), "target_pref_name")
        .select(
            "compound_key",
            F.col("target_pref_name").alias("target"),
            round_fp("median_pchembl", 2).alias("median_pchembl"),
            round_fp("max_pchembl", 2).alias("max_pchembl"),
            "n_measurements",
            "n_assays",
        )
    )


def xref_summary(xref: DataFrame, keys: DataFrame | int) -> DataFrame:
    """Per display name: the smallest reference, its link, and the number of references."""
    first = F.min(F.struct("xref_id", "url"))
    return (
        _by_keys(xref, "compound_key", keys)
        .groupBy("compound_key", "display_name")
        .agg(first.alias("_f"), F.count(F.lit(1)).alias("n_refs"))
        .select("compound_key", "display_name", "_f.xref_id", "_f.url", "n_refs")
        .orderBy("compound_key", "display_name")
    )


def pdb_entries(pdb: DataFrame, keys: DataFrame | int) -> DataFrame:
    """Distinct entries of compounds.

    They come in tasks of one ligand code each, which may hold very many: they are dealt anew before any is compared.
    """
    columns = ["compound_key", "ligand_code", "pdb_id", "title", "method", "year", "resolution"]
    return _by_keys(pdb, "compound_key", keys).select(*columns).repartition(*columns).distinct().orderBy(
        "compound_key", "pdb_id", "ligand_code"
    )


# --- overview -----------------------------------------------------------------------


def target_names(targets: DataFrame) -> DataFrame:
    return targets.select("pref_name").orderBy("pref_name")


def target_summary(sar: DataFrame, targets: DataFrame) -> DataFrame:
    """Compounds, pairs, median and best potency per target name and type.

    Several keys may share a name, so names are joined before the aggregation.
    """
    per_key = sar.select("target_key", "compound_key", "median_pchembl", "max_pchembl").join(
        targets.select("target_key", "pref_name", "target_type"), "target_key"
    )
    return (
        per_key.groupBy(F.col("pref_name").alias("target"), "target_type")
        .agg(
            F.count_distinct("compound_key").alias("n_compounds"),
            F.count(F.lit(1)).alias("n_pairs"),
            round_fp(F.median("median_pchembl"), 2).alias("median_pchembl"),
            round_fp(F.max("max_pchembl"), 2).alias("best_pchembl"),
        )
        .orderBy(F.desc("n_pairs"), "target")
    )


def confidence_distribution(fact: DataFrame, assays: DataFrame) -> DataFrame:
    """Activities and assays per confidence score.

    Counted per assay before the join, so the fact is shuffled as partial counts only.
    """
    per_assay = fact.groupBy("assay_chembl_id").agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_assay.join(assays.select("assay_chembl_id", "confidence_score"), "assay_chembl_id")
        .groupBy("confidence_score")
        .agg(F.sum("_n").alias("n_activities"), F.count(F.lit(1)).alias("n_assays"))
        .orderBy("confidence_score")
    )


def type_distribution(fact: DataFrame) -> DataFrame:
    """Activities and compounds per endpoint type."""
    return (
        fact.groupBy("standard_type")
        .agg(F.count(F.lit(1)).alias("n_activities"), F.count_distinct("molecule_chembl_id").alias("n_compounds"))
        .orderBy(F.desc("n_activities"), "standard_type")
    )


def layer_counts(spark, tables: Mapping[str, str | DataFrame]) -> DataFrame:
    """Row count per table; paths that cannot be read are skipped."""
    counts = []
    for name, table in tables.items():
        try:
            df = table if isinstance(table, DataFrame) else spark.read.parquet(table)
        except AnalysisException:
            continue
        counts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows"))
    if not counts:
        return spark.createDataFrame([], "table string, rows bigint")
    return reduce(DataFrame.unionByName, counts)


def headline_metrics(compounds: DataFrame, fact: DataFrame, targets: DataFrame) -> DataFrame:
    """Four headline counts, one scan per table."""
    by_compound = compounds.agg(
        F.count(F.lit(1)).alias("compounds"), F.count_if("is_approved_drug").alias("approved")
    )

    def rows(df: DataFrame, *names: str) -> DataFrame:
        return df.select(
            F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names]))
        )

    return (
        rows(by_compound, "compounds", "approved")
        .unionByName(rows(fact.agg(F.count(F.lit(1)).alias("activities")), "activities"))
        .unionByName(rows(targets.agg(F.count(F.lit(1)).alias("targets")), "targets"))
    )


# --- scope --------------------------------------------------------------------------


def resolve_scope(sar: DataFrame, catalog: DataFrame, scope: Scope) -> DataFrame:
    """Compound keys passing every chosen facet."""
    pairs = sar.where(F.col("target_pref_name").isin(list(scope.targets))) if scope.targets else sar
    kept = catalog
    if scope.approval == "approved":
        kept = kept.where(F.col("is_approved_drug"))
    elif scope.approval == "research":
        kept = kept.where(~F.col("is_approved_drug"))
    if scope.min_pchembl > 0:
        kept = kept.where(F.coalesce("best_pchembl", F.lit(-1.0)) >= scope.min_pchembl)
    if scope.structure_only and "has_pdb" in catalog.columns:
        kept = kept.where(F.coalesce("has_pdb", F.lit(False)))
    return kept.join(pairs.select("compound_key"), "compound_key", "left_semi").select("compound_key").distinct()


def scoped_sar(sar: DataFrame, scope: Scope, keys: DataFrame) -> DataFrame:
    """Pairs of the compounds in scope, limited to the chosen targets."""
    pairs = sar.where(F.col("target_pref_name").isin(list(scope.targets))) if scope.targets else sar
    return pairs.join(keys.select("compound_key"), "compound_key", "left_semi")


def overview_metrics(sar: DataFrame, catalog: DataFrame, scope: Scope) -> DataFrame:
    """Six headline numbers of a scope, as (metric, value) rows."""
    keys = resolve_scope(sar, catalog, scope)
    pairs = scoped_sar(sar, scope, keys).agg(
        F.coalesce(F.sum("n_measurements"), F.lit(0)).alias("activities"),
        F.count_distinct("target_pref_name").alias("targets"),
        F.count(F.lit(1)).alias("pairs"),
    )
    compounds = catalog.join(keys, "compound_key", "left_semi").agg(
        F.count(F.lit(1)).alias("compounds"),
        F.count_if(F.col("n_targets") >= 2).alias("multi_target"),
        F.count_if("is_approved_drug").alias("approved"),
    )

    def rows(df: DataFrame) -> DataFrame:
        return df.select(
            F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in df.columns]))
        )

    return rows(compounds).unionByName(rows(pairs))


# --- per-compound properties ----------------------------------------------------------


def ro5_breakdown(df: DataFrame) -> DataFrame:
    """Add one pass flag per rule (NULL when unknown) and the number of known violations."""
    flags = {f"{name}_ok": F.col(column) <= F.lit(limit) for name, column, limit in RO5_LIMITS}
    violations: Column = F.lit(0)
    for flag in flags.values():
        violations = violations + F.coalesce((~flag).cast("int"), F.lit(0))
    return df.withColumns({**flags, "violations": violations})


def efficiency(df: DataFrame, potency: str = "best_pchembl", atoms: str = "heavy_atoms", logp: str = "alogp") -> DataFrame:
    """Add ligand and lipophilic efficiency."""
    return df.withColumns(
        {
            "ligand_efficiency": heavy_atom_efficiency(potency, atoms),
            "lipophilic_efficiency": lipophilic_efficiency(potency, logp),
        }
    )


def score_pairs(pairs: DataFrame, fingerprints: DataFrame, key: str, hexed: str, nbits: int = 2048) -> DataFrame:
    """Similarity of given (``{key}_a``, ``{key}_b``) pairs; a missing fingerprint gives 0.0."""
    packed = fingerprints.select(F.col(key), hex_to_words(hexed, nbits).alias("_w"))
    out = pairs
    for s in ("a", "b"):
        side = packed.select(F.col(key).alias(f"{key}_{s}"), F.col("_w").alias(f"_w_{s}"))
        out = out.join(side, f"{key}_{s}", "left")
    return out.withColumn("tanimoto", tanimoto_words("_w_a", "_w_b")).drop("_w_a", "_w_b")


def nearest_neighbors(
    key: int | str,
    fingerprints: DataFrame,
    catalog: DataFrame,
    k: int = 10,
    min_similarity: float = 0.0,
    include_self: bool = False,
    nbits: int = 2048,
    index: DataFrame | None = None,
) -> DataFrame:
    """The k most similar compounds of one query with their potency difference.

    The query's own row is one lookup; its fingerprint becomes a literal, so the rest is
    a scan with a top-k, whatever the table size. Attributes are joined to k rows only. With a
    popcount ``index`` (``write_popcount_index``) in place of ``fingerprints`` the scan skips
    bit counts that cannot reach the k-th best.
    """
    if index is not None:
        own = index.where(F.col("compound_key") == F.lit(key))
        top = nearest_in_index(index, own, k, min_similarity, exclude=None if include_self else key, nbits=nbits)
        return _with_attributes(top.withColumnRenamed("similarity", "_t"), key, catalog)
    query = fingerprints.where(F.col("compound_key") == F.lit(key)).select("ecfp4_hex").limit(1).collect()
    hexed = F.lit(query[0][0] if query else None).cast("string")
    scored = fingerprints.select(
        "compound_key",
        "molecule_chembl_id",
        tanimoto_words(hex_to_words("ecfp4_hex", nbits), hex_to_words(hexed, nbits)).alias("_t"),
    ).where(F.col("_t") >= min_similarity)
    if not query:
        scored = scored.where(F.lit(False))
    if not include_self:
        scored = scored.where(F.col("compound_key") != F.lit(key))
    return _with_attributes(scored.orderBy(F.desc("_t"), "molecule_chembl_id").limit(k), key, catalog)


def _with_attributes(top: DataFrame, key: int | str, catalog: DataFrame) -> DataFrame:
    """The neighbours with what the catalog says of them, against the query's own potency."""
    best = catalog.where(F.col("compound_key") == F.lit(key)).select("best_pchembl").limit(1).collect()
    reference = F.lit(best[0][0] if best else None).cast("double")
    attributes = catalog.select("compound_key", "pref_name", "best_pchembl", "best_target")
    return top.join(attributes, "compound_key", "left").select(
        "molecule_chembl_id",
        "pref_name",
        round_fp("_t", 3).alias("tanimoto"),
        "best_pchembl",
        round_fp(F.col("best_pchembl") - reference, 2).alias("delta_pchembl"),
        "best_target",
    ).orderBy(F.desc("tanimoto"), "molecule_chembl_id")


# --- activity cliffs ------------------------------------------------------------------


def filter_cliffs(
    cliffs: DataFrame,
    min_tanimoto: float,
    min_delta: float,
    include_identical: bool = True,
    targets: Sequence[str] = (),
) -> DataFrame:
    """Cliffs above (rounded) floors, optionally without identical pairs or by target."""
    view = cliffs.where((F.col("tanimoto") >= min_tanimoto) & (F.col("delta_pchembl") >= min_delta))
    if not include_identical:
        view = view.where(~F.col("is_identical_fp"))
    if targets:
        view = view.where(F.col("target_pref_name").isin(list(targets)))
    return view


def ranked_cliffs(cliffs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Add the row index by descending SALI (undefined last) and the pair label."""
    last = F.lit(float("inf"))
    order = [F.coalesce(-F.col("sali"), last), "target_key", "compound_key_a", "compound_key_b"]
    label = F.concat("molecule_chembl_id_a", F.lit(" ⇄ "), "molecule_chembl_id_b")
    cliffs = materialize(cliffs, "cliffs")  # the positions read it several times
    placed = global_position(cliffs, order, "_pos", ranges)
    return placed.withColumns({"_row": F.col("_pos") - 1, "pair": label}).drop("_pos")


def attach_pair_attributes(pairs: DataFrame, attrs: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Look up attributes for both sides of each pair."""
    out = pairs
    for s in ("a", "b"):
        side = attrs.select(F.col(key).alias(f"{key}_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in columns])
        out = out.join(side, f"{key}_{s}", "left")
    return out


# --- views ----------------------------------------------------------------------------


def label_class(df: DataFrame, column: str, labels: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumn(column, lookup_label(column, labels))


def cytotox_by_payload(cyto: DataFrame) -> DataFrame:
    """Best cellular potency and number of lines per payload."""
    return (
        cyto.where(F.col("reference_name").isNotNull() & F.col("payload_class").isNotNull())
        .groupBy("reference_name", "payload_class")
        .agg(
            F.max("median_p_cyto").alias("best_p_cyto"),
            F.count_distinct("cell_line_chembl_id").alias("n_cell_lines"),
        )
        .orderBy(F.desc("best_p_cyto"), "reference_name", "payload_class")
    )


def library_filter(
    catalog: DataFrame,
    potency: tuple[float, float] = (0.0, 14.0),
    ranges: Mapping[str, tuple[float, float]] | None = None,
    max_ro5: int = 4,
    text: str = "",
) -> DataFrame:
    """Inclusive property ranges (missing counts as 0, except potency) and a text search.

    The text is matched literally and without case in the id or the name.
    """
    view = catalog.where(F.col("best_pchembl").between(*potency))
    for column, (lo, hi) in (ranges or {}).items():
        view = view.where(F.coalesce(F.col(column), F.lit(0)).between(lo, hi))
    view = view.where(F.coalesce("num_ro5_violations", F.lit(0)) <= max_ro5)
    needle = text.strip().lower()
    if needle:
        view = view.where(
            F.lower("molecule_chembl_id").contains(needle)
            | F.lower(F.coalesce("pref_name", F.lit(""))).contains(needle)
        )
    return view.orderBy(F.desc("best_pchembl"), "molecule_chembl_id")


def contains_features(df: DataFrame, elements: str, query: Sequence) -> DataFrame:
    """Add ``contains``: whether the entity's set holds the query set (NULL if unusable)."""
    return df.withColumn("contains", contains_all(elements, F.lit(list(query))))


def sar_ranking(
    sar: DataFrame, target: str, min_n: int = 1, low: float = 5.0, high: float = 14.0, k: int = 20
) -> DataFrame:
    """Top k compounds of one target."""
    kept = sar.where(
        (F.col("target_pref_name") == target)
        & (F.col("n_measurements") >= min_n)
        & F.col("median_pchembl").between(low, high)
    )
    return kept.orderBy(F.desc("median_pchembl"), "molecule_chembl_id").limit(k)


def sar_heatmap(sar: DataFrame, targets: Sequence[str], k: int = 30) -> DataFrame:
    """Top k compounds by best median, one column per target (NULL where not measured)."""
    top = (
        sar.groupBy("molecule_chembl_id")
        .agg(F.max("median_pchembl").alias("best"))
        .orderBy(F.desc("best"), "molecule_chembl_id")
        .limit(k)
    )
    return (
        sar.join(F.broadcast(top), "molecule_chembl_id")  # k rows
        .groupBy("molecule_chembl_id", "best")
        .pivot("target_pref_name", list(targets))
        .agg(F.max("median_pchembl"))
        .orderBy(F.desc("best"), "molecule_chembl_id")
    )


def selectivity_matrix(sar: DataFrame, selective: DataFrame, keys: DataFrame | None, targets: Sequence[str], k: int = 30) -> DataFrame:
    """The heatmap of the compounds that ``selectivity_view`` shows: in scope, with at least two targets."""
    shown = selective.where(F.col("n_targets") >= 2).select("compound_key")
    if keys is not None:
        shown = shown.join(keys.select("compound_key"), "compound_key", "left_semi")
    return sar_heatmap(sar.join(shown, "compound_key", "left_semi"), targets, k)


def selectivity_view(selective: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Compounds with at least two targets, most selective first."""
    view = selective.where(F.col("n_targets") >= 2)
    if keys is not None:
        view = view.join(keys.select("compound_key"), "compound_key", "left_semi")
    return view.orderBy(F.desc("selectivity_index"), "molecule_chembl_id")


def distribution(df: DataFrame, group: str, value: str) -> DataFrame:
    """Five-number summary and size of every group (values on a bounded grid)."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(value).alias("low"),
            F.percentile(value, [0.25, 0.5, 0.75]).alias("_q"),
            F.max(value).alias("high"),
        )
        .select(
            group,
            "n",
            "low",
            F.col("_q")[0].alias("p25"),
            F.col("_q")[1].alias("median"),
            F.col("_q")[2].alias("p75"),
            "high",
        )
    )


def histogram(df: DataFrame, value: str, by: str, bins: int = 40) -> DataFrame:
    """Counts in equal-width bins (1..bins) between the smallest and largest value, per flag."""
    low, high = df.agg(F.min(value), F.max(value)).first()
    known = df.where(F.col(value).isNotNull())
    width = ((high - low) / bins) if high is not None else 0
    raw = F.floor((F.col(value) - F.lit(low)) / F.lit(width)) + 1 if width else F.lit(1)
    # The largest value belongs to the last bin.
    bin_no = F.least(raw.cast("int"), F.lit(bins))
    return known.groupBy(bin_no.alias("bin"), by).agg(F.count(F.lit(1)).alias("n"))


def top_categories(df: DataFrame, column: str, k: int, name: str, null_label: str = "acyclic") -> DataFrame:
    """Keep the k largest groups, call the rest 'other' and missing values ``null_label``."""
    top = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .count()
        .orderBy(F.desc("count"), column)
        .limit(k)
        .select(column, F.lit(True).alias("_top"))
    )
    label = (
        F.when(F.col(column).isNull(), F.lit(null_label)).when(F.col("_top"), F.col(column)).otherwise(F.lit("other"))
    )
    return df.join(F.broadcast(top), column, "left").withColumn(name, label).select(*df.columns, name)  # k rows


def series_view(series: DataFrame, min_size: int, sort_by: str) -> DataFrame:
    """Series of at least a size, largest value of the chosen column first."""
    return series.where(F.col("n_compounds") >= min_size).orderBy(F.desc_nulls_last(sort_by), "scaffold_key")


def member_rank(members: DataFrame, series: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Rank in the series by unrounded ``potency``, the series' size, and the distance to its best and median."""
    members = materialize(members, "members")  # read for the ranges, the ranks and the sizes
    order = [F.coalesce(-F.col("potency"), F.lit(float("inf"))), "molecule_chembl_id"]
    ranked = group_rank(members, "scaffold_key", order, "rank", rows_per_range)
    sizes = members.groupBy("scaffold_key").agg(F.count(F.lit(1)).alias("n_members"))
    stats = series.select("scaffold_key", "max_pchembl", "median_pchembl")
    shown = round_fp("potency", 2)
    return (
        ranked.join(sizes, "scaffold_key")
        .join(stats, "scaffold_key")
        .select(
            "scaffold_key",
            "molecule_chembl_id",
            shown.alias("best_pchembl"),
            "rank",
            "n_members",
            round_fp(shown - F.col("max_pchembl"), 2).alias("delta_to_best"),
            round_fp(shown - F.col("median_pchembl"), 2).alias("delta_to_median"),
        )
    )


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def entry_label(df: DataFrame) -> DataFrame:
    """Add the one-line description of a structure entry, skipping what is missing."""
    method = F.nullif(lookup_label("method", METHOD_SHORT), F.lit(""))
    resolution = F.concat(one_decimal("resolution"), F.lit(" Å"))
    shown = F.when(F.col("resolution").isNotNull(), resolution)
    how = F.nullif(F.concat_ws(" ", method, shown), F.lit(""))
    meta = F.nullif(F.concat_ws(" · ", how, F.col("year").cast("string")), F.lit(""))
    head = F.concat_ws(" - ", F.upper("pdb_id"), F.nullif("title", F.lit("")))
    return df.withColumn("label", F.concat_ws(" · ", head, meta))


def facet_bounds(df: DataFrame, columns: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(column, low, high) of each filterable column, with its default when it is empty."""
    bounds = df.agg(
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(F.col(f"lo_{c}"), F.lit(float(lo))).alias("low"),
            F.coalesce(F.col(f"hi_{c}"), F.lit(float(hi))).alias("high"),
        )
        for c, (lo, hi) in columns.items()
    ]
    return bounds.select(F.inline(F.array(*rows)))
