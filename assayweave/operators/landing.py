"""Operators between landed records and typed staging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import explode_json_refs

# A literal IN list longer than this is better as a semi join.
MAX_IN_LIST = 500


def derive_ids(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-empty ids: the scope of the next landing stage."""
    return df.select(column).where(F.col(column).isNotNull() & (F.col(column) != "")).distinct()


def scope_filter(
    df: DataFrame,
    in_lists: Mapping[str, Sequence | DataFrame] | None = None,
    equals: Mapping[str, object] | None = None,
    not_null: Sequence[str] = (),
) -> DataFrame:
    """Keep records in scope. An ``in_lists`` value is a short list or a frame of ids.

    Literal conditions come first so they reach the Parquet scan; id frames are semi
    joins whose strategy is left to the optimizer.
    """
    out = df
    for column, value in (equals or {}).items():
        out = out.where(F.col(column) == F.lit(value))
    for column in not_null:
        out = out.where(F.col(column).isNotNull())
    for column, values in (in_lists or {}).items():
        if isinstance(values, DataFrame):
            keys = values.select(F.col(values.columns[0]).alias(column)).distinct()
            out = out.join(keys, column, "left_semi")
        elif len(values) > MAX_IN_LIST:
            rows = [(v,) for v in values]
            keys = df.sparkSession.createDataFrame(rows, df.select(column).schema).distinct()
            out = out.join(keys, column, "left_semi")
        else:
            out = out.where(F.col(column).isin(list(values)))
    return out


def stamp_lookup(df: DataFrame, key: str, lookup: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach configuration attributes by key; unknown keys get NULL.

    The lookup is a driver-side configuration (tens of rows), hence small by construction.
    """
    return df.join(lookup.select(key, *columns), key, "left")


def reference_codes(molecules: DataFrame, mapping: DataFrame, source: str) -> DataFrame:
    """Distinct (molecule, code) pairs of one source from JSON references and bulk dumps."""
    embedded = explode_json_refs(molecules, "molecule_chembl_id", "cross_references")
    columns = ["molecule_chembl_id", F.col("xref_id").alias("ligand_code")]
    both = embedded.where(F.col("source") == source).select(*columns).unionByName(
        mapping.where((F.col("source") == source) & F.col("xref_id").isNotNull()).select(*columns)
    )
    return both.distinct()


def resolve_capped(responses: DataFrame, code: str, payload: str, cap: int = 50) -> DataFrame:
    """Ligand code to its first ``cap`` entry ids, from landed JSON responses.

    An item is an object with ``pdb_id`` or a bare string. The cap is part of the
    definition (ids are sorted, so which ones stay is fixed). ``row_number() <= cap``
    is planned with a group limit before the shuffle: at most ``cap`` rows per code
    leave a map task.
    """
    is_array = F.ltrim(F.col(payload)).startswith("[")
    items = F.from_json(F.when(is_array, F.col(payload)), "array<string>")
    exploded = responses.where(F.col(code) != "").select(
        F.col(code).alias("ligand_code"), F.explode(items).alias("_item")
    )
    is_object = F.ltrim("_item").startswith("{")
    pdb_id = F.when(is_object, F.get_json_object("_item", "$.pdb_id")).otherwise(F.col("_item"))
    ids = exploded.select("ligand_code", F.lower(pdb_id).alias("pdb_id")).where("pdb_id <> ''").distinct()
    order = Window.partitionBy("ligand_code").orderBy("pdb_id")
    return ids.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= cap).drop("_rn")


def merge_entry_metadata(ids: DataFrame, summary: DataFrame, experiment: DataFrame) -> DataFrame:
    """Entry ids with title, method, year and resolution; unknown entries keep NULLs.

    ``summary`` has (pdb_id, title, experimental_method array, release_date) and
    ``experiment`` (pdb_id, resolution), one row per entry.
    """
    keys = ids.select(F.lower("pdb_id").alias("pdb_id")).where("pdb_id <> ''").distinct()
    head = F.substring(F.col("release_date").cast("string"), 1, 4)
    described = summary.select(
        F.lower("pdb_id").alias("pdb_id"),
        F.nullif(F.regexp_replace("title", r"(?U)^\s+|\s+$", ""), F.lit("")).alias("title"),
        F.try_element_at("experimental_method", F.lit(1)).alias("method"),
        F.when(head.rlike("^[0-9]{1,4}$"), head).alias("year"),
    )
    measured = experiment.select(F.lower("pdb_id").alias("pdb_id"), "resolution")
    return keys.join(described, "pdb_id", "left").join(measured, "pdb_id", "left")

