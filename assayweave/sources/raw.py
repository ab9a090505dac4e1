"""Reading, shaping, stamping and writing raw entities (one Parquet dataset each)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import try_int
from .schemas import RAW_SCHEMAS, RULES, Rule


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


RAW_NAME = "raw_{entity}.parquet"


def raw_path(directory: str, entity: str, template: str = RAW_NAME) -> str:
    return f"{directory.rstrip('/')}/{template.format(entity=entity)}"


def read_raw(
    spark: SparkSession,
    directory: str,
    entity: str,
    schema: T.StructType | str | None = None,
    template: str = RAW_NAME,
) -> DataFrame:
    """Scan one raw entity with its declared schema: no inference job, columns pruned later."""
    declared = schema if schema is not None else RAW_SCHEMAS[entity]()
    return spark.read.schema(declared).parquet(raw_path(directory, entity, template))


def write_entity(df: DataFrame, directory: str, entity: str) -> str:
    """Overwrite the dataset of one entity."""
    path = raw_path(directory, entity)
    df.write.mode("overwrite").parquet(path)
    return path


def flatten_nested(df: DataFrame, sep: str = ".") -> DataFrame:
    """Struct leaves become top-level columns named by their path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType, here)
            else:
                out.append(F.col(".".join(_tick(p) for p in here)).alias(sep.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))


def land(
    records: DataFrame, entity: str, directory: str, version: str, now: str, endpoint: str | None = None, check: bool = True
) -> str:
    """Land an entity's records: flatten, stamp, validate, turn nested values into text, write.

    Records that break a declared rule of the entity stop the landing before anything is written.
    """
    stamped = with_provenance(flatten_nested(records), endpoint or entity, version, now)
    checked = enforce_schema(stamped, RULES.get(entity, ()), check) if entity in RULES else stamped
    return write_entity(stringify_nested(checked), directory, entity)


def stringify_nested(df: DataFrame) -> DataFrame:
    """Array, map and struct columns become JSON text; the others are left alone."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            (F.to_json(F.col(_tick(f.name))) if isinstance(f.dataType, nested) else F.col(_tick(f.name))).alias(f.name)
            for f in df.schema.fields
        ]
    )


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SHA-256 of ``name=value`` pairs in name order, so column order does not matter.

    NULL is written as ``\\N``; backslashes and tabs inside values are escaped, hence
    NULL, the empty string and shifted separators all hash differently.
    """
    nested = (T.ArrayType, T.MapType, T.StructType)
    types = {f.name: f.dataType for f in df.schema.fields}

    def part(name: str) -> Column:
        col = F.col(_tick(name))
        text = F.to_json(col) if isinstance(types[name], nested) else col.cast("string")
        escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\t"), F.lit("\\t"))
        return F.concat(F.lit(f"{name}="), F.coalesce(escaped, F.lit("\\N")))

    return F.sha2(F.concat_ws("\t", *[part(c) for c in sorted(columns or df.columns)]), 256)


def with_provenance(
    df: DataFrame,
    endpoint: str,
    version: str,
    now: str,
    names: Sequence[str] = ("_fetch_ts", "_source_endpoint", "_chembl_version", "_row_hash"),
) -> DataFrame:
    """Add the four stamps. ``now`` is an argument so a retried task writes the same rows."""
    ts, source, release, digest = names
    return df.withColumns(
        {ts: F.lit(now), source: F.lit(endpoint), release: F.lit(str(version)), digest: row_hash(df)}
    )


def _check_columns(df: DataFrame, rules: Sequence[Rule]) -> None:
    missing = [r.column for r in rules if r.column not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")


def _cast(df: DataFrame, rule: Rule) -> Column:
    source = F.col(_tick(rule.column))
    if df.schema[rule.column].dataType == T._parse_datatype_string(rule.type):
        return source
    if rule.type in ("int", "bigint", "smallint"):
        return try_int(source, rule.type)
    return source.try_cast(rule.type)


def schema_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(column, rule, violations) for every declared rule, from a single scan."""
    _check_columns(df, rules)
    counts: list[tuple[str, str, Column]] = []
    for rule in rules:
        source, cast = F.col(_tick(rule.column)), _cast(df, rule)
        counts.append((rule.column, "type", F.count_if(source.isNotNull() & cast.isNull())))
        if not rule.nullable:
            counts.append((rule.column, "not_null", F.count_if(source.isNull())))
    totals = df.agg(*[n.alias(f"n{i}") for i, (_, _, n) in enumerate(counts)])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(f"n{i}").alias("violations"))
            for i, (c, r, _) in enumerate(counts)
        ]
    )
    return totals.select(F.inline(rows))


def enforce_schema(df: DataFrame, rules: Sequence[Rule], check: bool = True) -> DataFrame:
    """Coerce the declared columns, keep the others, and fail on any violation."""
    _check_columns(df, rules)
    if check:
        bad = schema_violations(df, rules).where("violations > 0").collect()  # at most two rows per rule
        if bad:
            raise ValueError("; ".join(f"{r['column']}: {r['violations']} {r['rule']}" for r in bad))
    return df.withColumns({r.column: _cast(df, r) for r in rules})
