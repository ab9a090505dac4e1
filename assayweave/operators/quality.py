"""Data-quality checks. Every check returns its violating rows: empty means pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_grain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations occurring more than once, with their count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values occurring more than once."""
    return check_grain(df.where(F.col(column).isNotNull()), [column])


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list (NULL is accepted), with their count."""
    bad = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def check_known_class(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Like ``check_accepted``, but a NULL is a violation too; returns the rows."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(list(values)))


def check_relationship(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows whose non-null foreign key has no parent."""
    known = parent.select(F.col(pk).alias(fk))
    return child.where(F.col(fk).isNotNull()).join(known, fk, "left_anti").select(*child.columns)


def check_pair_order(df: DataFrame, group: str, a: str, b: str) -> DataFrame:
    """Pairs that occur twice or are not in ascending order; one aggregation finds both."""
    return (
        df.groupBy(group, a, b).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | (F.col(a) >= F.col(b)))
    )


def check_thresholds(df: DataFrame, floors: Mapping[str, float]) -> DataFrame:
    """Rows with a value under its floor."""
    return df.where(reduce(Column.__or__, [F.col(c) < F.lit(v) for c, v in floors.items()]))


def check_range(df: DataFrame, columns: Sequence[str], low: float | None, high: float | None) -> DataFrame:
    """Rows with a value outside [low, high]; None leaves a side open, NULL passes."""
    tests = [F.col(c) < F.lit(low) for c in columns if low is not None]
    tests += [F.col(c) > F.lit(high) for c in columns if high is not None]
    return df.where(reduce(Column.__or__, tests))


def check_null_rate(df: DataFrame, column: str, ceiling: float) -> DataFrame:
    """One row when the share of NULLs exceeds the ceiling."""
    share = F.avg(F.col(column).isNull().cast("double"))
    return df.agg(share.alias("null_rate")).where(F.col("null_rate") > ceiling).select(
        F.lit(column).alias("column_name"), "null_rate"
    )


def check_row_floor(tables: Mapping[str, DataFrame], floor: int) -> DataFrame:
    """Tables with fewer rows than the floor (1 checks for not empty)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("model"), "n") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).where(F.col("n") < floor)


def check_mean_band(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """One row when the mean leaves the band."""
    mean = df.agg(F.avg(column).alias("mean"))
    return mean.where((F.col("mean") < low) | (F.col("mean") > high))


def check_one_open_window(history: DataFrame, key: str) -> DataFrame:
    """Keys with more than one open window."""
    return (
        history.where(F.col("valid_to").isNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("open_windows"))
        .where("open_windows > 1")
    )


def check_reconciles(a: DataFrame, total_a: Column, b: DataFrame, total_b: Column) -> DataFrame:
    """One row when two totals differ; the one-row totals meet by a union, not a cross join."""
    sides = a.agg(total_a.cast("bigint").alias("a_n")).select("a_n", F.lit(None).cast("bigint").alias("b_n")).unionByName(
        b.agg(total_b.cast("bigint").alias("b_n")).select(F.lit(None).cast("bigint").alias("a_n"), "b_n")
    )
    both = sides.agg(F.max("a_n").alias("a_n"), F.max("b_n").alias("b_n"))
    return both.where(F.col("a_n") != F.col("b_n"))


def freshness(
    df: DataFrame, ts: Column, now: Column, warn_days: int = 90, error_days: int = 3650
) -> DataFrame:
    """Newest stamp and its status: pass, warn or error (error when there is none)."""
    newest = df.agg(F.max(ts.cast("timestamp")).alias("newest"))
    age = F.col("age_seconds")
    status = (
        F.when(age.isNull() | (age > error_days * 86400), "error").when(age > warn_days * 86400, "warn").otherwise("pass")
    )
    return newest.withColumn(
        "age_seconds", F.unix_seconds(now.cast("timestamp")) - F.unix_seconds("newest")
    ).withColumn("status", status)


def row_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(check, violations) of many row-level conditions from one scan of a table."""
    counted = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    rows = [
        F.struct(F.lit(name).alias("check"), F.col(f"r{i}").alias("violations")) for i, name in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*rows)))


def check_suite(checks: Mapping[str, DataFrame], row_level: Sequence[tuple[DataFrame, Mapping[str, Column]]] = ()) -> DataFrame:
    """(check, violations, passed), one row per check."""
    parts = [
        bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
        for name, bad in checks.items()
    ]
    parts += [row_rules(df, rules) for df, rules in row_level]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("violations") == 0)
