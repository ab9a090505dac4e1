"""Global positions and per-group ranks without a single-task window.

An un-partitioned ``row_number`` sends every row to one task. Global positions come from one write: rows are
dealt to ranges of the sort key, sorted inside them and written with the number of their range and their place in
it; the counts of the ranges, read from the written file, give the offsets, and the numbers are a projection of
the file from then on.

Ranks inside groups are made in ranges of (group, order), whose boundaries come from a hash-threshold sample, so that a
retried task sees the same boundaries: a row's range is a pure function of its key. The rank is the row number
inside the range plus what the group has in the ranges before.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ROWS_PER_RANGE = 100_000
MAX_RANGES = 4096
_SAMPLES_PER_RANGE = 20


def _range_of(key: Column, bounds: Sequence[Column]) -> Column:
    """Number of boundaries <= key, as a balanced CASE tree (log2 comparisons per row)."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key >= bounds[mid], search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(bounds))


def _sample_bounds(df: DataFrame, order: Sequence[Column], rows_per_range: int) -> list[Column]:
    """Range boundaries of the composite sort key; the sample is bounded by MAX_RANGES."""
    keys = df.select(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    total = keys.count()
    ranges = min(MAX_RANGES, -(-total // rows_per_range))
    if ranges <= 1:
        return []
    wanted = ranges * _SAMPLES_PER_RANGE
    share = min(1.0, wanted / total)
    buckets = 1 << 30
    hashed = F.pmod(F.xxhash64(*keys.columns), F.lit(buckets))
    rows = keys.where(hashed < F.lit(max(1, int(share * buckets)))).orderBy(*keys.columns).collect()
    if not rows:
        raise ValueError("the hash sample of the sort key is empty: are its values distinct?")
    step = len(rows) / ranges
    picked = sorted({int(step * i) for i in range(1, ranges)} - {0})
    types = dict(keys.dtypes)
    return [
        F.struct(*[F.lit(rows[i][c]).cast(types[c]).alias(c) for c in keys.columns]) for i in picked if i < len(rows)
    ]


def global_position(df: DataFrame, order: Sequence[Column | str], name: str, ranges: int | None = None) -> DataFrame:
    """Add ``name`` = 1..N in the ascending order of ``order`` (unique, non-null columns).

    For descending numbers pass the negated column; map NULLs to a value at the wanted end. The result reads what is
    written here, in ``ranges`` files, by default as many as AQE finds fit for their size. The input is shuffled once; only
    what follows its last shuffle runs a second time, for Spark's sample of the sort key.
    """
    keys = {f"_k{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    keyed = df.withColumns(keys)
    ranged = keyed.repartitionByRange(*([ranges] if ranges else []), *keys).sortWithinPartitions(*keys)
    # Without shuffles in between, the low 33 bits of the id are the row's place in its partition.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    written = materialize(ranged.select(*df.columns, F.spark_partition_id().alias("_range"), place.alias("_place")), "positions")
    counts = {r["_range"]: r["n"] for r in written.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [counts.get(i, 0) for i in range(max(counts, default=0) + 1)]  # one number per range
    offsets = F.lit(np.cumsum([0, *sizes[:-1]], dtype=np.int64))
    number = F.element_at(offsets, F.col("_range") + 1) + F.col("_place") + 1
    return written.select(*df.columns, number.alias(name))


def dense_key(df: DataFrame, order_col: str, name: str, ranges: int | None = None) -> DataFrame:
    """1..N key in natural-key order, as the first column."""
    return global_position(df, [order_col], name, ranges).select(name, *df.columns)


def _carried(parts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups, _range, _before, _total) for groups that lie in several ranges: their sum of ``_n`` in the ranges before.

    ``parts`` has a row per group and range. A range border cuts one group at most, so the result has at most
    two rows per range, however many groups there are.
    """
    of_group = Window.partitionBy(*groups)
    before = of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.withColumns({"_ranges": F.count(F.lit(1)).over(of_group), "_total": F.sum("_n").over(of_group)})
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .where("_ranges > 1")
        .select(*groups, "_range", "_before", "_total")
    )


def _same_group(groups: Sequence[str], other: Sequence[str]) -> Column:
    same = F.lit(True)
    for a, b in zip(groups, other):
        same = same & F.col(a).eqNullSafe(F.col(b))
    return same


def group_rank(
    df: DataFrame,
    group: str,
    order: Sequence[Column | str],
    name: str,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Rank 1..n inside each group; one group may hold most rows.

    Rows are cut into ranges of (group, order). A group inside one range is ranked there; one that runs over
    borders also gets the number of its rows in the ranges before, from a small broadcast table.
    """
    keys = [F.col(group), *[F.col(c) if isinstance(c, str) else c for c in order]]
    bounds = _sample_bounds(df, keys, rows_per_range)
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(keys)])
    ranged = df.withColumn("_range", _range_of(key, bounds) if bounds else F.lit(0))
    inside = ranged.withColumn(name, F.row_number().over(Window.partitionBy("_range", group).orderBy(*keys[1:])).cast("bigint"))
    if not bounds:
        return inside.drop("_range")
    carried = _carried(ranged.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n")), [group])
    other = carried.select(F.col(group).alias("_g"), F.col("_range").alias("_r"), "_before")
    joined = inside.join(F.broadcast(other), _same_group([group], ["_g"]) & (F.col("_range") == F.col("_r")), "left")
    return joined.withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0))).drop("_range", "_g", "_r", "_before")


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    name: str = "quantiles",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Exact interpolated quantiles per group (``name``: array) without per-group state.

    Equal values are counted first (map-side). The (group, value) counts are then cut into ranges of the
    sort key and numbered by cumulative weight; a group that runs over borders gets its weight in the ranges
    before from a small broadcast table. Each group picks the values at its two neighbouring ranks per
    probability. No task holds more of a group than a range of it.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_w"))
    counted = materialize(counted, "quantiles")  # read by the sampling, numbering and offset passes
    order = [F.col(g) for g in groups] + [F.col(value)]
    bounds = _sample_bounds(counted, order, rows_per_range)
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    ranged = counted.withColumn("_range", _range_of(key, bounds) if bounds else F.lit(0))
    own = Window.partitionBy("_range", *groups)
    running = own.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumns({"_run": F.sum("_w").over(running), "_here": F.sum("_w").over(own)})
    carried = _carried(ranged.groupBy(*groups, "_range").agg(F.sum("_w").alias("_n")), groups)
    names = [f"_g{i}" for i in range(len(groups))]
    other = carried.select(*[F.col(g).alias(n) for g, n in zip(groups, names)], F.col("_range").alias("_r"), "_before", "_total")
    joined = placed.join(F.broadcast(other), _same_group(groups, names) & (F.col("_range") == F.col("_r")), "left")
    at = joined.withColumns(
        {
            "_hi": F.col("_run") + F.coalesce("_before", F.lit(0)),
            "_total": F.coalesce("_total", "_here"),
        }
    ).withColumn("_lo", F.col("_hi") - F.col("_w"))

    def pick(rank: Column) -> Column:
        return F.max(F.when((F.col("_lo") <= rank) & (rank < F.col("_hi")), F.col(value)))

    picks: list[Column] = []
    for i, p in enumerate(probabilities):
        rank = F.lit(float(p)) * (F.col("_total") - 1)
        picks += [
            pick(F.floor(rank)).alias(f"_a{i}"),
            pick(F.ceil(rank)).alias(f"_b{i}"),
            F.max(rank - F.floor(rank)).alias(f"_f{i}"),
        ]
    found = at.groupBy(*groups).agg(*picks)
    values = [
        F.col(f"_a{i}") + F.col(f"_f{i}") * (F.col(f"_b{i}") - F.col(f"_a{i}")) for i in range(len(probabilities))
    ]
    return found.select(*groups, F.array(*values).alias(name))
