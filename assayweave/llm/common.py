"""Helpers shared by the operators: table reading, groups over Arrow batches, ranges, connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
FIRST_KEY = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def tasks_for(df: DataFrame, least: int = 1) -> int:
    """Number of partitions for keyed work: the session's setting, at least the input's own splits."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, wanted, df.rdd.getNumPartitions())


def whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Regroup batches of rows sorted by ``key`` so that no group is cut by a batch border.

    Holds one batch and the group open at its end; callers bound the size of a group.
    """
    open_parts: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[key].iloc[-1]
        if open_parts and open_parts[-1][key].iloc[-1] == last == batch[key].iloc[0]:
            open_parts.append(batch)
            continue
        cut = int((batch[key] == last).to_numpy().argmax())
        done = [*open_parts, batch.iloc[:cut]]
        done = [x for x in done if len(x)]
        if done:
            yield pd.concat(done, ignore_index=True)
        open_parts = [batch.iloc[cut:]]
    if open_parts:
        yield pd.concat(open_parts, ignore_index=True)


def pack(chunk: int, bucket: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
    """One row for each bucket, with the bucket's part of every column as an array: little overhead in a shuffle."""
    order = np.argsort(bucket, kind="stable")
    values, cuts = np.unique(bucket[order], return_index=True)
    if not len(values):
        return pd.DataFrame({k: pd.Series([], dtype=object) for k in ("chunk", "bucket", *columns)})
    out = {"chunk": np.full(len(values), chunk, np.int64), "bucket": values.astype(np.int64)}
    for name, column in columns.items():
        out[name] = np.split(column[order], cuts[1:])
    return pd.DataFrame(out)


def flat(packed: pd.DataFrame, name: str) -> np.ndarray:
    """A packed column's arrays one after the other, as 64-bit integers."""
    return np.concatenate([np.asarray(x, np.int64) for x in packed[name]]) if len(packed) else np.zeros(0, np.int64)


def range_bounds(df: DataFrame, key: str, ranges: int) -> list[int]:
    """At most ``ranges - 1`` ascending boundaries of a non-null bigint column, about equally far in rows."""
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = df.stat.approxQuantile(key, shares, 1 / (4 * ranges))
    return sorted({int(x) for x in found})


def range_number(key: Column, bounds: Sequence[int]) -> Column:
    """Number of boundaries <= key, as a balanced CASE tree."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key >= F.lit(bounds[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(bounds))


def connected_components(edges: DataFrame, salts: int = 8) -> DataFrame:
    """(node, label) for every node of the ``a``, ``b`` edges; the label is the component's smallest node.

    Alternating large-star and small-star rounds. A hub's edges are spread over ``salts`` keys when its
    minimum is joined back, minima are combined map-side, and each round is written to the shared
    folder, so a lost executor costs one round. Loops and repeated edges are harmless.
    """

    def with_least(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int")).join(least, ["u", "salt"])

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = materialize(e, "edges")
    before = state(e)
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        near = with_least(large)
        small = (
            near.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(near.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        e = materialize(small, "stars")
        after = state(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
