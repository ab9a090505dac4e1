"""Nearest neighbours of one fingerprint by a popcount index: only counts that can still win are read.

Two fingerprints with ``a`` and ``b`` bits are at most min(a, b) / max(a, b) similar. The index is a table of packed
fingerprints sorted by their bit count, so a range of counts is a range of row groups: the filter on the count
is pushed to the scan, which skips all others. A search reads the counts nearest to the query's own first and goes on
outwards until the k-th best similarity is above what any unread count can reach.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import hex_to_words, popcount_words, tanimoto_words

#: Similarities down to which the rings of bit counts reach, one after the other.
RINGS = (0.9, 0.8, 0.65, 0.5, 0.35, 0.2, 0.1, 0.0)


def write_popcount_index(
    fingerprints: DataFrame, path: str, key: str = "compound_key", name: str = "molecule_chembl_id", hexed: str = "ecfp4_hex", nbits: int = 2048
) -> DataFrame:
    """Write (key, name, words, n_bits) sorted by ``n_bits`` and return the table as it is read back.

    A missing or empty fingerprint has no bits. The rows are dealt by ranges of (n_bits, name), so one count that very
    many rows share is spread over several files.
    """
    words = fingerprints.select(key, name, hex_to_words(hexed, nbits).alias("words"))
    counted = words.withColumn("n_bits", F.coalesce(popcount_words("words"), F.lit(0)))
    counted.repartitionByRange("n_bits", name).sortWithinPartitions("n_bits", name).write.mode("overwrite").parquet(path)
    return fingerprints.sparkSession.read.schema(counted.schema).parquet(path)


def rings(own: int, least: float, nbits: int) -> Iterator[tuple[float, list[tuple[int, int]]]]:
    """(bound, ranges): ranges of bit counts not read before, and the similarity no count beyond them can exceed.

    Counts from ceil(t * own) to floor(own / t) can be ``t`` similar. The ranges of all rings together are all counts
    that can be ``least`` similar.
    """
    below, above = own, own - 1  # read so far: below <= n <= above, nothing yet
    for t in sorted({*(r for r in RINGS if r > least), least}, reverse=True):
        low = 0 if t <= 0 else math.ceil(t * own - 1e-9)
        high = nbits if t <= 0 or own == 0 else min(nbits, math.floor(own / t + 1e-9))
        low, high = min(low, below), max(high, above)
        parts = [(low, below - 1), (above + 1, high)]
        below, above = low, high
        yield t, [p for p in parts if p[0] <= p[1]]


def nearest_in_index(
    index: DataFrame,
    query: DataFrame,
    k: int,
    min_similarity: float = 0.0,
    key: str = "compound_key",
    name: str = "molecule_chembl_id",
    exclude: int | str | None = None,
    nbits: int = 2048,
) -> DataFrame:
    """(key, name, ``similarity``) of the k rows most similar to the one row of ``query`` (words, n_bits).

    Ties go to the smaller name. Without a query row the result is empty. Every ring returns at most k rows.
    """
    schema = index.select(key, name, F.lit(0.0).alias("similarity")).schema
    found = query.select("words", "n_bits").limit(1).collect()
    if not found:
        return index.sparkSession.createDataFrame([], schema)
    words, own = found[0]
    literal = F.lit(words).cast("array<bigint>") if words is not None else F.lit(None).cast("array<bigint>")
    others = index if exclude is None else index.where(F.col(key) != F.lit(exclude))
    best: list[tuple] = []
    for bound, ranges in rings(own, min_similarity, nbits):
        if ranges:
            here = F.lit(False)
            for low, high in ranges:
                here = here | F.col("n_bits").between(low, high)
            scored = others.where(here).select(key, name, tanimoto_words("words", literal).alias("similarity"))
            top = scored.where(F.col("similarity") >= min_similarity).orderBy(F.desc("similarity"), name).limit(k)
            best = sorted([*best, *map(tuple, top.collect())], key=lambda r: (-r[2], r[1]))[:k]
        # What is unread is less similar than the bound; an equal one could still win a tie.
        if len(best) == k and best[-1][2] >= bound and bound > min_similarity:
            break
    return index.sparkSession.createDataFrame(best, schema)
