"""Fingerprint rows and 2-D coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import bits_to_hex, hashed_bits, hex_to_bits, hex_to_words, popcount_words
from ..functions.scalar import ColumnOrName, _col

MIN_ROWS_FOR_PROJECTION = 4


def hashed_fingerprint(
    df: DataFrame, key: str, features: ColumnOrName, nbits: int = 2048, source: str = "hashed", version: str = "1", now: str = ""
) -> DataFrame:
    """Feature sets to fingerprint rows with provenance; rows without features are dropped.

    Row-wise only: no explode and no shuffle. ``count_dropped`` tells how many rows went.
    """
    sets = df.select(F.col(key), F.sort_array(F.array_distinct(_col(features))).alias("_f"))
    digest = F.sha2(F.concat_ws("\t", F.col(key).cast("string"), F.array_join("_f", " ")), 256)
    return (
        sets.select(key, digest.alias("_row_hash"), hashed_bits("_f", nbits).alias("onbits"))
        .where(F.size("onbits") > 0)
        .select(
            key, "onbits", F.size("onbits").alias("n_onbits"), bits_to_hex("onbits", nbits).alias("hex"), "_row_hash"
        )
        .withColumns({"_fetch_ts": F.lit(now), "_source": F.lit(source), "_version": F.lit(version)})
    )


def count_dropped(df: DataFrame, features: ColumnOrName) -> DataFrame:
    """One row: entities with and without usable features."""
    usable = F.coalesce(F.size(_col(features)) > 0, F.lit(False))
    return df.agg(F.count_if(usable).alias("computed"), F.count_if(~usable).alias("skipped"))


def fingerprint_pack(df: DataFrame, hexed: str, nbits: int = 2048) -> DataFrame:
    """Add the packed words, on-bits and popcount of a hex fingerprint."""
    return df.withColumn("words", hex_to_words(hexed, nbits)).withColumns(
        {"onbits": hex_to_bits(hexed, nbits), "n_onbits": popcount_words("words")}
    )


def set_bits(vector: ColumnOrName) -> Column:
    """Positions of the positive entries of a numeric vector, as sorted on-bits."""
    marked = F.transform(_col(vector), lambda x, i: F.when(x > 0, i))
    return F.array_compact(marked)


def project_2d(df: DataFrame, key: str, vector: str, min_rows: int = MIN_ROWS_FOR_PROJECTION) -> DataFrame:
    """Deterministic 2-D coordinates: the two leading principal components.

    The covariance is a distributed sum over rows (d x d on the driver, d fixed by the
    vector length). Each component's sign is fixed by making its largest loading positive, of
    equally large ones the first. Below ``min_rows`` usable rows the result is empty.
    """
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.where(F.col(vector).isNotNull()).select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    if len(rows.limit(min_rows).collect()) < min_rows:
        return rows.select(key, F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).limit(0)
    centred = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(rows).transform(rows)
    model = PCA(k=2, inputCol="_c", outputCol="_p").fit(centred)
    loadings = model.pc.toArray()
    signs = [1.0 if max(column.tolist(), key=abs) >= 0 else -1.0 for column in loadings.T]
    point = vector_to_array("_p")
    return model.transform(centred).select(
        key, (point[0] * F.lit(signs[0])).alias("x"), (point[1] * F.lit(signs[1])).alias("y")
    )
