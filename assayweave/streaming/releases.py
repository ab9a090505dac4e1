"""The incremental load as a file stream: each arriving batch is appended once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.history import key_range, new_rows
from ..operators.keyed import KeyedTable
from ..operators.staging import dedupe


def incremental_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    key: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append the unseen keys of newly arrived Parquet files to ``target``.

    The target table itself is the deduplication state, so no state store grows with the
    stream. A batch goes to a folder of its own, named by its number and overwritten on
    a replay: a batch repeated after a failure leaves the same rows, once. The target is read by
    its key only, so a later release may bring further columns: start the stream with the wider
    schema and read the target with ``mergeSchema``.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        fresh = dedupe(batch.where(F.col(key).isNotNull()), [key])
        try:
            known = T.StructType([schema[key], T.StructField("_batch", T.LongType())])
            loaded = spark.read.schema(known).parquet(target).where(F.col("_batch") != batch_id)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            loaded = None
        rows = fresh if loaded is None else new_rows(key_range(loaded, fresh, key), fresh, key)
        rows.write.mode("overwrite").parquet(f"{target}/_batch={batch_id}")

    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(source)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keyed_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: KeyedTable,
    checkpoint: str,
    upsert: bool = False,
    max_files: int | None = None,
) -> StreamingQuery:
    """Load newly arrived Parquet files into a keyed table: unseen keys, or with ``upsert`` all of them.

    A micro-batch is the version of its number, so one that is replayed after a failure is loaded once, and only
    files that may hold one of its keys are read.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        (table.upsert if upsert else table.append)(batch, version=batch_id + 1)

    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(source)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
