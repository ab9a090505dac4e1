"""Cleaning a document table in stages: each stage's rows are written and read again as the next one's documents.

toxicity drops the texts the toxicity model rejects; simhash keeps one document of each group whose SimHash
fingerprints are linked; decontaminate drops documents that hold a benchmark item; mix repeats or drops documents so that the
sources come to their target weights; tokens writes the token ids of the mix and reads them back.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayweave.llm import decontaminate, mixing, simhash, token_output, toxicity
from assayweave.llm.common import table
from assayweave.session import materialize, scratch_dir, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the model of all labelled rows does not reject. NULL and empty texts have a score like any other, repeated
    rows the same one; labels of unknown, NULL or repeated ids are no error, and without labels nothing goes."""
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.rejecting(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one of the smallest id. NULL, empty and wordless texts are one group, repeated rows
    another; NULL ids come last."""
    small_batches(spark)
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. NULL and empty texts hold none; repeated rows stay or go together; items
    that are NULL, empty or repeated change nothing."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document taken twice is two rows, one not taken is gone. NULL and empty texts have no words to take and go;
    NULL is a source of its own; repeated rows are taken one by one."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token files: a row for each row of ``docs``, with ids in ascending order and NULL ids first. NULL and
    empty texts have their end id only; an empty table gives no rows."""
    small_batches(spark)
    path = scratch_dir(spark, "tokens")
    token_output.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.digests(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]
#: Trees, signatures and coded blocks have no SQL form; the stages are tested against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
