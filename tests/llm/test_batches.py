"""Memory that a batch of whole texts takes in a worker."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assayweave.llm import boosting, toxicity

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_features_of_a_large_batch_are_held_in_parts():
    texts = ["some words of a text, and then some more of them. " * 60] * 2000
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), boosting._constant(0.25))
    want = model.scores(texts[:1])[0]
    tracemalloc.start()
    found = model.scores(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [want] * len(texts)
    assert peak < 150e6


def test_scored_batches_are_cut_into_parts():
    whole = pa.RecordBatch.from_arrays([pa.array(range(1300))], ["n"])
    cut = list(toxicity.parts([whole, whole.slice(0, 0)]))
    assert [b.num_rows for b in cut] == [512, 512, 276]
    assert [n for b in cut for n in b.column(0).to_pylist()] == list(range(1300))


@pytest.mark.parametrize("kept", ["10000", "0", "100"])
def test_stages_send_texts_in_small_batches(spark, kept):
    before = spark.conf.get(BATCH)
    docs = spark.range(1500, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"))
    try:
        spark.conf.set(BATCH, kept)
        corpus_pipeline.small_batches(spark)
        rows = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches), "n bigint")
        assert max(r.n for r in rows.collect()) == (100 if kept == "100" else 512)
    finally:
        spark.conf.set(BATCH, before)
