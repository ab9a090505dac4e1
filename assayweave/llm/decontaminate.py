"""Benchmark items found inside documents by containment of their word shingles.

A MinHash containment search: the shingles of an item are ordered by hash, and its sketch are the ``k``
smallest. Items are partitioned by size (powers of two); the upper size ``u`` of a partition gives
``k = u - ceil(t u) + 1``, so a document holding at least the share ``t`` of an item's shingles cannot miss all
of the sketch: no true pair is lost. Documents are probed with all their shingles, however long they are, and
each candidate is verified by exact containment of the shingles themselves.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnp import LOWER, Runs, slices, words

SEED = 11
#: Items are broadcast in blocks of at most so many characters of text.
BLOCK_CHARS = 8_000_000
_LOWER = bytes(LOWER)


def shingles(text: str | None, width: int) -> set[bytes]:
    """Distinct ``width``-word shingles, A-Z lower-cased; of fewer words the whole sequence, of none nothing."""
    w = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    return {b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def _hashes(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of all shingles of the texts, as ``shingles`` cuts them."""
    w = words(texts, lower=True)
    runs = Runs(w.hashes(SEED), SEED + 1)
    starts = w.run_starts(width)
    counts = np.diff(w.first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    of = np.r_[w.text_of_word()[starts], short]
    return of, runs.of(np.r_[starts, w.first[short]], np.r_[starts + width, w.first[short + 1]])


def sketch_length(size: int, threshold: float) -> int:
    """Sketch size for an item of ``size`` shingles, from the upper size of its power-of-two partition."""
    upper = (1 << (size - 1).bit_length()) if size > 1 else 1
    return min(size, upper - math.ceil(threshold * upper) + 1)


class Sketches:
    """The items of one block: sketch hash to items, and each item's shingles for the verification."""

    def __init__(self, items: list[tuple[int | None, str | None]], width: int, threshold: float):
        self.width, self.threshold = width, threshold
        self.items = [(i, s) for i, t in items if (s := shingles(t, width))]
        by_hash: dict[int, list[int]] = defaultdict(list)
        for number, (_, own) in enumerate(self.items):
            _, h = _hashes([s.decode("utf-8", "surrogatepass") for s in own], width)
            for x in np.sort(h)[: sketch_length(len(own), threshold)].tolist():
                by_hash[x].append(number)
        self.hashes = np.array(sorted(by_hash), np.uint64)
        self.numbers = [by_hash[x] for x in self.hashes.tolist()]

    def probe(self, texts: list[str | None]) -> Iterator[tuple[int, int | None, int, int]]:
        """(text number, item id, item's shingles, shared shingles) of every pair at the threshold."""
        if not len(self.hashes):
            return
        of, h = _hashes(texts, self.width)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = self.hashes[at] == h
        candidates: dict[int, set[int]] = defaultdict(set)
        for text, place in zip(of[hit].tolist(), at[hit].tolist()):
            candidates[text].update(self.numbers[place])
        for text, numbers in candidates.items():
            own = shingles(texts[text], self.width)
            for number in sorted(numbers):
                item, wanted = self.items[number]
                shared = len(wanted & own)
                if shared >= self.threshold * len(wanted):
                    yield text, item, len(wanted), shared


def _blocks(items: DataFrame, block_chars: int) -> Iterator[Broadcast]:
    """The (item_id, text) rows in broadcast blocks of about ``block_chars`` characters at most."""
    slim = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total * 2 // block_chars) or 1
    for block in range(blocks):
        part = slim.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else slim
        yield items.sparkSession.sparkContext.broadcast([(r.item_id, r.text) for r in part.toLocalIterator()])


def contained_items(
    docs: DataFrame, items: DataFrame, width: int = 5, threshold: float = 0.8, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every item held by a document to ``threshold`` or more.

    ``docs`` (doc_id, text) are read in place, without a shuffle, once per block of ``items`` (item_id, text);
    a block is broadcast and holds at most about ``block_chars`` characters. Texts with fewer words than
    ``width`` are one shingle; NULL and wordless texts hold nothing and are held by nothing. Repeated rows on
    either side give repeated pairs. Further columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found: DataFrame | None = None
    for shared in _blocks(items, block_chars):

        def probe(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            sketches = Sketches(shared.value, width, threshold)
            for batch in batches:
                ids, all_texts = (c.to_pylist() for c in batch.columns)
                rows = [
                    (ids[cut][t], i, n, m) for cut in slices(all_texts) for t, i, n, m in sketches.probe(all_texts[cut])
                ]
                columns = zip(*rows) if rows else ((),) * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        names = ["doc_id", "item_id", "n_item", "n_shared"]
        pairs = texts.mapInArrow(probe, ", ".join(f"{c} bigint" for c in names))
        found = pairs if found is None else found.union(pairs)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def decontaminate(
    docs: DataFrame, items: DataFrame, width: int = 5, threshold: float = 0.8, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``text`` holds no item; rows are judged where they are read."""
    kept, place = docs, docs.columns.index("text")
    for shared in _blocks(items, block_chars):

        def keep(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            sketches = Sketches(shared.value, width, threshold)
            for batch in batches:
                texts = batch.column(place).to_pylist()
                clean = np.ones(len(texts), bool)
                for cut in slices(texts):
                    clean[[cut.start + t for t, *_ in sketches.probe(texts[cut])]] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(keep, docs.schema)
    return kept
