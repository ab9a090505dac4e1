"""I-Match fingerprints: hashes of a text's distinct terms that lie in a band of inverse document frequency.

The lexicon are the terms whose share of documents lies in ``[low, high]``. A text's signature hashes its sorted
distinct lexicon terms. Around it stand signatures over randomised parts of the lexicon, in sizes from a quarter
down: two texts agree in a part if they hold the same of its terms, which for parts of about one term a text
happens as often as the texts' terms overlap. So likeness is measured from fingerprints alone, from equal texts
down to halves in common.

Terms of a text that very many rows repeat lie outside the band. So every text also has signatures over randomised
parts of all its terms, and the fewer of its terms lie in the band, the more these count in a comparison.

The lexicon is broadcast. Its size is bounded for every corpus: a document has ``T`` distinct terms on average,
so at most ``T / low`` terms occur in the share ``low`` of all documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FIRST_KEY, flat, pack, range_bounds, range_number, tasks_for
from .textnp import NO_TERM, mix, slices, words

LOW, HIGH = 0.0005, 0.1
SCALES, SUBSETS = 6, 24
#: With this share of its terms in the band and more, a text is compared by them alone.
ENOUGH = 0.25
SEED = 31


def _terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of all terms: runs of letters and digits, A-Z lower-cased."""
    w = words(texts, lower=True, between=NO_TERM)
    return w.text_of_word(), w.hashes(SEED)


def _distinct(of: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
    return of[new], h[new]


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> tuple[np.ndarray, int]:
    """Sorted hashes of the terms found in a share of ``low`` to ``high`` of all rows (and in two at least), and the rows.

    Frequencies count every row. Tasks send each distinct term once per batch, packed by hash bucket.
    """
    buckets = tasks_for(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [_distinct(*_terms(texts[cut]))[1] for cut in slices(texts)]
            terms, times = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64),) * 2
            packed = pack(0, (terms % np.uint64(buckets)).astype(np.int64), terms=terms.view(np.int64), times=times)
            if len(packed):
                yield pa.RecordBatch.from_pandas(packed[["bucket", "terms", "times"]], schema=shape, preserve_index=False)

    shape = pa.schema([("bucket", pa.int64()), ("terms", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
    n = docs.count()
    least, most = max(2.0, low * n), max(2.0, high * n)

    def band(pdf: pd.DataFrame) -> pd.DataFrame:
        terms, of = np.unique(flat(pdf, "terms"), return_inverse=True)
        times = np.zeros(len(terms), np.int64)
        np.add.at(times, of, flat(pdf, "times"))
        return pd.DataFrame({"term": terms[(times >= least) & (times <= most)]})

    sent = docs.select(F.col("text").cast("string")).mapInArrow(count, "bucket bigint, terms array<bigint>, times array<bigint>")
    kept = sent.groupBy("bucket").applyInPandas(band, "term bigint").toPandas()
    return np.sort(kept["term"].to_numpy(np.int64).view(np.uint64)), n


def signatures(texts: list[str | None], lexicon_terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature of 64 bits, parts[text, set, scale, subset] of 16 bits, share of 16 bits) of each text.

    Set 0 has the lexicon terms, set 1 all terms; a part without a term is 0. The share is that of distinct terms
    in the lexicon, 65535 for all. The signature of a text without a lexicon term hashes all its terms; a text
    without terms has zeros only.
    """
    of, h = _distinct(*_terms(texts))
    if len(lexicon_terms):
        at = np.minimum(np.searchsorted(lexicon_terms, h), len(lexicon_terms) - 1)
        inside = lexicon_terms[at] == h
    else:
        inside = np.zeros(len(h), bool)
    n_inside = np.bincount(of[inside], minlength=len(texts))
    share = n_inside * 65535 // np.maximum(np.bincount(of, minlength=len(texts)), 1)

    def sums(member: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Hash of each text's members, 0 without any."""
        texts_of = of[member]
        running = np.r_[np.zeros(1, np.uint64), np.cumsum(mix(values[member]))]
        cuts = np.searchsorted(texts_of, np.arange(len(texts) + 1))
        total = mix(running[cuts[1:]] - running[cuts[:-1]])
        return np.where(cuts[1:] > cuts[:-1], total, np.uint64(0))

    whole = sums(np.flatnonzero(inside | (n_inside == 0)[of]), h)
    parts = np.zeros((len(texts), 2, SCALES, SUBSETS), np.uint16)
    for subset in range(SUBSETS):
        u = mix(h + mix(np.arange(subset + 1, subset + 2).astype(np.uint64)))
        member = np.arange(len(h))
        for scale in range(SCALES):  # a quarter of the terms, a sixteenth, ...: each inside the one before
            member = member[(u[member] >> np.uint64(2 * scale)) & np.uint64(3) == 0]
            for kind, some in enumerate((member[inside[member]], member)):
                digest = sums(some, u)
                parts[:, kind, scale, subset] = np.where(digest > 0, digest % np.uint64(65535) + np.uint64(1), 0)
    return whole, parts, share.astype(np.uint16)


def text_form(whole: np.ndarray, parts: np.ndarray, share: np.ndarray) -> list[str]:
    """Fingerprints as text: 16 hex digits of the signature, then 4 for every part and for the share."""
    lead = whole.astype(">u8").tobytes().hex()
    rest = np.concatenate((parts.reshape(len(whole), -1), share[:, None]), axis=1).astype(">u2").tobytes().hex()
    n = 4 * (2 * SCALES * SUBSETS + 1)
    return [lead[16 * i : 16 * i + 16] + rest[n * i : n * i + n] for i in range(len(whole))]


Signed = tuple[np.ndarray, np.ndarray, np.ndarray]


def _agreement(a: np.ndarray, b: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """The share of parts[pair, scale, subset] that agree; ``equal`` where there are none.

    Counted are parts in which either text has a term, on the scales where that is so in at most four of
    five parts: larger parts hold many terms of a text and all but never agree. If there is no such scale, the
    finest one counts.
    """
    either = (a > 0) | (b > 0)
    same = either & (a == b)
    filled = either.mean(axis=2)
    use = (filled > 0) & (filled <= 0.8)
    use[:, -1] |= ~use.any(axis=1)
    agree = (same.sum(axis=2) * use).sum(axis=1)
    seen = (either.sum(axis=2) * use).sum(axis=1)
    return np.where(seen > 0, agree / np.maximum(seen, 1), equal)


def likeness(a: Signed, b: Signed) -> np.ndarray:
    """0 to 1 for each pair of fingerprints: agreement by lexicon terms, 1 for equal signatures, and by all terms.

    The lexicon terms count by the smaller share of them in the two texts, from ``ENOUGH`` alone.
    """
    equal = (a[0] == b[0]).astype(float)
    band = np.maximum(_agreement(a[1][:, 0], b[1][:, 0], equal), equal)
    every = _agreement(a[1][:, 1], b[1][:, 1], equal)
    weight = np.minimum(np.minimum(a[2], b[2]) / (65535 * ENOUGH), 1.0)
    return np.where(weight < 1, every + weight * (band - every), band)


def fingerprint(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(doc_id, fingerprint) for every row, where it is read; NULL counts as the empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs, low, high)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            prints = [x for cut in slices(texts) for x in text_form(*signatures(texts[cut], shared.value))]
            yield pa.RecordBatch.from_arrays([ids, pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, fingerprint string")


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, extra, doc_id, text), each part's rows in descending doc_id and, after them, the next row (``extra``).

    Ids are cut into ranges by quantiles; the row that starts a range is also sent to the range before, the
    very first one to the last. Texts are shuffled once. NULL ids come last; equal ids go by their texts.
    """
    slim = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_KEY)).alias("key"), F.col("text").cast("string").alias("text")
    )
    bounds = range_bounds(slim.select("key"), "key", ranges)
    part = range_number(F.col("key"), bounds).alias("part")
    tops = slim.select(part, "key").groupBy("part").agg(F.max("key").alias("top")).orderBy("part").collect()
    if not tops:
        return slim.select(F.lit(0).alias("part"), F.lit(False).alias("extra"), F.col("key").alias("doc_id"), "text")
    parts = [r.part for r in tops]
    users = parts[1:] + parts[:1]  # the row at a range's top follows the last row of the range above it
    top, user = [None] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for r, u in zip(tops, users):
        top[r.part], user[r.part] = r.top, u

    def at(values: list) -> F.Column:
        return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), F.col("part") + 1)

    own = F.struct(F.col("part").cast("bigint").alias("part"), F.lit(False).alias("extra"))
    copy = F.struct(at(user).alias("part"), F.lit(True).alias("extra"))
    placed = slim.withColumn("part", range_number(F.col("key"), bounds))
    copies = F.when(F.col("key") == at(top), F.array(own, copy)).otherwise(F.array(own))
    spread = placed.select(F.explode(copies).alias("o"), "key", "text").select("o.part", "o.extra", "key", "text")
    dealt = spread.repartition(tasks_for(docs), "part")
    return dealt.sortWithinPartitions("part", "extra", F.col("key").desc(), "text").withColumnRenamed("key", "doc_id")


def edited_likeness(docs: DataFrame, low: float = LOW, high: float = HIGH, ranges: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many of the next
    document in descending doc_id, after the last the first. NULL texts count as empty and equal texts have
    equal fingerprints; a table of one row is its own next.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs, low, high)[0])
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(rows: list[tuple[int, str]], following: str) -> pa.RecordBatch:
        """Rows of one part, in order, and the text that follows the last of them."""
        texts = [t for _, t in rows] + [following]
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, texts[1:])]
        plain, cut = signatures(texts, shared.value), signatures(edited, shared.value)
        own, after = tuple(x[:-1] for x in plain), tuple(x[1:] for x in plain)
        columns = [
            pa.array([None if i == FIRST_KEY else i for i, _ in rows], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
            pa.array(text_form(*own), pa.string()),
            pa.array(text_form(*cut), pa.string()),
            pa.array(likeness(own, cut), pa.float64()),
            pa.array(likeness(own, after), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, str]] = []
        part, closed, size = None, False, 0
        for batch in batches:
            for p, extra, i, t in zip(*(c.to_pylist() for c in batch.columns)):
                t = t or ""
                if p != part:
                    held, part, closed, size = [], p, False, 0
                if closed:
                    continue
                if held and (extra or size > 1_000_000):
                    yield compare(held, t)
                    held, size = [], 0
                closed = extra
                if not extra:
                    held.append((i, t))
                    size += len(t)

    slim = with_next(docs, ranges or 4 * tasks_for(docs))
    return slim.mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
