"""Toxicity by gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon is learned: words, and the first 4 to 6 bytes of words, that labelled toxic texts hold far more
often than clean ones, by a log-likelihood test. Rows that train the trees get their features from a lexicon
learned without their own fold, so the trees see it as it will work on new texts. Features are densities of
lexicon words, also after undoing letter swaps, their nearness to second-person words, capitals, punctuation,
obfuscation rates and length. The text alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import boosting
from .common import flat, fold, pack, tasks_for
from .textnp import LOWER, NO_TERM, Words, slices, words

#: Bound on the labelled rows that lexicon, trees and calibration are fitted to.
SAMPLE = 20_000
#: Characters and rows whose features a task holds at once when it scores: features take some 90 times their texts' memory.
SCORED, ROWS = 1_000_000, 512
FOLDS = 4
STEMS = (4, 5, 6)
SEED = 53
#: Least log-likelihood ratio of a lexicon term. A few chance terms pass; rows see lexicons without their own fold, so the
#: trees learn how far to trust a weak term.
LEAST = 14.0
NEAR = 5
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine ihr euch euer sie tu toi te ton ta tes vous votre vos "
    "tú ti usted ustedes vosotros tuyo"
).split()
#: Look-alikes of letters.
SWAPS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_UNSWAP = LOWER.copy()
for _from, _to in SWAPS.items():
    _UNSWAP[ord(_from)] = ord(_to)
_NO_SWAPPED = NO_TERM & ~np.isin(np.arange(256), [ord(c) for c in SWAPS])
_N_FEATURES = 16


def _keys(w: Words) -> list[np.ndarray]:
    """Hashes of all words, and of their first bytes for words that are longer (else 0); the kinds never collide."""
    letters = w.letters(SEED)
    out = [letters.of(w.starts, w.ends)]
    for n in STEMS:
        longer = w.ends - w.starts > n
        stem = letters.of(w.starts, np.minimum(w.starts + n, w.ends)) ^ np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64))
        out.append(np.where(longer, stem, np.uint64(0)))
    return out


def _second_person() -> np.ndarray:
    return np.sort(words(SECOND_PERSON, lower=True).hashes(SEED))


def _within(values: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is a key, place among the keys)."""
    if not len(sorted_keys):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return sorted_keys[at] == values, at


def features(texts: list[str | None], terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A row of features for each text; ``terms`` are sorted lexicon hashes with ``weights`` above 0."""
    n = len(texts)
    w = words(texts, lower=True, between=NO_TERM)
    of = w.text_of_word()
    count = np.maximum(np.diff(w.first), 1).astype(float)

    def per_text(values: np.ndarray, texts_of: np.ndarray = of) -> np.ndarray:
        return np.bincount(texts_of, values.astype(float), minlength=n)[:n]

    gain = np.zeros(len(of))
    word_hit = stem_hit = np.zeros(len(of), bool)
    for kind, keys in enumerate(_keys(w)):
        hit, at = _within(keys, terms)
        gain = np.maximum(gain, np.where(hit, weights[at], 0.0) if len(terms) else 0.0)
        word_hit, stem_hit = (hit, stem_hit) if kind == 0 else (word_hit, stem_hit | hit)
    any_hit = word_hit | stem_hit
    hits = per_text(any_hit)
    you, _ = _within(w.hashes(SEED), _second_person())
    at_you = np.flatnonzero(you)
    at_hit = np.flatnonzero(any_hit)
    beside = np.zeros(len(at_hit), bool)
    if len(at_you) and len(at_hit):
        place = np.searchsorted(at_you, at_hit)
        for near in (at_you[np.minimum(place, len(at_you) - 1)], at_you[np.maximum(place - 1, 0)]):
            beside |= (np.abs(near - at_hit) <= NEAR) & (of[near] == of[at_hit])
    best = np.zeros(n)
    np.maximum.at(best, of, gain)

    # Tokens with look-alikes of letters in them, read as the letters they stand for.
    v = words(texts, between=_NO_SWAPPED)
    swapped = (_UNSWAP[v.data] != LOWER[v.data]).cumsum()
    odd = swapped[v.ends - 1] - np.where(v.starts > 0, swapped[v.starts - 1], 0) > 0
    letter = np.r_[0, ((LOWER[v.data] >= 97) & (LOWER[v.data] <= 122)).cumsum()]
    odd &= letter[v.ends] - letter[v.starts] > 1
    v_of = v.text_of_word()
    v.data = _UNSWAP[v.data]
    hidden = np.zeros(len(v_of), bool)
    for keys in _keys(v):
        hidden |= _within(keys, terms)[0]
    hidden &= odd

    raw = v_data = words(texts).data
    starts, ends = w.offsets[:-1], np.maximum(w.offsets[1:] - 1, w.offsets[:-1])
    size = np.maximum(ends - starts, 1).astype(float)

    def share(mask: np.ndarray) -> np.ndarray:
        running = np.r_[0, mask.cumsum()]
        return (running[ends] - running[starts]) / size

    upper = (raw >= 65) & (raw <= 90)
    up = np.r_[0, upper.cumsum()]
    shouted = (up[w.ends] - up[w.starts] == w.ends - w.starts) & (w.ends - w.starts > 2)
    again = np.zeros(len(raw), bool)
    again[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & (LOWER[raw[2:]] >= 97) & (LOWER[raw[2:]] <= 122)
    punctuation = NO_TERM[raw] & (raw > 32)
    columns = [
        per_text(word_hit) / count,
        np.log1p(per_text(word_hit)),
        per_text(stem_hit) / count,
        np.log1p(per_text(stem_hit)),
        per_text(gain) / count,
        best,
        np.bincount(of[at_hit], beside, minlength=n)[:n] / np.maximum(hits, 1),
        per_text(you) / count,
        share(upper),
        per_text(shouted) / count,
        share(raw == ord("!")),
        share(punctuation),
        per_text(odd, v_of) / count,
        share(again),
        np.log1p(per_text(hidden, v_of)),
        np.log1p(np.diff(w.first)),
    ]
    return np.stack(columns, axis=1)


def _likelihood_ratio(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Log-likelihood ratio of a term's texts by label against its texts overall; 0 where toxic texts hold it less."""
    share = n_toxic / max(n_toxic + n_clean, 1)
    both = toxic + clean
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(toxic > 0, toxic * np.log(toxic / (both * share)), 0.0)
        b = np.where(clean > 0, clean * np.log(clean / (both * (1 - share))), 0.0)
    return np.where(toxic > both * share, 2 * (a + b), 0.0)


def _lexicons(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted terms and weights[term, i]: lexicon i < FOLDS learned without fold i, the last from all rows."""
    cells = {(r.part, r.y): r.n for r in sample.groupBy("part", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = np.array([[cells.get((p, y), 0) for y in (0, 1)] for p in range(FOLDS)], float)
    buckets = tasks_for(sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, part, y = (c.to_pylist() for c in batch.columns)
            cell = np.array(part, np.int64) * 2 + np.array(y, np.int64)
            terms, cells = [], []
            for cut in slices(texts, SCORED):
                w = words(texts[cut], lower=True, between=NO_TERM)
                of = np.tile(w.text_of_word(), 1 + len(STEMS))
                keys = np.concatenate(_keys(w))
                of, keys = of[keys != 0], keys[keys != 0]
                order = np.lexsort((keys, of))
                of, keys = of[order], keys[order]
                new = np.ones(len(of), bool)
                new[1:] = (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])
                terms.append(keys[new])
                cells.append(cell[cut][of[new]])
            if not terms:
                continue
            t, c = np.concatenate(terms), np.concatenate(cells)
            order = np.lexsort((c, t))
            t, c = t[order], c[order]
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
            at = np.flatnonzero(new)
            times = np.diff(np.r_[at, len(t)])
            packed = pack(0, (t[at] % np.uint64(buckets)).astype(np.int64), terms=t[at].view(np.int64), cells=c[at], times=times)
            if len(packed):
                yield pa.RecordBatch.from_pandas(packed.drop(columns="chunk"), schema=shape, preserve_index=False)

    array = pa.list_(pa.int64())
    shape = pa.schema([("bucket", pa.int64()), ("terms", array), ("cells", array), ("times", array)])

    def weigh(pdf: pd.DataFrame) -> pd.DataFrame:
        terms, of = np.unique(flat(pdf, "terms"), return_inverse=True)
        table = np.zeros((len(terms), FOLDS, 2))
        cell = flat(pdf, "cells")
        np.add.at(table, (of, cell // 2, cell % 2), flat(pdf, "times"))
        ratios = []
        for without in [*range(FOLDS), None]:
            use = [p for p in range(FOLDS) if p != without]
            n = totals[use].sum(axis=0)
            ratios.append(_likelihood_ratio(table[:, use, 1].sum(axis=1), table[:, use, 0].sum(axis=1), n[1], n[0]))
        ratios = np.stack(ratios, axis=1)
        keep = (ratios >= LEAST).any(axis=1)
        return pd.DataFrame({"term": terms[keep], "ratios": pd.Series(list(ratios[keep]), dtype=object)})

    sent = sample.select("text", "part", "y").mapInArrow(count, "bucket bigint, terms array<bigint>, cells array<bigint>, times array<bigint>")
    found = sent.groupBy("bucket").applyInPandas(weigh, "term bigint, ratios array<double>").toPandas()
    terms = found["term"].to_numpy(np.int64).view(np.uint64)
    ratios = np.array(found["ratios"].tolist(), float).reshape(len(terms), FOLDS + 1)
    order = np.argsort(terms)
    return terms[order], np.where(ratios >= LEAST, np.log(np.maximum(ratios, 1.0)), 0.0)[order]


def _lexicon(terms: np.ndarray, weights: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    own = weights[:, number] > 0
    return terms[own], weights[own, number]


class Model:
    """A fitted scorer; small enough to be shipped to every task."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, trees: boosting.Trees):
        self.terms, self.weights, self.trees = terms, weights, trees

    def scores(self, texts: list[str | None]) -> list[float]:
        return [s for cut in slices(texts, SCORED) for s in self.trees.score(features(texts[cut], self.terms, self.weights)).tolist()]


def fit(docs: DataFrame, labels: DataFrame, learns: Column, sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` labelled rows at most, those of ``labels`` (doc_id, toxic) where ``learns`` holds.

    Rows are chosen by a hash of the id. NULL ids or labels teach nothing; of several labels the highest counts.
    """
    known = labels.where(learns & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.max("toxic").cast("int").alias("y"))
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int((1 << 20) * sample / n))
    # ``known`` is bounded by ``sample``, whatever the tables hold.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(known), F.col("_doc") == F.col("_id")).select(
        "text", F.pmod(F.xxhash64(F.col("_id") + 1), F.lit(FOLDS)).cast("int").alias("part"), "y"
    )
    rows = materialize(rows, "labelled")
    terms, weights = _lexicons(rows)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [_lexicon(terms, weights, p) for p in range(FOLDS)]
        for batch in batches:
            texts, part, y = (c.to_pylist() for c in batch.columns)
            for p in sorted(set(part)):
                at = [i for i, q in enumerate(part) if q == p]
                for cut in slices([texts[i] for i in at], SCORED):
                    x = features([texts[i] for i in at[cut]], *own[p])
                    columns = [pa.array(list(x)), pa.array([y[i] for i in at[cut]], pa.int32()), pa.array([p] * len(x), pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, ["x", "y", "part"])

    examples = materialize(rows.select("text", "part", "y").mapInArrow(learn, "x array<double>, y int, part int"), "examples")
    return Model(*_lexicon(terms, weights, FOLDS), boosting.fit(examples, F.col("part") == 0))


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``ROWS`` rows: only so many texts are Python strings, and rows of a result, at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row, where it is read. NULL, empty and wordless texts get the score of no features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = model.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, score double")


def rejecting(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = model.scores(batch.column(place).to_pylist())
            yield batch.filter(pa.array([s < threshold for s in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text is divisible by 5."""
    return fold(doc_id, 5) == 0
