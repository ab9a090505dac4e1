"""Language by string kernels: presence of character n-grams, Nystroem landmarks and kernel ridge regression.

The kernel of two texts counts the n-grams of 1 to 3 letters that both hold, divided by the root of the
numbers they hold. N-grams are hashed to bins, so a text is a vector of bins present and kernels against all
landmarks are one matrix product per batch. Landmarks are texts of the training sample; the kernel among them
turns landmark kernels into features, and ridge regression one language against the rest is solved from sums
that tasks make over the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .textnp import TaskCache, mix

#: Bounds on the training texts and on the landmarks of one language.
SAMPLE, LANDMARKS = 1500, 32
BINS, LONGEST = 1 << 14, 3
RIDGE = 1e-3
#: Texts of one matrix: at most so many, of about so many characters.
ROWS, CHARS = 256, 1_000_000
_tables = TaskCache()


def _letters() -> np.ndarray:
    """Which code points of the basic plane are letters."""
    if "letters" not in _tables:
        _tables["letters"] = np.array([chr(c).isalpha() for c in range(1 << 16)])
    return _tables["letters"]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def presence(texts: list[str | None]) -> np.ndarray:
    """Bins present in each text: lower-cased letters, anything between them one blank, whole texts."""
    joined = "\0".join([*((t or "").lower().replace("\0", " ") for t in texts), ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    end = codes == 0
    letter = _letters()[np.minimum(codes, 0xFFFF)] | (codes > 0xFFFF)
    blank = ~letter & ~end
    keep = ~(blank & np.r_[False, blank[:-1]])
    codes = np.where(blank, 32, codes)[keep].astype(np.uint64)
    end = codes == 0
    of = np.cumsum(end) - end
    out = np.zeros((len(texts), BINS), np.float32)
    h = np.zeros(len(codes), np.uint64)
    good = ~end
    for n in range(1, LONGEST + 1):
        size = len(codes) - n + 1
        if size <= 0:
            break
        h = h[:size] * np.uint64(0x100000001B3) + codes[n - 1 :]
        good = good[:size] & ~end[n - 1 :]
        out[of[:size][good], (mix(h[good] + np.uint64(n)) >> np.uint64(50)).astype(np.int64)] = 1
    return out


def batches_of(texts: list[str | None]) -> Iterator[slice]:
    begin = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > begin and (i - begin >= ROWS or size + n > CHARS):
            yield slice(begin, i)
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield slice(begin, len(texts))


class Landmarks:
    """Features of texts from their kernels against fixed texts."""

    def __init__(self, texts: list[str]):
        self.bins = presence(texts).T
        self.sizes = np.sqrt(np.maximum(self.bins.sum(axis=0), 1))
        kernel = (self.bins.T @ self.bins) / (self.sizes[:, None] * self.sizes[None, :])
        values, vectors = np.linalg.eigh(kernel.astype(float))
        use = values > 1e-6
        self.whiten = vectors[:, use] / np.sqrt(values[use])

    def features(self, texts: list[str | None]) -> np.ndarray:
        bins = presence(texts)
        sizes = np.sqrt(np.maximum(bins.sum(axis=1), 1))
        kernel = (bins @ self.bins) / (sizes[:, None] * self.sizes[None, :])
        return np.c_[kernel.astype(float) @ self.whiten, np.ones(len(texts))]


class Model:
    def __init__(self, languages: list[str], landmarks: Landmarks | None, weights: np.ndarray | None):
        self.languages, self.landmarks, self.weights = languages, landmarks, weights

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score 0 to 1) of each text; ('und', 0) without letters or without a trained language."""
        out: list[tuple[str, float]] = []
        for cut in batches_of(texts):
            known = [has_letter(t) for t in texts[cut]]
            if not self.languages or not any(known):
                out += [("und", 0.0)] * len(known)
                continue
            margins = self.landmarks.features(texts[cut]) @ self.weights
            odds = np.exp(4 * (margins - margins.max(axis=1, keepdims=True)))
            best = margins.argmax(axis=1)
            score = 1 / odds.sum(axis=1)
            out += [(self.languages[b], float(s)) if k else ("und", 0.0) for b, s, k in zip(best, score, known)]
        return out


def fit(docs: DataFrame, learns: Column, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """Fit on rows of ``docs`` (doc_id, text, lang) where ``learns`` holds, about ``sample`` of each language at most.

    Rows are chosen by a hash of id, text and language, so copies of a text under other ids are chosen one by one; NULL
    languages and texts without letters teach nothing. The languages are the distinct values of lang: one row
    each is gathered. Every language counts alike, however many rows it has in the table or in the sample.
    """
    known = docs.where(learns & F.col("lang").isNotNull())
    texts = known.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("bigint").alias("id"))
    texts = texts.where(F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r.n for r in texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], None, None)
    order = F.pmod(F.xxhash64("text", "lang", "id"), F.lit(1 << 30))

    def at_most(n: int) -> Column:
        """About ``n`` rows of each language at most: a threshold on the hash per language."""
        limits = [x for c in languages for x in (F.lit(c), F.lit(int((1 << 30) * min(1.0, n / counts[c]))))]
        return order < F.create_map(*limits)[F.col("lang")]

    rows = materialize(texts.where(at_most(sample)), "languages")
    # Twice the expected number at most: rows that repeat an id and its text are chosen together.
    chosen = rows.where(at_most(landmarks)).orderBy(order, "text").limit(2 * landmarks * len(languages)).select("text").collect()
    taken = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not chosen:  # few rows, and no hash below the threshold
        chosen = rows.orderBy("text").limit(landmarks).select("text").collect()
    marks = Landmarks([r.text for r in chosen])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_, langs = (c.to_pylist() for c in batch.columns)
            for cut in batches_of(texts_):
                x = marks.features(texts_[cut])
                y = np.array([[1.0 if c == lang else -1.0 for c in languages] for lang in langs[cut]])
                weight = np.array([1 / taken[lang] for lang in langs[cut]])  # by its rows in the sample
                part = np.c_[x.T @ (x * weight[:, None]), x.T @ (y * weight[:, None])]
                yield pa.RecordBatch.from_arrays([pa.array([part.ravel().tolist()])], ["part"])

    n = marks.whiten.shape[1] + 1
    total = np.zeros((n, n + len(languages)))
    for r in rows.select("text", "lang").mapInArrow(sums, "part array<double>").toLocalIterator():
        total += np.array(r.part).reshape(total.shape)
    gram = total[:, :n]
    weights = np.linalg.solve(gram + RIDGE * np.trace(gram) / n * np.eye(n), total[:, n:])
    return Model(languages, marks, weights)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, where it is read; 'und' with score 0 for texts without a letter.

    NULL and empty texts are 'und'; repeated rows and NULL or repeated ids are rows of their own, equal texts get equal results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.predict(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array([l for l, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, lang_pred string, score double")
