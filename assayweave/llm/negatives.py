"""Hard negatives: for an anchor and each of its positives, the other-label rows that score just below, by segment summaries.

Vectors are integer vectors and scores their inner products. A vector is cut into segments of equal length, and every
segment's mean and deviation (the norm of what is left without the mean) are stored with the vector. In a segment of
``w`` components the products add up to ``w`` times the product of the means, give or take at most the product
of the deviations; so summaries bound a score from both sides. Levels of ever shorter segments are nested: where the
first bound does not decide, the next level refines it, and only what no level rules out is scored exactly.

Anchors are the query set: blocks of them meet blocks of all rows. A unit of work is one group of anchors with one
slice of the rows; its task streams the slice's blocks and keeps the best few rows of each anchor, so it sends a bounded
number of rows on. First the positives are found (best of the anchor's label), then the negatives between two scores.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import tasks_for

#: Segment lengths of the levels; a longer one is a multiple of the next.
LEVELS = (16, 4, 2)
BLOCK = 2048
ANCHORS = 2048
_STRIP = 256
_NO_ID = np.iinfo(np.int64).max
_EXACT, _LARGEST = 1 << 53, 1 << 40


# --- vectors and their summaries ---------------------------------------------------------


@dataclass
class Vectors:
    """Integer vectors of a block as doubles, padded with zeros to whole segments, and their summaries of each level."""

    rows: np.ndarray
    means: list[np.ndarray]
    deviations: list[np.ndarray]

    def take(self, which: np.ndarray | slice) -> Vectors:
        return Vectors(self.rows[which], [m[which] for m in self.means], [d[which] for d in self.deviations])


def summaries(rows: np.ndarray, levels: Sequence[int]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Means (times the root of the segment's length) and deviations of each vector's segments, for every level."""
    means, deviations = [], []
    for width in levels:
        parts = rows.reshape(len(rows), -1, width)
        mean = parts.mean(axis=2)
        means.append((mean * np.sqrt(width)).astype(np.float32))
        deviations.append(np.sqrt(np.square(parts - mean[:, :, None]).sum(axis=2)).astype(np.float32))
    return means, deviations


def bounds(a: Vectors, b: Vectors, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores of ``a`` with ``b``, wider by what rounding to single precision can err."""
    ma, mb, da, db = a.means[level], b.means[level], a.deviations[level], b.deviations[level]
    middle, spread = ma @ mb.T, da @ db.T
    norms = [np.sqrt(np.square(m, dtype=np.float64).sum(axis=1) + np.square(d, dtype=np.float64).sum(axis=1)) for m, d in ((ma, da), (mb, db))]
    spread = spread + (ma.shape[1] + 8) * 2.5e-7 * np.outer(*norms) + 1e-3
    return middle - spread, middle + spread


def exact_scores(a: Vectors, b: Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Scores of the pairs (i, j), all in 64-bit integers; what does not fit raises."""
    most = np.prod([np.sqrt(np.square(v.rows).sum(axis=1)).max(initial=0) for v in (a, b)])  # no partial sum is above it
    if most >= 1 << 63:
        raise ArithmeticError("an inner product exceeds 64 bits")
    if most >= _EXACT:
        return np.einsum("ij,ij->i", a.rows[i].astype(np.int64), b.rows[j].astype(np.int64))
    if len(i) * 8 > len(a.rows) * len(b.rows):
        return (a.rows @ b.rows.T)[i, j].astype(np.int64)
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        out[part] = np.einsum("ij,ij->i", a.rows[i[part]], b.rows[j[part]])
    return out


def between(a: Vectors, b: Vectors, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j) and exact scores of the allowed pairs whose score is in [low[i], high[i]]; bounds rule out first."""
    rows, columns = np.arange(len(a.rows)), np.arange(len(b.rows))
    for level in range(len(a.means)):
        below, above = bounds(a.take(rows), b.take(columns), level)
        allowed = allowed & (above >= low[rows, None]) & (below <= high[rows, None])
        left, top = allowed.any(axis=1), allowed.any(axis=0)
        rows, columns, allowed = rows[left], columns[top], allowed[left][:, top]
        if not len(rows):
            return rows, columns, np.zeros(0, np.int64)
    i, j = np.nonzero(allowed)
    i, j = rows[i], columns[j]
    scores = exact_scores(a, b, i, j)
    kept = (scores >= low[i]) & (scores <= high[i])
    return i[kept], j[kept], scores[kept]


class Best:
    """The ``k`` best (score descending, id ascending) of each of ``n`` slots seen so far."""

    def __init__(self, n: int, k: int):
        self.k, self.n = k, n
        self.slot, self.score, self.id, self.key = (np.zeros(0, np.int64) for _ in range(4))

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, key: np.ndarray) -> None:
        slot, score, ids, key = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids), (self.key, key)))
        order = np.lexsort((key, ids, -score, slot))
        slot = slot[order]
        first = np.searchsorted(slot, slot, "left")
        kept = np.arange(len(slot)) - first < self.k
        self.slot, self.score, self.id, self.key = slot[kept], score[order][kept], ids[order][kept], key[order][kept]

    def floor(self) -> np.ndarray:
        """The score a new row has to reach: that of the k-th best, or none."""
        out = np.full(self.n, -np.inf)
        slots, starts, counts = np.unique(self.slot, return_index=True, return_counts=True)
        full = counts == self.k
        out[slots[full]] = self.score[starts[full] + self.k - 1]
        return out


# --- blocks of rows ----------------------------------------------------------------------

_BLOCK = "vec_ids array<bigint>, keys array<bigint>, labels array<bigint>, vectors binary, means array<binary>, deviations array<binary>"
_BLOCK_TYPES = [*[pa.list_(pa.int64())] * 3, pa.binary(), *[pa.list_(pa.binary())] * 2]


def _packed(ids: list, keys: list, labels: list, vectors: list, dims: int, levels: Sequence[int]) -> list:
    rows = np.zeros((len(vectors), dims), np.float64)
    for row, v in zip(rows, vectors):
        row[: len(v)] = v
    if np.abs(rows).max(initial=0) >= _LARGEST:
        raise ArithmeticError("a component exceeds 40 bits")
    means, deviations = summaries(rows, levels)
    return [ids, keys, labels, rows.tobytes(), [m.tobytes() for m in means], [d.tobytes() for d in deviations]]


def _loaded(row: dict, dims: int, levels: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, Vectors]:
    ids = np.array([_NO_ID if v is None else v for v in row["vec_ids"]], np.int64)
    rows = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), dims)
    means, deviations = ([np.frombuffer(x, np.float32).reshape(len(ids), dims // w) for x, w in zip(row[n], levels)] for n in ("means", "deviations"))
    return ids, np.array(row["keys"], np.int64), np.array(row["labels"], np.int64), Vectors(rows, means, deviations)


def blocks(rows: DataFrame, dims: int, levels: Sequence[int], block: int = BLOCK, more: str = "") -> DataFrame:
    """Rows (vec_id, key, label, vector, more) packed where they lie, ``block`` a row at most, with their summaries.

    Rows with a column ``grp`` first (sorted by it) are packed group by group, whole, and keep it.
    """
    grouped = rows.columns[0] == "grp"
    extra = [c.split()[0] for c in more.split(", ") if c]
    schema = ("grp int, " if grouped else "") + _BLOCK + "".join(f", {c}" for c in more.split(", ") if c)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def close() -> pa.RecordBatch:
            ids, keys, labels, vectors = ([r[c] for r in held] for c in ("vec_id", "key", "label", "vector"))
            values = [*_packed(ids, keys, labels, vectors, dims, levels), *[[r[c] for r in held] for c in extra]]
            types = [*_BLOCK_TYPES, *[pa.list_(pa.list_(pa.int64()))] * len(extra)]
            names = [c.split()[0] for c in schema.split(", ")]
            columns = [pa.array([v], t) for v, t in zip(values, types)]
            if grouped:
                columns = [pa.array([held[0]["grp"]], pa.int32()), *columns]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["grp"] != held[0]["grp"] if grouped else len(held) == block):
                    yield close()
                    held = []
                held.append(row)
        if held:
            yield close()

    return rows.mapInArrow(pack, schema)


def _units(asked: DataFrame, stored: DataFrame, n_groups: int, slices: int, tasks: int) -> DataFrame:
    """Every group of anchors (a packed row each) with every slice of the packed rows, the anchors first in each unit."""
    extra = asked.columns[1 + len(stored.columns) :]
    none = [F.lit(None).cast(dict(asked.dtypes)[c]).alias(c) for c in extra]

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = asked.withColumn("slice", numbers(slices)).withColumn("stored", F.lit(False))
    dealt = stored.select("*", *none).withColumn("grp", numbers(n_groups))
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64("keys"), F.lit(slices)).cast("int")).withColumn("stored", F.lit(True))
    names = ["grp", "slice", "stored", *stored.columns, *extra]
    return asked.select(*names).union(dealt.select(*names)).repartition(tasks, "grp", "slice").sortWithinPartitions("grp", "slice", "stored")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one; blocks of a unit without anchors are left out."""
    unit = None
    for batch in batches:
        for at in range(batch.num_rows):
            here = (batch["grp"][at].as_py(), batch["slice"][at].as_py())
            if not batch["stored"][at].as_py():
                unit = here
            if unit == here:
                yield batch.slice(at, 1).to_pylist()[0]


def usable(rows: DataFrame, classes: int = 10, relabelled: int = 7) -> DataFrame:
    """(vec_id, label, vector) of the (vec_id, embedding, label) rows that take part; components become floor(256 x).

    Rows with a NULL label or vector or a NULL or non-finite component take no part. Where ``relabelled`` divides the id,
    the label becomes (label + 1) modulo ``classes``; a NULL id keeps its label.
    """
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % relabelled == 0, (label + 1) % classes).otherwise(label)
    kept = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    vector = F.transform(x, lambda c: F.floor(c * 256).cast("double"))
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), vector.alias("vector"))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column | None = None,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    levels: Sequence[int] = LEVELS,
    block: int = BLOCK,
    anchors_per_group: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over (vec_id, label, vector) rows.

    An anchor's positives are its first ``positives`` other rows of its label by score (ties: smaller vec_id). For each
    of them the first ``negatives`` rows of other labels whose score is between ``share`` (as a fraction) of the positive's
    score and that score are returned. Fewer if there are fewer; anchors without positives give no rows. ``vector``
    holds whole numbers; a shorter one counts as padded with zeros. Rows that share an id or a vector are rows
    of their own. NULL ids come last among ties and are no anchors by default. Scores beyond 64 bits raise.
    """
    if any(a % b for a, b in zip(levels, levels[1:])):
        raise ValueError("a level's segments have to be whole segments of the next level")
    is_anchor = F.col("vec_id") % 100 == 0 if is_anchor is None else is_anchor
    kept = rows.select("vec_id", F.monotonically_increasing_id().alias("key"), "label", "vector")
    kept = materialize(kept, "vectors")  # the numbers are those written
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 1
    dims = -(-longest // levels[0]) * levels[0]
    tasks = tasks_for(kept)
    stored = materialize(blocks(kept, dims, levels, block), "vector-blocks")
    asked = kept.where(is_anchor)
    n_groups = max(1, -(-asked.count() // anchors_per_group))
    slices = max(1, min(stored.count(), tasks))
    asked = asked.select(F.pmod(F.xxhash64("key"), F.lit(n_groups)).cast("int").alias("grp"), *kept.columns)

    def together(anchors: DataFrame, more: str = "") -> DataFrame:
        sorted_ = anchors.repartition(min(n_groups, tasks), "grp").sortWithinPartitions("grp", "key")
        return materialize(blocks(sorted_, dims, levels, more=more), "anchors")

    def strips(row: dict) -> Iterator[tuple]:
        ids, keys, labels, b = _loaded(row, dims, levels)
        for at in range(0, len(ids), _STRIP):
            part = slice(at, at + _STRIP)
            yield ids[part], keys[part], labels[part], b.take(part)

    def find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None

        def close() -> pa.RecordBatch:
            columns = [keys[best.slot], best.score, best.id, best.key]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _POSITIVE_NAMES)

        for row in _stream(batches):
            if not row["stored"]:
                if best is not None:
                    yield close()
                ids, keys, labels, a = _loaded(row, dims, levels)
                best, unlimited = Best(len(keys), positives), np.full(len(keys), np.inf)
                continue
            for b_ids, b_keys, b_labels, b in strips(row):
                allowed = (labels[:, None] == b_labels[None, :]) & (keys[:, None] != b_keys[None, :])
                i, j, score = between(a, b, allowed, best.floor(), unlimited)
                best.offer(i, score, b_ids[j], b_keys[j])
        if best is not None:
            yield close()

    found = _units(together(asked), stored, n_groups, slices, tasks).mapInArrow(find_positives, _POSITIVE)
    first = Window.partitionBy("anchor_key").orderBy(F.col("score").desc(), "other_id", "other_key")
    found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    met = found.groupBy("anchor_key").agg(F.sort_array(F.collect_list(F.struct("place", "score", "other_id"))).alias("p"))
    # Negatives: only anchors with a positive ask on, with a slot for each positive.
    again = asked.join(met, asked["key"] == met["anchor_key"])
    again = again.select(*asked.columns, F.col("p.score").alias("scores"), F.col("p.other_id").alias("others"))

    def find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for row in _stream(batches):
            if not row["stored"]:
                if best is not None:
                    yield _negatives(best, ids, keys, slot_of, others, scores)
                ids, keys, labels, a = _loaded(row, dims, levels)
                counts = np.array([len(s) for s in row["scores"]], np.int64)
                slot_of, starts = np.repeat(np.arange(len(keys)), counts), np.cumsum(counts) - counts
                scores, others = (np.array([x for some in row[n] for x in some], np.int64) for n in ("scores", "others"))
                least = np.array([-(-share[0] * s // share[1]) if s >= 0 else np.inf for s in scores.tolist()], np.float64)
                most = np.maximum.reduceat(scores, starts).astype(np.float64)
                best = Best(len(slot_of), negatives)
                continue
            for b_ids, b_keys, b_labels, b in strips(row):
                reach = np.maximum(least, best.floor())
                low = np.minimum.reduceat(reach, starts)
                i, j, score = between(a, b, labels[:, None] != b_labels[None, :], low, most)
                for k in range(int(counts.max())):
                    slot = np.minimum(starts[i] + k, len(slot_of) - 1)
                    due = (k < counts[i]) & (score <= scores[slot]) & (score >= reach[slot])
                    best.offer(slot[due], score[due], b_ids[j[due]], b_keys[j[due]])
        if best is not None:
            yield _negatives(best, ids, keys, slot_of, others, scores)

    again = together(again, "scores array<array<bigint>>, others array<array<bigint>>")
    found = _units(again, stored, n_groups, slices, tasks).mapInArrow(find_negatives, _NEGATIVE)
    first = Window.partitionBy("anchor_key", "slot").orderBy(F.col("negative_score").desc(), "negative_id", "negative_key")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)

    def back(column: str) -> Column:
        return F.when(F.col(column) != _NO_ID, F.col(column)).alias(column)

    return found.select(back("anchor_id"), back("positive_id"), "rank", back("negative_id"), "positive_score", "negative_score")


_POSITIVE_NAMES = ["anchor_key", "score", "other_id", "other_key"]
_POSITIVE = ", ".join(f"{n} bigint" for n in _POSITIVE_NAMES)
_NEGATIVE_NAMES = ["anchor_key", "anchor_id", "slot", "positive_id", "positive_score", "negative_score", "negative_id", "negative_key"]
_NEGATIVE = ", ".join(f"{n} bigint" for n in _NEGATIVE_NAMES)


def _negatives(best: Best, ids: np.ndarray, keys: np.ndarray, slot_of: np.ndarray, others: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    """What a unit of work has found: the best negatives of each slot."""
    anchor = slot_of[best.slot]
    place = np.arange(len(slot_of)) - np.searchsorted(slot_of, slot_of, "left")
    columns = [keys[anchor], ids[anchor], place[best.slot], others[best.slot], scores[best.slot], best.score, best.id, best.key]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _NEGATIVE_NAMES)
