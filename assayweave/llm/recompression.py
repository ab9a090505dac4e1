"""Repeated passages found and removed by recompression of the word sequence.

Rounds of recompression shorten every text: maximal runs of one symbol become one symbol, then each adjacent
pair of a left and a right symbol becomes one. A symbol's name is a 64-bit hash of what it stands for, and its
side in a round is a bit of that name; so all tasks give equal passages equal symbols without exchanging a
dictionary, save for symbols near a passage's ends that depend on words outside it.

A symbol is known to recur inside a window when all words that its making depends on lie in the window. Each
window takes as anchor the highest such symbol (of equal ones the smallest name). Equal windows have equal
anchors at equal places, hence a window whose anchor occurs once in all texts occurs once. The steps:

1. count the anchors over all texts, by name;
2. hash the windows under anchors that occur again to 96 bits, along with windows that have no anchor, and
   find each window's first occurrence;
3. mark the words of all later occurrences and drop them.

Texts are dealt once to chunks, ranges of (id, text) of about equal size in bytes; the three steps read that one
exchange. An id that a third of all rows share, or lack, is many chunks, and so are equal rows. Between the steps go
packed arrays: one row for a chunk and a hash bucket. In a chunk an anchor or a window counts once, so a passage that
a third of all texts share sends a row part per chunk, not per text.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FIRST_KEY, flat, pack, tasks_for
from .textnp import Runs, Words, mix, slices, words

WINDOW = 20
ROUNDS = 3
NAME, FIRST, SECOND = 101, 202, 303
#: Text of a chunk; a longer text is in a chunk of its own, or with the rest of one.
CHUNK_BYTES = 16 << 20
#: Code points of a text that order rows of one id, before a hash of the whole text does.
PREFIX = 64
_SAMPLED = 64
_NO = np.iinfo(np.int64).max


def _breaks(text_of: np.ndarray) -> np.ndarray:
    """True where the next symbol belongs to another text (and at the end)."""
    return np.r_[text_of[1:] != text_of[:-1], True] if len(text_of) else np.zeros(0, bool)


class Symbols:
    """The symbols of some texts: name, word range [start, end), and the words [left, right) its making depends on."""

    def __init__(self, names: np.ndarray, text_of: np.ndarray):
        at = np.arange(len(names))
        self.name, self.text = names, text_of
        self.start, self.end, self.left, self.right = at, at + 1, at, at + 1

    def _neighbours(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(left of the symbol before, right of the symbol after); beyond a text's ends nothing is known."""
        last = _breaks(self.text)
        before = np.r_[-1, self.left[:-1]] if len(place) else self.left
        after = np.r_[self.right[1:], _NO] if len(place) else self.right
        before = np.where(np.r_[True, last[:-1]], -1, before) if len(place) else before
        after = np.where(last, _NO, after)
        return before[place], after[place]

    def runs(self) -> None:
        """Each maximal run of two or more equal symbols becomes one; a symbol now also depends on its neighbours."""
        n = len(self.name)
        if not n:
            return
        new = np.r_[True, (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1])]
        heads = np.flatnonzero(new)
        tails = np.r_[heads[1:], n] - 1
        length = tails - heads + 1
        before, _ = self._neighbours(heads)
        _, after = self._neighbours(tails)
        name = self.name[heads]
        many = length > 1
        name = np.where(many, mix(mix(name + np.uint64(0x9E3779B97F4A7C15)) + length.astype(np.uint64)), name)
        self.left, self.right = before, after
        self.name, self.text, self.start, self.end = name, self.text[heads], self.start[heads], self.end[tails]

    def pairs(self, turn: int) -> np.ndarray:
        """Each left symbol followed by a right one in its text becomes one symbol; returns where new symbols stand.

        A pair depends on its two symbols only. A left symbol that stays alone depends on the one after it, a
        right one on the one before.
        """
        n = len(self.name)
        if not n:
            return np.zeros(0, np.int64)
        right_side = (mix(self.name + np.uint64(turn * 2 + 1)) >> np.uint64(63)).astype(bool)
        joins = np.zeros(n, bool)
        joins[:-1] = ~right_side[:-1] & right_side[1:] & (self.text[1:] == self.text[:-1])
        eaten = np.r_[False, joins[:-1]]
        at = np.flatnonzero(~eaten)
        joined = joins[at]
        nxt = np.minimum(at + 1, n - 1)
        before, after = self._neighbours(at)
        both = mix(mix(self.name[at] * np.uint64(3) + np.uint64(turn)) + self.name[nxt])
        alone_right = right_side[at] & ~joined
        alone_left = ~right_side[at] & ~joined
        left = np.where(alone_right, before, self.left[at])
        right = np.where(joined, self.right[nxt], np.where(alone_left, after, self.right[at]))
        self.name = np.where(joined, both, self.name[at])
        self.end = np.where(joined, self.end[nxt], self.end[at])
        self.text, self.start, self.left, self.right = self.text[at], self.start[at], left, right
        return np.flatnonzero(joined)


class _Least:
    """Place of the smallest value in any short range, from smallest places of ranges of 1, 2, 4, ... values."""

    def __init__(self, values: np.ndarray, longest: int):
        self.values = values
        self.tables = [np.arange(len(values))]
        while 1 << len(self.tables) <= longest:
            half = 1 << (len(self.tables) - 1)
            a, b = self.tables[-1][: max(len(values) - 2 * half + 1, 0)], self.tables[-1][half:]
            b = b[: len(a)]
            self.tables.append(np.where(values[b] < values[a], b, a))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For ranges [a, b) that hold a value; the first of equal ones."""
        size = np.frexp((b - a).astype(float))[1] - 1
        out = np.zeros(len(a), np.int64)
        for k, table in enumerate(self.tables):
            at = np.flatnonzero(size == k)
            if len(at):
                x, y = table[a[at]], table[b[at] - (1 << k)]
                out[at] = np.where(self.values[y] < self.values[x], y, x)
        return out


def anchors(w: Words, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, anchor name, anchor place) of every window; place -1 where a window has no anchor."""
    starts = w.run_starts(window)
    name = np.zeros(len(starts), np.uint64)
    place = np.full(len(starts), -1, np.int64)
    if not len(starts):
        return starts, name, place
    symbols = Symbols(w.hashes(NAME), w.text_of_word())
    made_in: list[tuple[np.ndarray, ...]] = []
    for turn in range(rounds):
        symbols.runs()
        made = symbols.pairs(turn)
        left, right = symbols.left[made], symbols.right[made]
        known = (left >= 0) & (right <= len(w.starts)) & (right - left <= window)
        made = made[known]
        made_in.append((left[known], right[known], symbols.name[made], symbols.start[made]))
    open_ = np.arange(len(starts))
    for left, right, names, at_word in reversed(made_in):
        # Both ends of what symbols depend on grow along the text, so a window's symbols are a range of them.
        a = np.searchsorted(left, starts[open_])
        b = np.searchsorted(right, starts[open_] + window, "right")
        some = b > a
        if some.any():
            best = _Least(names, window).of(a[some], b[some])
            name[open_[some]], place[open_[some]] = names[best], at_word[best]
            open_ = open_[~some]
    return starts, mix(name), place


def _intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Word ranges covered by windows at the sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window)
    begins, ends = np.r_[starts[0], starts[cut + 1]], np.r_[starts[cut], starts[-1]] + window
    return list(zip(begins.tolist(), ends.tolist()))


def _order_key() -> dict[str, Column]:
    """The order of rows: id, how the text begins, a hash of it; rows equal in all that are equal, and the split each is
    read in cuts a group of very many of them."""
    text = F.coalesce("text", F.lit(""))
    return {"_id": F.col("doc_id"), "_head": F.left(text, F.lit(PREFIX)), "_hash": F.xxhash64(text), "_split": F.spark_partition_id()}


def _chunk_bounds(rows: DataFrame, least: int) -> list[tuple]:
    """Ascending order keys that cut the rows into parts of about equal bytes: ``least`` parts or as many as bring a part to
    ``CHUNK_BYTES``. They come from about ``_SAMPLED`` sampled rows for each of ``least`` parts."""
    n = rows.count()
    share = min(1.0, _SAMPLED * least / max(n, 1))
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    sampled = rows.sample(share, seed=0) if share < 1 else rows
    found = sorted(tuple(r) for r in sampled.select(*[c.alias(k) for k, c in _order_key().items()], size.alias("size")).collect())
    if not found:
        return []
    through = np.cumsum([r[-1] for r in found])
    parts = max(least, int(through[-1] / share) // CHUNK_BYTES + 1)
    at = np.searchsorted(through, through[-1] * np.arange(1, parts) / parts)
    return sorted({found[i][:-1] for i in at.tolist()})


def _chunk_number(bounds: Sequence[tuple]) -> Column:
    """Number of boundaries <= the row's order key, as a balanced CASE tree."""
    key, types = F.struct(*_order_key()), ("bigint", "string", "bigint", "int")

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        bound = F.struct(*[F.lit(v).cast(t).alias(k) for v, t, k in zip(bounds[mid], types, _order_key())])
        return F.when(key >= bound, search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(bounds))


def without_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, chunks: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): texts without the words that an earlier equal window covers.

    Earlier means a smaller doc_id, or an earlier start in the same text; NULL ids come first. Rows that
    share an id are ordered by the first ``PREFIX`` code points of their texts, then by a hash of them, and of equal
    rows all but one count as later. NULL texts have no words; a text shorter than a window keeps all of them. The
    kept words are joined by one space, in a text that loses nothing as well. ``chunks`` sets how many parts the texts are
    dealt to at least.
    """
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_KEY))
    slim = docs.select(key.alias("doc_id"), F.col("text").cast("string").alias("text"))
    bounds = _chunk_bounds(slim, chunks or 2 * tasks_for(docs))
    parts = len(bounds) + 1
    # Chunks are ranges of the order: a place is a chunk and a word's number in it, and places have the order of the rule.
    keyed = slim.withColumns(_order_key())
    dealt = keyed.select("doc_id", "text", F.col("_hash").alias("hash"), _chunk_number(bounds).alias("chunk")).repartition(parts, "chunk")

    def in_order(pdf: pd.DataFrame) -> tuple[np.ndarray, list[str | None]]:
        ids, hashes = (pdf[c].to_numpy(np.int64) for c in ("doc_id", "hash"))
        texts = [t if isinstance(t, str) else None for t in pdf["text"]]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], (texts[i] or "")[:PREFIX], hashes[i]))
        return ids[order], [texts[i] for i in order]

    def bucket_of(hashes: np.ndarray) -> np.ndarray:
        return (hashes.view(np.uint64) % np.uint64(parts)).astype(np.int64)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        """The chunk's anchors by bucket, each once, or twice if it occurs more than once here."""
        _, texts = in_order(pdf)
        found = []
        for cut in slices(texts):
            _, name, place = anchors(words(texts[cut]), window, rounds)
            name, place = name[place >= 0], place[place >= 0]
            order = np.lexsort((name, place))  # symbols of two rounds may begin at one word
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(place[order]) != 0) | (name[order][1:] != name[order][:-1])
            found.append(name[order][new])
        names, times = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64),) * 2
        names = np.repeat(names, np.minimum(times, 2).astype(np.int64)).view(np.int64)
        return pack(int(pdf["chunk"].iloc[0]), bucket_of(names), names=names)

    def repeated(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of one bucket, the anchors of each chunk that occur twice or more in all chunks."""
        chunk = np.repeat(pdf["chunk"].to_numpy(np.int64), pdf["names"].map(len).to_numpy())
        names = flat(pdf, "names")
        _, of, times = np.unique(names, return_inverse=True, return_counts=True)
        keep = times[of] > 1
        out = pack(0, chunk[keep], names=names[keep])
        return out.assign(chunk=out["bucket"])[["chunk", "names"]]

    def hashed(docs_pdf: pd.DataFrame, names_pdf: pd.DataFrame) -> pd.DataFrame:
        """The chunk's windows under repeated anchors: each at its first place, later places apart."""
        known = np.unique(flat(names_pdf, "names").view(np.uint64))
        _, texts = in_order(docs_pdf)
        ones, twos, places, seen = [], [], [], 0
        for cut in slices(texts):
            w = words(texts[cut])
            starts, name, place = anchors(w, window, rounds)
            wanted = place < 0
            if len(known):
                wanted |= known[np.minimum(np.searchsorted(known, name), len(known) - 1)] == name
            starts = starts[wanted]
            ones.append(Runs(w.hashes(FIRST), FIRST + 1).of(starts, starts + window).view(np.int64))
            second = Runs(w.hashes(SECOND), SECOND + 1).of(starts, starts + window)
            twos.append((second >> np.uint64(32)).astype(np.uint32).view(np.int32))
            places.append((starts + seen).astype(np.int32))
            seen += len(w.starts)
        one, two, place = (np.concatenate(c) for c in (ones, twos, places))
        order = np.lexsort((place, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        chunk = int(docs_pdf["chunk"].iloc[0])
        head, tail = np.sort(order[new]), np.sort(order[~new])  # in the order of the text, which packs best
        firsts = pack(chunk, bucket_of(one[head]), one=one[head], two=two[head], place=place[head])
        if not len(tail):
            return firsts
        # Later places need no further look: they pass the next step in a bucket of this chunk alone.
        laters = pack(chunk, np.full(len(tail), -1 - chunk), one=one[tail] * 0, two=two[tail] * 0, place=place[tail])
        return pd.concat([firsts, laters], ignore_index=True)

    def later(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of one bucket of windows, the places that are not a window's first, by chunk."""
        if pdf["bucket"].iloc[0] < 0:
            return pdf[["chunk", "place"]]
        chunk = np.repeat(pdf["chunk"].to_numpy(np.int64), pdf["one"].map(len).to_numpy())
        one, two, place = (flat(pdf, c) for c in ("one", "two", "place"))
        order = np.lexsort((place, chunk, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        rest = order[~new]
        out = pack(0, chunk[rest], place=place[rest].astype(np.int32))
        return out.assign(chunk=out["bucket"])[["chunk", "place"]]

    def keep(docs_pdf: pd.DataFrame, places_pdf: pd.DataFrame) -> pd.DataFrame:
        """The chunk's texts without the words of the marked windows."""
        ids, texts = in_order(docs_pdf)
        place = np.sort(flat(places_pdf, "place"))
        rows, seen = [], 0
        for i, t in zip(ids.tolist(), texts):
            own = (t or "").encode("utf-8", "surrogatepass").split()
            lo, hi = np.searchsorted(place, (seen, seen + len(own)))
            kept, at = [], 0
            for begin, end in _intervals(place[lo:hi] - seen, window):
                kept += own[at:begin]
                at = end
            kept += own[at:]
            seen += len(own)
            text = b" ".join(kept).decode("utf-8", "surrogatepass")
            rows.append((None if i == FIRST_KEY else i, len(own), len(own) - len(kept), text))
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_text"])
        return out.assign(doc_id=pd.array([r[0] for r in rows], "Int64"))

    by_chunk = dealt.groupBy("chunk")
    counted = by_chunk.applyInPandas(count, "chunk bigint, bucket bigint, names array<bigint>")
    known = counted.groupBy("bucket").applyInPandas(repeated, "chunk int, names array<bigint>")
    columns = "chunk bigint, bucket bigint, one array<bigint>, two array<int>, place array<int>"
    windows = by_chunk.cogroup(known.groupBy("chunk")).applyInPandas(hashed, columns)
    marked = windows.groupBy("bucket").applyInPandas(later, "chunk int, place array<int>")
    return by_chunk.cogroup(marked.groupBy("chunk")).applyInPandas(
        keep, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    )
