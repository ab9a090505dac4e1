"""Spelling variants: words one edit apart, grouped under their most frequent spelling, by dense prefix-suffix tiling.

Two words are near when one inserted, deleted or replaced code point makes one the other. With the words' code
points in padded matrices, left-aligned and right-aligned, a tile of two blocks of words is compared at once: the
length of the common prefix plus that of the common suffix reaches the longer length less one exactly for them.

Which blocks meet: let the shorter word have ``s`` code points. An edit behind the first ``s // 2`` leaves that
prefix whole, any other leaves the last ``s - s // 2`` whole, so a near pair shares one of the two. Words are dealt to
these groups once as the shorter and once as the longer word; groups of over ``block`` words are cut into blocks
and all pairs of blocks become tiles of their own, so no task holds a large group and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import tasks_for

BLOCK = 1024
#: Small groups are compared together, up to so many words a tile.
_TILE = 512
#: Words of up to so many code points count alike.
_LONG = 2048
_FOUND = "word string, n_near bigint, best_n bigint, best string"


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and the code points plus one as matrices padded with zeros: left-aligned and right-aligned."""
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32) + np.uint32(1)
    flat = flat.astype(np.uint8 if not len(flat) or flat.max() < 256 else np.uint32)
    width = int(lengths.max(initial=0))
    row = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.zeros((len(words), width), flat.dtype)
    right = left.copy()
    left[row, place] = flat
    right[row, place + np.repeat(width - lengths, lengths)] = flat
    return lengths, left, right


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row of ``a`` with every row of ``b``; of the common suffix on reversed rows."""
    same = np.ones((len(a), len(b)), bool)
    length = np.zeros((len(a), len(b)), np.uint16 if a.shape[1] < 1 << 16 else np.int64)
    for x, y in zip(a.T, b.T):
        same &= x[:, None] == y[None, :]
        if not same.any():
            break
        length += same
    return length


def single_edits(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(near, common prefix) of every word of tile side ``a`` with every one of ``b``; equal words are not near."""
    (a_len, a_left, a_right), (b_len, b_left, b_right) = a, b
    longer, gap = np.maximum(a_len[:, None], b_len[None, :]), np.abs(a_len[:, None] - b_len[None, :])
    prefix = common_prefix(a_left, b_left)
    suffix = common_prefix(a_right[:, ::-1], b_right[:, ::-1])
    equal = (gap == 0) & (prefix >= longer)
    return (gap <= 1) & ~equal & (prefix.astype(np.int64) + suffix >= longer - 1), prefix


def _keys() -> Column:
    """The four groups of a word: by prefix and suffix, as the shorter word of a pair and as the longer one."""
    options = []
    for role in (0, 1):
        shorter = F.length("word") - role
        half = F.floor(shorter / 2).cast("int")
        head = F.substring(F.col("word"), F.lit(1), half)
        tail = F.expr(f"right(word, length(word) - {role} - cast(floor((length(word) - {role}) / 2) as int))")
        for side, key in ((False, head), (True, tail)):
            options.append(F.struct(shorter.alias("cls"), F.lit(side).alias("by_suffix"), key.alias("key")))
    return F.filter(F.array(*options), lambda o: o.cls > 0)


def _tiles(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows sorted by unit, cut between units into frames of about a tile, with the number of each row's unit."""
    kept = None
    for batch in batches:
        kept = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
        unit = kept["unit"].to_numpy()
        starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]) if len(unit) else np.zeros(0, np.int64)
        begin, longest = 0, kept["cls"].to_numpy()
        for i in range(1, len(starts)):
            end, following = starts[i], starts[i + 1] if i + 1 < len(starts) else None
            if following is None or (following - begin) * max(_LONG, longest[begin:following].max()) > _LONG * _TILE:
                number = np.searchsorted(starts, np.arange(begin, end), "right")
                yield kept.iloc[begin:end], number
                begin = end
        kept = kept.iloc[begin:].reset_index(drop=True)
    if kept is not None and len(kept):
        yield kept, pd.factorize(kept["unit"])[0]


def _compare(rows: pd.DataFrame, unit: np.ndarray) -> pd.DataFrame | None:
    """For each word of a tile: the number of near words in its unit that are due there, and the best of them."""
    words = rows["word"].tolist()
    n = rows["n"].to_numpy(np.int64)
    coded = code_points(words)
    length, cls = coded[0], rows["cls"].to_numpy(np.int64)
    block, cross = rows["block"].to_numpy(np.int64), rows["cross"].to_numpy(bool)
    by_suffix = rows["by_suffix"].to_numpy(bool)
    near, best = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
    # Candidates for the best are tried by descending frequency, then by code points.
    order = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])), np.int64)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    for at in range(0, len(words), _TILE):
        part = slice(at, at + _TILE)
        found, prefix = single_edits(tuple(x[part] for x in coded), coded)
        found &= unit[part, None] == unit[None, :]
        found &= np.minimum(length[part, None], length[None, :]) == cls[part, None]  # longer pairs have a group of their own
        found &= ~cross[part, None] | (block[part, None] != block[None, :])
        found &= ~(by_suffix[part, None] & (prefix >= cls[part, None] // 2))  # met by their prefix
        near[part] = found.sum(axis=1)
        first = np.where(found, place[None, :], len(words)).min(axis=1, initial=len(words))
        best[part] = np.where(near[part] > 0, order[np.minimum(first, len(words) - 1)], -1)
    hit = np.flatnonzero(near)
    if not len(hit):
        return None
    return pd.DataFrame({"word": [words[i] for i in hit], "n_near": near[hit], "best_n": n[best[hit]], "best": [words[i] for i in best[hit]]})


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) of each word with a near word: their number and the one of largest ``n``.

    ``words`` (word, n) is read several times and has distinct words. Ties go to the smallest in code-point order.
    """
    keyed = words.select("word", "n", F.explode(_keys()).alias("o")).select("word", "n", "o.*")
    sizes = keyed.groupBy("cls", "by_suffix", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    # Blocks of very long words are smaller, down to a word, so that a tile's matrices stay in memory.
    blocks = F.least("m", F.ceil(F.col("m") * F.greatest(F.col("cls"), F.lit(_LONG)) / (_LONG * block))).cast("int")
    placed = (
        keyed.join(sizes, ["cls", "by_suffix", "key"])
        .withColumn("block", F.pmod(F.xxhash64("word"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    )
    low, high = F.least("block", "other"), F.greatest("block", "other")
    dealt = placed.select(
        F.concat_ws("|", *[F.col(c).cast("string") for c in ("cls", "by_suffix")], low.cast("string"), high.cast("string"), "key").alias("unit"), "word", "n", "cls", "by_suffix", "block", (low < high).alias("cross")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, unit in _tiles(batches):
            found = _compare(rows, unit)
            if found is not None:
                yield found

    tasks = tasks_for(words)
    found = dealt.repartition(tasks, "unit").sortWithinPartitions("unit").mapInPandas(run, _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    named = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return named.select("word", "n_near", F.col("b.w").alias("best"), (-F.col("b.m")).alias("best_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form) links without cycles: the last word reached, by doubling the way in each round."""
    way = materialize(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = way.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        longer = materialize(longer, "forms")
        way = longer.select("word", "root")
        if longer.where("_moved").isEmpty():
            return way


def variants(words: DataFrame, ratio: int = 5, block: int = BLOCK) -> DataFrame:
    """One row per word of (word, n): ``n``, ``n_near``, ``form``, ``form_n`` and ``root``.

    The form is the near word of largest n, if that is at least ``ratio`` times the word's; the root is where the
    forms lead. Rows of a repeated word are one word with the sum of their n; NULL and empty words and words of no
    positive n are left out; an empty table gives no rows. ``ratio`` of at least 2 keeps the forms free of cycles.
    """
    if ratio < 2:
        raise ValueError("ratio has to be at least 2")
    known = words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("bigint").alias("n"))
    known = known.where("length(word) > 0 and n > 0").groupBy("word").agg(F.sum("n").alias("n"))
    known = materialize(known, "words")
    near = known.join(near_words(known, block), "word", "left")
    formed = F.col("best_n") >= ratio * F.col("n")
    near = materialize(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "near-words",
    )
    led = roots(near.where("form is not null"))
    return near.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def word_counts(docs: DataFrame, least_length: int = 6, least_count: int = 5, slip: int = 199) -> DataFrame:
    """(word, n) of the runs of Latin letters in whole texts, A-Z lower-cased, with one in ``slip`` misspelt.

    The slips are a fixed function of document and run: where ``slip`` divides the crc32 of ``<doc_id>:<run>``, the run
    loses the code point crc32 modulo its length. NULL texts have no runs, a NULL id counts as empty text. Runs too
    short to reach ``least_length`` never leave the scan.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    pattern = F.lit(r"[A-Za-zÀ-ÿ]{%d,}" % max(least_length, 1))
    text = F.col("text").cast("string")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_doc"), F.explode(F.regexp_extract_all(text, pattern, F.lit(0))).alias("_run"))
    runs = runs.select("_doc", F.translate("_run", upper, lower).alias("_run"))
    crc = F.crc32(F.concat("_doc", F.lit(":"), "_run").cast("binary"))
    runs = runs.select("_run", crc.alias("_h"))
    gone = F.pmod("_h", F.length("_run")).cast("int")
    cut = F.concat(F.substring(F.col("_run"), F.lit(1), gone), F.substring(F.col("_run"), gone + 2, F.length("_run")))
    word = F.when(F.col("_h") % slip == 0, cut).otherwise(F.col("_run"))
    counted = runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)
