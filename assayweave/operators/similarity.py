"""Exact set-similarity (Tanimoto) joins.

All-pairs scoring is quadratic, so pairs are found through shared rare elements (prefix
filtering) bounded by size and position, and only those candidates are scored:

* equal sets are collapsed first; everything below works on distinct sets ("classes");
* T(a, b) >= t needs ``t * n_a <= n_b <= n_a / t`` and an overlap of at least
  ``ceil(t / (1 + t) * (n_a + n_b))``;
* with elements ordered from rare to frequent, the first ``n - ceil(t * n) + 1`` elements of
  both sets must share one;
* prefixes longer by k elements must share k + 1; k grows with the set, and the shared elements of sets over an open vocabulary are
  counted where two blocks of sets of like sizes meet, before the sets are fetched;
* for packed bits an element held by very many sets is cut into blocks; block pairs meet in separate
  join keys, so no task holds more than ``block_rows`` squared comparisons of one element.

Where prefixes of bits rule out little, members of a group meet in tiles instead (``cliffs_in_tiles``).

Copies are brought back at the end, in arrays of a few members (``cliffs_of_pairs``), or through a
per-class shortlist when only the nearest ones are wanted (``nearest_neighbors_all``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from ..functions.fingerprint import bits_to_words
from ..session import materialize

BLOCK_ROWS = 4096
#: Elements of more sets than that count as equally frequent.
HOT_TOKEN = 10_000_000
#: Values of an element's hash that are counted to tell rare elements from frequent ones, a power of two: 4 bytes each in every task.
SKETCH = 1 << 20
#: Meetings of two sets in a shared element that a task counts at once.
MEETINGS = 4_000_000
#: Where all sets of bits meet, a block has so many times the rows: fewer copies of a row, no larger a join.
TILE = 1
#: Similar sets share one more element of their prefixes for so many elements in common at least.
SHARED = 24
#: Members of a class and a band that are carried together.
TOGETHER = 64
#: Entries that are multiplied with a tile at once, pairs told at once, and sets of a part unless more hang together.
STRIP, TOLD = 256, 8000
_EPS = 1e-9


def set_class(elements: str) -> Column:
    """Identity of a set: equal sorted distinct arrays share it (128-bit digest)."""
    return F.unhex(F.md5(F.array_join(F.col(elements).cast("array<string>"), "\x1f")))


def distinct_sets(df: DataFrame, elements: str, universe: int | None = None, known: DataFrame | None = None) -> DataFrame:
    """(sid, cls, n, elements[, words]), one row per distinct non-empty set, written once.

    ``sid`` is a short row number fixed by the write. With a ``universe`` the packed words
    are stored as well. ``known`` has a row for each ``cls`` that is wanted; its other columns come along.
    """
    sets = df.select(set_class(elements).alias("cls"), F.col(elements).alias("elements"))
    columns = [F.monotonically_increasing_id().alias("sid"), "cls", F.size("elements").alias("n"), "elements"]
    if universe is not None:
        columns.append(bits_to_words("elements", -(-universe // 64) * 64).alias("words"))
    # The empty set is dropped after the aggregation, or the filter would compute the sets twice.
    sets = sets.dropDuplicates(["cls"])
    if known is not None:
        sets = sets.join(known, "cls")
        columns += [c for c in known.columns if c != "cls"]
    return materialize(sets.select(*columns).where("n > 0"), "sets")


def _needed(threshold: float, n: Column) -> Column:
    return F.ceil(F.lit(threshold) * n - F.lit(_EPS)).cast("int")


def _blocks(df: DataFrame, key: str, member: str, block_rows: int) -> DataFrame:
    """Add ``_block`` and ``_blocks``: how a key with more than ``block_rows`` rows is cut.

    Only hot keys enter the size table, so it has at most rows / block_rows entries.
    """
    hot = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_size"))
        .where(F.col("_size") > block_rows)
        .select(key, F.ceil(F.col("_size") / block_rows).cast("int").alias("_blocks"))
    )
    marked = df.join(materialize(hot, "hot"), key, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    return marked.withColumn("_block", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))


def _meet(prefixes: DataFrame, member: str, threshold: float, block_rows: int) -> DataFrame:
    """Pairs of sets sharing a prefix element that the size and position bounds allow.

    ``prefixes`` has element, ``member``, n, rest (elements from this position on), ``least`` (elements a similar pair
    shares in its prefixes, see ``_least``) and payload columns; the result carries them with suffixes ``_l`` and ``_r``.
    A pair occurs once per shared element. For an element cut into blocks the left copy of a row
    goes to the block pairs (i, j) with its own block as i, the right copy to those with it
    as j, i <= j.
    """
    cut = _blocks(prefixes, "element", member, block_rows)
    carried = [c for c in prefixes.columns if c != "element"]
    own, last = F.col("_block"), F.col("_blocks") - 1
    left = cut.select(
        "element", own.alias("i"), F.explode(F.sequence(own, last)).alias("j"), *[F.col(c).alias(f"{c}_l") for c in carried]
    )
    right = cut.select(
        "element",
        F.explode(F.sequence(F.lit(0), own)).alias("i"),
        own.alias("j"),
        *[F.col(c).alias(f"{c}_r") for c in carried],
    )
    n_l, n_r = F.col("n_l"), F.col("n_r")
    overlap = _needed(threshold / (1.0 + threshold), n_l + n_r)
    # Before the k-th shared element k - 1 are shared, and the first ``least`` ones have to pass.
    possible = (
        ((F.col("i") < F.col("j")) | (F.col(f"{member}_l") < F.col(f"{member}_r")))
        & (F.least(n_l, n_r) >= _needed(threshold, F.greatest(n_l, n_r)))
        & (F.least("rest_l", "rest_r") + F.least("least_l", "least_r") > overlap)
    )
    # Little data can mean much work here: an explicit number keeps the exchange the join
    # needs anyway from being coalesced by its size in bytes.
    spread = int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return left.repartition(spread, "element", "i", "j").join(right, ["element", "i", "j"]).where(possible)


def _score(shared: Column) -> Column:
    return shared.cast("double") / (F.col("n_l") + F.col("n_r") - shared)


def _least(threshold: float, n: Column) -> Column:
    """How many elements prefixes lengthened by as many share: k common elements lie among the first n - overlap + k of both.

    Sets that are not similar share a few rare elements by chance, but hardly a number that grows with their size.
    """
    return F.lit(1) + F.floor(F.lit(threshold / SHARED) * n).cast("int")


def _ranked_bits(sets: DataFrame, width: int) -> tuple[DataFrame, int]:
    """``sets`` with ``_ranks`` (its bits numbered from rare to frequent, sorted), and how many of them are no two sets'.

    The frequency table is bounded by the width and becomes a literal array, so ordering the bits needs no shuffle.
    """
    in_range = F.col("bit").between(0, width - 1)
    # The packed words of a bit outside would be wrong: better no answer than a lost pair.
    checked = F.when(in_range, F.col("bit")).otherwise(F.raise_error(F.lit(f"a bit is not in [0, {width})")).cast("int"))
    counts = sets.select(F.explode("elements").alias("bit")).select(checked.alias("bit")).groupBy("bit").count().collect()
    found = {r["bit"]: r["count"] for r in counts}
    order = sorted(range(width), key=lambda i: (found.get(i, 0), i))
    place = [0] * width
    for i, bit in enumerate(order):
        place[bit] = i
    places = F.lit(place)
    ranked = sets.withColumn("_ranks", F.sort_array(F.transform("elements", lambda e: F.get(places, e))))
    return ranked, sum(found.get(i, 0) < 2 for i in range(width))


def _bit_prefixes(ranked: DataFrame, single: int, threshold: float, columns: Sequence[Column | str]) -> DataFrame:
    n = F.col("n")
    # Bits of a single set can meet nothing and are not emitted (they keep their position).
    return (
        ranked.select("n", *columns, F.posexplode(F.slice("_ranks", F.lit(1), n - _needed(threshold, n) + 1)).alias("_pos", "element"))
        .where(F.col("element") >= single)
        .withColumns({"rest": n - F.col("_pos"), "least": F.lit(1)})
        .drop("_pos")
    )


def _all_meet(prefixes: DataFrame, sets: DataFrame) -> bool:
    """Whether prefixes bring more pairs together than there are (few bits, low thresholds)."""
    return sum(r["count"] ** 2 for r in prefixes.groupBy("element").count().collect()) >= sets.count() ** 2


def prefixes_are_dense(sets: DataFrame, threshold: float, width: int) -> bool:
    """Whether prefixes of ``sets`` (from ``distinct_sets``) would bring more pairs together than there are."""
    return _all_meet(_bit_prefixes(*_ranked_bits(sets, width), threshold, []), sets)


def _similar_bits(sets: DataFrame, threshold: float, width: int, block_rows: int, carried: Sequence[str]) -> DataFrame:
    """Elements are bit numbers below ``width``: pairs are scored on packed words inside the join.

    Words hold the bits from rare to frequent and travel with each prefix row (width / 8
    bytes); a pair is kept at the first bit it shares, so only true pairs leave the join, once each. Where prefixes would bring
    more pairs together than there are (few bits, low thresholds), all sets meet in blocks instead, every pair once.
    """
    ranked, single = _ranked_bits(sets, width)
    n_words = -(-width // 64)
    ranked = ranked.withColumn("_words", bits_to_words("_ranks", n_words * 64))
    words = [F.get("_words", F.lit(i)).alias(f"w{i}") for i in range(n_words)]
    n = F.col("n")
    prefixes = _bit_prefixes(ranked, single, threshold, ["cls", *carried, *words])
    pairwise = _all_meet(prefixes, sets)
    if pairwise:
        prefixes = ranked.select("n", "cls", *carried, *words, F.lit(0).alias("element"), n.alias("rest"), F.lit(1).alias("least"))
        block_rows *= TILE
    both = [F.col(f"w{i}_l").bitwiseAND(F.col(f"w{i}_r")) for i in range(n_words)]
    shared = sum((F.bit_count(b) for b in both), F.lit(0))
    met = _meet(prefixes, "cls", threshold, block_rows)
    similarity = _score(shared)
    met = met.where(similarity >= threshold)
    if not pairwise:
        word, bit = F.floor(F.col("element") / 64), F.col("element") % 64
        for i, b in enumerate(both):
            # Bit 0 of a word is its highest.
            rarer = F.when((word == i) & (bit > 0), F.call_function("shiftrightunsigned", b, (F.lit(64) - bit).cast("int")))
            met = met.where(rarer.otherwise(F.when(word > i, b).otherwise(F.lit(0).cast("bigint"))) == 0)
    return _ordered(met, similarity, carried)


def _ordered(met: DataFrame, similarity: Column, carried: Sequence[str]) -> DataFrame:
    """(cls_a, cls_b, similarity, the carried columns of both), cls_a < cls_b."""
    right_first = F.col("cls_r") < F.col("cls_l")
    sides = [
        F.when(right_first, F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}")).alias(f"{c}_{s}")
        for s, x, y in (("a", "r", "l"), ("b", "l", "r"))
        for c in ("cls", *carried)
    ]
    return met.select(*sides, similarity.alias("similarity"))


def _by_tile(meet: Callable[[pa.Table], Iterator], keys: int) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow`` over rows sorted by their first ``keys`` columns: calls ``meet`` with all rows of each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            new = np.zeros(len(batch) - 1, bool)
            columns = [batch.column(i) for i in range(keys)]
            for k in columns:
                new |= pc.not_equal(k.slice(1), k.slice(0, len(k) - 1)).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(batch)]
            for start, end in zip(cuts, cuts[1:]):
                if held and any(held[-1].column(i)[0] != k[start] for i, k in enumerate(columns)):
                    yield from meet(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(start, end - start))
        if held:
            yield from meet(pa.Table.from_batches(held))

    return run


def _rarity(sets: DataFrame) -> np.ndarray:
    """How many elements of all sets fall to each of ``SKETCH`` values of their hash: an upper bound of an element's sets."""
    value = F.pmod(F.xxhash64("_token"), F.lit(SKETCH)).cast("int").alias("value")
    found = sets.select(F.explode("elements").alias("_token")).groupBy(value).agg(F.count(F.lit(1)).alias("f")).toArrow()
    out = np.zeros(SKETCH, np.int32)
    out[found["value"].to_numpy()] = np.minimum(found["f"].to_numpy(), max(HOT_TOKEN, 2))
    return out


def _size_blocks(counts: dict[int, int], threshold: float, rows: int) -> dict[str, np.ndarray]:
    """Blocks of about ``rows`` sets of like sizes, and which blocks hold sets of sizes that can be similar.

    By range of sizes (``size``: its least): the first of its blocks and their number, more than one only where a size has more
    sets than a block. By block: the first and last block it meets.
    """
    ranges: list[list[int]] = []  # least size, greatest size, sets
    for n in sorted(counts):
        if ranges and ranges[-1][2] + counts[n] <= rows:
            ranges[-1][1:] = [n, ranges[-1][2] + counts[n]]
        else:
            ranges.append([n, n, counts[n]])
    size, most, total = np.array(ranges, np.int64).reshape(-1, 3).T
    blocks = -(-total // rows)
    low, high = np.repeat(size, blocks), np.repeat(most, blocks)
    need = np.ceil(threshold * low - _EPS)
    return {
        "size": size,
        "first": np.cumsum(blocks) - blocks,
        "blocks": blocks,
        "from": np.searchsorted(high, need, "left"),
        "to": np.searchsorted(need, high, "right") - 1,
    }


def _rarest(rarity: Broadcast, blocks: dict[str, np.ndarray]) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow``: sets of hashes in, their rarest ones (32 bits of each) and the blocks the set meets out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = rarity.value
        for batch in batches:
            if not len(batch):
                continue
            sid, n, length, least = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            codes = batch.column(4).flatten().to_numpy(zero_copy_only=False)
            many = batch.column(4).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(batch)), many)
            f = known[codes & (len(known) - 1)]
            order = np.lexsort((codes, f, row))
            place = np.arange(len(codes)) - np.repeat(np.cumsum(many) - many, many)
            # What no other set can hold is not sent, but keeps its place.
            kept = order[(place < length[row]) & (f[order] > 1)]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(batch)))]).astype(np.int32)
            at = np.searchsorted(blocks["size"], n, "right") - 1
            # Row numbers of a partition follow each other, so their remainders deal it evenly.
            block = blocks["first"][at] + (sid % blocks["blocks"][at])
            short = (codes[kept] >> 32).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sid),
                    pa.array(n),
                    pa.array(least),
                    *[pa.array(x.astype(np.int32)) for x in (block, blocks["from"][block], blocks["to"][block])],
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(short)),
                ],
                names=["sid", "n", "least", "_own", "_from", "_to", "codes"],
            )

    return run


def _share_enough(threshold: float) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow``: the prefixes of pairs of blocks in, pairs of sets that share enough of them out, each once.

    Pairs that hang together by a set are one part, small ones go together, so few parts need the same set.
    """

    def parts(rows: int, x: np.ndarray, y: np.ndarray, number: int) -> np.ndarray:
        label, last = np.arange(rows), None
        while last is None or (label != last).any():
            last = label.copy()
            least_label = np.minimum(label[x], label[y])
            np.minimum.at(label, x, least_label)
            np.minimum.at(label, y, least_label)
            label = label[label]
        sets = np.bincount(label, minlength=rows)
        return number + ((np.cumsum(sets) - sets) // TOLD)[label[x]]

    def meet(table: pa.Table) -> Iterator[pa.RecordBatch]:
        batch = table.combine_chunks().to_batches()[0]
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        sid, n, least = (column[x].to_numpy(zero_copy_only=False) for x in ("sid", "n", "least"))
        codes = column["codes"].flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(batch)), column["codes"].value_lengths().to_numpy(zero_copy_only=False))
        same = column["_i"][0] == column["_j"][0]
        ours = column["_left"].to_numpy(zero_copy_only=False)[row]
        theirs = column["_right"].to_numpy(zero_copy_only=False)[row]
        order = np.argsort(codes[theirs], kind="stable")
        posted, holder = codes[theirs][order], row[theirs][order]
        asked, asker = codes[ours], row[ours]
        begin = np.searchsorted(posted, asked, "left")
        times = np.searchsorted(posted, asked, "right") - begin
        before = np.cumsum(times) - times
        # Whole sets, until some million meetings are to be counted.
        starts = np.flatnonzero(np.diff(asker, prepend=-1))
        cuts, at = [0], 0
        found, told, number = [], 0, 0
        while starts.size and at < len(starts):
            at = max(at + 1, int(np.searchsorted(before[starts], before[starts[at]] + MEETINGS, "left")))
            cuts.append(int(starts[at]) if at < len(starts) else len(asked))
        for start, end in zip(cuts, cuts[1:]):
            if not times[start:end].sum():
                continue
            which = np.repeat(np.arange(start, end), times[start:end])
            other = holder[begin[which] + np.arange(len(which)) + before[start] - before[which]]
            this = asker[which]
            sizes = n[this], n[other]
            keep = np.minimum(*sizes) >= np.ceil(threshold * np.maximum(*sizes) - _EPS)
            if same:
                keep &= sid[this] < sid[other]
            pairs, shared = np.unique(this[keep] * len(batch) + other[keep], return_counts=True)
            this, other = np.divmod(pairs, len(batch))
            enough = shared >= np.minimum(least[this], least[other])
            found.append((this[enough], other[enough]))
            told += int(enough.sum())
            if told > MEETINGS:
                yield from tell(batch, sid, found, number)
                found, told, number = [], 0, number + len(batch)
        if told:
            yield from tell(batch, sid, found, number)

    def tell(batch: pa.RecordBatch, sid: np.ndarray, found: list, number: int) -> Iterator[pa.RecordBatch]:
        x, y = (np.concatenate(side) for side in zip(*found))
        part = parts(len(sid), x, y, number)
        tile = [pa.array(np.full(len(x), batch.column(i)[0].as_py(), np.int32)) for i in range(2)]
        ends = [np.minimum(sid[x], sid[y]), np.maximum(sid[x], sid[y])]
        yield pa.RecordBatch.from_arrays([*tile, *map(pa.array, [part, *ends])], names=["_i", "_j", "_part", "a", "b"])

    return _by_tile(meet, 2)


def _score_parts(threshold: float) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow``: the sets and pairs of each part in, the similar pairs with the sets' other columns out."""

    def meet(table: pa.Table) -> Iterator[pa.RecordBatch]:
        batch = table.combine_chunks().to_batches()[0]
        sid, other = batch.column(3).to_numpy(zero_copy_only=False), batch.column(4)
        asked = other.is_valid().to_numpy(zero_copy_only=False)
        held = np.flatnonzero(~asked)
        held = held[np.argsort(sid[held], kind="stable")]
        places = pa.array(held)
        elements = batch.column(len(batch.schema) - 1).take(places)
        carried = [batch.column(i).take(places) for i in range(5, len(batch.schema) - 1)]
        names = batch.schema.names[5:-1]
        # Numbers stand for the elements themselves: two are equal if and only if their elements are.
        code = pc.dictionary_encode(elements.flatten(), null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = elements.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        first, values = np.cumsum(n) - n, int(code.max(initial=0)) + 1
        x = np.searchsorted(sid[held], sid[asked])
        y = np.searchsorted(sid[held], other.filter(pa.array(asked)).to_numpy(zero_copy_only=False))
        work = np.cumsum(n[x] + n[y])
        cuts = np.unique([0, *np.searchsorted(work, np.arange(MEETINGS, work[-1] if len(work) else 0, MEETINGS)), len(x)])
        for start, end in zip(cuts, cuts[1:]):
            keys = []
            for side in (x[start:end], y[start:end]):
                pair = np.repeat(np.arange(len(side)), n[side])
                at = np.arange(len(pair)) - np.repeat(np.cumsum(n[side]) - n[side], n[side])
                keys.append(pair * values + code[first[side][pair] + at])
            both = np.sort(np.concatenate(keys))
            twice = both[1:][both[1:] == both[:-1]]
            shared = np.bincount(twice // values, minlength=end - start)
            similarity = shared / (n[x[start:end]] + n[y[start:end]] - shared)
            keep = np.flatnonzero(similarity >= threshold)
            for k in range(0, len(keep), TOLD):
                some = keep[k : k + TOLD]
                sides = [c.take(pa.array(ends[start + some])) for ends in (x, y) for c in carried]
                yield pa.RecordBatch.from_arrays(
                    [*sides, pa.array(similarity[some])], names=[*[f"{c}_{s}" for s in "lr" for c in names], "similarity"]
                )

    return _by_tile(meet, 3)


def _similar_tokens(sets: DataFrame, threshold: float, block_rows: int, carried: Sequence[str]) -> DataFrame:
    """Elements are arbitrary tokens and sets may be long: only row numbers and hashes of rare elements meet.

    Tokens meet by a hash: a collision can only add a candidate, which the exact comparison rejects. The order from rare to
    frequent comes from a table of bounded size that all tasks hold, so elements stay where they are. Candidates are pairs that share as many
    elements of their prefixes as similar ones must (``_least``). Prefixes are sent to pairs of blocks of like sizes, and what a pair
    shares is counted where its blocks meet; only the pairs that share enough leave the task. They are scored on whole sets in parts of
    pairs that hang together.
    """
    n, least = F.col("n"), _least(threshold, F.col("n"))
    session = sets.sparkSession
    spread = int(session.conf.get("spark.sql.shuffle.partitions"))
    counts = {r["n"]: r["count"] for r in sets.groupBy("n").count().collect()}
    # Small tables are cut finer, so that all tasks have some blocks.
    rows = max(1, min(16 * block_rows, -(-sum(counts.values()) // max(1, int((4 * spread) ** 0.5)))))
    sent = sets.select(
        "sid",
        "n",
        (n - _needed(threshold, n) + least).alias("length"),
        least.alias("least"),
        F.transform("elements", lambda e: F.xxhash64(e)).alias("codes"),
    )
    found = _rarest(session.sparkContext.broadcast(_rarity(sets)), _size_blocks(counts, threshold, rows))
    schema = "sid bigint, n int, least int, _own int, _from int, _to int, codes array<int>"
    prefixes = materialize(sent.mapInArrow(found, schema), "prefixes")
    own, other = F.col("_own"), F.col("_other")
    dealt = prefixes.where(F.size("codes") > 0).withColumn("_other", F.explode(F.sequence("_from", "_to")))
    tiles = dealt.select(
        F.least(own, other).alias("_i"),
        F.greatest(own, other).alias("_j"),
        (own <= other).alias("_left"),
        (own >= other).alias("_right"),
        "sid",
        "n",
        "least",
        "codes",
    )
    tiles = tiles.repartition(spread, "_i", "_j").sortWithinPartitions("_i", "_j")
    found = tiles.mapInArrow(_share_enough(threshold), "_i int, _j int, _part bigint, a bigint, b bigint")
    candidates = materialize(found, "candidates")
    # A set is sent once to each part that asks for it, however many pairs it is in.
    part = ["_i", "_j", "_part"]
    asked = candidates.select(*part, F.explode(F.array("a", "b")).alias("sid")).distinct()
    held = asked.join(sets.select("sid", "cls", *carried, "elements"), "sid")
    held = held.select(*part, "sid", F.lit(None).cast("bigint").alias("_other"), "cls", *carried, "elements")
    empty = [F.lit(None).cast(held.schema[c].dataType).alias(c) for c in ("cls", *carried, "elements")]
    pairs = candidates.select(*part, F.col("a").alias("sid"), F.col("b").alias("_other"), *empty)
    dealt = held.union(pairs).repartition(spread, *part).sortWithinPartitions(*part)
    sides = [StructField(f"{c}_{s}", sets.schema[c].dataType) for s in "lr" for c in ("cls", *carried)]
    scored = dealt.mapInArrow(_score_parts(threshold), StructType([*sides, StructField("similarity", DoubleType())]))
    return _ordered(scored, F.col("similarity"), carried)


def similar_classes(
    sets: DataFrame,
    threshold: float,
    universe: int | None = None,
    block_rows: int = BLOCK_ROWS,
    carried: Sequence[str] = (),
) -> DataFrame:
    """(cls_a, cls_b, similarity) for all pairs of distinct sets with T >= threshold, each pair once.

    ``sets`` comes from ``distinct_sets``. ``universe`` is the bit width when elements are
    0-based bit numbers below it. Columns ``carried`` of both sets come along, with suffixes ``_a`` and ``_b``.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]: at 0 every pair of the table would qualify")
    if universe is None:
        return _similar_tokens(sets, threshold, block_rows, carried)
    return _similar_bits(sets, threshold, universe, block_rows, carried)


def class_pairs(df: DataFrame, elements: str, threshold: float, universe: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``similar_classes`` plus the pair of every class with itself (similarity 1)."""
    sets = distinct_sets(df, elements, universe)
    own = sets.select(F.col("cls").alias("cls_a"), F.col("cls").alias("cls_b"), F.lit(1.0).alias("similarity"))
    return similar_classes(sets, threshold, universe, block_rows).unionByName(own)


def group_pairs(
    df: DataFrame,
    elements: str,
    threshold: float,
    members: DataFrame,
    group: str,
    value: str,
    min_delta: float,
    universe: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``class_pairs`` by group: (group, cls_a, cls_b, similarity) where members' values lie ``min_delta`` apart in it.

    ``members`` holds group, ``cls`` and value. Every class carries the range of its values in each of its groups through the
    join (as many entries as it has groups), so pairs of classes are not joined to their groups to find that nothing qualifies.
    """
    usable = members.where(F.col(group).isNotNull()).groupBy("cls", group).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    entry = F.struct(F.col(group).alias("key"), F.struct("lo", "hi").alias("value"))
    ranges = usable.groupBy("cls").agg(F.map_from_entries(F.collect_list(entry)).alias("_in"))
    sets = distinct_sets(df, elements, universe, ranges)
    own = [F.col(c).alias(f"{c}_{s}") for s in ("a", "b") for c in ("cls", "_in")]
    met = similar_classes(sets, threshold, universe, block_rows, ["_in"]).unionByName(
        sets.select(*own, F.lit(1.0).alias("similarity"))
    )
    here = met.select("cls_a", "cls_b", "similarity", "_in_b", F.explode("_in_a").alias(group, "_a"))
    both = here.withColumn("_b", F.try_element_at("_in_b", F.col(group))).where("_b is not null").drop("_in_b")
    return both.where(_apart(min_delta, "_a", "_b")).select(group, "cls_a", "cls_b", "similarity")


def _apart(min_delta: float, a: str, b: str) -> Column:
    """Whether two ranges of values hold some that are at least ``min_delta`` apart."""
    return (F.col(f"{a}.hi") - F.col(f"{b}.lo") >= min_delta) | (F.col(f"{b}.hi") - F.col(f"{a}.lo") >= min_delta)


def _member_blocks(members: DataFrame, group: str, key: str, value: str, min_delta: float, block_rows: int) -> DataFrame:
    """(group, cls, _band, _block, _in, _rows): arrays of at most about ``TOGETHER`` members of a class and a band of values."""
    if min_delta < 0:
        raise ValueError("min_delta must not be negative")
    together = min(block_rows, TOGETHER)
    band = F.floor(F.col(value) / F.lit(min_delta / 2.0)) if min_delta > 0 else F.lit(0)
    banded = materialize(members.where(F.col(group).isNotNull()).withColumn("_band", band.cast("bigint")), "members")
    place = [group, "cls", "_band"]
    # Only bands of more than one array are joined to the members: at most rows / ``together`` of them.
    hot = banded.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / F.lit(together)).cast("int").alias("_blocks")).where("_blocks > 1")
    attributes = [c for c in members.columns if c not in (group, "cls", key)]
    blocked = (
        banded.join(hot, place, "left")
        .withColumn("_block", F.pmod(F.xxhash64(key), F.coalesce("_blocks", F.lit(1))).cast("int"))
        .groupBy(*place, "_block")
        .agg(
            F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("_in"),
            F.collect_list(F.struct(key, *attributes)).alias("_rows"),
        )
    )
    return materialize(blocked, "blocks")


def cliffs_of_pairs(
    members: DataFrame,
    pairs: DataFrame,
    group: str,
    key: str,
    value: str,
    min_delta: float,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of members of one group, similar by ``pairs``, whose values differ by >= min_delta.

    ``members`` holds group, ``cls``, key, value and any attributes; ``pairs`` comes from ``class_pairs`` or, by group, from
    ``group_pairs``. Values are banded by
    half the floor: a qualifying pair always lies in different bands, so copies with close
    values never meet. What does meet are arrays of at most about ``TOGETHER`` members of a (group, class, band), and of
    those only such whose ranges of values allow the gap.

    Result: group, similarity, ``a`` and ``b`` (structs of the other member columns, the
    key first, a.key < b.key) and ``delta`` (unrounded).
    """
    blocked = _member_blocks(members, group, key, value, min_delta, block_rows)

    def side(s: str) -> DataFrame:
        return blocked.select(group, *[F.col(c).alias(f"{c}_{s}") for c in ("cls", "_band", "_block", "_in", "_rows")])

    by = [group] if group in pairs.columns else []
    distinct_classes = F.col("cls_a") != F.col("cls_b")
    once = F.col("_band_a") < F.col("_band_b") if min_delta > 0 else F.col("_block_a") <= F.col("_block_b")
    met = (
        pairs.join(side("a"), [*by, "cls_a"])
        .join(side("b"), [group, "cls_b"])
        .where((distinct_classes | once) & _apart(min_delta, "_in_a", "_in_b"))
        .withColumn("a", F.explode("_rows_a"))
        .withColumn("b", F.explode("_rows_b"))
    )
    if min_delta == 0:
        met = met.where(distinct_classes | (F.col("_block_a") < F.col("_block_b")) | (F.col(f"a.{key}") < F.col(f"b.{key}")))
    return _cliffs(met, group, value, min_delta)


def _meet_in_tiles(threshold: float, min_delta: float, width: int, value: str) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow``: entries of tile pairs in, pairs of their members out that are similar and far enough apart in value.

    Common bits of a few entries with a tile are one matrix product, as exact as the bits are few; entries are sorted by
    value, so those too close are not multiplied.
    """
    share = threshold / (1.0 + threshold)

    def meet(table: pa.Table) -> Iterator[pa.RecordBatch]:
        batch = table.combine_chunks().to_batches()[0]
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        words = column["words"].flatten().to_numpy(zero_copy_only=False)
        bits = np.unpackbits(words.view(np.uint8)).reshape(len(batch), -1).astype(np.float32)
        n = column["n"].to_numpy(zero_copy_only=False).astype(np.float64)
        rows, count = column["_rows"].flatten(), column["_rows"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(count) - count
        values = rows.field(value).to_numpy(zero_copy_only=False).astype(np.float64)
        # A value that is not a number rules nothing out here.
        lo = np.nan_to_num(column["lo"].to_numpy(zero_copy_only=False), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        hi = np.nan_to_num(column["hi"].to_numpy(zero_copy_only=False), nan=np.inf, posinf=np.inf, neginf=-np.inf)
        finite = np.concatenate([lo[np.isfinite(lo)], hi[np.isfinite(hi)], [0.0]])
        gap = min_delta - 1e-12 * np.abs(finite).max()
        one, less = np.ones((len(batch), 1), np.float32), (-share * n)[:, None].astype(np.float32)
        ours, theirs = np.hstack([bits, less, one]), np.hstack([bits, one, less])
        order = np.argsort(lo, kind="stable")
        same = column["_i"][0] == column["_j"][0]
        left = order[column["_left"].to_numpy(zero_copy_only=False)[order]]
        right = order[column["_right"].to_numpy(zero_copy_only=False)[order]]
        lo_r, most = lo[right], np.maximum.accumulate(hi[right])
        for at in range(0, len(left), STRIP):
            a = left[at : at + STRIP]
            head = np.searchsorted(lo_r, hi[a].max() - gap, "right")
            tail = np.searchsorted(most, lo[a].min() + gap, "left")
            begin = at if same else 0
            place = np.concatenate([np.arange(begin, max(head, begin)), np.arange(max(head, tail, begin), len(right))])
            if not len(place):
                continue
            b = right[place]
            over = ours[a] @ theirs[b].T
            x, y = np.nonzero(over >= -0.01 - 1e-6 * width)
            both = n[a[x]] + n[b[y]]
            shared = np.rint(over[x, y] + share * both)
            with np.errstate(invalid="ignore"):
                apart = (hi[a[x]] - lo[b[y]] >= gap) | (hi[b[y]] - lo[a[x]] >= gap)
            keep = apart & (shared / (both - shared) >= threshold)
            if same:
                keep &= (place[y] > at + x) | ((place[y] == at + x) & (min_delta == 0))
            similarity = (shared / (both - shared))[keep]
            x, y = a[x[keep]], b[y[keep]]
            if not len(x):
                continue
            times = count[x] * count[y]
            before = np.cumsum(times) - times
            # Every member of an entry with every one of the other, some thousand pairs at a time.
            cuts = np.unique([0, *np.searchsorted(before, np.arange(TOLD, before[-1], TOLD)), len(x)])
            for start, end in zip(cuts, cuts[1:]):
                pair = np.repeat(np.arange(start, end), times[start:end])
                nth = np.arange(len(pair)) + before[start] - before[pair]
                ia = first[x[pair]] + nth // count[y[pair]]
                ib = first[y[pair]] + nth % count[y[pair]]
                far = ~(np.abs(values[ia] - values[ib]) < gap)
                pair, ia, ib = pair[far], pa.array(ia[far]), pa.array(ib[far])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(x[pair])),
                        pa.array(similarity[pair]),
                        pa.array(x[pair] == y[pair]),
                        rows.take(ia),
                        rows.take(ib),
                    ],
                    names=[batch.schema.names[0], "similarity", "_own", "a", "b"],
                )

    return _by_tile(meet, 3)


def cliffs_in_tiles(
    members: DataFrame,
    sets: DataFrame,
    threshold: float,
    width: int,
    group: str,
    key: str,
    value: str,
    min_delta: float,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The result of ``cliffs_of_pairs`` over ``class_pairs`` for sets of bits whose prefixes rule out little.

    Arrays of a few members of a group, class and band of values meet all others of their group, in tiles of about
    4 * ``block_rows`` members that are dealt by hash; a task holds two tiles. Pairs of members of one group are quadratic, but no
    pairs of other groups and few of close values are scored. ``sets`` comes from ``distinct_sets`` with ``width``.
    """
    blocked = _member_blocks(members.where(F.col(value).isNotNull()), group, key, value, min_delta, block_rows)
    tiles = F.ceil(F.sum(F.size("_rows")) / F.lit(4 * block_rows)).cast("int")
    entries = blocked.join(sets.select("cls", "n", "words"), "cls").join(blocked.groupBy(group).agg(tiles.alias("_tiles")), group)
    own, other = F.col("_own"), F.col("_other")
    dealt = entries.withColumn("_own", F.pmod(F.xxhash64("cls", "_band", "_block"), F.col("_tiles")).cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    )
    sent = dealt.select(
        group,
        F.least(own, other).alias("_i"),
        F.greatest(own, other).alias("_j"),
        (own <= other).alias("_left"),
        (own >= other).alias("_right"),
        "n",
        F.col("_in.lo").cast("double").alias("lo"),
        F.col("_in.hi").cast("double").alias("hi"),
        "words",
        "_rows",
    )
    spread = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = sent.repartition(spread, group, "_i", "_j").sortWithinPartitions(group, "_i", "_j")
    member = blocked.schema["_rows"].dataType.elementType
    schema = StructType(
        [
            StructField(group, blocked.schema[group].dataType),
            StructField("similarity", DoubleType()),
            StructField("_own", BooleanType()),
            StructField("a", member),
            StructField("b", member),
        ]
    )
    met = sent.mapInArrow(_meet_in_tiles(threshold, min_delta, width, value), schema)
    met = met.where(~F.col("_own") | (F.col(f"a.{key}") < F.col(f"b.{key}")))
    return _cliffs(met, group, value, min_delta)


def _cliffs(met: DataFrame, group: str, value: str, min_delta: float) -> DataFrame:
    delta = F.abs(F.col(f"a.{value}") - F.col(f"b.{value}"))
    return met.where(delta >= min_delta).select(
        group,
        "similarity",
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        delta.alias("delta"),
    )


def nearest_neighbors_all(
    df: DataFrame,
    key: str,
    elements: str,
    k: int,
    min_sim: float,
    universe: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(key, neighbor, similarity, rank): the k most similar others of every entity.

    Members of one class are equally similar to a query, and ties go to the smaller key:
    only the k + 1 smallest keys of a class can appear in any answer (one may be the query
    itself). Ranking per class over these shortlists is exact and does not grow with the
    number of copies; the output is at most k rows per entity.
    """
    # Written once: the sets would be computed anew for every use.
    entities = materialize(df.where(F.size(elements) > 0).select(F.col(key), set_class(elements).alias("cls")), "entities")
    sets = distinct_sets(df, elements, universe)
    by_key = Window.partitionBy("cls").orderBy(key)
    shortlist = (
        entities.withColumn("_rn", F.row_number().over(by_key))
        .where(F.col("_rn") <= k + 1)
        .select(F.col("cls").alias("cls_b"), F.col(key).alias("neighbor"))
    )
    pairs = similar_classes(sets, min_sim, universe, block_rows)
    # Both directions from one run of the join.
    there = F.struct("cls_a", "cls_b", "similarity")
    back = F.struct(F.col("cls_b").alias("cls_a"), F.col("cls_a").alias("cls_b"), "similarity")
    directed = pairs.select(F.explode(F.array(there, back)).alias("p")).select("p.*")
    own = sets.select(F.col("cls").alias("cls_a"), F.col("cls").alias("cls_b"), F.lit(1.0).alias("similarity"))
    near = Window.partitionBy("cls_a").orderBy(F.desc("similarity"), "neighbor")
    ranked = (
        directed.unionByName(own)
        .join(shortlist, "cls_b")
        .withColumn("_rn", F.row_number().over(near))
        .where(F.col("_rn") <= k + 1)
        .select(F.col("cls_a").alias("cls"), "neighbor", "similarity")
    )
    # Written, so that a class of very many copies is a plain exchange on both sides, which AQE can split.
    ranked = materialize(ranked, "ranked")
    per_entity = Window.partitionBy(key).orderBy(F.desc("similarity"), "neighbor")
    return (
        entities.join(ranked, "cls")
        .where(F.col(key) != F.col("neighbor"))
        .withColumn("rank", F.row_number().over(per_entity))
        .where(F.col("rank") <= k)
        .select(key, "neighbor", "similarity", "rank")
    )


def set_signature(elements: str) -> list[Column]:
    """Four 64-bit words with a bit for each element of a set: a subset's bits are among them."""
    place = "xxhash64(e) & 255"
    return [
        F.expr(
            f"aggregate({elements}, 0L, (a, e) -> a | if(({place}) div 64 = {w}, shiftleft(1L, cast(({place}) % 64 as int)), 0L))"
        ).alias(f"_s{w}")
        for w in range(4)
    ]


def containing_sets(
    df: DataFrame,
    key: str,
    elements: str,
    queries: DataFrame,
    query_key: str,
    query_elements: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query, entity) pairs where the entity's set contains the query's whole set.

    A query meets the entities that hold its rarest element, and of them those that also hold the second rarest one and
    whose 256-bit signature holds the query's; only these are compared by their whole sets. The postings of
    an element that more than ``block_rows`` entities hold are cut into blocks, which each of its queries visits. Postings of
    elements that are no query's rarest are not shuffled. An element missing from the data ends the query, and so does a
    NULL one; an empty query is contained in nothing here: it would select the entire table.
    """
    own = queries.where(F.size(query_elements) > 0)
    wanted = own.select(F.col(query_key), F.explode(F.array_distinct(query_elements)).alias("element"))
    asked = materialize(wanted.select("element").distinct(), "asked")
    # Only elements of queries are counted and posted.
    posted = df.select(F.col(key), F.explode(F.array_distinct(elements)).alias("element")).join(asked, "element", "left_semi")
    counts = materialize(posted.groupBy("element").agg(F.count(F.lit(1)).alias("_f")), "counts")
    frequency = wanted.join(counts, "element", "left").select(query_key, F.struct(F.coalesce("_f", F.lit(0)).alias("f"), "element").alias("_e"))
    first = frequency.groupBy(query_key).agg(F.min("_e").alias("_first")).where("_first.f > 0")
    rest = frequency.join(first, query_key).where(F.col("_e") != F.col("_first"))
    second = rest.groupBy(query_key).agg(F.min("_e").alias("_2"))
    signed = own.select(F.col(query_key), F.col(query_elements).alias("_query")).select(query_key, *set_signature("_query"))
    last = F.floor(F.col("_first.f") / block_rows).cast("int")
    probes = (
        signed.join(first, query_key)
        .join(second.select(query_key, F.col("_2.element").alias("_second")), query_key, "left")
        .select("*", F.col("_first.element").alias("element"), F.explode(F.sequence(F.lit(0), last)).alias("_block"))
        .drop("_first")
    )
    probes = materialize(probes, "probes")
    blocks = F.floor(F.col("_f") / block_rows).cast("bigint") + 1
    cut = probes.select("element").distinct().join(counts, "element").select("element", blocks.alias("_blocks"))
    named = [c.alias(f"_e{w}") for w, c in enumerate(set_signature(elements))]
    # Signed before the sets are taken apart: what stands beside an explode is evaluated for each of its rows.
    held = df.select(F.col(key), F.array_distinct(elements).alias("_have"), *named)
    postings = held.select(key, *[f"_e{w}" for w in range(4)], F.explode("_have").alias("element")).join(cut, "element")
    postings = postings.withColumn("_block", F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int"))
    met = postings.join(probes, ["element", "_block"])
    for w in range(4):
        met = met.where(F.col(f"_e{w}").bitwiseAND(F.col(f"_s{w}")) == F.col(f"_s{w}"))
    hits = met.select(query_key, key, "_second")
    both = hits.where("_second is not null").join(posted.withColumnRenamed("element", "_second"), [key, "_second"], "left_semi")
    hits = hits.where("_second is null").select(query_key, key).union(both.select(query_key, key))
    whole = df.select(key, F.col(elements).alias("_have"))
    compared = hits.join(own.select(query_key, F.col(query_elements).alias("_query")), query_key).join(whole, key)
    return compared.where(F.size(F.array_except("_query", "_have")) == 0).select(query_key, key)
