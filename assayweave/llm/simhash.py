"""SimHash near-duplicates by a binary trie self-join.

Every text gets a 64-bit fingerprint. Distinct fingerprints are linked when they differ in few bits, and
links are closed into components. The self-join walks pairs of trie nodes from the top, adds up the bits
in which their paths differ and drops a pair as soon as the budget is exceeded.

Spreading the trie over tasks: a budget of ``k`` differing bits leaves at least one of ``k + 1`` blocks of
bits untouched. So the trie is read in ``k + 1`` bit orders, each beginning with another block, and a
subtrie below one value of the first block is a unit of work. A subtrie with more than ``most`` leaves is
cut again in the same way by its remaining bits, until every unit is small; no leaf is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import connected_components, tasks_for, whole_groups

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLOCK = 1 << 16
_FRONTIER = 1 << 20
Connect = Callable[[pd.DataFrame, np.ndarray, np.ndarray, int], Iterator[pd.DataFrame]]


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each ``width``-word shingle of the text with A-Z lower-cased, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if len(words) > width:
        shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    else:
        shingles = [b" ".join(words)] if words else []
    return np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64, len(shingles))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes; 0 without hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``fp`` bigint) for every row; a NULL or wordless text has fingerprint 0. Rows stay where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            fps = [fingerprint(shingle_hashes(t.as_py(), width)) for t in texts]
            yield pa.RecordBatch.from_arrays([ids, pa.array(fps, pa.int64())], ["id", "fp"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "id bigint, fp bigint").withColumnRenamed("id", id_col)


def _bit(values: np.ndarray, bit: int) -> np.ndarray:
    return ((values >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)


def trie_pairs(groups: np.ndarray, rest: np.ndarray, bits: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of leaves of one group whose ``rest`` differ in at most ``budget`` of ``bits`` bits, in parts.

    Leaves are sorted by (group, rest). A node is a range of leaves with a common path; the walk starts with
    every group paired with itself and goes down a level at a time. Surviving node pairs are kept in slices, so
    memory stays bounded. Leaves that are equal in ``rest`` are paired as well.
    """
    n = len(rest)
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if n else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], n] if n else starts
    wide = ends - starts > 1
    zero = np.zeros(int(wide.sum()), np.int8)
    # A pair of nodes: leaves [al, ah) and [bl, bh), and the differing bits of their paths so far.
    stack = [(bits, starts[wide], ends[wide], starts[wide], ends[wide], zero)]
    ones: dict[int, np.ndarray] = {}
    while stack:
        level, al, ah, bl, bh, errors = stack.pop()
        if not len(al):
            continue
        if len(al) > _FRONTIER:
            for at in range(0, len(al), _FRONTIER):
                cut = slice(at, at + _FRONTIER)
                stack.append((level, al[cut], ah[cut], bl[cut], bh[cut], errors[cut]))
            continue
        single = (ah - al == 1) & (bh - bl == 1)
        if single.any():  # two leaves: their remaining bits at once
            a, b = al[single], bl[single]
            near = (np.bitwise_count(rest[a] ^ rest[b]) <= budget) & (a != b)
            if near.any():
                yield a[near], b[near]
            al, ah, bl, bh, errors = (x[~single] for x in (al, ah, bl, bh, errors))
        if not len(al):
            continue
        if level == 0:  # several leaves with one path
            for x0, x1, y0, y1 in zip(al.tolist(), ah.tolist(), bl.tolist(), bh.tolist()):
                for a in range(x0, x1):
                    b = np.arange(a + 1 if x0 == y0 else y0, y1)
                    if len(b):
                        yield np.full(len(b), a), b
            continue
        bit = level - 1
        if bit not in ones:
            ones[bit] = np.r_[0, np.cumsum(_bit(rest, bit))]
        c = ones[bit]
        am, bm = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl])
        same = al == bl
        children = (
            (al, am, bl, bm, errors, None),
            (am, ah, bm, bh, errors, None),
            (al, am, bm, bh, errors + 1, None),
            (am, ah, bl, bm, errors + 1, ~same),  # for a node with itself it repeats the one before
        )
        parts = []
        for x0, x1, y0, y1, e, only in children:
            keep = (x1 > x0) & (y1 > y0) & (e <= budget) & ~((x0 == y0) & (x1 - x0 == 1))
            keep = keep & only if only is not None else keep
            parts.append([v[keep].astype(v.dtype) for v in (x0, x1, y0, y1, e)])
        stack.append((bit, *(np.concatenate(cols) for cols in zip(*parts))))


def trie_links(groups: np.ndarray, rest: np.ndarray, bits: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) that connect the leaves paired by ``trie_pairs``: each leaf with the first of its component."""
    label = np.arange(len(rest))
    for a, b in trie_pairs(groups, rest, bits, budget):
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            low, high = np.minimum(la, lb)[apart], np.maximum(la, lb)[apart]
            np.minimum.at(label, high, low)
            while True:  # every leaf to the root of its tree
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up
            a, b = a[apart], b[apart]
    joined = np.flatnonzero(label != np.arange(len(rest)))
    return label[joined], joined


def _blocks(bits: int, parts: int) -> list[tuple[int, int]]:
    """(lowest bit, size) of each block, from the top."""
    sizes = [bits // parts + (i < bits % parts) for i in range(parts)]
    lows, at = [], bits
    for s in sizes:
        at -= s
        lows.append((at, s))
    return lows


def _route(rows: DataFrame, bits: int, parts: int) -> DataFrame:
    """Each row once per block: the group takes in the block's value, ``rest`` loses its bits."""
    blocks = _blocks(bits, parts)
    widest = max(size for _, size in blocks)
    tag = (parts - 1).bit_length()
    options = []
    for i, (low, size) in enumerate(blocks):
        value = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << size) - 1))
        below = F.col("rest").bitwiseAND(F.lit((1 << low) - 1))
        above = F.shiftrightunsigned("rest", low + size) if low + size < 64 else F.lit(0).cast("bigint")
        if low + size < bits:
            above = above.bitwiseAND(F.lit((1 << (bits - low - size)) - 1))
        name = F.shiftleft(F.shiftleft("grp", tag) + F.lit(i), widest) + value
        # blocks of one cut may differ by a bit in size; short ones keep a zero bit so that all rests align
        options.append(F.struct(name.alias("grp"), (F.shiftleft(above, low) + below).alias("rest")))
    carried = [c for c in rows.columns if c not in ("grp", "rest")]
    return rows.select(*carried, F.explode(F.array(*options)).alias("o")).select(*carried, "o.grp", "o.rest")


def trie_join(rows: DataFrame, bits: int, budget: int, most: int, connect: Connect, schema: str) -> DataFrame:
    """Walk the tries of ``rows`` (grp, rest: ``bits`` bits, more): ``connect`` gets whole groups, sorted, as a frame.

    The tries are dealt to tasks as the module says; ``most`` bounds the leaves of a group, as long as over 16
    bits are left to cut.
    """
    parts, found = budget + 1, None
    tasks = tasks_for(rows)
    while True:
        routed, bits = _route(rows, bits, parts), bits - bits // parts
        hot = None
        if bits > 16:
            sizes = routed.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("grp")
            hot = materialize(sizes, "hot")
            if hot.isEmpty():
                hot = None
        now = routed if hot is None else routed.join(hot, "grp", "left_anti")

        def walk(batches: Iterator[pd.DataFrame], left: int = bits) -> Iterator[pd.DataFrame]:
            for batch in whole_groups(batches, "grp"):
                rest = batch["rest"].to_numpy(np.int64).astype(np.uint64)
                yield from connect(batch, batch["grp"].to_numpy(np.int64), rest, left)

        pairs = now.repartition(tasks, "grp").sortWithinPartitions("grp", "rest").mapInPandas(walk, schema)
        found = pairs if found is None else found.union(pairs)
        if hot is None:
            return found
        rows = materialize(routed.join(hot, "grp", "left_semi"), "subtries")


def links(distinct_fps: DataFrame, budget: int = 3, most: int = 1 << 16) -> DataFrame:
    """Links (a, b) that join distinct fingerprints (``fp`` bigint) with at most ``budget`` differing bits.

    Linked fingerprints are connected by the result, not every pair is listed. ``most`` bounds a unit of work.
    """

    def connect(batch: pd.DataFrame, groups: np.ndarray, rest: np.ndarray, left: int) -> Iterator[pd.DataFrame]:
        fps = batch["fp"].to_numpy(np.int64)
        a, b = trie_links(groups, rest, left, budget)
        yield pd.DataFrame({"a": fps[a], "b": fps[b]})

    rows = distinct_fps.select("fp", F.lit(0).cast("bigint").alias("grp"), F.col("fp").alias("rest"))
    return trie_join(rows, 64, budget, most, connect, "a bigint, b bigint")


def components(fps: DataFrame, budget: int = 3, id_col: str = "doc_id", most: int = 1 << 16) -> DataFrame:
    """(id, fp, ``component_id``): the smallest id reachable over links; one row per input row.

    ``fps`` (id, fp) is read several times, so give it written. Rows with equal ids or fingerprints stay
    apart rows. NULL ids never name a component; a component of NULL ids only has a NULL name.
    """
    nodes = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    nodes = materialize(nodes, "fingerprints")
    labels = connected_components(links(nodes.select("fp"), budget, most)).withColumnRenamed("node", "fp")
    named = nodes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    roots = named.groupBy("label").agg(F.min("least").alias("component_id"))
    # Written, so that AQE sees plain exchanges on both sides below and can split a hot fingerprint.
    of = materialize(named.join(roots, "label").select("fp", "component_id"), "components")
    return fps.join(of, "fp").select(id_col, "fp", "component_id")


def near_duplicates(docs: DataFrame, width: int = 3, budget: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable).

    NULL, empty and wordless texts share fingerprint zero and are linked like any other. Repeated rows give
    repeated rows. Texts are read once, whole; further columns of the input are ignored.
    """
    fps = materialize(fingerprints(docs, width, id_col, text_col), "simhash")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return components(fps, budget, id_col).select(id_col, hexed, "component_id")


def deduplicate(docs: DataFrame, width: int = 3, budget: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of linked documents, with all columns of ``docs``.

    Of a group the smallest id stays; NULL ids come last, and of rows that share the id the one read first stays. NULL,
    empty and wordless texts are one group. Rows are numbered in a written copy, so that repeated rows stay apart and
    a lost task finds the same numbers.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("number"), row), "numbered")
    texts = rows.select("number", F.col(f"row.`{text_col}`").alias("text"))
    fps = materialize(fingerprints(texts, width, "number"), "simhash")
    ids = rows.select("number", F.col(f"row.`{id_col}`").alias("id"))
    of = components(fps, budget, "number").join(ids, "number")
    first = of.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "number")).alias("first"))
    return rows.join(first.select("first.number"), "number", "left_semi").select("row.*")
