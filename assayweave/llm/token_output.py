"""Token ids of a document table in files, coded by an adaptive context-mixing range coder.

The files are Parquet with one row per segment: a run of documents in ascending doc_id with about
``SEGMENT`` ids, their ids and lengths, the dictionary of the segment and its coded blocks (see
``rangecoder``). Blocks are reset and checksummed one by one, so any of them decodes alone. A segment belongs to
a range of doc_ids and knows the ids before it in its range.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rangecoder
from .common import FIRST_KEY, range_bounds, range_number, tasks_for

SEGMENT = 7_500_000
#: Texts that go to the library whole at once: its encodings are far larger than the ids kept of them.
AT_ONCE = 1000
#: Pieces a worker knows the ids of; when there are more, the half that came most often stays.
KNOWN = 500_000
#: Characters of texts that are taken apart at once, and pieces that the library gets as one text.
CHARACTERS, PIECES_AT_ONCE = 6_000_000, 200
END = 2
#: The pre-tokenizer of byte-level BPE files without a prefix space. Fixed by these files.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A place in a text where a piece begins whatever stands around it.
CUT = re.compile(r"(?= \S)")


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level BPE files: printable bytes for themselves, the others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of texts by the tokenizers library. Equal pieces are encoded once, as long as they are known.

    Byte-level BPE encodes the pieces of a text one by one, so their ids laid end to end are the text's. A piece always begins
    at a blank that something else than white space follows, so texts are cut there first, and only different chunks of a
    batch are taken apart. The library's model is asked for the pieces: for those that begin with such a blank side by side,
    as of their ids just the first of each begins with a blank, and for any other by itself. Texts with an added token, and
    tokenizers of another make, go to the library whole.
    """

    def __init__(self, path: str):
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        pre = made.get("pre_tokenizer") or {}
        byte_level = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self.by_piece = byte_level and not made.get("normalizer") and made["model"]["type"] == "BPE"
        self.added = [t["content"] for t in made.get("added_tokens", [])]
        self.pieces = regex.compile(PIECES)
        self.letters = _byte_letters()
        if self.by_piece:
            self.side_by_side = Tokenizer(self.tokenizer.model)
            self.side_by_side.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            vocab = made["model"]["vocab"]
            self.blank = np.zeros(max([0, *vocab.values(), *(t["id"] for t in made.get("added_tokens", []))]) + 1, bool)
            self.blank[[i for token, i in vocab.items() if token[0] == self.letters[32]]] = True
        self.known: dict[str, int] = {}
        self.ids, self.ends, self.uses = array("I"), array("q", [0]), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the pieces that came most often, for later batches and tasks."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: KNOWN // 2])
        ids, sizes = _runs(np.array(self.ids, np.uint32), np.array(self.ends), kept)
        pieces = list(self.known)
        self.known = {pieces[k]: i for i, k in enumerate(kept.tolist())}
        self.ids, self.ends, self.uses = array("I", ids.tobytes()), array("q", [0, *np.cumsum(sizes).tolist()]), self.uses[kept] >> 1

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for at in range(0, len(texts), AT_ONCE):
            coded = self.tokenizer.encode_batch_fast(texts[at : at + AT_ONCE], add_special_tokens=False)
            out += [np.array(e.ids, np.uint32) for e in coded]
        return out

    def _keep(self, pieces: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.ends.frombytes((ends + len(self.ids)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.astype(np.uint32).tobytes())

    def _learn(self, pieces: list[str]) -> None:
        """Ask for the ids of different pieces that are not known yet."""
        beside = [p for p in pieces if p[0] == " " and not p.isspace()]
        alone = [p for p in pieces if p[0] != " " or p.isspace()]
        letters = {b: c for b, c in self.letters.items() if b != ord("\n")}
        for at in range(0, len(beside), PIECES_AT_ONCE):
            some = beside[at : at + PIECES_AT_ONCE]
            text = "\n".join(some)
            text = text.replace(" ", letters[32]) if text.isascii() else text.encode().decode("latin-1").translate(letters)
            ids = np.array(self.side_by_side.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            begins = np.flatnonzero(self.blank[ids])
            if len(begins) == len(some):
                self._keep(some, ids, np.append(begins[1:], len(ids)))
            else:
                alone += some
        model = self.tokenizer.model
        asked = [[t.id for t in model.tokenize(p.encode().decode("latin-1").translate(self.letters))] for p in alone]
        self._keep(alone, np.array([i for ids in asked for i in ids], np.uint32), np.cumsum([len(ids) for ids in asked], dtype=np.int64))

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        numbers = np.array(list(map(self.known.get, pieces, repeat(-1))), np.int64)
        missing = np.flatnonzero(numbers < 0).tolist()
        new = [pieces[i] for i in missing]
        self._learn(list(dict.fromkeys(new)))
        numbers[missing] = list(map(self.known.__getitem__, new))
        times = np.bincount(numbers, minlength=len(self.known))
        times[: len(self.uses)] += self.uses
        self.uses = times
        return numbers

    def _taken_apart(self, pieces: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that have so many of the pieces each, one after the other, and how many each has."""
        numbers = self._numbers(pieces)
        ids, sizes = _runs(np.array(self.ids, np.uint32), np.array(self.ends), numbers)
        ends = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)].astype(np.int64)]
        return ids, np.diff(ends)

    def _cut(self, chunks: list[str]) -> tuple[list[str], list[int]]:
        """The pieces of the chunks, and how many each has."""
        found = [self.pieces.findall(c) for c in chunks]
        return [p for own in found for p in own], [len(own) for own in found]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self.by_piece and not any(a in t for a in self.added) for t in texts]
        if len(self.known) > KNOWN:
            self._forget()
        parts = pc.split_pattern(pa.array([t if ok else "" for t, ok in zip(texts, plain)], pa.large_string()), " ")
        cuts, values = parts.offsets.to_numpy(), parts.flatten()
        first = values.take(pa.array(cuts[:-1])).dictionary_encode()
        after = values.dictionary_encode()
        words = after.dictionary.to_numpy(zero_copy_only=False)
        # Most are one word, which is a piece, or one with a mark.
        letters = pc.match_substring_regex(after.dictionary, "^[A-Za-z]+$").to_numpy(zero_copy_only=False)
        marked = pc.match_substring_regex(after.dictionary, "^[A-Za-z]+[!,.:;?]$").to_numpy(zero_copy_only=False)
        other = np.flatnonzero(~(letters | marked))
        # A blank that white space or nothing follows is no place to cut: such texts are cut by the pattern.
        loose = np.zeros(len(words), bool)
        loose[other] = [not w or w[0].isspace() for w in words[other].tolist()]
        other = other[~loose[other]]
        found = self.pieces.findall("".join([" " + w for w in words[other].tolist()]))
        begins = np.flatnonzero(pc.starts_with(pa.array(found, pa.large_string()), " ").to_numpy(zero_copy_only=False))
        own, own_counts = self._cut(first.dictionary.to_pylist())
        with_mark = [p for w in words[marked].tolist() for p in (" " + w[:-1], w[-1])]
        pieces = [" " + w for w in words[letters].tolist()] + with_mark + found + own
        placed = np.r_[np.flatnonzero(letters), np.flatnonzero(marked), other]
        simple = np.repeat([1, 2], [len(placed) - len(other) - len(with_mark) // 2, len(with_mark) // 2])
        counts = np.concatenate([simple, np.diff(np.append(begins, len(found))), own_counts, [0]]).astype(np.int64)
        # Where the chunks stand: those of after blanks, first ones, and one without a piece for loose blanks.
        place = np.full(len(words), len(counts) - 1)
        place[placed] = np.arange(len(placed))
        number = after.indices.to_numpy()
        is_loose = loose[number]
        is_loose[cuts[:-1]] = False
        number = place[number]
        number[cuts[:-1]] = len(placed) + first.indices.to_numpy()
        ids, sizes = self._taken_apart(pieces, counts)
        ids, sizes = _runs(ids, np.r_[0, np.cumsum(sizes)], number)
        at = np.r_[0, np.cumsum(sizes)][cuts]
        out = [ids[a:b] for a, b in zip(at, at[1:])]
        for i in np.flatnonzero(np.diff(np.r_[0, np.cumsum(is_loose)][cuts])).tolist():
            cut, counts = self._cut(CUT.split(texts[i]))
            out[i] = self._taken_apart(cut, np.array(counts))[0]
        for i, ok in enumerate(plain):
            if not ok:
                out[i] = self._whole([texts[i]])[0]
        return out


def _runs(ids: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ids[ends[k]:ends[k + 1]] of the numbers k one after the other, and their lengths."""
    sizes = np.diff(ends)[numbers]
    begins = np.cumsum(sizes) - sizes
    shift = np.repeat(ends[numbers] - begins, sizes)
    shift += np.arange(len(shift))
    return ids[shift], sizes


def encoder(path: str) -> Encoder:
    """The tokenizer of a file; a worker process keeps it and the pieces it knows for its next tasks."""
    kept = sys.modules.setdefault("open_tokenizers", types.ModuleType("open_tokenizers")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[str]]]:
    """Parts, keys and texts of rows that have about CHARACTERS together, whatever the batches' borders."""
    held: tuple[list, list, list[str]] = ([], [], [])
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            some = batch.slice(at, 100)
            for column, more in zip(held, some.columns):
                column += more.to_pylist()
            size += sum(map(len, held[2][-some.num_rows :]))
            if size >= CHARACTERS:
                yield held
                held, size = ([], [], []), 0
    if held[0]:
        yield held


SEGMENTS = "part bigint, first bigint, doc_ids array<bigint>, lengths array<bigint>, dictionary array<bigint>, blocks array<binary>"
_NAMES = [c.split()[0] for c in SEGMENTS.split(", ")]
_TYPES = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.binary())]


def segments(docs: DataFrame, tokenizer: str, end: int = END, segment: int = SEGMENT, block: int = rangecoder.BLOCK) -> DataFrame:
    """Coded segments of (doc_id, text); each text's ids are followed by ``end``.

    Texts are shuffled once, to ranges of ids; a task codes its ranges one after the other and holds a segment
    at a time. NULL texts count as empty, NULL ids come first, rows that share an id are ordered by text. An
    empty table has no segments.
    """
    slim = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_KEY)).alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    parts = tasks_for(docs)
    placed = slim.withColumn("part", range_number(F.col("key"), range_bounds(slim, "key", parts)).cast("bigint"))
    dealt = placed.repartition(parts, "part").sortWithinPartitions("part", "key", "text").select("part", "key", "text")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part, first, keys, coded, size = None, 0, [], [], 0
        last = np.array([end], np.uint32)

        def close() -> pa.RecordBatch:
            lengths, ids = [len(c) + 1 for c in coded], np.concatenate([x for c in coded for x in (c, last)])
            coded.clear()
            pa.default_memory_pool().release_unused()
            dictionary, blocks = rangecoder.encode(ids, block)
            row = (part, first, keys, lengths, dictionary.tolist(), blocks)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES)], _NAMES)

        for parts_, keys_, texts in _gathered(batches):
            for p, k, ids in zip(parts_, keys_, encode(texts)):
                if keys and (p != part or size >= segment):
                    yield close()
                    first, keys, coded, size = first + size, [], [], 0
                if p != part:
                    part, first = p, 0
                keys.append(k)
                coded.append(ids)
                size += len(ids) + 1
        if keys:
            yield close()

    return dealt.mapInArrow(code, SEGMENTS)


def write(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    """Write the table's ids; a rerun gives the same files' rows."""
    segments(docs, tokenizer, **options).write.mode("overwrite").parquet(path)


def documents(spark: SparkSession, path: str, block: int = rangecoder.BLOCK) -> DataFrame:
    """(doc_id, start, ids) of every written document; ``start`` counts the ids of all documents before it.

    Every block is decoded and checked; a wrong checksum stops the read.
    """
    return _read(spark, path, block, lambda ids: ids.tolist(), "ids array<bigint>", pa.list_(pa.int64()))


def digests(spark: SparkSession, path: str, block: int = rangecoder.BLOCK) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): as ``documents``, with ids counted and summed up where they are decoded."""

    def crc(ids: np.ndarray) -> int:
        return zlib.crc32(ids.astype("<u4").tobytes())

    return _read(spark, path, block, crc, "ids_crc32 bigint", pa.int64())


def _read(spark: SparkSession, path: str, block: int, value, column: str, kind: pa.DataType) -> DataFrame:
    stored = spark.read.schema(SEGMENTS).parquet(path)
    own = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, n: a + n)
    # One row per range of ids: bounded by the number of partitions that wrote.
    totals = stored.select("part", own.alias("n")).groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before, run = {}, 0
    for r in totals:
        before[r.part], run = run, run + r.n

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, keys, lengths, dictionary, blocks = (c[row].as_py() for c in batch.columns)
                ids = rangecoder.decode(np.array(dictionary, np.uint32), blocks, sum(lengths), block)
                ends = np.cumsum(lengths)
                columns = [
                    pa.array([None if k == FIRST_KEY else k for k in keys], pa.int64()),
                    pa.array(before[part] + first + ends - np.array(lengths), pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([value(ids[e - n : e]) for e, n in zip(ends.tolist(), lengths)], kind),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", column.split()[0]])

    return stored.mapInArrow(decode, f"doc_id bigint, start bigint, n_tokens bigint, {column}")
