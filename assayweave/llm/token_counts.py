"""Token counts of texts by a tokenizer compiled to deterministic finite-state transducers, without tokenizing.

Byte-level BPE works in two steps, and each becomes a transducer:

* The splitter reads classes of characters and marks where pieces begin, one character late. It has few states, so
  a chunk of text has a whole map: for every state at its beginning the state at its end and the pieces begun. The maps
  of all chunks are computed in lockstep and composed by a parallel prefix scan; that gives the state before every
  chunk, and a second pass in lockstep the beginnings of pieces.
* The merger reads a piece's bytes. Merging is regular: the tokens of a text are the only sequence in which every
  neighbouring pair stays unmerged, and the last token of every beginning of the text is settled by the last tokens of
  its own beginnings. A state therefore holds, for each place where a token may still be open, the place in the tree
  of tokens, the last token there and how many tokens it lies back. A transition carries the tokens it emits: the
  change of the count (0 or less where a byte is taken into a longer token). States are compiled when first met and
  kept by the worker; the table is emptied when it holds too many, which costs time only.

All pieces of a batch go through the merger in lockstep; pieces beyond ``LONG`` bytes are read in chunks, whose maps
(entry state to exit state and count) are kept by their bytes, so that repeated content is read once.
"""

from __future__ import annotations

import json
import re
import sys
import types
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnp import BATCH_BYTES, mix, slices

#: Characters in a chunk of the splitter, bytes of a piece in lockstep, bytes merged at once, states kept.
CHUNK = 128
#: After so many characters of a chunk its states have mostly met.
MEET = 24
LONG = 256
AT_ONCE = 500_000
STATES = 400_000

# --- splitter ----------------------------------------------------------------------------

#: Classes of characters. Letters that end a contraction have classes of their own.
CLASSES = ("letter", "stmd", "r", "v", "l", "e", "number", "other", "apostrophe", "blank", "white", "border")
_LETTERS = CLASSES[:6]
#: What has just been read. Plural: the last of several white characters; 'r: an apostrophe that begins a piece, and r.
_STATES = ("border", "letter", "number", "other", "blank", "blanks", "white", "whites", "apostrophe", "'r", "'v", "'l", "done")


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, begun) by class and state; begun: 1 if a piece begins at the character read, 2 if at the one before.

    Pieces are those of the pre-tokenizer of byte-level BPE: contractions after an apostrophe that begins a piece,
    letters, numbers or other characters with a blank before them, and white space, whose last character goes with what
    follows (a blank) or stands alone.
    """
    state = {name: i for i, name in enumerate(_STATES)}
    step = np.zeros((len(CLASSES), len(_STATES)), np.uint8)
    begun = np.zeros_like(step)

    def kind(c: str) -> str:
        return "letter" if c in _LETTERS else c

    def after(s: str, c: str) -> tuple[str, int]:
        k = kind(c)
        if s in ("'r", "'v", "'l"):  # does the letter end a contraction, or did it begin a piece?
            if c == ("l" if s == "'l" else "e"):
                return "done", 0
            to, here = after("letter", c)
            return to, here | 2
        if k == "border":
            return "border", 0
        if s == "apostrophe" and c == "stmd":
            return "done", 0
        if s == "apostrophe" and c in ("r", "v", "l"):
            return f"'{c}", 0
        if s in ("blank", "blanks", "white", "whites") and k in ("blank", "white"):
            return f"{k}s", 0
        alone = 2 if s in ("blanks", "whites") else 0  # the last of several white characters begins a piece
        if k in ("blank", "white"):
            return k, 1
        if s in ("blank", "blanks"):  # the blank before belongs to the piece
            return ("other" if k == "apostrophe" else k), alone
        if k == "apostrophe":
            return ("other", 0) if s in ("other", "apostrophe") else ("apostrophe", 1 | alone)
        if s == k or (s == "apostrophe" and k == "other"):
            return k, 0
        return k, 1 | alone

    for c, name in enumerate(CLASSES):
        for s in _STATES:
            to, starts = after(s, name)
            step[c, state[s]], begun[c, state[s]] = state[to], starts
    return step, begun


def character_classes(tokenizer) -> np.ndarray:
    """The class of every code point, as the library's own pre-tokenizer takes it.

    All code points are split at once, sorted by what the Unicode database of Python says, so that the pieces are few;
    one character of every piece is then tried beside a letter, a number and a sign.
    """
    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], np.uint32)
    guess = {"L": 0, "N": 1, "Z": 2}
    order = sorted(points.tolist(), key=lambda c: guess.get(unicodedata.category(chr(c))[0], 3))
    text = "".join(map(chr, order))
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    out = np.full(0x110000, CLASSES.index("other"), np.uint8)
    for _, (begin, end) in split(text):
        run = order[begin:end]
        for part in ([run[:1], run[1:]] if run[0] == 32 else [run]):
            if part:
                c = chr(part[-1])
                found = [name for name, x in (("letter", "a"), ("number", "1"), ("other", "!")) if len(split(x + c + x)) == 1]
                out[part] = CLASSES.index(found[0] if found else "white")
    for name, characters in (("stmd", "stmd"), ("r", "r"), ("v", "v"), ("l", "l"), ("e", "e"), ("apostrophe", "'"), ("blank", " ")):
        out[[ord(c) for c in characters]] = CLASSES.index(name)
    return out


def scan(maps: np.ndarray, begun: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State before each chunk, and pieces begun before it and in all, from the chunks' maps [chunk, state] and state 0.

    Inclusive scan by doubling: after round r a map spans 2**r chunks.
    """
    maps, begun = maps.copy(), begun.astype(np.int64)
    span = 1
    while span < len(maps):
        earlier, later = maps[:-span].astype(np.intp), maps[span:]
        begun[span:] = begun[:-span] + np.take_along_axis(begun[span:], earlier, 1)
        maps[span:] = np.take_along_axis(later, earlier, 1)
        span *= 2
    return np.r_[np.uint8(0), maps[:-1, 0]], np.r_[0, begun[:, 0]]


class Splitter:
    """Beginnings of pieces in a sequence of character classes."""

    def __init__(self) -> None:
        self.step, self.begun = splitter()
        self.states = len(_STATES)
        self.flat_step = self.step.ravel()
        self.flat_begun = self.begun.ravel()
        self.pieces = np.array([0, 1, 1, 2], np.uint8)[self.flat_begun]

    def __call__(self, classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """Positions where pieces begin; ``classes`` begins and ends at a border."""
        n = len(classes)
        chunks = -(-n // chunk)
        border = CLASSES.index("border")
        table = np.full(chunks * chunk, border, np.uint16)
        table[:n] = classes
        rows = np.ascontiguousarray(table.reshape(chunks, chunk).T) * np.uint16(self.states)
        maps = np.tile(np.arange(self.states, dtype=np.uint8), (chunks, 1))
        counts = np.zeros((chunks, self.states), np.uint16)
        out = np.zeros((chunk, chunks), np.uint8)
        maps = self._follow(rows[:MEET, :, None], maps, counts)
        # In most chunks all states have met by now, and one of them stands for all.
        apart = np.flatnonzero((maps != maps[:, :1]).any(axis=1))
        own = counts[apart]
        whole = self._follow(rows[MEET:, apart, None], maps[apart], own)
        more = np.zeros(chunks, np.uint16)
        maps[:] = self._follow(rows[MEET:], maps[:, 0], more, out[MEET:])[:, None]
        counts += more[:, None]
        maps[apart], counts[apart] = whole, own
        state, before = scan(maps, counts)
        state = self._follow(rows[:MEET], state, np.zeros(chunks, np.uint16), out[:MEET])
        rest = np.zeros((max(chunk - MEET, 0), len(apart)), np.uint8)
        self._follow(rows[MEET:, apart], state[apart], np.zeros(len(apart), np.uint16), rest)
        out[MEET:, apart] = rest
        begun = np.ascontiguousarray(out.T).ravel()
        starts = (begun & 1).astype(bool)
        starts[:-1] |= begun[1:] > 1
        found = np.flatnonzero(starts)
        assert len(found) == before[-1]
        return found

    def _follow(self, rows: np.ndarray, state: np.ndarray, counts: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """States after ``rows`` of classes; pieces begun are added to ``counts``, where they begin is written to ``out``."""
        for i, row in enumerate(rows):
            at = row + state
            counts += self.pieces[at]
            if out is not None:
                out[i] = self.flat_begun[at]
            state = self.flat_step[at]
        return state


# --- merger ------------------------------------------------------------------------------


class Merger:
    """Byte-level BPE as a transducer whose transitions carry emitted-token counts; compiled as far as it is met."""

    def __init__(self, vocabulary: dict[bytes, int], merges: Sequence[tuple[bytes, bytes]], states: int = STATES):
        if any(bytes([b]) not in vocabulary for b in range(256)):
            raise ValueError("the vocabulary has to hold every byte")
        self.most = states
        self.rank: dict[tuple[bytes, bytes], int] = {}
        self.made: dict[bytes, tuple[int, bytes, bytes]] = {}
        for rank, (a, b) in enumerate(merges):
            if a + b in self.made or len(a + b) < 2 or (len(a) > 1 and a not in self.made) or (len(b) > 1 and b not in self.made):
                raise ValueError("merges have to build every token once, from earlier ones")
            self.rank[a, b] = rank
            self.made[a + b] = (rank, a, b)
        # The tree of tokens: child by byte, the token that ends at a node.
        self.child: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        self._spines: tuple[dict, dict] = ({}, {})
        self._known: set[bytes] = set()
        for token in [*(bytes([b]) for b in range(256)), *self.made]:
            if not self._whole(token):
                continue  # its own bytes are merged otherwise, so it is in no text
            node = 0
            for b in token:
                if b not in self.child[node]:
                    self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token.append(None)
                node = self.child[node][b]
            self.token[node] = token
        self.clear()

    def clear(self) -> None:
        """Forget the compiled states."""
        self.stays: dict[tuple[bytes, bytes], bool] = {}
        self.names: dict[tuple, int] = {((0, b"", 0),): 0}
        self.held: list[tuple] = [((0, b"", 0),)]
        self.triples: dict[tuple, tuple] = {}
        self.chunks: dict[tuple[int, bytes], tuple[int, int]] = {}
        self._hash(1 << 16)

    def _hash(self, size: int) -> None:
        """An open-addressing table of the transitions; a move is ``next * 1024 + change + 512``."""
        old = (self.keys, self.values) if size > 1 << 16 else None
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, -1, np.int64)
        self.values = np.zeros(size, np.int64)
        self.n_moves = 0
        if old is not None:
            there = old[0] >= 0
            for key, value in zip(old[0][there].tolist(), old[1][there].tolist()):
                self._put(key, value)

    @staticmethod
    def _slot(key):
        return (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)

    def _place(self, key: int) -> int:
        """Where a key is in the table, or has to be put."""
        size = len(self.keys)
        at = ((key * 0x9E3779B97F4A7C15) % (1 << 64) >> 20) % size
        while self.keys[at] >= 0 and self.keys[at] != key:
            at = (at + 1) % size
        return at

    def _put(self, key: int, value: int) -> None:
        at = self._place(key)
        self.keys[at], self.values[at] = key, value
        self.n_moves += 1

    def _move(self, state: int, byte: int) -> int:
        key = state * 256 + byte
        at = self._place(key)
        return int(self.values[at]) if self.keys[at] == key else self._compile(state, byte)

    def spine(self, token: bytes, left: bool) -> list[tuple[bytes, float, float]]:
        """Tokens that stand at the end of ``token`` (at its beginning if ``left``) while it is merged: birth and end."""
        known = self._spines[left]
        if token not in known:
            out, end, at = [], float("inf"), token
            while True:
                made = self.made.get(at)
                out.append((at, made[0] if made else -1, end))
                if made is None:
                    break
                end, at = made[0], made[1 if left else 2]
            known[token] = out
        return known[token]

    def apart(self, a: bytes, b: bytes, before: float = float("inf")) -> bool:
        """Whether no merge of a rank under ``before`` joins across the border of neighbours ``a`` and ``b``.

        A pair at the border merges if its rank comes while both are there. Equal ranks go from left to right: the left
        one is gone if its own merge has that rank, the right one is still there.
        """
        for x, born_x, end_x in self.spine(a, False):
            for y, born_y, end_y in self.spine(b, True):
                rank = self.rank.get((x, y))
                if rank is not None and rank < before and born_x < rank < end_x and born_y < rank <= end_y:
                    return False
        return True

    def _whole(self, token: bytes) -> bool:
        """Whether a token's bytes are merged to just this token; asked in the order of ranks."""
        made = self.made.get(token)
        whole = made is None or (made[1] in self._known and made[2] in self._known and self.apart(made[1], made[2], made[0]))
        if whole:
            self._known.add(token)
        return whole

    def _compile(self, state: int, byte: int) -> int:
        found, kept = None, []
        for node, last, back in self.held[state]:
            child = self.child[node].get(byte)
            if child is None:
                continue
            token = self.token[child]
            if token is not None and found is None:
                pair = (last, token)
                ok = not last or self.stays.get(pair)
                if ok is None:
                    ok = self.stays[pair] = self.apart(last, token)
                if ok:
                    found = (token, back + 1)
            kept.append((child, last, back))
        token, change = found
        same = self.triples.setdefault  # equal parts of states are one object
        parts = [(c, last, back - change) for c, last, back in kept if self.child[c]]
        to = tuple(same(p, p) for p in (*parts, (0, token, 0)))
        name = self.names.setdefault(to, len(self.held))
        if name == len(self.held):
            self.held.append(to)
        move = (name << 10) + change + 512
        self._put(state * 256 + byte, move)
        if 2 * self.n_moves > len(self.keys):
            self._hash(4 * len(self.keys))
        return move

    def _step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = state * 256 + byte
        at = (self._slot(key.view(np.uint64)) & self.mask).astype(np.int64)
        there = self.keys[at]
        open_ = np.flatnonzero(there != key)
        while len(open_):
            gone = there[open_] < 0
            if gone.any():
                missing = np.unique(key[open_[gone]])
                for k in missing.tolist():
                    self._move(k >> 8, k & 255)
                return self._step(state, byte)
            at[open_] = (at[open_] + 1) & int(self.mask)
            there[open_] = self.keys[at[open_]]
            open_ = open_[there[open_] != key[open_]]
        return self.values[at]

    def _chunk(self, state: int, data: bytes) -> tuple[int, int]:
        """A chunk's map at one entry state: exit state and change of the count."""
        known = self.chunks.get((state, data))
        if known is None:
            at, count = state, 0
            for b in data:
                move = self._move(at, b)
                at, count = move >> 10, count + (move & 1023) - 512
            known = at, count
            if len(self.chunks) < 1 << 16:
                self.chunks[state, data] = known
        return known

    def _long(self, data: bytes) -> int:
        """Tokens of a long piece: its chunks' maps, one after the other."""
        state = total = 0
        for at in range(0, len(data), LONG):
            if len(self.held) > self.most:
                kept = self.held[state]
                self.clear()
                state = self.names.setdefault(kept, len(self.held))
                if state == len(self.held):
                    self.held.append(kept)
            state, count = self._chunk(state, data[at : at + LONG])
            total += count
        return total

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of tokens of each piece data[starts:ends]."""
        counts = np.zeros(len(starts), np.int64)
        lengths = ends - starts
        for i in np.flatnonzero(lengths > LONG).tolist():
            counts[i] = self._long(data[starts[i] : ends[i]].tobytes())
        known, of = distinct(data, starts, lengths)
        short = known[lengths[known] <= LONG]
        cuts = np.searchsorted(np.cumsum(lengths[short]), np.arange(AT_ONCE, lengths[short].sum() + AT_ONCE, AT_ONCE))
        for part in np.split(short, np.unique(np.minimum(cuts + 1, len(short)))):
            if len(self.held) > self.most:
                self.clear()
            part = part[np.argsort(-lengths[part], kind="stable")]
            left, begin = lengths[part], starts[part]
            state, count = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            # Pieces are sorted by length, so those still open are the first ``n``.
            for k in range(int(left[0]) if len(part) else 0):
                n = int(np.searchsorted(-left, -k, "left"))
                move = self._step(state[:n], data[begin[:n] + k].astype(np.int64))
                state[:n] = move >> 10
                count[:n] += (move & 1023) - 512
            counts[part] = count
        return counts[of]


_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def distinct(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, of): pieces no two of which are equal, if of up to 16 bytes, and for every piece the one equal to it.

    Pieces are grouped by a hash of their bytes and compared with the first of their group; one that is not equal to it
    stands for itself, like all longer ones.
    """
    at = np.arange(len(starts))
    few = np.flatnonzero(lengths <= 16)
    if not len(few):
        return at, at
    bytes_ = np.r_[data, np.zeros(16, np.uint8)]
    eight = np.ndarray(len(data) + 9, "<u8", bytes_, strides=(1,))  # the eight bytes from every place on
    n = lengths[few]
    low = eight[starts[few]] & _MASKS[np.minimum(n, 8)]
    high = eight[starts[few] + 8] & _MASKS[np.maximum(n - 8, 0)]
    hashed = mix(low ^ mix(high + (n.astype(np.uint64) << np.uint64(56))))
    order = np.argsort(hashed)
    new = np.r_[True, hashed[order][1:] != hashed[order][:-1]]
    first = np.empty(len(few), np.int64)
    first[order] = order[new][np.cumsum(new) - 1]
    equal = (low == low[first]) & (high == high[first]) & (n == n[first])
    of = at.copy()
    of[few] = np.where(equal, few[first], few)
    return np.flatnonzero(of == at), of


# --- a tokenizer file --------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level BPE files: printable Latin-1 stands for itself, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Counter:
    """Token counts by a byte-level BPE file of the tokenizers library, without begin, end or added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, pre = made["model"], made.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        split = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        if not plain or not split or made.get("normalizer"):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in made.get("added_tokens", [])):
            raise ValueError("added tokens that take white space or whole words are not supported")
        letters = byte_letters()

        def as_bytes(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        added = {t["content"] for t in made.get("added_tokens", [])}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocabulary = {as_bytes(t): i for t, i in model["vocab"].items() if t not in added}
        self.merger = Merger(vocabulary, [(as_bytes(a), as_bytes(b)) for a, b in pairs])
        self.splitter = Splitter()
        self.classes = character_classes(Tokenizer.from_file(path))
        # Special strings in a text are one token each. Longer ones first: the library takes the longest at a place.
        self.added = sorted(added - {""}, key=lambda t: (-len(t), t))

    def _special(self, points: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of special strings, leftmost first and without overlaps."""
        if not any(a in text for a in self.added):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        begins, ends, at = [], [], 0
        while at < len(text):
            places = [(p, -len(a)) for a in self.added if (p := text.find(a, at)) >= 0]
            if not places:
                break
            p, n = min(places)
            begins.append(p)
            ends.append(p - n)
            at = p - n
        return np.array(begins, np.int64), np.array(ends, np.int64)

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        """Number of tokens of each text."""
        if not texts:
            return np.zeros(0, np.int64)
        text = "\n".join(texts) + "\n"  # the character between texts only holds a place
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        places = np.cumsum(sizes) - sizes
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        border = CLASSES.index("border")
        classes = self.classes[points]
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        classes[ends] = border
        begins, closes = self._special(points, text)
        for b, e in zip(begins.tolist(), closes.tolist()):
            classes[b:e] = border
        starts = self.splitter(classes)
        # A piece reaches to the next one or to the border before it.
        walls = np.flatnonzero(classes == border)
        until = np.minimum(np.r_[starts[1:], len(points)], walls[np.minimum(np.searchsorted(walls, starts), len(walls) - 1)])
        tokens = self.merger(data, places[starts], places[until])
        out = np.bincount(np.searchsorted(ends, starts), weights=tokens, minlength=len(texts)).astype(np.int64)
        return out + np.bincount(np.searchsorted(ends, begins), minlength=len(texts))


def counter(path: str) -> Counter:
    """The compiled tokenizer of a file; a worker process keeps it for its next tasks."""
    kept = sys.modules.setdefault("compiled_tokenizers", types.ModuleType("compiled_tokenizers")).__dict__
    if path not in kept:
        kept[path] = Counter(path)
    return kept[path]


#: A blank between two other characters: a piece begins there whatever stands around.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def cut(text: str, most: int = BATCH_BYTES) -> list[str]:
    """A long text in parts whose token counts add up to its own, of about ``most`` characters if it has blanks."""
    parts, at = [], 0
    while len(text) - at > most and (found := _CUT.search(text, at + most)):
        parts.append(text[at : found.start()])
        at = found.start()
    return [*parts, text[at:]]


def count_tokens(docs: DataFrame, tokenizer: str, text_col: str = "text", name: str = "n_tokens", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``name`` bigint: the number of tokens of the whole text, as the library gives it.

    NULL and empty texts have none. Rows stay where they are read; repeated rows and any other columns pass as they are,
    but the text itself, if it is not wanted. ``tokenizer`` is the path of a byte-level BPE file that all executors can
    open; strings of its special tokens in a text are one token each.
    """
    kept = [c for c in docs.columns if c != name and (keep_text or c != text_col)]
    given = docs.select(*kept, F.col(text_col).cast("string").alias("_counted_text"))
    schema = given.drop("_counted_text").withColumn(name, F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            texts, of = [], []
            for i, t in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                own = cut(t) if t else []
                texts += own
                of += [i] * len(own)
            counts = [count(texts[s]) for s in slices(texts)]
            total = np.bincount(np.array(of, np.int64), np.concatenate(counts) if counts else None, batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(total, pa.int64())], [*kept, name])

    return given.mapInArrow(run, schema)
