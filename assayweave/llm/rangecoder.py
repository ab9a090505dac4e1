"""An adaptive context-mixing range coder for token ids, run over many blocks in step.

Ids are coded as ranks in the order of their frequency (the dictionary stands beside the blocks). A symbol says
that the rank is what followed the last two ranks, or the last rank, when they came before in the block, or
else the rank's group: groups grow by a factor of four, and the place in the group follows as an even choice.
Three adaptive models predict the symbol: without context, from the last rank, and from the last two. Their
distributions are mixed by weights that follow which of them has done best lately, and the mix drives the
coder. All state is reset at the start of a block and all of it is integers, so a block decodes anywhere.

The blocks of a segment are the lanes of the arrays below: one step codes one rank of every block. A distribution is the 8
cumulative frequencies between its symbols, 16 bits each, in two 64-bit words: it is fetched and put back as one item of 16
bytes, and mixed, moved and compared four frequencies at a time. No frequency exceeds its 16 bits, so none reaches into the next.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048
GROUPS = 7
HIT_2, HIT_1, SYMBOLS = GROUPS, GROUPS + 1, GROUPS + 2
#: Contexts of the second and third model, and slots for what followed one and two ranks, as powers of two.
CONTEXTS_1, CONTEXTS_2, SLOTS_1, SLOTS_2 = 6, 8, 10, 11
#: Total of a model (WEIGHTS of them and a FLOOR for each symbol stay below 2^SCALE), and the total of the mix.
FULL, WEIGHTS, FLOOR, SCALE = 4064, 8, 28, 15
#: Of a frequency and its target, a sixteenth of the distance is gone at each step.
RATE = 4
#: The weights follow every so manyth rank.
WEIGH = 16
#: Most bits of a place: a symbol and a place leave at least 1 of the coder's range, which is moved out below 2^30.
MOST_BITS = 19
# Numbers that the steps use are arrays of one item, which cost numpy less than scalars.
_BITS, _LEAST, _DIGIT, _ONE, _SCALE, _TWO = (np.array([k], np.uint64) for k in (30, 1 << 30, 32, 1, SCALE, 2))
_EACH, _HIGH = (np.array([0x0001000100010001 * k], np.uint64) for k in (1, 0x8000))
#: First rank of each group (0 for hits): the groups have 4, 16, 64, ... ranks.
FIRST = np.array([(4 ** (g + 1) - 4) // 3 for g in range(GROUPS)], np.int64)
FIRST_OF = np.r_[FIRST, 0, 0].astype(np.uint64)


def _items(fields: np.ndarray) -> np.ndarray:
    """The 8 frequencies along the last axis as one item of 16 bytes."""
    return np.ascontiguousarray(fields, np.uint16).view(np.complex128)[..., 0]


_BETWEEN = np.arange(1, SYMBOLS)
_EVEN = _items(FULL * _BETWEEN // SYMBOLS)
_BASE = _items(FLOOR * _BETWEEN).reshape(1).view(np.uint64)[:, None]
#: What a symbol adds to each frequency, and the bits that a frequency keeps when it is shifted.
_TARGET = _items(np.where(_BETWEEN > np.arange(SYMBOLS)[:, None], FULL >> RATE, 0))
_RATE, _KEEP = np.array([RATE], np.uint64), np.uint64(0xFFFF >> RATE) * _EACH
_HASH_1, _HASH_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ROWS = np.array([[64 - CONTEXTS_1], [64 - CONTEXTS_2]], np.uint64)
_SLOTS = np.array([[64 - SLOTS_1], [64 - SLOTS_2]], np.uint64)


def _bits_of(size: int) -> np.ndarray:
    """Bits of a place by symbol; the last group has the rest of ``size`` ranks."""
    last = max(0, size - 1 - int(FIRST[-1])).bit_length()
    if last > MOST_BITS:
        raise ValueError(f"{size} different ids are too many for a segment")
    return np.array([*(2 * (g + 1) for g in range(GROUPS - 1)), last, 0, 0], np.uint64)


def _rank_type(size: int) -> type:
    """Its largest value is no rank."""
    return np.uint16 if size <= 0xFFFF else np.uint32


class _Predictor:
    """The models of ``lanes`` blocks over ``size`` ranks."""

    def __init__(self, lanes: int, size: int):
        # The rows of a context stand beside each other, as do the slots for what followed: all lanes use the frequent ones.
        # The first model has one row.
        lane, self.lanes = np.arange(lanes), np.array([lanes])
        contexts, slots = (1 << CONTEXTS_1) + (1 << CONTEXTS_2), (1 << SLOTS_1) + (1 << SLOTS_2)
        self.table = np.full(lanes * contexts, _EVEN)
        self.own = np.full((3, lanes), _EVEN)
        self.rows = lane + lanes * np.array([[0], [1 << CONTEXTS_1]])
        self.slots = lane + lanes * np.array([[0], [1 << SLOTS_1]])
        kind = _rank_type(size)
        self.after = np.full(lanes * slots, np.iinfo(kind).max, kind)
        self.gains = np.zeros((2, lanes), np.int32)
        self.hashed = np.zeros((2, lanes), np.uint64)
        self.before = np.zeros(lanes, np.uint64)
        self.n, self.steps = -1, 0

    def only(self, n: int) -> None:
        """From now on the first ``n`` lanes."""
        if n == self.n:
            return
        self.n = n
        self.own, self.rows, self.slots, self.gains, self.hashed, self.before = (
            np.ascontiguousarray(x[..., :n]) for x in (self.own, self.rows, self.slots, self.gains, self.hashed, self.before)
        )
        self.fetched = self.own[1:].reshape(-1)
        self.words = self.own.view(np.uint64)
        self.by_word = self.words.reshape(3, n, 2).transpose(0, 2, 1)
        self.at_rows, self.at_slots = np.empty((2, 2, n), np.int64)
        self.parts = np.empty((3, 2, n), np.uint64)
        # The mix stands between the first bound, 0, and the last.
        self.mix = np.zeros((4, n), np.uint64)
        self.mix[3] = 1 << SCALE
        self.mixed = self.mix[1:3]
        self.fields = self.mix.view(np.uint16).reshape(-1)
        bound = 3 + np.arange(SYMBOLS + 1)
        place = (bound >> 2) * 4 * n + (bound & 3)
        self.place = np.stack([place[:-1], place[1:]])
        self.lane = 4 * np.arange(n)
        self.first_field = 8 * np.arange(n)
        self._weigh()

    def _weigh(self) -> None:
        weights = self.gains * np.int32(WEIGHTS - 1)
        weights += 512
        weights >>= 10
        self.weights = np.concatenate([WEIGHTS - weights[:1] - weights[1:], weights]).astype(np.uint64)[:, None]

    def predict(self) -> None:
        """Mix the models; sets the ranks that hits stand for."""
        for shift, begin, at in ((_ROWS, self.rows, self.at_rows), (_SLOTS, self.slots, self.at_slots)):
            np.right_shift(self.hashed, shift, out=at.view(np.uint64))
            at *= self.lanes
            at += begin
        self.hit_1, self.hit_2 = self.after[self.at_slots]
        np.take(self.table, self.at_rows.reshape(-1), out=self.fetched, mode="clip")
        np.multiply(self.by_word, self.weights, out=self.parts)
        np.add.reduce(self.parts, axis=0, out=self.mixed)
        self.mixed += _BASE

    def symbol_at(self, value: np.ndarray) -> np.ndarray:
        """The symbols in whose part of the mix the values lie."""
        above = value * _EACH
        above |= _HIGH
        held = above - self.mixed
        held &= _HIGH
        counts = np.bitwise_count(held)
        return (counts[0] + counts[1]).astype(np.int64)

    def bounds(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, width) of the symbols in the mix."""
        at = self.place.take(symbol, axis=1)
        at += self.lane
        low, width = self.fields[at].astype(np.uint64)
        width -= low
        return low, width

    def _follow(self, symbol: np.ndarray) -> None:
        """Move the weights to the model that gave the symbol the most."""
        fields, at = self.words.view(np.uint16), self.first_field + symbol
        high = np.where(symbol < SYMBOLS - 1, fields.take(at, axis=1, mode="clip"), np.uint16(FULL))
        zero, one, two = high - np.where(symbol > 0, fields.take(at - 1, axis=1, mode="clip"), np.uint16(0))
        best = np.stack([(one > zero) & (one >= two), (two > zero) & (two > one)])
        step = best * np.int32(1024)
        step -= self.gains
        step >>= 3
        self.gains += step
        self._weigh()

    def learn(self, symbol: np.ndarray, rank: np.ndarray) -> None:
        if self.steps % WEIGH == 0:
            self._follow(symbol)
        self.steps += 1
        words = self.words
        fall = words >> _RATE
        fall &= _KEEP
        words -= fall
        words += _TARGET[symbol].view(np.uint64)
        self.table[self.at_rows.reshape(-1)] = self.fetched
        self.after[self.at_slots[0]] = rank
        self.after[self.at_slots[1]] = rank
        last = rank.astype(np.uint64)
        np.multiply(last, _HASH_1, out=self.hashed[0])
        np.add(self.hashed[0], self.before, out=self.hashed[1])
        np.multiply(last, _HASH_2, out=self.before)


class _Writer:
    """Digits of 32 bits; a carry stays in the upper half of its digit until all are there."""

    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, 1 << 62, np.uint64)
        self.out = np.zeros((steps + 1, lanes), np.uint64)
        self.flat = self.out.reshape(-1)
        self.at = np.arange(lanes)

    def put(self, n: int, low: np.ndarray, width: np.ndarray, place: np.ndarray, bits: np.ndarray) -> None:
        """A symbol by its bounds, then a place of so many bits."""
        bottom, size, at = self.low[:n], self.range[:n], self.at[:n]
        size >>= _SCALE
        low *= size
        bottom += low
        size *= width
        size >>= bits
        bottom += size * place
        digit = bottom >> _BITS
        self.flat[at] = digit  # counts only if the lane moves on
        move = (size < _LEAST).astype(np.uint64)
        at += move.view(np.int64) * len(self.low)
        shift = move * _DIGIT
        digit *= move
        digit <<= _BITS
        bottom -= digit
        bottom <<= shift
        size <<= shift

    def close(self) -> list[bytes]:
        # The least value of whole digits in the range: 2^30 fit in it.
        self.flat[self.at] = (self.low + _LEAST - _ONE) >> _BITS
        sizes = self.at // len(self.low) + 1
        out = self.out[: int(sizes.max())]
        while (carry := out >> _DIGIT).any():
            out &= np.uint64(0xFFFFFFFF)
            out[:-1] += carry[1:]
        little = np.ascontiguousarray(out.T, "<u4")
        return [little[i, :s].tobytes() for i, s in enumerate(sizes.tolist())]


class _Reader:
    def __init__(self, blocks: list[bytes]):
        most = max(len(b) // 4 for b in blocks) + 3
        data = np.zeros((len(blocks), most), np.uint64)
        for row, b in zip(data, blocks):
            row[: len(b) // 4] = np.frombuffer(b, "<u4")
        # 62 bits are in the coder, so later digits begin two bits before a word's end.
        self.code = (data[:, 0] << _BITS) | (data[:, 1] >> _TWO)
        self.range = np.full(len(blocks), 1 << 62, np.uint64)
        later = data[:, 1:-1] & np.uint64(3)
        later <<= _BITS
        later |= data[:, 2:] >> _TWO
        self.data = later.T.reshape(-1)
        self.at = np.arange(len(blocks))

    def value(self, n: int) -> np.ndarray:
        self.range[:n] >>= _SCALE
        return self.code[:n] // self.range[:n]

    def take(self, n: int, low: np.ndarray, width: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """After ``value``: take the symbol out, and the place of so many bits, which is returned."""
        code, size, at = self.code[:n], self.range[:n], self.at[:n]
        low *= size
        code -= low
        size *= width
        size >>= bits
        place = code // size
        code -= size * place
        move = (size < _LEAST).astype(np.uint64)
        shift = move * _DIGIT
        code <<= shift
        code |= self.data.take(at, mode="clip") * move
        size <<= shift
        at += move.view(np.int64) * len(self.code)
        return place


def _ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids by falling frequency, the rank of every id)."""
    if int(ids.max()) < 1 << 20:
        times = np.bincount(ids)
        values = np.flatnonzero(times)
        values = values[np.lexsort((values, -times[values]))]
        rank_of = np.zeros(len(times), _rank_type(len(values)))
        rank_of[values] = np.arange(len(values))
        return values.astype(np.uint32), rank_of.take(ids)
    values, of, times = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((values, -times))
    rank_of = np.empty(len(values), np.int32)
    rank_of[order] = np.arange(len(values))
    return values[order], rank_of[of]


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, list[bytes]]:
    """(dictionary: ids by falling frequency, coded blocks of ``block`` ids each, the last one shorter).

    A block is the crc32 of its ids as little-endian unsigned 32-bit integers, then the range coder's digits.
    """
    ids = np.ascontiguousarray(ids, np.uint32)
    if not len(ids):
        return np.zeros(0, np.uint32), []
    values, flat_ranks = _ranked(ids)
    size = len(values)
    bits_of = _bits_of(size)
    groups = (np.searchsorted(FIRST, np.arange(size), "right") - 1).astype(np.uint8)
    lanes, steps = -(-len(ids) // block), min(block, len(ids))
    ranks = np.zeros((steps, lanes), _rank_type(size))
    full = len(ids) // block
    ranks[:, :full] = flat_ranks[: full * block].reshape(full, -1).T if full else 0
    tail = flat_ranks[full * block :]
    if len(tail):
        ranks[: len(tail), full] = tail
    del flat_ranks
    models, out = _Predictor(lanes, size), _Writer(lanes, steps)
    for t in range(steps):
        n = lanes if not len(tail) or t < len(tail) else full
        r = ranks[t, :n]
        models.only(n)
        models.predict()
        symbol = groups[r].astype(np.int64)
        place = r - FIRST_OF[symbol]
        for hit, of in ((HIT_1, models.hit_1), (HIT_2, models.hit_2)):
            met = of == r
            np.copyto(symbol, hit, where=met)
            place *= ~met
        out.put(n, *models.bounds(symbol), place, bits_of[symbol])
        models.learn(symbol, r)
    little = ids.astype("<u4", copy=False)
    sums = [zlib.crc32(little[i : i + block].tobytes()) for i in range(0, len(ids), block)]
    return values, [s.to_bytes(4, "little") + b for s, b in zip(sums, out.close())]


def decode(dictionary: np.ndarray, blocks: list[bytes], n_ids: int, block: int = BLOCK) -> np.ndarray:
    """The ``n_ids`` ids of a segment; raises ValueError where a block's checksum disagrees."""
    if not n_ids:
        return np.zeros(0, np.uint32)
    lanes, steps, full = len(blocks), min(block, n_ids), n_ids // block
    tail = n_ids - full * block
    size = len(dictionary)
    bits_of = _bits_of(size)
    models, source = _Predictor(lanes, size), _Reader([b[4:] for b in blocks])
    ranks = np.zeros((steps, lanes), _rank_type(size))
    for t in range(steps):
        n = lanes if not tail or t < tail else full
        models.only(n)
        models.predict()
        symbol = models.symbol_at(source.value(n))
        place = source.take(n, *models.bounds(symbol), bits_of[symbol])
        place += FIRST_OF[symbol]
        r = place.astype(ranks.dtype)
        np.copyto(r, models.hit_1, where=symbol == HIT_1)
        np.copyto(r, models.hit_2, where=symbol == HIT_2)
        ranks[t, :n] = r
        models.learn(symbol, r)
    flat_ranks = np.concatenate([ranks[:, :full].T.reshape(-1), ranks[:tail, full] if tail else ranks[:0, 0]])
    if flat_ranks.max() >= size:
        raise ValueError("a block holds an unknown rank")
    ids = dictionary.astype(np.uint32)[flat_ranks]
    little = ids.astype("<u4", copy=False)
    for i, b in enumerate(blocks):
        if zlib.crc32(little[i * block : (i + 1) * block].tobytes()) != int.from_bytes(b[:4], "little"):
            raise ValueError(f"checksum of block {i} disagrees")
    return ids
