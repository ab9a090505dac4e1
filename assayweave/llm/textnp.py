"""Words of a batch of texts as numpy arrays, and hashes of words and of runs of words.

A run's hash is a polynomial over 64-bit integers, read off prefix sums; so all windows of a batch cost a few
array operations. Two hashers with different seeds together give 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

#: Texts of about so many bytes are worked on at once; a longer text makes a batch of its own.
BATCH_BYTES = 2_000_000
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
#: What stands between words: the six ASCII white-space characters, or anything ASCII but letters and digits.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
NO_TERM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class TaskCache(dict):
    """A cache that is empty in every process it is shipped to."""

    def __reduce__(self):
        return TaskCache, ()


_powers = TaskCache()


def _base(seed: int) -> tuple[int, int, np.ndarray]:
    """An odd multiplier, its inverse and a value for each byte."""
    rng = np.random.default_rng(seed)
    base = int(rng.integers(1 << 62, dtype=np.uint64)) * 8 + 3
    return base % (1 << 64), pow(base, -1, 1 << 64), rng.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse; kept for the next batch."""
    kept = _powers.get(seed)
    if kept is None or len(kept[0]) < n:
        size = max(n, 1024) * 5 // 4
        base, inverse, _ = _base(seed)
        steps = [np.full(size, np.uint64(b), np.uint64) for b in (base, inverse)]
        for s in steps:
            s[0] = 1
        kept = _powers[seed] = (np.cumprod(steps[0]), np.cumprod(steps[1]))
    return kept[0][:n], kept[1][:n]


class Runs:
    """Hashes of runs [a, b) of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, seed: int):
        self.up, self.down = powers(seed, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + mix((b - a).astype(np.uint64)))


@dataclass
class Words:
    """Words of some texts one after the other: byte positions in ``data``; text ``i`` has words first[i]:first[i+1].

    ``offsets`` are the texts' own positions: text ``i`` is data[offsets[i]:offsets[i+1] - 1].
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def hashes(self, seed: int) -> np.ndarray:
        return self.letters(seed).of(self.starts, self.ends)

    def letters(self, seed: int) -> Runs:
        """Hashes of any parts of the words."""
        return Runs(_base(seed)[2][self.data], seed)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def run_starts(self, width: int) -> np.ndarray:
        """First words of all runs of ``width`` words inside a text."""
        at = np.arange(len(self.starts))
        return at[at + width <= np.repeat(self.first[1:], np.diff(self.first))]


def words(texts: Sequence[str | None], lower: bool = False, between: np.ndarray = SPACE) -> Words:
    """Words of each text (NULL: none): runs of bytes not in ``between``; A-Z lower-cased on demand."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    if lower:
        data = LOWER[data]
    space = between[data]
    inside = ~space
    starts = np.flatnonzero(inside & np.r_[True, space[:-1]]) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(inside & np.r_[space[1:], True]) + 1 if len(data) else starts
    ends_of_text = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)
    first = np.r_[0, np.searchsorted(starts, ends_of_text)].astype(np.int64)
    return Words(data, starts, ends, first, np.r_[0, ends_of_text])


def slices(texts: Sequence[str | None], most: int = BATCH_BYTES) -> Iterator[slice]:
    """Cut a batch of texts so that each piece has about ``most`` characters at most."""
    begin = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += n + 1
    if begin < len(texts):
        yield slice(begin, len(texts))
