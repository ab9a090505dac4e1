"""Fingerprint column functions.

A fingerprint has three forms: ``bits`` (sorted distinct ``array<int>``), ``hex`` (the
bit string read left to right, so bit 0 is the most significant) and ``words``
(``array<bigint>``, 64 bits each, the fast form for comparisons).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import ColumnOrName, _col


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``.

    An expression mentioned inside a lambda is evaluated per element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_set(text: ColumnOrName) -> Column:
    """Sorted distinct lower-case words of a whole text: runs of letters, marks and digits of any script."""
    plain = F.trim(F.regexp_replace(F.lower(_col(text)), r"[^\p{L}\p{M}\p{N}]+", " "))
    return F.sort_array(F.array_remove(F.array_distinct(F.split(plain, " ")), ""))


def hashed_bits(features: ColumnOrName, nbits: int = 2048) -> Column:
    """Feature set to on-bits, row-wise and shuffle-free (md5 prefix modulo ``nbits``)."""

    def bit(feature: Column) -> Column:
        return (F.conv(F.substring(F.md5(feature), 1, 4), 16, 10).cast("int") % F.lit(nbits)).cast("int")

    return F.sort_array(F.array_distinct(F.transform(_col(features), bit)))


def _bit_text(bits: Column, nbits: int) -> Column:
    """'0'/'1' text of sorted on-bits, left to right, in one pass over the bits."""

    def text(b: Column) -> Column:
        def run(bit: Column, i: Column) -> Column:
            before = F.when(i == 0, F.lit(-1)).otherwise(F.get(b, i - 1))
            return F.concat(F.repeat(F.lit("0"), bit - before - 1), F.lit("1"))

        return F.rpad(F.array_join(F.transform(b, run), ""), nbits, "0")

    return _let(bits, text)


def _words_of(text: Column, nbits: int, convert: Callable[[Column], Column], step: int) -> Column:
    """``convert`` every ``step`` characters of a text into an array."""
    count = nbits // 64
    pieces = lambda t: F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)), lambda i: convert(F.substr(t, i * step + 1, F.lit(step)))
    )
    return _let(text, pieces)


def bits_to_hex(bits: ColumnOrName, nbits: int = 2048) -> Column:
    """Sorted on-bits to the hex string of ``nbits / 4`` characters."""
    bits = _col(bits)
    words = _words_of(_bit_text(bits, nbits), nbits, lambda w: F.lpad(F.conv(w, 2, 16), 16, "0"), 64)
    return F.when(bits.isNotNull(), F.lower(F.array_join(words, "")))


def bits_to_words(bits: ColumnOrName, nbits: int = 2048) -> Column:
    """Sorted on-bits to 64-bit words."""
    bits = _col(bits)
    words = _words_of(_bit_text(bits, nbits), nbits, lambda w: F.conv(w, 2, -10).cast("bigint"), 64)
    return F.when(bits.isNotNull(), words)


def hex_to_words(hexed: ColumnOrName, nbits: int = 2048) -> Column:
    """Hex string to 64-bit words."""
    hexed = _col(hexed)
    return F.when(F.length(hexed) > 0, _words_of(hexed, nbits, lambda w: F.conv(w, 16, -10).cast("bigint"), 16))


def hex_to_bits(hexed: ColumnOrName, nbits: int = 2048) -> Column:
    """Hex string to sorted on-bits, in one pass over the bit string."""
    hexed = _col(hexed)
    text = F.array_join(_words_of(hexed, nbits, lambda w: F.lpad(F.conv(w, 16, 2), 64, "0"), 16), "")
    marked = F.transform(F.split(text, ""), lambda c, i: F.when(c == "1", i))
    return F.when(hexed.isNotNull(), F.array_compact(marked))


def popcount_words(words: ColumnOrName) -> Column:
    """Number of set bits."""
    return F.aggregate(_col(words), F.lit(0), lambda acc, w: acc + F.bit_count(w))


def _ratio(shared: Column, union: Column) -> Column:
    return F.when(union > 0, shared.cast("double") / union).otherwise(F.lit(0.0))


def tanimoto_words(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Popcount similarity of two packed fingerprints; missing or empty gives 0.0."""
    a, b = _col(a), _col(b)
    both = F.zip_with(a, b, lambda x, y: x.bitwiseAND(y))
    either = F.zip_with(a, b, lambda x, y: x.bitwiseOR(y))
    return F.when(a.isNotNull() & b.isNotNull(), _ratio(popcount_words(both), popcount_words(either))).otherwise(
        F.lit(0.0)
    )


def tanimoto_bits(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Similarity of two sets given as distinct arrays; missing or empty gives 0.0."""
    a, b = _col(a), _col(b)
    shared = F.size(F.array_intersect(a, b))
    return F.when(
        a.isNotNull() & b.isNotNull(), _ratio(shared, F.size(a) + F.size(b) - shared)
    ).otherwise(F.lit(0.0))


def contains_all(bits: ColumnOrName, query: ColumnOrName) -> Column:
    """True when every element of ``query`` is in ``bits``; NULL if either is NULL."""
    bits, query = _col(bits), _col(query)
    return F.when(bits.isNotNull() & query.isNotNull(), F.size(F.array_except(query, bits)) == 0)
