"""Winnowing over arrays of words, in built-in array functions only.

A k-gram hash is built by doubling: hashes of single words give hashes of pairs,
those of fours and so on, each a combination of two shifted arrays.  The sliding
minimum is built the same way.  A fingerprint is one long: the upper 36 bits hold
the k-gram hash, the lower 28 bits the complement of its position, so the minimum
of a window is its smallest hash and among ties the rightmost.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionlake.llm.common import let

POSITION_BITS = 28
_LOW = (1 << POSITION_BITS) - 1


def _pair(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _shifted(a: Column, by: int, combine) -> Column:
    return F.zip_with(a, F.slice(a, F.lit(by + 1), F.size(a)), combine)


def kgram_hashes(hashes: Column, k: int) -> Column:
    """Hash of each k words in a row; fewer than k words give one hash.

    ``hashes`` is an array of word hashes and must be cheap to repeat (a bound
    lambda variable or a column).
    """

    def grams(n: int) -> Column:
        if n == 1:
            return hashes
        if n % 2:
            return F.zip_with(grams(n - 1), F.slice(hashes, F.lit(n), F.size(hashes)), _pair)
        return let(grams(n // 2), lambda g: _shifted(g, n // 2, _pair))

    count = F.greatest(F.size(hashes) - (k - 1), F.least(F.size(hashes), F.lit(1)))
    return F.slice(grams(k), F.lit(1), count)


def _step(by: int):
    return lambda a: _shifted(a, by, _smaller)


def sliding_min(values: Column, width: int) -> Column:
    """Minimum of each ``width`` values in a row, by doubling; one for short input."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = let(out, _step(step))
        have += step
    count = F.greatest(F.size(values) - (width - 1), F.least(F.size(values), F.lit(1)))
    return F.slice(out, F.lit(1), count)


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def fingerprints(hashes: Column, k: int, window: int) -> Column:
    """Selected (hash, position) pairs of an array of word hashes, packed in longs.

    Any run of ``k + window - 1`` equal words in two texts shares a selected
    k-gram.  Empty input gives an empty array.  Positions are exact below 2**28
    words; beyond, they count modulo that.
    """
    pack = lambda g, i: g.bitwiseAND(F.lit(~_LOW)).bitwiseOR(
        F.lit(_LOW) - i.cast("bigint").bitwiseAND(F.lit(_LOW))
    )
    return let(
        hashes,
        lambda h: let(
            F.transform(kgram_hashes(h, k), pack),
            lambda p: F.array_distinct(sliding_min(p, window)),
        ),
    )


def position(fingerprint: Column) -> Column:
    return F.lit(_LOW) - fingerprint.bitwiseAND(F.lit(_LOW))


def gram_hash(fingerprint: Column) -> Column:
    return F.shiftrightunsigned(fingerprint, POSITION_BITS)
