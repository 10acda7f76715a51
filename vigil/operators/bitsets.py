"""Successor sets as bitmaps of bucket indices, in as many words as the encoder needs.

A device visits at most ``n_buckets`` values (101 by default, two words), so the
set of buckets that followed a bucket fits in a few longs. Words hold 62 bits
each so every value stays positive and no arithmetic step can overflow. The
running union is a ``bit_or`` aggregate, which Spark evaluates incrementally over
growing window frames and merges map-side in group-bys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 62  # bits per word


def n_words(n_buckets: int) -> int:
    return -(-n_buckets // WORD)


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _shl(x: Column, n: Column | int) -> Column:
    """``x << n`` with a column shift count."""
    return F.call_function("shiftleft", x, n if isinstance(n, Column) else F.lit(n))


def bit_word(b: str | Column, word: int) -> Column:
    """Word ``word`` of the set that holds bucket ``b`` alone (0 when b is null or elsewhere)."""
    b, low = _c(b), word * WORD
    return (F.when((b >= low) & (b < low + WORD), _shl(F.lit(1).cast("long"), b - low))
             .otherwise(F.lit(0).cast("long")))


def _up_to(b: Column, word: int) -> Column:
    """Mask of the buckets <= b in a word."""
    one, low = F.lit(1).cast("long"), word * WORD
    full = _shl(one, F.lit(WORD)) - one
    return (F.when(b >= low + WORD - 1, full).when(b < low, F.lit(0).cast("long"))
             .otherwise(_shl(one, b - low + 1) - one))


def _highest(x: Column) -> Column:
    """Index of the highest set bit of a positive long."""
    return F.length(F.bin(x)) - 1


def _lowest(x: Column) -> Column:
    """Index of the lowest set bit of a positive long."""
    return F.bit_count(x.bitwiseXOR(x - 1)) - 1


def nearest_at_or_below(words: list[Column], b: Column) -> Column:
    """Largest member <= b, or null."""
    found = [w.bitwiseAND(_up_to(b, k)) for k, w in enumerate(words)]
    return F.coalesce(*[F.when(x != 0, _highest(x) + k * WORD) for k, x in reversed(list(enumerate(found)))])


def nearest_above(words: list[Column], b: Column) -> Column:
    """Smallest member > b, or null."""
    found = [w.bitwiseAND(F.bitwise_not(_up_to(b, k))) for k, w in enumerate(words)]
    return F.coalesce(*[F.when(x != 0, _lowest(x) + k * WORD) for k, x in enumerate(found)])


def covered_bits(words: list[Column], b: Column, w: int) -> Column:
    """How many of the bits ``b .. b+w-1`` are switched on by the codes of
    the set's members (member ``s`` switches on ``s .. s+w-1``).

    Members at or below ``b`` cover ``[b, s_lo+w-1]`` at best via the nearest
    one; members above cover ``[s_up, b+w-1]`` at best via the nearest one.
    """
    s_lo = nearest_at_or_below(words, b)
    s_up = nearest_above(words, b)
    zero = F.lit(0)
    len_lo = F.coalesce(F.greatest(zero, s_lo + w - b), zero)
    len_up = F.coalesce(F.greatest(zero, b + w - s_up), zero)
    overlap = F.coalesce(F.greatest(zero, s_lo + w - s_up), zero)
    return len_lo + len_up - overlap
