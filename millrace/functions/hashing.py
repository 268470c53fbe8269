"""Polynomial string hash, folded to a power-of-two range."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the external bitmap: 2^33 bits, multiplier 61.
BITMAP_BITS = 1 << 33
HASH_SEED = 61


def bit_offset(value: Column, bits: int = BITMAP_BITS, seed: int = HASH_SEED) -> Column:
    """``h = h * seed + code`` over the characters, modulo ``bits`` (a power of two).

    The mask is applied at each step: the result is the same and no step can overflow.
    """
    if bits & (bits - 1):
        raise ValueError("bits must be a power of two")
    letters = F.filter(F.split(value, ""), lambda c: c != "")
    return F.aggregate(
        letters, F.lit(0).cast("bigint"),
        lambda h, c: (h * F.lit(seed) + F.ascii(c)).bitwiseAND(F.lit(bits - 1)))
