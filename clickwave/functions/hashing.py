"""Bitmap offsets for distinct counting.

The offset of a value is the polynomial string hash ``h = h*seed + char`` over
its characters, kept modulo ``2**cap_bits``.  Masking at every step gives the
same answer as masking once at the end (both are arithmetic modulo a power of
two) and keeps the intermediate values far from overflow, which matters with
ANSI arithmetic on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the bitmap: 2^29 bits (64 MB) per window, seed 61.
BITMAP_BITS = 29
HASH_SEED = 61


def polynomial_hash(s: Column, seed: int = HASH_SEED, cap_bits: int = BITMAP_BITS) -> Column:
    mask = (1 << cap_bits) - 1
    chars = F.split(s, "")
    return F.aggregate(
        chars, F.lit(0).cast("bigint"),
        lambda acc, ch: (acc * F.lit(seed) + F.ascii(ch).cast("bigint")).bitwiseAND(F.lit(mask)),
    )


def bitmap_offset(value: Column, seed: int = HASH_SEED, cap_bits: int = BITMAP_BITS) -> Column:
    """Bit position of a value (its decimal text for numbers) in the window bitmap."""
    return polynomial_hash(value.cast("string"), seed, cap_bits)
