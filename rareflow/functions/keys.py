"""Reproducible pseudo-random row order."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SPACE = 4294967296
#: Odd factors below 2**31, so that products of 32-bit numbers fit a long, and shifts.
ROUNDS = ((1103515245, 15), (2146121005, 13), (1540483477, 16))
SEED_STEP = 2654435769
#: From the seed of a normal draw's radius to that of its angle.
ANGLE = 50_000


def perm_key(row_id, seed: int = 42) -> Column:
    """Integer key of ``row_id``: an order that looks random and never changes.

    Rounds of multiplying and xor-shifting 32 bits, with the seed mixed into each, so
    that different seeds give unrelated orders. Ids of one 32-bit range have different keys.
    """
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    key = (row_id + F.lit(seed * SEED_STEP)) % F.lit(KEY_SPACE)
    for factor, shift in ROUNDS:
        key = (key * F.lit(factor) + F.lit(seed * SEED_STEP % KEY_SPACE)) % F.lit(KEY_SPACE)
        key = key.bitwiseXOR(F.shiftright(key, shift))
    return key


def unit_draw(row_id, seed: int = 42) -> Column:
    """The permutation key scaled to [0, 1)."""
    return perm_key(row_id, seed) / F.lit(float(KEY_SPACE))


def normal_draw(row_id, seed: int = 42) -> Column:
    """A standard normal number from two permutation keys of the row (Box and Muller): the same in any partition."""
    radius = F.sqrt(F.lit(-2.0) * F.ln((perm_key(row_id, seed) + F.lit(0.5)) / F.lit(float(KEY_SPACE))))
    return radius * F.cos(F.lit(2.0 * math.pi) * unit_draw(row_id, seed + ANGLE))
