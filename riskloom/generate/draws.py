"""Reproducible random draws: each value depends on seed, row and purpose only.

No generator state is carried from row to row, so any number of tasks draws the same
values, also when one of them runs again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int, row: Column, purpose: str) -> Column:
    """Value in (0, 1) with 53 random bits."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), row, F.lit(purpose)), 11)
    return (bits.cast("double") + 0.5) * (2.0**-53)


def integer(seed: int, row: Column, purpose: str, low: int, high: int) -> Column:
    """Whole number from low to high, both included."""
    return (F.floor(uniform(seed, row, purpose) * (high - low + 1)) + low).cast("long")


def choice(seed: int, row: Column, purpose: str, values: list[str]) -> Column:
    return F.element_at(
        F.array(*[F.lit(v) for v in values]), integer(seed, row, purpose, 1, len(values)).cast("int")
    )


def lognormal(seed: int, row: Column, purpose: str, mean: float, deviation: float) -> Column:
    """exp of a normal draw made from two uniforms (Box and Muller)."""
    radius = F.sqrt(F.log(uniform(seed, row, purpose + "/radius")) * -2.0)
    angle = F.cos(uniform(seed, row, purpose + "/angle") * (2 * math.pi))
    return F.exp(radius * angle * deviation + mean)
