"""Small predicate helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def distinct_from(left: Column, right: Column) -> Column:
    """Null-safe inequality."""
    return ~left.eqNullSafe(right)


def is_blank(value: Column | str) -> Column:
    return F.trim(F.col(value) if isinstance(value, str) else value) == ""


def in_unit_range(value: str) -> Column:
    """Not null and between 0 and 1."""
    return F.coalesce(F.col(value).between(0, 1), F.lit(False))
