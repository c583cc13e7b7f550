"""Order-independent money arithmetic.

A sum of doubles depends on the order in which tasks deliver their parts, so two
runs of the same job can differ in the last digit. Amounts are summed as decimals
instead, so the result is the same for every partitioning. An amount that the
decimal does not hold exactly (NaN, an infinite one, one with more than ten
decimals or 18 integer digits) is summed as a double beside them; no amount is
rounded and no group changes its way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,10)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money_sum(amount: Column | str) -> Column:
    """Sum as double: exact decimals plus the doubles that are none."""
    amount = _col(amount)
    # 0 * NaN and 0 * inf are NaN, so this is the plain test for "finite".
    decimal = F.when(amount * 0 == 0, amount).try_cast(EXACT)
    exact = F.when(decimal.cast("double") == amount, decimal)
    rest = F.when(exact.isNull(), amount.cast("double"))
    of_exact, of_rest = F.sum(exact).cast("double"), F.sum(rest)
    return F.coalesce(of_exact + of_rest, of_exact, of_rest)


def money_avg(amount: Column | str) -> Column:
    """Exact sum divided by the number of amounts; null for an empty group."""
    amount = _col(amount)
    return F.try_divide(money_sum(amount), F.count(amount))


def cents(value: Column) -> Column:
    """Round half up to two decimals on the decimal value, not on its binary double."""
    return F.round(value.cast("decimal(38,10)"), 2).cast("double")
