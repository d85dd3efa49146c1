"""Exact money arithmetic: sums run over wide decimals, so they lose nothing and do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(38,10)"


def exact(amount: Column) -> Column:
    """An amount with up to ten decimals. Not-a-number and infinity are no amounts and become NULL."""
    return amount.try_cast(MONEY)


def finite(amount: Column) -> Column:
    """The amount as it is, NULL where :func:`exact` has none, so that all aggregates leave out the same rows."""
    return F.when(exact(amount).isNotNull(), amount.cast("double"))


def as_amount(total: Column) -> Column:
    return total.cast("double")


def average_half_up(total: Column, count: Column) -> Column:
    """Average of an exact sum, rounded half away from zero to two digits."""
    return F.round(total / count, 2).cast("double")
