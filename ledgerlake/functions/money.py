"""Sums of money that do not depend on the order in which rows arrive."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(c: Column) -> Column:
    """An amount in whole cents, half a cent rounded away from zero; NULL where it does not fit."""
    return c.try_cast(MONEY)


def total(c: Column) -> Column:
    """Exact decimal sum of a DOUBLE amount."""
    return F.sum(money(c))


def total_if(condition: Column, c: Column) -> Column:
    return F.sum(F.when(condition, money(c)).otherwise(F.lit(0).cast(MONEY)))


def as_double(c: Column) -> Column:
    return c.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE quotient; NULL where the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def or_zero(c: Column) -> Column:
    """DOUBLE with NULL read as zero."""
    return F.coalesce(c.cast("double"), F.lit(0.0))
