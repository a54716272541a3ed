"""Row predicates used by quality rules, filters and change detection."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.functions.parsing import DIGITS, to_long


def all_of(conditions) -> Column:
    return reduce(and_, conditions)


def is_digits(c: Column) -> Column:
    return c.rlike(DIGITS)


def is_key(c: Column) -> Column:
    """Digits that make a BIGINT; more of them than fit are no key."""
    return is_digits(c) & to_long(c).isNotNull()


def is_present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def in_domain(c: Column, values) -> Column:
    return c.isin(*values)


def matches(c: Column, pattern: str) -> Column:
    return c.rlike(pattern)


def holds(c: Column) -> Column:
    """Three-valued logic reduced to two: an unknown answer counts as a failed rule."""
    return F.coalesce(c, F.lit(False))


def differs(pairs) -> Column:
    """True when any (left, right) pair differs, with NULL equal to NULL."""
    return ~all_of(left.eqNullSafe(right) for left, right in pairs)


def since(c: Column, as_of: Column, *, days: int = 0, months: int = 0) -> Column:
    """The date is no older than the given span before ``as_of``."""
    start = F.add_months(as_of, -months) if months else as_of
    return c >= (F.date_sub(start, days) if days else start)


def complete(df: DataFrame, columns) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return df.dropna(subset=list(columns))
