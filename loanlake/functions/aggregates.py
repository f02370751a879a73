"""Aggregates whose null handling differs from the Spark built-ins."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def n_unique(c) -> Column:
    """Exact distinct count in which null counts as one more value."""
    c = _col(c)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def sum0(c) -> Column:
    """Sum that is 0 (not null) when there is nothing to add."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def ratio(a, b) -> Column:
    """Double division; null when the denominator is zero."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))
