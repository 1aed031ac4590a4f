"""Row predicates used by the quality checks. NULL input gives NULL: not an issue."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def out_of_range(c: Column, low, high) -> Column:
    return ~c.between(low, high)


def bad_format(c: Column, length: int, pattern: str) -> Column:
    """Wrong length or not matching the (anchored) pattern."""
    return (F.length(c) != length) | ~c.rlike(pattern)


def is_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def not_accepted(c: Column, values: Iterable) -> Column:
    return ~c.isin(list(values))


def hits(predicate: Column) -> Column:
    """How many rows meet the predicate; zero, not NULL, on an empty table."""
    return F.count_if(F.coalesce(predicate, F.lit(False)))
