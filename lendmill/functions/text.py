"""Tokens of a text: lower case, split on anything but letters and digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(c: Column) -> Column:
    """All tokens in order; empty array for empty text, NULL for NULL."""
    return F.array_remove(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), "")
