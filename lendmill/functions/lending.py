"""Column rules of the lending business."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendmill import fixed_values as V


def product_segment(product_type: Column) -> Column:
    """Product line by prefix, whatever the case; anything else is Other."""
    (first, label), *more = V.PRODUCT_PREFIXES
    rule = F.when(product_type.ilike(f"{first}%"), label)
    for prefix, label in more:
        rule = rule.when(product_type.ilike(f"{prefix}%"), label)
    return rule.otherwise(V.PRODUCT_OTHER)


def dpd_bucket(dpd: Column) -> Column:
    """Days-past-due bucket; the rules apply in order.

    A missing value meets no rule and lands in the last bucket; a negative
    one meets the first edge.
    """
    rule = F.when(dpd == 0, V.DPD_CURRENT)
    for edge, label in V.DPD_EDGES:
        rule = rule.when(dpd <= edge, label)
    return rule.otherwise(V.DPD_LAST)
