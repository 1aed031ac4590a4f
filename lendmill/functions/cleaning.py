"""Column helpers for cleaning and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters other than a blank after which a word starts.
_WORD_BREAKS = r"\t\n\r!?@\"^#$&~_,.:;+\-*%/|\\\[\](){}<>"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def title_words(c: Column) -> Column:
    """Capitalise every word; words also start after punctuation.

    Spark's ``initcap`` breaks on blanks only, so text with other breaks is
    taken apart and put together again; plain names keep the cheap path.
    """
    pieces = F.regexp_extract_all(
        F.lower(c), F.lit(f"[^ {_WORD_BREAKS}]+|[ {_WORD_BREAKS}]"), F.lit(0)
    )
    joined = F.array_join(F.transform(pieces, F.initcap), "")
    return F.when(c.rlike(f"[{_WORD_BREAKS}]"), joined).otherwise(F.initcap(c))


def years_between(start: Column, end: Column) -> Column:
    """Calendar-year boundaries crossed, not completed years."""
    return F.year(end) - F.year(start)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def month_start(ts: Column) -> Column:
    """First instant of the month, kept without a time zone."""
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def hours_before(ts: Column, hours: int) -> Column:
    return ts - F.make_interval(hours=F.lit(hours))


def safe_ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part / whole`` rounded once; NULL unless ``whole`` is positive.

    Divided as doubles, because a quotient of wide decimals is cut to six
    digits before it could be rounded; kept as a decimal, so that sums of it
    do not depend on their order.
    """
    ratio = part.cast("double") / whole.cast("double")
    return F.when(whole > 0, F.round(ratio, digits).cast(f"decimal(18,{digits})"))
