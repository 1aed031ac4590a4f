"""Changes as signed rows, and the sums, counts and maxima they move.

A row that came counts 1, a row that went counts -1 (``SIGN``). Sums and counts of signed
rows add up to those of the rows that are left. A maximum does not; it is the largest of
the values that are left, so values are counted one by one, which is a short list per key
for whole days and flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGN = "_sign"

#: Sums are kept this wide, whatever the width of what is added.
_WIDE = "decimal(38,{scale})"


def signed(came: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """Rows that came and rows that went."""
    rows = came.withColumn(SIGN, F.lit(1).cast("long"))
    if gone is None:
        return rows
    return rows.unionByName(gone.withColumn(SIGN, F.lit(-1).cast("long")))


def wide(kind: str) -> str:
    """The type a sum of values of a type is kept in."""
    if kind.startswith("decimal"):
        return _WIDE.format(scale=kind.rstrip(")").split(",")[1])
    return "double" if kind in ("double", "float") else "bigint"


def _value(c: str, kind: str) -> Column:
    return F.coalesce(F.col(c) * F.col(SIGN), F.lit(0).cast(kind))


def _known(c: str) -> Column:
    return F.when(F.col(c).isNotNull(), F.col(SIGN)).otherwise(0)


def signed_sums(rows: DataFrame, key: str, sums: dict[str, str] | None = None) -> DataFrame:
    """Per key ``n_rows``, and per sum its value and how many values it has (``name__n``).

    ``sums`` maps result names to columns. Rows without a key are left out.
    """
    kinds = dict(rows.dtypes)
    out = [F.sum(SIGN).alias("n_rows")]
    for name, c in (sums or {}).items():
        out.append(F.sum(_value(c, kinds[c])).cast(wide(kinds[c])).alias(name))
        out.append(F.sum(_known(c)).alias(f"{name}__n"))
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(*out)


def signed_terms(rows: DataFrame, key: str, sums: dict[str, str] | None = None) -> DataFrame:
    """What each row adds to ``signed_sums``, not summed yet."""
    kinds = dict(rows.dtypes)
    out = [F.col(key), F.col(SIGN).alias("n_rows")]
    for name, c in (sums or {}).items():
        out.append(_value(c, kinds[c]).cast(wide(kinds[c])).alias(name))
        out.append(_known(c).cast("long").alias(f"{name}__n"))
    return rows.filter(F.col(key).isNotNull()).select(*out)


def signed_values(rows: DataFrame, key: str, column: str) -> DataFrame:
    """Per key and value of a column ``n_rows``; missing keys and values are left out."""
    return value_terms(rows, key, column).groupBy(key, "value").agg(F.sum("n_rows").alias("n_rows"))


def value_terms(rows: DataFrame, key: str, column: str) -> DataFrame:
    """What each row adds to ``signed_values``, not summed yet."""
    known = rows.filter(F.col(key).isNotNull() & F.col(column).isNotNull())
    return known.select(key, F.col(column).alias("value"), F.col(SIGN).alias("n_rows"))


def counted(rows: DataFrame) -> DataFrame:
    """Signed rows as changes of a table that adds them up: ``n_rows`` is 1 or -1."""
    return rows.withColumnRenamed(SIGN, "n_rows")


def repeated(rows: DataFrame) -> DataFrame:
    """Each row as often as ``n_rows`` says."""
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))).alias("_time")
    columns = [c for c in rows.columns if c != "n_rows"]
    return rows.filter("n_rows > 0").select(*columns, times).drop("_time")


def known_sum(name: str) -> Column:
    """A sum as SQL has it: missing where no value went in."""
    return F.when(F.col(f"{name}__n") != 0, F.col(name))


def largest(values: DataFrame, key: str, name: str) -> DataFrame:
    """Per key the largest value that is left."""
    return values.filter("n_rows > 0").groupBy(key).agg(F.max("value").alias(name))
