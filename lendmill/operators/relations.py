"""Joins between tables and the small relational helpers around them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def zero_filled(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent; a missing key is an orphan."""
    return child.join(parent.select(key), key, "left_anti")


def missing_parent(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key is set but unknown."""
    known = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(known, fk, "left_anti")


def key_usage(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Per key (the missing one included) how many child and parent rows carry it.

    Both sides are stacked and counted together: one shuffle of partial
    counts answers orphan and duplicate questions without a join.
    """
    stacked = child.select(
        F.col(fk).alias("key"), F.lit(1).alias("child"), F.lit(0).alias("parent")
    ).unionByName(
        parent.select(F.col(pk).alias("key"), F.lit(0).alias("child"), F.lit(1).alias("parent"))
    )
    return stacked.groupBy("key").agg(
        F.sum("child").alias("n_child"), F.sum("parent").alias("n_parent")
    )


def count_orphans(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, nulls_count: bool = True
) -> DataFrame:
    """One row: child rows without a parent."""
    lost = F.coalesce(F.col("n_parent"), F.lit(0)) == 0
    if nulls_count:
        lost = lost | F.col("key").isNull()
    else:
        lost = lost & F.col("key").isNotNull()
    usage = key_usage(child, fk, parent, pk)
    return usage.agg(F.coalesce(F.sum(F.when(lost, F.col("n_child"))), F.lit(0)).alias("n_orphans"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: how many keys (not rows) are duplicated."""
    return repeated_keys(df, key).agg(F.count(F.lit(1)).alias("n_duplicate_keys"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
            for name, df in tables.items()
        ]
    )


def sort_desc(df: DataFrame, measure: str, tiebreak: str, nulls_first: bool = False) -> DataFrame:
    """Largest first; equal measures in key order."""
    c = F.col(measure)
    return df.orderBy(c.desc_nulls_first() if nulls_first else c.desc_nulls_last(), tiebreak)


def latest(df: DataFrame, ts: str, n: int, tiebreak: str) -> DataFrame:
    """The n newest rows."""
    return df.orderBy(F.col(ts).desc_nulls_last(), tiebreak).limit(n)
