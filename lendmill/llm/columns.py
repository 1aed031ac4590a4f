"""Column and table helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.session import fresh_path

#: A word is a run of anything but space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | Column) -> Column:
    """The words of a text in order; a null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP, -1), "")


def n_words(text: str | Column) -> Column:
    """Number of words as long; null text: 0."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hidden(df: DataFrame) -> DataFrame:
    """The frame under names that no other column can clash with (``in_0`` ...)."""
    return df.toDF(*[f"in_{i}" for i in range(len(df.columns))])


def position(df: DataFrame, name: str) -> str:
    """The hidden name of a column."""
    return f"in_{df.columns.index(name)}"


def shown(df: DataFrame, names: list[str], results: dict[str, str]) -> DataFrame:
    """Input columns under their own names, then ``results`` (new name -> column).

    A result replaces an input column of the same name.
    """
    taken = {n.lower() for n in results}
    kept = [F.col(f"in_{i}").alias(n) for i, n in enumerate(names) if n.lower() not in taken]
    return df.select(*kept, *[F.col(c).alias(n) for n, c in results.items()])


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, lineage cut.

    Parquet refuses columns of no type; they are kept as empty strings.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    kinds = dict(df.dtypes)
    df.select(
        *[F.col(c).cast("string").alias(c) if kinds[c] == "void" else F.col(c) for c in df.columns]
    ).write.parquet(path)
    return spark.read.parquet(path)
