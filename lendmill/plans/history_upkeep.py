"""A customer history that takes rows in any order: what was seen, and the versions that follow from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.operators.history import IS_CURRENT, VALID_FROM, VALID_TO, latest_per_key, scd2_insert
from lendmill.sources.buckets import BUCKETS, BucketTable


class HistoryTable:
    """Versions of ``check_cols`` per key, kept in buckets beside every row seen.

    A delivery rewrites the buckets its keys fall into, and in them makes versions again only
    around its own instants. Of rows of one key and instant the largest ``tiebreak`` counts,
    whatever came first. Rows without an instant cannot be placed and are left out; a
    missing key is a key.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        like: DataFrame,
        key: str,
        check_cols: list[str],
        ts: str,
        tiebreak: str,
        buckets: int = BUCKETS,
    ):
        self.key, self.check_cols, self.ts, self.tiebreak = key, check_cols, ts, tiebreak
        seen = like.select(key, *check_cols, ts, tiebreak).schema
        at = seen[ts].dataType
        columns = [seen[c] for c in (key, *check_cols)]
        columns += [T.StructField(VALID_FROM, at), T.StructField(VALID_TO, at)]
        versions = T.StructType([*columns, T.StructField(IS_CURRENT, T.BooleanType())])
        self.seen = BucketTable(spark, f"{path}/seen", key, seen, buckets)
        self.versions = BucketTable(spark, f"{path}/versions", key, versions, buckets)

    def deliver(self, rows: DataFrame, number: int) -> None:
        """Take in a numbered delivery; one that died half-way is given again under its number."""
        rows = rows.select(self.key, *self.check_cols, self.ts, self.tiebreak)
        rows = rows.filter(F.col(self.ts).isNotNull())
        instant = [self.key, self.ts]
        self.seen.rewrite(
            rows, number, lambda old, new: latest_per_key(old.unionByName(new), instant, self.tiebreak)
        )
        came = self.seen.changes(number)

        def inserted(old: DataFrame, came: DataFrame) -> DataFrame:
            seen = self.seen.read(self.seen.touched(came))
            return scd2_insert(old, seen, came, self.key, self.check_cols, self.ts)

        self.versions.rewrite(came, number, inserted)

    def read(self) -> DataFrame:
        return self.versions.read()
