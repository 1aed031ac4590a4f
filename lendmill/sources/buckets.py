"""Tables kept in hash buckets of a key: a change rewrites the buckets its keys fall into, no others."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.operators.history import latest_per_key

#: Buckets of a table; tables of one key and number of buckets line up.
BUCKETS = 256

#: A run may have so many files; where every task of a shuffle writing to every bucket makes more, rows are
#: shuffled once again, to one place per bucket.
FILES = 2048

_BUCKET = "_bucket"
_PUBLISHED = "run long, change long"


def bucket_of(key: str | Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class BucketTable:
    """Rows under ``path`` in buckets of ``key``.

    A run writes the touched buckets to a folder of its own, then a list of the run that
    each bucket is to be read from, then its number. Readers see the last numbered run and
    open the listed folders only. A job that dies before leaves the run before in force.
    Changes are numbered by the caller, rising; one already made is not made again, so a
    day that died half-way can be run again over several tables.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._known: list[tuple[int, int]] | None = None
        self._listed: dict[int, dict[int, int]] = {}

    def _runs(self) -> list[tuple[int, int]]:
        """(run, change) published so far, in order; a row per run, read once: one writer at a time."""
        if self._known is None:
            try:
                found = self.spark.read.schema(_PUBLISHED).parquet(f"{self.path}/published")
                self._known = sorted((r["run"], r["change"]) for r in found.collect())
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                self._known = []
        return self._known

    def _places(self, before: int | None) -> dict[int, int]:
        """The run each bucket with rows is in: now, or before a numbered change."""
        runs = [run for run, change in self._runs() if before is None or change < before]
        if not runs:
            return {}
        if runs[-1] not in self._listed:
            listed = self.spark.read.schema("bucket int, run long").parquet(f"{self.path}/buckets/run={runs[-1]}")
            self._listed[runs[-1]] = {r["bucket"]: r["run"] for r in listed.collect()}  # a row per bucket
        return self._listed[runs[-1]]

    def changed(self) -> int:
        """Number of the last change made; 0 before the first."""
        return max((change for _, change in self._runs()), default=0)

    def read(self, only: list[int] | None = None, before: int | None = None) -> DataFrame:
        """All rows, or those of some buckets; with ``before`` as they were ahead of that change."""
        places = self._places(before)
        folders = [
            f"{self.path}/rows/run={run}/{_BUCKET}={b}"
            for b, run in sorted(places.items())
            if only is None or b in only
        ]
        if not folders:
            # as a plan that is known to be empty: what is united or joined with it is left out
            none = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
            return self.spark.range(1).filter(F.lit(False)).select(none)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def touched(self, keys: DataFrame) -> list[int]:
        found = keys.select(bucket_of(self.key, self.buckets).alias("b")).distinct().collect()
        return sorted(r["b"] for r in found)  # one per bucket at most

    def rewrite(
        self,
        changes: DataFrame | list[int],
        number: int,
        combine: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None,
    ) -> list[int]:
        """Replace the rows of the buckets that ``changes`` touch by ``combine(rows, changes)``.

        Returns the touched buckets. ``changes`` has the key; it is written once, as it may be
        much work, and combined from there. Without ``combine`` its rows replace those of their keys.
        Where ``combine`` makes whole buckets from other tables, a list of buckets will do: nothing is kept of
        what the change was made of, and ``combine`` gets no changes.
        """
        if self.changed() >= number:
            return []
        run = max((r for r, _ in self._runs()), default=0) + 1
        if isinstance(changes, list):
            touched, changes = changes, None
        else:
            waiting = f"{self.path}/changes/run={run}"
            changes.write.mode("overwrite").option("compression", "zstd").parquet(waiting)
            changes = self.spark.read.schema(changes.schema).parquet(waiting)
            touched = self.touched(changes)
        places = self._places(None)
        if touched:
            new = (combine or self._replaced)(self.read(touched), changes)
            new = new.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
            new = new.withColumn(_BUCKET, bucket_of(self.key, self.buckets))
            rows = f"{self.path}/rows/run={run}"
            if self.buckets * int(self.spark.conf.get("spark.sql.shuffle.partitions")) > FILES:
                new = new.hint("rebalance", _BUCKET)  # a bucket goes to few files, a hot one is split
            new.write.mode("overwrite").option("compression", "zstd").partitionBy(_BUCKET).parquet(rows)
            files = self.spark.read.schema(self.schema).parquet(rows).inputFiles()
            filled = {int(f.rsplit(f"/{_BUCKET}=", 1)[1].split("/")[0]) for f in files if f"/{_BUCKET}=" in f}
            places = {b: r for b, r in places.items() if b not in touched} | dict.fromkeys(filled, run)
        self._note(sorted(places.items()), "bucket int, run long", f"{self.path}/buckets/run={run}", "overwrite")
        self._note([(run, number)], _PUBLISHED, f"{self.path}/published", "append")
        self._known, self._listed[run] = [*self._runs(), (run, number)], places
        return touched

    def merge(self, only: list[int], number: int, changes: DataFrame, *same: str) -> None:
        """``add`` without keeping the changes, whose keys fall into the buckets ``only``: they may be many rows
        per ``same`` and are summed on the way to the rows from before, in one shuffle."""
        self.rewrite(only, number, lambda rows, _: added(rows.unionByName(changes), *same))

    def _note(self, rows: list[tuple[int, int]], schema: str, path: str, mode: str) -> None:
        """A few numbers, as one file."""
        names = T.StructType.fromDDL(schema).names
        pairs = [F.struct(*[F.lit(x).alias(n) for n, x in zip(names, r, strict=True)]) for r in rows]
        noted = F.array(*pairs) if pairs else F.array().cast(f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")
        found = self.spark.range(0, 1, 1, 1).select(F.inline(noted))
        kinds = T.StructType.fromDDL(schema)
        found.select([F.col(f.name).cast(f.dataType) for f in kinds]).write.mode(mode).parquet(path)

    def changes(self, number: int) -> DataFrame:
        """What a numbered change was made of, as written."""
        run = next(r for r, change in self._runs() if change == number)
        return self.spark.read.parquet(f"{self.path}/changes/run={run}")

    def _replaced(self, rows: DataFrame, changes: DataFrame) -> DataFrame:
        return rows.join(changes.select(self.key), self.key, "left_anti").unionByName(changes)

    def upsert(self, batch: DataFrame, number: int, *newest: str) -> list[int]:
        """Per key the row with the largest ``newest`` columns counts, the batch on a tie."""

        def merged(rows: DataFrame, changes: DataFrame) -> DataFrame:
            both = rows.withColumn("_from_batch", F.lit(0)).unionByName(
                changes.withColumn("_from_batch", F.lit(1))
            )
            return latest_per_key(both, self.key, *newest, "_from_batch")

        return self.rewrite(batch.filter(F.col(self.key).isNotNull()), number, merged)

    def add(self, changes: DataFrame, number: int, *same: str) -> list[int]:
        """Sum all columns but ``same`` per ``same``; what adds up to no ``n_rows`` goes."""
        return self.rewrite(changes, number, lambda rows, more: added(rows.unionByName(more), *same))


def added(rows: DataFrame, *same: str) -> DataFrame:
    """Rows of sums added up per ``same``, without those that come to no rows."""
    sums = [
        F.sum(f.name).cast(f.dataType).alias(f.name) for f in rows.schema if f.name not in same
    ]
    return rows.groupBy(*same).agg(*sums).filter("n_rows <> 0")


def side_by_side(steps: list[Callable[[], object]]) -> list:
    """Independent tables are written at the same time."""
    if not steps:
        return []
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]
