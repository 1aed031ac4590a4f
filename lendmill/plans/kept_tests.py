"""Column tests kept up by what changed: the report of a day from its own rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.operators.increments import SIGN, signed
from lendmill.operators.quality import ColumnTest, row_rule
from lendmill.operators.relations import union_all
from lendmill.sources.buckets import BUCKETS, BucketTable, side_by_side

_COPIES = "copies"


class KeptTests:
    """Failures of column tests over tables that change by signed rows.

    Row-wise failures add up. For every tested or referred-to key a table in buckets holds how many rows
    have it and how many rows of each referring table point at it; of the keys that a change touches
    the state before and after tells new repeats and orphans, and those that were mended. So
    a change reads its own rows and the buckets of its keys, whatever the tables hold.
    ``like`` has the tables' schemas, as empty or any frames.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        tests: list[ColumnTest],
        like: dict[str, DataFrame],
        buckets: int = BUCKETS,
    ):
        self.spark, self.path, self.tests = spark, path, tests
        self.by_row = [t for t in tests if t.kind in ("not_null", "accepted_values")]
        self.keys: dict[tuple[str, str], BucketTable] = {}
        self.unique: dict[tuple[str, str], ColumnTest] = {}
        self.refers: dict[tuple[str, str], list[ColumnTest]] = {}
        for t in tests:
            if t.kind == "unique":
                self.unique[t.table, t.column] = t
            elif t.kind == "relationships":
                self.refers.setdefault((t.to_table, t.to_column), []).append(t)
        for at in dict.fromkeys([*self.unique, *self.refers]):
            kind = like[at[0]].schema[at[1]].dataType.simpleString()
            counts = [_COPIES, *[t.name for t in self.refers.get(at, [])]]
            schema = ", ".join([f"key {kind}", "n_rows long", *[f"{c} long" for c in counts]])
            self.keys[at] = BucketTable(spark, f"{path}/keys/{at[0]}.{at[1]}", "key", schema, buckets)

    def apply(self, changes: dict[str, tuple[DataFrame, DataFrame | None]], number: int) -> None:
        """Take in a numbered change: per table the rows that came and those that went."""
        rows = {n: signed(came, gone) for n, (came, gone) in changes.items()}
        moved = [m for m in (self._moved_rows(rows[n], n) for n in rows) if m is not None]

        def count(at: tuple[str, str], change: DataFrame) -> DataFrame:
            self.keys[at].add(change, number, "key")
            return self._moved_keys(at, self.keys[at], number)

        found = {at: self._key_changes(at, rows) for at in self.keys}
        moved += side_by_side([lambda at=at, c=c: count(at, c) for at, c in found.items() if c is not None])
        if moved:
            found = union_all(moved).groupBy("test_name").agg(F.sum("failures").alias("failures"))
            found.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/added/change={number}")

    def _moved_rows(self, rows: DataFrame, table: str) -> DataFrame | None:
        """By how much the row-wise failures of a table change."""
        mine = [t for t in self.by_row if t.table == table]
        if not mine:
            return None
        sums = [F.coalesce(F.sum(F.when(row_rule(t), F.col(SIGN))), F.lit(0)).alias(t.name) for t in mine]
        return _long(rows.agg(*sums), [t.name for t in mine])

    def _key_changes(self, at: tuple[str, str], rows: dict[str, DataFrame]) -> DataFrame | None:
        """Per key what its counts change by; None where no table of it changed."""
        counts = [_COPIES, *[t.name for t in self.refers.get(at, [])]]

        def counted(df: DataFrame, key: str, name: str) -> DataFrame:
            marks = [(F.col(SIGN) if c == name else F.lit(0)).cast("long").alias(c) for c in counts]
            return df.select(F.col(key).alias("key"), *marks)

        parts = [counted(rows[at[0]], at[1], _COPIES)] if at[0] in rows else []
        parts += [
            counted(rows[t.table], t.column, t.name) for t in self.refers.get(at, []) if t.table in rows
        ]
        if not parts:
            return None
        summed = union_all(parts).filter("key IS NOT NULL").groupBy("key").agg(
            *[F.sum(c).alias(c) for c in counts]
        )
        # counts that are kept are never negative, so a key without any has a sum of 0
        return summed.withColumn("n_rows", sum((F.col(c) for c in counts), F.lit(0)).cast("long"))

    def _moved_keys(self, at: tuple[str, str], table: BucketTable, number: int) -> DataFrame:
        """Failures of the touched keys now, less those before."""
        touched = table.changes(number).select("key")
        only = table.touched(touched)
        failures: dict[str, Column] = {t.name: F.when(F.col(_COPIES) == 0, F.col(t.name)) for t in self.refers.get(at, [])}
        if at in self.unique:
            failures[self.unique[at].name] = (F.col(_COPIES) > 1).cast("long")

        def state(before: int | None, sign: int) -> DataFrame:
            rows = table.read(only, before).join(touched, "key", "left_semi")
            sums = [F.coalesce(F.sum(f), F.lit(0)).alias(n) for n, f in failures.items()]
            return _long(rows.agg(*sums), list(failures), sign)

        return state(None, 1).unionByName(state(number, -1))

    def report(self) -> DataFrame:
        """One row per test, as ``run_tests`` gives it."""
        described = [
            F.struct(F.lit(t.name).alias("test_name"), F.lit(t.table).alias("table_name"), F.lit(t.column).alias("column_name"))
            for t in self.tests
        ]
        every = self.spark.range(1).select(F.inline(F.array(*described)))
        added = self.spark.read.schema("test_name string, failures long").parquet(f"{self.path}/added")
        total = added.groupBy("test_name").agg(F.sum("failures").alias("failures"))
        found = every.join(F.broadcast(total), "test_name", "left")  # a row per test
        found = found.withColumn("failures", F.coalesce("failures", F.lit(0)))
        return found.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def _long(wide: DataFrame, names: list[str], sign: int = 1) -> DataFrame:
    rows = [
        F.struct(F.lit(n).alias("test_name"), (F.col(n) * sign).cast("long").alias("failures")) for n in names
    ]
    return wide.select(F.inline(F.array(*rows)))
