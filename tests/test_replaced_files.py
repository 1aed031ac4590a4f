"""Files replaced under their names, whatever the number of files before and after."""

import os

import duckdb
import pytest
from oracle_check import compare
from pyspark.sql import functions as F

from lendmill.plans import registered
from lendmill.plans.registered import ORACLE, QUERIES


def replaced(spark, path, n, parts=1):
    """The query over ``n`` customers against its SQL: what differs, or None."""
    customers = spark.range(0, n, 1, parts).select(
        F.col("id").alias("c_custkey"),
        F.concat(F.lit("Customer#"), "id").alias("c_name"),
        (F.col("id") % 25).cast("int").alias("c_nationkey"),
        (F.col("id") % 9973 / 4 - 999).alias("c_acctbal"),
        F.element_at(F.array(*map(F.lit, ("BUILDING", "MACHINERY", "FURNITURE"))), (F.col("id") % 3 + 1).cast("int"))
        .alias("c_mktsegment"),
    )
    customers.write.parquet(f"{path}/customer.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM read_parquet('{path}/customer.parquet/*.parquet')")
    return compare(spark, con, str(path), QUERIES["replaced_file_loaded"], ORACLE["replaced_file_loaded"])[0]


def contents(path):
    return sorted(open(f"{path}/{f}").read() for f in os.listdir(path) if f.startswith("part-"))


def test_more_rows_than_three_files_hold(spark, tmp_path, monkeypatch):
    numbers, replace = [], registered._replace_files

    def counted(spark, path, by):
        numbers.append((len(contents(path)), len(contents(by))))
        replace(spark, path, by)

    monkeypatch.setattr(registered, "_replace_files", counted)
    assert replaced(spark, tmp_path, 800_000, 4) is None
    (first, second) = numbers
    assert first == second and first[0] == first[1] > 3  # every file gets other rows, none is emptied


@pytest.mark.parametrize("n", [1, 2, 6])
def test_fewer_rows_than_files(spark, tmp_path, n):
    assert replaced(spark, tmp_path, n) is None


@pytest.mark.parametrize(("before", "after"), [(3, 1), (1, 3), (2, 2)])
def test_any_number_of_files_is_replaced(spark, tmp_path, before, after):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    for path, n, text in ((old, before, "old"), (new, after, "new")):
        rows = spark.range(0, n, 1, n).select(F.lit(text).alias("a"), F.col("id").alias("b"))
        rows.write.option("header", "true").csv(path)
    names = {f for f in os.listdir(old) if f.startswith("part-")}
    registered._replace_files(spark, old, new)
    assert names <= set(os.listdir(old))  # every name is kept
    emptied = ["a,b\n"] * (before - after)
    assert contents(old) == sorted(emptied + [f"a,b\nnew,{i}\n" for i in range(after)])
