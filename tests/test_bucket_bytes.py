"""What a change of kept tables moves."""

import os

from pyspark.sql import functions as F

from lendmill.plans.mart_upkeep import MartUpkeep
from lendmill.sources.buckets import BucketTable
from test_upkeep import day, frames, same_marts

SUMS = "k long, n_rows long"


def test_changes_that_are_merged_are_summed_on_the_way_and_not_kept(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path / "t"), "k", SUMS, 4)
    ones = spark.range(100).select((F.col("id") % 7).alias("k"), F.lit(1).cast("long").alias("n_rows"))
    t.merge(t.touched(ones), 1, ones, "k")
    back = ones.filter("k < 3").withColumn("n_rows", -F.col("n_rows"))
    t.merge(t.touched(back), 2, back, "k")
    assert sorted(map(tuple, t.read().collect())) == [(3, 14), (4, 14), (5, 14), (6, 14)]
    assert not os.path.exists(tmp_path / "t" / "changes")
    t.merge(t.touched(back), 2, back, "k")  # made already
    assert t.changed() == 2 and t.read().count() == 4


def test_a_day_keeps_no_copy_of_what_raw_tables_hold(spark, tmp_path):
    first = day(20)
    raw = frames(spark, first)
    upkeep = MartUpkeep(spark, str(tmp_path), raw, buckets=2)
    upkeep.apply({n: (df, None) for n, df in raw.items()}, 1)
    same_marts(upkeep, first and raw)
    kept = [n for n in os.listdir(tmp_path / "silver") if (tmp_path / "silver" / n / "changes").exists()]
    assert sorted(kept) == ["customer_flags", "customer_sums"]


def test_rows_of_few_buckets_are_written_where_they_were_summed(spark, tmp_path, monkeypatch):
    hints, whole = [], type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, *a: (hints.append(a), whole(df, *a))[1])
    ones = spark.range(50).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("n_rows"))
    few, many = (BucketTable(spark, str(tmp_path / f"{n}"), "k", SUMS, n) for n in (4, 4096))
    few.add(ones, 1, "k")
    assert not hints and few.read().count() == 50
    many.add(ones, 1, "k")
    assert hints == [("rebalance", "_bucket")] and many.read().count() == 50
