"""Snapshots, upserts and published runs."""

import datetime as dt

from conftest import rows

from lendmill.operators import history as H
from lendmill.sources import warehouse as WH

T1, T2, T3 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1), dt.datetime(2026, 3, 1)


def people(spark, data):
    return spark.createDataFrame(data, "id int, name string, city string, score int")


def test_snapshot_steps(spark):
    check = ["city", "score"]
    dim = H.scd2_apply(None, people(spark, [(1, "a", "x", 1), (2, "b", None, 2), (3, "c", "z", 3)]), "id", check, T1)
    later = people(spark, [(1, "a", "y", 1), (2, "RENAMED", None, 2), (4, "d", "w", 4)])
    dim = H.scd2_apply(dim, later, "id", check, T2)
    expected = [
        (1, "a", "x", 1, T1, T2, False),
        (1, "a", "y", 1, T2, None, True),
        (2, "b", None, 2, T1, None, True),
        (3, "c", "z", 3, T1, None, True),
        (4, "d", "w", 4, T2, None, True),
    ]
    assert rows(dim) == sorted(expected, key=repr)
    again = H.scd2_apply(dim, later, "id", check, T3)
    assert rows(again) == rows(dim)
    back = H.scd2_apply(again, people(spark, [(1, "a", "x", 1)]), "id", check, T3)
    versions = rows(back.filter("id = 1").select("city", "valid_from", "valid_to"))
    assert versions == sorted([("x", T1, T2), ("y", T2, T3), ("x", T3, None)], key=repr)


def test_changes_to_and_from_missing_values_count(spark):
    dim = H.scd2_apply(None, people(spark, [(1, "a", None, 1), (2, "b", "x", 1)]), "id", ["city"], T1)
    later = people(spark, [(1, "a", "x", 1), (2, "b", None, 1)])
    found = H.detect_changes(dim, later, "id", ["city"]).select("change")
    assert rows(found) == [("changed",), ("changed",)]


def test_versions_do_not_overlap_and_one_is_open(spark):
    check, dim = ["city"], None
    for step, city in enumerate("xyxxzy"):
        source = people(spark, [(k, "n", city if k % 2 else "q", 1) for k in range(6)])
        dim = H.scd2_apply(dim, source, "id", check, T1 + dt.timedelta(days=step))
        dim = dim.sparkSession.createDataFrame(dim.collect(), dim.schema)
    by_key = {}
    for r in dim.collect():
        by_key.setdefault(r["id"], []).append((r["valid_from"], r["valid_to"]))
    for spans in by_key.values():
        spans.sort()
        assert [e is None for _, e in spans] == [False] * (len(spans) - 1) + [True]
        assert all(spans[i][1] == spans[i + 1][0] for i in range(len(spans) - 1))
    assert len(by_key[1]) == 5 and len(by_key[2]) == 1


def test_upsert_takes_the_newest_whatever_the_order(spark):
    kind = "id int, status string, ts int"
    base = spark.createDataFrame([(1, "old", 5), (2, "old", 5), (3, "old", 5)], kind)
    batch = spark.createDataFrame([(1, "new", 9), (2, "late", 1), (3, "tie", 5), (4, "first", 1)], kind)
    got = rows(H.upsert_latest(base, batch, "id", "ts"))
    assert got == [(1, "new", 9), (2, "old", 5), (3, "tie", 5), (4, "first", 1)]
    again = H.upsert_latest(H.upsert_latest(base, batch, "id", "ts"), batch, "id", "ts")
    assert rows(again) == got


def test_latest_row_prefers_a_known_time(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 3), (2, "c", None)], "id int, v string, ts int")
    assert rows(H.latest_per_key(df, "id", "ts")) == [(1, "b", 3), (2, "c", None)]


def test_layers():
    assert WH.target_path("/r/", "dim", " gold ") == "/r/gold/dim"
    assert WH.target_path("/r", "t") == "/r/silver/t"


def test_stored_versions(spark, tmp_path):
    path, check = str(tmp_path / "dim"), ["city"]

    def step(data, at):
        known = WH.read_versions(spark, path, closed=False)
        return H.scd2_step(known, people(spark, data), "id", check, at)

    assert WH.read_versions(spark, path) is None
    assert WH.publish_versions(step([(1, "a", "x", 1), (2, "b", "x", 1)], T1), path) == 1
    # Half a run that never got recorded does not count, and is overwritten.
    step([(1, "a", "LOST", 1)], T2).write.partitionBy("is_current").parquet(f"{path}/versions/run=2")
    assert WH.read_versions(spark, path).count() == 2
    assert WH.publish_versions(step([(1, "a", "y", 1)], T2), path) == 2
    assert WH.publish_versions(step([(1, "a", "z", 1)], T3), path) == 3
    got = WH.read_versions(spark, path).select("id", "city", "valid_from", "valid_to", "is_current")
    expected = [(1, "x", T1, T2, False), (1, "y", T2, T3, False), (1, "z", T3, None, True), (2, "x", T1, None, True)]
    assert rows(got) == sorted(expected, key=repr)
    WH.register_view(got, "dim_now")
    assert spark.sql("SELECT count(*) FROM dim_now WHERE is_current").first()[0] == 2
