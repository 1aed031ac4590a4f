"""Tables in buckets, and marts kept up by what changed against marts built anew."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lendmill import schemas
from lendmill.operators import increments as I
from lendmill.operators import staging as S
from lendmill.plans import marts
from lendmill.plans.mart_upkeep import MartUpkeep, newest_rows
from lendmill.sources.buckets import BucketTable, bucket_of

PAIRS = "k long, v string, at int"


def table(spark, tmp_path, **how):
    return BucketTable(spark, str(tmp_path / "t"), "k", PAIRS, **how)


def folders(tmp_path, run):
    path = tmp_path / "t" / "rows" / f"run={run}"
    return sorted(x for x in os.listdir(path) if x.startswith("_bucket=")) if path.exists() else []


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    t = table(spark, tmp_path, buckets=16)
    assert t.read().count() == 0 and t.changed() == 0
    base = spark.createDataFrame([(i, "old", 1) for i in range(200)], PAIRS)
    assert len(t.upsert(base, 1, "at")) == 16
    batch = spark.createDataFrame([(3, "new", 2), (3, "late", 0), (777, "more", 1), (5, "stale", 0)], PAIRS)
    touched = t.upsert(batch, 2, "at")
    wanted = {r["b"] for r in batch.select(bucket_of("k", 16).alias("b")).collect()}
    assert set(touched) == wanted and folders(tmp_path, 2) == sorted(f"_bucket={b}" for b in wanted)
    got = {k: v for k, v, _ in rows(t.read())}
    assert len(got) == 201 and got[3] == "new" and got[777] == "more" and got[5] == "old"
    assert t.upsert(base, 2, "at") == [] and t.read().count() == 201  # made already
    assert t.read(before=2).count() == 200
    assert {r["k"] for r in table(spark, tmp_path, buckets=16).read([touched[0]]).collect()} <= set(got)


def test_a_tie_goes_to_the_batch_and_missing_keys_stay_out(spark, tmp_path):
    t = table(spark, tmp_path, buckets=2)
    t.upsert(spark.createDataFrame([(1, "a", 5), (None, "x", 9)], PAIRS), 1, "at")
    t.upsert(spark.createDataFrame([(1, "b", 5), (2, "c", None)], PAIRS), 2, "at")
    assert rows(t.read()) == [(1, "b", 5), (2, "c", None)]


def test_a_rewrite_that_died_changes_nothing(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path, buckets=4)
    t.upsert(spark.createDataFrame([(i, "old", 1) for i in range(20)], PAIRS), 1, "at")
    more = spark.createDataFrame([(i, "new", 2) for i in range(30)], PAIRS)
    with monkeypatch.context() as patched:
        patched.setattr(BucketTable, "_note", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            t.upsert(more, 2, "at")
    again = table(spark, tmp_path, buckets=4)
    assert again.changed() == 1 and {v for _, v, _ in rows(again.read())} == {"old"}
    again.upsert(more, 2, "at")
    assert again.read().count() == 30 and {v for _, v, _ in rows(again.read())} == {"new"}


def test_buckets_that_run_empty(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path / "t"), "k", "k long, n_rows long", 4)
    change = lambda *r: spark.createDataFrame(list(r), "k long, n_rows long")
    t.add(change((1, 2), (2, 1), (3, 1)), 1, "k")
    t.add(change((1, -2), (2, -1), (3, 1)), 2, "k")
    assert rows(t.read()) == [(3, 2)]
    t.add(change((3, -2)), 3, "k")
    t.add(change(), 4, "k")
    assert rows(t.read()) == [] and t.changed() == 4
    t.add(change((9, 1)), 5, "k")
    assert rows(t.read()) == [(9, 1)]


def test_signed_sums_and_maxima(spark):
    came = spark.createDataFrame([("a", 5, 1), ("a", None, 9), ("b", 2, 2), (None, 7, 7)], "k string, x int, y int")
    gone = spark.createDataFrame([("a", 5, 1), ("b", 2, 2)], "k string, x int, y int")
    sums = I.signed_sums(I.signed(came, gone), "k", {"x": "x"})
    got = {r["k"]: (r["n_rows"], r["x"], r["known"]) for r in sums.withColumn("known", I.known_sum("x")).collect()}
    assert got == {"a": (1, 0, None), "b": (0, 0, None)}
    values = I.signed_values(I.signed(came, gone), "k", "y")
    assert rows(I.largest(values, "k", "top")) == [("a", 9)]


# ---- marts ----------------------------------------------------------------------------

AT = dt.datetime(2026, 1, 1)


def day(n=40, loaded=AT):
    """Raw rows of all five tables; a third of the repayments belong to one loan."""
    money, when = Decimal, dt.date(2025, 2, 1)
    return {
        "raw_customers": [
            (f"C{i}", f"{i:016d}", None, "budi", "M", dt.date(1990, 1, 1), "Bali", "x", "SMB", 700 + i, money(5), "0", "e", AT, AT, loaded)
            for i in range(n // 4)
        ],
        "raw_loans": [
            (f"L{i}", f"C{i % 7}" if i % 11 else None, "SMB x", money(100), 12, 1.5, when, "LANCAR", i % 120, i % 5 == 0 and 1 or 0, money(i), AT, loaded)
            for i in range(n)
        ],
        "raw_repayments": [
            (f"R{i}", f"L{i % n if i % 3 else 1}", when, when + dt.timedelta(i % 50), money(10), money(i) if i % 4 else None, i % 2, loaded)
            for i in range(3 * n)
        ],
        "raw_savings": [
            (f"A{i}", f"C{i % 9}" if i % 8 else None, "TABUNGAN", money(i) if i % 3 else None, 1.0, when, "ACTIVE", loaded)
            for i in range(n // 2)
        ],
        "raw_transactions": [
            (f"T{i}", f"A{i % 25}" if i % 10 else None, "FEE", "VA", money(i) if i % 6 else None, AT, loaded) for i in range(2 * n)
        ],
    }


def frames(spark, content):
    out = {}
    for name, (_, schema) in schemas.RAW_TABLES.items():
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        out[name] = spark.createDataFrame(content.get(name, []), f"{kinds}, _loaded_at timestamp_ntz")
    return out


def rebuilt(raw):
    """Both marts from all rows that count."""
    loans = S.stg_loans(newest_rows(raw["raw_loans"].filter("loan_id IS NOT NULL"), "loan_id"))
    loan_mart = marts.mart_loan_performance(loans, S.stg_repayments(raw["raw_repayments"]))
    people = S.stg_customers(raw["raw_customers"], "2026-06-30")
    savings, txn = S.stg_savings(raw["raw_savings"]), S.stg_transactions(raw["raw_transactions"])
    return loan_mart, marts.mart_customer_360(people, loans, savings, txn)


def same_marts(upkeep, raw):
    loan_mart, customer_mart = rebuilt(raw)
    for mine, theirs in ((upkeep.loan_mart(), loan_mart), (upkeep.customer_mart("2026-06-30"), customer_mart)):
        assert [(f.name, f.dataType) for f in mine.schema] == [(f.name, f.dataType) for f in theirs.schema]
        assert rows(mine) == rows(theirs)


def later(rows_, change):
    """The rows with a later load time, changed by position."""
    return [tuple(change.get(i, v) for i, v in enumerate(r[:-1])) + (AT + dt.timedelta(1),) for r in rows_]


def second_day(first):
    """What goes and what comes: corrected rows, new rows, a maximum taken back, accounts that change hands."""
    worst = [r for r in first["raw_repayments"] if r[1] == "L1" and (r[3] - r[2]).days > 40]
    gone = {
        "raw_repayments": worst + first["raw_repayments"][5:9],
        "raw_savings": first["raw_savings"][:4],
        "raw_transactions": first["raw_transactions"][3:30],
        "raw_customers": first["raw_customers"][:1],
        "raw_loans": first["raw_loans"][10:12],
    }
    came = {
        "raw_loans": later(first["raw_loans"][5:8], {1: "C1", 9: 0, 10: Decimal(1), 11: AT + dt.timedelta(1)})
        + later(first["raw_loans"][8:9], {1: "C2", 11: AT - dt.timedelta(9)}),
        "raw_savings": later(first["raw_savings"][:3], {1: "C3"}) + later(first["raw_savings"][4:5], {1: "C5"}),
        "raw_customers": later(first["raw_customers"][2:3], {6: "Papua"}),
        "raw_repayments": later(first["raw_repayments"][5:6], {1: "L39"}),
    }
    return came, gone


def test_second_day_equals_a_rebuild(spark, tmp_path):
    first = day()
    raw = frames(spark, first)
    upkeep = MartUpkeep(spark, str(tmp_path), raw, buckets=4)
    upkeep.apply({n: (df, None) for n, df in raw.items()}, 1)
    same_marts(upkeep, raw)
    came, gone = second_day(first)
    plus, minus = frames(spark, came), frames(spark, gone)
    upkeep.apply({n: (plus[n], minus[n]) for n in raw}, 2)
    left = {n: [r for r in first[n] if r not in gone.get(n, [])] + came.get(n, []) for n in first}
    same_marts(upkeep, frames(spark, left))
    # a day that touches one table leaves the others' buckets alone
    upkeep.apply({"raw_repayments": (frames(spark, {"raw_repayments": later(first["raw_repayments"][:1], {})})["raw_repayments"], None)}, 3)
    left["raw_repayments"] = left["raw_repayments"] + later(first["raw_repayments"][:1], {})
    same_marts(MartUpkeep(spark, str(tmp_path), raw, buckets=4), frames(spark, left))
    assert not (tmp_path / "silver" / "customer_rows" / "rows" / "run=3").exists()
    assert len(os.listdir(tmp_path / "silver" / "repay_sums" / "rows" / "run=3")) < 6


def test_a_day_that_died_is_taken_up_again(spark, tmp_path, monkeypatch):
    first = day(20)
    raw = frames(spark, first)
    MartUpkeep(spark, str(tmp_path), raw, buckets=2).apply({n: (df, None) for n, df in raw.items()}, 1)
    came, gone = second_day(first)
    plus, minus = frames(spark, came), frames(spark, gone)
    changes = {n: (plus[n], minus[n]) for n in raw}
    for step in ("loans_now", "customer_sums", "mart_customer_360"):
        with monkeypatch.context() as patched:
            whole = BucketTable.rewrite

            def dies(self, *a, step=step, whole=whole):
                if self.path.endswith(step):
                    raise RuntimeError("lost")
                return whole(self, *a)

            patched.setattr(BucketTable, "rewrite", dies)
            with pytest.raises(RuntimeError, match="lost"):
                MartUpkeep(spark, str(tmp_path), raw, buckets=2).apply(changes, 2)
    upkeep = MartUpkeep(spark, str(tmp_path), raw, buckets=2)
    upkeep.apply(changes, 2)
    left = {n: [r for r in first[n] if r not in gone.get(n, [])] + came.get(n, []) for n in first}
    same_marts(upkeep, frames(spark, left))
    upkeep.apply(changes, 2)
    same_marts(upkeep, frames(spark, left))
