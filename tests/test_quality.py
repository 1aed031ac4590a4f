"""Gate, column tests, freshness and metrics on 40 customers with planted faults."""

import datetime as dt
import json

import pytest
from conftest import rows

from lendmill import fixed_values as V
from lendmill.operators import quality as Q


@pytest.fixture(scope="module")
def faulty(spark):
    """Ten short ids, ten scores out of range, ten empty emails, ten empty provinces, one id six times."""
    data = []
    for i in range(40):
        key = "C00" if i >= 35 else f"C{i:02d}"
        nik = "1234567890" if i < 10 else f"{i:016d}"
        score = (-5, 0, 1200, 9999)[i % 4] if 10 <= i < 20 else 600
        email = None if 20 <= i < 30 else "a@b.co"
        province = None if i >= 30 else "Bali"
        segment = V.CUSTOMER_SEGMENTS[i % 3]
        data.append((key, nik, segment, score, email, province))
    return spark.createDataFrame(
        data,
        "customer_id string, nik string, segment string, credit_score bigint, email string, province string",
    )


def loans(spark, owners):
    data = [(f"L{i}", c) for i, c in enumerate(owners)]
    return spark.createDataFrame(data, "loan_id string, customer_id string")


def test_gate_counts(spark, faulty):
    got = Q.dq_gate(faulty, loans(spark, ["C00", "C01"]), "2026-01-01").first().asDict()
    assert got == {
        "checked_at": "2026-01-01",
        "bad_nik": 10,
        "bad_credit_score": 10,
        "duplicate_customer_id": 1,
        "null_segment": 0,
        "orphan_loans": 0,
        "total_issues": 21,
        "status": "FAIL",
        "raised": True,
    }


def test_gate_counts_orphans_and_missing_owners(spark, faulty):
    got = Q.dq_gate(faulty, loans(spark, ["C00", "X", "X", None])).first()
    assert got["orphan_loans"] == 3


def test_gate_passes_and_hides_raised(spark, faulty):
    clean = faulty.filter("customer_id = 'C25'")
    verdict = Q.dq_gate(clean, loans(spark, ["C25"]), on_fail="raise")
    said = json.loads(Q.verdict_json(verdict).first()[0])
    assert said["status"] == "PASS" and "raised" not in said


def test_gate_raises_on_request(spark, faulty):
    with pytest.raises(Q.GateFailed):
        Q.dq_gate(faulty, loans(spark, []), on_fail="raise")


def test_gate_is_one_join_free_shuffle(spark, faulty):
    plan = Q.dq_gate(faulty, loans(spark, ["C00"]))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_metrics(spark, faulty):
    at = dt.datetime(2026, 1, 1)
    got = Q.run_metrics(faulty, "stg_customers", Q.standard_metrics(), "2026-01-01")
    assert rows(got) == [
        (at, "credit_score_range", "stg_customers", 10),
        (at, "duplicate_count", "stg_customers", 5),
        (at, "null_count", "stg_customers", 10),
    ]
    two = [Q.Metric("a", "duplicate_count", "customer_id"), Q.Metric("b", "duplicate_count", "email")]
    found = {r["metric_name"]: r["value"] for r in Q.run_metrics(faulty, "t", two, "2026-01-01").collect()}
    assert found == {"a": 5, "b": 29}
    assert Q.metric_null_count(faulty, "email").first()[0] == 10
    assert Q.metric_duplicate_count(faulty, "customer_id").first()[0] == 5


def test_column_tests(spark, faulty):
    owned = loans(spark, ["C00", "X", None])
    suite = [
        Q.ColumnTest("c", "not_null", "email"),
        Q.ColumnTest("c", "unique", "customer_id"),
        Q.ColumnTest("c", "unique", "email"),
        Q.ColumnTest("c", "accepted_values", "segment", values=V.CUSTOMER_SEGMENTS[::2]),
        Q.ColumnTest("l", "relationships", "customer_id", to_table="c", to_column="customer_id"),
        Q.ColumnTest("l", "not_null", "loan_id"),
    ]
    report = Q.run_tests({"c": faulty, "l": owned}, suite)
    got = {r["test_name"]: (r["failures"], r["status"]) for r in report.collect()}
    assert got == {
        "not_null_c_email": (10, "fail"),
        "unique_c_customer_id": (1, "fail"),
        "unique_c_email": (1, "fail"),
        "accepted_values_c_segment": (13, "fail"),
        "relationships_l_customer_id": (1, "fail"),
        "not_null_l_loan_id": (0, "pass"),
    }
    assert Q.test_not_null(faulty, "email").count() == 10
    assert Q.test_unique(faulty, "customer_id").count() == 1
    assert Q.test_accepted(faulty, "segment", V.CUSTOMER_SEGMENTS[::2]).count() == 13


def test_suite_has_the_declared_expectations():
    kinds = [t.kind for t in Q.standard_tests()]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 10, "unique": 7, "accepted_values": 4, "relationships": 2,
    }


@pytest.mark.parametrize(
    "hours,expected", [(1, "pass"), (24, "pass"), (25, "warn"), (48, "warn"), (49, "error")]
)
def test_freshness(spark, hours, expected):
    loaded = dt.datetime(2026, 1, 10) - dt.timedelta(hours=hours)
    df = spark.createDataFrame([(loaded,), (dt.datetime(2025, 1, 1),)], "_loaded_at timestamp_ntz")
    assert Q.freshness(df, "2026-01-10").first()["status"] == expected


def test_a_table_never_loaded_is_stale(spark):
    df = spark.createDataFrame([], "_loaded_at timestamp_ntz")
    assert Q.freshness(df, "2026-01-10").first()["status"] == "error"


def test_arrivals_of_the_last_hours(spark, tmp_path):
    """Both edges count; earlier, later and missing times do not; both bounds reach the scan."""
    at = dt.datetime(2026, 1, 10, 12)
    minutes = [0, 30, 60, 119, 120, 121, -1]
    data = [(at - dt.timedelta(minutes=m),) for m in minutes] + [(None,)]
    spark.createDataFrame(data, "_loaded_at timestamp_ntz").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    kept = Q.arrived_within(df, "2026-01-10 12:00:00", hours=2)
    assert sorted(r[0] for r in kept.collect()) == sorted(at - dt.timedelta(minutes=m) for m in minutes[:5])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_loaded_at,2026-01-10T10:00" in plan
    found = Q.arrivals_per_hour(df, "2026-01-10 12:00:00", hours=2).collect()
    assert {(r.arrived_hour.hour, r.n_rows, r.last_arrival) for r in found} == {
        (12, 1, at),
        (11, 2, at - dt.timedelta(minutes=30)),
        (10, 2, at - dt.timedelta(minutes=119)),
    }
    assert Q.arrivals_per_hour(df.where("false"), "2026-01-10").collect() == []
