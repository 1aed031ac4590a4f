"""Every registered query over the test tables, beside its SQL where SQL can say it.

A query is registered with ``@query(sql)``; its name is the function's name.
Results leave as plain numbers and text, so that both engines print them alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill import fixed_values as V
from lendmill import schemas
from lendmill.functions import masking as M
from lendmill.functions.sql_names import register_functions
from lendmill.operators import facts, history, ml, retrieval, semantic
from lendmill.operators import governance as G
from lendmill.operators import quality as Q
from lendmill.operators import relations as R
from lendmill.operators.increments import signed
from lendmill.operators.lineage import lineage
from lendmill.operators.plan_lineage import column_edges
from lendmill.plans import analytics as A
from lendmill.plans import driver_tables as D
from lendmill.plans.daily_refresh import daily_refresh
from lendmill.plans.history_upkeep import HistoryTable
from lendmill.plans.kept_tests import KeptTests
from lendmill.plans.mart_upkeep import MartUpkeep
from lendmill.plans.marts import mart_customer_360 as mart_of_customers
from lendmill.plans.marts import mart_loan_performance as mart_of_loans
from lendmill.plans.oracle_views import with_views
from lendmill.session import fresh_path, shared_dir
from lendmill.sources import bronze, files
from lendmill.sources.buckets import BucketTable
from lendmill.sources.warehouse import register_view
from lendmill.streaming.indexing import kept_index, start_indexing
from lendmill.streaming.landing import header_of, ingest_bronze, load_landed, start_load
from lendmill.streaming.monitor import read_metrics, start_metrics

# What the default model learns from.
_FEATURES = (
    "credit_score", "monthly_income", "age", "n_loans", "total_outstanding", "total_savings_balance", "n_transactions"
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text, flags as 0/1."""

    def plain(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.BooleanType, T.IntegerType)):
            return c.cast("long").alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema])


def query(sql: str | None = None, extra: dict[str, str] | None = None, **casts: str):
    """Register a query; ``casts`` gives SQL types for columns, as ``DOUBLE="a b"``."""

    def register(fn):
        name = fn.__name__
        QUERIES[name] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        if sql is not None:
            text = sql
            if casts:
                fixed = ", ".join(
                    f"CAST({c} AS {kind}) AS {c}" for kind, cs in casts.items() for c in cs.split()
                )
                text = f"SELECT * REPLACE ({fixed}) FROM ({sql})"
            ORACLE[name] = with_views(text, extra)
        return fn

    return register


# ---- portfolio questions -----------------------------------------------------


@query(
    """SELECT product_segment, count(*) AS n_loans, sum(is_default) AS n_default,
              round(CAST(100 * sum(is_default) AS DOUBLE) / count(*), 2) AS npl_rate_pct,
              sum(outstanding) AS total_outstanding
       FROM mart_loan_performance GROUP BY product_segment""",
    BIGINT="n_default",
    DOUBLE="total_outstanding",
)
def npl_by_segment(spark, d):
    return A.npl_by_segment(D.loan_mart(spark, d))


@query(
    """SELECT dpd_bucket, count(*) AS n_loans, sum(outstanding) AS outstanding
       FROM mart_loan_performance GROUP BY dpd_bucket""",
    DOUBLE="outstanding",
)
def dpd_distribution(spark, d):
    return A.dpd_distribution(D.loan_mart(spark, d))


_PROVINCES = """SELECT province, count(*) AS n_customers, sum(total_savings_balance) AS savings_balance,
                       round(avg(credit_score), 6) AS avg_score
                FROM mart_customer_360 {where} GROUP BY province"""


@query(_PROVINCES.format(where=""), DOUBLE="savings_balance")
def province_profile(spark, d):
    out = A.province_profile(D.customer_mart(spark, d))
    return out.withColumn("avg_score", F.round("avg_score", 6))


@query(_PROVINCES.format(where="WHERE province IS NOT NULL"), DOUBLE="savings_balance")
def province_profile_known(spark, d):
    out = A.province_profile(D.customer_mart(spark, d), dropna=True)
    return out.withColumn("avg_score", F.round("avg_score", 6))


@query(
    _PROVINCES.format(where=f"WHERE segment = 'Tunaiku'"),
    DOUBLE="savings_balance",
)
def segment_filtered_provinces(spark, d):
    out = A.provinces_of_segment(D.customer_mart(spark, d), V.CUSTOMER_SEGMENTS[0])
    return out.withColumn("avg_score", F.round("avg_score", 6))


@query(
    """SELECT c.province, l.product_segment, count(*) AS loans,
              round(CAST(sum(CAST(l.collection_ratio AS DECIMAL(18,4))) AS DOUBLE)
                    / count(l.collection_ratio), 6) AS avg_collection,
              sum(l.outstanding) AS outstanding
       FROM mart_loan_performance l JOIN mart_customer_360 c ON l.customer_id = c.customer_id
       GROUP BY c.province, l.product_segment""",
    DOUBLE="outstanding",
)
def province_segment_heavy(spark, d):
    out = A.province_segment(D.loan_mart(spark, d), D.customer_mart(spark, d))
    return out.withColumn("avg_collection", F.round("avg_collection", 6))


@query("SELECT product_segment, count(*) AS n FROM mart_loan_performance GROUP BY 1")
def segment_count(spark, d):
    return R.count_by(D.loan_mart(spark, d), "product_segment")


@query(
    """SELECT count(*) AS total_loans, round(100 * avg(is_default), 6) AS npl_rate_pct,
              round(CAST(sum(outstanding) AS DOUBLE) / 1e9, 6) AS outstanding_bn,
              (SELECT count(*) FROM mart_customer_360) AS total_customers
       FROM mart_loan_performance"""
)
def portfolio_kpis(spark, d):
    out = A.portfolio_kpis(D.loan_mart(spark, d), D.customer_mart(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("npl_rate_pct", "outstanding_bn")})


@query(
    """SELECT product_segment, count(loan_id) AS loans, sum(outstanding) AS outstanding,
              round(avg(is_default), 6) AS npl, round_even(avg(is_default) * 100, 2) AS npl_pct
       FROM mart_loan_performance GROUP BY product_segment""",
    DOUBLE="outstanding",
)
def segment_summary(spark, d):
    return A.segment_summary(D.loan_mart(spark, d)).withColumn("npl", F.round("npl", 6))


# ---- staged tables and marts ------------------------------------------------------


@query(
    "SELECT * FROM stg_customers",
    DOUBLE="monthly_income",
    VARCHAR="birth_date created_at updated_at _loaded_at",
)
def stg_customers(spark, d):
    return D.customers(spark, d)


@query(
    "SELECT * FROM stg_loans", DOUBLE="plafond outstanding", VARCHAR="disbursed_at updated_at _loaded_at"
)
def stg_loans(spark, d):
    return D.loans(spark, d)


@query(
    "SELECT * FROM stg_repayments",
    DOUBLE="amount_due amount_paid shortfall",
    VARCHAR="due_date paid_date _loaded_at",
)
def stg_repayments(spark, d):
    return D.repayments(spark, d)


@query("SELECT * FROM stg_savings", DOUBLE="balance", VARCHAR="opened_at _loaded_at")
def stg_savings(spark, d):
    return D.savings(spark, d)


@query("SELECT * FROM stg_transactions", DOUBLE="amount", VARCHAR="txn_ts txn_month _loaded_at")
def stg_transactions(spark, d):
    return D.transactions(spark, d)


@query(
    """SELECT loan_id, n_installments, total_due, total_paid, n_late, max_days_late FROM mart_loan_performance
       WHERE n_installments > 0
       UNION ALL SELECT l_orderkey, count(*), sum(CAST(l_extendedprice AS DECIMAL(18,2))),
                        sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2))),
                        count(*) FILTER (WHERE l_returnflag = 'R'), max(l_partkey % 29) - 3
                 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey""",
    DOUBLE="total_due total_paid",
)
def repay_by_loan(spark, d):
    return facts.repay_by_loan(D.repayments(spark, d))


@query(
    """SELECT customer_id, count(*) AS n_loans, sum(plafond) AS total_plafond, sum(outstanding) AS total_outstanding,
              max(is_default) AS ever_default FROM raw_loans GROUP BY customer_id""",
    DOUBLE="total_plafond total_outstanding",
)
def loans_by_customer(spark, d):
    return facts.loans_by_customer(D.loans(spark, d))


@query(
    """SELECT c_custkey - c_custkey % 2 AS customer_id, count(*) AS n_accounts,
              sum(CAST(c_acctbal AS DECIMAL(18,2))) AS total_balance FROM customer GROUP BY 1""",
    DOUBLE="total_balance",
)
def savings_by_customer(spark, d):
    return facts.savings_by_customer(D.savings(spark, d))


@query(
    """SELECT c_custkey - c_custkey % 2 AS customer_id, count(*) AS n_txn,
              sum(CAST(value AS DECIMAL(18,2))) AS total_txn_amount
       FROM events JOIN customer ON user_id = c_custkey + CASE c_nationkey WHEN 13 THEN 1000000000 ELSE 0 END
       GROUP BY 1""",
    DOUBLE="total_txn_amount",
)
def txn_by_customer(spark, d):
    return facts.txn_by_customer(D.transactions(spark, d), D.savings(spark, d))


@query(
    "SELECT * FROM mart_loan_performance",
    DOUBLE="plafond outstanding total_due total_paid",
    VARCHAR="disbursed_at",
)
def mart_loan_performance(spark, d):
    return D.loan_mart(spark, d)


@query(
    "SELECT * FROM mart_customer_360",
    DOUBLE="monthly_income total_plafond total_outstanding total_savings_balance total_txn_amount",
)
def mart_customer_360(spark, d):
    return D.customer_mart(spark, d)


@query(
    """SELECT l.loan_id, l.customer_id, l.product_segment, l.collection_ratio, c.province, c.n_loans
       FROM mart_loan_performance l JOIN mart_customer_360 c ON l.customer_id = c.customer_id"""
)
def loans_with_customer(spark, d):
    joined = A.loans_with_customer(D.loan_mart(spark, d), D.customer_mart(spark, d))
    return joined.select(
        "loan_id", "customer_id", "product_segment", "collection_ratio", "province", "n_loans"
    )


@query(
    """SELECT t.account_id, t.txn_id, t.txn_type, t.amount, s.customer_id
       FROM stg_transactions t JOIN stg_savings s ON t.account_id = s.account_id""",
    DOUBLE="amount",
)
def txn_with_owner(spark, d):
    owned = facts.txn_with_owner(D.transactions(spark, d), D.savings(spark, d))
    return owned.select("account_id", "txn_id", "txn_type", "amount", "customer_id")


# ---- quality ---------------------------------------------------------------------

_GATE = """SELECT *, bad_nik + bad_credit_score + duplicate_customer_id + null_segment + orphan_loans AS total_issues
           FROM (SELECT count(*) FILTER (WHERE NOT regexp_full_match(nik, '[0-9]{{16}}')) AS bad_nik,
                        count(*) FILTER (WHERE credit_score NOT BETWEEN 300 AND 850) AS bad_credit_score,
                        count(*) FILTER (WHERE segment IS NULL OR segment = '') AS null_segment FROM {c})
           CROSS JOIN (SELECT count(*) AS duplicate_customer_id FROM (
                         SELECT customer_id FROM {c} GROUP BY customer_id HAVING count(*) > 1))
           CROSS JOIN (SELECT count(*) AS orphan_loans FROM stg_loans
                       WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM {c}))"""
_VERDICT = """SELECT *, CASE WHEN total_issues = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
                     CASE WHEN total_issues > 0 THEN 1 END AS raised FROM ({gate})"""


@query(_VERDICT.format(gate=_GATE.format(c="stg_customers")), BIGINT="raised")
def dq_gate(spark, d):
    return Q.dq_gate(D.customers(spark, d), D.loans(spark, d)).drop("checked_at")


@query(_VERDICT.format(gate=_GATE.format(c="suppliers")), BIGINT="raised", extra={
    "suppliers": "SELECT * FROM stg_customers UNION ALL SELECT * FROM stg_customers WHERE customer_id % 50 = 0"
})
def dq_gate_orphans(spark, d):
    """The gate over customers of whom some are there twice."""
    rows = D.customers(spark, d)
    twice = F.when(F.col("customer_id") % 50 == 0, 2).otherwise(1)
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), twice)).alias("_time")).drop("_time")
    return Q.dq_gate(rows, D.loans(spark, d)).drop("checked_at")


@query(
    f"""SELECT CAST(bad_nik AS VARCHAR) AS bad_nik, CAST(orphan_loans AS VARCHAR) AS orphan_loans, status,
               'true' AS raised FROM ({_VERDICT.format(gate=_GATE.format(c="stg_customers"))})"""
)
def dq_verdict_json(spark, d):
    """The verdict as one JSON object, read back key by key."""
    verdict = Q.verdict_json(Q.dq_gate(D.customers(spark, d), D.loans(spark, d)))
    keys = ("bad_nik", "orphan_loans", "status", "raised")
    return verdict.select(*[F.get_json_object("verdict", f"$.{k}").alias(k) for k in keys])


# The expectations on staged tables and marts, as (kind, table, column, rest).
_EXPECTED = (
    ("not_null", "stg_customers", "customer_id", ""),
    ("unique", "stg_customers", "customer_id", ""),
    ("not_null", "stg_customers", "nik", ""),
    ("not_null", "stg_customers", "segment", ""),
    ("accepted_values", "stg_customers", "segment", "'Tunaiku', 'Senyumku', 'SMB'"),
    ("not_null", "stg_loans", "loan_id", ""),
    ("unique", "stg_loans", "loan_id", ""),
    ("not_null", "stg_loans", "customer_id", ""),
    ("relationships", "stg_loans", "customer_id", "stg_customers"),
    ("accepted_values", "stg_loans", "is_default", "0, 1"),
    ("not_null", "stg_repayments", "repayment_id", ""),
    ("unique", "stg_repayments", "repayment_id", ""),
    ("relationships", "stg_repayments", "loan_id", "stg_loans"),
    ("not_null", "stg_savings", "account_id", ""),
    ("unique", "stg_savings", "account_id", ""),
    ("accepted_values", "stg_savings", "account_type", "'TABUNGAN', 'DEPOSITO'"),
    ("not_null", "stg_transactions", "txn_id", ""),
    ("unique", "stg_transactions", "txn_id", ""),
    ("not_null", "mart_loan_performance", "loan_id", ""),
    ("unique", "mart_loan_performance", "loan_id", ""),
    ("accepted_values", "mart_loan_performance", "dpd_bucket",
     "'CURRENT', 'DPD_1_30', 'DPD_31_60', 'DPD_61_90', 'DPD_90_PLUS'"),
    ("not_null", "mart_customer_360", "customer_id", ""),
    ("unique", "mart_customer_360", "customer_id", ""),
)


def _tests_sql() -> str:
    failing = {
        "not_null": "SELECT count(*) FROM {t} WHERE {c} IS NULL",
        "unique": "SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)",
        "accepted_values": "SELECT count(*) FROM {t} WHERE {c} NOT IN ({rest})",
        "relationships": "SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {rest})",
    }
    parts = [
        f"SELECT '{kind}_{t}_{c}' AS test_name, '{t}' AS table_name, '{c}' AS column_name, "
        f"({failing[kind].format(t=t, c=c, rest=rest)}) AS failures"
        for kind, t, c, rest in _EXPECTED
    ]
    body = " UNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body})"


@query(_tests_sql())
def column_tests(spark, d):
    tables = {
        "stg_customers": D.customers(spark, d),
        "stg_loans": D.loans(spark, d),
        "stg_repayments": D.repayments(spark, d),
        "stg_savings": D.savings(spark, d),
        "stg_transactions": D.transactions(spark, d),
        "mart_loan_performance": D.loan_mart(spark, d),
        "mart_customer_360": D.customer_mart(spark, d),
    }
    return Q.run_tests(tables, Q.standard_tests())


@query(_tests_sql())
def column_tests_incremental(spark, d):
    """The same report after two changes: the first brings rows of which many fail, twice over; the second
    takes the wrong ones back and brings the right ones and the rest."""
    tables = {
        "stg_customers": D.customers(spark, d), "stg_loans": D.loans(spark, d), "stg_repayments": D.repayments(spark, d),
        "stg_savings": D.savings(spark, d), "stg_transactions": D.transactions(spark, d),
        "mart_loan_performance": D.loan_mart(spark, d), "mart_customer_360": D.customer_mart(spark, d),
    }
    key = {t.table: t.column for t in Q.standard_tests() if t.kind == "unique"}
    kept = KeptTests(spark, fresh_path(spark, "tests"), Q.standard_tests(), tables, buckets=8)
    first, second = {}, {}
    for name, rows in tables.items():
        third = F.pmod(F.xxhash64(key[name]), F.lit(3))
        wrong = rows.filter(third == 1)
        wrong = wrong.unionByName(wrong)
        for column in ("nik", "segment", "account_type", "dpd_bucket"):
            if column in rows.columns:
                wrong = wrong.withColumn(column, F.lit(None).cast("string"))
        if name in ("stg_loans", "stg_repayments"):
            owner = "customer_id" if name == "stg_loans" else "loan_id"
            wrong = wrong.withColumn(owner, -F.col(owner))
        first[name] = (rows.filter(third == 0).unionByName(wrong), None)
        second[name] = (rows.filter(third != 0), wrong)
    for number, change in enumerate((first, second), 1):
        kept.apply(change, number)
    return kept.report()


_FRESH_AT = "2024-02-01 12:00:00"


@query(
    f"""SELECT max_loaded_at, age_hours,
               CASE WHEN age_hours > 48 THEN 'error' WHEN age_hours > 24 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max(txn_ts) AS max_loaded_at,
                     round(date_sub('second', max(txn_ts), TIMESTAMP '{_FRESH_AT}') / 3600, 6) AS age_hours
              FROM stg_transactions)""",
    VARCHAR="max_loaded_at",
)
def freshness(spark, d):
    out = Q.freshness(D.transactions(spark, d), _FRESH_AT, ts="txn_ts")
    return out.withColumn("age_hours", F.round("age_hours", 6))


@query(
    f"""SELECT date_trunc('hour', txn_ts) AS arrived_hour, count(*) AS n_rows, max(txn_ts) AS last_arrival
        FROM stg_transactions
        WHERE txn_ts BETWEEN TIMESTAMP '{_FRESH_AT}' - INTERVAL 72 HOUR AND TIMESTAMP '{_FRESH_AT}'
        GROUP BY 1""",
    VARCHAR="arrived_hour last_arrival",
)
def arrivals_per_hour(spark, d):
    return Q.arrivals_per_hour(D.transactions(spark, d), _FRESH_AT, hours=72, ts="txn_ts")


_METRICS = """SELECT '{at}' AS measurement_time, metric_name, '{table}' AS table_name, value FROM (
    SELECT 'null_count' AS metric_name, count(*) AS value FROM {src} WHERE email IS NULL
    UNION ALL SELECT 'duplicate_count', count(customer_id) - count(DISTINCT customer_id) FROM {src}
    UNION ALL SELECT 'credit_score_range', count(*) FROM {src} WHERE credit_score < 300 OR credit_score > 850)"""


@query(_METRICS.format(at=D.LOADED_AT, table="stg_customers", src="stg_customers"))
def dq_metrics(spark, d):
    return Q.run_metrics(
        D.customers(spark, d), "stg_customers", Q.standard_metrics(), D.LOADED_AT
    )


@query(
    """SELECT l.loan_id, l.customer_id FROM stg_loans l
       LEFT JOIN stg_customers c ON l.customer_id = c.customer_id WHERE c.customer_id IS NULL"""
)
def orphans_anti(spark, d):
    lost = R.orphans(D.loans(spark, d), D.customers(spark, d), "customer_id")
    return lost.select("loan_id", "customer_id")


# Loans reached through closed loans only: a foreign key that is often missing.
_CLOSED = {
    "closed_links": "SELECT loan_id, CASE WHEN status = 'LUNAS' THEN customer_id END AS owner FROM stg_loans"
}


def _closed_links(spark, d):
    owner = F.when(F.col("status") == "LUNAS", F.col("customer_id")).alias("owner")
    return D.loans(spark, d).select("loan_id", owner)


@query(
    """SELECT loan_id, owner FROM closed_links
       WHERE owner IS NOT NULL AND owner NOT IN (SELECT customer_id FROM stg_customers)""",
    extra=_CLOSED,
)
def missing_parents(spark, d):
    return R.missing_parent(
        _closed_links(spark, d), "owner", D.customers(spark, d), "customer_id"
    ).select("loan_id", "owner")


@query(
    """SELECT
         (SELECT count(*) FROM closed_links l LEFT JOIN stg_customers c ON l.owner = c.customer_id
           WHERE c.customer_id IS NULL) AS with_missing_keys,
         (SELECT count(*) FROM closed_links l LEFT JOIN stg_customers c ON l.owner = c.customer_id
           WHERE c.customer_id IS NULL AND l.owner IS NOT NULL) AS without_missing_keys""",
    extra=_CLOSED,
)
def orphan_counts(spark, d):
    links, parents = _closed_links(spark, d), D.customers(spark, d)
    without = R.count_orphans(links, "owner", parents, "customer_id", nulls_count=False)
    counted = R.count_orphans(links, "owner", parents, "customer_id")
    return counted.select(
        F.col("n_orphans").alias("with_missing_keys"),
        without.scalar().alias("without_missing_keys"),
    )


@query(
    """SELECT count(*) AS n_duplicate_keys FROM
       (SELECT repayment_id FROM stg_repayments GROUP BY repayment_id HAVING count(*) > 1)"""
)
def duplicate_keys(spark, d):
    return R.duplicate_keys(D.repayments(spark, d), "repayment_id")


_RAW = ["raw_customers", "raw_loans", "raw_repayments", "raw_savings", "raw_transactions"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _RAW))
def table_counts(spark, d):
    return R.table_counts({t: getattr(D, t)(spark, d) for t in _RAW})


@query("SELECT DISTINCT province FROM stg_customers")
def distinct_provinces(spark, d):
    return R.distinct_values(D.customers(spark, d), "province")


@query(
    """SELECT txn_id, account_id, txn_ts FROM stg_transactions ORDER BY txn_ts DESC, txn_id LIMIT 5""",
    VARCHAR="txn_ts",
)
def latest_transactions(spark, d):
    return R.latest(D.transactions(spark, d), "txn_ts", 5, "txn_id").select(
        "txn_id", "account_id", "txn_ts"
    )


# ---- history ---------------------------------------------------------------------


@query(
    """SELECT user_id, event_type, valid_from, valid_to, CASE WHEN valid_to IS NULL THEN 1 ELSE 0 END AS is_current
       FROM (SELECT user_id, event_type, ts AS valid_from,
                    lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
             FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before,
                          row_number() OVER (PARTITION BY user_id ORDER BY ts) AS place
                   FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS copy
                         FROM events) WHERE copy = 1)
             WHERE place = 1 OR event_type IS DISTINCT FROM before)""",
    VARCHAR="valid_from valid_to",
    BIGINT="is_current",
)
def scd2_history(spark, d):
    events = D.table(spark, d, "events")
    return history.scd2_from_history(events, "user_id", ["event_type"], "ts", "event_id")


@query(
    """SELECT user_id, event_type, valid_from, valid_to, CASE WHEN valid_to IS NULL THEN 1 ELSE 0 END AS is_current
       FROM (SELECT user_id, event_type, ts AS valid_from,
                    lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
             FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before,
                          row_number() OVER (PARTITION BY user_id ORDER BY ts) AS place
                   FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS copy
                         FROM events) WHERE copy = 1)
             WHERE place = 1 OR event_type IS DISTINCT FROM before)""",
    VARCHAR="valid_from valid_to",
    BIGINT="is_current",
)
def scd2_backdated(spark, d):
    """The same history from three deliveries, the newest rows first, the others between those."""
    events = D.table(spark, d, "events").select("user_id", "event_type", "ts", "event_id")
    table = HistoryTable(
        spark, fresh_path(spark, "history"), events, "user_id", ["event_type"], "ts", "event_id", buckets=8
    )
    turn = F.when(F.col("event_id") % 5 == 0, 3).when(F.dayofmonth("ts") > 15, 1).otherwise(2)
    for number in (1, 2, 3):
        table.deliver(events.filter(turn == number), number)
    return table.read()


_CHECKED = ["province", "segment", "credit_score"]
_FIRST, _SECOND = "2024-01-01 00:00:00", "2024-07-01 00:00:00"
_VERSIONS = {
    "snapshot": "SELECT customer_id, full_name, province, segment, credit_score FROM stg_customers",
    "later": f"""
        SELECT customer_id,
               CASE WHEN segment = 'Senyumku' THEN upper(full_name) ELSE full_name END AS full_name,
               CASE WHEN segment = 'Tunaiku' THEN 'Bali' ELSE province END AS province,
               segment, credit_score
        FROM stg_customers WHERE segment <> 'SMB'
        UNION ALL
        SELECT s_suppkey + 1000000000, s_name, NULL, 'SMB', CAST(700 AS BIGINT) FROM supplier""",
    "changes": """
        SELECT coalesce(o.customer_id, n.customer_id) AS customer_id,
               CASE WHEN o.customer_id IS NULL THEN 'new' WHEN n.customer_id IS NULL THEN 'gone'
                    WHEN o.province IS NOT DISTINCT FROM n.province AND o.segment IS NOT DISTINCT FROM n.segment
                     AND o.credit_score IS NOT DISTINCT FROM n.credit_score THEN 'same' ELSE 'changed' END AS change
        FROM snapshot o FULL JOIN later n ON o.customer_id = n.customer_id""",
}


@query("SELECT customer_id, change FROM changes", extra=_VERSIONS)
def change_detection(spark, d):
    dim = history.first_snapshot(D.customer_snapshot(spark, d), _FIRST)
    found = history.detect_changes(dim, D.customer_versions(spark, d), "customer_id", _CHECKED)
    key = F.coalesce("old.customer_id", "new.customer_id").alias("customer_id")
    return found.select(key, "change")


@query(
    f"""SELECT s.*, '{_FIRST}' AS valid_from, CASE WHEN g.change = 'changed' THEN '{_SECOND}' END AS valid_to,
               CASE WHEN g.change = 'changed' THEN 0 ELSE 1 END AS is_current
        FROM snapshot s JOIN changes g ON s.customer_id = g.customer_id
        UNION ALL
        SELECT l.*, '{_SECOND}', NULL, 1 FROM later l JOIN changes g ON l.customer_id = g.customer_id
        WHERE g.change IN ('changed', 'new')""",
    extra=_VERSIONS,
    BIGINT="is_current",
)
def scd2_apply(spark, d):
    dim = history.scd2_apply(None, D.customer_snapshot(spark, d), "customer_id", _CHECKED, _FIRST)
    later = D.customer_versions(spark, d)
    return history.scd2_apply(dim, later, "customer_id", _CHECKED, _SECOND)


def _kept_marts(spark, d) -> MartUpkeep:
    """The marts after two days. The first brings two thirds of every table, half of it wrong; the
    second takes the wrong rows back, and brings the right ones and the rest."""
    raw = {n: getattr(D, n)(spark, d) for n in schemas.RAW_TABLES}
    key = {"raw_customers": "customer_id", "raw_loans": "loan_id", "raw_repayments": "repayment_id",
           "raw_savings": "account_id", "raw_transactions": "txn_id"}
    wrong = {
        "raw_customers": {"city": F.lit("nowhere"), "credit_score": F.lit(None)},
        "raw_loans": {"customer_id": F.col("customer_id") + 1, "outstanding": F.lit(1), "is_default": F.lit(1)},
        "raw_repayments": {"paid_date": F.date_add("paid_date", 400), "amount_paid": F.lit(None)},
        "raw_savings": {"customer_id": F.col("customer_id") + 2, "balance": F.lit(7)},
        "raw_transactions": {"account_id": F.col("account_id") + 1, "amount": F.lit(-1)},
    }
    upkeep = MartUpkeep(spark, fresh_path(spark, "house"), raw, buckets=8)
    days: list[dict] = [{}, {}]
    for name, rows in raw.items():
        third = F.pmod(F.xxhash64(key[name]), F.lit(3))
        kinds = dict(rows.dtypes)
        bent = rows.filter(third == 1).withColumns({c: v.cast(kinds[c]) for c, v in wrong[name].items()})
        days[0][name] = (rows.filter(third == 0).unionByName(bent), None)
        days[1][name] = (rows.filter(third != 0), bent)
    for number, changes in enumerate(days, 1):
        upkeep.apply(changes, number)
    return upkeep


@query(
    "SELECT * FROM mart_loan_performance",
    DOUBLE="plafond outstanding total_due total_paid collection_ratio", VARCHAR="disbursed_at",
)
def mart_incremental(spark, d):
    return _kept_marts(spark, d).loan_mart()


@query(
    "SELECT * FROM mart_customer_360",
    DOUBLE="monthly_income total_plafond total_outstanding total_savings_balance total_txn_amount",
)
def mart_incremental_customers(spark, d):
    return _kept_marts(spark, d).customer_mart(D.AS_OF)


# A batch with every late loan paid off, one backdated loan set, and new loans.
_BATCH_AT = "2026-06-01 09:00:00"
_BATCH = {
    "batch": f"""
        SELECT loan_id, customer_id, 'LUNAS' AS status, CAST(0 AS DECIMAL(18,2)) AS outstanding,
               TIMESTAMP '{_BATCH_AT}' AS updated_at FROM stg_loans WHERE dpd_bucket = 'DPD_90_PLUS'
        UNION ALL
        SELECT loan_id, customer_id, 'DPD30', outstanding, TIMESTAMP '1970-01-01 00:00:00'
        FROM stg_loans WHERE dpd_bucket = 'DPD_31_60'
        UNION ALL
        SELECT loan_id + 1000000000, customer_id, 'LANCAR', plafond, TIMESTAMP '{_BATCH_AT}'
        FROM stg_loans WHERE dpd_bucket = 'CURRENT'""",
}


def _loan_batch(loans: DataFrame) -> DataFrame:
    at = F.lit(_BATCH_AT).cast("timestamp_ntz").alias("updated_at")

    def rows(bucket, status, outstanding, when, shift=0):
        return loans.filter(F.col("dpd_bucket") == bucket).select(
            (F.col("loan_id") + shift).alias("loan_id"),
            "customer_id",
            F.lit(status).alias("status"),
            outstanding.cast("decimal(18,2)").alias("outstanding"),
            when,
        )

    old = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at")
    return R.union_all(
        [
            rows("DPD_90_PLUS", "LUNAS", F.lit(0), at),
            rows("DPD_31_60", "DPD30", F.col("outstanding"), old),
            rows("CURRENT", "LANCAR", F.col("plafond"), at, 1_000_000_000),
        ]
    )


@query(
    """SELECT loan_id, customer_id, status, outstanding, updated_at FROM (
         SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY updated_at DESC, from_batch DESC) AS place
         FROM (SELECT loan_id, customer_id, status, outstanding, updated_at, 0 AS from_batch FROM stg_loans
               UNION ALL SELECT *, 1 FROM batch)) WHERE place = 1""",
    extra=_BATCH,
    DOUBLE="outstanding",
    VARCHAR="updated_at",
)
def upsert_latest(spark, d):
    loans = D.loans(spark, d)
    base = loans.select("loan_id", "customer_id", "status", "outstanding", "updated_at")
    return history.upsert_latest(base, _loan_batch(loans), "loan_id", "updated_at")


@query(
    """SELECT loan_id, customer_id, status, outstanding, updated_at FROM (
         SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY updated_at DESC, from_batch DESC) AS place
         FROM (SELECT loan_id, customer_id, status, outstanding, updated_at, 0 AS from_batch FROM stg_loans
               UNION ALL SELECT *, 1 FROM batch)) WHERE place = 1""",
    extra=_BATCH,
    DOUBLE="outstanding",
    VARCHAR="updated_at",
)
def upsert_buckets(spark, d):
    """The same upsert into a table kept in buckets, batch by batch, one of them made twice."""
    loans = D.loans(spark, d)
    base = loans.select("loan_id", "customer_id", "status", "outstanding", "updated_at")
    table = BucketTable(spark, fresh_path(spark, "loans"), "loan_id", base.schema, buckets=16)
    batch = _loan_batch(loans)
    early = F.col("updated_at") < "2000-01-01"
    for number, rows in enumerate((base, batch.filter(early), batch.filter(~early)), 1):
        for _ in range(2):
            table.upsert(rows, number, "updated_at")
    return table.read()


@query(
    """SELECT event_id, user_id, event_type, ts FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
       WHERE place = 1""",
    VARCHAR="ts",
)
def latest_per_key(spark, d):
    events = D.table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return history.latest_per_key(events, "user_id", "ts", "event_id")


# ---- governance --------------------------------------------------------------------

_SEEN = ["customer_id", "nik", "email", "phone", "monthly_income", "province"]


def _governed(spark, d, role):
    rows = G.apply_row_access(D.customers(spark, d), role).select(*_SEEN)
    return G.apply_masking(rows, G.CUSTOMER_POLICIES, role)


@query(
    f"""SELECT customer_id, 'XXXXXXXXXXXXXXXX' AS nik, regexp_replace(email, '^[^@]+', '****') AS email,
               left(phone, 4) || 'XXXXXX' AS phone, CAST(NULL AS DOUBLE) AS monthly_income, province
        FROM stg_customers WHERE province = 'DKI Jakarta'"""
)
def masked_analyst(spark, d):
    return _governed(spark, d, M.ANALYST)


@query(
    """SELECT customer_id, repeat('X', greatest(length(nik) - 4, 0)) || right(nik, 4) AS nik,
              regexp_replace(email, '^[^@]+', '****') AS email, left(phone, 4) || 'XXXXXX' AS phone,
              monthly_income, province FROM stg_customers""",
    DOUBLE="monthly_income",
)
def masked_engineer(spark, d):
    return _governed(spark, d, M.ENGINEER)


@query(
    "SELECT customer_id, nik, email, phone, monthly_income, province FROM stg_customers",
    DOUBLE="monthly_income",
)
def masked_auditor(spark, d):
    return _governed(spark, d, M.AUDITOR)


@query(f"SELECT * FROM stg_customers WHERE province = 'DKI Jakarta'", DOUBLE="monthly_income",
       VARCHAR="birth_date created_at updated_at _loaded_at")
def row_access(spark, d):
    return G.apply_row_access(D.customers(spark, d), M.ANALYST)


@query("SELECT customer_id, nik FROM stg_customers")
def projection_allowed(spark, d):
    return G.governed_select(D.customers(spark, d), ["customer_id", "nik"], M.AUDITOR)


@query(
    f"""SELECT customer_id, left(phone, 4) || 'XXXXXX' AS phone FROM stg_customers
        WHERE province = 'DKI Jakarta'"""
)
def projection_lenient(spark, d):
    wanted = ["customer_id", "nik", "phone"]
    return G.governed_select(D.customers(spark, d), wanted, M.ANALYST, lenient=True)


@query(
    """SELECT customer_id, repeat('X', greatest(length(nik) - 4, 0)) || right(nik, 4) AS nik,
              regexp_replace(email, '^[^@]+', '****') AS email FROM stg_customers"""
)
def masked_by_variable(spark, d):
    """The role is a variable of the session, read where the query runs."""
    spark.sql("DECLARE OR REPLACE VARIABLE current_role_name STRING DEFAULT 'analyst'")
    spark.sql("SET VAR current_role_name = 'engineer'")
    role = F.expr("current_role_name")
    rows = G.apply_row_access(D.customers(spark, d), role)
    return G.apply_masking(rows, G.CUSTOMER_POLICIES, role).select("customer_id", "nik", "email")


@query(
    """SELECT customer_id, age, repeat('X', greatest(length(nik) - 4, 0)) || right(nik, 4) AS nik,
              regexp_replace(email, '^[^@]+', '****') AS email, left(phone, 4) || 'XXXXXX' AS phone,
              monthly_income FROM stg_customers""",
    DOUBLE="monthly_income",
    BIGINT="age",
)
def masked_by_sql(spark, d):
    """The same masks as SQL functions over a view, with the role in the query."""
    register_functions(spark)
    register_view(D.raw_customers(spark, d), "raw_customers")
    return spark.sql(
        f"""SELECT customer_id, years_between(birth_date, DATE '{D.AS_OF}') AS age,
                   mask_nik(nik, 'engineer') AS nik, mask_email(lower(email), 'engineer') AS email,
                   mask_phone(phone, 'engineer') AS phone,
                   mask_income(monthly_income, 'engineer') AS monthly_income
            FROM raw_customers WHERE may_see_row(province, 'engineer')"""
    )


@query(
    """SELECT product_segment, dpd_bucket, count(*) AS n_loans,
              round(CAST(100 * sum(is_default) AS DOUBLE) / count(*), 2) AS npl_rate_pct
       FROM stg_loans GROUP BY product_segment, dpd_bucket"""
)
def loans_by_sql(spark, d):
    """Portfolio SQL as an analyst would type it, over the raw loans."""
    register_functions(spark)
    register_view(D.raw_loans(spark, d), "raw_loans")
    return spark.sql(
        """SELECT product_segment, dpd_bucket, count(*) AS n_loans,
                  round(100 * sum(is_default) / count(*), 2) AS npl_rate_pct
           FROM (SELECT product_segment(product_type) AS product_segment,
                        dpd_bucket(dpd) AS dpd_bucket, is_default
                 FROM raw_loans)
           GROUP BY product_segment, dpd_bucket ORDER BY npl_rate_pct DESC"""
    )


def _tags_sql() -> str:
    columns = (
        "customer_id nik npwp full_name gender birth_date province city segment credit_score "
        "monthly_income phone email created_at updated_at age _loaded_at"
    ).split()
    tags = {"nik": "NIK", "npwp": "NPWP", "phone": "PHONE", "email": "EMAIL"}
    rows = [(c, "pii_type", v) for c, v in tags.items()]
    rows += [(c, "data_classification", "CONFIDENTIAL") for c in columns]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{k}' AS tag, '{v}' AS tag_value, count({c}) AS n_values FROM stg_customers"
        for c, k, v in rows
    )


@query(_tags_sql())
def tag_inventory(spark, d):
    return G.tags_of(G.tag_customers(D.customers(spark, d)))


_EDGES = {
    "lineage_edges": """
        SELECT 'world' AS src, 'region:' || r_regionkey AS dst FROM region
        UNION ALL SELECT 'region:' || n_regionkey, 'nation:' || n_nationkey FROM nation
        UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey FROM customer
        UNION ALL SELECT 'customer:' || o_custkey, 'loan:' || o_orderkey FROM orders
        UNION ALL SELECT 'loan:' || o_orderkey, 'product:' || o_orderpriority FROM orders
        UNION ALL SELECT 'customer:' || c_custkey, 'mart:' || c_mktsegment FROM customer
        UNION ALL SELECT DISTINCT 'mart:' || c_mktsegment, 'nation:' || c_nationkey FROM customer"""
}


def _reach(start: str, here: str, there: str) -> dict[str, str]:
    return {
        **_EDGES,
        "reach": f"""
            SELECT '{start}' AS node, 0 AS distance
            UNION SELECT e.{there}, r.distance + 1 FROM reach r JOIN lineage_edges e ON e.{here} = r.node
            WHERE r.distance < 5""",
    }


_NEAREST = """SELECT node, min(distance) AS distance FROM reach WHERE node <> '{start}' GROUP BY node"""


@query(
    _NEAREST.format(start="product:1-URGENT"),
    extra=_reach("product:1-URGENT", "dst", "src"),
    BIGINT="distance",
)
def lineage_upstream(spark, d):
    return lineage(D.lineage_edges(spark, d), "product:1-URGENT", "upstream", 5)


@query(
    _NEAREST.format(start="region:0"), extra=_reach("region:0", "src", "dst"), BIGINT="distance"
)
def lineage_downstream(spark, d):
    return lineage(D.lineage_edges(spark, d), "region:0", "downstream", 5)


# ---- semantic layer ------------------------------------------------------------------


# Mart column, staged table and column its values are made of.
_MART_COLUMNS = {
    "mart_loan_performance": {
        "stg_loans": "loan_id customer_id product_segment product_type status dpd dpd_bucket is_default plafond "
        "outstanding interest_rate disbursed_at",
        "stg_repayments": "total_due:amount_due total_paid:amount_paid n_late:is_late max_days_late:days_late "
        "collection_ratio:amount_due collection_ratio:amount_paid",
    },
    "mart_customer_360": {
        "stg_customers": "customer_id full_name segment province city age credit_score monthly_income",
        "stg_loans": "total_plafond:plafond total_outstanding:outstanding ever_default:is_default",
        "stg_savings": "total_savings_balance:balance",
        "stg_transactions": "total_txn_amount:amount",
    },
}


def _mart_columns_sql() -> str:
    values = ", ".join(
        f"('{mart}', '{pair.split(':')[0]}', '{table}', '{pair.split(':')[-1]}')"
        for mart, tables in _MART_COLUMNS.items()
        for table, pairs in tables.items()
        for pair in pairs.split()
    )
    return f"""SELECT dst, dst_column, src, src_column, CASE dst WHEN 'mart_loan_performance' THEN
                 (SELECT count(*) FROM mart_loan_performance) ELSE (SELECT count(*) FROM mart_customer_360) END AS n_rows
               FROM (VALUES {values}) AS edges(dst, dst_column, src, src_column)"""


@query(_mart_columns_sql())
def lineage_of_marts(spark, d):
    """Source columns of both marts, found in the plans of the registered views, with the marts' rows."""
    staged = {
        "stg_customers": D.customers, "stg_loans": D.loans, "stg_repayments": D.repayments,
        "stg_savings": D.savings, "stg_transactions": D.transactions,
    }
    for name, rows in staged.items():
        register_view(rows(spark, d), name)
    stg = {name: spark.table(name) for name in staged}
    loans = stg["stg_loans"]
    register_view(mart_of_loans(loans, stg["stg_repayments"]), "mart_loan_performance")
    people = mart_of_customers(stg["stg_customers"], loans, stg["stg_savings"], stg["stg_transactions"])
    register_view(people, "mart_customer_360")
    names = ["mart_loan_performance", "mart_customer_360"]
    counts = [
        spark.table(n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("dst"), "n_rows") for n in names
    ]
    return column_edges(spark, names).join(R.union_all(counts), "dst")


def _ask(spark, d, metrics, dims, where=None):
    tables = {"loans": D.loan_mart(spark, d), "customers": D.customer_mart(spark, d)}
    return semantic.semantic_query(semantic.LOAN_PORTFOLIO, tables, metrics, dims, where)


@query(
    """SELECT product_segment, round(avg(is_default), 6) AS npl_rate, count(loan_id) AS total_loans
       FROM mart_loan_performance GROUP BY product_segment"""
)
def semantic_npl_by_product(spark, d):
    out = _ask(spark, d, ["npl_rate", "total_loans"], ["produk"])
    return out.withColumn("npl_rate", F.round("npl_rate", 6))


@query(
    """SELECT c.province, sum(l.outstanding) AS total_outstanding
       FROM mart_loan_performance l LEFT JOIN mart_customer_360 c ON l.customer_id = c.customer_id
       GROUP BY c.province""",
    DOUBLE="total_outstanding",
)
def semantic_outstanding_by_province(spark, d):
    return _ask(spark, d, ["total_outstanding"], ["provinsi"])


@query("SELECT segment, count(customer_id) AS total_customers FROM mart_customer_360 GROUP BY segment")
def semantic_customers_by_segment(spark, d):
    return _ask(spark, d, ["total_customers"], ["segmen nasabah"])


@query(
    """SELECT coalesce(a.province, b.province) AS province, a.total_outstanding, a.npl_rate,
              b.total_customers, b.total_savings
       FROM (SELECT c.province, sum(l.outstanding) AS total_outstanding, round(avg(l.is_default), 6) AS npl_rate
             FROM mart_loan_performance l LEFT JOIN mart_customer_360 c ON l.customer_id = c.customer_id
             GROUP BY c.province) a
       FULL JOIN (SELECT province, count(customer_id) AS total_customers, sum(total_savings_balance) AS total_savings
             FROM mart_customer_360 GROUP BY province) b ON a.province IS NOT DISTINCT FROM b.province""",
    DOUBLE="total_outstanding total_savings",
)
def semantic_mixed_grain(spark, d):
    metrics = ["total_outstanding", "npl_rate", "total_customers", "total_savings"]
    return _ask(spark, d, metrics, ["province"]).withColumn("npl_rate", F.round("npl_rate", 6))


@query(
    f"""SELECT l.dpd_bucket, sum(l.outstanding) AS total_outstanding
        FROM mart_loan_performance l JOIN mart_customer_360 c ON l.customer_id = c.customer_id
        WHERE c.segment = 'Tunaiku' AND l.product_segment = 'SMB' GROUP BY l.dpd_bucket""",
    DOUBLE="total_outstanding",
)
def semantic_filtered(spark, d):
    where = {"segmen nasabah": V.CUSTOMER_SEGMENTS[0], "produk": V.PRODUCT_PREFIXES[1][1]}
    return _ask(spark, d, ["total_outstanding"], ["tunggakan"], where)


# ---- retrieval -----------------------------------------------------------------------

_SEARCH = "pour the annd von est"
_BM25 = {
    "split_docs": r"""
        SELECT doc_id, lang, source,
               list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words
        FROM documents""",
    "postings": """
        SELECT doc_id, doc_len, word, count(*) AS tf
        FROM (SELECT doc_id, len(words) AS doc_len, unnest(words) AS word FROM split_docs)
        WHERE list_contains(string_split('%s', ' '), word) GROUP BY doc_id, doc_len, word"""
    % _SEARCH,
    "in_docs": "SELECT word, count(*) AS df FROM postings GROUP BY word",
    "corpus": "SELECT count(*) AS n_docs, avg(len(words)) AS mean_len FROM split_docs",
    "scored": f"""
        SELECT doc_id, round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * (1.2 + 1)
               / (tf + 1.2 * (1 - 0.75 + 0.75 * doc_len / mean_len))), 6) AS score
        FROM postings p JOIN in_docs i ON p.word = i.word CROSS JOIN corpus GROUP BY doc_id""",
}
_TOP_DOCS = """SELECT s.doc_id, d.lang, d.source, s.score FROM scored s JOIN split_docs d ON s.doc_id = d.doc_id
               ORDER BY s.score DESC, s.doc_id LIMIT 10"""


def _doc_index(spark, d):
    return retrieval.build_index(
        D.table(spark, d, "documents"), "text", "doc_id", ["lang", "source"]
    )


@query(_TOP_DOCS, extra=_BM25)
def bm25_topk(spark, d):
    documents = D.table(spark, d, "documents")
    return retrieval.search_texts(
        documents, "text", "doc_id", _SEARCH, ["lang", "source"], 10
    )


@query("SELECT doc_id, score FROM scored", extra=_BM25)
def bm25_scores(spark, d):
    scores = retrieval.score_documents(_doc_index(spark, d), _SEARCH)
    return scores.withColumn("score", F.round("score", 6))


@query(_TOP_DOCS, extra=_BM25)
def search_response(spark, d):
    path = fresh_path(spark, "index")
    retrieval.write_index(_doc_index(spark, d), path)
    index = retrieval.read_index(spark, path, "doc_id")
    found = retrieval.search(index, _SEARCH, ["lang", "source"], 10)
    schema = "doc_id bigint, lang string, source string, score double"
    return retrieval.parse_results(retrieval.results_json(found, "doc_id"), schema)


@query(
    """SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]),
              (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 6) AS score
       FROM embeddings ORDER BY score DESC, vec_id LIMIT 10"""
)
def vector_topk(spark, d):
    vectors = D.table(spark, d, "embeddings")
    asked = vectors.filter("vec_id = 0").select("embedding").first()[0]
    return retrieval.vector_topk(vectors, asked, 10, "vec_id", "embedding")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, d):
    k = F.from_json("props", "k bigint")["k"].alias("k")
    return D.table(spark, d, "events").select("event_id", k)


# ---- model ---------------------------------------------------------------------------

_FEATURE_ROWS = {
    "feature_rows": "SELECT customer_id, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in _FEATURES)
    + ", CAST(ever_default AS DOUBLE) AS ever_default FROM mart_customer_360"
}


def _features(spark, d):
    return ml.features(D.customer_mart(spark, d))


@query("SELECT * FROM feature_rows", extra=_FEATURE_ROWS)
def ml_features(spark, d):
    return _features(spark, d)


@query(
    """SELECT customer_id,
              CAST(CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 7) AS BIGINT) % 10000 < 2000 AS BIGINT)
                AS is_test
       FROM feature_rows""",
    extra=_FEATURE_ROWS,
)
def ml_split(spark, d):
    train, test = ml.split(_features(spark, d), "customer_id")
    return train.select("customer_id", F.lit(0).alias("is_test")).unionByName(
        test.select("customer_id", F.lit(1).alias("is_test"))
    )


_SUMMARIZED = ["credit_score", "monthly_income", "total_outstanding"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n_values, CAST(min({c}) AS DOUBLE) AS min_value,
                   CAST(max({c}) AS DOUBLE) AS max_value, round(avg(CAST({c} AS DOUBLE)), 3) AS mean_value,
                   round(stddev_samp(CAST({c} AS DOUBLE)), 3) AS stddev_value FROM mart_customer_360"""
        for c in _SUMMARIZED
    )
)
def ml_eda(spark, d):
    out = ml.summarize(D.customer_mart(spark, d), _SUMMARIZED)
    return out.withColumns({c: F.round(c, 3) for c in ("mean_value", "stddev_value")})


@query(f"SELECT ever_default, count(*) AS n_rows FROM mart_customer_360 GROUP BY ever_default")
def ml_target_balance(spark, d):
    return ml.target_balance(D.customer_mart(spark, d))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CASE WHEN stddev_pop({c}) * stddev_pop(ever_default) > 0 THEN round(corr({c}, ever_default), 6) END AS label_corr,
                   count(*) FILTER (WHERE {c} = 0) AS n_zero,
                   round(avg(ever_default) FILTER (WHERE {c} = 0), 6) AS label_rate_at_zero FROM feature_rows"""
        for c in _FEATURES
    ),
    extra=_FEATURE_ROWS,
)
def ml_leakage(spark, d):
    out = ml.leakage(_features(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("label_corr", "label_rate_at_zero")})


@query(
    """SELECT rows_of, n_positive, n_negative,
              CAST(doubled - n_positive * (n_positive + 1) AS DOUBLE) / (2 * CAST(n_positive AS DOUBLE) * n_negative) AS roc_auc
       FROM (SELECT rows_of, count(*) FILTER (label = 1) AS n_positive, count(*) FILTER (label = 0) AS n_negative,
                    sum(doubled) FILTER (label = 1) AS doubled FROM score_ranks GROUP BY rows_of)""",
    extra={
        "score_rows": """
            SELECT 'customers' AS rows_of, ever_default AS label, -floor(credit_score / 5) AS score FROM mart_customer_360
            UNION ALL SELECT 'loans', is_default, dpd FROM mart_loan_performance""",
        "score_ranks": """
            SELECT rows_of, label, 2 * rank() OVER (PARTITION BY rows_of ORDER BY score)
                   + count(*) OVER (PARTITION BY rows_of, score) - 1 AS doubled
            FROM score_rows WHERE score IS NOT NULL AND label IN (0, 1)""",
    },
)
def ml_auc(spark, d):
    """How well a low credit score tells customers, and days past due tell loans, that defaulted."""
    people = D.customer_mart(spark, d).select(
        F.col("ever_default").alias("label"), (-F.floor(F.col("credit_score") / 5)).alias("score")
    )
    loans = D.loan_mart(spark, d).select(F.col("is_default").alias("label"), F.col("dpd").alias("score"))
    parts = [
        ml.roc_auc(rows, "label").select(F.lit(name).alias("rows_of"), "n_positive", "n_negative", "roc_auc")
        for name, rows in (("customers", people), ("loans", loans))
    ]
    return R.union_all(parts)


def _model(spark, d):
    train, test = ml.split(_features(spark, d), "customer_id")
    return ml.train(train), test


@query()
def ml_scores(spark, d):
    model, _ = _model(spark, d)
    return ml.score(model, _features(spark, d))


@query()
def ml_confusion(spark, d):
    model, test = _model(spark, d)
    return ml.confusion(ml.predict(model, test))


@query()
def ml_importance(spark, d):
    model, test = _model(spark, d)
    rows = [*ml.importance(model), *ml.evaluate(ml.predict(model, test)).items()]
    return files.from_rows(spark, rows, "name string, value double")


@query(
    """SELECT customer_id, 1 AS is_probability, 1 AS saved_scores_same FROM feature_rows""",
    extra=_FEATURE_ROWS,
    BIGINT="is_probability saved_scores_same",
)
def ml_scores_in_range(spark, d):
    """Every customer has a probability, and a saved model gives the same one."""
    shared_dir(spark)
    rows = _features(spark, d).checkpoint()
    train, _ = ml.split(rows, "customer_id")
    model, path = ml.train(train), fresh_path(spark, "model")
    ml.save(spark, model, path, "v1", {})
    again = ml.score(ml.load(path, "v1"), rows).withColumnRenamed("predicted_default_probability", "again")
    p = F.col("predicted_default_probability")
    return (
        ml.score(model, rows)
        .join(again, "customer_id")
        .select(
            "customer_id",
            p.between(0, 1).cast("long").alias("is_probability"),
            (p == F.col("again")).cast("long").alias("saved_scores_same"),
        )
    )


@query(
    f"""SELECT CAST(ever_default AS BIGINT) AS actual, count(*) AS n_rows, 1 AS importances_sum_to_one FROM feature_rows
        WHERE CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 7) AS BIGINT) % 10000 < 2000
        GROUP BY ever_default""",
    extra=_FEATURE_ROWS,
    BIGINT="importances_sum_to_one",
)
def ml_matrix_totals(spark, d):
    """The confusion matrix adds up to the test set, and all importances to one."""
    model, test = _model(spark, d)
    whole = abs(sum(w for _, w in ml.importance(model, len(V.FEATURES))) - 1) < 1e-9
    return ml.confusion(ml.predict(model, test)).select(
        "actual",
        (F.col("predicted_0") + F.col("predicted_1")).alias("n_rows"),
        F.lit(int(whole)).alias("importances_sum_to_one"),
    )


# ---- landed files --------------------------------------------------------------------

# Bad tokens by province, as they would arrive in a file.
_TEXT_CUSTOMERS = {
    "landed_customers": """
        SELECT CAST(customer_id AS VARCHAR) AS customer_id, nik, nullif(npwp, '') AS npwp, full_name, gender,
               birth_date, province, city, nullif(segment, '') AS segment, credit_score,
               CASE WHEN province = 'NATION_8' THEN NULL ELSE monthly_income END AS monthly_income,
               phone, email, created_at, updated_at,
               CASE province WHEN 'NATION_5' THEN 'credit_score' WHEN 'NATION_6' THEN 'birth_date' END AS bad
        FROM raw_customers"""
}


def _landed_text(spark, d):
    rows = D.raw_customers(spark, d).drop("_loaded_at")
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    province = F.col("province")
    return text.withColumns(
        {
            "credit_score": F.when(province == "NATION_5", "n/a").otherwise(F.col("credit_score")),
            "birth_date": F.when(province == "NATION_6", "1990-13-45").otherwise(F.col("birth_date")),
            "monthly_income": F.when(province == "NATION_8", "NULL").otherwise(
                F.concat(F.lit(" "), "monthly_income", F.lit(" "))
            ),
        }
    )


#: Rows a landed file holds at most.
_FILE_ROWS = 250_000


def _write_csv(df: DataFrame, path: str) -> str:
    """Files of some rows each: one that is read whole, for its quoted line breaks, is one task's work."""
    rows = df.write.option("header", "true").option("emptyValue", "")
    rows.option("maxRecordsPerFile", _FILE_ROWS).csv(path)
    return path


def _landed(spark, d):
    path = _write_csv(_landed_text(spark, d), fresh_path(spark, "landed"))
    return files.read_csv_positional(spark, path, schemas.RAW_CUSTOMERS)


@query(
    "SELECT * EXCLUDE (bad) FROM landed_customers WHERE bad IS NULL",
    extra=_TEXT_CUSTOMERS,
    DOUBLE="monthly_income",
    VARCHAR="birth_date created_at updated_at",
)
def ingest_good(spark, d):
    good, _ = bronze.split_bad_rows(_landed(spark, d), schemas.RAW_CUSTOMERS)
    return good


@query(
    "SELECT customer_id, bad AS bad_columns FROM landed_customers WHERE bad IS NOT NULL",
    extra=_TEXT_CUSTOMERS,
)
def ingest_rejects(spark, d):
    _, rejects = bronze.split_bad_rows(_landed(spark, d), schemas.RAW_CUSTOMERS)
    return rejects.select(
        F.get_json_object(bronze.RAW_TOKENS, "$.customer_id").alias("customer_id"),
        F.array_join(bronze.BAD_COLUMNS, ",").alias("bad_columns"),
    )


@query(
    """SELECT kind, count(*) AS n_rows FROM (
         SELECT CASE WHEN bad IS NULL THEN 'good' ELSE 'rejected' END AS kind FROM landed_customers
         UNION ALL SELECT CASE WHEN bad IS NULL THEN 'good' ELSE 'rejected' END FROM landed_customers)
       GROUP BY kind""",
    extra=_TEXT_CUSTOMERS,
)
def bronze_append(spark, d):
    out = fresh_path(spark, "bronze")
    landed = bronze.land_rows(_landed(spark, d), schemas.RAW_CUSTOMERS)
    bronze.to_bronze(landed, out)
    bronze.to_bronze(landed, out)
    counts = R.table_counts(
        {"good": bronze.read_bronze(spark, out), "rejected": bronze.read_rejects(spark, out)}
    )
    return counts.select(F.col("table_name").alias("kind"), F.col("n").alias("n_rows"))


def _drifted(spark, d):
    """The customers again, with other column order and spelling, no phone and a new column."""
    rows = D.raw_customers(spark, d).drop("_loaded_at", "phone")
    upper = [F.col(c).cast("string").alias(c.upper()) for c in reversed(rows.columns)]
    tier = F.when(F.col("monthly_income") > 5_000_000, "GOLD").otherwise("SILVER")
    return rows.select(tier.alias("Loyalty_Tier"), *upper)


_DRIFT = {
    "drifted": """
        SELECT CAST(customer_id AS VARCHAR) AS customer_id, nullif(segment, '') AS segment, credit_score,
               CAST(NULL AS VARCHAR) AS phone,
               CASE WHEN monthly_income > 5000000 THEN 'GOLD' ELSE 'SILVER' END AS loyalty_tier
        FROM raw_customers"""
}


def _read_drifted(spark, d):
    path = _write_csv(_drifted(spark, d), fresh_path(spark, "drifted"))
    text = files.read_csv_by_name(spark, path, schemas.RAW_CUSTOMERS, evolve=True)
    good, _ = bronze.split_bad_rows(text, schemas.RAW_CUSTOMERS)
    return good


@query("SELECT * FROM drifted", extra=_DRIFT)
def csv_by_name(spark, d):
    return _read_drifted(spark, d).select(
        "customer_id", "segment", "credit_score", "phone", "loyalty_tier"
    )


@query(
    """SELECT * FROM drifted UNION ALL
       SELECT CAST(customer_id AS VARCHAR), nullif(segment, ''), credit_score, phone, NULL FROM raw_customers""",
    extra=_DRIFT,
)
def schema_evolution(spark, d):
    columns = ["customer_id", "segment", "credit_score", "phone"]
    base = D.raw_customers(spark, d).select(*columns)
    base = bronze.clean_tokens(base.withColumn("customer_id", F.col("customer_id").cast("string")))
    drifted = _read_drifted(spark, d)
    new = drifted.select(*[F.col(c).alias(c.upper()) for c in columns], "loyalty_tier")
    return bronze.append_evolving(base, new)


@query(
    "SELECT account_id, customer_id, account_type, balance, interest_rate, opened_at FROM raw_savings",
    DOUBLE="balance",
    VARCHAR="opened_at",
)
def ndjson_roundtrip(spark, d):
    columns = ["account_id", "customer_id", "account_type", "balance", "interest_rate", "opened_at"]
    path = fresh_path(spark, "savings")
    saved = D.raw_savings(spark, d).select(*columns)
    saved.write.json(path)
    return files.read_ndjson(spark, path, saved.schema)


@query(
    """SELECT event_id, k, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS amount, campaign,
              CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS n_bad, NULL AS line
       FROM (SELECT event_id, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
                    CASE WHEN event_type = 'view' THEN 'c' || user_id % 7 END AS campaign FROM events)
       UNION ALL SELECT NULL, NULL, NULL, NULL, 0, 'torn {' || event_id FROM events WHERE event_id % 10 = 0""",
    BIGINT="n_bad",
    VARCHAR="line",
)
def ndjson_variant(spark, d):
    """Events land as lines with nested properties; some have fields that no schema knows, some an amount
    that is no number, some lines are torn. They are stored as they are, and read by fields later."""
    path, out = fresh_path(spark, "lines"), fresh_path(spark, "variants")
    events = D.table(spark, d, "events")
    broken = F.col("event_id") % 3 == 0
    extra = F.when(
        F.col("event_type") == "view",
        F.struct(F.concat(F.lit("c"), (F.col("user_id") % 7).cast("string")).alias("campaign")),
    )
    amount = F.when(broken, "unknown")
    line = F.struct(
        "event_id",
        F.parse_json("props").alias("props"),
        F.when(broken, F.to_variant_object(F.array(amount))).otherwise(F.parse_json(F.col("value").cast("string"))).alias("amount"),
        extra.alias("extra"),
    )
    lines = events.select(F.to_json(line).alias("value"))
    torn = events.filter("event_id % 10 = 0").select(F.concat(F.lit("torn {"), "event_id").alias("value"))
    lines.unionByName(torn).write.text(path)
    files.read_ndjson_variant(spark, path).write.parquet(out)
    fields = {
        "event_id": ("$.event_id", "bigint"), "k": ("$.props.k", "bigint"),
        "amount": ("$.amount", "double"), "campaign": ("$.extra.campaign", "string"),
    }
    found = files.variant_fields(spark.read.parquet(out), fields)
    return found.select(*fields, F.size("_bad_columns").cast("long").alias("n_bad"), F.col("_line").alias("line"))


@query(
    "SELECT txn_id, account_id, txn_type, amount, txn_ts FROM stg_transactions",
    DOUBLE="amount",
    VARCHAR="txn_ts",
)
def parquet_roundtrip(spark, d):
    path = fresh_path(spark, "transactions")
    columns = ["txn_id", "account_id", "txn_type", "amount", "txn_ts"]
    D.transactions(spark, d).select(*columns).write.parquet(path)
    return files.read_parquet(spark, path)


@query()
def file_ledger(spark, d):
    """Files of two landings, and which of them the ledger of the first has not seen."""
    path = fresh_path(spark, "landing")
    _write_csv(D.raw_savings(spark, d), f"{path}/savings.csv")
    ledger_path = fresh_path(spark, "ledger")
    files.list_files(spark, path).write.parquet(ledger_path)
    _write_csv(D.raw_transactions(spark, d), f"{path}/transactions.csv")
    manifest = files.list_files(spark, path)
    unseen = files.unseen_files(manifest, spark.read.parquet(ledger_path))
    return manifest.select("path", "length").join(
        unseen.select("path", F.lit(True).alias("unseen")), "path", "left"
    )


@query(
    """SELECT CASE WHEN customer_id % 2 = 0 THEN 'good' ELSE 'rejected' END AS whole_lines_only, count(*) AS n_rows,
              count(*) FILTER (WHERE customer_id % 2 = 0) AS n_two_lines FROM raw_customers GROUP BY 1
       UNION ALL SELECT 'multi-line', count(*), count(*) FROM raw_customers""",
)
def ingest_quoted_breaks(spark, d):
    """Names over two lines: read whole where fields may span lines; set aside, both halves, where
    they may not."""
    rows = D.raw_customers(spark, d).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.concat(F.lit("first, "), "full_name", F.lit("\nsecond line")).alias("full_name"),
        F.col("credit_score").cast("string").alias("credit_score"),
    )
    schema = T.StructType([f for f in schemas.RAW_CUSTOMERS if f.name in rows.columns])
    path = _write_csv(rows.select(*schema.names), fresh_path(spark, "breaks"))
    whole, _ = bronze.split_bad_rows(files.read_csv_positional(spark, path, schema), schema)
    counted = whole.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("full_name").rlike("^first, .*\nsecond line$")).alias("n_two_lines"),
    ).select(F.lit("multi-line").alias("whole_lines_only"), "n_rows", "n_two_lines")
    # every other name on one line
    some = rows.withColumn(
        "full_name",
        F.when(F.col("customer_id").cast("long") % 2 == 0, F.replace("full_name", F.lit("\n"), F.lit(" "))).otherwise(
            F.col("full_name")
        ),
    )
    path = _write_csv(some.select(*schema.names), fresh_path(spark, "torn"))
    good, torn = bronze.split_bad_rows(
        files.read_csv_positional(spark, path, schema, multi_line=False), schema
    )
    good = good.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("good").alias("whole_lines_only"), "n_rows", F.col("n_rows").alias("n_two_lines")
    )
    halves = torn.agg((F.count(F.lit(1)) / 2).cast("long").alias("n_rows")).select(
        F.lit("rejected").alias("whole_lines_only"), "n_rows", F.lit(0).alias("n_two_lines")
    )
    return counted.unionByName(good).unionByName(halves)


@query(
    """SELECT account_id, customer_id, CASE WHEN account_id % 3 <> 0 THEN account_type END AS account_type,
              CASE WHEN account_id % 3 <> 0 THEN balance END AS balance
       FROM raw_savings""",
    DOUBLE="balance",
    VARCHAR="account_id customer_id",
)
def ingest_ragged(spark, d):
    """Savings as lines of too few, the right number of, and too many fields."""
    schema = schemas.RAW_SAVINGS
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schema.names]
    number = F.col("account_id").cast("long") % 3
    line = (
        F.when(number == 0, F.concat_ws(",", *text[:2]))
        .when(number == 1, F.concat_ws(",", *text))
        .otherwise(F.concat_ws(",", *text, F.lit("extra"), F.lit("fields")))
    )
    # one column whose name is the header line, under a separator that does not occur
    lines = D.raw_savings(spark, d).select(line.alias(",".join(schema.names)))
    path = fresh_path(spark, "ragged")
    lines.write.option("header", "true").option("sep", "\u0001").option("quote", "").csv(path)
    wide = T.StructType([f if f.name != "balance" else T.StructField("balance", T.DecimalType(18, 2)) for f in schema])
    good, _ = bronze.split_bad_rows(files.read_csv_positional(spark, path, wide), wide)
    return good.select("account_id", "customer_id", "account_type", "balance")


@query(
    """SELECT landing, CAST(count(*) > 0 AS BIGINT) AS has_files, max(unseen) AS unseen FROM (
         SELECT 'savings.csv' AS landing, 0 AS unseen FROM raw_savings
         UNION ALL SELECT 'transactions.csv', 1 FROM raw_transactions) GROUP BY landing""",
    BIGINT="unseen",
)
def file_ledger_flags(spark, d):
    """Which landing's files the ledger has seen, by landing."""
    name = F.regexp_extract("path", r"/([^/]+\.csv)/", 1).alias("landing")
    return (
        file_ledger(spark, d)
        .groupBy(name)
        .agg(
            (F.count(F.lit(1)) > 0).cast("long").alias("has_files"),
            F.max(F.coalesce(F.col("unseen").cast("long"), F.lit(0))).alias("unseen"),
        )
    )


# ---- streams -------------------------------------------------------------------------


def _age_files(spark, path: str, days: int) -> None:
    """Give every file under a path a modification time in the past."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = there.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(there):
        store.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


_LOADED_TWICE = """SELECT account_type, 2 * count(*) AS n_accounts, 2 * count(customer_id) AS n_owned
                   FROM raw_savings GROUP BY account_type"""


def _load_savings(spark, d, deliver, by_name):
    """Deliver the savings twice in some way, loading after each; count what arrived."""
    landing, out, state = (fresh_path(spark, n) for n in ("landing", "savings", "state"))
    schema = schemas.RAW_SAVINGS
    text = D.raw_savings(spark, d).select(*[F.col(c).cast("string").alias(c) for c in schema.names])
    text = text.withColumn("balance", F.lit("1"))
    for turn in (0, 1):
        deliver(text, landing, turn)
        start_load(spark, f"{landing}/*", schema, out, state, by_name=by_name).awaitTermination()
    return bronze.read_bronze(spark, out).groupBy("account_type").agg(
        F.count(F.lit(1)).alias("n_accounts"), F.count("customer_id").alias("n_owned")
    )


@query(_LOADED_TWICE)
def late_file_loaded(spark, d):
    """The second delivery's files are weeks older than what was loaded already."""

    def deliver(text, landing, turn):
        _write_csv(text, f"{landing}/turn={turn}")
        if turn:
            _age_files(spark, f"{landing}/turn={turn}", 40)

    return _load_savings(spark, d, deliver, False)


def _replace_files(spark, path: str, by: str) -> None:
    """Give the files under one path the contents of those under another, their names kept.

    A file that none is left for keeps nothing but its header; one too many comes to lie beside the others.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    listed = [[f.getPath() for f in store.listStatus(hadoop.Path(p))] for p in (path, by)]
    files = [sorted(f.toString() for f in there if f.getName().startswith("part-")) for there in listed]
    for old, new in zip_longest(*files):
        if new is None:
            header = ",".join(header_of(spark, old))
            emptied = store.create(hadoop.Path(old), True)
            emptied.write(f"{header}\n".encode())
            emptied.close()
        elif old is None:
            store.rename(hadoop.Path(new), hadoop.Path(path, hadoop.Path(new).getName()))
        else:
            store.delete(hadoop.Path(old), False)
            store.rename(hadoop.Path(new), hadoop.Path(old))


@query(
    """SELECT account_type, count(*) AS n_accounts, count(customer_id) AS n_owned, sum(balance) AS balance,
              count(DISTINCT account_id) AS n_ids FROM raw_savings GROUP BY account_type""",
    DOUBLE="balance",
)
def replaced_file_loaded(spark, d):
    """Wrong savings land beside right ones; the wrong files are replaced under their names, in two
    steps, and each is loaded. What they held before no longer counts, good rows or rejects."""
    landing, late, out, state = (fresh_path(spark, n) for n in ("landing", "late", "savings", "state"))
    schema = schemas.as_text(schemas.RAW_SAVINGS)
    money = T.DecimalType(18, 2)
    typed = T.StructType(
        [T.StructField(f.name, money if f.name == "balance" else f.dataType) for f in schemas.RAW_SAVINGS]
    )
    rows = D.raw_savings(spark, d).select(*[F.col(c).cast("string").alias(c) for c in schema.names])
    even = F.xxhash64("account_id") % 2 == 0
    # every content in as many files, which even all rows twice fill by half only: none is written as two
    n_files = max(3, math.ceil(4 * rows.filter(even).count() / _FILE_ROWS))
    right = rows.filter(even).repartition(n_files)
    twice = right.unionByName(right).withColumn("account_type", F.lit("GONE"))
    torn = right.withColumn("balance", F.lit("no number"))
    _write_csv(rows.filter(~even), f"{landing}/a")
    _write_csv(twice.coalesce(n_files), f"{landing}/b")
    load_landed(spark, f"{landing}/*", typed, out, state)
    for n, content in enumerate((torn, right)):
        _write_csv(content.coalesce(n_files), f"{late}/{n}")
        _replace_files(spark, f"{landing}/b", f"{late}/{n}")
        for _ in range(2):
            load_landed(spark, f"{landing}/*", typed, out, state)
    loaded = bronze.read_bronze(spark, out).unionByName(
        bronze.read_rejects(spark, out).select(F.lit("REJECT").alias("account_type")), True
    )
    return loaded.groupBy("account_type").agg(
        F.count(F.lit(1)).alias("n_accounts"), F.count("customer_id").alias("n_owned"),
        F.sum("balance").alias("balance"), F.count_distinct("account_id").alias("n_ids"),
    )


@query(_LOADED_TWICE)
def mixed_headers(spark, d):
    """Two files side by side whose columns stand in another order."""

    def deliver(text, landing, turn):
        if not turn:
            _write_csv(text, f"{landing}/a")
            _write_csv(text.select(*reversed(text.columns)), f"{landing}/b")

    return _load_savings(spark, d, deliver, True)


@query(
    """SELECT loyalty_tier, count(*) AS n_rows, count(phone) AS n_phones FROM (
         SELECT * FROM drifted UNION ALL SELECT CAST(customer_id AS VARCHAR), segment, credit_score, phone, NULL FROM raw_customers)
       GROUP BY loyalty_tier""",
    extra=_DRIFT,
)
def drift_in_daily_load(spark, d):
    """The day's load with a delivery of drifted customers beside the usual one."""
    landing, out = fresh_path(spark, "landing"), fresh_path(spark, "bronze")
    file, schema = schemas.RAW_TABLES["raw_customers"]
    _write_csv(D.raw_customers(spark, d).select(*schema.names), f"{landing}/{file}")
    for extra in schemas.DRIFT_DELIVERIES["raw_customers"]:
        _write_csv(_drifted(spark, d), f"{landing}/{extra}")
    only = {"raw_customers": schemas.RAW_TABLES["raw_customers"]}
    for _ in range(2):
        ingest_bronze(spark, landing, out, only, schemas.DRIFT_DELIVERIES)
    loaded = bronze.read_bronze(spark, f"{out}/raw_customers")
    return loaded.groupBy("loyalty_tier").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("phone").alias("n_phones")
    )


@query(
    """SELECT product_type, count(*) AS n_loans, sum(outstanding) AS outstanding FROM (
         SELECT product_type, outstanding FROM raw_loans UNION ALL SELECT product_type, outstanding FROM raw_loans)
       GROUP BY product_type""",
    DOUBLE="outstanding",
)
def stream_ingest_once(spark, d):
    """Land the loans, load twice, land them again under new names, load again: two copies."""
    landing, out, state = (fresh_path(spark, n) for n in ("landing", "loans", "state"))
    money = T.DecimalType(18, 2)
    schema = T.StructType(
        [
            T.StructField(f.name, money if isinstance(f.dataType, T.DecimalType) else f.dataType)
            for f in schemas.RAW_LOANS
        ]
    )
    loans = D.raw_loans(spark, d).select(*schema.names)

    def land():
        loans.write.mode("append").option("header", "true").csv(landing)

    def load():
        start_load(spark, landing, schema, out, state).awaitTermination()

    land()
    load()
    load()
    land()
    load()
    loaded = bronze.read_bronze(spark, out)
    return loaded.groupBy("product_type").agg(
        F.count(F.lit(1)).alias("n_loans"), F.sum("outstanding").alias("outstanding")
    )


@query(
    "SELECT metric_name, table_name, value FROM ("
    + _METRICS.format(at="first", table="customers", src="stg_customers")
    + ") UNION ALL SELECT metric_name, table_name, value FROM ("
    + _METRICS.format(at="second", table="customers", src="twice")
    + ")",
    extra={"twice": "SELECT * FROM stg_customers UNION ALL SELECT * FROM stg_customers"},
)
def stream_metrics(spark, d):
    """Measure the customers, append them once more, and measure again."""
    path, out, state = (fresh_path(spark, n) for n in ("customers", "metrics", "state"))
    rows = D.customers(spark, d)
    for _ in range(2):
        rows.write.mode("append").parquet(path)
        start_metrics(
            spark, path, "customers", Q.standard_metrics(), out, state, buckets=8
        ).awaitTermination()
    return read_metrics(spark, out).select("metric_name", "table_name", "value")


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS state, metric_name, table_name, value FROM ("
        + _METRICS.format(at=n, table="customers", src=n) + ")"
        for n in ("wrong", "stg_customers", "known")
    ),
    extra={
        "wrong": """SELECT customer_id - customer_id % 3 AS customer_id, CAST(NULL AS VARCHAR) AS email, 9 AS credit_score
                    FROM stg_customers""",
        "known": "SELECT customer_id, email, credit_score FROM stg_customers WHERE email IS NOT NULL",
    },
)
def stream_metrics_replaced(spark, d):
    """Customers arrive wrong, are replaced by the right ones, and those without an address are removed."""
    path, out, state = (fresh_path(spark, n) for n in ("customers", "metrics", "state"))
    rows = D.customers(spark, d).select("customer_id", "email", "credit_score")
    wrong = rows.select(
        (F.col("customer_id") - F.col("customer_id") % 3).alias("customer_id"),
        F.lit(None).cast("string").alias("email"),
        F.lit(9).cast("long").alias("credit_score"),
    )
    nobody = rows.filter("email IS NULL")
    steps = (signed(wrong), signed(rows, wrong), signed(rows.limit(0), nobody))
    for rows in steps:
        rows.write.mode("append").parquet(path)
        start_metrics(
            spark, path, "customers", Q.standard_metrics(), out, state, buckets=8
        ).awaitTermination()
    step = F.regexp_extract("_metadata.file_path", "/batch=([0-9]+)/", 1).cast("int")
    names = F.element_at(F.array(*map(F.lit, ("wrong", "stg_customers", "known"))), step + 1)
    found = spark.read.parquet(out).select(names.alias("state"), "metric_name", "table_name", "value")
    return found


@query(_TOP_DOCS, extra=_BM25)
def stream_index(spark, d):
    """Index the English documents, then the others as they arrive, and search."""
    path, out, state = (fresh_path(spark, n) for n in ("documents", "index", "state"))
    documents = D.table(spark, d, "documents")
    english = F.col("lang") == "en"
    for part in (documents.filter(english), documents.filter(~english | F.col("lang").isNull())):
        part.write.mode("append").parquet(path)
        start_indexing(
            spark, path, documents.schema, "text", "doc_id", ["lang", "source"], out, state, None, buckets=8
        ).awaitTermination()
    index = kept_index(spark, documents.schema, "doc_id", ["lang", "source"], out, 8).read()
    return retrieval.search(index, _SEARCH, ["lang", "source"], 10)


@query(_TOP_DOCS, extra=_BM25)
def stream_index_replaced(spark, d):
    """Every document is delivered with another's text first, half of them again as they are, then
    all; one more is delivered and taken back. The search sees the newest texts only."""
    path, out, state = (fresh_path(spark, n) for n in ("documents", "index", "state"))
    rows = D.table(spark, d, "documents").withColumn("gone", F.lit(False))
    wrong = rows.withColumn("text", F.concat(F.lit(f"{_SEARCH} "), F.reverse("text")))
    more = rows.agg(F.max("doc_id").alias("doc_id")).select(
        (F.col("doc_id") + 1).alias("doc_id"), F.lit(_SEARCH).alias("text"), F.lit("en").alias("lang"),
        F.lit("x").alias("source"), F.lit(1).cast("long").alias("n_chars"), F.lit(False).alias("gone"),
    )
    for part in (
        wrong.unionByName(more),
        rows.filter("doc_id % 2 = 0"),
        rows.unionByName(more.withColumn("gone", F.lit(True))),
    ):
        part.write.mode("append").parquet(path)
        start_indexing(
            spark, path, rows.schema, "text", "doc_id", ["lang", "source"], out, state, None, "gone", 8
        ).awaitTermination()
    index = kept_index(spark, rows.schema, "doc_id", ["lang", "source"], out, 8).read()
    return retrieval.search(index, _SEARCH, ["lang", "source"], 10)


@query(_TOP_DOCS, extra=_BM25)
def stream_index_merged(spark, d):
    """Documents arrive in six batches, many of them again with another text, so that parts are merged
    and what they superseded is dropped; a last batch takes foreign documents back."""
    rows = D.table(spark, d, "documents").withColumn("gone", F.lit(False))
    kept = kept_index(spark, rows.schema, "doc_id", ["lang", "source"], fresh_path(spark, "index"), 8)
    fifth = F.pmod(F.xxhash64("doc_id"), F.lit(5))
    wrong = rows.withColumn("text", F.concat(F.lit(f"{_SEARCH} "), "text"))
    foreign = wrong.filter("doc_id % 50 = 0").withColumn("doc_id", F.col("doc_id") + 10_000_000)
    parts = [wrong.filter(fifth <= n) for n in range(4)]
    parts += [foreign.unionByName(rows.filter(fifth == 0)), rows.filter(fifth != 0)]
    parts.append(foreign.withColumn("gone", F.lit(True)))
    for number, part in enumerate(parts, 1):
        index = retrieval.build_index(part, "text", "doc_id", ["lang", "source"], "gone")
        for _ in range(2):
            kept.add(index, number)
    return retrieval.search(kept.read(), _SEARCH, ["lang", "source"], 10)


@query(
    """SELECT 'ingest' AS step, table_name AS object, n AS n_rows, 'done' AS status FROM (
         SELECT 'raw_customers' AS table_name, count(*) AS n FROM raw_customers
         UNION ALL SELECT 'raw_loans', count(*) FROM raw_loans
         UNION ALL SELECT 'raw_repayments', count(*) FROM raw_repayments
         UNION ALL SELECT 'raw_savings', count(*) FROM raw_savings
         UNION ALL SELECT 'raw_transactions', count(*) FROM raw_transactions)
       UNION ALL SELECT 'snapshot', 'dim_customers_scd2', count(*), 'done' FROM raw_customers
       UNION ALL SELECT 'build', 'mart_loan_performance', count(*), 'done' FROM raw_loans
       UNION ALL SELECT 'build', 'mart_customer_360', count(*), 'done' FROM raw_customers
       UNION ALL SELECT 'test', 'test_results', count(*), CASE WHEN max(failures) > 0 THEN 'fail' ELSE 'pass' END
                 FROM test_report
       UNION ALL SELECT 'gate', 'dq_verdict', total_issues, CASE WHEN total_issues = 0 THEN 'pass' ELSE 'fail' END
                 FROM gate_counts""",
    extra={"test_report": _tests_sql(), "gate_counts": _GATE.format(c="stg_customers")},
)
def daily_refresh_report(spark, d):
    """Land all five tables as text, then run the whole day."""
    landing, root = fresh_path(spark, "landing"), fresh_path(spark, "lakehouse")
    for name, (file, schema) in schemas.RAW_TABLES.items():
        _write_csv(getattr(D, name)(spark, d).select(*schema.names), f"{landing}/{file}")
    return daily_refresh(spark, landing, root, D.AS_OF, buckets=8)
