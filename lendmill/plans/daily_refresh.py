"""One day's work: load, keep history, build, test, gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.operators import quality as Q
from lendmill.operators import staging as S
from lendmill.operators.history import scd2_step
from lendmill.operators.relations import union_all
from lendmill.plans.mart_upkeep import MartUpkeep
from lendmill.schemas import RAW_TABLES
from lendmill.sources.bronze import read_bronze
from lendmill.sources.buckets import BUCKETS
from lendmill.sources.changes import Feed
from lendmill.sources.warehouse import (
    publish_versions,
    read_versions,
    register_view,
    target_path,
    write_table,
)
from lendmill.streaming.landing import ingest_bronze

HISTORY_KEY = "customer_id"
HISTORY_COLUMNS = [
    "customer_id",
    "nik",
    "full_name",
    "province",
    "city",
    "segment",
    "credit_score",
    "monthly_income",
    "updated_at",
]
HISTORY_CHECKED = ["province", "city", "segment", "credit_score", "monthly_income"]


def staged_tables(raw: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    return {
        "stg_customers": S.stg_customers(raw["raw_customers"], as_of),
        "stg_loans": S.stg_loans(raw["raw_loans"]),
        "stg_repayments": S.stg_repayments(raw["raw_repayments"]),
        "stg_savings": S.stg_savings(raw["raw_savings"]),
        "stg_transactions": S.stg_transactions(raw["raw_transactions"]),
    }


def snapshot_customers(spark: SparkSession, root: str, newest: DataFrame, at) -> DataFrame:
    """Bring the customer history up to date; one row per customer goes in."""
    path = target_path(root, "dim_customers_scd2", "silver")
    known = read_versions(spark, path, closed=False)
    source = newest.select(*HISTORY_COLUMNS)
    publish_versions(scd2_step(known, source, HISTORY_KEY, HISTORY_CHECKED, at), path)
    return read_versions(spark, path)


def with_repeated(tests: DataFrame, test: str, repeated: DataFrame) -> DataFrame:
    """The report with keys that one load brought more than once among a test's failures, though
    only one row of each is left."""
    more = F.when(F.col("test_name") == test, F.coalesce(repeated.scalar(), F.lit(0))).otherwise(F.lit(0))
    failures = (F.col("failures") + more).cast("long")
    counted = tests.withColumn("failures", failures)
    return counted.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def daily_refresh(spark: SparkSession, landing: str, root: str, as_of, buckets: int = BUCKETS) -> DataFrame:
    """Run every step in order and report step, object, rows and status.

    Staged tables stay views. Loans, customers and marts are kept in buckets, and a day rewrites
    those that what came or went falls into; a day that died half-way is taken up again.
    """
    ingest_bronze(spark, landing, f"{root}/bronze")
    paths = {name: target_path(root, name, "bronze") for name in RAW_TABLES}
    raw = {name: read_bronze(spark, path) for name, path in paths.items()}
    upkeep = MartUpkeep(spark, root, raw, buckets)
    feed = Feed(spark, paths, target_path(root, "_feed", "silver"))
    number, changes = feed.plan()
    upkeep.apply(changes, number)
    feed.done(number)
    history = snapshot_customers(spark, root, upkeep.customers(), as_of)
    # a loan delivered again replaces what was known of it
    staged = staged_tables(raw | {"raw_loans": upkeep.loans()}, as_of)
    for name, df in staged.items():
        register_view(df, name)
    gold = {
        "mart_loan_performance": upkeep.loan_mart(),
        "mart_customer_360": upkeep.customer_mart(as_of),
    }
    for name, df in gold.items():
        register_view(df, name)
    tests = Q.run_tests({**staged, **gold}, Q.standard_tests())
    tests = with_repeated(tests, "unique_stg_loans_loan_id", upkeep.repeated_loans())
    tests = write_table(tests, target_path(root, "test_results", "gold"))
    gate = Q.dq_gate(staged["stg_customers"], staged["stg_loans"], as_of)
    gate = write_table(gate, target_path(root, "dq_verdict", "gold"))

    def counted(step: str, tables: dict[str, DataFrame]) -> list[DataFrame]:
        return [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(step).alias("step"),
                F.lit(name).alias("object"),
                "n_rows",
                F.lit("done").alias("status"),
            )
            for name, df in tables.items()
        ]

    failing = F.count_if(F.col("status") == "fail")
    report = [
        *counted("ingest", raw),
        *counted("snapshot", {"dim_customers_scd2": history}),
        *counted("build", gold),
        tests.agg(F.count(F.lit(1)).alias("n_rows"), failing.alias("bad")).select(
            F.lit("test").alias("step"),
            F.lit("test_results").alias("object"),
            "n_rows",
            F.when(F.col("bad") == 0, "pass").otherwise("fail").alias("status"),
        ),
        gate.select(
            F.lit("gate").alias("step"),
            F.lit("dq_verdict").alias("object"),
            F.col("total_issues").alias("n_rows"),
            F.lower("status").alias("status"),
        ),
    ]
    return union_all(report)
