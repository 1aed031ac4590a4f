"""The two marts: loan performance and customer 360."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.functions.cleaning import safe_ratio
from lendmill.operators.facts import customer_facts, repay_by_loan
from lendmill.operators.relations import zero_filled


def mart_loan_performance(loans: DataFrame, repayments: DataFrame) -> DataFrame:
    """One row per staged loan with its repayment record."""
    slim = loans.select(
        "loan_id",
        "customer_id",
        "product_segment",
        "product_type",
        "status",
        "dpd",
        "dpd_bucket",
        "is_default",
        "plafond",
        "outstanding",
        "interest_rate",
        "disbursed_at",
    )
    joined = slim.join(repay_by_loan(repayments), "loan_id", "left")
    ratio = safe_ratio(F.col("total_paid"), F.col("total_due"))
    return zero_filled(
        joined.withColumn("collection_ratio", ratio),
        ["n_installments", "total_due", "total_paid", "n_late", "max_days_late"],
    )


def mart_customer_360(
    customers: DataFrame, loans: DataFrame, savings: DataFrame, transactions: DataFrame
) -> DataFrame:
    """One row per staged customer row with loans, savings and transactions."""
    slim = customers.select(
        "customer_id",
        "full_name",
        "segment",
        "province",
        "city",
        "age",
        "credit_score",
        "monthly_income",
    )
    facts = customer_facts(loans, savings, transactions)
    return zero_filled(
        slim.join(facts, "customer_id", "left"),
        [c for c in facts.columns if c != "customer_id"],
    )
