"""Staged views: cleaned, derived and bucketed columns; rows without a key are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions import cleaning as C
from lendmill.functions import lending as L


def _col(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def stg_customers(raw: DataFrame, as_of=None) -> DataFrame:
    return raw.filter(F.col("customer_id").isNotNull()).select(
        "customer_id",
        "nik",
        C.blank_to_null(F.col("npwp")).alias("npwp"),
        C.title_words(F.col("full_name")).alias("full_name"),
        F.upper("gender").alias("gender"),
        "birth_date",
        C.years_between(F.col("birth_date"), _col(as_of)).alias("age"),
        "province",
        "city",
        "segment",
        "credit_score",
        "monthly_income",
        "phone",
        F.lower("email").alias("email"),
        "created_at",
        "updated_at",
        "_loaded_at",
    )


def stg_loans(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("loan_id").isNotNull()).select(
        "loan_id",
        "customer_id",
        "product_type",
        L.product_segment(F.col("product_type")).alias("product_segment"),
        "plafond",
        "tenor_months",
        "interest_rate",
        "disbursed_at",
        "status",
        "dpd",
        "is_default",
        L.dpd_bucket(F.col("dpd")).alias("dpd_bucket"),
        "outstanding",
        "updated_at",
        "_loaded_at",
    )


def stg_repayments(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("repayment_id").isNotNull()).select(
        "repayment_id",
        "loan_id",
        "due_date",
        "paid_date",
        "amount_due",
        "amount_paid",
        (F.col("amount_due") - F.col("amount_paid")).alias("shortfall"),
        C.days_between(F.col("due_date"), F.col("paid_date")).alias("days_late"),
        "is_late",
        "_loaded_at",
    )


def stg_savings(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("account_id").isNotNull()).select(
        "account_id",
        "customer_id",
        "account_type",
        "balance",
        "interest_rate",
        "opened_at",
        "status",
        "_loaded_at",
    )


def stg_transactions(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("txn_id").isNotNull()).select(
        "txn_id",
        "account_id",
        "txn_type",
        "channel",
        "amount",
        "txn_ts",
        C.month_start(F.col("txn_ts")).alias("txn_month"),
        "_loaded_at",
    )
