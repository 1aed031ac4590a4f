"""Pre-aggregated facts per loan, customer or account.

All of them are plain grouped sums: Spark combines rows before the shuffle,
so a loan or account that holds a large share of the rows costs one row per
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F




def repay_by_loan(repayments: DataFrame) -> DataFrame:
    """Per loan: installments, sums due, paid and late, worst days late (may be negative)."""
    return repayments.groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("n_installments"),
        F.sum("amount_due").alias("total_due"),
        F.sum("amount_paid").alias("total_paid"),
        F.sum("is_late").alias("n_late"),
        F.max("days_late").alias("max_days_late"),
    )


def loans_by_customer(loans: DataFrame) -> DataFrame:
    return loans.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.sum("plafond").alias("total_plafond"),
        F.sum("outstanding").alias("total_outstanding"),
        F.max("is_default").alias("ever_default"),
    )


def savings_by_customer(savings: DataFrame) -> DataFrame:
    return savings.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_accounts"), F.sum("balance").alias("total_balance")
    )


def txn_by_account(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n_txn"), F.sum("amount").alias("amount")
    )


def txn_with_owner(transactions: DataFrame, savings: DataFrame) -> DataFrame:
    """Transactions with the account's customer; those without an account are dropped."""
    return transactions.join(savings.select("account_id", "customer_id"), "account_id")


def txn_by_customer(transactions: DataFrame, savings: DataFrame) -> DataFrame:
    """Per customer: transactions and their amount. Summed per account before the
    join, so the join moves one row per account instead of every transaction."""
    accounts = savings.select("account_id", "customer_id")
    return (
        accounts.join(txn_by_account(transactions), "account_id")
        .groupBy("customer_id")
        .agg(F.sum("n_txn").alias("n_txn"), F.sum("amount").alias("total_txn_amount"))
    )


def customer_facts(loans: DataFrame, savings: DataFrame, transactions: DataFrame) -> DataFrame:
    """Loans, savings and transactions per customer in one grouped pass.

    The three fact sets are stacked and summed together: one shuffle on the
    customer instead of three, and one join for whoever attaches the result.
    """
    loan_rows = loans.select(
        "customer_id", F.lit(1).alias("n_loans"), "plafond", "outstanding", "is_default"
    )
    accounts = savings.select("account_id", "customer_id", "balance")
    per_account = txn_by_account(transactions)
    account_rows = accounts.join(per_account, "account_id", "left").select(
        "customer_id", F.lit(1).alias("n_accounts"), "balance", "n_txn", "amount"
    )
    return (
        loan_rows.unionByName(account_rows, allowMissingColumns=True)
        .groupBy("customer_id")
        .agg(
            F.sum("n_loans").alias("n_loans"),
            F.sum("plafond").alias("total_plafond"),
            F.sum("outstanding").alias("total_outstanding"),
            F.max("is_default").alias("ever_default"),
            F.sum("n_accounts").alias("n_savings_accounts"),
            F.sum("balance").alias("total_savings_balance"),
            F.sum("n_txn").alias("n_transactions"),
            F.sum("amount").alias("total_txn_amount"),
        )
    )
