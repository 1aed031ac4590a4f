"""Portfolio questions and dashboard aggregates over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators.relations import sort_desc


def _count():
    return F.count(F.lit(1))



def npl_by_segment(mlp: DataFrame) -> DataFrame:
    """Loans, defaults, non-performing percentage and outstanding per product line."""
    share = (100 * F.sum("is_default")).cast("decimal(20,0)") / _count().cast("decimal(20,0)")
    out = mlp.groupBy("product_segment").agg(
        _count().alias("n_loans"),
        F.sum("is_default").alias("n_default"),
        F.round(share, 2).alias("npl_rate_pct"),
        F.sum("outstanding").alias("total_outstanding"),
    )
    return sort_desc(out, "npl_rate_pct", "product_segment")


def dpd_distribution(mlp: DataFrame) -> DataFrame:
    return (
        mlp.groupBy("dpd_bucket")
        .agg(_count().alias("n_loans"), F.sum("outstanding").alias("outstanding"))
        .orderBy("dpd_bucket")
    )


def province_profile(c360: DataFrame, dropna: bool = False) -> DataFrame:
    """Customers, savings and average score per province, largest first."""
    rows = c360.filter(F.col("province").isNotNull()) if dropna else c360
    out = rows.groupBy("province").agg(
        _count().alias("n_customers"),
        F.sum("total_savings_balance").alias("savings_balance"),
        F.avg("credit_score").alias("avg_score"),
    )
    return sort_desc(out, "n_customers", "province")


def province_segment(mlp: DataFrame, c360: DataFrame) -> DataFrame:
    """Loans, average collection ratio and outstanding per province and product line.

    Loans are summed per customer and line, customers per id and province,
    before they meet: the join moves sums, and a customer with a large share
    of the loans is one row per line on either side.
    """
    per_loan = mlp.groupBy("customer_id", "product_segment").agg(
        _count().alias("loans"),
        F.sum("collection_ratio").alias("ratio_sum"),
        F.count("collection_ratio").alias("ratio_n"),
        F.sum("outstanding").alias("outstanding"),
    )
    per_customer = c360.groupBy("customer_id", "province").agg(_count().alias("copies"))
    times = F.col("copies")
    out = (
        per_loan.join(per_customer, "customer_id")
        .groupBy("province", "product_segment")
        .agg(
            F.sum(F.col("loans") * times).alias("loans"),
            (
                F.sum((F.col("ratio_sum") * times)).cast("double")
                / F.nullif(F.sum(F.col("ratio_n") * times), F.lit(0))
            ).alias("avg_collection"),
            F.sum(F.col("outstanding") * times).alias("outstanding"),
        )
    )
    return out.orderBy(F.col("outstanding").desc_nulls_last(), "province", "product_segment")


def loans_with_customer(mlp: DataFrame, c360: DataFrame) -> DataFrame:
    """Loan rows with their customer's columns, for row-level use."""
    extra = [c for c in c360.columns if c == "customer_id" or c not in mlp.columns]
    return mlp.join(c360.select(*extra), "customer_id")


def portfolio_kpis(mlp: DataFrame, c360: DataFrame) -> DataFrame:
    """One row: loans, non-performing percentage, outstanding in billions, customers."""
    customers = c360.agg(_count()).scalar()
    return mlp.agg(
        _count().alias("total_loans"),
        F.coalesce(100 * F.avg("is_default"), F.lit(0.0)).alias("npl_rate_pct"),
        F.coalesce(F.sum("outstanding").cast("double") / 1e9, F.lit(0.0)).alias("outstanding_bn"),
    ).withColumn("total_customers", customers)


def segment_summary(mlp: DataFrame) -> DataFrame:
    """Loans, outstanding and default share per product line; half-even rounding."""
    return mlp.groupBy("product_segment").agg(
        F.count("loan_id").alias("loans"),
        F.sum("outstanding").alias("outstanding"),
        F.avg("is_default").alias("npl"),
        F.bround(F.avg("is_default") * 100, 2).alias("npl_pct"),
    )


def provinces_of_segment(c360: DataFrame, segment: str) -> DataFrame:
    """The province profile of one customer segment; the filter comes first."""
    return province_profile(c360.filter(F.col("segment") == segment))

