"""The lending tables as seen through the star-schema test tables.

Orders stand in for loans, line items for repayments, events for
transactions. Some values are bent on purpose (short ids, missing provinces,
accounts nobody transacts on) so that every rule has rows to catch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.fixed_values import ACCOUNT_TYPES, CUSTOMER_SEGMENTS, OPEN_PROVINCE
from lendmill.operators import staging as S
from lendmill.plans.marts import mart_customer_360, mart_loan_performance

LOADED_AT = "2026-06-01 02:00:00"
AS_OF = "2026-06-30"

# Stand-in values: test-table value -> lending value.
SEGMENT_OF = {
    "BUILDING": CUSTOMER_SEGMENTS[0],
    "AUTOMOBILE": CUSTOMER_SEGMENTS[0],
    "MACHINERY": CUSTOMER_SEGMENTS[1],
    "HOUSEHOLD": CUSTOMER_SEGMENTS[2],
}
PRODUCT_OF = {
    "1-URGENT": f"{CUSTOMER_SEGMENTS[0]} A",
    "2-HIGH": f"{CUSTOMER_SEGMENTS[0].lower()} B",
    "3-MEDIUM": f"{CUSTOMER_SEGMENTS[2]} C",
    "4-NOT SPECIFIED": f"{CUSTOMER_SEGMENTS[2].lower()} D",
}
STATUS_OF = {"O": "LANCAR", "P": "LUNAS", "F": "DPD90"}
ACCOUNT_OF = {"BUILDING": ACCOUNT_TYPES[1], "MACHINERY": "GIRO"}


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer is read for the schema once per path, not per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _mapped(c: str, values: dict[str, str], otherwise) -> Column:
    first, *rest = values.items()
    rule = F.when(F.col(c) == first[0], first[1])
    rule = reduce(lambda r, kv: r.when(F.col(c) == kv[0], kv[1]), rest, rule)
    return rule.otherwise(otherwise)


def _stamp() -> Column:
    return F.lit(LOADED_AT).cast("timestamp_ntz")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    key, nat = F.col("c_custkey"), F.col("c_nationkey")
    digits = F.when(nat == 7, 10).otherwise(16)
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        key.alias("customer_id"),
        F.lpad(key.cast("string"), digits, F.lit("0")).alias("nik"),
        F.when(F.col("c_mktsegment") == "BUILDING", "")
        .otherwise(F.lpad(key.cast("string"), 15, "9"))
        .alias("npwp"),
        F.lower("c_name").alias("full_name"),
        F.when(key % 2 == 0, "m").otherwise("f").alias("gender"),
        F.date_add(F.lit("1960-01-01").cast("date"), (key % 16000).cast("int")).alias("birth_date"),
        F.when(nat == 0, OPEN_PROVINCE).when(nat != 9, F.col("n_name")).alias("province"),
        F.concat(F.lit("CITY_"), (key % 7).cast("string")).alias("city"),
        F.when(nat == 11, "")
        .otherwise(_mapped("c_mktsegment", SEGMENT_OF, F.lit("Personal")))
        .alias("segment"),
        (F.floor(F.col("c_acctbal") / 16).cast("long") + 360).alias("credit_score"),
        F.floor(F.col("c_acctbal") * 1000).cast("decimal(18,0)").alias("monthly_income"),
        F.concat(F.lit("08"), F.lpad(key.cast("string"), 9, "0")).alias("phone"),
        F.when(nat != 3, F.concat(F.replace("c_name", F.lit("#"), F.lit("")), F.lit("@Example.co.id"))).alias(
            "email"
        ),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit("2024-06-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
        _stamp().alias("_loaded_at"),
    )


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, price = F.col("o_orderstatus"), F.col("o_totalprice").cast("decimal(18,2)")
    unknown_dpd = (status == "P") & (F.col("o_orderpriority") == "5-LOW")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("loan_id"),
        # some loans point at customers that do not exist
        F.when(F.col("o_orderkey") % 97 == 0, F.col("o_custkey") + 5_000_000_000)
        .otherwise(F.col("o_custkey"))
        .alias("customer_id"),
        # nearly, but not quite, the product lines
        F.when(F.col("o_orderkey") % 23 == 1, "Tunai E")
        .when(F.col("o_orderkey") % 23 == 2, "SM B F")
        .otherwise(_mapped("o_orderpriority", PRODUCT_OF, F.lit(None).cast("string")))
        .alias("product_type"),
        price.alias("plafond"),
        (F.col("o_orderkey") % 6 * 6 + 6).alias("tenor_months"),
        (F.col("o_orderkey") % 25 + 12).cast("double").alias("interest_rate"),
        F.col("o_orderdate").cast("date").alias("disbursed_at"),
        _mapped("o_orderstatus", STATUS_OF, status).alias("status"),
        F.when(status == "O", 0)
        .when(~unknown_dpd, F.col("o_orderkey") % 131 - 5)
        .cast("long")
        .alias("dpd"),
        (status == "F").cast("long").alias("is_default"),
        F.when(status == "P", 0).otherwise(price).cast("decimal(18,2)").alias("outstanding"),
        F.col("o_orderdate").alias("updated_at"),
        _stamp().alias("_loaded_at"),
    )


def raw_repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = F.col("l_extendedprice").cast("decimal(18,2)")
    paid_on = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("repayment_id"),
        F.col("l_orderkey").alias("loan_id"),
        F.date_sub(paid_on, (F.col("l_partkey") % 29 - 3).cast("int")).alias("due_date"),
        paid_on.alias("paid_date"),
        due.alias("amount_due"),
        (due * (1 - F.col("l_discount")).cast("decimal(4,2)")).alias("amount_paid"),
        (F.col("l_returnflag") == "R").cast("long").alias("is_late"),
        _stamp().alias("_loaded_at"),
    )


def raw_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") == 13, key + 1_000_000_000).otherwise(key).alias("account_id"),
        (key - key % 2).alias("customer_id"),
        _mapped("c_mktsegment", ACCOUNT_OF, F.lit(ACCOUNT_TYPES[0])).alias("account_type"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
        (F.col("c_nationkey") / 10).alias("interest_rate"),
        F.date_add(F.lit("2021-06-01").cast("date"), (key % 1700).cast("int")).alias("opened_at"),
        F.when(F.col("c_acctbal") < 0, "DORMANT").otherwise("ACTIVE").alias("status"),
        _stamp().alias("_loaded_at"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("account_id"),
        F.upper("event_type").alias("txn_type"),
        F.when(F.col("event_type") == "view", "QRIS").otherwise("MOBILE_APP").alias("channel"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.col("ts").alias("txn_ts"),
        _stamp().alias("_loaded_at"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stg_customers(raw_customers(spark, sf_dir), AS_OF)


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stg_loans(raw_loans(spark, sf_dir))


def repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stg_repayments(raw_repayments(spark, sf_dir))


def savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stg_savings(raw_savings(spark, sf_dir))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stg_transactions(raw_transactions(spark, sf_dir))


def loan_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_loan_performance(loans(spark, sf_dir), repayments(spark, sf_dir))


def customer_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_customer_360(
        customers(spark, sf_dir),
        loans(spark, sf_dir),
        savings(spark, sf_dir),
        transactions(spark, sf_dir),
    )


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later state of the customers: one segment moved and got a new score, one only changed
    its names, one left; suppliers joined as new customers."""
    columns = ["customer_id", "full_name", "province", "segment", "credit_score"]
    now = customers(spark, sf_dir).select(*columns)
    moved = F.col("segment") == CUSTOMER_SEGMENTS[0]
    renamed = F.col("segment") == CUSTOMER_SEGMENTS[1]
    stayed = now.filter(F.col("segment") != CUSTOMER_SEGMENTS[2]).select(
        "customer_id",
        F.when(renamed, F.upper("full_name")).otherwise(F.col("full_name")).alias("full_name"),
        F.when(moved, "Bali").otherwise(F.col("province")).alias("province"),
        "segment",
        "credit_score",
    )
    joined = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("customer_id"),
        F.col("s_name").alias("full_name"),
        F.lit(None).cast("string").alias("province"),
        F.lit(CUSTOMER_SEGMENTS[2]).alias("segment"),
        F.lit(700).cast("long").alias("credit_score"),
    )
    return stayed.unionByName(joined)


def customer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["customer_id", "full_name", "province", "segment", "credit_score"]
    return customers(spark, sf_dir).select(*columns)


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What feeds what, object by object: region, nation, customer, loan, product, mart."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    customer, order = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")

    def node(kind: str, c: str) -> Column:
        return F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))

    def edge(df: DataFrame, src: Column, dst: Column) -> DataFrame:
        return df.select(src.alias("src"), dst.alias("dst"))

    parts = [
        edge(region, F.lit("world"), node("region", "r_regionkey")),
        edge(nation, node("region", "n_regionkey"), node("nation", "n_nationkey")),
        edge(customer, node("nation", "c_nationkey"), node("customer", "c_custkey")),
        edge(order, node("customer", "o_custkey"), node("loan", "o_orderkey")),
        edge(order, node("loan", "o_orderkey"), node("product", "o_orderpriority")),
        # A mart reads customers directly and products through loans.
        edge(customer, node("customer", "c_custkey"), node("mart", "c_mktsegment")),
        edge(customer, node("mart", "c_mktsegment"), node("nation", "c_nationkey")).distinct(),
    ]
    return reduce(DataFrame.unionByName, parts)
