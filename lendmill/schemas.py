"""Raw-layer schemas: what the landed files hold, in file order.

Money is decimal(18,0) and counts or flags are long; the load-time column
``_loaded_at`` is added at ingest and is never in a file.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 0)

_CUSTOMERS = """
    customer_id string, nik string, npwp string, full_name string, gender string,
    birth_date date, province string, city string, segment string,
    credit_score bigint, monthly_income decimal(18,0), phone string, email string,
    created_at timestamp_ntz, updated_at timestamp_ntz
"""
_LOANS = """
    loan_id string, customer_id string, product_type string, plafond decimal(18,0),
    tenor_months bigint, interest_rate double, disbursed_at date, status string,
    dpd bigint, is_default bigint, outstanding decimal(18,0), updated_at timestamp_ntz
"""
_REPAYMENTS = """
    repayment_id string, loan_id string, due_date date, paid_date date,
    amount_due decimal(18,0), amount_paid decimal(18,0), is_late bigint
"""
_SAVINGS = """
    account_id string, customer_id string, account_type string, balance decimal(18,0),
    interest_rate double, opened_at date, status string
"""
_TRANSACTIONS = """
    txn_id string, account_id string, txn_type string, channel string,
    amount decimal(18,0), txn_ts timestamp_ntz
"""
_DOCS = "doc_id string, title string, category string, content string"


def _struct(ddl: str) -> T.StructType:
    fields = []
    for part in ddl.replace("decimal(18,0)", "money").split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "money": MONEY,
}

RAW_CUSTOMERS = _struct(_CUSTOMERS)
RAW_LOANS = _struct(_LOANS)
RAW_REPAYMENTS = _struct(_REPAYMENTS)
RAW_SAVINGS = _struct(_SAVINGS)
RAW_TRANSACTIONS = _struct(_TRANSACTIONS)
PRODUCT_DOCS = _struct(_DOCS)

# Raw table -> (landed file or folder, schema).
RAW_TABLES: dict[str, tuple[str, T.StructType]] = {
    "raw_customers": ("customers.csv", RAW_CUSTOMERS),
    "raw_loans": ("loans.csv", RAW_LOANS),
    "raw_repayments": ("repayments.csv", RAW_REPAYMENTS),
    "raw_savings": ("savings.csv", RAW_SAVINGS),
    "raw_transactions": ("transactions.csv", RAW_TRANSACTIONS),
}

# Raw table -> further deliveries whose columns are matched by their headers.
DRIFT_DELIVERIES: dict[str, tuple[str, ...]] = {
    "raw_customers": ("customers_v2_schemadrift.csv",),
    "raw_loans": ("loans_incremental.csv",),
}


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all as strings: how a text file is read before conversion."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])
