"""The lending tables and marts as DuckDB SQL, for the side-by-side check.

All constants are written out, and marts are asked of the driver's tables directly, one
question per column, so that nothing here follows the code under test.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "raw_customers": """
        SELECT c_custkey AS customer_id,
               lpad(CAST(c_custkey AS VARCHAR), CASE WHEN c_nationkey = 7 THEN 10 ELSE 16 END, '0') AS nik,
               CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE lpad(CAST(c_custkey AS VARCHAR), 15, '9') END AS npwp,
               lower(c_name) AS full_name,
               CASE WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'f' END AS gender,
               DATE '1960-01-01' + CAST(c_custkey % 16000 AS INTEGER) AS birth_date,
               CASE WHEN c_nationkey = 0 THEN 'DKI Jakarta' WHEN c_nationkey <> 9 THEN n_name END AS province,
               'CITY_' || CAST(c_custkey % 7 AS VARCHAR) AS city,
               CASE WHEN c_nationkey = 11 THEN '' ELSE CASE c_mktsegment WHEN 'BUILDING' THEN 'Tunaiku' WHEN 'AUTOMOBILE' THEN 'Tunaiku' WHEN 'MACHINERY' THEN 'Senyumku'
                    WHEN 'HOUSEHOLD' THEN 'SMB' ELSE 'Personal' END END AS segment,
               CAST(floor(c_acctbal / 16) AS BIGINT) + 360 AS credit_score,
               CAST(floor(c_acctbal * 1000) AS DECIMAL(18,0)) AS monthly_income,
               '08' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
               CASE WHEN c_nationkey <> 3 THEN replace(c_name, '#', '') || '@Example.co.id' END AS email,
               TIMESTAMP '2024-01-01 00:00:00' AS created_at,
               TIMESTAMP '2024-06-01 00:00:00' AS updated_at,
               TIMESTAMP '2026-06-01 02:00:00' AS _loaded_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_loans": """
        SELECT o_orderkey AS loan_id, o_custkey + 5000000000 * CAST(o_orderkey % 97 = 0 AS BIGINT) AS customer_id,
               CASE WHEN o_orderkey % 23 = 1 THEN 'Tunai E' WHEN o_orderkey % 23 = 2 THEN 'SM B F' ELSE
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Tunaiku A' WHEN '2-HIGH' THEN 'tunaiku B'
                    WHEN '3-MEDIUM' THEN 'SMB C' WHEN '4-NOT SPECIFIED' THEN 'smb D' END END AS product_type,
               CAST(o_totalprice AS DECIMAL(18,2)) AS plafond,
               o_orderkey % 6 * 6 + 6 AS tenor_months,
               CAST(o_orderkey % 25 + 12 AS DOUBLE) AS interest_rate,
               CAST(o_orderdate AS DATE) AS disbursed_at,
               CASE o_orderstatus WHEN 'O' THEN 'LANCAR' WHEN 'P' THEN 'LUNAS' WHEN 'F' THEN 'DPD90' ELSE o_orderstatus END AS status,
               CASE WHEN o_orderstatus = 'O' THEN 0
                    WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                    ELSE o_orderkey % 131 - 5 END AS dpd,
               CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS is_default,
               CASE WHEN o_orderstatus = 'P' THEN CAST(0 AS DECIMAL(18,2))
                    ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS outstanding,
               o_orderdate AS updated_at, TIMESTAMP '2026-06-01 02:00:00' AS _loaded_at
        FROM orders""",
    "raw_repayments": """
        SELECT l_orderkey * 10 + l_linenumber AS repayment_id, l_orderkey AS loan_id,
               CAST(l_shipdate AS DATE) - CAST(l_partkey % 29 - 3 AS INTEGER) AS due_date,
               CAST(l_shipdate AS DATE) AS paid_date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_due,
               CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) AS amount_paid,
               CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS is_late,
               TIMESTAMP '2026-06-01 02:00:00' AS _loaded_at
        FROM lineitem""",
    "raw_savings": """
        SELECT CASE WHEN c_nationkey = 13 THEN c_custkey + 1000000000 ELSE c_custkey END AS account_id,
               c_custkey - c_custkey % 2 AS customer_id,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'DEPOSITO' WHEN 'MACHINERY' THEN 'GIRO' ELSE 'TABUNGAN' END AS account_type,
               CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
               c_nationkey / 10 AS interest_rate,
               DATE '2021-06-01' + CAST(c_custkey % 1700 AS INTEGER) AS opened_at,
               CASE WHEN c_acctbal < 0 THEN 'DORMANT' ELSE 'ACTIVE' END AS status,
               TIMESTAMP '2026-06-01 02:00:00' AS _loaded_at
        FROM customer""",
    "raw_transactions": """
        SELECT event_id AS txn_id, user_id AS account_id, upper(event_type) AS txn_type,
               CASE WHEN event_type = 'view' THEN 'QRIS' ELSE 'MOBILE_APP' END AS channel,
               CAST(value AS DECIMAL(18,2)) AS amount, ts AS txn_ts,
               TIMESTAMP '2026-06-01 02:00:00' AS _loaded_at
        FROM events""",
    "stg_customers": """
        SELECT * REPLACE (nullif(npwp, '') AS npwp, upper(full_name[1]) || full_name[2:] AS full_name,
                          upper(gender) AS gender, lower(email) AS email),
               year(DATE '2026-06-30') - year(birth_date) AS age
        FROM raw_customers WHERE customer_id IS NOT NULL""",
    "stg_loans": """
        SELECT *, CASE WHEN starts_with(lower(product_type), 'tunaiku') THEN 'Tunaiku'
                       WHEN starts_with(lower(product_type), 'smb') THEN 'SMB' ELSE 'Other' END AS product_segment,
               CASE WHEN dpd = 0 THEN 'CURRENT' WHEN dpd <= 30 THEN 'DPD_1_30' WHEN dpd <= 60 THEN 'DPD_31_60'
                    WHEN dpd <= 90 THEN 'DPD_61_90' ELSE 'DPD_90_PLUS' END AS dpd_bucket
        FROM raw_loans WHERE loan_id IS NOT NULL""",
    "stg_repayments": """
        SELECT *, amount_due - amount_paid AS shortfall, date_diff('day', due_date, paid_date) AS days_late
        FROM raw_repayments WHERE repayment_id IS NOT NULL""",
    "stg_savings": "SELECT * FROM raw_savings WHERE account_id IS NOT NULL",
    "stg_transactions": """
        SELECT *, CAST(date_trunc('month', txn_ts) AS TIMESTAMP) AS txn_month
        FROM raw_transactions WHERE txn_id IS NOT NULL""",
    "mart_loan_performance": """
        SELECT loan_id, customer_id, product_segment, product_type, status, dpd, dpd_bucket, is_default, plafond,
               outstanding, interest_rate, disbursed_at,
               (SELECT count(*) FROM lineitem WHERE l_orderkey = loan_id) AS n_installments,
               coalesce((SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) FROM lineitem
                         WHERE l_orderkey = loan_id), 0) AS total_due,
               coalesce((SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2)))
                         FROM lineitem WHERE l_orderkey = loan_id), 0) AS total_paid,
               (SELECT count(*) FROM lineitem WHERE l_orderkey = loan_id AND l_returnflag = 'R') AS n_late,
               coalesce((SELECT max(l_partkey % 29) - 3 FROM lineitem WHERE l_orderkey = loan_id), 0) AS max_days_late,
               (SELECT round(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2)))::DOUBLE
                             / nullif(sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE, 0), 4)
                FROM lineitem WHERE l_orderkey = loan_id) AS collection_ratio
        FROM stg_loans""",
    "mart_customer_360": """
        SELECT customer_id, full_name, segment, province, city, age, credit_score, monthly_income,
               (SELECT count(*) FROM orders WHERE o_custkey = customer_id AND o_orderkey % 97 <> 0) AS n_loans,
               coalesce((SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders
                         WHERE o_custkey = customer_id AND o_orderkey % 97 <> 0), 0) AS total_plafond,
               coalesce((SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders
                         WHERE o_custkey = customer_id AND o_orderkey % 97 <> 0 AND o_orderstatus <> 'P'), 0)
                 AS total_outstanding,
               CAST(EXISTS (SELECT 1 FROM orders WHERE o_custkey = customer_id AND o_orderkey % 97 <> 0
                            AND o_orderstatus = 'F') AS BIGINT) AS ever_default,
               (SELECT count(*) FROM raw_savings s WHERE s.customer_id = c.customer_id) AS n_savings_accounts,
               coalesce((SELECT sum(balance) FROM raw_savings s WHERE s.customer_id = c.customer_id), 0)
                 AS total_savings_balance,
               (SELECT count(*) FROM events, raw_savings s WHERE s.customer_id = c.customer_id AND s.account_id = user_id)
                 AS n_transactions,
               coalesce((SELECT sum(CAST(value AS DECIMAL(18,2))) FROM events, raw_savings s
                         WHERE s.customer_id = c.customer_id AND s.account_id = user_id), 0) AS total_txn_amount
        FROM stg_customers c""",
}


def with_views(select: str, extra: dict[str, str] | None = None) -> str:
    """The SELECT under the views it needs, directly or through other views."""
    known = {**VIEWS, **(extra or {})}
    needed: set[str] = set()
    queue = [select]
    while queue:
        text = queue.pop()
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in known:
            if name in words and name not in needed:
                needed.add(name)
                queue.append(known[name])
    bodies = ",\n".join(f"{n} AS ({known[n]})" for n in known if n in needed)
    recursive = "RECURSIVE " if "reach" in needed else ""
    return f"WITH {recursive}{bodies}\n{select}" if bodies else select
