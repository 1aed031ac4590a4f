"""The column rules under SQL names, for those who write queries as text.

They are temporary SQL functions: Spark inlines their bodies into the plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lendmill import fixed_values as V
from lendmill.functions.masking import CLEAR_ROLES, ENGINEER, TRUSTED_ROLES


def _texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_PREFIXES = " ".join(f"WHEN v ILIKE '{p}%' THEN '{label}'" for p, label in V.PRODUCT_PREFIXES)
_EDGES = " ".join(f"WHEN v <= {edge} THEN '{label}'" for edge, label in V.DPD_EDGES)
_CLEAR = f"role IN ({_texts(CLEAR_ROLES)})"

# Signature, result type, body.
SQL_FUNCTIONS = {
    "product_segment(v STRING)": ("STRING", f"CASE {_PREFIXES} ELSE '{V.PRODUCT_OTHER}' END"),
    "dpd_bucket(v BIGINT)": (
        "STRING",
        f"CASE WHEN v = 0 THEN '{V.DPD_CURRENT}' {_EDGES} ELSE '{V.DPD_LAST}' END",
    ),
    "years_between(a DATE, b DATE)": ("INT", "year(b) - year(a)"),
    "mask_nik(v STRING, role STRING)": (
        "STRING",
        f"CASE WHEN {_CLEAR} THEN v WHEN role = '{ENGINEER}' "
        f"THEN regexp_replace(v, '.(?=.{{{V.NIK_KEEP_LAST}}})', 'X') ELSE '{V.NIK_HIDDEN}' END",
    ),
    "mask_email(v STRING, role STRING)": (
        "STRING",
        f"CASE WHEN {_CLEAR} THEN v ELSE regexp_replace(v, '{V.EMAIL_LOCAL_PART}', '{V.EMAIL_HIDDEN}') END",
    ),
    "mask_phone(v STRING, role STRING)": (
        "STRING",
        f"CASE WHEN {_CLEAR} THEN v ELSE concat(left(v, {V.PHONE_KEEP_FIRST}), '{V.PHONE_HIDDEN}') END",
    ),
    "mask_income(v DECIMAL(18,0), role STRING)": (
        "DECIMAL(18,0)",
        f"CASE WHEN role IN ({_texts(TRUSTED_ROLES)}) THEN v END",
    ),
    "may_see_row(province STRING, role STRING)": (
        "BOOLEAN",
        f"role IN ({_texts(TRUSTED_ROLES)}) OR province = '{V.OPEN_PROVINCE}'",
    ),
}


def register_functions(spark: SparkSession) -> None:
    for signature, (kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
