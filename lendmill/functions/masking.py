"""Masking rules by role. With a literal role the rule folds to one expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendmill import fixed_values as V

ADMIN, AUDITOR, ENGINEER, ANALYST = "admin", "auditor", "engineer", "analyst"
CLEAR_ROLES = (ADMIN, AUDITOR)
TRUSTED_ROLES = (ADMIN, AUDITOR, ENGINEER)


def has_role(role: str | Column, allowed: tuple[str, ...]) -> Column:
    """Exact match; roles do not inherit. ``role`` is a name or a session-variable column."""
    return (role if isinstance(role, Column) else F.lit(role)).isin(*allowed)


def mask_nik(c: Column, role: str | Column) -> Column:
    last = F.regexp_replace(c, f".(?=.{{{V.NIK_KEEP_LAST}}})", "X")
    return (
        F.when(has_role(role, CLEAR_ROLES), c)
        .when(has_role(role, (ENGINEER,)), last)
        .otherwise(V.NIK_HIDDEN)
    )


def mask_email(c: Column, role: str | Column) -> Column:
    hidden = F.regexp_replace(c, V.EMAIL_LOCAL_PART, V.EMAIL_HIDDEN)
    return F.when(has_role(role, CLEAR_ROLES), c).otherwise(hidden)


def mask_phone(c: Column, role: str | Column) -> Column:
    hidden = F.concat(F.left(c, F.lit(V.PHONE_KEEP_FIRST)), F.lit(V.PHONE_HIDDEN))
    return F.when(has_role(role, CLEAR_ROLES), c).otherwise(hidden)


def mask_income(c: Column, role: str | Column) -> Column:
    return F.when(has_role(role, TRUSTED_ROLES), c)


def may_see_row(province: Column, role: str | Column) -> Column:
    """Trusted roles see every row; others one province, and never a missing one."""
    return has_role(role, TRUSTED_ROLES) | (province == V.OPEN_PROVINCE)
