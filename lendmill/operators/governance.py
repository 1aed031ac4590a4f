"""Role-based masking, row access, projection checks, tags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.fixed_values import TAG_VALUES
from lendmill.functions import masking as M

Policy = Callable[[Column, "str | Column"], Column]

# Column -> masking rule of the customer table.
CUSTOMER_POLICIES: dict[str, Policy] = {
    "nik": M.mask_nik,
    "email": M.mask_email,
    "phone": M.mask_phone,
    "monthly_income": M.mask_income,
}

# Column -> tag of the customer table, and the tag of the table itself.
CUSTOMER_TAGS = {"nik": "NIK", "npwp": "NPWP", "phone": "PHONE", "email": "EMAIL"}
CUSTOMER_CLASS = "CONFIDENTIAL"


class ProjectionDenied(PermissionError):
    """A protected column was requested by a role that may not select it."""


def apply_masking(df: DataFrame, policies: dict[str, Policy], role: str | Column) -> DataFrame:
    """Replace each governed column by what the role may see of it."""
    return df.withColumns(
        {c: rule(F.col(c), role) for c, rule in policies.items() if c in df.columns}
    )


def apply_row_access(df: DataFrame, role: str | Column, column: str = "province") -> DataFrame:
    return df.filter(M.may_see_row(F.col(column), role))


def check_projection(
    columns: list[str], role: str, protected: tuple[str, ...] = ("nik",), lenient: bool = False
) -> list[str]:
    """The columns the role may select; raises on a protected one, or leaves it out."""
    denied = [c for c in columns if c.lower() in protected and role not in M.CLEAR_ROLES]
    if denied and not lenient:
        raise ProjectionDenied(f"role {role!r} may not select {', '.join(denied)}")
    return [c for c in columns if c not in denied]


def governed_select(
    df: DataFrame,
    columns: list[str],
    role: str,
    policies: dict[str, Policy] = CUSTOMER_POLICIES,
    lenient: bool = False,
) -> DataFrame:
    """What a role gets: projection check, then row access, then masks."""
    allowed = check_projection(columns, role, lenient=lenient)
    return apply_masking(apply_row_access(df, role).select(*allowed), policies, role)


def tag(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """Attach a tag to a column. Expressions drop tags; tag after transforming."""
    if value not in TAG_VALUES.get(key, (value,)):
        raise ValueError(f"{value!r} is not an allowed value of {key}")
    return df.withMetadata(column, {**df.schema[column].metadata, key: value})


def tag_table(df: DataFrame, key: str, value: str) -> DataFrame:
    """A table tag reaches every column that does not carry the key itself."""
    for f in df.schema:
        if key not in f.metadata:
            df = tag(df, f.name, key, value)
    return df


def tag_customers(df: DataFrame) -> DataFrame:
    for column, value in CUSTOMER_TAGS.items():
        df = tag(df, column, "pii_type", value)
    return tag_table(df, "data_classification", CUSTOMER_CLASS)


def tags_of(df: DataFrame) -> DataFrame:
    """Tag inventory: column, tag, value, and how many rows carry a value there."""
    pairs = [
        (f.name, key, f.metadata[key])
        for f in df.schema
        for key in sorted(f.metadata)
        if key in TAG_VALUES
    ]
    kind = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("column_name", "tag", "tag_value")]
        + [T.StructField("n_values", T.LongType())]
    )
    if not pairs:
        return df.sparkSession.createDataFrame([], kind)
    names = list(dict.fromkeys(p[0] for p in pairs))
    counted = df.agg(*[F.count(c).alias(c) for c in names])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(key).alias("tag"),
            F.lit(value).alias("tag_value"),
            F.col(c).alias("n_values"),
        )
        for c, key, value in pairs
    ]
    return counted.select(F.inline(F.array(*rows)))
