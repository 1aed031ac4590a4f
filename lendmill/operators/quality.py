"""Quality gate, declarative column tests, freshness and metrics."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill import fixed_values as V
from lendmill.functions import checks as K
from lendmill.functions.cleaning import hours_before
from lendmill.operators.relations import repeated_keys, union_all


class GateFailed(RuntimeError):
    """The quality gate found issues and was asked to raise."""


ISSUES = ["bad_nik", "bad_credit_score", "duplicate_customer_id", "null_segment", "orphan_loans"]


def dq_gate(customers: DataFrame, loans: DataFrame, as_of=None, on_fail: str = "return") -> DataFrame:
    """One row: five issue counts, their total and the verdict.

    Customers and loans are stacked and reduced per customer id in a single
    shuffle; range, format and blank checks, duplicated ids and loans without
    a customer all come out of it, with no join. ``on_fail="raise"`` runs the
    query and raises when there are issues.
    """
    checked = customers.select(
        "customer_id",
        F.lit(1).alias("customers"),
        F.lit(0).alias("loans"),
        *[
            F.coalesce(flag, F.lit(False)).cast("int").alias(name)
            for name, flag in (
                ("bad_nik", K.bad_format(F.col("nik"), V.NIK_LENGTH, V.NIK_PATTERN)),
                (
                    "bad_credit_score",
                    K.out_of_range(F.col("credit_score"), V.SCORE_MIN, V.SCORE_MAX),
                ),
                ("null_segment", K.is_blank(F.col("segment"))),
            )
        ],
    )
    zero = F.lit(0)
    owed = loans.select(
        "customer_id",
        zero.alias("customers"),
        F.lit(1).alias("loans"),
        zero.alias("bad_nik"),
        zero.alias("bad_credit_score"),
        zero.alias("null_segment"),
    )
    flags = ["customers", "loans", "bad_nik", "bad_credit_score", "null_segment"]
    per_id = checked.unionByName(owed).groupBy("customer_id").agg(
        *[F.sum(c).alias(c) for c in flags]
    )
    unowned = (F.col("customers") == 0) | F.col("customer_id").isNull()
    counts = per_id.agg(
        *[F.coalesce(F.sum(c), zero).cast("long").alias(c) for c in flags[2:]],
        F.count_if(F.col("customers") > 1).alias("duplicate_customer_id"),
        F.coalesce(F.sum(F.when(unowned, F.col("loans"))), zero).alias("orphan_loans"),
    )
    total = sum((F.col(c) for c in ISSUES[1:]), F.col(ISSUES[0]))
    checked_at = F.current_timestamp() if as_of is None else F.lit(as_of)
    verdict = counts.select(
        checked_at.cast("string").alias("checked_at"), *ISSUES, total.alias("total_issues")
    ).withColumns(
        {
            "status": F.when(F.col("total_issues") == 0, "PASS").otherwise("FAIL"),
            "raised": F.when(F.col("total_issues") > 0, True),
        }
    )
    if on_fail == "raise":
        found = verdict.first()
        if found["status"] == "FAIL":
            raise GateFailed(str(found.asDict()))
    return verdict


def verdict_json(verdict: DataFrame) -> DataFrame:
    """The verdict as one JSON object; ``raised`` appears only when the gate failed."""
    return verdict.select(F.to_json(F.struct("*")).alias("verdict"))


def freshness(
    df: DataFrame,
    as_of,
    ts: str = "_loaded_at",
    warn_hours: int = V.WARN_HOURS,
    error_hours: int = V.ERROR_HOURS,
) -> DataFrame:
    """One row: newest load time, its age in hours and pass, warn or error."""
    now = F.lit(as_of).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now) / 3600
    status = (
        F.when(F.col("max_loaded_at").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    newest = df.agg(F.max(ts).cast("timestamp_ntz").alias("max_loaded_at"))
    return newest.withColumn("age_hours", age).withColumn("status", status)


def arrived_within(df: DataFrame, as_of, hours: int = 1, ts: str = "_loaded_at") -> DataFrame:
    """Rows of the last hours up to ``as_of``: the earliest instant counts, later rows and
    rows without a time do not. Both bounds are constants, so they reach the scan."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= hours_before(now, hours)) & (F.col(ts) <= now))


def arrivals_per_hour(df: DataFrame, as_of, hours: int = 1, ts: str = "_loaded_at") -> DataFrame:
    """``arrived_hour``, ``n_rows`` and ``last_arrival`` of the last hours up to ``as_of``;
    an hour without rows has no row."""
    return (
        arrived_within(df, as_of, hours, ts)
        .groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("arrived_hour"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max(ts).cast("timestamp_ntz").alias("last_arrival"))
    )


# ---- declarative column tests ------------------------------------------------


@dataclass(frozen=True)
class ColumnTest:
    """One expectation on a column: not_null, unique, accepted_values or relationships."""

    table: str
    kind: str
    column: str
    values: tuple = ()
    to_table: str = ""
    to_column: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


def test_not_null(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c).isNull())


def test_unique(df: DataFrame, c: str) -> DataFrame:
    """Repeated keys; a missing key is not one."""
    return repeated_keys(df.filter(F.col(c).isNotNull()), c)


def test_accepted(df: DataFrame, c: str, values) -> DataFrame:
    return df.filter(K.not_accepted(F.col(c), values))


# Not pytest cases, whatever their names say.
for _f in (test_not_null, test_unique, test_accepted):
    _f.__test__ = False


def _report(test: ColumnTest, failures: Column) -> Column:
    return F.struct(
        F.lit(test.name).alias("test_name"),
        F.lit(test.table).alias("table_name"),
        F.lit(test.column).alias("column_name"),
        failures.cast("long").alias("failures"),
    )


def _failures(
    df: DataFrame,
    key: str | None,
    by_row: dict[str, ColumnTest],
    unique: str | None,
    children: dict[str, tuple[DataFrame, str]],
) -> DataFrame:
    """Failures of one table's tests, a column per test, to be summed over all rows.

    With a key the rows are reduced per key, which counts its copies, and the rows of
    the tables that refer to it are counted along: one shuffle tells repeated keys
    and orphans. Row-wise failures ride along as sums.
    """
    flags = {n: row_rule(t).cast("long").alias(n) for n, t in by_row.items()}
    if key is None:
        return df.select(*flags.values())
    own = {n: F.lit(0).cast("long").alias(n) for n in (*by_row, *children)}
    one, none = F.lit(1).alias("_copies"), F.lit(0).alias("_copies")
    stacked = df.select(F.col(key).alias("_key"), one, *(own | flags).values())
    for n, (child, fk) in children.items():
        mark = {n: F.lit(1).cast("long").alias(n)}
        stacked = stacked.unionByName(
            child.select(F.col(fk).alias("_key"), none, *(own | mark).values())
        )
    per_key = stacked.groupBy("_key").agg(
        F.sum("_copies").alias("_copies"), *[F.sum(n).alias(n) for n in own]
    )
    known = F.col("_key").isNotNull()
    out = [F.col(n) for n in by_row]
    out += [F.when(known & (F.col("_copies") == 0), F.col(n)).alias(n) for n in children]
    if unique:
        out.append((known & (F.col("_copies") > 1)).cast("long").alias(unique))
    return per_key.select(*out)


def run_tests(tables: dict[str, DataFrame], tests: list[ColumnTest]) -> DataFrame:
    """One row per test: failures and pass or fail.

    A table is scanned once for its row-wise tests, its first uniqueness test and the
    relationships that point at that key. Failures are summed to one row per table before they
    are brought together, so that a task counts the keys of one table, not of a part of every table.
    """
    name = {t: f"t{i}" for i, t in enumerate(tests)}
    refers = [t for t in tests if t.kind == "relationships"]
    frames = []
    for table in dict.fromkeys(t.table for t in tests):
        mine = [t for t in tests if t.table == table]
        by_row = {name[t]: t for t in mine if t.kind in ("not_null", "accepted_values")}
        for t in [t for t in mine if t.kind == "unique"] or [None]:
            key = t.column if t else None
            here = [r for r in refers if key and (r.to_table, r.to_column) == (table, key)]
            refers = [r for r in refers if r not in here]
            children = {name[r]: (tables[r.table], r.column) for r in here}
            frames.append(_failures(tables[table], key, by_row, t and name[t], children))
            by_row = {}
    for r in refers:  # to a column without a uniqueness test
        children = {name[r]: (tables[r.table], r.column)}
        frames.append(_failures(tables[r.to_table], r.to_column, {}, None, children))
    frames = [f.agg(*[F.sum(n).alias(n) for n in f.columns]) for f in frames if f.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    summed = stacked.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in name.values()])
    found = summed.select(F.inline(F.array(*[_report(t, F.col(n)) for t, n in name.items()])))
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return found.withColumn("status", status)


def row_rule(t: ColumnTest) -> Column:
    """Whether a row fails a row-wise test."""
    c = F.col(t.column)
    return c.isNull() if t.kind == "not_null" else K.not_accepted(c, t.values)


def standard_tests() -> list[ColumnTest]:
    """The expectations on the staged tables and the marts."""

    def keyed(table: str, key: str) -> list[ColumnTest]:
        return [ColumnTest(table, "not_null", key), ColumnTest(table, "unique", key)]

    def accepted(table: str, column: str, values: tuple) -> ColumnTest:
        return ColumnTest(table, "accepted_values", column, values=values)

    def refers(table: str, column: str, to_table: str, to_column: str) -> ColumnTest:
        return ColumnTest(table, "relationships", column, to_table=to_table, to_column=to_column)

    return [
        *keyed("stg_customers", "customer_id"),
        ColumnTest("stg_customers", "not_null", "nik"),
        ColumnTest("stg_customers", "not_null", "segment"),
        accepted("stg_customers", "segment", V.CUSTOMER_SEGMENTS),
        *keyed("stg_loans", "loan_id"),
        ColumnTest("stg_loans", "not_null", "customer_id"),
        refers("stg_loans", "customer_id", "stg_customers", "customer_id"),
        accepted("stg_loans", "is_default", V.DEFAULT_FLAGS),
        *keyed("stg_repayments", "repayment_id"),
        refers("stg_repayments", "loan_id", "stg_loans", "loan_id"),
        *keyed("stg_savings", "account_id"),
        accepted("stg_savings", "account_type", V.ACCOUNT_TYPES),
        *keyed("stg_transactions", "txn_id"),
        *keyed("mart_loan_performance", "loan_id"),
        accepted("mart_loan_performance", "dpd_bucket", V.DPD_LABELS),
        *keyed("mart_customer_360", "customer_id"),
    ]


# ---- metrics -----------------------------------------------------------------


@dataclass(frozen=True)
class Metric:
    """A number measured on a table: null_count, duplicate_count or a row rule."""

    name: str
    kind: str
    column: str = ""
    rule: Column | None = field(default=None, compare=False)


def standard_metrics() -> list[Metric]:
    return [
        Metric("null_count", "null_count", "email"),
        Metric("duplicate_count", "duplicate_count", "customer_id"),
        Metric(
            "credit_score_range",
            "rule",
            rule=K.out_of_range(F.col("credit_score"), V.SCORE_MIN, V.SCORE_MAX),
        ),
    ]


def metric_null_count(df: DataFrame, c: str) -> DataFrame:
    return df.agg(K.hits(F.col(c).isNull()).alias("value"))


def metric_duplicate_count(df: DataFrame, c: str) -> DataFrame:
    """Surplus rows: rows with a key minus distinct keys."""
    return df.agg((F.count(c) - F.count_distinct(F.col(c))).alias("value"))


def metric_rule_count(df: DataFrame, rule: Column) -> DataFrame:
    return df.agg(K.hits(rule).alias("value"))


def run_metrics(df: DataFrame, table: str, metrics: list[Metric], at) -> DataFrame:
    """Long-form results: measurement_time, metric_name, table_name, value.

    Row-wise metrics and the first duplicate count share one aggregate; each
    further duplicate count takes one of its own, so that Spark never expands
    the rows once per distinct column.
    """
    duplicates = [m for m in metrics if m.kind == "duplicate_count"]
    together = [m for m in metrics if m not in duplicates[1:]]
    frames = [_measure(df, together), *[_measure(df, [m]) for m in duplicates[1:]]]
    return union_all([f for f in frames if f is not None]).select(
        F.lit(at).cast("timestamp_ntz").alias("measurement_time"),
        "metric_name",
        F.lit(table).alias("table_name"),
        "value",
    )


def _measure(df: DataFrame, metrics: list[Metric]) -> DataFrame | None:
    if not metrics:
        return None
    found = df.agg(*[_metric_value(m).alias(f"m{i}") for i, m in enumerate(metrics)])
    rows = [
        F.struct(F.lit(m.name).alias("metric_name"), F.col(f"m{i}").cast("long").alias("value"))
        for i, m in enumerate(metrics)
    ]
    return found.select(F.inline(F.array(*rows)))


def _metric_value(m: Metric) -> Column:
    if m.kind == "null_count":
        return K.hits(F.col(m.column).isNull())
    if m.kind == "duplicate_count":
        return F.count(m.column) - F.count_distinct(F.col(m.column))
    return K.hits(m.rule)
