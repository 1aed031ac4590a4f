"""Column rules, staged tables and marts on hand-made rows."""

import datetime as dt
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from lendmill import fixed_values as V
from lendmill import schemas
from lendmill.functions import checks, cleaning, lending
from lendmill.operators import facts, relations, staging
from lendmill.plans import analytics, marts


def values(spark, kind, data, *columns):
    df = spark.createDataFrame([(v,) for v in data], f"x {kind}")
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_product_segment(spark):
    (one, first), (two, second) = V.PRODUCT_PREFIXES
    data = [f"{one} a", f"{one.lower()} b", f"{two} c", two.lower(), "house", "", None, f"My {two}"]
    got = values(spark, "string", data, lending.product_segment(F.col("x")))
    assert got == [first, first, second, second, "Other", "Other", "Other", "Other"]


def test_dpd_bucket_keeps_its_quirks(spark):
    data = [0, 1, 30, 31, 60, 61, 90, 91, None, -5]
    got = values(spark, "int", data, lending.dpd_bucket(F.col("x")))
    assert got == [
        "CURRENT", "DPD_1_30", "DPD_1_30", "DPD_31_60", "DPD_31_60", "DPD_61_90", "DPD_61_90",
        "DPD_90_PLUS", "DPD_90_PLUS", "DPD_1_30",
    ]


def test_title_words(spark):
    data = ["siti-NUR o_neil", "budi SANTOSO", "a.b c", "", None, "dewi\tayu"]
    got = values(spark, "string", data, cleaning.title_words(F.col("x")))
    assert got == ["Siti-Nur O_Neil", "Budi Santoso", "A.B C", "", None, "Dewi\tAyu"]


def test_dates(spark):
    df = spark.createDataFrame(
        [(dt.date(1990, 12, 31), dt.date(2026, 1, 1), dt.datetime(2025, 3, 9, 8, 7))],
        "a date, b date, t timestamp_ntz",
    )
    got = df.select(
        cleaning.years_between(F.col("a"), F.col("b")),
        cleaning.days_between(F.col("b"), F.col("b") + F.lit(3)),
        cleaning.month_start(F.col("t")).alias("m"),
        cleaning.hours_before(F.col("t"), 1),
    )
    assert got.schema["m"].dataType.simpleString() == "timestamp_ntz"
    assert tuple(got.first()) == (36, 3, dt.datetime(2025, 3, 1), dt.datetime(2025, 3, 9, 7, 7))


def test_predicates_ignore_missing_values(spark):
    x = F.col("x")
    assert values(spark, "int", [299, 300, 850, 851, None], checks.out_of_range(x, 300, 850)) == [
        True, False, False, True, None,
    ]
    data = ["1234567890123456", "12345", "12345678901234x6", None]
    assert values(spark, "string", data, checks.bad_format(x, 16, "^[0-9]+$")) == [
        False, True, True, None,
    ]
    assert values(spark, "string", ["", None, "a"], checks.is_blank(x)) == [True, True, False]


def test_ratio_is_guarded_and_rounded_once(spark):
    df = spark.createDataFrame(
        [(Decimal("1"), Decimal("3")), (Decimal("1"), Decimal("0")), (Decimal("1"), None)],
        "p decimal(18,2), w decimal(18,2)",
    )
    got = [r[0] for r in df.select(cleaning.safe_ratio(F.col("p"), F.col("w"))).collect()]
    assert got == [Decimal("0.3333"), None, None]


LOADED = dt.datetime(2026, 6, 1)


def _frame(spark, schema, data):
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    money = [i for i, f in enumerate(schema) if f.dataType.simpleString().startswith("decimal")]
    fixed = [tuple(Decimal(v) if i in money and v is not None else v for i, v in enumerate(r)) for r in data]
    rows_ = [(*r, LOADED) for r in fixed]
    return spark.createDataFrame(rows_, f"{kinds}, _loaded_at timestamp_ntz")


def _loans(spark, data):
    """(loan, customer, product, dpd, is_default, outstanding)"""
    full = [
        (l, c, p, 100, 12, 18.5, dt.date(2025, 1, 1), "LANCAR", d, f, o, LOADED)
        for l, c, p, d, f, o in data
    ]
    return staging.stg_loans(_frame(spark, schemas.RAW_LOANS, full))


def test_loan_mart(spark):
    loans = _loans(
        spark,
        [("L1", "C1", "house", 0, 0, 50), ("L2", "C1", "SMB x", None, 1, 70), (None, "C1", "x", 0, 0, 1)],
    )
    d = dt.date
    repay = staging.stg_repayments(
        _frame(
            spark,
            schemas.RAW_REPAYMENTS,
            [
                ("R1", "L1", d(2025, 2, 1), d(2025, 1, 30), 10, 10, 0),
                ("R2", "L1", d(2025, 3, 1), d(2025, 2, 27), 20, 5, 0),
                ("R3", "L9", d(2025, 3, 1), d(2025, 3, 9), 20, 20, 1),
                (None, "L2", d(2025, 3, 1), d(2025, 3, 9), 20, 20, 1),
            ],
        )
    )
    mart = marts.mart_loan_performance(loans, repay)
    assert len(mart.columns) == 18
    cols = ["loan_id", "dpd_bucket", "n_installments", "total_due", "n_late", "max_days_late", "collection_ratio"]
    assert rows(mart.select(*cols)) == [
        ("L1", "CURRENT", 2, Decimal(30), 0, -2, Decimal("0.5000")),
        ("L2", "DPD_90_PLUS", 0, Decimal(0), 0, 0, None),
    ]


def _customers(spark, data):
    """(customer, province, segment, score)"""
    full = [
        (c, "1" * 16, "", "siti nur", "f", dt.date(1990, 12, 31), p, "X", s, n, 5, "0812345", "A@B.co", LOADED, LOADED)
        for c, p, s, n in data
    ]
    return staging.stg_customers(_frame(spark, schemas.RAW_CUSTOMERS, full), "2026-01-01")


def test_customer_mart_fills_gaps_and_keeps_grain(spark):
    customers = _customers(spark, [("C1", "Bali", "SMB", 700), ("C2", None, "SMB", None)])
    loans = _loans(spark, [("L1", "C1", "SMB x", 0, 0, 50), ("L2", "C1", "SMB x", 40, 1, 70)])
    d = dt.date(2024, 1, 1)
    savings = staging.stg_savings(
        _frame(
            spark,
            schemas.RAW_SAVINGS,
            [("A1", "C1", "TABUNGAN", 5, 1.0, d, "ACTIVE"), ("A2", "C1", "TABUNGAN", 7, 1.0, d, "ACTIVE")],
        )
    )
    txn = staging.stg_transactions(
        _frame(
            spark,
            schemas.RAW_TRANSACTIONS,
            [("T1", "A1", "FEE", "VA", 3, LOADED), ("T2", "A2", "FEE", "VA", 4, LOADED), ("T3", "A9", "FEE", "VA", 9, LOADED)],
        )
    )
    mart = marts.mart_customer_360(customers, loans, savings, txn)
    assert len(mart.columns) == 16
    got = rows(mart.drop("full_name", "city", "monthly_income"))
    assert got == [
        ("C1", "SMB", "Bali", 36, 700, 2, Decimal(200), Decimal(120), 1, 2, Decimal(12), 2, Decimal(7)),
        ("C2", "SMB", None, 36, None, 0, Decimal(0), Decimal(0), 0, 0, Decimal(0), 0, Decimal(0)),
    ]
    assert rows(facts.txn_by_customer(txn, savings)) == [("C1", 2, Decimal(7))]


def test_kpis_of_an_empty_portfolio(spark):
    loans = _loans(spark, [("L1", "C1", "SMB", 0, 0, 1)]).filter("false")
    got = analytics.portfolio_kpis(loans, _customers(spark, [("C1", "Bali", "SMB", 1)]).filter("false"))
    assert tuple(got.first()) == (0, 0.0, 0.0, 0)


def test_missing_default_flag_counts_differently(spark):
    loans = _loans(spark, [("L1", "C", "SMB", 0, 1, 1), ("L2", "C", "SMB", 0, None, 1)])
    assert analytics.npl_by_segment(loans).first()["npl_rate_pct"] == Decimal("50.00")
    assert analytics.segment_summary(loans).first()["npl_pct"] == 100.0


def test_orphans_and_missing_parents_treat_missing_keys_differently(spark):
    child = spark.createDataFrame([("a", 1), ("b", 9), ("c", None)], "id string, fk int")
    parent = spark.createDataFrame([(1,), (2,)], "fk int")
    assert rows(relations.orphans(child, parent, "fk").select("id")) == [("b",), ("c",)]
    assert rows(relations.missing_parent(child, "fk", parent, "fk").select("id")) == [("b",)]
    assert relations.count_orphans(child, "fk", parent, "fk").first()[0] == 2
    assert relations.count_orphans(child, "fk", parent, "fk", nulls_count=False).first()[0] == 1


def test_sorting_and_latest(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("d", 3)], "k string, v int")
    assert [r[0] for r in relations.sort_desc(df, "v", "k").collect()] == ["c", "d", "a", "b"]
    assert [r[0] for r in relations.sort_desc(df, "v", "k", nulls_first=True).collect()][0] == "b"
    assert [r[0] for r in relations.latest(df, "v", 2, "k").collect()] == ["c", "d"]
