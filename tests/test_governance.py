"""Masks, row access, projection, tags, lineage."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lendmill.functions import masking as M
from lendmill.operators import governance as G
from lendmill.operators.lineage import lineage


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [
            ("C1", "1234567890123456", "a.b@c.id", "081234567", 100, "DKI Jakarta", "n"),
            ("C2", None, None, None, None, "Bali", None),
            ("C3", "123", "@c.id", "0899", 5, None, "n"),
        ],
        "customer_id string, nik string, email string, phone string, monthly_income int, province string, npwp string",
    )


MASKED = ["nik", "email", "phone", "monthly_income"]


def seen(df, role):
    return [tuple(r) for r in G.apply_masking(df, G.CUSTOMER_POLICIES, role).orderBy("customer_id").select(*MASKED).collect()]


def test_masks(customers):
    clear = [tuple(r) for r in customers.orderBy("customer_id").select(*MASKED).collect()]
    assert seen(customers, M.ADMIN) == seen(customers, M.AUDITOR) == clear
    assert seen(customers, M.ENGINEER) == [
        ("XXXXXXXXXXXX3456", "****@c.id", "0812XXXXXX", 100),
        (None, None, None, None),
        ("123", "@c.id", "0899XXXXXX", 5),
    ]
    hidden = "X" * 16
    assert seen(customers, M.ANALYST) == [
        (hidden, "****@c.id", "0812XXXXXX", None),
        (hidden, None, None, None),
        (hidden, "@c.id", "0899XXXXXX", None),
    ]
    assert seen(customers, "somebody else") == seen(customers, M.ANALYST)


def test_masking_twice_changes_nothing(customers):
    once = G.apply_masking(customers, G.CUSTOMER_POLICIES, M.ANALYST)
    assert rows(G.apply_masking(once, G.CUSTOMER_POLICIES, M.ANALYST)) == rows(once)


def test_an_auditor_pays_nothing(customers):
    plan = G.apply_masking(customers, G.CUSTOMER_POLICIES, M.AUDITOR)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE" not in plan and "regexp" not in plan


def test_role_may_come_from_the_session(spark, customers):
    spark.sql("DECLARE OR REPLACE VARIABLE cur_role STRING DEFAULT 'analyst'")
    view = customers.select(M.mask_income(F.col("monthly_income"), F.expr("session.cur_role")).alias("v"))
    view.createOrReplaceTempView("incomes")
    assert spark.sql("SELECT max(v) FROM incomes").first()[0] is None
    spark.sql("SET VARIABLE cur_role = 'auditor'")
    assert customers.select(M.mask_income(F.col("monthly_income"), F.expr("session.cur_role")).alias("v")).agg(F.max("v")).first()[0] == 100


def test_row_access(customers):
    assert rows(G.apply_row_access(customers, M.ANALYST).select("customer_id")) == [("C1",)]
    assert G.apply_row_access(customers, M.ENGINEER).count() == 3


def test_projection(customers):
    for role in (M.ANALYST, M.ENGINEER):
        with pytest.raises(G.ProjectionDenied):
            G.governed_select(customers, ["customer_id", "NIK"], role)
    lenient = G.governed_select(customers, ["customer_id", "nik"], M.ANALYST, lenient=True)
    assert lenient.columns == ["customer_id"]
    assert G.governed_select(customers, ["nik"], M.AUDITOR).count() == 3


def test_tags(customers):
    tagged = G.tag_customers(customers)
    found = {(r[0], r[1]): (r[2], r[3]) for r in G.tags_of(tagged.select("nik", "email", "province")).collect()}
    assert found == {
        ("nik", "pii_type"): ("NIK", 2),
        ("email", "pii_type"): ("EMAIL", 2),
        ("nik", "data_classification"): ("CONFIDENTIAL", 2),
        ("email", "data_classification"): ("CONFIDENTIAL", 2),
        ("province", "data_classification"): ("CONFIDENTIAL", 2),
    }
    with pytest.raises(ValueError):
        G.tag(customers, "nik", "pii_type", "SECRET")
    assert G.tags_of(customers).count() == 0


EDGES = [
    ("files", "raw_c"), ("files", "raw_l"), ("raw_c", "stg_c"), ("raw_l", "stg_l"), ("stg_c", "c360"),
    ("stg_l", "c360"), ("stg_l", "mlp"), ("raw_c", "dim"), ("c360", "board"), ("board", "files"),
]


def test_lineage(spark):
    edges = spark.createDataFrame(EDGES, "src string, dst string")
    assert rows(lineage(edges, "c360", "upstream", 2)) == [("raw_c", 2), ("raw_l", 2), ("stg_c", 1), ("stg_l", 1)]
    up = dict(rows(lineage(edges, "c360", "upstream", 5)))
    assert up == {"stg_c": 1, "stg_l": 1, "raw_c": 2, "raw_l": 2, "files": 3, "board": 4}
    down = dict(rows(lineage(edges, "raw_l", "downstream", 5)))
    assert down == {"stg_l": 1, "c360": 2, "mlp": 2, "board": 3, "files": 4, "raw_c": 5}
    assert lineage(edges, "nobody", "upstream", 5).count() == 0
