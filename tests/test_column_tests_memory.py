"""Column tests sum each table's failures before they meet those of other tables."""

from lendmill.operators import quality as Q


def test_tables_meet_as_single_rows(spark):
    rows = spark.range(20).selectExpr("id % 7 AS k")
    tests = [Q.ColumnTest(t, "unique", "k") for t in ("a", "b", "c")]
    report = Q.run_tests({"a": rows, "b": rows.distinct(), "c": rows.limit(0)}, tests)
    assert [(r["table_name"], r["failures"]) for r in report.orderBy("table_name").collect()] == [("a", 7), ("b", 0), ("c", 0)]
    plan = report._jdf.queryExecution().optimizedPlan()
    unions = [n for n in plan.toString().splitlines() if "Union" in n]
    assert len(unions) == 1
    depth = plan.toString().splitlines()
    at = next(i for i, n in enumerate(depth) if "Union" in n)
    assert "Aggregate [sum(" in depth[at + 1]  # a row per table, not a row per key
