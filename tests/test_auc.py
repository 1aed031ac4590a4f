"""Area under the ROC curve against counting all pairs."""

import random

import pytest

from lendmill.operators import ml


def by_pairs(data):
    ok = [(x, s) for x, s in data if x in (0, 1) and s is not None]
    pos, neg = [s for x, s in ok if x == 1], [s for x, s in ok if x == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return len(pos), len(neg), won / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("values", [3, 1000, 1])
def test_area_equals_counting_pairs(spark, values):
    rng = random.Random(values)
    data = [(rng.choice((0, 0, 1)), rng.randrange(values) + 0.25) for _ in range(400)]
    data += [(1, 0.25)] * 150 + [(None, 1.0), (1, None), (2, 5.0), (0, -7.5)]
    df = spark.createDataFrame(data, "label int, score double")
    got = ml.roc_auc(df.repartition(5), "label").first()
    assert tuple(got)[:2] == by_pairs(data)[:2] and got["roc_auc"] == pytest.approx(by_pairs(data)[2], abs=1e-12)


@pytest.mark.parametrize("data", [[], [(1, 2.0)], [(0, 1.0), (0, 2.0)]])
def test_one_label_only(spark, data):
    df = spark.createDataFrame(data, "label int, score double")
    assert tuple(ml.roc_auc(df, "label").first()) == by_pairs(data)


def test_no_task_orders_all_rows(spark):
    df = spark.range(1000).selectExpr("cast(id % 2 as int) label", "cast(id as double) score")
    plan = ml.roc_auc(df, "label")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(_score" in plan
    single = plan.index("Exchange SinglePartition", plan.index("Window"))
    assert plan.index("HashAggregate(keys=[_range", single) > single  # reduced to a row per range before
