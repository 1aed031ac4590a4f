"""Histories of hot keys, and latest rows."""

import random

import pytest
from conftest import rows

from lendmill.operators import history
from lendmill.plans.history_upkeep import HistoryTable


def _skewed(spark, n=600):
    rng = random.Random(5)
    data = []
    for i in range(n):
        kind = rng.random()
        key = None if kind < 0.1 else 7 if kind < 0.5 else 8 if kind < 0.6 else rng.randrange(100, 400)
        data.append((key, i))
    return spark.createDataFrame(data, "k bigint, v bigint")


def _brute_history(data):
    out, by_key = [], {}
    for k, t, s in sorted(data, key=lambda r: (str(r[0]), r[1])):
        by_key.setdefault(k, []).append((t, s))
    for k, seq in by_key.items():
        kept = [x for i, x in enumerate(seq) if i == 0 or x[1] != seq[i - 1][1]]
        for i, (t, s) in enumerate(kept):
            until = kept[i + 1][0] if i + 1 < len(kept) else None
            out.append((k, s, t, until, until is None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_rows", [1_000_000, 60, 5])
def test_history_of_hot_keys(spark, slice_rows):
    """A key of many budgets and rows without a key are cut; the result does not change."""
    rng = random.Random(9)
    data = [(1, t, rng.choice("ab")) for t in range(700)]
    data += [(None, t, rng.choice("abbb")) for t in range(300)]
    data += [(2, t, "x") for t in range(100)]
    data += [(k, t, rng.choice(["a", None])) for k in range(10, 60) for t in range(rng.randrange(1, 6))]
    df = spark.createDataFrame(data, "k int, t int, s string")
    out = history.scd2_from_history(df, "k", ["s"], "t", slice_rows=slice_rows)
    assert rows(out) == _brute_history(data)


def test_a_hot_key_is_spread(spark):
    df = spark.range(1000).selectExpr("1 as k", "id as t", "cast(id as string) as s")
    heavy = df.groupBy(df.k.alias("_heavy")).count().withColumnRenamed("count", "_n")
    sliced = history._sliced(df, heavy, "k", "t", 100).groupBy("_slice").count()
    counts = [r["count"] for r in sliced.collect()]
    assert len(counts) >= 8 and max(counts) <= 250


@pytest.mark.parametrize("seed", range(2))
def test_deliveries_in_any_order(spark, tmp_path, seed):
    """Backdated rows split, shorten, merge and reopen versions; one delivery is made twice."""
    rng = random.Random(seed)
    data = {(k, t): rng.choice("aab") for k in (1, 2, 3, None) for t in rng.sample(range(200), 40)}
    data |= {(9, t): "ab"[t // 7 % 2] for t in range(60)}
    data = [(k, t, s, 1) for (k, t), s in data.items()]
    rng.shuffle(data)
    parts = [data[i::5] for i in range(5)]
    parts[4] = parts[4] + [(k, t, "c", 2) for k, t, *_ in parts[0][:6]]  # another row of an instant wins
    shape = "k int, t int, s string, n int"
    df = lambda part: spark.createDataFrame(part, shape)
    table = HistoryTable(spark, str(tmp_path), df([]), "k", ["s"], "t", "n", buckets=2)
    left = {}
    for number, part in enumerate(parts, 1):
        table.deliver(df([*part, (1, None, "z", 1)]), number)
        if number == 2:
            table.deliver(df(part), number)
        for k, t, s, n in part:
            left[(k, t)] = max(left.get((k, t), (0, "")), (n, s))
        if number in (1, 3, 5):
            assert rows(table.read()) == _brute_history([(k, t, s) for (k, t), (_, s) in left.items()])


def test_a_backdated_row_makes_the_versions_around_it_only(spark):
    seen = [(1, t, "abc"[t // 10 % 3]) for t in range(100)]
    df = lambda r, shape: spark.createDataFrame(r, shape)
    shape = "k int, t int, s string"
    stored = history.scd2_from_history(df(seen, shape), "k", ["s"], "t")
    new = (1, 45, "z")
    # rows outside the window are not asked for: without them nothing changes
    near = [r for r in seen if 40 <= r[1] < 60 and r[1] != 45]
    out = history.scd2_insert(stored, df([*near, new], shape), df([new], shape), "k", ["s"], "t")
    assert rows(out) == _brute_history([*[r for r in seen if r[1] != 45], new])


def test_history_takes_the_last_row_of_an_instant(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", 1), (1, 2, "b", 2), (1, 2, "a", 3), (1, 3, "c", 4)], "k int, t int, s string, n int"
    )
    out = history.scd2_from_history(df, "k", ["s"], "t", "n")
    assert rows(out) == [(1, "a", 1, 3, False), (1, "c", 3, None, True)]


def test_latest_row_combines_before_the_shuffle(spark):
    df = _skewed(spark)
    out = history.latest_per_key(df, "k", "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert "WindowGroupLimit" in plan.split("Exchange")[1]
    best = {}
    for k, v in (tuple(r) for r in df.collect()):
        best[k] = max(best.get(k, -1), v)
    assert rows(out) == sorted(best.items(), key=repr)
