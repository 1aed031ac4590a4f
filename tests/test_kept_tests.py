"""Column tests kept up by changes against testing whole tables."""

import random

import pytest
from conftest import rows

from lendmill.operators import quality as Q
from lendmill.plans import kept_tests
from lendmill.plans.kept_tests import KeptTests
from lendmill.sources.buckets import BucketTable

SHAPES = {"people": "id int, kind string", "loans": "no int, owner int, guarantor int"}
TESTS = [
    Q.ColumnTest("people", "not_null", "id"),
    Q.ColumnTest("people", "unique", "id"),
    Q.ColumnTest("people", "accepted_values", "kind", values=("a", "b")),
    Q.ColumnTest("loans", "unique", "no"),
    Q.ColumnTest("loans", "relationships", "owner", to_table="people", to_column="id"),
    Q.ColumnTest("loans", "relationships", "guarantor", to_table="people", to_column="id"),
]


def frames(spark, content):
    return {n: spark.createDataFrame(content[n], SHAPES[n]) for n in content}


def expected(spark, content):
    return rows(Q.run_tests(frames(spark, content), TESTS))


def made(rng, n):
    some = lambda k: rng.choice([None, *range(k)])
    return {
        "people": [(some(12), rng.choice(["a", "b", "c", None])) for _ in range(n)],
        "loans": [(some(15), some(14), some(14)) for _ in range(n)],
    }


def changed(spark, path, like, came, gone, number):
    plus, minus = frames(spark, came), frames(spark, gone)
    kept = KeptTests(spark, path, TESTS, like, buckets=2)
    kept.apply({n: (plus[n], minus.get(n)) for n in plus}, number)
    return rows(kept.report().select("test_name", "table_name", "column_name", "failures", "status"))


def test_changes_equal_whole_tables(spark, tmp_path):
    rng = random.Random(4)
    like, content = frames(spark, {"people": [], "loans": []}), {"people": [], "loans": []}
    for number in (1, 2, 3):
        came = made(rng, 12)
        gone = {n: rng.sample(content[n], len(content[n]) // 3) for n in content}
        if number == 3:  # one table only
            came, gone = {"people": came["people"]}, {"people": gone["people"]}
        for n in came:
            for r in gone[n]:
                content[n].remove(r)
            content[n] += came[n]
        assert changed(spark, str(tmp_path), like, came, gone, number) == expected(spark, content)


def test_a_change_that_died_is_made_again(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    first, second = made(rng, 10), made(rng, 10)
    like = frames(spark, first)
    changed(spark, str(tmp_path), like, first, {}, 1)
    with monkeypatch.context() as patched:
        whole = BucketTable.add

        def dies(self, *a):
            if self.path.endswith("loans.no"):
                raise RuntimeError("lost")
            return whole(self, *a)

        patched.setattr(kept_tests.BucketTable, "add", dies)
        with pytest.raises(RuntimeError, match="lost"):
            changed(spark, str(tmp_path), like, second, first, 2)
    assert changed(spark, str(tmp_path), like, second, first, 2) == expected(spark, second)
    assert changed(spark, str(tmp_path), like, second, first, 2) == expected(spark, second)
