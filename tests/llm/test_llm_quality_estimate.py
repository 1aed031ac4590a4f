"""What the quality rules' estimate makes of rare junk and of a rule that is often wrong."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendmill.llm import quality_rules as Q

RULES = ["length", "word_length", "symbols", "capitals", "shouting", "repeated_windows", "repeated_lines"]

#: Vote patterns of 10,000 documents with their counts; rules in the order above.
DOCUMENTS = {
    (1, 1, 1, 1, 1, 1, 1): 7185,
    (0, 1, 1, 1, 1, 1, 1): 790,
    (1, 1, -1, 1, 1, 1, 1): 591,
    (-1, 1, 1, 1, 1, 1, 1): 374,
    (1, 1, 1, 1, 1, -1, 1): 219,
    (1, 1, 1, 1, 1, 1, 0): 201,
    (1, 1, 1, -1, -1, -1, 1): 149,
    (1, 1, 1, -1, -1, -1, 0): 119,
    (0, 1, -1, 1, 1, 1, 1): 66,
    (1, 1, 1, -1, -1, -1, -1): 54,
    (1, 1, 1, 1, 1, -1, -1): 43,
    (-1, 1, -1, 1, 1, 1, 1): 30,
    (0, 1, 1, 1, 1, 1, 0): 28,
}


def lone(rule):
    return tuple(-1 if r == rule else 1 for r in RULES)


def plain_posteriors(counts):
    """Expectation-maximisation on arrays: class 0 is good, class k the kind of rule k - 1."""
    seen = np.array([[[v == x for x in (1, 0, -1)] for v in p] for p in counts], float)
    n, k = np.array(list(counts.values()), float), len(next(iter(counts)))
    good, own = np.array([0.8, 0.195, 0.005]), np.array([0.02, 0.03, 0.95])
    share = np.array([0.8] + [0.2 / k] * k)
    table = np.tile(good, (k + 1, k, 1))
    for r in range(k):
        table[r + 1, r] = own
    first_share, first_table = share.copy(), table.copy()
    for _ in range(100_000):
        weight = share * np.exp(np.einsum("prv,crv->pc", seen, np.log(table)))
        texts = n[:, None] * weight / weight.sum(1, keepdims=True)
        believed = np.tile(table[0], (k + 1, 1, 1))
        believed[0] = first_table[0]
        for r in range(k):
            believed[r + 1, r] = first_table[r + 1, r]
        new = np.einsum("pc,prv->crv", texts, seen) + 10 * believed
        new = np.clip(new / new.sum(2, keepdims=True), 1e-9, None)
        for r in range(k):
            kind = new[r + 1, r]
            if kind[2] < 0.5:
                kind[:2] *= 0.5 / kind[:2].sum()
                kind[2] = 0.5
        share = texts.sum(0) + 10 * first_share
        share /= share.sum()
        share[1:] = np.minimum(share[1:], 0.1)
        share[0] = 1 - share[1:].sum()
        change, table = np.abs(new - table).max(), new
        if change < 1e-12:
            break
    weight = share * np.exp(np.einsum("prv,crv->pc", seen, np.log(table)))
    return dict(zip(counts, weight[:, 0] / weight.sum(1), strict=True))


def posteriors(spark, counts):
    names = [f"v_{r}" for r in RULES]
    rows = spark.createDataFrame([(*p, n) for p, n in counts.items()], [*names, "n"])
    votes = rows.withColumn("i", F.explode(F.sequence(F.lit(1), "n"))).select(*names)
    model = Q.estimate(votes, RULES)
    found = rows.select(*names, Q.posterior(model).alias("p")).collect()
    return {tuple(r)[:-1]: r.p for r in found}


def check(spark, counts):
    found, expected = posteriors(spark, counts), plain_posteriors(counts)
    assert [found[p] for p in counts] == pytest.approx([expected[p] for p in counts], abs=1e-4)
    return found


@pytest.mark.parametrize("rule", RULES)
def test_rare_junk_that_one_rule_sees(spark, rule):
    counts = {p: n for p, n in DOCUMENTS.items() if p[RULES.index(rule)] >= 0}
    for n in (1, 10):  # 10 are 0.1%
        found = check(spark, counts | {lone(rule): n})
        assert found[lone(rule)] < Q.KEEP_FROM <= found[(1,) * len(RULES)]


@pytest.mark.parametrize("rule", RULES)
def test_rule_that_is_wrong_on_a_third_of_clean_texts(spark, rule):
    counts, at = {}, RULES.index(rule)
    for p, n in DOCUMENTS.items():
        wrong = n // 3 if min(p) >= 0 else 0
        for q, m in ((p, n - wrong), (p[:at] + (-1,) + p[at + 1 :], wrong)):
            if m:
                counts[q] = counts.get(q, 0) + m
    found = check(spark, counts)
    assert found[lone(rule)] >= Q.KEEP_FROM
    shout = (1, 1, 1, -1, -1, -1, 1)
    assert found[shout] < Q.KEEP_FROM
    if rule != "symbols":  # the other kinds of junk are still told
        assert found[lone("symbols")] < Q.KEEP_FROM


@pytest.mark.parametrize("times", [1, 20])
def test_what_is_found_does_not_depend_on_the_number_of_texts(spark, times):
    found = check(spark, {p: n * times for p, n in DOCUMENTS.items()})
    assert found[lone("symbols")] < Q.KEEP_FROM
    assert all((found[p] >= Q.KEEP_FROM) == (min(p) >= 0) for p in DOCUMENTS)


def test_junk_of_two_thirds_that_several_rules_see(spark):
    found = check(spark, DOCUMENTS | {(1, 1, 1, -1, -1, 1, 1): 20_000})
    assert found[(1, 1, 1, -1, -1, 1, 1)] < Q.KEEP_FROM
