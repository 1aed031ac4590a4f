"""Quality rules, mixing, packing."""

import itertools
import random

import plain
import pytest

from lendmill.llm import quality_rules as Q
from lendmill.llm.mixing import fit, knapsack, mix, source_targets
from lendmill.llm.packing import Bins, best_fit, pack


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(plain.awkward(), plain.SCHEMA)


# ---- quality ------------------------------------------------------------------


def test_measures(docs):
    found = Q.judge(docs).collect()
    rows = plain.awkward()
    expected = sorted((str(r[0]), str(r[3]), *plain.measures(r[1])) for r in rows)
    got = sorted(
        (str(r.doc_id), str(r.block), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in found
    )
    assert got == expected
    for r in found:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept) and 0 <= r.posterior <= 1


def test_kinds_of_junk_are_told_from_prose(spark):
    rng = random.Random(1)
    say = lambda n: [f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}" for _ in range(n)]
    good = [" ".join(say(120)) for _ in range(150)]
    symbols = [" ".join(x + "***" for x in say(120)) for _ in range(8)]
    shouts = [" ".join(x.upper() + "!!" for x in say(120)) for _ in range(8)]
    docs = spark.createDataFrame(
        [(i, t) for i, t in enumerate(good + symbols + shouts)], "doc_id long, text string"
    )
    kept = {r.doc_id for r in Q.judge(docs).where("kept").collect()}
    assert kept == set(range(150))


def test_model_of_counts_is_a_distribution(spark):
    rules = ["a", "b", "c"]
    patterns = [p for p in itertools.product((1, 0, -1), repeat=3) for _ in range(10 if 1 in p else 1)]
    model = Q.estimate(spark.createDataFrame(patterns, [f"v_{r}" for r in rules]), rules)
    assert sum(model.share.values()) == pytest.approx(1)
    for own in model.votes.values():
        for p in own.values():
            assert sum(p.values()) == pytest.approx(1) and min(p.values()) > 0


def test_quality_empty_table(docs):
    assert Q.judge(docs.where("false")).collect() == []


# ---- mixing -------------------------------------------------------------------


def test_knapsack_is_best():
    rng = random.Random(2)
    for _ in range(60):
        lengths = sorted(rng.sample(range(1, 30), 4))
        counts = [rng.randrange(0, 4) for _ in lengths]
        budget = rng.randrange(0, 90)
        taken = knapsack(lengths, counts, budget)
        assert all(0 <= t <= n for t, n in zip(taken, counts, strict=True))
        sums = {
            sum(length * n for length, n in zip(lengths, p, strict=True))
            for p in itertools.product(*[range(n + 1) for n in counts])
        }
        assert sum(length * t for length, t in zip(lengths, taken, strict=True)) == max(
            s for s in sums if s <= budget
        )


def test_fit_large_budgets_and_long_texts():
    for most in (64, 1 << 16):
        lengths, counts = [1, 7, 90, 4000, 100_000], [50, 900, 400, 300, 9]
        for budget in (0, 1, 12_345, 777_777, 2_000_000, 10**9):
            taken = fit(lengths, counts, budget, most)
            got = sum(length * t for length, t in zip(lengths, taken, strict=True))
            whole = sum(length * n for length, n in zip(lengths, counts, strict=True))
            assert all(0 <= t <= n for t, n in zip(taken, counts, strict=True))
            assert abs(got - min(budget, whole)) <= 1


def _levels(sizes, weights, most):
    """Water filling by bisection."""
    total, low, high = sum(sizes), 0.0, 10.0 * sum(sizes) + 1
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(most * s, w * mid) for s, w in zip(sizes, weights, strict=True)) < total:
            low = mid
        else:
            high = mid
    return [min(most * s, w * high) for s, w in zip(sizes, weights, strict=True)]


def test_targets_stop_at_three_times(spark):
    sizes = [("a", 1000), ("b", 10), ("é", 40), ("z", 0), ("Z", 500), (None, 3)]
    found = source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()
    order = ["Z", "a", "b", "z", "é", None]
    known = dict(sizes)
    expected = _levels([known[s] for s in order], [1, 2, 3, 1, 2, 3], 3)
    got = {r.source: r.target for r in found}
    assert [got[s] for s in order] == pytest.approx(expected)


def test_mix(docs):
    found = mix(docs).collect()
    again = mix(docs.repartition(7)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    rows = plain.awkward()
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted(
        (str(r[0]), len(plain.words(r[1]))) for r in rows
    )
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert {r.source_size for r in own} == {sum(r.size for r in own)}
        assert all(r.taken == r.times * r.size and r.taken <= 3 * r.size for r in own)


def test_mix_hits_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" * rng.randrange(1, 60)), f"s{min(rng.randrange(9), 4)}") for i in range(900)]
    rows += [(1000 + i, "five words are in here", "s4") for i in range(800)]  # one length, one source
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix(docs, keep_text=False).collect()
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1


def test_mix_empty_table_and_no_words(spark, docs):
    assert mix(docs.where("false")).collect() == []
    none = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert {(r.size, r.target, r.taken) for r in mix(none).collect()} == {(0, 0.0, 0)}


# ---- packing ------------------------------------------------------------------


def _slow_best_fit(sizes, sources, clusters, capacity, distinct):
    """Every bin looked at, tightest compatible one taken; sizes of bins and their documents."""
    bins = []
    for k in sorted(range(len(sizes)), key=lambda k: (-(sizes[k] % capacity), k)):
        size = sizes[k] % capacity
        if not size:
            continue
        fits = [
            b
            for b in bins
            if b["left"] >= size
            and not (distinct and sources[k] in b["sources"])
            and not (clusters[k] is not None and clusters[k] in b["clusters"])
        ]
        if fits:
            tight = min(b["left"] for b in fits)
            b = next(b for b in fits if b["left"] == tight)
        else:
            bins.append(b := {"left": capacity, "sources": set(), "clusters": set(), "docs": []})
        b["left"] -= size
        b["sources"].add(sources[k])
        b["clusters"].add(clusters[k])
        b["docs"].append(k)
    return bins


@pytest.mark.parametrize("distinct", [True, False])
def test_best_fit(distinct):
    rng = random.Random(6)
    for _ in range(20):
        n, capacity = 150, 64
        sizes = [rng.choice([0, 3, 5, rng.randrange(1, 150)]) for _ in range(n)]
        sources = [rng.choice(["hot", "hot", "a", "b", "c"]) for _ in range(n)]
        clusters = [rng.choice([None, 1, 1, 2, rng.randrange(10, 99)]) for _ in range(n)]
        pieces = best_fit(sizes, sources, clusters, capacity, distinct)
        held, words = {}, {}
        for k, piece, begin, size, b, place, offset in pieces:
            words[k] = words.get(k, 0) + size
            if b is None:
                assert not sizes[k]
                continue
            assert begin == piece * capacity
            held.setdefault(b, []).append((place, offset, size, k))
        assert words == dict(enumerate(sizes))
        for own in held.values():
            own.sort()
            assert [x[0] for x in own] == list(range(len(own)))
            assert [x[1] for x in own] == list(itertools.accumulate([0] + [x[2] for x in own[:-1]]))
            assert sum(x[2] for x in own) <= capacity
            docs = [x[3] for x in own]
            known = [clusters[k] for k in docs if clusters[k] is not None]
            assert len(known) == len(set(known))
            assert not distinct or len(docs) == len({sources[k] for k in docs})
        whole = sum(s // capacity for s in sizes)
        assert len(held) - whole <= len(_slow_best_fit(sizes, sources, clusters, capacity, distinct)) + 2


def test_tightest_compatible_bin():
    bins = Bins(100)
    for residual, bitmap, number in ((10, 0b01, 1), (12, 0b10, 2), (12, 0b11, 3), (90, 0, 4)):
        bins.add(residual, bitmap, number)
    assert bins.take(9, 0b01) == (12, 0b10, 2)
    assert bins.take(9, 0b01) == (90, 0, 4)
    assert bins.take(9, 0b01) is None
    assert bins.take(9, 0) == (10, 0b01, 1)
    assert bins.take(13, 0) is None and bins.take(12, 0) == (12, 0b11, 3)


def test_pack(docs):
    found = pack(docs, capacity=128, group_rows=8).collect()
    rows = plain.awkward()
    assert sum(r.n_words for r in found) == sum(len(plain.words(r[1])) for r in rows)
    assert {r.doc_id for r in found} == {r[0] for r in rows}
    bins = {}
    for r in found:
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    for own in bins.values():
        assert sum(r.n_words for r in own) <= 128 and len(own) == len({r.source for r in own})
    assert sorted(map(repr, found)) == sorted(map(repr, pack(docs.repartition(3), capacity=128, group_rows=8).collect()))


def test_pack_empty_table_and_given_clusters(spark, docs):
    assert pack(docs.where("false")).collect() == []
    same = spark.createDataFrame(
        [(i, "a b", f"s{i}", i % 2 if i else None) for i in range(6)],
        "doc_id long, text string, source string, c int",
    )
    found = pack(same, cluster="c", capacity=100).collect()
    bins = {}
    for r in found:
        bins.setdefault(r.bin_id, []).append(r.c)
    assert all(len([c for c in own if c is not None]) == len({c for c in own if c is not None}) for own in bins.values())
    assert len(bins) == 3
