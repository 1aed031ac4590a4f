"""Substring dedup and SimHash against plain Python."""

import random

import numpy as np
import plain
import pytest

from lendmill.llm import wordspans
from lendmill.llm.components import SALTS, _told, components
from lendmill.llm.simhash import (
    _forest,
    _replicate,
    hex_fingerprint,
    keep_one,
    link_fingerprints,
    nearest_anchors,
    simhash_components,
)
from lendmill.llm.substring_dedup import substring_dedup


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(plain.awkward(), plain.SCHEMA)


@pytest.mark.parametrize("window, block_bytes, part_windows", [(35, 8 << 20, 1 << 20), (5, 20_000, 3_000)])
def test_substring(docs, window, block_bytes, part_windows):
    found = substring_dedup(docs, window=window, block_bytes=block_bytes, part_windows=part_windows)
    rows = plain.awkward()
    cut = plain.substring([r[1] for r in rows], window)
    expected = [(r[0], r[2], r[3], *c) for r, c in zip(rows, cut, strict=True)]
    got = [
        (r.doc_id, r.source, r.block, r.n_words, r.n_removed, r.text) for r in found.collect()
    ]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_substring_intervals_and_clean_texts(docs):
    found = {(r.doc_id, r.block): r for r in substring_dedup(docs, join_clean=False).collect()}
    row = found[(7, 7)]
    assert row.removed == [[40, 100]] and row.n_removed == 60
    assert found[(5, 5)].text == "tabs\tand\nlines\r\nand\x0bmore\x0cend "
    assert found[(14, 14)].text == ""


def test_word_hashes_do_not_depend_on_place_or_slice(monkeypatch):
    words = ["a", "bb", "a" * 63, "é" * 40, "x" * 5000, "bb", "yy" * 900, "a"] * 3
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    found = []
    for size in (1 << 20, 100, 3):
        monkeypatch.setattr(wordspans, "SLICE_BYTES", size)
        found.append(wordspans.word_hashes(wordspans.spans(data, np.array([0, len(data)]))).tolist())
        by = {}
        for w, h in zip(words, found[-1], strict=True):
            assert by.setdefault(w, h) == h
        assert len(set(by.values())) == len(by)
    assert found[0] == found[1] == found[2]


def test_substring_empty_table(docs):
    assert substring_dedup(docs.where("false")).collect() == []


def test_simhash(docs):
    rows = plain.awkward()
    found = simhash_components(docs, "doc_id", "text").withColumn("hex", hex_fingerprint()).collect()
    prints = [plain.fingerprint(r[1]) for r in rows]
    assert sorted((str(r.doc_id), r.hex) for r in found) == sorted(
        (str(r[0]), format(p, "016x")) for r, p in zip(rows, prints, strict=True)
    )
    group = plain.linked(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    lowest = {}
    for (key, *_), g in zip(rows, group, strict=True):
        if key is not None:
            lowest[g] = min(lowest.get(g, key), key)
    assert sorted((str(r.doc_id), r.component_id) for r in found) == sorted(
        (str(r[0]), lowest.get(g)) for r, g in zip(rows, group, strict=True)
    )


def test_simhash_all_keys_null(spark):
    docs = spark.createDataFrame([(None, "a b c d")] * 2, "doc_id long, text string")
    assert [r.component_id for r in simhash_components(docs, "doc_id", "text").collect()] == [None, None]


def test_simhash_empty_table(docs):
    assert simhash_components(docs.where("false"), "doc_id", "text").collect() == []


def _neighbourhood(rng, centres, spread, n):
    """Values a few flipped bits from some centres."""
    out = set()
    for c in centres:
        for _ in range(n):
            out.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(spread + 1))))
    return sorted(out)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_join_the_same_groups(spark, distance):
    rng = random.Random(distance)
    values = _neighbourhood(rng, [rng.getrandbits(64) for _ in range(3)], 3, 60)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    distinct = spark.createDataFrame(signed, "fingerprint long")
    found = components(link_fingerprints(distinct, distance), "a", "b").collect()
    root = {v: v for (v,) in signed} | {r.node: r.root for r in found}
    group = plain.linked(values, lambda a, b: (a ^ b).bit_count() <= distance)
    mine = {}
    for (v,), g in zip(signed, group, strict=True):
        mine.setdefault(g, set()).add(root[v])
    assert all(len(x) == 1 for x in mine.values())
    assert len({x for s in mine.values() for x in s}) == len(mine)


def test_anchor_with_very_many_fingerprints():
    rng = random.Random(5)
    values = np.array(_neighbourhood(rng, [0, (1 << 40) - 1], 2, 900), np.uint64)
    a, b = _forest(np.zeros(len(values), np.uint64), values, 2)
    group = {int(v): int(v) for v in values} | {int(x): int(y) for x, y in zip(a, b, strict=True)}
    small = values.tolist()
    expected = plain.linked(small, lambda x, y: (x ^ y).bit_count() <= 2)
    assert len(set(group.values())) == len(set(expected))
    assert len(a) == len(values) - len(set(expected))


def test_anchors_cover_within_nine_bits_and_partners_meet():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    assert (np.bitwise_count(x ^ nearest_anchors(x)) <= 9).all()
    import pyarrow as pa

    def placed(v):
        batch = pa.record_batch([pa.array(np.array([v], np.uint64).view(np.int64))], ["fingerprint"])
        return set(next(_replicate(iter([batch]), 2)).column(0).to_pylist())

    for v in x[:40].tolist():
        i, j = rng.choice(64, 2, replace=False).tolist()
        assert placed(v) & placed(v ^ (1 << i) ^ (1 << j))


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(0, 64)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (None, 3)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    root = {r.node: r.root for r in found}
    assert {root[i] for i in range(65)} == {0} and {root[i] for i in range(1000, 1200)} == {1000}
    assert len(found) == 265


def test_components_of_any_links(spark):
    """Against union by walking: hubs at both ends of the order, chains, repeats, both directions."""
    rng = random.Random(11)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)]
    links += [(500, i) for i in range(501, 700)] + [(999, i) for i in range(700, 900)] + [(900, 999), (900, 901)]
    near = {}
    for a, b in links:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    expected = {}
    for node in sorted(near):
        todo = [node]
        while todo:
            at = todo.pop()
            if at not in expected:
                expected[at] = node
                todo.extend(near[at])
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)


def test_a_hub_is_dealt_to_groups(spark):
    """No task of the join holds the links of a hub: each of its groups has a small share."""
    stars = spark.range(1, 6401).selectExpr("id as node", "0L as root")
    low = spark.createDataFrame([(0, -1)], "root long, low long")
    told = _told(stars, "root", "node", low)
    sizes = [r["count"] for r in told.groupBy("root", "salt").count().collect()]
    assert sum(sizes) == 6400 and len(sizes) == SALTS and max(sizes) < 200
    assert told.where("low = -1").count() == 6400


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_keep_one(docs):
    kept = keep_one(docs, "doc_id", "text").collect()
    rows = plain.awkward()
    group = plain.linked([plain.fingerprint(r[1]) for r in rows], lambda a, b: (a ^ b).bit_count() <= 2)
    lowest = {}
    for (key, *_), g in zip(rows, group, strict=True):
        lowest[g] = min(lowest.get(g, (True, 0)), (key is None, key or 0))
    expected = sorted(str(None if none else k) for none, k in lowest.values())
    assert sorted(str(r.doc_id) for r in kept) == expected
    assert kept[0].asDict().keys() == set(docs.columns)
