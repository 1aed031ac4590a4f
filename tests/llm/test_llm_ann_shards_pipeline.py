"""Nearest neighbours, sharding, the pipeline and the registered queries."""

import collections
import math
import os
import zlib

import numpy as np
import plain
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from test_llm_quality_estimate import plain_posteriors

from lendmill.llm import quality_rules as Q
from lendmill.llm.ann_tree import AnnIndex, Tree, nearest_neighbours
from lendmill.llm.queries import ORACLE, QUERIES
from lendmill.llm.sharding import place, topology, tree_shard, write_shards

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, leaf string, id int"


# ---- nearest neighbours -------------------------------------------------------


def _brute(rows, queries, k):
    good = [
        (i, np.array(v, np.float32).astype(float))
        for i, v in rows
        if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)
    ]
    out = {}
    for q in queries:
        own = sorted((tuple(v) for i, v in good if i == q))
        if own:
            far = sorted((math.sqrt(sum((v - np.array(own[0])) ** 2)), i) for i, v in good if i != q)
            out[q] = far[:k]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=8)).round(2).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(400)]  # one vector many times
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [float("inf")] * 8, [1.0] * 7 + [None], [1.0] * 3]
    rows += [(2000 + 50 * i, v) for i, v in enumerate(odd)]
    return rows + [(50, rows[50][1]), (50, [9.0] * 8), (None, [1.0] * 8)]


def _found(spark, vectors, **settings):
    df = spark.createDataFrame([(i, v, "l", 1) for i, v in vectors], VECTORS)
    rows = nearest_neighbours(df, F.col("vec_id") % 50 == 0, **settings).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_all_leaves_visited_is_exact(spark, vectors):
    df = spark.createDataFrame([(i, v, "l", 1) for i, v in vectors], VECTORS)
    index = AnnIndex(df, leaf_rows=20, block_rows=64)
    asking = index.table.where("id % 50 = 0").groupBy("id").agg(F.min("vec").alias("vec"))
    got = {}
    for r in index.search(asking, 10, visits=10**6).orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append((r.score, r.id))
    expected = _brute(vectors, [i for i, _ in vectors if i is not None and i % 50 == 0], 10)
    assert got.keys() == expected.keys()
    for q, far in expected.items():
        assert [i for _, i in got[q]] == [i for _, i in far]
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in far], abs=1e-12)


def test_calibrated_recall(spark, vectors):
    got = _found(spark, vectors, leaf_rows=20, block_rows=100)
    expected = _brute(vectors, [i for i, _ in vectors if i is not None and i % 50 == 0], 10)
    assert got.keys() == expected.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in far}) for q, far in expected.items())
    assert hits >= 0.9 * sum(len(far) for far in expected.values())
    assert all(len(x) == 10 for x in got.values())


def test_few_or_no_candidates(spark, vectors):
    assert _found(spark, []) == {}
    assert _found(spark, [(0, [1.0] * 8)]) == {}
    assert _found(spark, [(0, [1.0] * 8), (3, [1.0, 2.0] * 4)]) == {0: [(2.0, 3)]}
    assert _found(spark, [(0, None), (50, [0.0] * 8)]) == {}


def test_tree_puts_every_vector_in_a_leaf_and_visits_each_once():
    x = np.random.default_rng(1).normal(size=(3000, 6))
    tree = Tree(x, 50)
    assert set(tree.leaf_of(x)) <= set(range(tree.n_leaves))
    for q in x[:5]:
        assert sorted(tree.visits(q)) == list(range(tree.n_leaves))
    assert Tree(np.ones((100, 4)), 10).n_leaves >= 1


# ---- sharding -----------------------------------------------------------------


def test_place(spark):
    docs = spark.createDataFrame(plain.awkward(), plain.SCHEMA)
    found = place(docs, 7).collect()
    rows = plain.awkward()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == sorted(
        (str(r[0]), len(raw) + 16, zlib.crc32(raw)) for r in rows for raw in [(r[1] or "").encode()]
    )
    shards = collections.defaultdict(list)
    for r in found:
        shards[r.shard].append(r.slot)
        assert 0 <= r.shard < 7 and r.grown_shard in (r.shard, 7)
        assert r.rack == r.shard // 5 % 2 and r.region == r.shard // 10
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert place(docs.where("false"), 7).collect() == []


def test_only_changed_subtrees_move(spark):
    keys = spark.range(20_000)
    trees = {
        "a": topology(12),
        "more": topology(13),
        "heavy": topology(12, [1.0] * 4 + [3.0] + [1.0] * 7),
        "none": topology(12, [1.0] * 3 + [0.0] + [1.0] * 8),
    }
    frame = keys.select("id", *[tree_shard(F.col("id"), t)["shard"].alias(n) for n, t in trees.items()])
    rows = frame.collect()
    moved = lambda n: [(r.a, r[n]) for r in rows if r.a != r[n]]
    assert {to for _, to in moved("more")} == {12}
    assert {to for _, to in moved("heavy")} == {4}
    assert {was for was, _ in moved("none")} == {3} and 3 not in {r.none for r in rows}
    share = collections.Counter(r.heavy for r in rows)
    assert share[4] / len(rows) == pytest.approx(3 / 14, abs=0.015)
    for s in set(range(12)) - {4}:
        assert share[s] / len(rows) == pytest.approx(1 / 14, abs=0.012)


def test_write_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * i) for i in range(300)], "doc_id long, text string")
    write_shards(docs, f"{tmp_path}/out", 12, files_per_shard=2)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 300 and back.select("text").where("length(text) = doc_id").count() == 300
    assert set(os.listdir(f"{tmp_path}/out")) >= {"region=0", "region=1"}


# ---- pipeline -----------------------------------------------------------------


def _votes(text):
    n, chars, symbols, dup, repeat = plain.measures(text)
    text = text or ""
    lines = len([x for x in text.split("\n") if plain.WORD.search(x)])
    capitals = sum(c.isupper() for c in text)

    def vote(bad, good):
        return Q.BAD if bad else Q.GOOD if good else Q.ABSTAIN

    per = lambda a, b: a / b if b else math.nan
    return (n < 50 or 100 * repeat > 50 * n), {
        "word_length": vote(per(chars, n) < 2.5 or per(chars, n) > 12, 3 <= per(chars, n) <= 9),
        "symbols": vote(per(symbols, n) > 0.1, per(symbols, n) < 0.02),
        "capitals": vote(per(capitals, chars) > 0.3, per(capitals, chars) < 0.1),
        "shouting": vote(per(text.count("!"), n) > 0.1, per(text.count("!"), n) < 0.02),
        "repeated_lines": vote(dup >= 3 and per(dup, lines) > 0.5, per(dup, lines) < 0.1),
    }


def _kept_by_rules(texts):
    votes = [(failed, tuple(v.values())) for failed, v in map(_votes, texts)]
    good = plain_posteriors(collections.Counter(p for _, p in votes))
    return [not failed and good[p] >= Q.KEEP_FROM for failed, p in votes]


def test_pipeline(spark, tmp_path):
    extra = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = [(r[0], r[1], "xx", r[2], len(r[1] or "")) for r in plain.awkward()]
    rows += [(100 + r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in extra[:60]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"}
    good, one, cut, mixed, packed = seen

    kept = [r for r, ok in zip(rows, _kept_by_rules([r[1] for r in rows]), strict=True) if ok]
    assert sorted(map(repr, kept)) == sorted(repr(tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars"))) for r in good)
    group = plain.linked([plain.fingerprint(r[1]) for r in kept], lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for r, g in zip(kept, group, strict=True):
        first[g] = min(first.get(g, r), r, key=lambda x: (x[0] is None, x[0] or 0))
    assert sorted(r.doc_id for r in one) == sorted(r[0] for r in first.values())
    texts = [r[1] for r in first.values()]
    want = {}
    for r, (n, gone, text) in zip(first.values(), plain.substring(texts, 35), strict=True):
        if not gone or gone < n:
            want[r[0]] = (text, len(text)) if gone else (r[1], r[4])
    assert {r.doc_id: (r.text, r.n_chars) for r in cut} == want
    times = collections.Counter(r.doc_id for r in mixed)
    assert set(times) <= set(want) and max(times.values()) <= 3
    words = collections.Counter()
    for r in packed:
        words[r.doc_id] += r.n_words
    assert words == collections.Counter(
        {i: n * len(plain.words(want[i][0])) for i, n in times.items() if plain.words(want[i][0])}
    )
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(repr, ran)) == sorted(map(repr, packed))


def test_pipeline_of_an_empty_table_and_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, times int, n_words int"
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(1, text, None, None, None, "mine", 7, None), (2, "", "en", "a", 0, "k", 0, 1)]
    full = spark.createDataFrame(rows, schema)
    for docs, n in ((full.where("false"), 0), (full, 1)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == full.columns, name
        found = docs.collect()
        assert len(found) == n
        if n:
            assert found[0].kept == "mine" and found[0].times == 7 and found[0].text == text
        assert corpus_pipeline.packed(spark, docs, str(tmp_path)).count() == n


# ---- registered queries -------------------------------------------------------


@pytest.mark.parametrize("name", list(QUERIES))
def test_registered(spark, name):
    problem, rows, _ = compare(spark, connect(SF), SF, QUERIES[name], ORACLE.get(name))
    assert problem is None and rows


def test_names():
    import __spark_entry__ as entry

    numbers = {int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()
