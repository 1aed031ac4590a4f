"""An index that is kept up: replaced and removed documents, merges, batches that died."""

import random

import pytest
from conftest import rows
from pyspark.sql import types as T

from lendmill.operators import retrieval as R
from lendmill.sources.search_index import FANOUT, KeptIndex

SHAPE = "id int, t string, tag string, gone boolean"
LIKE = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("tag", T.StringType())])


def kept(spark, tmp_path):
    return KeptIndex(spark, str(tmp_path / "i"), "id", LIKE, buckets=4)


def batch(spark, docs):
    return R.build_index(spark.createDataFrame(docs, SHAPE), "t", "id", ["tag"], "gone")


def parts(index, kind="postings"):
    return [e for e in index.entries() if e["kind"] == kind]


def same(spark, index, live):
    """Scores and documents are those of an index built at once."""
    fresh = batch(spark, [(i, *d, False) for i, d in live.items()] or [(0, "", "", True)])
    for query in ("a b", "c", "unknown"):
        assert rows(R.score_documents(index.read(), query)) == rows(R.score_documents(fresh, query))
    found = R.search(index.read(), "a b c", ["tag"], 5)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in R.search(fresh, "a b c", ["tag"], 5).collect()]


def test_batches_equal_one_index(spark, tmp_path):
    rng, index, live = random.Random(3), kept(spark, tmp_path), {}
    superseded = 0
    for number in range(1, 6):
        docs = {}
        for i in rng.sample(range(30), 8):
            gone = rng.random() < 0.25
            text = None if rng.random() < 0.1 else " ".join(rng.choices("abcd", k=rng.randrange(0, 9)))
            docs[i] = (i, text, f"{number}", gone)
            superseded += live.pop(i, None) is not None
            if not gone:
                live[i] = (text, f"{number}")
        index.add(batch(spark, list(docs.values())), number)
        if number == 3:
            index.add(batch(spark, [(99, "a a a", "x", False)]), number)  # made already
        if number == 5:
            same(spark, index, live)
    # parts of a size were merged, and what they superseded left the list with them
    assert len(parts(index)) < 5 and max(len(e["origins"]) for e in parts(index)) >= FANOUT
    dead = {(r["id"], r["_origin"]) for r in index._read("dead", index.entries()).collect()}
    listed = [e for e in parts(index, "dead") if "merge" in e["folder"]]
    assert len(dead) < superseded and len(listed) <= 1


def test_everything_removed(spark, tmp_path):
    index = kept(spark, tmp_path)
    assert rows(R.score_documents(index.read(), "a")) == []
    index.add(batch(spark, [(1, "a", "x", False), (2, "a b", "x", False)]), 1)
    index.add(batch(spark, [(1, None, "x", True), (2, None, "x", True), (3, "never there", "x", True)]), 2)
    assert rows(R.score_documents(index.read(), "a b")) == []
    index.add(batch(spark, [(2, "b", "y", False)]), 3)
    same(spark, index, {2: ("b", "y")})


@pytest.mark.parametrize("step", ["_store", "_publish", "rewrite"])
def test_a_batch_that_died_is_made_again(spark, tmp_path, monkeypatch, step):
    index = kept(spark, tmp_path)
    index.add(batch(spark, [(i, "a b", "x", False) for i in range(6)]), 1)
    docs = [(1, "b c", "y", False), (2, "a", "y", True), (7, "a", "y", False)]

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(type(index.live) if step == "rewrite" else KeptIndex, step, dies)
        with pytest.raises(RuntimeError, match="lost"):
            index.add(batch(spark, docs), 2)
    if step != "_publish":
        same(spark, kept(spark, tmp_path), {i: ("a b", "x") for i in range(6)})
    again = kept(spark, tmp_path)
    again.add(batch(spark, docs), 2)
    same(spark, again, {0: ("a b", "x"), 1: ("b c", "y"), 7: ("a", "y")} | {i: ("a b", "x") for i in (3, 4, 5)})


def test_a_search_reads_terms_and_few_documents(spark, tmp_path):
    index = kept(spark, tmp_path)
    index.add(batch(spark, [(i, f"w{i} all", "x", False) for i in range(50)]), 1)
    scores = R.score_documents(index.read(), "w7")
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [" in plan or "EqualTo(term," in plan or "term#" in plan and "= w7" in plan
    assert "/live/" not in plan and "tag" not in plan
    asked = []
    whole = index.live.read
    index.live.read = lambda only=None, before=None: asked.append(only) or whole(only, before)
    found = R.search(index.read(), "w7", ["tag"], 3).collect()
    assert [(r["id"], r["tag"]) for r in found] == [(7, "x")]
    assert [len(x) for x in asked if x is not None] == [1]


def test_words_of_a_batch_are_written_once(spark, tmp_path):
    """Documents and postings come from one pass; attributes may have any name."""
    like = T.StructType.fromDDL("id int, term string, tf long")
    index = KeptIndex(spark, str(tmp_path / "i"), "id", like, buckets=4)
    docs = [(1, "a b a", "x", 7, False), (2, "", None, 8, False), (3, None, "z", None, False), (4, "a", "x", 1, True)]
    found = spark.createDataFrame(docs, "id int, t string, term string, tf long, gone boolean")
    index.add(R.build_index(found, "t", "id", ["term", "tf"], "gone"), 1)
    with_words = {
        str(f.parent)
        for f in (tmp_path / "i").rglob("*.parquet")
        if {"term", "_words"} & set(spark.read.parquet(str(f)).columns) and "live" not in f.parts
    }
    assert len(with_words) == 1
    read = index.read()
    assert sorted(map(tuple, read.docs.select("id", "doc_len", "term", "tf").collect())) == [
        (1, 3, "x", 7), (2, 0, None, 8), (3, 0, "z", None),
    ]
    assert sorted(map(tuple, read.postings.select("id", "term", "tf", "doc_len").collect())) == [
        (1, "a", 2, 3), (1, "b", 1, 3),
    ]


def test_a_merge_leaves_dead_parts_unread(spark, tmp_path, monkeypatch):
    """Three parts that the fourth replaces whole are dropped; only the fourth is read."""
    index, reads = kept(spark, tmp_path), []
    whole = index._read

    def read(kind, entries):
        reads.append((kind, [e["folder"] for e in entries if e["kind"] == kind]))
        return whole(kind, entries)

    monkeypatch.setattr(index, "_read", read)
    for number in range(1, 5):
        reads.clear()
        index.add(batch(spark, [(i, "a b" if i else "", f"{number}", False) for i in range(6)]), number)
    assert [p["origins"] for p in parts(index)] == [[1, 2, 3, 4]] and not parts(index, "dead")
    read_parts = {f for kind, folders in reads if kind == "postings" for f in folders}
    assert read_parts == {"postings/batch=4", parts(index)[0]["folder"]}
    same(spark, index, {i: ("a b" if i else "", "4") for i in range(6)})


@pytest.mark.parametrize("few", [0, 500_000])
def test_a_merge_with_many_dead_sorts_no_postings_to_find_them(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr("lendmill.sources.search_index.FEW_DEAD", few)
    index, live = kept(spark, tmp_path), {}
    for number in range(1, 4):
        docs = {i: (" ".join("abc"[: 1 + i % 3]), f"{number}") for i in range(number, number + 6)}
        index.add(batch(spark, [(i, *d, False) for i, d in docs.items()]), number)
        live |= docs
    dead = index._read("dead", index.entries())
    left = index._without(dead, parts(index))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert ("BroadcastHashJoin" if few else "ShuffledHashJoin") in plan
    assert left.select("id").distinct().count() == len(live) == left.select("id", "_origin").distinct().count()
    more = {i: ("a b c a b c c c c a" if i == 20 else "a b c", "4") for i in range(20, 24)}
    index.add(batch(spark, [(i, *d, False) for i, d in more.items()] + [(1, "b", "4", True)]), 4)
    live |= more
    del live[1]
    assert len(parts(index)) == 1
    same(spark, index, live)
