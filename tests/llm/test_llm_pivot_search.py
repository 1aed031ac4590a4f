"""Exact search against all pairs in plain Python; what the bounds eliminate."""

import random

import numpy as np
from pyspark.sql import functions as F

from lendmill.llm import pivot_search as P
from lendmill.llm.queries import QUERIES


def plain(rows, k=5, asks=lambda i: i % 50 == 0):
    """rows: (id, vector or None); every asking row against every other row."""
    ok = lambda v: v is not None and all(c is not None and np.isfinite(c) for c in v)
    whole = [(i, [int(np.floor(256.0 * c)) for c in v]) for i, v in rows if i is not None and ok(v)]
    out = []
    for n, (i, q) in enumerate(whole):
        if asks(i):
            scores = [(-sum(a * b for a, b in zip(q, x, strict=True)), j) for m, (j, x) in enumerate(whole) if m != n]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def awkward(n=400, dim=12, clusters=0):
    rng = random.Random(5)
    heart = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(max(clusters, 1))]
    spread = 0.05 if clusters else 1.0
    made = lambda: [c * bool(clusters) + rng.gauss(0, spread) for c in rng.choice(heart)]
    return [(i, made()) for i in range(n)]


def searched(spark, rows, schema="vec_id long, embedding array<double>", **settings):
    df = spark.createDataFrame(rows, schema)
    found = P.top_inner_products(df, F.col("vec_id") % 50 == 0, **settings)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


def test_query_equals_all_pairs(spark, tmp_path):
    rng = random.Random(1)
    hot = [0.5] * 8
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, hot) for i in range(150)]  # a third are one vector
    rows += [(50, rows[50][1])] * 3 + [(2000, [0.0] * 8), (2050, None), (2100, [float("nan")] * 8)]
    rows += [(2150, [None] * 8), (2200, [float("inf")] * 8), (None, hot), (2250, [-0.001] * 8)]
    schema = "vec_id long, embedding array<float>, score string, tag string, block string"
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], schema)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op12_exact_topk_search"](spark, str(tmp_path))
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    single = [(i, v if v is None else [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == plain(single)


def test_many_small_blocks_and_rounds(spark):
    for clusters in (0, 8):
        rows = awkward(clusters=clusters)
        small = {"pivots": 9, "block_rows": 20, "query_rows": 3}
        assert searched(spark, rows, **small) == plain(rows)


def test_few_rows(spark):
    assert searched(spark, []) == []
    assert searched(spark, [(50, [1.0, 2.0])]) == []
    few = [(50, [1.0, 2.0]), (1, [0.0, 0.0]), (100, [-1.0, 3.0])]
    assert searched(spark, few) == plain(few)
    assert searched(spark, [(50, []), (1, [])]) == [(50, 1, 1, 0)]
    # a vector of another length than most, and one beyond 64 bits, take no part
    odd = [*few, (3, [1.0]), (4, [1e30, 1.0]), (150, [1e300, 1.0])]
    assert searched(spark, odd) == plain(few)


def block(x, pivots, first=0):
    x = np.array(x, np.int64)
    one = {"tag": np.arange(first, first + len(x)).astype(np.int64).tobytes()}
    far = P._distances(x, pivots)
    return P.Block(one | {"id": one["tag"], "x": x.astype(np.int32).tobytes(), "far": far.tobytes()})


def test_bounds_hold_and_eliminate():
    rng = np.random.default_rng(2)
    hearts = rng.normal(0, 300, (20, 16))
    x = np.floor(hearts[rng.integers(0, 20, 3000)] + rng.normal(0, 5, (3000, 16))).astype(np.int64)
    pivots = P.choose_pivots(x[:500].astype(float), 32)
    assert len(pivots) == 32 and not pivots[0].any()
    q, v = block(x[:40], pivots), block(x, pivots)
    scores = x[:40] @ x.T
    assert (P.bounds(q, slice(0, 40), v) >= scores).all()
    found, evaluated = P.best_of(q, v, {}, 5)
    assert evaluated < 0.35 * 40 * 3000  # of the scores that all pairs would take
    for i in range(40):
        others = sorted((-s, j) for j, s in enumerate(scores[i]) if j != i)[:5]
        assert [(-s, p) for n, p, s in found if n == i] == others


def test_bounds_hold_for_large_numbers():
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**28), 2**28, (300, 4))
    x[:100] = x[0] + rng.integers(-3, 3, (100, 4))
    pivots = P.choose_pivots(x.astype(float), 8)
    v = block(x, pivots)
    exact = [[sum(int(a) * int(b) for a, b in zip(p, r, strict=True)) for r in x] for p in x[:50]]
    q = block(x[:50], pivots)
    assert (P.bounds(q, slice(0, 50), v) >= np.array(exact, float)).all()
    found, _ = P.best_of(q, v, {}, 5)
    for i in range(50):
        others = sorted((-s, j) for j, s in enumerate(exact[i]) if j != i)[:5]
        assert [(-s, p) for n, p, s in found if n == i] == others
