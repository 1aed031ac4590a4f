"""Whitening against a dense eigendecomposition; the solver against matrices of any kind."""

import random

import numpy as np
import pytest

from lendmill.llm import whitening as W
from lendmill.llm.queries import QUERIES


def dense(rows, scale=64, offset=1_000_000, k=16):
    """rows: (id, vector or None) -> deviations and whitened values by id, shares, n."""
    ok = lambda v: v is not None and all(c is not None and np.isfinite(c) for c in v)
    whole = [(i, tuple(int(np.floor(scale * c)) + offset for c in v)) for i, v in rows if ok(v)]
    distinct = sorted({v for _, v in whole})
    n, dim = len(distinct), len(distinct[0])
    sums = [sum(v[d] for v in distinct) for d in range(dim)]
    apart = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in distinct], float) / n
    values, vectors = np.linalg.eigh(apart.T @ apart / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    real = values > values.sum() * 1e-13
    values, vectors = values[real], vectors[:, real]
    trace = (apart**2).sum() / n
    out = []
    for i, v in whole:
        exact = [n * c - s for c, s in zip(v, sums, strict=True)]
        white = np.array(exact, float) / n @ vectors / np.sqrt(values)
        out.append((i, sum(e * e for e in exact), white))
    return out, values / trace, n


def check(got, rows):
    wanted, shares, n = dense(rows)
    by_id = {}
    for r in got:
        assert r["n"] == n and abs(r["identity_error"]) < 1e-10
        assert abs(r["explained"] / shares[r["component"] - 1] - 1) < 1e-10
        by_id.setdefault(r["vec_id"], []).append((r["component"], r["deviation"], r["whitened"]))
    k = len(shares)
    for i, deviation, white in wanted:
        mine = sorted(by_id[i])[: k * sum(1 for j, *_ in wanted if j == i)]
        assert {d for _, d, _ in mine} == {deviation}
        per = [[w for c, _, w in mine if c == j + 1] for j in range(k)]
        assert np.allclose(np.abs([p[0] for p in per]), np.abs(white), atol=1e-8)
    # one sign for all rows
    first = {r["component"]: r["whitened"] for r in got if r["vec_id"] == wanted[0][0]}
    sign = [np.sign(first[j + 1] * wanted[0][2][j]) for j in range(k)]
    for i, _, white in wanted:
        for c, _, w in by_id[i]:
            assert abs(w - sign[c - 1] * white[c - 1]) < 1e-8
    assert len(got) == k * len(wanted)


def query(spark, tmp_path, rows):
    schema = "vec_id long, embedding array<float>, x string, n string, whitened string"
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], schema)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op13_embedding_whitening"](spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return got.collect()


def vectors(n=300, dim=24, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) / np.sqrt(np.arange(1, dim + 1))
    return [(i, [float(c) for c in row.astype(np.float32)]) for i, row in enumerate(x)]


def test_query_equals_dense(spark, tmp_path):
    rows = vectors()
    rows += [(1000 + i, rows[5][1]) for i in range(150)]  # a third are one vector
    rows += [(2000, None), (2001, [float("nan")] * 24), (2002, [None] * 24), (2003, [float("inf")] * 24)]
    rows += [(2004, [0.0] * 24)]
    check(query(spark, tmp_path, rows), rows)


def test_fewer_dimensions_than_components_and_low_rank(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, [float(rng.randrange(-50, 50)), float(rng.randrange(-50, 50)), 0.0]) for i in range(60)]
    rows = [(i, [a, b, a]) for i, (a, b, _) in rows]
    got = query(spark, tmp_path, rows)
    assert {r["component"] for r in got} == {1, 2}
    check(got, rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    assert query(spark, tmp_path, rows) == []


def test_another_length_takes_no_part(spark, tmp_path):
    rows = vectors(40, 4)
    check(query(spark, tmp_path, [*rows, (99, [1.0]), (98, [1e300] * 4)]), rows)


def test_transform_keeps_columns(spark):
    df = spark.createDataFrame([(i, [i, i * i], "t", 1.5) for i in range(9)], "id int, x array<long>, tag string, in_0 double")
    out = W.fit(df, "x").transform(df, "x")
    assert out.columns == ["id", "x", "tag", "in_0", "whitened", "deviation"]
    assert {(r["tag"], r["in_0"], len(r["whitened"])) for r in out.collect()} == {("t", 1.5, 2)}


def test_deviation_beyond_64_bits():
    n, sums = 10**7, np.array([10**7 * 5 + 3])
    assert W._deviation(np.array([[5], [7]]), n, sums) == [9, (n * 7 - (5 * n + 3)) ** 2]
    assert W._deviation(np.array([[2**39]]), n, sums) == [None]


def spectra():
    rng = np.random.default_rng(7)
    yield "flat", rng.normal(size=(2000, 64))
    yield "falling", rng.normal(size=(2000, 150)) / np.sqrt(np.arange(1, 151))
    yield "low rank", rng.normal(size=(500, 10)) @ rng.normal(size=(10, 40))
    twins = np.repeat(rng.normal(size=(400, 1)), 1, axis=1)
    yield "one axis", np.hstack([twins, np.zeros((400, 30))])
    basis = np.linalg.qr(rng.normal(size=(120, 120)))[0]
    yield "equal pairs", (basis * np.sqrt(np.repeat(np.arange(60, 0, -1), 2))).T * np.sqrt(120)


@pytest.mark.parametrize("name, x", list(spectra()))
def test_solver(name, x):
    a = x.T @ x / len(x)
    calls = []
    values, vectors_ = W.jacobi_davidson(lambda b: calls.append(b.shape[1]) or a @ b, len(a), 16)
    true = np.linalg.eigvalsh(a)[::-1][: len(values)]
    assert np.allclose(values, true, atol=1e-13 * true[0])
    assert np.linalg.norm(a @ vectors_ - vectors_ * values, axis=0).max() < 1e-13 * true[0]
    assert np.abs(vectors_.T @ vectors_ - np.eye(len(values))).max() < 1e-13
    assert len(calls) < 150 and max(calls) <= 20


def test_minres_solves_each_column():
    rng = np.random.default_rng(8)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    shifts = np.array([0.3, -2.0, 5.0])
    b = rng.normal(size=(20, 3))
    x = W.minres(lambda t: a @ t - t * shifts, b, 60)
    for i in range(3):
        assert np.allclose(x[:, i], np.linalg.solve(a - shifts[i] * np.eye(20), b[:, i]), atol=1e-6)
