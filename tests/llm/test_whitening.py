import random

import numpy as np
import pytest

from hearthline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, id int, x int"


def exact(rows, components=32):
    """Plain covariance in exact whole numbers and the library's eigenvectors: what whitening must return, up to sign."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in kept], object)
    n, sums = len(x), x.sum(0)
    z = n * x - sums
    cov = (z.T @ z / n**3).astype(float)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return [i for i, _ in kept], n, (z * z).sum(1), (z / n).astype(float) @ u / np.sqrt(e), e / np.trace(cov)


def compare(got, rows, components=32):
    ids, n, deviation, white, share = exact(rows, components)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
        assert r.n == n and r.identity_error < 1e-9
    assert sorted(by) == sorted(set(ids)) and sum(map(len, by.values())) == len(ids) * white.shape[1]
    mine = np.array([[r.whitened for r in sorted(by[i], key=lambda r: r.component)] for i in ids])
    signs = np.sign((mine * white).sum(0))
    assert np.abs(mine * signs - white).max() < 1e-6
    assert all(r.deviation == d and abs(r.explained - share[r.component - 1]) < 1e-9 for i, d in zip(ids, deviation) for r in by[i])


def test_equals_exact_covariance(spark):
    rng = np.random.default_rng(5)
    mix = rng.standard_normal((40, 40)) * np.linspace(3, 0.3, 40)
    rows = [(k, (rng.standard_normal(40) @ mix + 7).tolist()) for k in range(500)]
    rows += [(900 + k, rows[0][1]) for k in range(200)]  # a vector that fills a third of the rows
    odd = [(1000, None), (1001, [None] + [1.0] * 39), (1002, [float("nan")] * 40), (1003, [float("inf")] * 40), (1004, []), (1005, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, "theirs", 1, 2) for i, v in rows + odd], SCHEMA)
    once = whitening.whiten(table.repartition(5)).collect()
    compare(once, rows)
    again = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(table.coalesce(1)).collect()}
    assert all(again[r.vec_id, r.component] == pytest.approx(r.whitened, abs=1e-9) for r in once)


def test_driver_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    compare(whitening.query(spark, "/root/testdata/sf0.01").collect(), [(r.vec_id, r.embedding) for r in table.collect()])


def test_few_rows_and_few_directions(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).count() == 0
    assert whitening.whiten(empty).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    alike = spark.createDataFrame([(k, [1.0, 2.0], "", 0, 0) for k in range(5)], SCHEMA)
    assert whitening.whiten(alike).count() == 0
    line = spark.createDataFrame([(k % 3, [k / 4, k / 2, 5.0], "", 0, 0) for k in range(8)] + [(None, [9.0, 18.0, 5.0], "", 0, 0)], SCHEMA)
    got = whitening.whiten(line).collect()
    assert len(got) == 9 and {r.component for r in got} == {1} and got[0].explained == pytest.approx(1) and got[0].identity_error < 1e-9
    assert sum(r.vec_id is None for r in got) == 1


def test_inertia_counts_and_close_values():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    values = np.sort(np.r_[[5.0] * 4, 5 + 1e-9, 5 + 1e-13, np.linspace(0.1, 4, 20), [1e-6] * 2, [0.0] * 2])[::-1]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    for shift in (6, 5.0000001, 4.9, 2.03, 0.05, -1):
        assert whitening.eigenvalues_above(a, shift) == (values > shift).sum()
    e, u = whitening.leading_eigenpairs(a, 27)
    assert np.abs(e - values[:27]).max() < 1e-12 and np.abs(u.T @ u - np.eye(27)).max() < 1e-9
    assert np.abs(a @ u - u * e).max() < 1e-12
    assert len(whitening.leading_eigenpairs(a, 40)[0]) == 28  # the directions without variance are none


def test_large_numbers_stay_exact(spark):
    rows = [(k, [random.Random(k).uniform(-1e9, 1e9), 1.0 * k]) for k in range(40)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    table = spark.createDataFrame([(i, v, "", 0, 0) for i, v in rows], SCHEMA)
    model = whitening.fit(table, "embedding")
    assert model.sums == [sum(int(np.floor(64 * v[d])) + 1_000_000 for _, v in rows) for d in range(2)]
    got = {r.vec_id: r.deviation for r in whitening.transform(table.select("vec_id", "embedding"), "embedding", model).collect()}
    for i, v in rows:
        want = sum((40 * (int(np.floor(64 * v[d])) + 1_000_000) - model.sums[d]) ** 2 for d in range(2))
        assert got[i] == (want if want < 2**63 else None)
