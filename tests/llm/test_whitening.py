from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabletally.llm import whitening

SF = "/root/testdata/sf0.001"
DDL = "component string, vec_id long, embedding array<float>, n int, whitened string"


def kept(rows):
    return [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def integers(rows):
    good = kept(rows)
    dims = max((len(v) for _, v in good), default=0)
    return [
        (i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] + [100_000] * (dims - len(v))) for i, v in good
    ]


def check(got, rows, k=8):
    """The returned rows against plain integer sums and NumPy's eigenvalues."""
    x = integers(rows)
    n, dims = len(x), len(x[0][1]) if x else 0
    sums = [sum(v[d] for _, v in x) for d in range(dims)]
    expected = sorted((i, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))) for i, v in x)
    count = min(k, dims)
    assert len(got) == n * count
    for component in range(1, count + 1):
        mine = [r for r in got if r.component == component]
        assert sorted((r.vec_id, r.deviation) for r in mine) == expected
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)] for _, v in x])
    values = np.linalg.eigvalsh(centred.T @ centred / n)[::-1]
    for r in got:
        assert r.n == n
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-6, abs=1e-12)
        assert 0 <= r.identity_error < 1e-6
    # whitened vectors: unit covariance, and the same lengths as by NumPy's own components
    table = {}
    for r in got:
        table.setdefault((r.vec_id, r.component), []).append(r.whitened)
    ids = [i for i, _ in x]
    if len(set(ids)) == len(ids):
        w = np.array([[table[i, c][0] for c in range(1, count + 1)] for i in ids])
        assert np.abs(w.T @ w / n - np.eye(count)).max() < 1e-6
        vectors = np.linalg.eigh(centred.T @ centred / n)[1][:, ::-1][:, :count]
        assert np.allclose(np.abs(centred @ vectors / np.sqrt(values[:count])), np.abs(w), rtol=1e-5, atol=1e-6)


def run(spark, rows, **options):
    df = spark.createDataFrame([("x", i, v, 3, "y") for i, v in rows], DDL).repartition(3)
    return whitening.whiten(df, **options).collect()


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    df = whitening.op12_whitening(spark, SF)
    assert dict(df.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    check(df.collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).astype("f4").tolist()) for i in range(40)]
    rows += [(100, None), (101, [1.0, None]), (102, [float("nan")] * 5), (103, [float("-inf")] * 5), (104, []), (105, [2.5])]
    check(run(spark, rows), rows)
    check(run(spark, rows + rows[:3], k=2), rows + rows[:3], k=2)  # repeated rows
    nulls = run(spark, [*rows, (None, [0.0] * 5)])
    assert sum(r.vec_id is None for r in nulls) == 5


def test_tables_without_variance(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []
    assert run(spark, [(1, []), (2, [])]) == []
    for rows in ([(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        got = run(spark, rows)
        assert len(got) == 2 * len(rows)
        assert {(r.whitened, r.deviation, r.identity_error, r.explained) for r in got} == {(None, 0, 0.0, 0.0)}


def test_numbers_beyond_a_long(spark):
    rows = [(i, [1e15 * (i - 2), float(i)]) for i in range(5)]
    x = integers(rows)
    got = {(r.vec_id, r.component): r for r in run(spark, rows)}
    sums = [sum(v[d] for _, v in x) for d in range(2)]
    for i, v in x:
        exact = sum((5 * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        assert got[i, 1].deviation == (exact if len(str(exact)) <= 38 else None)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 200), st.integers(1, 6), st.sampled_from([1, 7, 1000, 1 << 20, 1 << 33, 1 << 60]), st.integers(0, 99))
def test_cross_products_are_exact(n, dims, most, seed):
    values = np.random.default_rng(seed).integers(-most, most + 1, (n, dims))
    exact = values.astype(object)
    assert (whitening.cross_products(values) == exact.T @ exact).all()
    total = {}
    for i in range(dims):
        for _, a, b, at, v in whitening.limbs(i, i, dims, int((exact.T @ exact)[i, i])):
            total[a, b] = total.get((a, b), 0) + (v << 32 * at)
    assert all(total.get((i, i), 0) == (exact.T @ exact)[i, i] for i in range(dims))
