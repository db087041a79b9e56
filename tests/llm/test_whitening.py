"""Contour integration against numpy's eigh, whitening against brute force."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from claimtide.llm import feast, whitening


def matrices():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 16, 17, 40):
        x = rng.standard_normal((200, d)) * np.linspace(1, 3, d)
        yield f"random {d}", x.T @ x / 200
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    yield "identity", np.eye(20)
    yield "clusters", np.diag([5.0] * 10 + [3.0] * 10 + [1.0] * 10)
    yield "rank 3", q[:, :3] @ np.diag([9.0, 2.0, 1.0]) @ q[:, :3].T
    yield "falling", q @ np.diag(10.0 ** -np.arange(30)) @ q.T
    yield "near", q @ np.diag(np.r_[1 + 1e-9 * np.arange(15), np.zeros(15)]) @ q.T
    yield "tiny", 1e-200 * (x.T @ x)


@pytest.mark.parametrize("name, a", list(matrices()), ids=lambda v: v if isinstance(v, str) else "")
def test_largest_equals_eigh(name, a):
    values, vectors = feast.largest(a, 16)
    want = np.linalg.eigh((a + a.T) / 2)[0][::-1][:16]
    scale = np.abs(a).max()
    assert np.abs(values - want).max() <= 1e-13 * scale
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() <= 1e-13


@pytest.mark.parametrize("name, a", list(matrices()), ids=lambda v: v if isinstance(v, str) else "")
def test_inertia_counts_and_slices(name, a):
    scale = np.abs(a).max()
    form = feast.tridiagonal(a / scale)
    every = np.linalg.eigvalsh(a / scale)
    for shift in (-1.0, 1e-7, 0.3, 0.61, 2.0, 30.0):
        assert feast.count_above(form, shift) == (every > shift).sum()
    for low, high, count in feast.slices(form, 16):
        assert count == ((every > low) & (every <= high)).sum()


def brute(rows, components):
    """(id, n, deviation, whitened values) and the covariance, by plain numpy."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = Counter(len(x) for _, x in kept)
    d = max(lengths, key=lambda n: (lengths[n], n))
    kept = [(i, x) for i, x in kept if len(x) == d]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in kept:
        apart = [n * c - s for c, s in zip(x, sums, strict=True)]
        out.append((i, n, sum(c * c for c in apart), np.array(apart) / n @ vectors / np.sqrt(values)))
    return out, values / np.trace(covariance)


def check(spark, rows, components, kind="array<float>"):
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], f"vec_id long, embedding {kind}, x int, id string").repartition(5)
    got = whitening.whiten(df, components=components).collect()
    want, explained = brute(rows, components)
    k = len(explained)
    by_row = {}
    for r in got:
        assert r.identity_error <= 1e-10 and abs(r.explained - explained[r.component - 1]) <= 1e-10
        by_row.setdefault((r.vec_id, r.n, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    for key, times in Counter(w[:3] for w in want).items():
        assert sorted(by_row[key]) == list(range(1, k + 1)) and all(len(v) == times for v in by_row[key].values())
    assert len(got) == k * len(want)
    values = np.array([[by_row[w[:3]][c][0] for c in range(1, k + 1)] for w in want])
    plain = np.array([w[3] for w in want])
    sign = np.sign((values * plain).sum(0))
    assert np.abs(values - plain * sign).max() <= 1e-8


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((120, 20)) @ np.diag(np.linspace(3, 0.2, 20))
    rows = [(i % 100, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    copies = rows[:1] * 30 + [(500 + k, rows[1][1]) for k in range(60)]
    odd = [(900, None), (901, []), (902, [None] * 20), (903, [float("nan")] * 20), (904, [float("inf"), *[0.0] * 19]), (905, [1.0] * 19), (None, rows[2][1])]
    check(spark, rows + copies + odd, 16)


def test_few_dimensions_and_a_large_mean(spark):
    rng = np.random.default_rng(6)
    check(spark, [(i, [1e9 + float(a), float(b)]) for i, (a, b) in enumerate(rng.integers(-50, 50, (80, 2)) / 64)], 16, "array<double>")


def test_no_variance_no_rows_and_great_deviations(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [0.5, 0.5])] * 3):
        df = whitening.whiten(spark.createDataFrame(rows, schema))
        assert df.collect() == [] and df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = whitening.whiten(spark.createDataFrame([(1, [1e9]), (2, [-1e9]), (3, [1.0])], schema)).collect()
    assert {r.vec_id: r.deviation for r in got} == {1: None, 2: None, 3: (3 * 64 - 64) ** 2}
    got = whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [1.0]), (3, [2.0])], schema)).collect()
    assert {r.vec_id for r in got} == {2, 3}
