"""Polygamma functions, local regression and moderated tests against closed forms and dense computations."""

import math

import numpy as np
import pytest

from sparkloom.functions.special import polygamma, t_two_sided, trigamma_inverse
from sparkloom.operators import calibration as C
from sparkloom.operators import moderation as M


def test_polygamma_values():
    euler, zeta3 = 0.5772156649015329, 1.2020569031595943
    assert polygamma(0, 1.0) == pytest.approx(-euler, abs=1e-14) and polygamma(0, 0.5) == pytest.approx(-euler - 2 * math.log(2), abs=1e-13)
    assert polygamma(1, 1.0) == pytest.approx(math.pi**2 / 6, abs=1e-14) and polygamma(1, 0.5) == pytest.approx(math.pi**2 / 2, abs=1e-13)
    assert polygamma(2, 1.0) == pytest.approx(-2 * zeta3, abs=1e-13) and polygamma(2, 0.5) == pytest.approx(-14 * zeta3, abs=1e-11)
    x = np.array([1e-3, 0.3, 2.5, 14.9, 15.1, 400.0])
    for order, step in ((0, 1 / x), (1, -1 / x**2), (2, 2 / x**3)):
        assert np.allclose(polygamma(order, x + 1) - polygamma(order, x), step, rtol=1e-9, atol=1e-13)


@pytest.mark.parametrize("x", [1e-4, 0.2, 1.0, 7.3, 55.0, 1e6])
def test_inverse_of_trigamma(x):
    assert trigamma_inverse(float(polygamma(1, x))) == pytest.approx(x, rel=1e-9)
    assert trigamma_inverse(0.0) == trigamma_inverse(-1.0) == math.inf


def dense_trend(x, y, span):
    """The local regression in one place: points, solved values and the trace of the smoother."""
    q = np.quantile(x, np.linspace(0, 1, M.QUANTILES))
    at = np.unique(q[:: (M.QUANTILES - 1) // (M.POINTS - 1)])
    ahead = math.ceil(span * (M.QUANTILES - 1))
    rows = []
    for g in at:
        reach = min(max(g - q[i], q[i + ahead] - g) for i in range(M.QUANTILES - ahead)) * (1 + 1e-6)
        w = np.maximum(0, 1 - np.abs((x - g) / reach) ** 3) ** 3
        d = np.c_[np.ones(len(x)), x - g] * w[:, None]
        rows.append((np.linalg.solve(d.T @ np.c_[np.ones(len(x)), x - g], d.T))[0])
    smooth = np.array(rows)
    trace = sum(np.interp(x[i], at, smooth[:, i]) for i in range(len(x)))
    return at, smooth @ y, trace


def test_local_regression_against_dense_weights(spark):
    rng = np.random.default_rng(1)
    x = rng.gamma(2, 2, 150)
    y = np.sin(x) + rng.normal(size=150) / 5
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y, strict=True)] + [(None, 1.0), (1.0, float("nan"))], "x double, y double").repartition(4)
    got, (at, values, trace) = M.local_trend(df, 0.4), dense_trend(x, y, 0.4)
    assert np.allclose(got.x, at) and np.allclose(got.y, values, atol=1e-9) and got.freedom == pytest.approx(trace, rel=1e-9)
    line = spark.createDataFrame([(float(a), 2.0 - 3 * float(a)) for a in x], "x double, y double")
    assert np.allclose(M.local_trend(line).y, 2 - 3 * M.local_trend(line).x, atol=1e-9)
    same = M.local_trend(spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "x double, y double"))
    assert same(np.array([0.0, 9.0])).tolist() == [3.0, 3.0] and same.freedom == 1
    assert M.local_trend(line.limit(0)).y.tolist() == [0.0]


def variances(seed, n, df, d0, s0):
    rng = np.random.default_rng(seed)
    true = s0 * d0 / rng.chisquare(d0, n) if math.isfinite(d0) else np.broadcast_to(s0, n)
    return true * rng.chisquare(df, n) / df


@pytest.mark.parametrize("d0", [1.0, 2.0, 4.0, 10.0])
def test_freedom_and_variance_of_the_prior(spark, d0):
    s2 = variances(3, 20_000, 20, d0, 0.7)
    found = M.variance_prior(spark.createDataFrame([(float(v), 20.0, 0.0) for v in s2], "s2 double, df double, x double"), trend=False)
    e = np.log(s2) - polygamma(0, 10.0) + math.log(10)
    want = 2 * trigamma_inverse(e.var(ddof=1) - float(polygamma(1, 10.0)))
    assert found.df == pytest.approx(want, rel=1e-9) and found.df == pytest.approx(d0, rel=0.06)
    assert math.exp(found.location.y[0]) == pytest.approx(math.exp(e.mean() + float(polygamma(0, want / 2)) - math.log(want / 2)), rel=1e-9)
    assert math.exp(found.location.y[0]) == pytest.approx(0.7, rel=0.06)


def test_prior_that_follows_a_trend(spark):
    x = np.linspace(0, 4, 6000)
    s2 = variances(4, 6000, 12, 6.0, np.exp(1 - x))
    rows = spark.createDataFrame([(float(v), 12.0, float(a)) for v, a in zip(s2, x, strict=True)], "s2 double, df double, x double")
    found = M.variance_prior(rows)
    assert found.df == pytest.approx(6.0, rel=0.15) and np.abs(found.location(np.array([0.5, 2.0, 3.5])) - (1 - np.array([0.5, 2.0, 3.5]))).max() < 0.1
    assert M.variance_prior(rows, trend=False).df < 2
    chance = spark.createDataFrame([(float(v), 12.0, 0.0) for v in np.exp(np.random.default_rng(1).normal(size=500) / 100)], "s2 double, df double, x double")
    assert M.variance_prior(chance, trend=False).df == math.inf
    assert M.variance_prior(chance.limit(0)).df == math.inf


def screen(spark, n=50, m=60):
    rng = np.random.default_rng(21)
    side = (np.arange(n) % 2).astype(int)
    counts = rng.negative_binomial(2, 0.2, (n, m)) * rng.integers(1, 6, m)
    expr = spark.createDataFrame([(i, g, float(counts[i, g])) for i in range(n) for g in range(m) if counts[i, g]], "cell_id long, gene_id long, count double")
    return side, counts, expr, spark.createDataFrame([(i, int(side[i])) for i in range(n)], "cell_id long, treated int")


@pytest.mark.parametrize("trend", [False, True])
def test_moderated_tests_equal_closed_forms(spark, trend):
    side, counts, expr, cells = screen(spark)
    got = {r.gene_id: r for r in C.gene_tests(expr, cells, trend=trend).collect()}
    v = np.log2((counts + 0.5) / (counts.sum(1, keepdims=True) + 1) * 1e6)
    means = np.stack([v[side == t].mean(0) for t in (0, 1)])
    df = len(side) - 2
    s2 = sum(((v[side == t] - means[t]) ** 2).sum(0) for t in (0, 1)) / df
    e = np.log(s2) - float(polygamma(0, df / 2)) + math.log(df / 2)
    if trend:
        at, y, used = dense_trend(v.mean(0), e, 0.5)
        fit = np.interp(v.mean(0), at, y)
    else:
        fit, used = np.full(len(e), e.mean()), 1
    spread = ((e - fit) ** 2).sum() / (len(e) - used) - float(polygamma(1, df / 2))
    d0 = 2 * trigamma_inverse(spread)
    s0 = np.exp(fit + (float(polygamma(0, d0 / 2)) - math.log(d0 / 2) if math.isfinite(d0) else 0))
    post = s0 if math.isinf(d0) else (d0 * s0 + df * s2) / (d0 + df)
    t = (means[1] - means[0]) / np.sqrt(post * (1 / (side == 0).sum() + 1 / side.sum()))
    for g, r in got.items():
        assert r.prior_df == pytest.approx(d0, rel=1e-6) and r.prior_s2 == pytest.approx(s0[g], rel=1e-6)
        assert r.moderated_t == pytest.approx(t[g], rel=1e-6)
        assert r.moderated_pval == pytest.approx(t_two_sided(t[g], min(df + d0, df * len(got))), rel=1e-5)


def test_weights_are_the_same_in_blocks_of_library_sizes(spark, monkeypatch):
    _, _, expr, cells = screen(spark)
    run = lambda: {r.gene_id: (r.beta, r.t) for r in C.gene_tests(expr, cells, weighted=True, moderated=False).collect()}
    whole = run()
    monkeypatch.setattr(C, "SIZES", 4)
    again = run()
    assert all(np.allclose(whole[g], again[g]) for g in whole) and len(again) == len(whole) == 60


def test_moderated_tests_of_empty_tables(spark):
    _, _, expr, cells = screen(spark)
    assert C.gene_tests(expr.limit(0), cells).count() == 0
    assert C.gene_tests(expr.limit(0), cells, weighted=True).count() == 0


def test_counts_are_read_once(spark):
    _, _, expr, cells = screen(spark)
    want = {r.gene_id: (r.beta, r.t) for r in C.gene_tests(expr, cells).collect()}
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = expr.count()
    got = {r.gene_id: (r.beta, r.t) for r in C.gene_tests(expr.mapInPandas(counted, expr.schema), cells).collect()}
    assert got.keys() == want.keys() and all(got[g] == pytest.approx(want[g], rel=1e-9) for g in want)
    assert read.value == rows
