"""Kendall's tau, its p-value and rank correlations of sparse tables against all pairs."""

import math

import numpy as np
import pytest

from sparkloom.operators import association as A
from sparkloom.operators import factor as N


def tau(x, y):
    """tau-b and its normal p-value with ties, from all pairs."""
    sx, sy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
    n, s = len(x), (sx * sy).sum() / 2
    tx, ty = (np.unique(v, return_counts=True)[1].astype(float) for v in (x, y))
    some = math.sqrt(abs(sx).sum() / 2 * (abs(sy).sum() / 2))
    if not some:
        return None, None
    v = lambda t: (t * (t - 1) * (2 * t + 5)).sum()
    var = (n * (n - 1) * (2 * n + 5) - v(tx) - v(ty)) / 18 + (tx * (tx - 1)).sum() * (ty * (ty - 1)).sum() / (2 * n * (n - 1))
    if n > 2:
        var += (tx * (tx - 1) * (tx - 2)).sum() * (ty * (ty - 1) * (ty - 2)).sum() / (9 * n * (n - 1) * (n - 2))
    return s / some, math.erfc(abs(s) / math.sqrt(var) / math.sqrt(2))


@pytest.mark.parametrize("levels", [1, 2, 7, 1000])
def test_sums_of_orders_equal_all_pairs(levels):
    rng = np.random.default_rng(levels)
    for n in (0, 1, 2, 3, 17, 120):
        x, y, w = rng.integers(0, levels, n).astype(float), rng.integers(0, levels, n).astype(float), rng.integers(1, 5, n)
        want = (np.sign(x[:, None] - x) * np.sign(y[:, None] - y) * w[:, None] * w).sum() / 2
        assert A.order_sum(x, y, w) == pytest.approx(want)


def test_kendall_of_any_levels(spark):
    rng = np.random.default_rng(3)
    n = 150
    sides = {
        "continuous": (rng.normal(size=n), rng.normal(size=n)),
        "follows": (z := rng.normal(size=n), z + rng.normal(size=n) / 3),
        "mostly zero": (rng.normal(size=n) * (rng.random(n) < 0.3), rng.normal(size=n)),
        "both zero": (rng.poisson(0.4, n).astype(float), rng.poisson(0.4, n) * rng.random(n)),
        "few": (rng.integers(0, 3, n).astype(float), rng.integers(0, 4, n).astype(float)),
        "constant": (np.ones(n), rng.normal(size=n)),
        "two": (np.array([1.0, 2.0]), np.array([5.0, 4.0])),
    }
    rows = [(k, float(a), float(b)) for k, (x, y) in sides.items() for a, b in zip(x, y, strict=True)]
    rows += [("few", None, 1.0), ("few", 1.0, float("nan")), ("none", None, None)]
    got = {r.k: (r.stat, r.pval) for r in A.kendall(spark.createDataFrame(rows, "k string, x double, y double"), "x", "y", ("k",)).collect()}
    assert got.keys() == sides.keys()
    for k, (x, y) in sides.items():
        want = tau(x, y)
        assert got[k] == want if want[0] is None else np.allclose(got[k], want, atol=1e-9), k


def test_rank_correlations_of_motifs(spark):
    rng = np.random.default_rng(6)
    genes = spark.createDataFrame([(g,) for g in range(40)], "gene_id int")
    x = {p: rng.normal(size=40) * (rng.random(40) < 0.5) for p in "ab"}
    y = {m: rng.poisson(0.6, 40).astype(float) for m in "uv"}
    loading = spark.createDataFrame([(p, g, float(v[g])) for p, v in x.items() for g in range(40) if v[g] or g % 3 == 0], "program string, gene_id int, score double")
    counts = spark.createDataFrame([(g, m, int(v[g])) for m, v in y.items() for g in range(40) if v[g]], "gene_id int, motif string, n long")
    ranks = lambda v: np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])
    for name, f in (("pearson", lambda a, b: np.corrcoef(a, b)[0, 1]), ("spearman", lambda a, b: np.corrcoef(ranks(a), ranks(b))[0, 1]), ("kendall", lambda a, b: tau(a, b)[0])):
        got = {(r.program, r.motif): r for r in N.motif_enrichment(loading, counts, genes, correlation=name).collect()}
        assert len(got) == 4 and all(r.adj_pval >= r.pval - 1e-12 for r in got.values())
        for (p, m), r in got.items():
            assert r.stat == pytest.approx(f(x[p], y[m]), abs=1e-9)
    with pytest.raises(ValueError):
        N.motif_enrichment(loading, counts, genes, correlation="other")
