"""Effects with errors from shared draws against a dense computation in one place."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import calibration as C
from sparkloom.operators import propagation as G
from sparkloom.operators import similarity as S


def dense_effects(y, w, z, m, t, often):
    """Coefficient of t under weights m * often, and the mean growth of each gene's log expression."""
    x = np.c_[np.ones(len(t)), t, z]
    root = np.sqrt(m * often)
    beta = np.linalg.lstsq(x * root[:, None], y * root[:, None], rcond=None)[0][1]
    q = np.exp(y)
    grown = np.log((q * np.exp(beta)) @ w) - np.log(q @ w)
    return beta, (often[:, None] * grown).sum(0) / often.sum()


@pytest.fixture(scope="module")
def screen(spark):
    rng = np.random.default_rng(8)
    n, k, genes = 90, 3, 5
    p = rng.random((n, k)) * rng.integers(0, 2, (n, k)) / 1e3
    w = rng.random((k, genes))
    w[:, 2] = 0
    w[1, 3] = 0
    cells = [(c, f"t{c % 2}", int(rng.random() < 0.4), float(rng.random() + 0.5), float(rng.normal())) for c in range(n)]
    scores = spark.createDataFrame([(i, f"p{j}", float(p[i, j])) for i in range(n) for j in range(k) if p[i, j] or j == 0], "cell_id long, program string, score double")
    loading = spark.createDataFrame([(f"p{j}", f"g{g}", float(w[j, g])) for j in range(k) for g in range(genes)], "program string, gene_id string, score double")
    return p, w, cells, scores, loading, spark.createDataFrame(cells, "cell_id long, target string, treated int, weight double, x double")


@pytest.mark.parametrize("method,bucket,genes", [("log", 4096, 512), ("pseudo", 16, 2)])
def test_against_dense_draws(spark, screen, monkeypatch, method, bucket, genes):
    monkeypatch.setattr(G, "BUCKET", bucket)
    monkeypatch.setattr(G, "GENES", genes)
    p, w, cells, scores, loading, df = screen
    programs, of_genes = G.effects_with_errors(scores, loading, df, ["target"], ["x"], method, permutations=4, bootstraps=6)
    programs = {(r.target, r.program): r for r in programs.collect()}
    of_genes = {(r.target, r.gene_id): r for r in of_genes.collect()}
    assert len(programs) == 6 and len(of_genes) == 2 * 4 and ("t0", "g2") not in of_genes
    off = np.array([np.quantile(1e6 * c[c > 0], 0.05) for c in p.T]) if method == "pseudo" else np.ones(3)
    perm = {(r.target, r.cell_id): r.on for r in C.permuted_labels(df, 4, 42, ["target"]).collect()}
    boot = {(r.target, r.cell_id): np.add(r.on, r.off) for r in C.bootstrap_labels(df, 6, 42, ["target"]).collect()}
    for target in ("t0", "t1"):
        own = [c for c in cells if c[1] == target]
        ids = [c[0] for c in own]
        y, t, m, x = np.log(1e6 * p[ids] + off), *(np.array([c[i] for c in own], float) for i in (2, 3, 4))
        labels, counts = np.array([perm[target, i] for i in ids]), np.array([boot[target, i] for i in ids])
        assert (labels.sum(0) == t.sum()).all()
        run = lambda t, often: dense_effects(y, w[:, [0, 1, 3, 4]], x, m, t, often)
        beta, effect = run(t, np.ones(len(t)))
        perms = [run(labels[:, i], np.ones(len(t))) for i in range(4)]
        boots = [run(t, counts[:, i]) for i in range(6)]
        for j in range(3):
            r = programs[target, f"p{j}"]
            want = (beta[j], np.mean([q[0][j] for q in perms]), np.std([q[0][j] for q in boots], ddof=1))
            assert np.allclose((r.beta, r.bias, r.se), want, atol=1e-9) and abs(r.stat - r.beta / r.se) < 1e-9
        for j, g in enumerate(("g0", "g1", "g3", "g4")):
            r = of_genes[target, g]
            bias, se = np.mean([q[1][j] for q in perms]), np.std([q[1][j] for q in boots], ddof=1)
            assert np.allclose((r.effect, r.bias, r.corrected, r.se), (effect[j], bias, effect[j] - bias, se), atol=1e-9)
            assert abs(r.stat - r.corrected / r.se) < 1e-6


def test_loadings_in_several_passes_agree(spark, screen, monkeypatch):
    _, _, _, scores, loading, df = screen
    run = lambda: {r.gene_id: (r.effect, r.se) for r in G.effects_with_errors(scores, loading, df, permutations=1, bootstraps=3)[1].collect()}
    once = run()
    monkeypatch.setattr(S, "DENSE_ENTRIES", 10)
    again = run()
    assert len(again) == 4 and all(np.allclose(once[g], again[g]) for g in once)


def test_degenerate_labels_and_tables(spark, screen):
    _, _, _, scores, loading, df = screen
    alike = df.withColumn("treated", F.lit(1))
    programs, genes = G.effects_with_errors(scores, loading, alike, permutations=2, bootstraps=2)
    assert all(r.beta is None and r.pval is None for r in programs.collect()) and all(r.effect is None for r in genes.collect())
    programs, genes = G.effects_with_errors(scores, loading, df.limit(0), ["target"], permutations=2, bootstraps=2)
    assert programs.count() == genes.count() == 0
    with pytest.raises(Exception, match="negative"):
        G.effects_with_errors(scores.withColumn("score", -F.col("score") - 1), loading, df, permutations=1, bootstraps=2)[0].collect()
    with pytest.raises(ValueError):
        G.effects_with_errors(scores, loading, df, method="other")


def test_changes_are_multiplied_before_a_log_is_taken(monkeypatch):
    rng = np.random.default_rng(9)
    q, w, betas = rng.random((700, 3)) + 0.1, rng.random((3, 40)) * (rng.random((3, 40)) < 0.7) + [[0.01], [0.0], [0.0]], np.r_[rng.normal(size=(3, 3)), [[90.0, -70.0, 1.0], [0.0, 0.0, 0.0]]]
    often, place = np.c_[np.ones(700), rng.poisson(1, (700, 2)), np.zeros(700)], np.array([0, 1, 2, 0, 3])
    want = np.array([often[:, i] @ np.log((q * np.exp(b)) @ w / (q @ w)) for i, b in zip(place, betas)])
    real, logs = np.log, []
    monkeypatch.setattr(np, "log", lambda x: logs.append(np.size(x)) or real(x))
    got = G.log_changes(q, w, betas, often, place)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-9) and sum(logs) < want.size * 700 / 5


def test_covariates_of_unlike_size_and_nearly_collinear(spark):
    rng = np.random.default_rng(21)
    n = 120
    total = rng.uniform(1e3, 4e5, n)
    near = 0.15 + total / 1e7 + rng.normal(0, 1e-4, n)  # such as a propensity
    t, y = np.arange(n) % 2, rng.random(n) + 2000 * (near - total / 1e7)
    cells = spark.createDataFrame([(i, int(t[i]), float(total[i]), float(near[i])) for i in range(n)], "cell_id long, treated int, a double, b double")
    scores = spark.createDataFrame([(i, "p", float(np.expm1(y[i] - y.min()) / 1e6)) for i in range(n)], "cell_id long, program string, score double")
    got = G.effects_with_errors(scores, None, cells, covariates=["a", "b"], permutations=0, bootstraps=2)[0].first()
    z = lambda v: (v - v.mean()) / v.std()
    want = np.linalg.lstsq(np.c_[np.ones(n), t, z(total), z(near)], y - y.min(), rcond=None)[0][1]
    assert got.beta == pytest.approx(want, rel=1e-6)
