"""Solvers, starts, online learning, consensus and components against dense computations."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import factor as N
from sparkloom.operators import similarity as S
from sparkloom.operators import solvers as V


def sparse(spark, x, parts=3):
    rows = [(i, [j for j in range(x.shape[1]) if x[i, j]], [float(v) for v in x[i] if v]) for i in range(len(x))]
    return spark.createDataFrame(rows, "cell_id long, idx array<int>, val array<double>").repartition(parts)


def planted(seed=3, n=60, genes=12, k=3, noise=0.05):
    rng = np.random.default_rng(seed)
    w, h = rng.gamma(1, 1, (n, k)) * (rng.random((n, k)) < 0.6), rng.gamma(1, 1, (k, genes)) * (rng.random((k, genes)) < 0.6)
    x = w @ h + noise * rng.random((n, genes))
    x[rng.random(x.shape) < 0.1] = 0
    x[5] = 0
    return x


def brute_nnls(gram, c):
    """Least squares over every set of free entries; the best feasible one."""
    best, found = 0.0, np.zeros(len(c))
    for size in range(1, len(c) + 1):
        for kind in itertools.combinations(range(len(c)), size):
            x = np.linalg.lstsq(gram[np.ix_(kind, kind)], c[list(kind)], rcond=None)[0]
            if (x >= 0).all():
                full = np.zeros(len(c))
                full[list(kind)] = x
                value = 0.5 * full @ gram @ full - c @ full
                if value < best:
                    best, found = value, full
    return found


@pytest.mark.parametrize("k", [1, 2, 5])
def test_block_pivoting_is_optimal(k):
    rng = np.random.default_rng(k)
    a = rng.normal(size=(12, k))
    gram, cross = a.T @ a, rng.normal(size=(40, k)) * 3
    cross[0] = 0
    got = V.block_pivoting(gram, cross)
    slack = got @ gram - cross
    assert (got >= 0).all() and (slack[got == 0] >= -1e-8).all() and np.abs(slack[got > 0]).max(initial=0) < 1e-8
    assert np.allclose(got, [brute_nnls(gram, c) for c in cross], atol=1e-8)


def test_sparse_rows_equal_dense_products(monkeypatch):
    monkeypatch.setattr(V, "CHUNK", 8)
    rng = np.random.default_rng(0)
    x = rng.random((9, 5)) * (rng.random((9, 5)) < 0.5)
    x[[0, 4, 8]] = 0
    rows = V.Rows.of(pd.Series([np.flatnonzero(r) for r in x]), pd.Series([r[r > 0] for r in x]))
    right, left = rng.random((5, 3)), rng.random((9, 2))
    assert np.allclose(rows.times(right), x @ right) and np.allclose(rows.crossed(left, 5), left.T @ x)
    mask = np.array([True, False] * 4 + [True])
    assert np.allclose(rows.taken(mask).times(right), (x @ right)[mask])
    none = V.Rows.of(pd.Series([], dtype=object), pd.Series([], dtype=object))
    assert none.times(right).shape == (0, 3) and (none.crossed(np.zeros((0, 2)), 5) == 0).all()


def dense_objective(x, w, h, loss):
    y = np.maximum(w @ h, V.TINY)
    if loss == "frobenius":
        return 0.5 * ((x - w @ h) ** 2).sum()
    seen = x > 0
    if loss == "kl":
        return (x[seen] * np.log(x[seen] / y[seen])).sum() - x.sum() + (w @ h).sum()
    return (x[seen] / y[seen] - np.log(x[seen]) - 1).sum() + np.log(y).sum()


def dense_round(x, h, algo, loss, inner):
    """One round on dense matrices: usages from a flat start, then spectra."""
    w = np.ones((len(x), len(h)))
    if loss == "frobenius" and algo == "bpp":
        w = np.array([brute_nnls(h @ h.T, r) for r in x @ h.T])
        new = np.array([brute_nnls(w.T @ w, c) for c in x.T @ w]).T
    elif loss == "frobenius" and algo == "hals":
        w *= ((x @ h.T).sum(1) / (h @ h.T).sum())[:, None]
        for _ in range(inner):
            for r in range(len(h)):
                w[:, r] = np.maximum(0, w[:, r] + ((x - w @ h) @ h[r]) / (h[r] @ h[r]))
        new = h.copy()
        for r in range(len(h)):
            new[r] = np.maximum(0, new[r] + w[:, r] @ (x - w @ new) / (w[:, r] @ w[:, r]))
    else:
        power = {"frobenius": 2, "kl": 1, "is": 0}[loss]
        root = 0.5 if loss == "is" else 1
        for _ in range(inner):
            y = np.maximum(w @ h, V.TINY)
            w *= ((x * y ** (power - 2)) @ h.T / np.maximum(y ** (power - 1) @ h.T, V.TINY)) ** root
        y = np.maximum(w @ h, V.TINY)
        new = h * ((w.T @ (x * y ** (power - 2))) / np.maximum(w.T @ y ** (power - 1), V.TINY)) ** root
    return w, new


@pytest.mark.parametrize("algo,loss", [("mu", "frobenius"), ("hals", "frobenius"), ("bpp", "frobenius"), ("mu", "kl"), ("mu", "is")])
def test_rounds_equal_dense_ones(spark, algo, loss):
    x = planted() + (0.01 if loss == "is" else 0)
    history = []
    got = N.factorise(sparse(spark, x), 12, 3, 7, loss=loss, algo=algo, rounds=3, inner=6, history=history)
    h = np.random.default_rng([7, 3]).random((3, 12)) + 0.01
    for turn in range(3):
        w, new = dense_round(x, h, algo, loss, 6)
        assert np.isclose(history[0][turn], dense_objective(x, w, h, loss), rtol=1e-7)
        h = new
    assert np.allclose(got, h, rtol=1e-6, atol=1e-8)


def test_sweeps_need_fewer_rounds_than_multiplications(spark):
    m, steps = sparse(spark, planted(noise=0)), {}
    for algo in ("mu", "hals", "halsvar", "bpp"):
        steps[algo] = []
        N.factorise(m, 12, 3, 2, algo=algo, rounds=12, inner=6, history=steps[algo])
    goal = steps["mu"][0][-1]
    for algo in ("hals", "halsvar", "bpp"):
        assert min(i for i, v in enumerate(steps[algo][0]) if v <= goal) < 9 and steps[algo][0][-1] <= goal * 1.001
    ended = []
    N.factorise_all(m, 12, [(3, 2), (2, 1)], rounds=40, tol=0.05, history=ended)
    assert all(2 <= len(h) < 40 for h in ended)
    assert N.factorise(m, 12, 3, 2, rounds=2, l1=1.0, l2=0.5).sum() != N.factorise(m, 12, 3, 2, rounds=2).sum()
    for bad in ({"algo": "cd"}, {"loss": "kl", "algo": "hals"}, {"loss": "x"}, {"init": "x"}):
        with pytest.raises(ValueError):
            N.factorise(m, 12, 3, 1, **bad)


def test_singular_vectors_and_their_starts(spark):
    x = planted(n=40)
    mean, scale = x.mean(0), x.std(0)
    scale[2] = 0
    for m, s in ((None, None), (mean, None), (mean, scale)):
        d = np.ones(12) if s is None else np.where(s > 0, 1 / np.where(s > 0, s, 1), 0)
        y = (x - (0 if m is None else m)) * d
        v, values = N.singular_vectors(sparse(spark, x), 12, 4, m, s)
        _, sv, vt = np.linalg.svd(y)
        assert np.allclose(values, sv[:4] ** 2, rtol=1e-7) and np.allclose(np.abs((v * vt[:4].T).sum(0)), 1, atol=1e-6)
    h = N.nndsvd(sparse(spark, x), 12, 3)
    u, sv, vt = np.linalg.svd(x, full_matrices=False)
    want = [np.sqrt(sv[0]) * np.abs(vt[0])]
    for j in (1, 2):
        sides = [(np.linalg.norm(np.maximum(sign * u[:, j], 0)) * np.linalg.norm(np.maximum(sign * vt[j], 0)), np.maximum(sign * vt[j], 0)) for sign in (1, -1)]
        weight, side = max(sides, key=lambda t: t[0])
        want.append(np.sqrt(sv[j] * weight) * side / np.linalg.norm(side))
    want = np.array(want)
    assert np.allclose(np.where(want > 1e-9, h - want, 0), 0, atol=1e-5) and (h > 0).all()
    steps = {}
    for init in ("random", "nndsvd"):
        steps[init] = []
        N.factorise(sparse(spark, x), 12, 3, 1, init=init, rounds=1, history=steps[init])
    assert steps["nndsvd"][0][0] < steps["random"][0][0]


def test_online_learning_sees_each_cell_once_a_pass_and_goes_on_from_its_state(spark, tmp_path):
    m, history = sparse(spark, planted()), []
    h = N.factorise_online(m, 12, 3, 5, batches=4, passes=3, history=history)
    by_pass = {t: sum(n for p, n, _ in history if p == t) for t in range(3)}
    assert by_pass == {0: 60, 1: 60, 2: 60}
    error = [sum(o for p, _, o in history if p == t) for t in range(3)]
    assert error[2] < error[0] / 2
    where = f"{tmp_path}/state"
    N.factorise_online(m, 12, 3, 5, batches=4, passes=2, state=where)
    assert np.allclose(N.factorise_online(m, 12, 3, 5, batches=4, passes=3, state=where), h)
    assert np.allclose(N.factorise_online(m, 12, 3, 5, batches=4, passes=3, state=where), h)


@pytest.mark.parametrize("entries", [1 << 23, 40])
def test_nearest_in_blocks_equal_all_pairs(spark, monkeypatch, entries):
    monkeypatch.setattr(S, "DENSE_ENTRIES", entries)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, (30, 5)).astype(float)
    x[3] = 1
    df = spark.createDataFrame([(f"g{i:02d}", row.tolist()) for i, row in enumerate(x)], "id string, v array<double>").repartition(4)
    for value, largest in ((N.distances, False), (N.correlations, True), (N.correlations, False)):
        d = value(x, x)
        got = {}
        for r in N.nearest_in_blocks(df, 4, value, largest).collect():
            got.setdefault(r.a, []).append((r.value, r.b))
        for i in range(30):
            pairs = [(d[i, j], f"g{j:02d}") for j in range(30) if j != i and not np.isnan(d[i, j])]
            want = sorted(pairs, key=lambda t: (round(-t[0] if largest else t[0], 9), t[1]))[:4]
            own = sorted(got.get(f"g{i:02d}", []), key=lambda t: (round(-t[0] if largest else t[0], 9), t[1]))
            assert np.allclose([v for v, _ in own], [v for v, _ in want]) and len(own) == len(want)


def test_usages_are_exact_and_spectra_follow_from_them(spark):
    x = planted()
    h = np.random.default_rng(2).random((3, 12))
    got = {r.cell_id: np.array(r.usage) for r in N.usages(sparse(spark, x), h).collect()}
    want = np.array([brute_nnls(h @ h.T, c) for c in x @ h.T])
    assert np.allclose([got[i] for i in range(60)], want, atol=1e-8)
    share = want / np.maximum(want.sum(1), 1e-300)[:, None]
    values = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(60) for j in range(12) if x[i, j]], "cell_id long, gene_id int, tpm double")
    spectra = {r.gene_id: r.spectrum for r in N.refit_spectra(values, N.usages(sparse(spark, x), h)).collect()}
    assert np.allclose([spectra[j] for j in range(12)], [brute_nnls(share.T @ share, c) for c in x.T @ share], atol=1e-8)


def test_k_selection_against_dense_errors(spark):
    x = planted(noise=0.01)
    m = sparse(spark, x)
    spectra = N.replicates(m, 12, [2, 3], 4, rounds=8)
    got = {r.K: r for r in N.k_selection(m, 12, spectra).collect()}
    assert set(got) == {2, 3} and got[3].prediction_error < got[2].prediction_error
    for k in (2, 3):
        h = N.median_matrix(N.consensus(spectra.filter(F.col("K") == k), k), 12)
        w = np.array([brute_nnls(h @ h.T, c) for c in x @ h.T])
        assert np.isclose(got[k].prediction_error, ((x - w @ h) ** 2).sum()) and -1 <= got[k].silhouette <= 1
    done = spark.createDataFrame([(3, 0.5, 1.0)], "K int, silhouette double, prediction_error double")
    both = {r.K: r.prediction_error for r in N.k_selection(m, 12, spectra, done=done).collect()}
    assert both[3] == 1.0 and np.isclose(both[2], got[2].prediction_error)


def test_scores_of_logged_scaled_counts(spark):
    rng = np.random.default_rng(6)
    x = rng.poisson(1.5, (30, 8))
    x[:, 7] = 0
    expr = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(30) for j in range(8) if x[i, j]], "cell_id long, gene_id int, count double")
    genes = spark.createDataFrame([(j,) for j in range(6)], "gene_id int")
    rows, mean, scale = N.prepare_log(expr, genes)
    y = np.log1p(x / np.maximum(x.sum(1, keepdims=True), 1) * 1e4)[:, :6]
    y = y[x.sum(1) > 0]
    assert np.allclose(mean, y.mean(0)) and np.allclose(scale, y.std(0)) and rows.count() == len(y)
    z = (y - y.mean(0)) / y.std(0)
    got = np.array([r.pc for r in N.pca(rows, 6, 3, mean, scale).orderBy("cell_id").collect()])
    _, _, vt = np.linalg.svd(z)
    assert np.allclose(np.abs(got), np.abs(z @ vt[:3].T), atol=1e-6)


def test_nearest_correlations_by_brute_force_with_equal_vectors(spark, monkeypatch):
    rng = np.random.default_rng(31)
    x = np.round(rng.random((90, 6)), 1)
    x[40:70] = x[0:30]  # equal vectors have equal correlations: ties by id
    x[88:] = 0.5  # constant
    vectors = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(90)], "id long, v array<double>")
    u = x[:88] - x[:88].mean(1, keepdims=True)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    r = {(a, b): float(np.einsum("i,i->", u[a], u[b])) for a in range(88) for b in range(88) if a != b}
    want = {(a, sign): sorted((b for b in range(88) if b != a), key=lambda b: (-sign * round(r[a, b], 12), b))[:4] for a in range(88) for sign in (1, -1)}
    for piece, entries in (((256, 8192), 1 << 23), ((7, 40), 200)):
        monkeypatch.setattr(N, "PIECE", piece)
        monkeypatch.setattr(N.similarity, "DENSE_ENTRIES", entries)
        got = {}
        for row in sorted(N.nearest_correlations(vectors, 4).collect(), key=lambda q: (-q.sign * round(q.value, 12), q.b)):
            got.setdefault((row.a, row.sign), []).append(row.b)
            assert row.value == pytest.approx(r[row.a, row.b], abs=1e-12)
        assert got == want
