"""The matched-cell analysis of several targets against runs of one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import calibration as C
from sparkloom.operators.matched import matched_screen


@pytest.fixture(scope="module")
def screen(spark):
    rng = np.random.default_rng(11)
    n = 240
    cells = spark.createDataFrame([(i, float(rng.normal()), float(rng.random())) for i in range(n)], "cell_id long, a double, b double")
    treated = spark.createDataFrame([(i, "t0") for i in range(0, 40)] + [(i, "t1") for i in range(30, 75)] + [(i, "few") for i in range(3)], "cell_id long, target string")
    controls = spark.createDataFrame([(i,) for i in range(75, n)], "cell_id long")
    value = rng.random((n, 2)) * rng.integers(0, 2, (n, 2)) / 1e3
    scores = spark.createDataFrame([(i, f"p{j}", float(value[i, j])) for i in range(n) for j in range(2) if value[i, j]], "cell_id long, program string, score double")
    loading = spark.createDataFrame([(f"p{j}", f"g{g}", float(rng.random())) for j in range(2) for g in range(3)], "program string, gene_id string, score double")
    return scores, cells, treated, controls, loading


def table(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def run(screen, treated=None, **options):
    scores, cells, every, controls, loading = screen
    options = {"ratio": 2, "loading": loading, "propagate": ("ols_log", "ols_pseudo"), "permutations": 2, "bootstraps": 4} | options
    return matched_screen(scores, cells, every if treated is None else treated, controls, ["a", "b"], **options)


def test_targets_together_and_alone(spark, screen):
    every = {k: table(v) for k, v in run(screen).items()}
    assert set(every) == {"rates", "balance", "contingency", "programs", "genes"}
    assert {r[0]: (r[1], r[-1]) for r in every["rates"]} == {"t0": (40, True), "t1": (45, True), "few": (3, False)}
    assert {(r[0], r[2]) for r in every["programs"]} == {(t, m) for t in ("t0", "t1") for m in ("ols_log", "ols_pseudo", "hurdle")}
    assert len(every["programs"]) == 12 and len(every["genes"]) == 2 * 2 * 3 and len(every["balance"]) == 4
    for target in ("t0", "t1"):
        alone = run(screen, screen[2].filter(F.col("target") == target))
        for kind, rows in every.items():
            own = [r for r in rows if target in r[:2]]
            for got, want in zip(table(alone[kind]), own, strict=True):
                assert all(a == b or isinstance(a, float) and a == pytest.approx(b, rel=1e-6, abs=1e-7) for a, b in zip(got, want, strict=True)), (kind, got, want)


def test_contingency_and_rates_by_hand(spark, screen):
    scores, cells, treated, controls, _ = screen
    out = run(screen, loading=None, methods=("ols_log",))
    assert "genes" not in out
    rows = C.screened_cells(cells, treated, ["a", "b"], controls)
    matched = C.match(rows, ["target"], ["a", "b"], 2).collect()
    value = {(r.cell_id, r.program): r.score for r in scores.collect()}
    for r in out["contingency"].collect():
        own = [m for m in matched if m.target == r.target]
        some = {side: sum((m.cell_id, r.program) in value for m in own if m.treated == side) for side in (0, 1)}
        size = {side: sum(m.treated == side for m in own) for side in (0, 1)}
        assert (r.treated_positive, r.treated_zero, r.control_positive, r.control_zero) == (some[1], size[1] - some[1], some[0], size[0] - some[0])


def test_thinned_controls_hold_the_first_ones(spark, screen):
    _, cells, treated, controls, _ = screen
    thin = C.screened_cells(cells, treated, ["a"], controls, max_controls=20)
    whole = C.screened_cells(cells, treated, ["a"], controls, max_controls=None)
    match = lambda rows: sorted(map(tuple, C.match(rows, ["target"], ["a"], 1, max_controls=20).select("target", "cell_id", "treated", "pair").collect()))
    assert match(thin) == match(whole) and thin.count() <= whole.count()


def test_unknown_methods_and_no_targets(spark, screen):
    with pytest.raises(ValueError):
        run(screen, methods=("ols",))
    with pytest.raises(ValueError):
        run(screen, propagate=("hurdle",))
    out = run(screen, screen[2].limit(0))
    assert all(df.count() == 0 for df in out.values())


def test_rates_count_controls_that_are_thinned(spark, screen):
    rates = run(screen, loading=None, methods=("ols_log",), max_controls=20)["rates"].collect()
    assert {r.target: r.controls for r in rates} == {"t0": 165, "t1": 165, "few": 0}
    assert all(r.matched_controls <= 20 for r in rates)


def test_programs_need_no_loadings_of_genes(spark, screen):
    options = {"methods": ("ols_log",), "propagate": ("ols_log",)}
    every, programs = run(screen, **options), run(screen, with_genes=False, **options)
    assert "genes" in every and "genes" not in programs
    for got, want in zip(table(programs["programs"]), table(every["programs"]), strict=True):
        assert all(a == b or isinstance(a, float) and a == pytest.approx(b, rel=1e-6, abs=1e-7) for a, b in zip(got, want, strict=True))


def test_falling_match_equals_nearest_free_and_waits_in_files(monkeypatch):
    monkeypatch.setattr(C, "WAITING", 3)
    rng = np.random.default_rng(12)
    for _ in range(200):
        scores, wanted = (np.sort(np.round(rng.random(rng.integers(1, n)) ** rng.choice([1, 4]), 2)) for n in (60, 40))
        ratio, width = int(rng.integers(1, 4)), float(rng.choice([0.05, 0.3, np.inf]))
        want = C.nearest_free(scores, wanted[::-1], ratio, width)
        going = C.FallingMatch(ratio, width)
        cells = [(-x, 0, -i, (x, i, 0.5)) for i, x in enumerate(scores.tolist())] + [(-x, 1, i, (x, i, 0.5)) for i, x in enumerate(wanted[::-1].tolist())]
        for _, side, _, cell in sorted(cells):
            (going.treated if side else going.control)(cell)
        going.end()
        got = {own[1]: [(other[1], d) for other, d in mine] for own, mine in going.found}
        assert got == {i: m for i, m in enumerate(want) if m}


def test_no_control_is_left_out(spark):
    n = 21_000  # one more than 20,000 and each is needed
    cells = spark.range(2 * n).select("id", ((F.col("id") * 7919) % 1000).cast("double").alias("a")).withColumnRenamed("id", "cell_id")
    treated = cells.filter(F.col("cell_id") < n).select("cell_id", F.lit("t").alias("target"))
    rows = C.screened_cells(cells, treated, ["a"], cells.select("cell_id"), least=1)
    assert C.match(rows, ["target"], ["a"], 1).filter("treated = 0").agg(F.count_distinct("cell_id")).first()[0] == n


@pytest.mark.parametrize("cluster", ["pair", None])
def test_weighted_ols_from_sums_equals_matrices(spark, cluster):
    rng = np.random.default_rng(13)
    n = 90
    t, w, a, pair = np.arange(n) % 3 == 0, rng.integers(1, 4, n) / 2, rng.normal(1e5, 2e4, n), np.arange(n) // 3
    y = 2.0 * t + a / 1e5 + rng.normal(0, 1, n)
    df = spark.createDataFrame([("k", int(t[i]), float(y[i]), float(w[i]), int(pair[i]), float(a[i]), 7.0) for i in range(n)], "k string, treated int, y double, weight double, pair long, a double, c double")
    got = C.weighted_ols(df.repartition(3), ["k"], "y", ["a", "c"], cluster).first()
    x = np.c_[np.ones(n), t, (a - a.mean()) / a.std()]
    inv = np.linalg.inv((x * w[:, None]).T @ x)
    beta = inv @ x.T @ (w * y)
    u = x * (w * (y - x @ beta))[:, None]
    if cluster:
        u = np.stack([u[pair == g].sum(0) for g in range(30)])
        factor = 30 / 29 * (n - 1) / (n - 4)
    else:
        u, factor = u / (1 - np.einsum("ij,jk,ik->i", x, inv, x) * w)[:, None], 1
    assert got.beta == pytest.approx(beta[1]) and got.se == pytest.approx(np.sqrt(factor * (inv @ u.T @ u @ inv)[1, 1])) and got.n == n


def test_matched_effects_use_every_control(spark):
    n = 21_000
    cells = spark.range(2 * n).select(F.col("id").alias("cell_id"), ((F.col("id") * 7919) % 1000).cast("double").alias("a"))
    treated = cells.filter(F.col("cell_id") < n).select("cell_id", F.lit("t").alias("target"))
    scores = cells.select("cell_id", F.lit("p").alias("program"), (F.col("cell_id") % 11).cast("double").alias("score"))
    assert C.matched_effects(scores, cells, treated, ["a"], cells.select("cell_id"), ratio=1).first().n == 2 * n


def test_hurdle_from_sums_equals_one_task(spark, monkeypatch):
    rng = np.random.default_rng(14)
    data = []
    for g, n in (("a", 300), ("b", 200), ("c", 40)):
        t, a = np.arange(n) % 2, rng.normal(1e3, 200, n)
        y = np.where(rng.random(n) < 0.3 + 0.3 * t, rng.gamma(2, 1e-5, n) * (1 + t) * a / 1e3, 0.0)
        data += [(g, int(t[i]), float(a[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(data, "k string, treated int, a double, y double")
    want = {r.k: r for r in C.hurdle(df, ["k"], "y", ["a"]).collect()}
    monkeypatch.setattr(C, "GROUP_ROWS", 100)
    got = {r.k: r for r in C.hurdle(df, ["k"], "y", ["a"]).collect()}
    assert set(got) == set(want) == {"a", "b", "c"}
    for k, r in want.items():
        assert list(got[k])[1:] == pytest.approx(list(r)[1:], rel=1e-6, abs=1e-12), k


def test_screen_takes_all_controls_by_default():
    import inspect

    every = (C.screened_cells, C.match, C.matched_effects, matched_screen)
    assert all(inspect.signature(f).parameters["max_controls"].default is None for f in every)
