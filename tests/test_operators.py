"""Hand-worked cases, invariants and odd inputs of the operators."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import association as A
from sparkloom.operators import calibration as C
from sparkloom.operators import enrichment as E
from sparkloom.operators import factor as N
from sparkloom.operators import ranking as R
from sparkloom.operators import recode as B
from sparkloom.operators import similarity as S
from sparkloom.operators import tables as D
from sparkloom.operators import text as T


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_positions_split_groups_without_changing_ranks(spark):
    values = [random.Random(1).randrange(30) for _ in range(300)]
    df = spark.createDataFrame([("g", float(v)) for v in values] + [("g", None), ("g", float("nan"))], "k string, v double")
    for buckets in (2, 32):
        got = {(r.v, r.below, r.equal) for r in R.positions(df, ["k"], "v", buckets=buckets).collect()}
        assert got == {(float(v), sum(x < v for x in values), values.count(v)) for v in values}


def test_benjamini_hochberg_by_hand(spark):
    df = spark.createDataFrame([(1, 0.01), (2, 0.04), (3, 0.03), (4, 0.5)], "i int, p double").withColumn("k", F.lit(1))
    assert [round(r.adj_pval, 6) for r in R.benjamini_hochberg(df, ["k"], "p").orderBy("i").collect()] == [0.04, 0.053333, 0.053333, 0.5]


@pytest.mark.parametrize("buckets", [2, 32])
def test_wide_benjamini_hochberg_is_the_same(spark, buckets):
    values = [random.Random(3).randrange(1, 60) / 80 for _ in range(200)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double").withColumn("k", F.lit(1))
    want = {r.i: r.adj_pval for r in R.benjamini_hochberg(df, ["k"], "p").collect()}
    got = {r.i: r.adj_pval for r in R.benjamini_hochberg_wide(df, "p", buckets=buckets).collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)


def test_storey_is_at_most_bh_and_bounded(spark):
    df = spark.createDataFrame([(i, (i + 1) / 50) for i in range(49)], "i int, p double").withColumn("k", F.lit(1))
    both = R.storey(R.benjamini_hochberg(df, ["k"], "p"), ["k"], "p").collect()
    assert all(0 <= r.qval <= r.adj_pval + 1e-12 <= 1 + 1e-12 for r in both)


def test_smoothed_share_of_null_hypotheses(spark):
    rng = np.random.default_rng(2)
    p = np.r_[rng.random(300), rng.random(200) ** 6]
    df = spark.createDataFrame([("a", float(v), i) for i, v in enumerate(p)] + [("b", 0.99, 0), ("b", 1.0, 1), (None, 0.2, 0)], "k string, p double, i int")
    got = [r.q for r in R.storey(df, ["k"], "p", "q", ties=["i"]).filter("k = 'a'").orderBy("i").collect()]
    x = np.arange(96) * 0.01
    pi0 = np.polyval(np.polyfit(x, [(p > v).mean() / (1 - v) for v in x], 3), 1.0)
    order = np.argsort(p, kind="stable")
    adjusted = np.empty(len(p))
    adjusted[order] = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
    assert 0.4 < pi0 < 0.8 and np.allclose(got, np.minimum(1, pi0 * np.minimum(1, adjusted)))
    rest = R.storey(df, ["k"], "p", "q", ties=["i"]).filter("k = 'b' OR k IS NULL").collect()
    assert len(rest) == 3 and all(0 <= r.q <= 1 for r in rest)


def test_clean_p(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, None, float("nan"), -0.1, 1.5, 0.0, 1.0)], "p double")
    assert [r[0] for r in df.select(R.clean_p(F.col("p"))).collect()] == [0.5, 1, 1, 1, 1, 0, 1]


def test_mann_whitney_by_hand(spark):
    test = spark.createDataFrame([("p", "t", 3.0), ("p", "t", 5.0)], "program string, target string, score double")
    ref = spark.createDataFrame([("p", 1.0), ("p", 3.0), ("p", 4.0)], "program string, score double")
    r = A.mann_whitney(test, ref, ["program"], "target").first()
    assert (r.stat, r.n_test, r.n_ref) == (4.5, 2, 3)
    sd = math.sqrt(2 * 3 / 12 * (6 - 6 / 20))
    assert r.z == pytest.approx((4.5 - 3 - 0.5) / sd)


def test_constant_scores_have_no_z(spark):
    t = spark.createDataFrame([("p", "t", 1.0)] * 2, "program string, target string, score double")
    assert A.mann_whitney(t, t.drop("target"), ["program"], "target").first().z is None


def test_kruskal_wallis_of_separate_groups(spark):
    df = spark.createDataFrame([("p", g, float(3 * i + j)) for i, g in enumerate("abc") for j in range(3)], "program string, g string, score double")
    r = A.kruskal_wallis(df, "g").first()
    assert r.stat == pytest.approx(7.2) and r.pval == pytest.approx(math.exp(-3.6))


def test_pseudobulk_needs_replicates(spark):
    df = spark.createDataFrame([("p", "s1", "a", 1.0)], "program string, s string, g string, score double")
    with pytest.raises(ValueError):
        A.pseudobulk(df, "s", "g")


@pytest.mark.parametrize("text,want", [("7", 7), ("topic_12", 12), ("P3", 3), ("x_4", 4), ("q4", None), (None, None), ("", None)])
def test_program_ids(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(B.parse_program(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("text,want", [(" TRUE", True), ("y", True), ("none", False), ("0.0", False), ("2", True), ("nan", False), ("huh", False), (None, False)])
def test_booleans(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(B.to_boolean(F.col("t"))).first()[0] is want


def test_columns_by_alias(spark):
    df = spark.createDataFrame([("g", 1.0)], "`Gene Name` string, Weight double")
    assert B.resolve_columns(df, ["Name", "Score"]).columns == ["Name", "Score"]
    with pytest.raises(ValueError):
        B.resolve_columns(df, ["cell_type"])


def test_constant_covariate_is_an_error(spark):
    with pytest.raises(Exception, match="constant"):
        B.covariate_design(spark.createDataFrame([(1.0,), (1.0,)], "x double"), ["x"]).collect()


def test_specificity_invariants(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([("s", f"t{i}", f"p{j}", float(rng.normal()), 0.01) for i in range(6) for j in range(5)], "sample string, target_name string, program_name string, log2FC double, adj_pval double")
    found = D.specificity(df).toPandas()
    assert found.groupby("target_name").z.median().abs().max() < 1e-9
    assert found.weight.sum() == pytest.approx(1) and np.isfinite(found.pmi).all()
    assert found.groupby("program_name").p_program.first().sum() == pytest.approx(1)


def test_knockdown_null_rules(spark):
    expr = spark.createDataFrame([(1, "g", 5.0), (1, "h", 5.0), (2, "h", 10.0), (3, "g", 1.0), (3, "h", 9.0)], "cell_id long, gene_id string, count double")
    cells = spark.createDataFrame([(1, "c"), (2, "c"), (3, "c"), (4, "d")], "cell_id long, condition string")
    guides = spark.createDataFrame([(0, "non-targeting"), (1, "g")], "guide_name int, target string")
    assign = spark.createDataFrame([(1, 0, 1), (2, 0, 1), (3, 1, 1)], "cell_id long, guide_name int, n int")
    genes = spark.createDataFrame([("g", "g")], "target string, gene_id string")
    got = {r.condition: r.kd for r in D.knockdown(expr, cells, assign, guides, genes, "non-targeting").collect()}
    assert got["c"] == pytest.approx((1 - 1000 / 2500) * 100) and got["d"] is None


def test_fisher_by_hand(spark):
    loading = spark.createDataFrame([("p", i, float(10 - i)) for i in range(10)], "program string, gene_id long, score double")
    sets = spark.createDataFrame([("a", i) for i in (0, 1, 2)] + [("b", i) for i in range(3, 10)], "term string, gene_id long")
    r = {x.term: x for x in E.fisher(loading, sets, n_top=3).collect()}
    assert r["a"].pval == pytest.approx(1 / 120) and r["a"].overlap == 3 and "b" not in r


def test_prerank_does_not_depend_on_partitions(spark):
    loading = spark.createDataFrame([("p", i, float(20 - i)) for i in range(40)], "program string, gene_id long, score double")
    sets = spark.createDataFrame([("top", i) for i in range(16)] + [("mixed", i) for i in range(0, 40, 2)], "term string, gene_id long")
    a, b = (rows(E.prerank(loading.repartition(n), sets, permutations=50)) for n in (1, 5))
    assert a == b and {r[1]: r[3] for r in a}["top"] == pytest.approx(1.0, abs=0.5)


def test_correlation_adds_zeros_back(spark):
    x = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 2, 1.0), ("c", 3, 4.0)], "program string, gene_id int, score double")
    got = {(r.a, r.b): r.r for r in S.correlation(x, x, "program", "gene_id", "score").collect()}
    dense = {"a": [1, 2, 0], "b": [0, 1, 0], "c": [0, 0, 4]}
    for (p, q), r in got.items():
        assert r == pytest.approx(np.corrcoef(dense[p], dense[q])[0, 1])


def test_jaccard_of_disjoint_sets(spark):
    a = spark.createDataFrame([("x", 1)], "p string, m int")
    assert rows(S.jaccard(a, spark.createDataFrame([("y", 2)], "p string, m int"), "p", "m")) == [("x", "y", 0.0)]


def test_reconstruction_error_is_zero_for_exact_factors(spark):
    w = spark.createDataFrame([(1, "p", 2.0), (2, "p", 3.0)], "cell_id long, program string, score double")
    h = spark.createDataFrame([("p", "g", 1.0), ("p", "h", 4.0)], "program string, gene_id string, score double")
    x = spark.createDataFrame([(1, "g", 2.0), (1, "h", 8.0), (2, "g", 3.0), (2, "h", 12.0)], "cell_id long, gene_id string, count double")
    assert S.reconstruction_error(x, w, h).first()[0] == pytest.approx(0, abs=1e-9)


def test_matching_uses_no_control_twice(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([("t", i, int(i < 20), float(rng.normal(0.5 * (i < 20)))) for i in range(120)], "target string, cell_id long, treated int, x double")
    m = C.match(df, ["target"], ["x"], ratio=3, caliper=1.0).toPandas()
    controls = m[m.treated == 0]
    assert controls.cell_id.is_unique and controls.groupby("pair").size().max() <= 3
    assert controls.groupby("pair").weight.sum().round(9).eq(1).all()


def test_weighted_ols_finds_the_effect(spark):
    rng = np.random.default_rng(4)
    data = [("k", i, i % 2, float(2.0 * (i % 2) + rng.normal(0, 0.1)), 1.0, i // 2) for i in range(200)]
    df = spark.createDataFrame(data, "k string, cell_id long, treated int, y double, weight double, pair long")
    r = C.weighted_ols(df, ["k"], "y", []).first()
    assert r.beta == pytest.approx(2, abs=0.05) and 0 < r.se < 0.05 and r.pval < 1e-6


def test_randomisation_is_seeded_and_valid(spark):
    rng = np.random.default_rng(5)
    clr = spark.createDataFrame([(i, p, float(rng.normal() + (3 if p == "b" and i < 15 else 0))) for i in range(60) for p in "ab"], "cell_id long, program string, clr double")
    cells = spark.createDataFrame([(i, "c", float(i % 3)) for i in range(60)], "cell_id long, condition string, x double")
    treated = spark.createDataFrame([(i, "t") for i in range(15)], "cell_id long, target string")
    a, b = (rows(C.randomisation_test(clr.repartition(n), cells, treated, ["x"], draws=199)) for n in (1, 4))
    assert [r[:3] for r in a] == [r[:3] for r in b] and np.allclose([r[4] for r in a], [r[4] for r in b])
    assert {r[2]: r[4] for r in a}["b"] == pytest.approx(1 / 200)


def test_factorisation_recovers_blocks_and_repeats(spark):
    data = [(i, list(range(3)) if i % 2 else list(range(3, 6)), [5.0, 4.0, 3.0]) for i in range(40)]
    m = spark.createDataFrame(data, "cell_id long, idx array<int>, val array<double>")
    h = N.factorise(m, 6, 2, seed=1, rounds=30)
    assert np.allclose(h, N.factorise(m.repartition(5), 6, 2, seed=1, rounds=30), atol=1e-5)
    share = h / h.sum(1, keepdims=True)
    assert sorted(np.round(share[:, :3].sum(1), 2).tolist()) == [0.0, 1.0]


def test_sentences(spark):
    df = spark.createDataFrame([(1, "See Fig. 2 for more. Then we go! Short. What, e.g. this one?  Yes indeed it is"), (2, None)], "pmid int, t string")
    assert [r.sentence for r in T.sentences(df, "pmid", F.col("t")).orderBy("position").collect()] == ["See Fig. 2 for more.", "Then we go!", "What, e.g. this one?", "Yes indeed it is"]


def test_unique_names_on_collision(spark):
    df = spark.createDataFrame([(1, ["cell", "cycle"], ["A"]), (2, ["cell", "cycle"], ["B"]), (3, ["cell", "cycle"], ["B"])], "t int, k array<string>, g array<string>")
    assert rows(T.unique_names(df, "t", "k", "g")) == [(1, "Cell Cycle"), (2, "Cell Cycle B"), (3, "Cell Cycle 3")] or len({r[1] for r in rows(T.unique_names(df, "t", "k", "g"))}) == 3


@pytest.mark.parametrize("f", [lambda d: R.average_ranks(d, ["program"], "score"), lambda d: A.kruskal_wallis(d, "g"), lambda d: B.dominant_program(d), lambda d: S.correlation(d, d, "program", "cell_id", "score", 1)])
def test_empty_tables(spark, f):
    empty = spark.createDataFrame([], "program string, cell_id long, score double, g string")
    assert f(empty).collect() == []


def test_nearest_free_against_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(60):
        scores = np.sort(np.round(rng.random(rng.integers(1, 30)), 2))
        wanted, ratio, width = np.round(rng.random(rng.integers(1, 15)), 2), int(rng.integers(1, 4)), float(rng.choice([0.05, 0.3, np.inf]))
        taken, want = set(), []
        for x in wanted:
            mine = []
            for _ in range(ratio):
                left = [j for j in range(len(scores)) if j not in taken]
                if not left or min(abs(scores[j] - x) for j in left) > width:
                    break
                best = min(abs(scores[j] - x) for j in left)
                mine.append(best)
                below = [j for j in left if scores[j] < x and x - scores[j] == best]
                taken.add(max(below) if below else min(j for j in left if abs(scores[j] - x) == best))
            want.append(mine)
        got = C.nearest_free(scores, wanted, ratio, width)
        assert [[d for _, d in m] for m in got] == want
        assert len({j for m in got for j, _ in m}) == sum(map(len, got))


def test_sent_matrices_and_joins_agree(spark, monkeypatch):
    rng = np.random.default_rng(2)
    usage = spark.createDataFrame([(c, str(p), float(rng.random())) for c in range(30) for p in range(4) if rng.random() < 0.7], "cell_id long, program string, score double")
    loading = spark.createDataFrame([(str(p), g, float(rng.random())) for p in range(4) for g in range(25) if rng.random() < 0.6], "program string, gene_id long, score double")
    expr = spark.createDataFrame([(c, g, float(rng.integers(1, 9))) for c in range(30) for g in range(26) if rng.random() < 0.4], "cell_id long, gene_id long, count double")
    betas = spark.createDataFrame([("0", 0.3), ("2", -0.2)], "program string, beta double")

    def found():
        e = {r.gene_id: r.effect for r in C.gene_effects(usage, loading, betas).collect()}
        v = {r.program: r.explained for r in S.explained_variance(expr, loading, 30).collect()}
        return e, v, {"error": S.reconstruction_error(expr, usage, loading).first().error}

    sent = found()
    monkeypatch.setattr(S, "DENSE_ENTRIES", 0)
    joined = found()
    for a, b in zip(sent, joined, strict=True):
        assert set(a) == set(b) and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_blocks_of_correlations(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(g, str(p), float(rng.random())) for g in range(17) for p in range(5) if rng.random() < 0.8] + [(99, str(p), 1.0) for p in range(5)]
    df = spark.createDataFrame(rows, "gene_id long, program string, score double")
    want = {(r.a, r.b): r.r for r in S.correlation(df, df, "gene_id", "program", "score").collect()}
    monkeypatch.setattr(S, "BLOCK_IDS", 4)
    got = {(r.a, r.b): r.r for r in S.correlation_in_blocks(df, "gene_id", "program", "score").collect()}
    assert set(got) == set(want) and all((got[k] is None) == (want[k] is None) and (got[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)


def test_enrichment_statistics_against_brute_force():
    rng = np.random.default_rng(7)
    size = np.array([15, 20, 33])
    null = rng.normal(0, 0.3, (3, 50)).round(2)
    seen = E.pd.DataFrame({"matched": [15, 20, 20, 33, 15, 33], "es": [0.9, 0.2, -0.4, -0.1, 0.0, 0.35]})
    got = E.judge(seen, size, null)
    same = lambda x, up: x >= 0 if up else x < 0

    def normal(x, k):
        own = [v for v in null[k] if same(v, x >= 0)]
        return x / abs(np.mean(own))

    at = [list(size).index(m) for m in seen["matched"]]
    nes = [normal(x, k) for x, k in zip(seen["es"], at, strict=True)]
    for i, (x, k) in enumerate(zip(seen["es"], at, strict=True)):
        up = x >= 0
        own = [v for v in null[k] if same(v, up)]
        assert got["pval"][i] == pytest.approx(sum(abs(v) >= abs(x) for v in own) / len(own))
        assert got["nes"][i] == pytest.approx(nes[i])
        pooled = [abs(normal(v, j)) for j in at for v in null[j] if same(v, up)]
        observed = [abs(v) for v in nes if same(v, up)]
        share = lambda values, i=i: sum(v >= abs(nes[i]) - 1e-12 for v in values) / len(values)
        assert got["fdr"][i] == pytest.approx(min(1, share(pooled) / share(observed)))
        worst = [max((abs(normal(null[j, d], j)) for j in set(at) if same(null[j, d], up)), default=None) for d in range(50)]
        assert got["fwer"][i] == pytest.approx(share([w for w in worst if w is not None]))


def test_random_sets_are_no_discoveries(spark):
    rng = random.Random(5)
    loading = spark.createDataFrame([("p", g, rng.random()) for g in range(400)], "program string, gene_id long, score double")
    top = sorted((r for r in loading.collect()), key=lambda r: -r.score)[:25]
    sets = [("planted", r.gene_id) for r in top] + [(f"random{i}", g) for i in range(12) for g in rng.sample(range(400), 25)]
    got = {r.term: r for r in E.prerank(loading, spark.createDataFrame(sets, "term string, gene_id long"), permutations=200).collect()}
    assert got["planted"].fdr < 0.05 and got["planted"].fwer < 0.05 and got["planted"].nes > 1.5
    assert sum(r.fwer < 0.05 for t, r in got.items() if t != "planted") <= 1 and all(r.fdr <= 1 for r in got.values())


def test_randomisation_against_all_cells_in_one_place(spark):
    """Coefficients and draws from sums of partitions, against least squares with the same labels."""
    rng = np.random.default_rng(9)
    n, draws = 80, 60
    y = rng.normal(size=(n, 3))
    x = rng.normal(size=n)
    t = (rng.random(n) < 0.3).astype(float)
    y[:, 1] += t
    clr = spark.createDataFrame([(i, str(p), float(y[i, p])) for i in range(n) for p in range(3)], "cell_id long, program string, clr double")
    cells = spark.createDataFrame([(i, "c", float(x[i])) for i in range(n)], "cell_id long, condition string, x double")
    treated = spark.createDataFrame([(i, "t") for i in range(n) if t[i]], "cell_id long, target string")
    got = {r.program: r for r in C.randomisation_test(clr.repartition(3), cells, treated, ["x"], draws=draws, seed=3).collect()}
    d = np.c_[np.ones(n), (x - x.mean()) / x.std()]
    p = C.logistic(d, t)
    labels = [t, *(C.uniforms(np.arange(n), np.arange(draws), 3, "c|t") < p[:, None]).T.astype(float)]
    effect = np.array([np.linalg.lstsq(np.c_[d, v], y, rcond=None)[0][-1] for v in labels])
    for k in range(3):
        assert got[str(k)].beta == pytest.approx(effect[0, k])
        assert got[str(k)].pval == pytest.approx((1 + (abs(effect[1:, k]) >= abs(effect[0, k]) - 1e-12).sum()) / (draws + 1))


def test_uniforms_are_uniform_and_named():
    u = C.uniforms(np.arange(2000), np.arange(20), 1, "a")
    assert abs(u.mean() - 0.5) < 0.01 and 0 <= u.min() and u.max() < 1 and abs(np.corrcoef(u[:, 0], u[:, 1])[0, 1]) < 0.08
    assert (C.uniforms(np.arange(5, 9), np.arange(20), 1, "a") == u[5:9]).all() and not (C.uniforms(np.arange(9), np.arange(20), 1, "b") == u[:9]).any()


def test_draws_of_bootstraps_against_plain_refits(spark):
    rng = np.random.default_rng(6)
    cells = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)], "cell_id long, treated int")
    scores = spark.createDataFrame([(i, p, float(rng.random())) for i in range(60) for p in "ab" if rng.random() < 0.8], "cell_id long, program string, score double")
    for make in (C.bootstrap_labels, C.permuted_labels):
        labels = make(cells, 7)
        got = {(r.draw, r.program): r.beta for r in C.refit_draws(scores, labels).collect()}
        rows_of = labels.collect()
        assert all(sum(r.on[d] for r in rows_of) == 15 for d in range(7)) or make is C.bootstrap_labels
        assert len({tuple(r.on[d] for r in rows_of) for d in range(7)}) == 7
        long = [(d, r.cell_id, side, w[d]) for r in rows_of for side, w in ((1, r.on), (0, r.off)) for d in range(7) if w[d]]
        want = {(r.draw, r.program): r.beta for r in C.refit(scores, spark.createDataFrame(long, "draw int, cell_id long, treated int, weight double")).collect()}
        assert {k for k, v in got.items() if v is not None} == {k for k, v in want.items() if v is not None} and all(got[k] == pytest.approx(want[k]) for k in want if want[k] is not None)
    assert C.permutation_bias(scores, cells.filter("treated = 0"), draws=2).filter("bias IS NOT NULL").count() == 0


def test_replicates_together_and_alone(spark):
    rng = np.random.default_rng(1)
    m = spark.createDataFrame([(i, sorted(rng.choice(8, 4, replace=False).tolist()), rng.random(4).tolist()) for i in range(30)], "cell_id long, idx array<int>, val array<double>")
    for options in ({"rounds": 3}, {"rounds": 2, "loss": "kl", "fraction": 0.6}):
        both = N.factorise_all(m, 8, [(2, 1), (3, 5)], **options)
        assert [h.shape for h in both] == [(2, 8), (3, 8)]
        for h, (k, seed) in zip(both, [(2, 1), (3, 5)], strict=True):
            assert np.allclose(h, N.factorise(m.repartition(3), 8, k, seed, **options))
    out = N.replicates(m, 8, [2], 2, rounds=2)
    assert N.replicates(m, 8, [2], 2, done=out, rounds=2) is out and out.count() == 2 * 2 * 8


def test_weighted_gene_tests_against_dense_least_squares(spark):
    rng = np.random.default_rng(12)
    n, m = 70, 45
    side = (np.arange(n) % 3 == 0).astype(int)
    counts = rng.poisson(rng.gamma(1.0, 3.0, m)[None] * rng.gamma(5, 0.2, n)[:, None] * np.where(side[:, None] * (np.arange(m) < 5), 3, 1))
    counts[:, 0] += 1
    expr = spark.createDataFrame([(i, g, float(counts[i, g])) for i in range(n) for g in range(m) if counts[i, g]], "cell_id long, gene_id long, count double")
    cells = spark.createDataFrame([(i, int(side[i])) for i in range(n)], "cell_id long, treated int")
    got = {r.gene_id: r for r in C.gene_tests(expr, cells, weighted=True, moderated=False).collect()}
    total = counts.sum(1)
    v, lib = np.log2((counts + 0.5) / (total[:, None] + 1) * 1e6), np.log2(total + 1) - np.log2(1e6)
    means = np.stack([v[side == t].mean(0) for t in (0, 1)])
    s2 = sum(((v[side == t] - means[t]) ** 2).sum(0) for t in (0, 1)) / (n - 2)
    genes = [g for g in range(m) if counts[:, g].any()]
    x, y = C.deviation_trend(spark.createDataFrame([(float(v[:, g].mean() + lib.mean()), float(s2[g])) for g in genes], "x double, s2 double"))
    for g in genes:
        w = np.interp(means[side, g] + lib, x, y) ** -4.0
        d = np.c_[np.ones(n), side] * np.sqrt(w)[:, None]
        beta, rest, _, _ = np.linalg.lstsq(d, v[:, g] * np.sqrt(w), rcond=None)
        s = rest[0] / (n - 2)
        t = beta[1] / np.sqrt(s * np.linalg.inv(d.T @ d)[1, 1])
        assert got[g].beta == pytest.approx(beta[1], rel=1e-6, abs=1e-9) and got[g].t == pytest.approx(t, rel=1e-6, abs=1e-6)
    kept = C.gene_tests(expr, cells, least_count=20, least_cells=10).select("gene_id").collect()
    assert {r.gene_id for r in kept} == {g for g in genes if counts[:, g].sum() >= 20 and (counts[:, g] > 0).sum() >= 10}


def test_hurdle_without_covariates_by_hand(spark):
    rng = np.random.default_rng(3)
    t = np.arange(300) % 2
    y = np.where(rng.random(300) < np.where(t == 1, 0.7, 0.4), rng.gamma(2, 1e-5, 300) * (1 + t), 0.0)
    df = spark.createDataFrame([("k", i, int(t[i]), float(y[i])) for i in range(300)], "k string, cell_id long, treated int, y double")
    r = C.hurdle(df, ["k"], "y", []).first()
    v, p = np.log1p(1e6 * y), [np.mean(y[t == s] > 0) for s in (0, 1)]
    m = [v[(t == s) & (y > 0)].mean() for s in (0, 1)]
    assert r.logit == pytest.approx(np.log(p[1] / (1 - p[1])) - np.log(p[0] / (1 - p[0])), abs=1e-4)
    assert r.positive == pytest.approx(m[1] - m[0]) and r.ame == pytest.approx(p[1] * m[1] - p[0] * m[0], abs=1e-4)
    # delta method, from independent halves: Var(p m) = m^2 p (1 - p) / n + p^2 s^2 / n_positive
    s2 = sum(((v[(t == s) & (y > 0)] - m[s]) ** 2).sum() for s in (0, 1)) / ((y > 0).sum() - 2)
    var = sum(m[s] ** 2 * p[s] * (1 - p[s]) / 150 + p[s] ** 2 * s2 / ((t == s) & (y > 0)).sum() for s in (0, 1))
    assert r.se == pytest.approx(np.sqrt(var), rel=1e-3)


def test_consensus_of_planted_programs(spark):
    rng = np.random.default_rng(4)
    base = np.array([[5, 4, 3, 0, 0, 1], [0, 1, 0, 6, 2, 2]], float)
    rows = [(i, c, d, float(max(0.0, base[c, d] * (i + 1) + rng.normal(0, 0.01)))) for i in range(6) for c in range(2) for d in range(6)]
    rows += [(9, 0, d, float(d == 1)) for d in range(6)] + [(9, 1, d, 0.0) for d in range(6)]  # an outlier and a zero spectrum
    got = N.consensus(spark.createDataFrame(rows, "replicate int, component int, dim int, value double"), 2, threshold=0.5).collect()
    found = {label: [r["median"] for r in sorted((x for x in got if x.label == label), key=lambda x: x.dim)] for label in (0, 1)}
    want = base / base.sum(1, keepdims=True)
    assert len(got) == 12 and min(np.abs(np.array([found[0], found[1]]) - want).max(), np.abs(np.array([found[1], found[0]]) - want).max()) < 0.02


def test_components_of_expression(spark):
    rng = np.random.default_rng(5)
    x = rng.random((40, 6)) * (rng.random((40, 6)) < 0.7)
    m = spark.createDataFrame([(i, [j for j in range(6) if x[i, j]], [float(v) for v in x[i] if v]) for i in range(40)], "cell_id long, idx array<int>, val array<double>")
    got = np.array([r.pc for r in N.pca(m, 6, 3).orderBy("cell_id").collect()])
    _, _, axes = np.linalg.svd(x - x.mean(0))
    assert np.allclose(np.abs(got), np.abs(x @ axes[:3].T), atol=1e-6)


def test_usages_of_fixed_spectra(spark):
    h = np.array([[1.0, 2, 0, 0], [0, 0, 3, 1]])
    w = np.array([[2.0, 0.5], [0.1, 4], [1, 1]])
    m = spark.createDataFrame([(i, list(range(4)), row.tolist()) for i, row in enumerate(w @ h)], "cell_id long, idx array<int>, val array<double>")
    for loss in ("frobenius", "kl"):
        got = np.array([r.usage for r in N.usages(m, h, loss).orderBy("cell_id").collect()])
        assert np.allclose(got, w, atol=1e-3)
