"""Queries of association tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import association as A
from sparkloom.operators.ranking import benjamini_hochberg, storey, storey_steps
from sparkloom.plans.registry import register
from sparkloom.plans.sqlmath import chi2_p, normal_p
from sparkloom.sources.tables import CONTROL, ScreenE, ScreenL

R = 6


def rounded(df, *names, digits: int = R):
    return df.withColumns({n: F.round(n, digits) for n in names})


#: Mann-Whitney by counting pairs: test and reference rows of a condition and program joined with each other.
UTEST = {
    "scores": "SELECT u.cell_id, u.program, u.score, c.condition AS sample FROM usage_e u JOIN cells_e c USING (cell_id)",
    "refs": "SELECT s.* FROM scores s WHERE cell_id IN (SELECT cell_id FROM cell_target_e WHERE target = 'non-targeting')",
    "tests": "SELECT s.*, t.target AS label FROM scores s JOIN cell_target_e t USING (cell_id) WHERE t.target <> 'non-targeting'",
    "pairs": "SELECT t.sample, t.program, t.label, sum(CASE WHEN t.score > r.score THEN 1.0 WHEN t.score = r.score THEN 0.5 ELSE 0 END) AS u FROM tests t JOIN refs r USING (sample, program) GROUP BY ALL",
    "means": "SELECT t.sample, t.program, t.label, avg(score) AS test_mean, count(*) AS n_test FROM tests t GROUP BY ALL",
    "ref_means": "SELECT sample, program, avg(score) AS ref_mean, count(*) AS n_ref FROM refs GROUP BY ALL",
    "ties": "SELECT sample, program, label, sum(c * c * c - c) AS ties FROM (SELECT sample, program, label, score, count(*)::DOUBLE AS c FROM (SELECT sample, program, label, score FROM tests UNION ALL SELECT r.sample, r.program, l.label, r.score FROM refs r JOIN (SELECT DISTINCT sample, program, label FROM tests) l USING (sample, program)) GROUP BY ALL) GROUP BY ALL",
    "utest": f"SELECT *, least(1.0, {normal_p('greatest(z, 0)')}) AS pval FROM (SELECT *, log2((test_mean + 1e-9) / (ref_mean + 1e-9)) AS log2FC, (greatest(u, n_test * n_ref - u) - n_test * n_ref / 2.0 - 0.5) / sqrt(n_test * n_ref / 12.0 * (n_test + n_ref + 1 - ties / ((n_test + n_ref) * (n_test + n_ref - 1.0)))) AS z FROM pairs JOIN means USING (sample, program, label) JOIN ref_means USING (sample, program) JOIN ties USING (sample, program, label))",
    "adjusted": "SELECT *, least(1.0, min(pval * m / k) OVER (PARTITION BY sample ORDER BY k DESC)) AS adj_pval FROM (SELECT *, count(*) OVER (PARTITION BY sample) AS m, row_number() OVER (PARTITION BY sample ORDER BY pval, label, program) AS k FROM utest)",
}
UTEST_OUT = "SELECT sample, label AS target_name, program AS program_name, n_ref, n_test, round(ref_mean, 6) AS ref_mean, round(test_mean, 6) AS test_mean, round(log2FC, 6) AS log2FC, u AS stat, round(z, 6) AS z, round(pval, 5) AS pval, round(adj_pval, 5) AS adj_pval FROM adjusted"


def _utest(s: ScreenE, **options):
    return A.perturbation_association(s.usage, s.cells, s.assignment, s.guides, [CONTROL], **options)


@register("perturb_utest", UTEST_OUT, UTEST)
def perturb_utest(spark, sf_dir):
    out = rounded(rounded(_utest(ScreenE(spark, sf_dir)), "ref_mean", "test_mean", "log2FC", "z"), "pval", "adj_pval", digits=5)
    return out.select("sample", "target_name", "program_name", "n_ref", "n_test", "ref_mean", "test_mean", "log2FC", "stat", "z", "pval", "adj_pval")


GUIDE = UTEST | {"tests": "SELECT s.*, g.guide_name AS label FROM scores s JOIN assign_e a USING (cell_id) JOIN guides_e g USING (guide_name) WHERE g.target <> 'non-targeting'"}


@register("perturb_utest_guide", "SELECT sample, label AS target_name, program AS program_name, u AS stat, round(z, 6) AS z FROM utest", GUIDE)
def perturb_utest_guide(spark, sf_dir):
    return rounded(_utest(ScreenE(spark, sf_dir), collapse_targets=False), "z").select("sample", "target_name", "program_name", "stat", "z")


BALANCED = UTEST | {
    "sizes": "SELECT sample, label, count(DISTINCT cell_id) AS size FROM tests GROUP BY ALL",
    "drawn": "SELECT sample, label, cell_id FROM (SELECT r.sample, z.label, r.cell_id, z.size, row_number() OVER (PARTITION BY r.sample, z.label ORDER BY md5('7|' || z.label || '|' || r.cell_id), r.cell_id) AS k FROM (SELECT DISTINCT sample, cell_id FROM refs) r JOIN sizes z USING (sample)) WHERE k <= size",
    "balanced": "SELECT r.sample, r.program, d.label, r.score FROM refs r JOIN drawn d USING (sample, cell_id)",
}


@register("perturb_utest_balanced", "SELECT t.sample, t.label AS target_name, t.program AS program_name, sum(CASE WHEN t.score > r.score THEN 1.0 WHEN t.score = r.score THEN 0.5 ELSE 0 END) AS stat, count(DISTINCT t.cell_id) AS n_test FROM tests t JOIN balanced r USING (sample, program, label) GROUP BY ALL", BALANCED)
def perturb_utest_balanced(spark, sf_dir):
    return _utest(ScreenE(spark, sf_dir), balanced_seed=7).select("sample", "target_name", "program_name", "stat", "n_test")


@register("fdr_bh", "SELECT sample, label AS target_name, program AS program_name, round(least(1.0, min(p * m / k) OVER (PARTITION BY sample ORDER BY k DESC)), 9) AS adj_pval FROM (SELECT *, count(*) OVER (PARTITION BY sample) AS m, row_number() OVER (PARTITION BY sample ORDER BY p, label, program) AS k FROM (SELECT *, round(pval, 4) AS p FROM utest))", UTEST)
def fdr_bh(spark, sf_dir):
    p = _utest(ScreenE(spark, sf_dir)).withColumn("p", F.round("pval", 4))
    return rounded(benjamini_hochberg(p, ["sample"], "p", "adj_pval", ["target_name", "program_name"]).select("sample", "target_name", "program_name", "adj_pval"), "adj_pval", digits=9)


@register("fdr_storey", "SELECT sample, label AS target_name, program AS program_name, round(least(1.0, pi0 * least(1.0, min(p * m / k) OVER (PARTITION BY sample ORDER BY k DESC))), 9) AS qval FROM (SELECT *, count(*) OVER (PARTITION BY sample) AS m, least(1.0, (count(*) FILTER (WHERE p > 0.5) OVER (PARTITION BY sample)) / (0.5 * count(*) OVER (PARTITION BY sample))) AS pi0, row_number() OVER (PARTITION BY sample ORDER BY p, label, program) AS k FROM (SELECT *, round(pval, 4) AS p FROM utest))", UTEST)
def fdr_storey(spark, sf_dir):
    p = _utest(ScreenE(spark, sf_dir)).withColumn("p", F.round("pval", 4))
    return rounded(storey(p, ["sample"], "p", "qval", 0.5, ["target_name", "program_name"]).select("sample", "target_name", "program_name", "qval"), "qval", digits=9)


SMOOTH = UTEST | {
    "rounded_p": "SELECT *, round(pval, 4) AS p FROM utest",
    "nulls": f"SELECT sample, avg(list_extract({storey_steps()}::DOUBLE[], 1 + len(list_filter(range(0, 96), lambda i: i * 0.01::DOUBLE < p)))) AS pi0 FROM rounded_p GROUP BY sample",
}


@register("fdr_storey_smooth", "SELECT sample, label AS target_name, program AS program_name, round(least(1.0, CASE WHEN pi0 BETWEEN 0 AND 1 THEN pi0 ELSE 1 END * least(1.0, min(p * m / k) OVER (PARTITION BY sample ORDER BY k DESC))), 9) AS qval FROM (SELECT *, count(*) OVER (PARTITION BY sample) AS m, row_number() OVER (PARTITION BY sample ORDER BY p, label, program) AS k FROM rounded_p JOIN nulls USING (sample))", SMOOTH)
def fdr_storey_smooth(spark, sf_dir):
    p = _utest(ScreenE(spark, sf_dir)).withColumn("p", F.round("pval", 4))
    return rounded(storey(p, ["sample"], "p", "qval", ties=["target_name", "program_name"]).select("sample", "target_name", "program_name", "qval"), "qval", digits=9)


RANKS = {
    "labelled": "SELECT u.program, u.score, c.category FROM usage_e u JOIN cells_e c USING (cell_id)",
    "ranked": "SELECT *, rank() OVER (PARTITION BY program ORDER BY score) + (count(*) OVER (PARTITION BY program, score) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY program, score) AS t FROM labelled",
    "by_group": "SELECT program, category, count(*)::DOUBLE AS n, sum(r) AS s FROM ranked GROUP BY ALL",
    "whole": "SELECT program, count(*)::DOUBLE AS n_all, count(DISTINCT category) AS g, sum(r * r) AS squares, sum(t * t - 1.0) AS ties FROM ranked GROUP BY ALL",
    "kw": "SELECT program, g, (12 / (n_all * (n_all + 1)) * sum(s * s / n) - 3 * (n_all + 1)) / (1 - any_value(ties) / (n_all * n_all * n_all - n_all)) AS h FROM by_group JOIN whole USING (program) GROUP BY program, g, n_all",
}


def _labelled(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    return s.usage.join(s.cells, "cell_id")


@register("kruskal_wallis", f"SELECT program, round(h, 6) AS stat, round({chi2_p('h', '(g - 1)')}, 6) AS pval FROM kw", RANKS)
def kruskal_wallis(spark, sf_dir):
    return rounded(A.kruskal_wallis(_labelled(spark, sf_dir), "category"), "stat", "pval")


PAIRS = "FROM by_group a JOIN by_group b ON a.program = b.program AND a.category < b.category JOIN whole w ON w.program = a.program JOIN kw k ON k.program = a.program"
DUNN_Z = "(a.s / a.n - b.s / b.n) / sqrt((n_all * (n_all + 1) / 12 - ties / (12 * (n_all - 1))) * (1 / a.n + 1 / b.n))"


@register("posthoc_dunn", f"SELECT program, group_a, group_b, round(z, 6) AS stat, round({normal_p('z')}, 6) AS pval FROM (SELECT a.program, a.category AS group_a, b.category AS group_b, {DUNN_Z} AS z {PAIRS})", RANKS)
def posthoc_dunn(spark, sf_dir):
    return rounded(A.posthoc(_labelled(spark, sf_dir), "category"), "stat", "pval")


@register("posthoc_conover", f"SELECT a.program, a.category AS group_a, b.category AS group_b, round((a.s / a.n - b.s / b.n) / sqrt((squares - n_all * (n_all + 1) * (n_all + 1) / 4) / (n_all - 1) * (n_all - 1 - h) / (n_all - w.g) * (1 / a.n + 1 / b.n)), 6) AS stat {PAIRS}", RANKS)
def posthoc_conover(spark, sf_dir):
    return rounded(A.posthoc(_labelled(spark, sf_dir), "category", test="conover").drop("pval"), "stat")


DSCF = {
    "three": "SELECT u.program, u.score, c.condition FROM usage_e u JOIN cells_e c USING (cell_id)",
    "pair_rows": "SELECT p.program, p.a, p.b, t.condition, t.score FROM (SELECT DISTINCT x.program, x.condition AS a, y.condition AS b FROM three x JOIN three y ON x.program = y.program AND x.condition < y.condition) p JOIN three t ON t.program = p.program AND t.condition IN (p.a, p.b)",
    "pair_ranks": "SELECT *, rank() OVER (PARTITION BY program, a, b ORDER BY score) + (count(*) OVER (PARTITION BY program, a, b, score) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY program, a, b, score) AS t FROM pair_rows",
    "pair_sums": "SELECT program, a, b, (count(*) FILTER (WHERE condition = a))::DOUBLE AS n, (count(*) FILTER (WHERE condition = b))::DOUBLE AS m, sum(r) FILTER (WHERE condition = a) AS w, sum(t * t - 1.0) AS ties FROM pair_ranks GROUP BY ALL",
}


@register("posthoc_dscf", "SELECT program, a AS group_a, b AS group_b, round(abs(w - n * (n + m + 1) / 2) / sqrt(n * m / 24 * (n + m + 1 - ties / ((n + m) * (n + m - 1)))), 6) AS stat FROM pair_sums", DSCF)
def posthoc_dscf(spark, sf_dir):
    return rounded(A.posthoc(_labelled(spark, sf_dir), "condition", test="dscf").drop("pval"), "stat")


@register("posthoc_summary", f'SELECT program, "group", round(min(p), 5) AS min_pval, round(avg(p), 5) AS mean_pval FROM (SELECT program, unnest([group_a, group_b]) AS "group", p FROM (SELECT program, group_a, group_b, {normal_p("z")} AS p FROM (SELECT a.program, a.category AS group_a, b.category AS group_b, {DUNN_Z} AS z {PAIRS}))) GROUP BY ALL', RANKS)
def posthoc_summary(spark, sf_dir):
    return rounded(A.pairwise_summary(A.posthoc(_labelled(spark, sf_dir), "category"), ["program"]), "min_pval", "mean_pval", digits=5)


@register("pseudobulk_mean", "SELECT program, condition, category, round(avg(score), 9) AS score FROM usage_e JOIN cells_e USING (cell_id) GROUP BY ALL")
def pseudobulk_mean(spark, sf_dir):
    return rounded(A.pseudobulk(_labelled(spark, sf_dir), "condition", "category", least=1), "score", digits=9)


@register("pearson_one_vs_all", "SELECT u.program, g.category, round(corr(score, CASE WHEN c.category = g.category THEN 1 ELSE 0 END), 6) AS stat, round(log2(avg(score) FILTER (WHERE c.category = g.category) / avg(score) FILTER (WHERE c.category <> g.category)), 6) AS log2FC FROM usage_e u JOIN cells_e c USING (cell_id), (SELECT DISTINCT category FROM cells_e) g GROUP BY ALL")
def pearson_one_vs_all(spark, sf_dir):
    return rounded(A.correlate_one_vs_all(_labelled(spark, sf_dir), "category").drop("pval"), "stat", "log2FC")


@register("pearson_one_vs_one", "SELECT u.program, p.a AS group_a, p.b AS group_b, round(corr(score, CASE WHEN c.category = p.b THEN 1 ELSE 0 END), 6) AS stat FROM usage_e u JOIN cells_e c USING (cell_id) JOIN (SELECT DISTINCT x.category AS a, y.category AS b FROM cells_e x, cells_e y WHERE x.category < y.category) p ON c.category IN (p.a, p.b) GROUP BY ALL")
def pearson_one_vs_one(spark, sf_dir):
    return rounded(A.correlate_one_vs_one(_labelled(spark, sf_dir), "category").drop("pval"), "stat")


CODED = {"coded": "SELECT u.program, u.score, CAST(substring(c.category, 2) AS INTEGER) AS code FROM usage_e u JOIN cells_e c USING (cell_id)"}


def _coded(spark, sf_dir):
    return _labelled(spark, sf_dir).withColumn("code", F.substring("category", 2, 9).cast("int"))


@register("spearman", "SELECT program, round(corr(x, y), 6) AS stat FROM (SELECT program, rank() OVER (PARTITION BY program ORDER BY score) + (count(*) OVER (PARTITION BY program, score) - 1) / 2.0 AS x, rank() OVER (PARTITION BY program ORDER BY code) + (count(*) OVER (PARTITION BY program, code) - 1) / 2.0 AS y FROM coded) GROUP BY program", CODED)
def spearman(spark, sf_dir):
    return rounded(A.spearman(_coded(spark, sf_dir), "score", "code").drop("pval"), "stat")


@register("kendall", "SELECT a.program, round(sum(sign(a.score - b.score) * sign(a.code - b.code)) / sqrt(sum(abs(sign(a.score - b.score)))::DOUBLE * sum(abs(sign(a.code - b.code)))), 6) AS stat FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score, code) AS i FROM coded) a JOIN (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score, code) AS i FROM coded) b ON a.program = b.program AND a.i < b.i GROUP BY a.program", CODED)
def kendall(spark, sf_dir):
    return rounded(A.kendall(_coded(spark, sf_dir), "score", "code").drop("pval"), "stat")


#: Every program's scores beside those of program 0, all distinct; the p-value has no ties then.
BESIDE = {
    "beside": "SELECT u.cell_id, u.program, u.score, v.score AS other FROM usage_e u JOIN usage_e v USING (cell_id) WHERE v.program = '0'",
    "orders": "SELECT a.program, sum(sign(a.score - b.score) * sign(a.other - b.other)) AS s, sum(abs(sign(a.score - b.score)))::DOUBLE AS px, sum(abs(sign(a.other - b.other)))::DOUBLE AS py FROM beside a JOIN beside b ON a.program = b.program AND a.cell_id < b.cell_id GROUP BY a.program",
}


@register("kendall_programs", "SELECT program, round(s / sqrt(px * py), 6) AS stat FROM orders", BESIDE)
def kendall_programs(spark, sf_dir):
    usage = ScreenE(spark, sf_dir).usage
    other = usage.filter("program = '0'").select("cell_id", F.col("score").alias("other"))
    return rounded(A.kendall(usage.join(other, "cell_id"), "score", "other").drop("pval"), "stat")
