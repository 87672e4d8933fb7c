"""Queries of similarity, explained variance and stability."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import similarity as S
from sparkloom.operators.ranking import top_k
from sparkloom.plans.association import rounded
from sparkloom.plans.registry import register
from sparkloom.sources.tables import ScreenE, ScreenL

#: Two runs of programs: loadings of lines shipped with odd and even line numbers.
RUNS = {f"run{i}": f"SELECT CAST(s_nationkey AS VARCHAR) AS program, l_partkey AS gene_id, sum(l_quantity) AS score FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber % 2 = {i} GROUP BY ALL" for i in (0, 1)}
FULL = RUNS | {
    "genes": "SELECT gene_id FROM run0 UNION SELECT gene_id FROM run1",
    **{f"full{i}": f"SELECT p.program, g.gene_id, coalesce(r.score, 0) AS score FROM (SELECT DISTINCT program FROM run{i}) p CROSS JOIN (SELECT gene_id FROM genes) g LEFT JOIN run{i} r ON r.program = p.program AND r.gene_id = g.gene_id" for i in (0, 1)},
}


def runs(spark, sf_dir):
    lines = ScreenL(spark, sf_dir)._lines
    return [lines.filter(F.col("l_linenumber") % 2 == i).groupBy(F.col("s_nationkey").cast("string").alias("program"), F.col("l_partkey").alias("gene_id")).agg(F.sum("l_quantity").alias("score")) for i in (0, 1)]


@register("program_correlation", "SELECT a.program AS a, b.program AS b, round(corr(a.score, b.score), 6) AS r FROM full0 a JOIN full1 b USING (gene_id) GROUP BY a.program, b.program", FULL)
def program_correlation(spark, sf_dir):
    return rounded(S.correlation(*runs(spark, sf_dir), "program", "gene_id", "score"), "r")


@register("program_distance", "SELECT a.program AS a, b.program AS b, round(sqrt(sum((a.score - b.score) * (a.score - b.score))), 5) AS d FROM full0 a JOIN full1 b USING (gene_id) GROUP BY a.program, b.program", FULL)
def program_distance(spark, sf_dir):
    return rounded(S.distance(*runs(spark, sf_dir), "program", "gene_id", "score"), "d", digits=5)


TOPS = RUNS | {f"top{i}": f"SELECT program, gene_id FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS k FROM run{i}) WHERE k <= 100" for i in (0, 1)}


@register("top_gene_overlap", "SELECT a.program AS a, b.program AS b, count(*) FILTER (WHERE a.gene_id = b.gene_id) AS n, count(*) FILTER (WHERE a.gene_id = b.gene_id) / 100 AS share FROM top0 a CROSS JOIN (SELECT * FROM top1) b GROUP BY a.program, b.program", TOPS)
def top_gene_overlap(spark, sf_dir):
    return S.top_overlap(*runs(spark, sf_dir), 100, percentage=True)


@register("jaccard_matrix", "SELECT a.program_name AS a, b.program_name AS b, round(count(*) FILTER (WHERE a.target_name = b.target_name) / (any_value(a.n) + any_value(b.n) - count(*) FILTER (WHERE a.target_name = b.target_name)), 9) AS jaccard FROM hits a, hits b WHERE a.sample = 'c0' AND b.sample = 'c1' GROUP BY a.program_name, b.program_name", {"hits": "SELECT program_name, target_name, sample, count(*) OVER (PARTITION BY program_name, sample) AS n FROM assoc WHERE adj_pval < 0.1"})
def jaccard_matrix(spark, sf_dir):
    hits = ScreenL(spark, sf_dir).assoc.filter("adj_pval < 0.1")
    return rounded(S.jaccard(hits.filter("sample = 'c0'"), hits.filter("sample = 'c1'"), "program_name", "target_name"), "jaccard", digits=9)


ALIGN = TOPS | {
    "overlap": "SELECT a.program AS a, b.program AS b, count(*) FILTER (WHERE a.gene_id = b.gene_id) AS n FROM top0 a CROSS JOIN (SELECT * FROM top1) b GROUP BY a.program, b.program",
    "numbered": "SELECT *, dense_rank() OVER (ORDER BY a) - 1 AS i, dense_rank() OVER (ORDER BY b) - 1 AS j FROM overlap",
    "peaked": "SELECT *, first_value(j) OVER (PARTITION BY a ORDER BY n DESC, j) AS peak, max(n) OVER (PARTITION BY a) AS best FROM numbered",
}


@register("diagonal_alignment", 'SELECT a, b, n, i, best, (j + i - peak + m) % m AS "column" FROM peaked CROSS JOIN (SELECT count(DISTINCT b) AS m FROM overlap)', ALIGN)
def diagonal_alignment(spark, sf_dir):
    return S.align_diagonal(S.top_overlap(*runs(spark, sf_dir), 100), "n")


@register("program_cell_correlation", "SELECT x.program AS a, y.program AS b, round(coalesce(corr(x.score, y.score), 0), 6) AS r FROM signed_e x JOIN signed_e y USING (cell_id) GROUP BY ALL")
def program_cell_correlation(spark, sf_dir):
    u = ScreenE(spark, sf_dir).signed
    return rounded(S.correlation(u, u, "program", "cell_id", "score").fillna(0.0, ["r"]), "r")


GENES = {"dense": "SELECT g.gene_id, p.program, coalesce(f.score, 0) AS score FROM (SELECT DISTINCT gene_id FROM loading_l) g CROSS JOIN (SELECT DISTINCT program FROM loading_l) p LEFT JOIN loading_l f ON f.gene_id = g.gene_id AND f.program = p.program"}


@register("gene_correlation", "SELECT x.gene_id AS a, y.gene_id AS b, round(coalesce(corr(x.score, y.score), 0), 5) AS r FROM dense x JOIN dense y USING (program) GROUP BY ALL", GENES)
def gene_correlation(spark, sf_dir):
    loading = ScreenL(spark, sf_dir).loading
    return rounded(S.correlation_in_blocks(loading, "gene_id", "program", "score").fillna(0.0, ["r"]), "r", digits=5)


PROFILE = {"profile": "SELECT x.target_name AS a, y.target_name AS b, corr(x.v, CASE WHEN x.target_name <> y.target_name THEN y.v END) AS r FROM (SELECT target_name, program_name, avg(log2FC) AS v FROM assoc GROUP BY ALL) x JOIN (SELECT target_name, program_name, avg(log2FC) AS v FROM assoc GROUP BY ALL) y USING (program_name) GROUP BY ALL"}


def _profile(spark, sf_dir):
    return S.profile_correlation(ScreenL(spark, sf_dir).assoc, "target_name", "program_name")


@register("profile_correlation", "SELECT a, b, round(r, 6) AS r FROM profile", PROFILE)
def profile_correlation(spark, sf_dir):
    return rounded(_profile(spark, sf_dir), "r")


@register("program_profile_correlation", "SELECT x.program_name AS a, y.program_name AS b, round(corr(x.v, CASE WHEN x.program_name <> y.program_name THEN y.v END), 6) AS r FROM (SELECT target_name, program_name, avg(log2FC) AS v FROM assoc GROUP BY ALL) x JOIN (SELECT target_name, program_name, avg(log2FC) AS v FROM assoc GROUP BY ALL) y USING (target_name) GROUP BY ALL")
def program_profile_correlation(spark, sf_dir):
    return rounded(S.profile_correlation(ScreenL(spark, sf_dir).assoc, "program_name", "target_name"), "r")


@register("nearest_entities", "SELECT a, b, round(r, 6) AS r, sign, rank FROM (SELECT *, row_number() OVER (PARTITION BY a, sign ORDER BY abs(r) DESC, b) AS rank FROM (SELECT a, b, r, CAST(sign(r) AS INTEGER) AS sign FROM profile WHERE r IS NOT NULL AND r <> 0)) WHERE rank <= 5", PROFILE)
def nearest_entities(spark, sf_dir):
    return rounded(S.nearest(_profile(spark, sf_dir), 5), "r")


@register("waterfall", "SELECT a, b, round(r, 6) AS r, rank, CASE WHEN rank <= 3 THEN 'top' WHEN up <= 3 THEN 'bottom' ELSE '' END AS flag FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY r DESC, b) AS rank, row_number() OVER (PARTITION BY a ORDER BY r, b DESC) AS up FROM profile WHERE r IS NOT NULL)", PROFILE)
def waterfall(spark, sf_dir):
    return rounded(S.waterfall(_profile(spark, sf_dir), 3), "r")


@register("count_variation", "SELECT program_name, round(stddev_pop(n) / avg(n), 6) AS cv FROM (SELECT program_name, sample, count(*) AS n FROM assoc WHERE adj_pval < 0.1 GROUP BY ALL) GROUP BY program_name")
def count_variation(spark, sf_dir):
    n = ScreenL(spark, sf_dir).assoc.filter("adj_pval < 0.1").groupBy("program_name", "sample").agg(F.count("*").alias("n"))
    return rounded(S.variation_across(n, "program_name", "n"), "cv")


@register("block_means", "SELECT CAST(l_suppkey // 10 AS BIGINT) AS i, CAST(l_partkey // 100 AS BIGINT) AS j, CAST(trunc(avg(l_quantity)) AS BIGINT) AS mean FROM lineitem GROUP BY ALL")
def block_means(spark, sf_dir):
    return S.block_means(ScreenL(spark, sf_dir).table("lineitem"), "l_suppkey", "l_partkey", "l_quantity", 10, 100)


@register("top_genes", "SELECT program, gene_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM loading_l) WHERE rank <= 50")
def top_genes(spark, sf_dir):
    return top_k(ScreenL(spark, sf_dir).loading, ["program"], [F.desc("score"), F.asc("gene_id")], 50)


VARIANCE = {
    "ncells": "SELECT count(DISTINCT cell_id)::DOUBLE AS n FROM expr_l",
    "hn": "SELECT program, gene_id, score / sum(score) OVER (PARTITION BY gene_id) AS h FROM loading_l",
    "varx": "SELECT sum(v) AS var_x FROM (SELECT (sum(count * count) - sum(count) * sum(count) / any_value(n.n)) / (any_value(n.n) - 1) AS v FROM expr_l CROSS JOIN (SELECT * FROM ncells) n GROUP BY gene_id)",
    "proj": "SELECT program, cell_id, sum(count * h) AS s FROM expr_l JOIN hn USING (gene_id) GROUP BY ALL",
}


@register("explained_variance", "SELECT p.program, round((sum(s * s) - sum(s) * sum(s) / any_value(n.n)) / (any_value(n.n) - 1) * (2 / any_value(norm) - 1) / any_value(var_x), 6) AS explained FROM proj p JOIN (SELECT program, sqrt(sum(h * h)) AS norm FROM hn GROUP BY program) q USING (program) CROSS JOIN (SELECT * FROM ncells) n CROSS JOIN (SELECT * FROM varx) GROUP BY p.program", VARIANCE)
def explained_variance(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    n = s.expr.select("cell_id").distinct().count()
    return rounded(S.explained_variance(s.expr, s.loading, n), "explained")


@register("variance_summary", "SELECT round(sum(e), 5) AS total, round(median(e), 6) AS median, round(max(e), 6) AS max FROM (SELECT (sum(s * s) - sum(s) * sum(s) / any_value(n.n)) / (any_value(n.n) - 1) * (2 / any_value(norm) - 1) / any_value(var_x) AS e FROM proj p JOIN (SELECT program, sqrt(sum(h * h)) AS norm FROM hn GROUP BY program) q USING (program) CROSS JOIN (SELECT * FROM ncells) n CROSS JOIN (SELECT * FROM varx) GROUP BY p.program)", VARIANCE)
def variance_summary(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    e = S.explained_variance(s.expr, s.loading, s.expr.select("cell_id").distinct().count())
    return e.agg(F.round(F.sum("explained"), 5).alias("total"), F.round(F.median("explained"), 6).alias("median"), F.round(F.max("explained"), 6).alias("max"))


ERROR = {
    "small": "SELECT cell_id, gene_id, count FROM expr_l",
    "w": "SELECT cell_id, program, score / 1e5 AS w FROM usage_l",
    "h": "SELECT program, gene_id, score / 100 AS h FROM loading_l",
    "dense": "SELECT coalesce(p.cell_id, x.cell_id) AS cell_id, coalesce(p.gene_id, x.gene_id) AS gene_id, coalesce(x.count, 0) - coalesce(p.v, 0) AS d FROM (SELECT cell_id, gene_id, sum(w * h) AS v FROM w JOIN h USING (program) GROUP BY ALL) p FULL JOIN small x ON p.cell_id = x.cell_id AND p.gene_id = x.gene_id",
}


@register("reconstruction_error", "SELECT round(sum(d * d), 2) AS error FROM dense", ERROR)
def reconstruction_error(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    w = s.usage.withColumn("score", F.col("score") / 1e5)
    return rounded(S.reconstruction_error(s.expr, w, s.loading.withColumn("score", F.col("score") / 100)), "error", digits=2)


POINTS = {
    "pts": "SELECT vec_id AS id, i AS dim, CAST(embedding[i] AS DOUBLE) AS value, label FROM embeddings, (SELECT unnest(range(1, 65)) AS i)",
    "dist": "SELECT a.id AS a, a.label AS la, b.label AS lb, sqrt(sum((a.value - b.value) * (a.value - b.value))) AS d FROM pts a JOIN pts b ON a.dim = b.dim AND a.id <> b.id GROUP BY a.id, b.id, a.label, b.label",
    "mean_d": "SELECT a, la, lb, avg(d) AS m FROM dist GROUP BY ALL",
    "sides": "SELECT a, la, max(m) FILTER (WHERE la = lb) AS own, min(m) FILTER (WHERE la <> lb) AS other FROM mean_d GROUP BY ALL",
}


def _points(spark, sf_dir):
    e = ScreenE(spark, sf_dir).table("embeddings")
    points = e.select(F.col("vec_id").alias("id"), F.posexplode("embedding").alias("dim", "value")).withColumn("value", F.col("value").cast("double"))
    return points, e.select(F.col("vec_id").alias("id"), "label")


@register("stability_silhouette", "SELECT a AS id, la AS label, round(CASE WHEN own IS NULL OR other IS NULL THEN 0 ELSE (other - own) / greatest(own, other) END, 6) AS silhouette FROM sides", POINTS)
def stability_silhouette(spark, sf_dir):
    return rounded(S.silhouette(*_points(spark, sf_dir)), "silhouette")


def _cluster_medians(points, labels):
    return rounded(S.cluster_medians(points.withColumn("value", F.col("value") * F.col("value")), labels), "median")


@register("cluster_medians", "SELECT label, dim, round(m / sum(m) OVER (PARTITION BY label), 6) AS median FROM (SELECT label, dim - 1 AS dim, median(value * value) AS m FROM pts GROUP BY label, dim)", POINTS)
def cluster_medians(spark, sf_dir):
    return _cluster_medians(*_points(spark, sf_dir))


def _k_selection(points, labels):
    s = S.silhouette(points, labels)
    return rounded(s.groupBy((F.col("label") % 3).alias("k")).agg(F.avg("silhouette").alias("silhouette")), "silhouette")


@register("k_selection", "SELECT la % 3 AS k, round(avg(CASE WHEN own IS NULL OR other IS NULL THEN 0 ELSE (other - own) / greatest(own, other) END), 6) AS silhouette FROM sides GROUP BY ALL", POINTS)
def k_selection(spark, sf_dir):
    return _k_selection(*_points(spark, sf_dir))
