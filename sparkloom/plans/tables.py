"""Queries of joins, aggregates, windows, specificity and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import tables as D
from sparkloom.operators.association import cells_of_targets, reference_cells
from sparkloom.operators.ranking import top_k
from sparkloom.plans.association import rounded
from sparkloom.plans.registry import register
from sparkloom.sources.tables import CONTROL, ScreenE, ScreenL, Source

SAMPLES = ["c0", "c1", "c2"]
CELL_TARGET_L = {"cell_target_l": "SELECT DISTINCT cell_id, target FROM assign_l JOIN guides_l USING (guide_name)"}


@register("guide_metadata", "SELECT guide_name, target FROM guides_l")
def guide_metadata(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    arrays = s.guides.agg(F.array_sort(F.collect_list(F.struct("guide_name", "target"))).alias("g")).select(F.col("g.guide_name").alias("names"), F.col("g.target").alias("targets"))
    return arrays.select(F.inline(F.arrays_zip(F.col("names").alias("guide_name"), F.col("targets").alias("target")))).toDF("guide_name", "target")


@register("target_cells", "SELECT target, count(*) AS n FROM cell_target_e GROUP BY target")
def target_cells(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    return cells_of_targets(s.assignment, s.guides).groupBy("target").agg(F.count("*").alias("n"))


@register("reference_cells", "SELECT cell_id FROM cell_target_e WHERE target = 'non-targeting'")
def reference(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    return reference_cells(s.assignment, s.guides, [CONTROL])


@register("shared_cells", "SELECT DISTINCT cell_id FROM cells_l SEMI JOIN usage_l USING (cell_id)")
def shared_cells(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    return s.cells.select("cell_id").join(s.usage.select("cell_id").distinct(), "cell_id")


@register("trait_query", "SELECT study, gene_id, trait, pval, n_cases FROM (SELECT t.*, row_number() OVER (PARTITION BY study, gene_id ORDER BY pval, trait) AS k FROM trait t JOIN supplier ON study = s_suppkey JOIN part ON gene_id = p_partkey WHERE p_name NOT LIKE '%raw%' AND p_retailprice > 900 AND n_cases >= 20) WHERE k = 1")
def trait_query(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    t, sup, p = s.trait, s.table("supplier"), s.table("part")
    rows = t.join(sup, t.study == sup.s_suppkey).join(p, t.gene_id == p.p_partkey)
    rows = rows.filter(~F.col("p_name").like("%raw%") & (F.col("p_retailprice") > 900) & (F.col("n_cases") >= 20)).select("study", "gene_id", "trait", "pval", "n_cases")
    return top_k(rows, ["study", "gene_id"], [F.asc("pval"), F.asc("trait")], 1).drop("rank")


@register("trait_metadata_join", "SELECT DISTINCT t.trait, t.study, s_name FROM trait t LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON study = s_suppkey")
def trait_metadata_join(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    meta = s.table("supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("study"), "s_name")
    return s.trait.select("trait", "study").join(meta, "study", "left").distinct()


@register("pvalue_effect_join", "SELECT target_name, program_name, adj_pval AS pval, log2FC AS beta FROM assoc WHERE sample = 'c0'")
def pvalue_effect_join(spark, sf_dir):
    a = ScreenL(spark, sf_dir).assoc.filter("sample = 'c0'")
    programs = [r[0] for r in a.select("program_name").distinct().orderBy("program_name").collect()]  # columns of a wide table
    wide = lambda v: a.groupBy("target_name").pivot("program_name", programs).agg(F.first(v))
    long = lambda df, v: df.unpivot(["target_name"], programs, "program_name", v).filter(F.col(v).isNotNull())
    return long(wide("adj_pval"), "pval").join(long(wide("log2FC"), "beta"), ["target_name", "program_name"])


@register("regulator_edges", "SELECT * FROM (SELECT *, row_number() OVER (ORDER BY n DESC, regulator, gene_id) AS rank FROM (SELECT l_suppkey AS regulator, l_partkey AS gene_id, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey = 3 GROUP BY ALL)) WHERE rank <= 50")
def regulator_edges(spark, sf_dir):
    s = Source(spark, sf_dir)
    li, sup = s.table("lineitem"), s.table("supplier")
    regulators = sup.filter("s_nationkey = 3").select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("r"))
    genes = s.table("part").select(F.concat(F.lit("P"), F.col("p_partkey")).alias("g"))
    edges = li.select(F.concat(F.lit("s"), F.col("l_suppkey")).alias("a"), F.concat(F.lit("p"), F.col("l_partkey")).alias("b"))
    both = edges.union(edges.select("b", "a")).select(F.upper("a").alias("r"), F.upper("b").alias("g"))
    hits = both.join(regulators, "r", "left_semi").join(genes, "g", "left_semi").groupBy("r", "g").agg(F.count("*").alias("n"))
    hits = hits.select(F.substring("r", 2, 20).cast("long").alias("regulator"), F.substring("g", 2, 20).cast("long").alias("gene_id"), "n")
    return hits.orderBy(F.desc("n"), "regulator", "gene_id").limit(50).withColumn("rank", F.row_number().over(D.W.orderBy(F.desc("n"), "regulator", "gene_id")).cast("long"))


@register("unique_not_top", "SELECT program, gene_id FROM (SELECT program, gene_id, row_number() OVER (PARTITION BY program ORDER BY score * ln(((SELECT count(DISTINCT program) FROM loading_l) + 1.0) / (n + 1)) DESC, gene_id) AS u, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS t FROM loading_l JOIN (SELECT gene_id, count(DISTINCT program) AS n FROM loading_l GROUP BY gene_id) USING (gene_id)) WHERE u <= 20 AND t > 20")
def unique_not_top(spark, sf_dir):
    from sparkloom.operators.enrichment import uniqueness

    scored = uniqueness(ScreenL(spark, sf_dir).loading)
    top = top_k(scored, ["program"], [F.desc("score"), F.asc("gene_id")], 20)
    unique = top_k(scored, ["program"], [F.desc("uniqueness"), F.asc("gene_id")], 20)
    return unique.select("program", "gene_id").join(top, ["program", "gene_id"], "left_anti")


@register("mean_by_condition", "SELECT program, condition, round(sum(score) / n, 4) AS mean FROM usage_l JOIN cells_l USING (cell_id) JOIN (SELECT condition, count(*) AS n FROM cells_l GROUP BY condition) USING (condition) GROUP BY program, condition, n")
def mean_by_condition(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    return rounded(D.mean_by_condition(s.usage, s.cells), "mean", digits=4)


@register("fraction_above_mean", "SELECT program, condition, round(avg(CAST(score > m AS INTEGER)), 6) AS fraction FROM (SELECT *, avg(score) OVER (PARTITION BY program, condition) AS m FROM usage_e JOIN cells_e USING (cell_id)) GROUP BY ALL")
def fraction_above_mean(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    return rounded(D.fraction_above_mean(s.usage, s.cells), "fraction")


@register("dot_plot", "SELECT gene_id, condition, round(sum(count) / n, 6) AS mean, round(count(*) FILTER (WHERE count > 0) / n, 6) AS fraction FROM expr_l JOIN cells_l USING (cell_id) JOIN (SELECT condition, count(*)::DOUBLE AS n FROM cells_l GROUP BY condition) USING (condition) GROUP BY gene_id, condition, n")
def dot_plot(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    return rounded(D.dot_plot(s.expr, s.cells, "gene_id", "count"), "mean", "fraction")


@register("cells_per_target", "SELECT target, coalesce(sum(n) FILTER (WHERE condition = 'c0'), 0) AS c0, coalesce(sum(n) FILTER (WHERE condition = 'c1'), 0) AS c1, coalesce(sum(n) FILTER (WHERE condition = 'c2'), 0) AS c2 FROM assign_e JOIN guides_e USING (guide_name) JOIN cells_e USING (cell_id) GROUP BY target")
def cells_per_target(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    return D.cells_per_target(s.assignment, s.guides, s.cells, SAMPLES)


@register("target_gene_expression", "SELECT gene_id, condition, round(sum(count) / n, 6) AS mean FROM expr_l JOIN cells_l USING (cell_id) JOIN (SELECT condition, count(*) AS n FROM cells_l GROUP BY condition) USING (condition) WHERE gene_id IN (SELECT s_suppkey FROM supplier) GROUP BY gene_id, condition, n")
def target_gene_expression(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    own = s.expr.join(s.guides.select(F.col("guide_name").alias("gene_id")).distinct(), "gene_id", "left_semi")
    return rounded(D.dot_plot(own, s.cells, "gene_id", "count").drop("fraction"), "mean")


KD = CELL_TARGET_L | {
    "norm_l": "SELECT cell_id, gene_id, count / sum(count) OVER (PARTITION BY cell_id) * 10000 AS norm FROM expr_l",
    "gene_of": "SELECT target, min(guide_name) AS gene_id FROM guides_l WHERE target <> 'non-targeting' GROUP BY target",
    "member": "SELECT cell_id, target, condition FROM cell_target_l JOIN cells_l USING (cell_id)",
    "kd": "SELECT g.target, c.condition, (SELECT count(*) FROM member m WHERE m.target = g.target AND m.condition = c.condition) AS n, (SELECT count(*) FROM member m WHERE m.target = 'non-targeting' AND m.condition = c.condition) AS n0, coalesce((SELECT sum(norm) FROM member m JOIN norm_l USING (cell_id) WHERE m.target = g.target AND m.condition = c.condition AND gene_id = g.gene_id), 0) AS s, coalesce((SELECT sum(norm) FROM member m JOIN norm_l USING (cell_id) WHERE m.target = 'non-targeting' AND m.condition = c.condition AND gene_id = g.gene_id), 0) AS s0 FROM gene_of g, (SELECT DISTINCT condition FROM cells_l) c",
    "kd_values": "SELECT target, condition, CASE WHEN s0 > 0 AND n0 > 0 AND n > 0 THEN (1 - (s / n) / (s0 / n0)) * 100 END AS kd FROM kd",
}


@register("knockdown", "SELECT target, condition, round(kd, 6) AS kd, round(avg(kd) OVER (PARTITION BY target), 6) AS mean_kd FROM kd_values", KD)
def knockdown(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    gene_of = s.guides.filter(F.col("target") != CONTROL).groupBy("target").agg(F.min("guide_name").alias("gene_id"))
    return rounded(D.knockdown(s.expr, s.cells, s.assignment, s.guides, gene_of, CONTROL), "kd", "mean_kd")


REL = {
    "rel_rows": "SELECT target, program, score, unnest([condition, 'All']) AS condition FROM usage_e JOIN cell_target_e USING (cell_id) JOIN cells_e USING (cell_id)",
    "rel": "SELECT target, program, condition, avg(score) AS m, stddev_pop(score) AS sd, count(*) AS n FROM rel_rows GROUP BY ALL",
}


@register("relative_to_control", "SELECT a.target, program, condition, round(a.m / b.m, 6) AS relative, round(a.sd / sqrt(a.n) / b.m, 6) AS sem, a.n FROM rel a JOIN rel b USING (program, condition) WHERE b.target = 'non-targeting'", REL)
def relative_to_control(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    labels = cells_of_targets(s.assignment, s.guides)
    return rounded(D.relative_to_control(s.usage, labels, s.cells, CONTROL), "relative", "sem")


@register("contingency", "SELECT t.target, program, t.p AS treated_positive, t.n - t.p AS treated_zero, c.p AS control_positive, c.n - c.p AS control_zero FROM (SELECT target, program, count(*) AS p, any_value(n) AS n FROM cell_target_l JOIN usage_l USING (cell_id) JOIN (SELECT target, count(*) AS n FROM cell_target_l GROUP BY target) USING (target) GROUP BY target, program) t JOIN (SELECT target, program, count(*) AS p, any_value(n) AS n FROM cell_target_l JOIN usage_l USING (cell_id) JOIN (SELECT target, count(*) AS n FROM cell_target_l GROUP BY target) USING (target) GROUP BY target, program) c USING (program) WHERE c.target = 'non-targeting' AND t.target <> 'non-targeting'", CELL_TARGET_L)
def contingency(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    return D.contingency(s.usage, cells_of_targets(s.assignment, s.guides), CONTROL)


@register("sample_size_gate", "SELECT target, condition, count(*) AS n FROM cell_target_e JOIN cells_e USING (cell_id) GROUP BY ALL HAVING count(*) >= 18")
def sample_size_gate(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    return cells_of_targets(s.assignment, s.guides).join(s.cells, "cell_id").groupBy("target", "condition").agg(F.count("*").alias("n")).filter("n >= 18")


@register("distinct_regulators", "SELECT program_name, sample, count(DISTINCT target_name) AS n FROM assoc WHERE adj_pval < 0.05 GROUP BY GROUPING SETS ((program_name), (program_name, sample))")
def distinct_regulators(spark, sf_dir):
    hits = ScreenL(spark, sf_dir).assoc.filter("adj_pval < 0.05")
    return hits.groupingSets([[F.col("program_name")], [F.col("program_name"), F.col("sample")]], F.col("program_name"), F.col("sample")).agg(F.count_distinct("target_name").alias("n"))


@register("distinct_terms", "SELECT p_size % 5 AS k, count(DISTINCT p_brand) FILTER (WHERE p_type = 'ECONOMY') AS ECONOMY, count(DISTINCT p_brand) FILTER (WHERE p_type = 'PROMO') AS PROMO FROM part GROUP BY ALL")
def distinct_terms(spark, sf_dir):
    p = Source(spark, sf_dir).table("part").withColumn("k", F.col("p_size") % 5)
    return p.groupBy("k").pivot("p_type", ["ECONOMY", "PROMO"]).agg(F.count_distinct("p_brand")).fillna(0)


@register("member_lists", "SELECT program_name, list_sort(list(DISTINCT target_name)) AS targets FROM assoc WHERE adj_pval < 0.05 GROUP BY program_name")
def member_lists(spark, sf_dir):
    return ScreenL(spark, sf_dir).assoc.filter("adj_pval < 0.05").groupBy("program_name").agg(F.array_sort(F.collect_set("target_name")).alias("targets"))


SIG = ", ".join(f"coalesce(string_agg(program_name, ', ' ORDER BY program_name) FILTER (WHERE sample = '{s}'), '') AS {s}_programs, count(*) FILTER (WHERE sample = '{s}') AS {s}_n" for s in SAMPLES)


@register("significant_programs", f"SELECT target_name, {SIG} FROM assoc WHERE adj_pval < 0.05 GROUP BY target_name")
def significant_programs(spark, sf_dir):
    return D.significant_programs(ScreenL(spark, sf_dir).assoc, SAMPLES)


@register("regulators_by_sign", "SELECT program_name, sample, count(*) FILTER (WHERE log2FC > 0) AS positive, count(*) FILTER (WHERE log2FC < 0) AS negative FROM assoc WHERE adj_pval <= 0.05 GROUP BY ALL")
def regulators_by_sign(spark, sf_dir):
    return D.regulators_by_sign(ScreenL(spark, sf_dir).assoc)


@register("expression_filter", "SELECT gene_id, sum(count) AS total, count(*) AS n FROM expr_l WHERE count > 0 GROUP BY gene_id HAVING sum(count) >= 750 AND count(*) >= 30")
def expression_filter(spark, sf_dir):
    return ScreenL(spark, sf_dir).expr.filter(F.col("count") > 0).groupBy("gene_id").agg(F.sum("count").alias("total"), F.count("*").alias("n")).filter("total >= 750 AND n >= 30")


HEAT = {"means": "SELECT 'n' || (l_partkey % 50) AS target_name, 'c' || (l_linenumber % 3) AS sample, avg(l_quantity) AS mean FROM lineitem GROUP BY ALL"}


@register("regulator_heatmap", "SELECT target_name, program_name, sample, log2FC, hit, round(log2FC * mean / max(mean) OVER (PARTITION BY program_name), 6) AS scaled FROM (SELECT a.*, a.adj_pval < 0.05 AS hit, coalesce(m.mean, 0) AS mean FROM assoc a SEMI JOIN (SELECT * FROM assoc WHERE adj_pval < 0.05) h ON a.target_name = h.target_name AND a.program_name = h.program_name LEFT JOIN means m ON m.target_name = a.target_name AND m.sample = a.sample)", HEAT)
def regulator_heatmap(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    li = s.table("lineitem")
    means = li.groupBy(F.concat(F.lit("n"), (F.col("l_partkey") % 50).cast("string")).alias("target_name"), F.concat(F.lit("c"), (F.col("l_linenumber") % 3).cast("string")).alias("sample")).agg(F.avg("l_quantity").alias("mean"))
    return rounded(D.regulator_heatmap(s.assoc, means).select("target_name", "program_name", "sample", "log2FC", "hit", "scaled"), "scaled")


@register("top_bottom_effects", "SELECT program_name, target_name, log2FC, top, bottom FROM (SELECT *, row_number() OVER (PARTITION BY program_name ORDER BY log2FC DESC, target_name) AS top, row_number() OVER (PARTITION BY program_name ORDER BY log2FC, target_name) AS bottom FROM assoc WHERE sample = 'c0' AND adj_pval < 0.1) WHERE top <= 5 OR bottom <= 5")
def top_bottom_effects(spark, sf_dir):
    hits = ScreenL(spark, sf_dir).assoc.filter("sample = 'c0' AND adj_pval < 0.1")
    return D.extremes(hits, "program_name", "target_name", "log2FC", 5).drop("sample", "adj_pval")


@register("best_terms", "SELECT program_name, target_name AS term, rank, round(-log10(greatest(adj_pval, 1e-300)), 6) AS neg_log10_p FROM (SELECT *, row_number() OVER (PARTITION BY program_name ORDER BY adj_pval, target_name) AS rank FROM assoc WHERE sample = 'c2') WHERE rank <= 10")
def best_terms(spark, sf_dir):
    a = ScreenL(spark, sf_dir).assoc.filter("sample = 'c2'").withColumnRenamed("target_name", "term")
    return rounded(D.top_terms(a, "program_name", "term", "adj_pval", 10).drop("sample", "log2FC", "adj_pval"), "neg_log10_p")


@register("top_genes_checked", "SELECT program, gene_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM loading_l) WHERE rank <= 15")
def top_genes_checked(spark, sf_dir):
    return D.top_of_unique(ScreenL(spark, sf_dir).loading, "program", "gene_id", "score", 15)


@register("guide_load", "SELECT cell_id, target, sum(n) AS load FROM assign_e JOIN guides_e USING (guide_name) GROUP BY ALL")
def guide_load(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    return s.assignment.join(s.guides, "guide_name").groupBy("cell_id", "target").agg(F.sum("n").alias("load"))


@register("most_active_condition", "SELECT program, first(condition ORDER BY mean DESC, condition) AS condition FROM (SELECT program, condition, avg(score) AS mean FROM usage_e JOIN cells_e USING (cell_id) GROUP BY ALL) GROUP BY program")
def most_active_condition(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    m = D.mean_by_condition(s.usage, s.cells)
    return m.groupBy("program").agg(F.min_by("condition", F.struct(-F.col("mean"), F.col("condition"))).alias("condition"))


@register("top_strings", "SELECT program, string_agg(CAST(gene_id AS VARCHAR), ', ' ORDER BY rank) AS genes FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM loading_l) WHERE rank <= 10 GROUP BY program")
def top_strings(spark, sf_dir):
    best = top_k(ScreenL(spark, sf_dir).loading, ["program"], [F.desc("score"), F.asc("gene_id")], 10)
    return best.groupBy("program").agg(D.ordered_join("rank", "gene_id").alias("genes"))


@register("embedding_scatter", "SELECT vec_id AS cell_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, round(CAST(embedding[6] AS DOUBLE) * CAST(embedding[6] AS DOUBLE), 9) AS score FROM embeddings")
def embedding_scatter(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    xy = s.table("embeddings").select(F.col("vec_id").alias("cell_id"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return rounded(xy.join(s.usage.filter("program = '5'").drop("program"), "cell_id"), "score", digits=9)


SPEC = {
    "med": "SELECT *, median(log2FC) OVER (PARTITION BY sample, target_name) AS m FROM assoc",
    "mad": "SELECT sample, target_name, median(abs(log2FC - m)) AS d FROM med GROUP BY ALL",
    "z": "SELECT sample, target_name, program_name, adj_pval, (log2FC - m) / (1.4826 * d + 1e-10) AS z FROM med JOIN mad USING (sample, target_name)",
    "e": "SELECT *, exp(abs(z) / 0.5 - max(abs(z) / 0.5) OVER (PARTITION BY sample, target_name)) AS e FROM z",
    "w": "SELECT *, e / sum(e) OVER (PARTITION BY sample) AS weight FROM e",
    "pmi": "SELECT *, ln((weight + 1e-10) / (p_target * p_program + 1e-10)) AS pmi FROM (SELECT *, sum(weight) OVER (PARTITION BY sample, target_name) AS p_target, sum(weight) OVER (PARTITION BY sample, program_name) AS p_program FROM w)",
}


@register("specificity", "SELECT sample, target_name, program_name, round(z, 6) AS z, round(weight, 9) AS weight, round(p_target, 9) AS p_target, round(p_program, 9) AS p_program, round(pmi, 5) AS pmi FROM pmi", SPEC)
def specificity(spark, sf_dir):
    s = D.specificity(ScreenL(spark, sf_dir).assoc).drop("log2FC", "adj_pval")
    return rounded(rounded(rounded(s, "z"), "weight", "p_target", "p_program", digits=9), "pmi", digits=5)


TOP_SPEC = "SELECT sample, {key}, string_agg({name}, ', ' ORDER BY r) AS names FROM (SELECT *, row_number() OVER (PARTITION BY sample, {key} ORDER BY pmi DESC, {name}) AS r FROM pmi WHERE adj_pval < 0.1) WHERE r <= 5 GROUP BY sample, {key}"


@register("top_specific_programs", TOP_SPEC.format(key="target_name", name="program_name"), SPEC)
def top_specific_programs(spark, sf_dir):
    return D.top_specific(D.specificity(ScreenL(spark, sf_dir).assoc), "target_name", "program_name").drop("scores")


@register("top_specific_regulators", TOP_SPEC.format(key="program_name", name="target_name"), SPEC)
def top_specific_regulators(spark, sf_dir):
    return D.top_specific(D.specificity(ScreenL(spark, sf_dir).assoc), "program_name", "target_name").drop("scores")


@register("score_attach", "SELECT a.target_name, a.program_name, a.sample, a.log2FC, round(pmi, 5) AS pmi FROM assoc a JOIN pmi p USING (sample, target_name, program_name) WHERE a.adj_pval < 0.05", SPEC)
def score_attach(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    scores = D.specificity(s.assoc).select("sample", "target_name", "program_name", "pmi")
    out = s.assoc.filter("adj_pval < 0.05").join(scores, ["sample", "target_name", "program_name"])
    return rounded(out.drop("adj_pval"), "pmi", digits=5)


@register("target_summary", "SELECT target_name, coalesce(programs, '') AS programs, coalesce(names, '') AS names, coalesce(cells, '') AS cells FROM (SELECT target_name, string_agg(program_name, ', ' ORDER BY program_name) AS programs FROM assoc WHERE adj_pval < 0.02 AND sample = 'c0' GROUP BY ALL) FULL JOIN (SELECT target_name, string_agg(program_name, ', ' ORDER BY r) AS names FROM (SELECT *, row_number() OVER (PARTITION BY sample, target_name ORDER BY pmi DESC, program_name) AS r FROM pmi WHERE adj_pval < 0.1 AND sample = 'c1') WHERE r <= 5 GROUP BY ALL) USING (target_name) FULL JOIN (SELECT 'n' || (l_partkey % 50) AS target_name, CAST(count(DISTINCT l_orderkey) AS VARCHAR) AS cells FROM lineitem GROUP BY ALL) USING (target_name)", SPEC)
def target_summary(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    programs = s.assoc.filter("adj_pval < 0.02 AND sample = 'c0'").groupBy("target_name").agg(F.array_join(F.array_sort(F.collect_list("program_name")), ", ").alias("programs"))
    names = D.top_specific(D.specificity(s.assoc).filter("sample = 'c1'"), "target_name", "program_name").select("target_name", "names")
    cells = s.table("lineitem").groupBy(F.concat(F.lit("n"), (F.col("l_partkey") % 50).cast("string")).alias("target_name")).agg(F.count_distinct("l_orderkey").cast("string").alias("cells"))
    return D.fold("target_name", [programs, names, cells])


@register("program_summary", "SELECT program_name, coalesce(sum(positive), 0)::BIGINT AS positive, coalesce(sum(negative), 0)::BIGINT AS negative, any_value(genes) AS genes FROM (SELECT program AS program_name, string_agg(CAST(gene_id AS VARCHAR), ', ' ORDER BY rank) AS genes FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM loading_l) WHERE rank <= 10 GROUP BY program) LEFT JOIN (SELECT program_name, count(*) FILTER (WHERE log2FC > 0) AS positive, count(*) FILTER (WHERE log2FC < 0) AS negative FROM assoc WHERE adj_pval <= 0.05 GROUP BY ALL) USING (program_name) GROUP BY program_name")
def program_summary(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    signs = D.regulators_by_sign(s.assoc).groupBy("program_name").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
    best = top_k(s.loading, ["program"], [F.desc("score"), F.asc("gene_id")], 10).groupBy(F.col("program").alias("program_name")).agg(D.ordered_join("rank", "gene_id").alias("genes"))
    return best.join(signs, "program_name", "left").fillna(0)
