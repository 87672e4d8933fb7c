"""Queries of recoding, filtering and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import recode as B
from sparkloom.plans.association import rounded
from sparkloom.plans.registry import register
from sparkloom.sources.tables import Papers, ScreenE, ScreenL, Source

PCT = "quantile_cont"


@register("rename_ids", "SELECT p_partkey AS row_id, coalesce(symbol, CAST(p_partkey AS VARCHAR)) AS gene_id FROM part LEFT JOIN gene_dict ON gene_id = p_partkey")
def rename_ids(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    ids = s.table("part").select(F.col("p_partkey").alias("row_id"), F.col("p_partkey").alias("gene_id"))
    return B.rename_by_dictionary(ids, "gene_id", s.gene_dict.withColumnRenamed("gene_id", "key"), "key", "symbol")


@register("convert_ids", "SELECT c_custkey, upper(split_part(c_name || CASE WHEN c_custkey % 2 = 0 THEN ':ENS' ELSE '' END, ':', 1)) AS converted FROM customer")
def convert_ids(spark, sf_dir):
    c = Source(spark, sf_dir).table("customer")
    ids = c.select("c_custkey", F.concat("c_name", F.when(F.col("c_custkey") % 2 == 0, ":ENS").otherwise("")).alias("name"))
    return B.convert_ids(ids, "name", "c_custkey", c, "c_name", "c_mktsegment").select("c_custkey", "converted")


@register("best_hit", "SELECT q.c_custkey AS query, coalesce(CAST(arg_min(o_orderkey, (-o_totalprice, o_orderkey)) AS VARCHAR), 'NOT FOUND') AS hit, max(o_totalprice) AS score FROM customer q LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o ON q.c_custkey = o.o_custkey GROUP BY ALL")
def best_hit(spark, sf_dir):
    s = Source(spark, sf_dir)
    hits = s.table("orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("query"), F.col("o_orderkey").alias("hit"), F.col("o_totalprice").alias("score"))
    return B.best_hit(s.table("customer").select(F.col("c_custkey").alias("query")), hits, "query", "score", "hit")


@register("prefix_exclusion", "SELECT p_partkey, p_name FROM part WHERE NOT starts_with(p_name, 's')")
def prefix_exclusion(spark, sf_dir):
    return B.without_prefix(Source(spark, sf_dir).table("part").select("p_partkey", "p_name"), "p_name", "s")


@register("standardise_loading", "SELECT CAST(gene_id AS VARCHAR) AS Name, round(score, 4) AS Score, CAST(program AS INTEGER) AS program_id FROM loading_l")
def standardise_loading(spark, sf_dir):
    df = ScreenL(spark, sf_dir).loading.select(F.col("gene_id").cast("string").alias("Gene Name"), F.col("score").alias("WEIGHT"), F.concat(F.lit("Topic_"), F.col("program")).alias("Topic"))
    out = B.resolve_columns(df, ["Name", "Score", "program_id"])
    return rounded(out.withColumn("program_id", B.parse_program(F.col("program_id"))), "Score", digits=4)


@register("standardise_regulators", "SELECT target_name AS regulator, CAST(program_name AS INTEGER) AS program_id, log2FC, adj_pval AS p, adj_pval <= 0.05 AS significant FROM assoc WHERE sample = 'c0'")
def standardise_regulators(spark, sf_dir):
    df = ScreenL(spark, sf_dir).assoc.filter("sample = 'c0'").select("target_name", F.concat(F.lit("P"), F.col("program_name")).alias("program"), "log2FC", "adj_pval")
    return B.standardise_regulators(df)


@register("standardise_cell_types", "SELECT category AS cell_type, program AS program, round(log2(avg(score)), 6) AS log2_fc_in_vs_out, round(min(score), 6) AS fdr FROM usage_e JOIN cells_e USING (cell_id) GROUP BY ALL")
def standardise_cell_types(spark, sf_dir):
    s = ScreenE(spark, sf_dir)
    df = s.usage.join(s.cells, "cell_id").groupBy(F.col("category").alias("CellType"), "program").agg(F.round(F.log2(F.avg("score")), 6).alias("logFC"), F.round(F.min("score"), 6).alias("padj"))
    return B.resolve_columns(df, ["cell_type", "log2_fc_in_vs_out", "fdr"])


@register("parse_program_id", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN event_id WHEN 2 THEN event_id END AS program FROM events")
def parse_program_id(spark, sf_dir):
    e, i = Source(spark, sf_dir).table("events"), F.col("event_id").cast("string")
    text = F.when(F.col("event_id") % 4 == 0, i).when(F.col("event_id") % 4 == 1, F.concat(F.lit("Program_"), i)).when(F.col("event_id") % 4 == 2, F.concat(F.lit("x"), i)).otherwise(F.concat(F.lit("q"), i))
    return e.select("event_id", B.parse_program(text).cast("long").alias("program"))


@register("coerce_boolean", "SELECT event_id, event_type = 'click' OR event_id % 3 = 1 AS flag FROM events")
def coerce_boolean(spark, sf_dir):
    e = Source(spark, sf_dir).table("events")
    text = F.when(F.col("event_type") == "click", " Yes").when(F.col("event_id") % 3 == 1, "2.5").when(F.col("event_id") % 3 == 2, "none").otherwise("0")
    return e.select("event_id", B.to_boolean(text).alias("flag"))


@register("significance_filter", "SELECT target_name, program_name, sample, adj_pval <= 0.05 AS within, adj_pval < 0.05 AS below FROM assoc WHERE adj_pval <= 0.05")
def significance_filter(spark, sf_dir):
    return B.significant(ScreenL(spark, sf_dir).assoc, 0.05, inclusive=True).select("target_name", "program_name", "sample", F.lit(True).alias("within"), (F.col("adj_pval") < 0.05).alias("below"))


@register("condition_subset", "SELECT condition, category, count(*) AS n FROM cells_l WHERE condition = 'F' GROUP BY ALL")
def condition_subset(spark, sf_dir):
    return ScreenL(spark, sf_dir).cells.filter("condition = 'F'").groupBy("condition", "category").agg(F.count("*").alias("n"))


@register("clean_p_values", "SELECT event_id, CASE WHEN value / 20 > 1 OR event_id % 7 = 0 THEN 1.0 ELSE round(value / 20, 9) END AS p FROM events")
def clean_p_values(spark, sf_dir):
    from sparkloom.operators.ranking import clean_p

    p = F.when(F.col("event_id") % 14 == 0, float("nan")).when(F.col("event_id") % 7 == 0, None).otherwise(F.round(F.col("value") / 20, 9))
    return Source(spark, sf_dir).table("events").select("event_id", clean_p(p).alias("p"))


TRAITS = {"raw_traits": """SELECT l_orderkey, l_linenumber, p_type || CASE WHEN l_partkey % 11 = 0 THEN ' and more' ELSE '' END AS trait, repeat(',', l_linenumber % 4) AS trait_efos, CASE WHEN l_suppkey % 9 = 0 THEN 'Uncategorised' ELSE 'Known' END AS category, CASE WHEN l_partkey % 5 > 0 THEN l_quantity END AS n_cases, l_extendedprice AS n_initial, CAST(l_suppkey % 7 AS VARCHAR) AS chrom, 28000000 + l_orderkey * 1000 AS pos FROM lineitem JOIN part ON l_partkey = p_partkey"""}


@register("trait_filters", """SELECT l_orderkey, l_linenumber, trait, n_cases FROM (SELECT *, rank() OVER (PARTITION BY trait ORDER BY n_cases DESC) AS r FROM (SELECT * REPLACE (coalesce(n_cases, n_initial) AS n_cases) FROM raw_traits WHERE length(trait_efos) <= 2 AND NOT contains(trait, ' and ') AND category <> 'Uncategorised')) WHERE r = 1 AND NOT (chrom = '6' AND pos BETWEEN 28510120 AND 33480577)""", TRAITS)
def trait_filters(spark, sf_dir):
    s = Source(spark, sf_dir)
    li, p = s.table("lineitem"), s.table("part")
    raw = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", F.concat(F.lit('"'), F.col("p_type"), F.when(F.col("l_partkey") % 11 == 0, " and more").otherwise("")).alias("trait"),
        F.expr("repeat(',', l_linenumber % 4)").alias("trait_efos"), F.when(F.col("l_suppkey") % 9 == 0, "Uncategorised").otherwise("Known").alias("category"),
        F.when(F.col("l_partkey") % 5 > 0, F.col("l_quantity")).alias("n_cases"), F.col("l_extendedprice").alias("n_initial"), (F.col("l_suppkey") % 7).cast("string").alias("chrom"), (F.lit(28000000) + F.col("l_orderkey") * 1000).alias("pos"),
    )
    return B.clean_traits(raw).select("l_orderkey", "l_linenumber", "trait", "n_cases")


@register("flatten_elements", "SELECT event_id, 'a' || event_id || ', b' || event_id AS joined FROM events")
def flatten_elements(spark, sf_dir):
    text = F.format_string("[{'element': 'b%d'}, {'element': 'a%d'}]", "event_id", "event_id")
    return Source(spark, sf_dir).table("events").select("event_id", B.flatten_elements(text).alias("joined"))


@register("repair_zero_p", "SELECT l_orderkey, l_linenumber, round(abs(-log10(CASE WHEN l_discount = 0 THEN (SELECT min(l_discount) FROM lineitem WHERE l_discount > 0) ELSE l_discount END)), 6) AS neg_log10_p FROM lineitem")
def repair_zero_p(spark, sf_dir):
    df = Source(spark, sf_dir).table("lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return rounded(B.repair_p(df, "l_discount").drop("l_discount"), "neg_log10_p")


@register("pathway_filter", "SELECT p_partkey, p_brand, p_size FROM part WHERE regexp_matches(p_type, '(?i)economy|promo') AND p_size < 30")
def pathway_filter(spark, sf_dir):
    return Source(spark, sf_dir).table("part").filter(F.col("p_type").rlike("(?i)economy|promo") & (F.col("p_size") < 30)).select("p_partkey", "p_brand", "p_size")


@register("list_truncation", "SELECT l_orderkey, array_to_string(list_slice(list(CAST(l_linenumber AS VARCHAR) ORDER BY l_linenumber), 1, 3), ';') AS items FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY ALL")
def list_truncation(spark, sf_dir):
    li = Source(spark, sf_dir).table("lineitem").select("l_orderkey", "l_linenumber").distinct()
    lists = li.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list("l_linenumber")).cast("array<string>"), ";").alias("items"))
    return lists.select("l_orderkey", B.first_items(F.col("items"), 3).alias("items"))


BAND = "CASE WHEN log2FC * 3 >= 3 THEN 'highly' WHEN log2FC * 3 >= 1.5 THEN 'moderately' WHEN log2FC * 3 >= 0.5 THEN 'weakly' WHEN log2FC * 3 <= -0.5 THEN 'depleted' END"
BAND_LISTS = ", ".join(f"coalesce(array_to_string(list_sort(list(DISTINCT target_name) FILTER (WHERE adj_pval < 0.05 AND band = '{b}')), '|'), '') AS {b}" for b in B.BANDS)


@register("fold_change_bands", f"SELECT program_name, {BAND_LISTS} FROM (SELECT *, {BAND} AS band FROM assoc) GROUP BY program_name")
def fold_change_bands(spark, sf_dir):
    return B.bands_by_program(ScreenL(spark, sf_dir).assoc.withColumn("fold", F.col("log2FC") * 3), "program_name", "target_name", "fold", "adj_pval")


@register("cell_type_validation", "SELECT 'unreadable programs' AS finding, count(*) AS n FROM lineitem UNION ALL SELECT 'FDR out of range', count(*) FROM lineitem WHERE l_quantity / 25 > 1 UNION ALL SELECT 'few cell types', 0 WHERE false UNION ALL SELECT 'few programs', 1")
def cell_type_validation(spark, sf_dir):
    li = Source(spark, sf_dir).table("lineitem").select(F.concat(F.lit("zz"), F.col("l_returnflag")).alias("program"), F.concat("l_linestatus", "l_linenumber").alias("cell_type"), F.col("l_discount").alias("fold"), (F.col("l_quantity") / 25).alias("fdr"))
    return B.validate_cell_types(li, "program", "cell_type", "fold", "fdr")


@register("screen_validation", "SELECT 'guides without cells' AS \"check\", count(*) AS n FROM guides_l ANTI JOIN assign_l USING (guide_name) UNION ALL SELECT 'assigned guides without target', count(DISTINCT guide_name) FROM assign_l ANTI JOIN guides_l USING (guide_name) UNION ALL SELECT 'cells without guides', count(*) FROM cells_l ANTI JOIN assign_l USING (cell_id)")
def screen_validation(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    return B.validate_screen(s.assignment, s.guides, s.cells).drop("examples")


@register("program_consistency", "SELECT 'assoc' AS result, (SELECT count(*) FROM (SELECT DISTINCT program_name FROM assoc) WHERE program_name NOT IN (SELECT program FROM usage_e)) AS unknown, (SELECT count(*) FROM (SELECT DISTINCT program FROM usage_e) WHERE program NOT IN (SELECT program_name FROM assoc)) AS missing")
def program_consistency(spark, sf_dir):
    return B.program_consistency({"assoc": ScreenL(spark, sf_dir).assoc}, ScreenE(spark, sf_dir).usage)


@register("volcano_classes", "SELECT target_name, program_name, sample, CASE WHEN adj_pval <= 0.05 AND log2FC >= 0.1 THEN 'up' WHEN adj_pval <= 0.05 AND log2FC <= -0.1 THEN 'down' ELSE 'ns' END AS class, round(-log10(greatest(adj_pval, 1e-300)), 6) AS neg_log10_p FROM assoc")
def volcano_classes(spark, sf_dir):
    return rounded(B.volcano(ScreenL(spark, sf_dir).assoc).drop("log2FC", "adj_pval"), "neg_log10_p")


@register("report_volcano", "SELECT program_name, len(list(1)) AS n, min(target_name) AS first_name, round(sum(round(least(300, -log10(CASE WHEN adj_pval = 0 THEN 1e-300 ELSE adj_pval END)), 3)), 3) AS height FROM assoc WHERE sample = 'c1' GROUP BY program_name")
def report_volcano(spark, sf_dir):
    points = B.report_volcano(ScreenL(spark, sf_dir).assoc.filter("sample = 'c1'"), "program_name", "target_name", "adj_pval", "log2FC")
    return points.select("program_name", F.size("points").cast("long").alias("n"), F.col("points")[0]["name"].alias("first_name"), F.round(F.aggregate("points", F.lit(0.0), lambda a, x: a + x["y"]), 3).alias("height"))


@register("cp10k", "SELECT cell_id, gene_id, round(count / sum(count) OVER (PARTITION BY cell_id) * 10000, 6) AS norm FROM expr_l")
def cp10k(spark, sf_dir):
    return rounded(B.cp10k(ScreenL(spark, sf_dir).expr).drop("count"), "norm")


GRID = {
    "grid": "SELECT c.cell_id, p.program, greatest(coalesce(u.score, 0), 1e-8) AS u FROM (SELECT DISTINCT cell_id FROM usage_l) c CROSS JOIN (SELECT DISTINCT program FROM usage_l) p LEFT JOIN usage_l u ON u.cell_id = c.cell_id AND u.program = p.program",
    "shares": "SELECT *, u / sum(u) OVER (PARTITION BY cell_id) AS share FROM grid",
}


@register("composition_clr", "SELECT cell_id, program, round(share, 9) AS share, round(ln(share) - avg(ln(share)) OVER (PARTITION BY cell_id), 6) AS clr FROM shares", GRID)
def composition_clr(spark, sf_dir):
    return rounded(rounded(B.floored_composition(ScreenL(spark, sf_dir).usage), "clr"), "share", digits=9)


@register("winsorise", "SELECT cell_id, program, round(CASE WHEN score <> 0 THEN least(score, quantile_cont(score, 0.9) OVER (PARTITION BY program)) ELSE score END, 4) AS capped FROM usage_l")
def winsorise(spark, sf_dir):
    return rounded(B.winsorise(ScreenL(spark, sf_dir).usage, ["program"], "score", 0.9).drop("score"), "capped", digits=4)


@register("response_transforms", "SELECT cell_id, program, round(ln(score * 1e6 + quantile_cont(score * 1e6, 0.05) OVER (PARTITION BY program)), 6) AS pseudo, round(ln(score * 1e6 + 1), 6) AS logged FROM usage_l")
def response_transforms(spark, sf_dir):
    u = B.transform_response(ScreenL(spark, sf_dir).usage, ["program"], "score", "ols_pseudo").withColumnRenamed("transformed", "pseudo").drop("back")
    return rounded(B.transform_response(u, ["program"], "score", "ols_log").withColumnRenamed("transformed", "logged").drop("back", "score"), "pseudo", "logged")


@register("covariate_design", "SELECT cell_id, round((total - (SELECT avg(total) FROM cells_l)) / (SELECT stddev_samp(total) FROM cells_l), 6) AS total, round((ln(1 + total) - (SELECT avg(ln(1 + total)) FROM cells_l)) / (SELECT stddev_samp(ln(1 + total)) FROM cells_l), 6) AS log_total FROM cells_l")
def covariate_design(spark, sf_dir):
    return rounded(B.covariate_design(ScreenL(spark, sf_dir).cells.select("cell_id", "total"), ["total"], ["total"]), "total", "log_total")


@register("dominant_program", "SELECT cell_id, program, round(score / sum(score) OVER (PARTITION BY cell_id), 9) AS share, first_value(program) OVER (PARTITION BY cell_id ORDER BY score DESC, program) AS dominant FROM usage_l")
def dominant_program(spark, sf_dir):
    return rounded(B.dominant_program(ScreenL(spark, sf_dir).usage).drop("score"), "share", digits=9)


@register("loading_curves", "SELECT program, gene_id, rank, round((l - min(l) OVER (PARTITION BY program)) / (max(l) OVER (PARTITION BY program) - min(l) OVER (PARTITION BY program) + 1e-15), 6) AS scaled FROM (SELECT program, gene_id, ln(score) AS l, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM loading_l WHERE score > 0) WHERE rank <= 100")
def loading_curves(spark, sf_dir):
    return rounded(B.loading_curves(ScreenL(spark, sf_dir).loading).drop("score"), "scaled")


@register("subsample_cells", "SELECT cell_id, condition FROM (SELECT *, row_number() OVER (PARTITION BY condition ORDER BY md5('42|' || cell_id), cell_id) AS k FROM cells_l) WHERE k <= 500")
def subsample_cells(spark, sf_dir):
    return B.subsample(ScreenL(spark, sf_dir).cells, ["condition"], "cell_id", 500).select("cell_id", "condition")


@register("drop_empty_guides", "SELECT guide_name, target FROM guides_l SEMI JOIN assign_l USING (guide_name)")
def drop_empty_guides(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    return s.guides.join(s.assignment, "guide_name", "left_semi")


@register("search_input", "SELECT program_name AS program, array_to_string(list(target_name ORDER BY s, target_name), ', ') AS regulators FROM (SELECT program_name, target_name, min(sample) AS s FROM assoc WHERE adj_pval < 0.01 GROUP BY ALL) GROUP BY ALL")
def search_input(spark, sf_dir):
    hits = B.significant(ScreenL(spark, sf_dir).assoc, 0.01)
    lists = hits.groupBy(F.col("program_name").alias("program")).pivot("sample", ["c0", "c1", "c2"]).agg(F.array_join(F.array_sort(F.collect_list("target_name")), ";"))
    return B.search_input(lists, ["c0", "c1", "c2"])


@register("file_keys", "SELECT DISTINCT p_size, CAST(p_size AS VARCHAR) || '_2_0_log_total_segment' AS key FROM part")
def file_keys(spark, sf_dir):
    return Source(spark, sf_dir).table("part").select("p_size", B.file_key(F.col("p_size"), F.lit(2.0), ["log_total", "segment"]).alias("key")).distinct()
