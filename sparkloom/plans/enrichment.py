"""Queries of gene-set enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import enrichment as E
from sparkloom.plans.association import rounded
from sparkloom.plans.registry import register
from sparkloom.sources.tables import ScreenL


def fisher_sql(sets: str, n_top: int) -> tuple[str, dict[str, str]]:
    extra = {
        "top": f"SELECT program, gene_id FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS r FROM loading_l) WHERE r <= {n_top} AND gene_id IN (SELECT gene_id FROM {sets})",
        "hit": f"SELECT program, term, count(*) AS overlap FROM top JOIN (SELECT DISTINCT term, gene_id FROM {sets}) USING (gene_id) GROUP BY ALL",
        "sizes": f"SELECT term, count(DISTINCT gene_id) AS set_size FROM {sets} GROUP BY term",
        "counts": f"SELECT *, (SELECT count(DISTINCT gene_id) FROM {sets}) AS total FROM hit JOIN sizes USING (term) JOIN (SELECT program, count(*) AS drawn FROM top GROUP BY program) USING (program)",
        "tested": "SELECT *, least(1.0, list_sum(list_transform(range(overlap, least(set_size, drawn) + 1), lambda k: CASE WHEN drawn - k > total - set_size THEN 0 ELSE exp(lgamma(set_size + 1) - lgamma(k + 1) - lgamma(set_size - k + 1) + lgamma(total - set_size + 1) - lgamma(drawn - k + 1) - lgamma(total - set_size - drawn + k + 1) - lgamma(total + 1) + lgamma(drawn + 1) + lgamma(total - drawn + 1)) END))) AS pval FROM counts",
    }
    sql = "SELECT program, term, overlap, set_size, round(pval, 6) AS pval, round(least(1.0, min(pval * m / k) OVER (PARTITION BY program ORDER BY k DESC)), 6) AS adj_pval, round((overlap + 0.5) * (total - set_size - drawn + overlap + 0.5) / ((set_size - overlap + 0.5) * (drawn - overlap + 0.5)), 6) AS odds_ratio FROM (SELECT *, count(*) OVER (PARTITION BY program) AS m, row_number() OVER (PARTITION BY program ORDER BY pval, term) AS k FROM tested)"
    return sql, extra


def _fisher(spark, sf_dir, sets, n_top):
    s = ScreenL(spark, sf_dir)
    out = E.enrich(s.loading, getattr(s, sets), "fisher", n_top=n_top).drop("combined_score", "genes")
    return rounded(out, "pval", "adj_pval", "odds_ratio")


@register("fisher_enrichment", *fisher_sql("geneset", 300))
def fisher_enrichment(spark, sf_dir):
    return _fisher(spark, sf_dir, "geneset", 300)


@register("fisher_by_type", *fisher_sql("typeset", 100))
def fisher_by_type(spark, sf_dir):
    return _fisher(spark, sf_dir, "typeset", 100)


TRAIT_SQL, TRAIT_EXTRA = fisher_sql("trait_sets", 200)


@register("trait_enrichment", TRAIT_SQL, TRAIT_EXTRA | {"trait_sets": "SELECT DISTINCT trait AS term, gene_id FROM trait WHERE n_cases >= 40"})
def trait_enrichment(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    sets = s.trait.filter("n_cases >= 40").select(F.col("trait").alias("term"), "gene_id")
    return rounded(E.fisher(s.loading, sets, 200).drop("combined_score", "genes"), "pval", "adj_pval", "odds_ratio")


@register("geneset_table", "SELECT term, list_sort(list(gene_id)) AS genes FROM geneset GROUP BY term HAVING count(*) BETWEEN 60 AND 90")
def geneset_table(spark, sf_dir):
    sets = ScreenL(spark, sf_dir).geneset.groupBy("term").agg(F.array_sort(F.collect_list("gene_id")).alias("genes"))
    return sets.filter(F.size("genes").between(60, 90))


@register("uniqueness_score", "SELECT program, gene_id, round(score * ln(((SELECT count(DISTINCT program) FROM loading_l) + 1.0) / (n + 1)), 6) AS uniqueness FROM loading_l JOIN (SELECT gene_id, count(DISTINCT program) AS n FROM loading_l GROUP BY gene_id) USING (gene_id)")
def uniqueness_score(spark, sf_dir):
    return rounded(E.uniqueness(ScreenL(spark, sf_dir).loading).drop("score"), "uniqueness")


GSEA = {
    "ranked": "SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS r, count(*) OVER (PARTITION BY program) AS n FROM loading_l",
    "steps": "SELECT r.program, t.term, r.r, CASE WHEN g.gene_id IS NOT NULL THEN abs(r.score) / t.total ELSE -1.0 / (r.n - t.m) END AS step FROM ranked r JOIN (SELECT program, term, sum(abs(score)) AS total, count(*) AS m FROM ranked JOIN geneset USING (gene_id) GROUP BY ALL HAVING count(*) BETWEEN 15 AND 500) t ON r.program = t.program LEFT JOIN geneset g ON g.gene_id = r.gene_id AND g.term = t.term",
    "walk": "SELECT *, sum(step) OVER (PARTITION BY program, term ORDER BY r ROWS UNBOUNDED PRECEDING) AS s FROM steps",
}


@register("gsea_scores", "SELECT program, term, round(CASE WHEN max(s) >= -least(min(s), 0) THEN max(s) ELSE min(s) END, 6) AS es FROM walk GROUP BY ALL", GSEA)
def gsea_scores(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    return rounded(E.running_scores(s.loading, s.geneset).select("program", "term", "es"), "es")


@register("gsea_prerank")
def gsea_prerank(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    return E.enrich(s.loading, s.geneset, "gsea", permutations=200)
