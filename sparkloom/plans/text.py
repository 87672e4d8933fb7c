"""Queries of evidence from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import text as T
from sparkloom.operators.ranking import top_k
from sparkloom.plans.association import rounded
from sparkloom.plans.registry import register
from sparkloom.sources.tables import Papers, ScreenL, dealt

VERBS = ["then", "heit", "tion"]
DOMAIN = ["the ", "der "]
SENTENCES = {
    "marked": "SELECT pmid, regexp_replace(replace(replace(coalesce(abstract, ''), 'vs.', 'vs' || chr(1)), 'Fig.', 'Fig' || chr(1)), '([.?!])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(2), 'g') AS t FROM papers",
    "sents": "SELECT pmid, position, s AS sentence FROM (SELECT pmid, unnest(range(0, len(parts))) AS position, unnest(parts) AS s FROM (SELECT pmid, list_filter(list_transform(string_split(t, chr(2)), lambda x: regexp_replace(replace(x, chr(1), '.'), '^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$', '', 'g')), lambda x: length(x) > 10) AS parts FROM marked))",
}


@register("sentence_split", "SELECT pmid, CAST(position AS INTEGER) AS position, sentence FROM sents", SENTENCES)
def sentence_split(spark, sf_dir):
    return T.sentences(Papers(spark, sf_dir).papers, "pmid", F.col("abstract"))


EVIDENCE = {
    "marked": SENTENCES["marked"].replace("coalesce(abstract, '')", "title || '. ' || abstract"),
    "sents": SENTENCES["sents"],
    "firsts": "SELECT pmid, min(position) AS position, first(sentence ORDER BY position) AS sentence FROM (SELECT *, trim(sentence, ' .') AS k FROM sents) GROUP BY pmid, k",
    "tokens": "SELECT DISTINCT pmid, position, sentence, unnest(regexp_split_to_array(lower(sentence), '[^\\p{L}\\p{N}_]+')) AS entity FROM firsts",
    "named": "SELECT *, count(*) OVER (PARTITION BY pmid, position) - 1 AS others FROM tokens WHERE entity IN (SELECT entity FROM entities)",
    "scored": "SELECT *, 2 * others + CASE WHEN contains(lower(sentence), 'the ') OR contains(lower(sentence), 'der ') THEN 1 ELSE 0 END + CASE WHEN contains(lower(sentence), 'then') OR contains(lower(sentence), 'heit') OR contains(lower(sentence), 'tion') THEN 1 ELSE 0 END AS score FROM named",
}


@register("evidence_sentences", "SELECT pmid, entity, sentence, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY pmid, entity ORDER BY score DESC, position) AS rank FROM scored) WHERE rank <= 2", EVIDENCE)
def evidence_sentences(spark, sf_dir):
    p = Papers(spark, sf_dir)
    return T.evidence(p.papers, p.entities, DOMAIN, VERBS)


MECHANISTIC = SENTENCES | {
    "verbed": "SELECT * FROM sents WHERE contains(lower(sentence), 'then') OR contains(lower(sentence), 'heit') OR contains(lower(sentence), 'tion')",
    "paired": "SELECT pmid, position, sentence, contains(lower(sentence), 'on') AS b FROM verbed WHERE contains(lower(sentence), 'th')",
    "chosen": "SELECT * FROM (SELECT *, bool_or(b) OVER (PARTITION BY pmid) AS some_b FROM paired) WHERE b OR NOT some_b",
}


@register("mechanistic_sentences", "SELECT pmid, 'TH' AS a, 'on' AS b, b AS \"both\", sentence, rank FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY position) AS rank FROM chosen) WHERE rank <= CASE WHEN b THEN 2 ELSE 3 END".replace("'on' AS b, b AS", "'on' AS b, c.b AS").replace("FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY position) AS rank FROM chosen)", "FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY position) AS rank FROM chosen) c").replace("CASE WHEN b THEN", "CASE WHEN c.b THEN"), MECHANISTIC)
def mechanistic_sentences(spark, sf_dir):
    p = Papers(spark, sf_dir)
    pairs = p.papers.select("pmid", F.lit("TH").alias("a"), F.lit("on").alias("b"))
    return T.mechanistic(p.papers, pairs, VERBS)


def _annotated(spark, sf_dir):
    """BioC documents built from line items: an order is a paper, its parts are genes and neighbouring lines are relations."""
    li = ScreenL(spark, sf_dir).table("lineitem")
    gene = lambda k: F.concat(F.lit("g"), (F.col(k) % 40).cast("string"))
    annotation = F.struct(F.create_map(F.lit("type"), F.when(F.col("l_linenumber") % 4 == 0, "Disease").otherwise("Gene"), F.lit("name"), gene("l_partkey")).alias("infons"), F.concat(F.lit("t"), F.col("l_linenumber").cast("string")).alias("text"))
    kind = F.when(F.col("l_returnflag") == "A", "Positive_Correlation").when(F.col("l_returnflag") == "N", "Negative_Correlation").otherwise("Association")
    relation = F.struct(F.create_map(F.lit("role1"), gene("l_partkey"), F.lit("role2"), gene("l_suppkey"), F.lit("type"), kind, F.lit("score"), (F.col("l_discount") * 10).cast("string")).alias("infons"))
    passage = F.struct(F.create_map(F.lit("type"), F.lit("title")).alias("infons"), F.concat(F.lit("order "), F.first(F.col("l_orderkey").cast("string"))).alias("text"), F.collect_list(annotation).alias("annotations"))
    return dealt(li, li.count(), "l_orderkey").groupBy(F.col("l_orderkey").alias("pmid")).agg(F.to_json(F.struct(F.array(passage).alias("passages"), F.collect_list(relation).alias("relations"))).alias("payload"))


@register("gene_mentions", "SELECT l_orderkey AS pmid, 'G' || (l_partkey % 40) AS gene, list_sort(list(DISTINCT 't' || l_linenumber)) AS texts FROM lineitem WHERE l_linenumber % 4 <> 0 GROUP BY ALL")
def gene_mentions(spark, sf_dir):
    return T.mentions(_annotated(spark, sf_dir))


RELATIONS = {"rel": "SELECT l_orderkey AS pmid, 'G' || (l_partkey % 40) AS gene_a, 'G' || (l_suppkey % 40) AS gene_b, CASE WHEN l_returnflag = 'A' THEN 'Positive_Correlation' ELSE 'Negative_Correlation' END AS kind, l_discount * 10 AS score FROM lineitem WHERE l_returnflag IN ('A', 'N')"}


@register("relation_extraction", "SELECT pmid, 'order ' || pmid AS title, gene_a, gene_b, kind, round(score, 6) AS score FROM rel", RELATIONS)
def relation_extraction(spark, sf_dir):
    return rounded(T.relations(_annotated(spark, sf_dir)), "score")


REGULATOR = RELATIONS | {
    "sides": "SELECT pmid, gene_a AS regulator, gene_b AS other, kind, round(score, 6) AS score FROM rel WHERE round(score, 6) >= 0.85 UNION ALL SELECT pmid, gene_b, gene_a, kind, round(score, 6) FROM rel WHERE round(score, 6) >= 0.85",
    "ones": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY regulator, other, pmid ORDER BY score DESC, kind) AS k FROM sides WHERE regulator <> other AND regulator IN ('G1', 'G2', 'G3', 'G77')) WHERE k = 1",
}


@register("regulator_evidence", "SELECT pmid, regulator, other, kind, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY regulator ORDER BY score DESC, pmid, other) AS rank FROM ones) WHERE rank <= 10", REGULATOR)
def regulator_evidence(spark, sf_dir):
    a = T.parsed(_annotated(spark, sf_dir))
    regulators = spark.range(1).select(F.explode(F.array(*map(F.lit, ["G1", "G2", "G3", "G77"]))).alias("regulator"))
    found = rounded(T.relations(a), "score").filter("score >= 0.85")
    return T.regulator_evidence(found, regulators, T.mentions(a))


SIGNS = {"signed": "SELECT *, count(*) OVER (PARTITION BY program_name) AS n, CASE WHEN log2FC < 0 THEN 'activator' ELSE 'repressor' END AS role FROM assoc WHERE sample = 'c0' AND adj_pval < 0.05 AND log2FC <> 0"}


def _by_sign(spark, sf_dir):
    return T.top_by_sign(ScreenL(spark, sf_dir).assoc.filter("sample = 'c0'"), all_up_to=8)


@register("top_regulators_by_sign", "SELECT target_name, program_name, role, rank FROM (SELECT *, row_number() OVER (PARTITION BY program_name, role ORDER BY abs(log2FC) DESC, target_name) AS rank FROM signed) WHERE rank <= 3 OR n <= 8", SIGNS)
def top_regulators_by_sign(spark, sf_dir):
    return _by_sign(spark, sf_dir).select("target_name", "program_name", "role", "rank")


@register("regulators_with_edges", "SELECT t.target_name, t.program_name, coalesce(count(e.gene_id), 0) AS n_targets FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY program_name, role ORDER BY abs(log2FC) DESC, target_name) AS rank FROM signed) WHERE rank <= 3 OR n <= 8) t LEFT JOIN (SELECT program AS program_name, gene_id, 'n' || (gene_id % 50) AS target_name FROM loading_l WHERE score > 50) e ON e.program_name = t.program_name AND e.target_name = t.target_name GROUP BY ALL", SIGNS)
def regulators_with_edges(spark, sf_dir):
    loading = ScreenL(spark, sf_dir).loading.filter("score > 50")
    edges = loading.select(F.concat(F.lit("n"), (F.col("gene_id") % 50).cast("string")).alias("regulator"), "gene_id").distinct().withColumn("weight", F.col("gene_id").cast("double"))
    genes = loading.select(F.col("program").alias("program_name"), "gene_id")
    return T.regulators_with_edges(_by_sign(spark, sf_dir), edges, genes).select("target_name", "program_name", "n_targets")


@register("driver_summaries", "SELECT program, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS k FROM loading_l) JOIN gene_dict USING (gene_id) WHERE k <= 20 GROUP BY program")
def driver_summaries(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    drivers = top_k(s.loading, ["program"], [F.desc("score"), F.asc("gene_id")], 20).select("program", "gene_id")
    found = T.driver_summaries(drivers, s.gene_dict.withColumnRenamed("symbol", "summary"))
    return found.select("program", F.size("summaries").cast("long").alias("n"))


@register("read_bands", "SELECT l_orderkey, list(CAST(l_linenumber AS VARCHAR) ORDER BY l_linenumber) AS items FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY l_orderkey")
def read_bands(spark, sf_dir):
    li = ScreenL(spark, sf_dir).table("lineitem").select("l_orderkey", "l_linenumber").distinct()
    text = li.groupBy("l_orderkey").agg(F.concat(F.array_join(F.array_sort(F.collect_list("l_linenumber")).cast("array<string>"), " | "), F.lit(" | ")).alias("t"))
    return text.select("l_orderkey", T.read_bands(F.col("t")).alias("items"))


CLAIMS = {"claims": "SELECT l_suppkey % 30 AS claim_id, l_orderkey AS pmid, 'g' || (l_suppkey % 40) AS gene FROM lineitem", "ment": "SELECT DISTINCT l_orderkey AS pmid, 'G' || (l_partkey % 40) AS g FROM lineitem WHERE l_linenumber % 4 <> 0"}


@register("citation_check", "SELECT claim_id, c.pmid, count(g) AS found, count(*) AS claimed, count(g) > 0 AS passed, round(count(g) / count(*), 6) AS confidence FROM claims c LEFT JOIN ment m ON m.pmid = c.pmid AND m.g = upper(c.gene) GROUP BY ALL", CLAIMS)
def citation_check(spark, sf_dir):
    li = ScreenL(spark, sf_dir).table("lineitem")
    claims = li.select((F.col("l_suppkey") % 30).alias("claim_id"), F.col("l_orderkey").alias("pmid"), F.concat(F.lit("g"), (F.col("l_suppkey") % 40).cast("string")).alias("gene"))
    return rounded(T.check_citations(claims, T.mentions(_annotated(spark, sf_dir))).drop("missing"), "confidence")


@register("badges", "SELECT pmid, CASE WHEN bool_and(passed) THEN 'VERIFIED' ELSE arg_min(name, priority) FILTER (WHERE NOT passed) END AS badge, bool_and(passed) AS all_passed, sum(evidence) AS evidence FROM checks GROUP BY pmid", {"checks": "SELECT l_orderkey AS pmid, 'check' || l_linenumber AS name, l_linenumber AS priority, l_discount < 0.08 AS passed, CAST(l_quantity AS BIGINT) AS evidence FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_discount) = 1"})
def badges(spark, sf_dir):
    li = top_k(ScreenL(spark, sf_dir).table("lineitem"), ["l_orderkey", "l_linenumber"], [F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_quantity"), F.asc("l_discount")], 1)
    checks = li.select(F.col("l_orderkey").alias("pmid"), F.concat(F.lit("check"), F.col("l_linenumber")).alias("name"), F.col("l_linenumber").alias("priority"), (F.col("l_discount") < 0.08).alias("passed"), F.col("l_quantity").cast("long").alias("evidence"))
    return T.badge(checks)


SNIPPETS = {
    "snip": "SELECT 'g' || (event_id % 50) AS gene, event_id AS position, event_type || ' rises.. ' || CASE WHEN event_id % 3 = 0 THEN '' ELSE 'PMID: ' || (user_id % 20) END AS text FROM events",
    "by_pmid": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gene, CASE WHEN contains(text, 'PMID') THEN text[strpos(text, 'PMID'):] ELSE 'row' || position END ORDER BY position) AS k FROM snip) WHERE k = 1",
    "by_text": "SELECT * FROM (SELECT gene, position, text, row_number() OVER (PARTITION BY gene, regexp_replace(text, '[^a-zA-Z0-9]+', ' ', 'g') ORDER BY position) AS k FROM by_pmid) WHERE k = 1",
}


@register("snippet_dedup", "SELECT gene, rank, CASE WHEN ends_with(t, '.') THEN t ELSE t || '.' END AS text FROM (SELECT gene, replace(trim(text), '..', '.') AS t, row_number() OVER (PARTITION BY gene ORDER BY position) AS rank FROM by_text) WHERE rank <= 5", SNIPPETS)
def snippet_dedup(spark, sf_dir):
    e = ScreenL(spark, sf_dir).table("events")
    tail = F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit("PMID: "), (F.col("user_id") % 20).cast("string")))
    rows = e.select(F.concat(F.lit("g"), (F.col("event_id") % 50).cast("string")).alias("gene"), F.col("event_id").alias("position"), F.concat("event_type", F.lit(" rises.. "), tail).alias("text"))
    return T.snippets(rows)


CONTEXT = SIGNS | {
    "cg": "SELECT program, string_agg(CAST(gene_id AS VARCHAR), ', ' ORDER BY k) AS genes FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS k FROM loading_l) WHERE k <= 20 GROUP BY program",
    "ct": "SELECT program, string_agg(term, ', ' ORDER BY k) AS terms FROM (SELECT program_name AS program, target_name AS term, row_number() OVER (PARTITION BY program_name ORDER BY adj_pval, target_name) AS k FROM assoc WHERE sample = 'c1') WHERE k <= 5 GROUP BY program",
    "cr": "SELECT program_name AS program, string_agg(role || ' ' || target_name, ', ' ORDER BY role || ' ' || target_name) AS regulators FROM (SELECT *, row_number() OVER (PARTITION BY program_name, role ORDER BY abs(log2FC) DESC, target_name) AS rank FROM signed) WHERE rank <= 3 OR n <= 8 GROUP BY program_name",
}


@register("context_assembly", "SELECT program, 'Genes: ' || coalesce(genes, 'Not available') || '; terms: ' || coalesce(terms, 'Not available') || '; regulators: ' || coalesce(regulators, 'Not available') AS context FROM cg FULL JOIN ct USING (program) FULL JOIN cr USING (program)", CONTEXT)
def context_assembly(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    terms = s.assoc.filter("sample = 'c1'").select(F.col("program_name").alias("program"), F.col("target_name").alias("term"), "adj_pval")
    return T.contexts(s.loading, terms, _by_sign(spark, sf_dir), "Genes: {genes}; terms: {terms}; regulators: {regulators}")


QUERY = {"arr": "SELECT program, list('g' || gene_id ORDER BY k) AS g FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS k FROM loading_l) WHERE k <= 6 GROUP BY program"}


@register("query_strings", "SELECT program, CAST(position AS INTEGER) AS position, q || ' AND role' AS query FROM (SELECT program, unnest(range(0, 6)) AS position, unnest([array_to_string(g, ' OR '), g[1] || ' AND ' || g[2], g[2] || ' AND ' || g[3], g[3] || ' AND ' || g[4], g[6] || ' AND (' || array_to_string(g[1:5], ' OR ') || ')', g[5] || ' AND (' || array_to_string(g[1:5], ' OR ') || ')']) AS q FROM arr)", QUERY)
def query_strings(spark, sf_dir):
    top = top_k(ScreenL(spark, sf_dir).loading, ["program"], [F.desc("score"), F.asc("gene_id")], 6)
    arr = top.groupBy("program").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "gene_id"))), lambda x: F.concat(F.lit("g"), x["gene_id"].cast("string"))).alias("g"))
    arr = arr.withColumn("r", F.array(F.get("g", F.lit(5)), F.get("g", F.lit(4))))
    return T.query_strings(arr, "program", "g", "r", "role")


@register("markdown_fields", "SELECT event_id, event_type AS label, 'value ' || value || chr(10) || 'of ' || user_id AS summary FROM events")
def markdown_fields(spark, sf_dir):
    e = ScreenL(spark, sf_dir).table("events")
    text = F.concat(F.lit("# Report\n**Label:** "), "event_type", F.lit("\n**Brief Summary:** value "), F.col("value").cast("string"), F.lit("\nof "), F.col("user_id").cast("string"), F.lit("\n**End:** x"))
    return e.select("event_id", T.markdown_fields(text, "Label").alias("label"), T.markdown_fields(text, "Brief Summary").alias("summary"))


@register("unique_names", "SELECT topic, CASE WHEN j = 1 THEN n ELSE n || ' ' || j END AS name FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY topic) AS j FROM (SELECT topic, CASE WHEN k = 1 OR k > 4 THEN b ELSE b || ' G' || (topic + k - 2) END AS n FROM (SELECT p_partkey AS topic, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS b, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k FROM part)))")
def unique_names(spark, sf_dir):
    p = ScreenL(spark, sf_dir).table("part")
    genes = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.concat(F.lit("G"), (F.col("p_partkey") + i).cast("string")))
    return T.unique_names(p.select(F.col("p_partkey").alias("topic"), F.split("p_name", " ").alias("words"), genes.alias("genes")), "topic", "words", "genes")


FUSE = {"found": "SELECT 'q' || (l_suppkey % 5) AS query, l_partkey AS pmid, 't' || l_partkey AS title, max(l_extendedprice) AS score FROM lineitem GROUP BY ALL"}


@register("query_fusion", "SELECT * FROM (SELECT *, row_number() OVER (ORDER BY hits DESC, score DESC, pmid) AS rank FROM (SELECT pmid, count(DISTINCT query) AS hits, list_sort(list(DISTINCT query)) AS sources, arg_min(title, query) AS title, max(score) AS score FROM found GROUP BY pmid)) WHERE rank <= 10", FUSE)
def query_fusion(spark, sf_dir):
    li = ScreenL(spark, sf_dir).table("lineitem")
    found = li.groupBy(F.concat(F.lit("q"), (F.col("l_suppkey") % 5).cast("string")).alias("query"), F.col("l_partkey").alias("pmid"), F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("title")).agg(F.max("l_extendedprice").alias("score"))
    return T.fuse_queries(found)


@register("enrichment_rows", "SELECT l_orderkey AS program, 'P' || l_partkey AS term, coalesce(CASE WHEN l_linenumber % 3 > 0 THEN l_discount END, 1.0) AS fdr, 'a|b' AS genes FROM lineitem")
def enrichment_rows(spark, sf_dir):
    li = ScreenL(spark, sf_dir).table("lineitem")
    row = F.struct(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("term"), F.when(F.col("l_linenumber") % 3 > 0, F.col("l_discount")).alias("fdr"), F.array(F.lit("a"), F.lit("b")).alias("genes"))
    return T.enrichment_rows(li.groupBy(F.col("l_orderkey").alias("program")).agg(F.collect_list(row).alias("r")), "program", "r")
