"""Evidence from a document table: sentences, mentions, relations, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sparkloom.operators.ranking import top_k
from sparkloom.sources.tables import written

#: Abbreviations that end no sentence.
ABBREVIATIONS = ["et al.", "e.g.", "i.e.", "Fig.", "Ref.", "vs."]
LEAST_CHARS = 10
HIDDEN_STOP = "\u0001"

BIOC = "struct<passages: array<struct<infons: map<string, string>, text: string, annotations: array<struct<infons: map<string, string>, text: string>>>>, relations: array<struct<infons: map<string, string>>>>"


def sentence_array(text: Column) -> Column:
    """Sentences longer than LEAST_CHARS: text cut after . ? ! and white space, but not inside an abbreviation."""
    for a in ABBREVIATIONS:
        text = F.replace(text, F.lit(a), F.lit(a.replace(".", HIDDEN_STOP)))
    parts = F.split(text, r"(?<=[.?!])\s+")
    plain = F.transform(parts, lambda s: F.regexp_replace(F.replace(s, F.lit(HIDDEN_STOP), F.lit(".")), r"^\s+|\s+$", ""))
    return F.filter(plain, lambda s: F.length(s) > LEAST_CHARS)


def sentences(docs: DataFrame, id_col: str, text: Column) -> DataFrame:
    """id, position, sentence."""
    return docs.select(F.col(id_col), F.posexplode(sentence_array(F.coalesce(text, F.lit("")))).alias("position", "sentence"))


def evidence(papers: DataFrame, entities: DataFrame, domain: list[str], verbs: list[str], n: int = 2) -> DataFrame:
    """The n best sentences per paper and entity that they name as a word, without regard to case.

    Score: 2 for each other entity, 1 for a domain word, 1 for a verb; repeats of a sentence
    count once, earlier ones win ties. Entities are words, so they meet sentences in a join
    on tokens and no pair of sentence and absent entity is made.
    """
    text = F.concat_ws(". ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
    rows = sentences(papers, "pmid", text)
    rows = rows.withColumn("_s", F.regexp_replace("sentence", r"^[ .]+|[ .]+$", "")).groupBy("pmid", "_s").agg(F.min(F.struct("position", "sentence")).alias("f")).select("pmid", "f.position", "f.sentence")
    low = F.lower("sentence")
    has = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w)).cast("int") if words else F.lit(0)
    rows = rows.withColumn("_base", has(domain) + has(verbs))
    named = rows.select("pmid", "position", "sentence", "_base", F.explode(F.array_distinct(F.split(low, r"[^\p{L}\p{N}_]+"))).alias("entity"))
    named = named.join(entities.select(F.lower("entity").alias("entity")).distinct(), "entity", "left_semi")
    others = F.count("*").over(W.partitionBy("pmid", "position")) - 1
    scored = named.withColumn("score", 2 * others + F.col("_base"))
    return top_k(scored, ["pmid", "entity"], [F.desc("score"), F.asc("position")], n).select("pmid", "entity", "sentence", "score", "rank")


def mechanistic(papers: DataFrame, pairs: DataFrame, verbs: list[str], n_both: int = 2, n_any: int = 3) -> DataFrame:
    """Sentences with a verb that name both members of a pair (as parts of words), the first n_both; without any, those that name the first, the first n_any.

    pairs: pmid, a, b.
    """
    rows = sentences(papers, "pmid", F.col("abstract"))
    low = F.lower("sentence")
    rows = rows.filter(F.exists(F.array(*map(F.lit, verbs)), lambda w: F.contains(low, w)))
    hit = pairs.join(rows, "pmid").filter(F.contains(low, F.lower("a")))
    hit = hit.withColumn("both", F.contains(low, F.lower("b")))
    some = F.max("both").over(W.partitionBy("pmid", "a", "b"))
    hit = hit.withColumn("some", some).filter("both OR NOT some")
    return top_k(hit, ["pmid", "a", "b"], [F.asc("position")], max(n_both, n_any)).filter(F.when(F.col("both"), F.col("rank") <= n_both).otherwise(F.col("rank") <= n_any)).select("pmid", "a", "b", "both", "sentence", "rank")


def parsed(annotated: DataFrame, id_col: str = "pmid", json_col: str = "payload") -> DataFrame:
    """id, d: the content of BioC JSON, read once and written, for mentions() and relations() of the same documents."""
    return written(annotated.select(id_col, F.from_json(json_col, BIOC).alias("d")), "bioc")


def _content(annotated: DataFrame, id_col: str, json_col: str) -> DataFrame:
    return annotated.select(id_col, F.col("d") if "d" in annotated.columns else F.from_json(json_col, BIOC).alias("d"))


def mentions(annotated: DataFrame, id_col: str = "pmid", json_col: str = "payload") -> DataFrame:
    """id, gene (upper case), texts: annotations of type Gene in BioC JSON, or in what parsed() made of it."""
    doc = _content(annotated, id_col, json_col)
    a = doc.select(id_col, F.explode("d.passages").alias("p")).select(id_col, F.explode("p.annotations").alias("a"))
    a = a.filter(F.col("a.infons")["type"] == "Gene").select(id_col, F.upper(F.coalesce(F.col("a.infons")["name"], F.col("a.text"))).alias("gene"), F.col("a.text").alias("text"))
    return a.groupBy(id_col, "gene").agg(F.array_sort(F.collect_set("text")).alias("texts"))


def relations(annotated: DataFrame, id_col: str = "pmid", json_col: str = "payload", kinds: tuple[str, ...] = ("Positive_Correlation", "Negative_Correlation")) -> DataFrame:
    """id, title, gene_a, gene_b, kind, score of gene-gene relations."""
    doc = _content(annotated, id_col, json_col)
    title = F.array_max(F.transform(F.filter("d.passages", lambda p: p["infons"]["type"] == "title"), lambda p: p["text"]))
    r = doc.select(id_col, title.alias("title"), F.explode("d.relations").alias("r")).select(id_col, "title", F.col("r.infons").alias("i"))
    r = r.select(id_col, "title", F.upper(F.col("i")["role1"]).alias("gene_a"), F.upper(F.col("i")["role2"]).alias("gene_b"), F.col("i")["type"].alias("kind"), F.col("i")["score"].try_cast("double").alias("score"))
    return r.filter(F.col("kind").isin(*kinds) & F.col("gene_a").isNotNull() & F.col("gene_b").isNotNull())


def regulator_evidence(found: DataFrame, regulators: DataFrame, mentioned: DataFrame, least: float = 0.5, n: int = 10) -> DataFrame:
    """Best relations of each regulator with another gene, one per gene and paper; without any, papers that mention it, at ``least``."""
    both = found.filter(F.col("score") >= least).select("pmid", F.col("gene_a").alias("regulator"), F.col("gene_b").alias("other"), "kind", "score")
    both = both.unionByName(found.filter(F.col("score") >= least).select("pmid", F.col("gene_b").alias("regulator"), F.col("gene_a").alias("other"), "kind", "score"))
    own = both.join(regulators.select("regulator").distinct(), "regulator", "left_semi").filter("regulator <> other")
    own = top_k(own, ["regulator", "other", "pmid"], [F.desc("score"), F.asc("kind")], 1).drop("rank")
    own = written(own, "own-relations")
    none = regulators.select("regulator").distinct().join(own.select("regulator").distinct(), "regulator", "left_anti")
    fallback = mentioned.select("pmid", F.col("gene").alias("regulator")).join(none, "regulator", "left_semi").select("pmid", "regulator", F.lit(None).cast("string").alias("other"), F.lit("Mentioned").alias("kind"), F.lit(least).alias("score"))
    return top_k(own.unionByName(fallback), ["regulator"], [F.desc("score"), F.asc("pmid"), F.asc("other")], n)


def top_by_sign(assoc: DataFrame, n: int = 3, all_up_to: int = 20, bound: float = 0.05) -> DataFrame:
    """Significant regulators by sign: falling effects activate, rising ones repress; n of each, or all of a program with few."""
    hits = assoc.filter((F.col("adj_pval") < bound) & (F.col("log2FC") != 0)).withColumn("role", F.when(F.col("log2FC") < 0, "activator").otherwise("repressor"))
    hits = hits.withColumn("_n", F.count("*").over(W.partitionBy("program_name")))
    ranked = hits.withColumn("rank", F.row_number().over(W.partitionBy("program_name", "role").orderBy(F.desc(F.abs("log2FC")), "target_name")))
    return ranked.filter((F.col("rank") <= n) | (F.col("_n") <= all_up_to)).drop("_n")


def regulators_with_edges(top: DataFrame, edges: DataFrame, genes: DataFrame) -> DataFrame:
    """Each program's regulators with their edges to its genes: number of targets and the targets by falling weight.

    edges: regulator, gene_id, weight. genes: program_name, gene_id.
    """
    hit = edges.join(genes, "gene_id").groupBy("program_name", "regulator").agg(F.count("*").alias("n_targets"), F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), "gene_id"))).alias("t"))
    hit = hit.select("program_name", F.col("regulator").alias("target_name"), "n_targets", F.col("t.gene_id").alias("targets"))
    return top.join(hit, ["program_name", "target_name"], "left").fillna(0, ["n_targets"])


def driver_summaries(drivers: DataFrame, summaries: DataFrame) -> DataFrame:
    """program -> map of gene to summary, for genes with one. The look-up is over distinct genes."""
    found = drivers.select("gene_id").distinct().join(summaries, "gene_id")
    return drivers.join(found, "gene_id").groupBy("program").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("gene_id", "summary")))).alias("summaries"))


def read_bands(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def check_citations(claims: DataFrame, mentioned: DataFrame) -> DataFrame:
    """Per claim (claim_id, pmid, gene): found of claimed genes, passed if any, confidence as their share, missing ones."""
    known = mentioned.select("pmid", F.upper("gene").alias("_g")).distinct().withColumn("_hit", F.lit(True))
    rows = claims.withColumn("_g", F.upper("gene")).join(known, ["pmid", "_g"], "left")
    return rows.groupBy("claim_id", "pmid").agg(
        F.count_if(F.coalesce("_hit", F.lit(False))).alias("found"),
        F.count("*").alias("claimed"),
        F.bool_or(F.coalesce("_hit", F.lit(False))).alias("passed"),
        (F.count_if(F.coalesce("_hit", F.lit(False))) / F.count("*")).alias("confidence"),
        F.array_sort(F.collect_set(F.when(F.col("_hit").isNull(), F.col("gene")))).alias("missing"),
    )


def badge(checks: DataFrame) -> DataFrame:
    """VERIFIED if all of a paper's checks passed, else the first failed one, UNVERIFIED without checks; in order of passing and evidence."""
    per = checks.groupBy("pmid").agg(F.bool_and("passed").alias("all_passed"), F.min_by("name", F.when(~F.col("passed"), F.col("priority"))).alias("_failed"), F.sum("evidence").alias("evidence"), F.count("passed").alias("_n"))
    kind = F.when(F.col("_n") == 0, "UNVERIFIED").when(F.col("all_passed"), "VERIFIED").otherwise(F.col("_failed"))
    out = per.select("pmid", kind.alias("badge"), F.coalesce("all_passed", F.lit(False)).alias("all_passed"), "evidence")
    return out.orderBy(F.desc("all_passed"), F.desc("evidence"), "pmid")


def snippets(df: DataFrame, n: int = 5) -> DataFrame:
    """gene, text rows: one per PMID and one per normalised text, the first n; '..' becomes '.', a final stop is added."""
    rows = df.withColumn("_pmid", F.regexp_extract("text", r"PMID:?\s*(\d+)", 1)).withColumn("_t", F.lower(F.regexp_replace("text", r"[^\p{L}\p{N}]+", " ")))
    rows = rows.withColumn("_p", F.when(F.col("_pmid") == "", F.concat(F.lit("row"), F.col("position"))).otherwise(F.col("_pmid")))
    for key in ("_p", "_t"):
        rows = rows.withColumn("_k", F.row_number().over(W.partitionBy("gene", key).orderBy("position"))).filter("_k = 1").drop("_k")
    rows = top_k(rows, ["gene"], [F.asc("position")], n)
    clean = F.regexp_replace(F.trim("text"), r"\.{2,}", ".")
    return rows.select("gene", "rank", F.when(clean.endswith("."), clean).otherwise(F.concat(clean, F.lit("."))).alias("text"))


def contexts(genes: DataFrame, terms: DataFrame, regulators: DataFrame, template: str, n_genes: int = 20, n_terms: int = 5) -> DataFrame:
    """One text per program from a template with {genes}, {terms} and {regulators}; parts without rows say 'Not available'."""
    joined = lambda value, order: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).cast("string").alias("v")))), lambda x: x["v"]), ", ")
    g = top_k(genes, ["program"], [F.desc("score"), F.asc("gene_id")], n_genes).groupBy("program").agg(joined("gene_id", "rank").alias("genes"))
    t = top_k(terms, ["program"], [F.asc("adj_pval"), F.asc("term")], n_terms).groupBy("program").agg(joined("term", "rank").alias("terms"))
    r = regulators.withColumn("_l", F.concat_ws(" ", "role", "target_name")).groupBy(F.col("program_name").alias("program")).agg(F.array_join(F.array_sort(F.collect_list("_l")), ", ").alias("regulators"))
    out = g.join(t, "program", "full").join(r, "program", "full").fillna("Not available", ["genes", "terms", "regulators"])
    text = F.lit(template)
    for name in ("genes", "terms", "regulators"):
        text = F.replace(text, F.lit("{" + name + "}"), F.col(name))
    return out.select("program", text.alias("context"))


def query_strings(df: DataFrame, program: str, genes: str, regulators: str, verb: str | None = None, n: int = 8) -> DataFrame:
    """Search strings of each program from arrays: all genes joined by OR, three neighbouring pairs, three regulators with the first five genes."""
    quoted = lambda a, k: F.array_join(F.slice(a, 1, k), " OR ")
    g, r = F.col(genes), F.col(regulators)
    pairs = F.transform(F.sequence(F.lit(0), F.least(F.lit(2), F.greatest(F.size(g) - 2, F.lit(-1)))), lambda i: F.concat_ws(" AND ", F.get(g, i), F.get(g, i + 1)))
    pairs = F.when(F.size(g) >= 2, pairs).otherwise(F.array().cast("array<string>"))
    regs = F.transform(F.slice(r, 1, 3), lambda x: F.concat(x, F.lit(" AND ("), quoted(g, 5), F.lit(")")))
    every = F.slice(F.concat(F.array(F.array_join(g, " OR ")), pairs, regs), 1, n)
    tail = F.lit(f" AND {verb}" if verb else "")
    return df.select(program, F.posexplode(every).alias("position", "q")).select(program, "position", F.concat("q", tail).alias("query"))


def markdown_fields(c: Column, label: str) -> Column:
    """Text after **Label:** up to the next label, white space trimmed."""
    return F.trim(F.regexp_extract(c, rf"(?is)\*\*{label}:\*\*\s*(.*?)(?=\s*\n\s*\*\*[A-Za-z ]+:\*\*|\z)", 1))


def unique_names(df: DataFrame, topic: str, keywords: str, genes: str) -> DataFrame:
    """Base of three keywords in title case; a repeated base gets the topic's gene of that rank, and what still repeats a counter, in topic order."""
    base = F.initcap(F.array_join(F.slice(F.col(keywords), 1, 3), " "))
    rows = df.withColumn("_b", base).withColumn("_k", F.row_number().over(W.partitionBy("_b").orderBy(topic)))
    gene = F.get(F.col(genes), F.col("_k") - 2)
    rows = rows.withColumn("_n", F.when(F.col("_k") == 1, F.col("_b")).otherwise(F.concat_ws(" ", "_b", gene)))
    rows = rows.withColumn("_j", F.row_number().over(W.partitionBy("_n").orderBy(topic)))
    return rows.select(topic, F.when(F.col("_j") == 1, F.col("_n")).otherwise(F.concat_ws(" ", "_n", F.col("_j").cast("string"))).alias("name"))


def fuse_queries(results: DataFrame, n: int = 10) -> DataFrame:
    """Papers by number of queries that found them, then best score: hits, sources, first title, rank. results: query, pmid, title, score."""
    per = results.groupBy("pmid").agg(F.count_distinct("query").alias("hits"), F.array_sort(F.collect_set("query")).alias("sources"), F.min_by("title", "query").alias("title"), F.max("score").alias("score"))
    ranked = per.orderBy(F.desc("hits"), F.desc("score"), "pmid").limit(n)
    return ranked.withColumn("rank", F.row_number().over(W.orderBy(F.desc("hits"), F.desc("score"), "pmid")))


def enrichment_rows(df: DataFrame, program: str, results: str) -> DataFrame:
    """Nested result lists as rows with defaults, genes joined by '|'."""
    return df.select(program, F.explode(results).alias("r")).select(program, F.col("r.term").alias("term"), F.coalesce("r.fdr", F.lit(1.0)).alias("fdr"), F.array_join("r.genes", "|").alias("genes"))
