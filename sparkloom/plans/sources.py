"""Queries of readers and sinks; files are written to and read from a folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkloom.plans.association import rounded
from sparkloom.plans.registry import register
from sparkloom.sources import readers as R
from sparkloom.sources import sinks as K
from sparkloom.sources.tables import ScreenE, ScreenL, Source, shared_folder


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


@register("matrix_roundtrip", "SELECT program, CAST(gene_id AS VARCHAR) AS gene_id, score FROM loading_l")
def matrix_roundtrip(spark, sf_dir):
    """All genes, as rows; programs are the columns, of which there are few whatever the table."""
    loading, path = ScreenL(spark, sf_dir).loading, _folder(spark)
    loading.groupBy("gene_id").pivot("program").agg(F.first("score")).write.option("sep", "\t").option("header", True).csv(path)
    return R.read_matrix(spark, path, row="gene_id", column="program").filter("score IS NOT NULL").select("program", "gene_id", "score")


@register("result_files", "SELECT target_name, program_name, log2FC, adj_pval, sample FROM assoc")
def result_files(spark, sf_dir):
    a, path = ScreenL(spark, sf_dir).assoc, _folder(spark)
    a.write.partitionBy("sample").option("sep", "\t").option("header", True).csv(path)
    return R.read_results(spark, f"{path}/*/", r"sample=([^/]+)/", "target_name string, program_name string, log2FC double, adj_pval double").select("target_name", "program_name", "log2FC", "adj_pval", "sample")


@register("condition_union", "SELECT sample, target_name, program_name, adj_pval < 0.05 AS significant FROM assoc")
def condition_union(spark, sf_dir):
    a, path = ScreenL(spark, sf_dir).assoc, _folder(spark)
    for s in ("c0", "c1", "c2"):
        a.filter(F.col("sample") == s).drop("sample").write.option("sep", "\t").option("header", True).csv(f"{path}/25_perturbation_{s}.txt")
    found = R.union_conditions(spark, f"{path}/25_perturbation", ["c0", "c1", "c2"], schema=a.drop("sample").schema)
    return found.select("sample", "target_name", "program_name", (F.col("adj_pval") < 0.05).alias("significant"))


@register("result_sweep", "SELECT CAST(program_name AS INTEGER) % 5 AS K, sample, count(*) AS n, count(DISTINCT target_name) AS targets FROM assoc GROUP BY ALL")
def result_sweep(spark, sf_dir):
    a, path = ScreenL(spark, sf_dir).assoc.withColumn("K", F.col("program_name").cast("int") % 5).withColumn("sel_thresh", F.lit(2.0)), _folder(spark)
    K.write_partitioned(a, path)
    return spark.read.parquet(path).groupBy("K", "sample").agg(F.count("*").alias("n"), F.count_distinct("target_name").alias("targets"))


@register("completeness_check", "SELECT CAST(k AS INTEGER) AS K, 2.0::DOUBLE AS sel_thresh, s AS sample FROM (SELECT unnest(range(0, 7)) AS k), (SELECT unnest(['c0', 'c1', 'c2', 'c3']) AS s) WHERE (k, s) NOT IN (SELECT (CAST(program_name AS INTEGER) % 5, sample) FROM assoc)")
def completeness_check(spark, sf_dir):
    a = ScreenL(spark, sf_dir).assoc.withColumn("K", F.col("program_name").cast("int") % 5).withColumn("sel_thresh", F.lit(2.0))
    return R.expected_but_missing(a, list(range(7)), [2.0], ["c0", "c1", "c2", "c3"])


@register("gzip_text", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def gzip_text(spark, sf_dir):
    path = _folder(spark)
    Source(spark, sf_dir).table("customer").select("c_custkey", "c_name", "c_acctbal").write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)
    return R.read_delimited(spark, path, "c_custkey long, c_name string, c_acctbal double", partitions=8)


@register("gtf_reader", "SELECT 'chr' || (p_size % 22) AS chromosome, p_partkey * 100 AS start, p_name AS gene_name FROM part")
def gtf_reader(spark, sf_dir):
    path = _folder(spark)
    line = F.concat_ws("\t", F.concat(F.lit("chr"), F.col("p_size") % 22), F.lit("x"), F.lit("gene"), F.col("p_partkey") * 100, F.col("p_partkey") * 100 + 50, F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit('gene_id "'), "p_partkey", F.lit('"; gene_name "'), "p_name", F.lit('";')))
    spark.range(1).select(F.lit("#! header").alias("value")).union(Source(spark, sf_dir).table("part").select(line)).write.text(path)
    return R.read_gtf(spark, path).select("chromosome", "start", "gene_name")


@register("loci_reader", "SELECT 'chr' || (p_size % 22) AS chromosome, p_partkey * 100 AS start, p_name AS gene_name, p_retailprice AS seq_score FROM part")
def loci_reader(spark, sf_dir):
    path = _folder(spark)
    p = Source(spark, sf_dir).table("part")
    p.select(F.concat(F.lit("chr"), F.col("p_size") % 22).alias("chromosome"), (F.col("p_partkey") * 100).alias("start"), (F.col("p_partkey") * 100 + 50).alias("end"), F.lit("s").alias("seq_name"), F.col("p_type").alias("seq_class"), F.col("p_retailprice").alias("seq_score"), F.col("p_name").alias("gene_name")).write.option("sep", "\t").option("header", True).csv(path)
    return R.read_loci(spark, path).select("chromosome", "start", "gene_name", "seq_score")


@register("sparse_entries", "SELECT cell_id, gene_id, count AS value FROM expr_l")
def sparse_entries(spark, sf_dir):
    e = ScreenL(spark, sf_dir).expr
    cells = e.select("cell_id", F.xxhash64("cell_id").alias("cell_idx")).distinct()
    genes = e.select("gene_id", (F.col("gene_id") + 1).alias("gene_idx")).distinct()
    entries = e.select(F.xxhash64("cell_id").alias("cell_idx"), (F.col("gene_id") + 1).alias("gene_idx"), F.col("count").alias("value"))
    return R.sparse_entries(entries, cells, genes, cells)


@register("matrix_market", "SELECT CAST(l_orderkey + 1 AS BIGINT) AS row, l_partkey + 1 AS \"column\", sum(l_quantity) AS value FROM lineitem GROUP BY ALL")
def matrix_market(spark, sf_dir):
    path = _folder(spark)
    e = ScreenL(spark, sf_dir).expr.select((F.col("cell_id") + 1).alias("i"), (F.col("gene_id") + 1).alias("j"), "count")
    e.select(F.concat_ws(" ", "i", "j", "count")).write.text(path)
    size = e.agg(F.concat_ws(" ", F.coalesce(F.max("i"), F.lit(0)), F.coalesce(F.max("j"), F.lit(0)), F.count("*")).alias("size"))
    size.select(F.concat_ws("\n", F.lit("%%MatrixMarket matrix coordinate real general"), "size")).write.mode("append").text(path)
    return R.read_matrix_market(spark, path)


@register("geneset_library", "SELECT 'lib' AS library, p_brand AS term, CAST(p_partkey AS VARCHAR) AS gene FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY p_brand HAVING count(*) BETWEEN 70 AND 100)")
def geneset_library(spark, sf_dir):
    path = _folder(spark)
    terms = ScreenL(spark, sf_dir).geneset.groupBy("term").agg(F.collect_list(F.col("gene_id").cast("string")).alias("genes"))
    terms.select(F.to_json(F.create_map(F.lit("lib"), F.create_map("term", "genes")))).write.text(path)
    return R.read_genesets(spark, path, 70, 100, wholetext=False)


@register("gmt_reader", "SELECT p_type AS term, CAST(p_partkey AS VARCHAR) AS gene FROM part")
def gmt_reader(spark, sf_dir):
    path = _folder(spark)
    terms = ScreenL(spark, sf_dir).typeset.groupBy("term").agg(F.collect_list(F.col("gene_id").cast("string")).alias("g"))
    terms.select(F.concat_ws("\t", "term", F.lit("na"), F.array_join("g", "\t"))).write.text(path)
    return R.read_gmt(spark, path)


@register("alias_table", "SELECT c_custkey AS cust_key, c_name AS full_name FROM customer")
def alias_table(spark, sf_dir):
    c = Source(spark, sf_dir).table("customer")
    return R.with_lower_names(c.select(F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("FULL name"), F.lit(1).alias("full_name"))).select("cust_key", "full_name")


@register("batch_results", "SELECT CASE WHEN event_id % 5 <> 4 THEN CAST(event_id AS INTEGER) END AS topic, CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN event_type WHEN 3 THEN ' ' END AS text, CASE event_id % 5 WHEN 2 THEN 'errored' WHEN 3 THEN 'empty' WHEN 4 THEN 'corrupt' ELSE 'ok' END AS status FROM events")
def batch_results(spark, sf_dir):
    i = F.col("event_id").cast("string")
    ident = F.concat(F.lit('{"custom_id": "topic_'), i, F.lit('", '))
    line = (
        F.when(F.col("event_id") % 5 == 0, F.concat(ident, F.lit('"response": {"content": [{"text": "'), "event_type", F.lit('"}]}}')))
        .when(F.col("event_id") % 5 == 1, F.concat(ident, F.lit('"result": {"type": "succeeded", "message": {"content": [{"text": "'), "event_type", F.lit('"}]}}}')))
        .when(F.col("event_id") % 5 == 2, F.concat(ident, F.lit('"result": {"type": "errored"}}')))
        .when(F.col("event_id") % 5 == 3, F.concat(ident, F.lit('"response": {"content": [{"text": " "}]}}')))
        .otherwise(F.concat(F.lit("{broken"), i))
    )
    return R.parse_batch_lines(Source(spark, sf_dir).table("events").select(line.alias("value")))


@register("cache_first", "SELECT c_custkey, 'cached' AS origin FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'fetch' FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 1")
def cache_first(spark, sf_dir):
    c = Source(spark, sf_dir).table("customer").select("c_custkey")
    cached, fetch = R.cache_first(c.filter("c_custkey % 3 = 0"), c.filter("c_custkey % 2 = 0"), "c_custkey")
    return cached.withColumn("origin", F.lit("cached")).unionByName(fetch.withColumn("origin", F.lit("fetch")))


@register("sheet_chunks", "SELECT sheet, count(*) AS n, min(k) AS first_key FROM (SELECT (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 7000 AS sheet, l_orderkey AS k FROM lineitem) GROUP BY sheet")
def sheet_chunks(spark, sf_dir):
    li = Source(spark, sf_dir).table("lineitem")
    return K.sheets(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 7000).groupBy("sheet").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("first_key"))


@register("json_payload", "SELECT event_id, replace(event_type || '/' || user_id, '/', '_') AS file_key, '{\"user_id\":' || user_id || ',\"bad\":null}' AS payload FROM (SELECT DISTINCT event_id, event_type, user_id FROM events)")
def json_payload(spark, sf_dir):
    e = Source(spark, sf_dir).table("events").select("event_id", F.concat_ws("/", "event_type", "user_id").alias("key"), "user_id", F.lit(float("nan")).alias("bad"))
    out = K.json_payload(e, "key", ["user_id", "bad"])
    return e.select("event_id", "key").distinct().join(out.distinct(), "key").select("event_id", "file_key", "payload")


SHEETS = "SELECT 'perturbation' AS sheet, sample, program_name, target_name AS key, log2FC AS value FROM assoc UNION ALL SELECT 'significant', sample, program_name, target_name, log2FC FROM assoc WHERE adj_pval < 0.05 UNION ALL SELECT 'go', NULL, program, list_aggregate(list('g' || gene_id ORDER BY gene_id)[1:5], 'string_agg', ';'), count(*) FROM loading_l GROUP BY program"


@register("keyed_sheets", SHEETS)
def keyed_sheets(spark, sf_dir):
    """Two sheets of one (K, threshold) are written and read back; those without a file are left out."""
    s, path = ScreenL(spark, sf_dir), _folder(spark)
    head, tab = f"{path}/25_2_0/25_", {"sep": "\t", "header": True}
    for c in ("c0", "c1", "c2"):
        s.assoc.filter(F.col("sample") == c).drop("sample").write.options(**tab).csv(f"{head}perturbation_association_results_{c}.txt")
    genes = F.array_join(F.transform(F.array_sort(F.collect_list("gene_id")), lambda g: F.concat(F.lit("g"), g.cast("string"))), ";")
    s.loading.groupBy("program").agg(genes.alias("Genes"), F.count("*").alias("n")).write.options(**tab).csv(f"{head}GO_term_enrichment.txt")
    sheets = R.load_sheets(spark, path, 25, 2.0, ["c0", "c1", "c2"], n_genes=5)
    assert {n for n, df in sheets.items() if df is not None} == {"go", "perturbation", "significant"}
    both = [sheets[n].select(F.lit(n).alias("sheet"), "sample", "program_name", F.col("target_name").alias("key"), F.col("log2FC").cast("double").alias("value")) for n in ("perturbation", "significant")]
    go = sheets["go"].select(F.lit("go").alias("sheet"), F.lit(None).cast("string").alias("sample"), F.col("program").alias("program_name"), F.col("Genes").alias("key"), F.col("n").cast("double").alias("value"))
    return both[0].unionByName(both[1]).unionByName(go)


@register("long_effect_matrix", "SELECT target_name AS perturbation, program_name AS gene, adj_pval AS p_value, log2FC AS coef_gene FROM assoc WHERE sample = 'c2'")
def long_effect_matrix(spark, sf_dir):
    a, path = ScreenL(spark, sf_dir).assoc.filter("sample = 'c2'"), _folder(spark)
    K.long_matrix(a.select(F.col("target_name").alias("perturbation"), F.col("program_name").alias("gene"), F.col("adj_pval").alias("p_value"), F.col("log2FC").alias("coef_gene")), ["perturbation", "gene"], ["p_value", "coef_gene"]).write.parquet(path)
    return spark.read.parquet(path)


RUN = {
    "named": "SELECT g.gene_id, CASE WHEN k = 1 THEN s ELSE s || '-' || (k - 1) END AS symbol FROM (SELECT gene_id, s, row_number() OVER (PARTITION BY s ORDER BY CAST(gene_id AS VARCHAR)) AS k FROM (SELECT DISTINCT l.gene_id, coalesce(symbol, CAST(l.gene_id AS VARCHAR)) AS s FROM loading_l l LEFT JOIN gene_dict d ON d.gene_id = l.gene_id)) g",
    "scored": "SELECT program, condition, count(*) AS n_cells, sum(score) AS total FROM usage_l JOIN cells_l USING (cell_id) GROUP BY ALL",
    "grid": "SELECT unnest([10, 25]) AS K, unnest([1, 2]) AS times",
}


def _wide(df, row, column, value):
    """Lines of a matrix with a header; absent numbers are 0. Entries of a row lie in order and fill the gap before them, so a line takes time for its length."""
    columns = df.select(column).distinct().agg(F.array_sort(F.collect_list(column)).alias("c"))
    places = columns.select(F.posexplode("c").alias("at", column))
    entry = F.struct("at", F.coalesce(value, F.lit(0.0)).cast("string").alias("v"))
    rows = df.join(places, column).groupBy(row).agg(F.array_sort(F.collect_list(entry)).alias("e")).crossJoin(columns.select(F.size("c").alias("n")))
    before = lambda i: F.when(i == 0, -1).otherwise(F.get(F.col("e"), i - 1)["at"])
    filled = F.transform("e", lambda x, i: F.concat(F.repeat(F.lit("0.0\t"), x["at"] - before(i) - 1), x["v"]))
    line = F.concat(F.col(row).cast("string"), F.lit("\t"), F.array_join(filled, "\t"), F.repeat(F.lit("\t0.0"), F.col("n") - F.get("e", F.size("e") - 1)["at"] - 1))
    return columns.select(F.concat(F.lit("\t"), F.array_join(F.col("c").cast("array<string>"), "\t"))).union(rows.select(line))


@register("compiled_run", "SELECT K, 2.0::DOUBLE AS sel_thresh, 'loading' AS kind, program, CAST(gene_id AS VARCHAR) AS key, symbol AS label, round(score * times, 5) AS value FROM loading_l JOIN named USING (gene_id) CROSS JOIN grid UNION ALL SELECT K, 2.0, 'score', program, condition, CAST(n_cells AS VARCHAR), round(total * times, 2) FROM scored CROSS JOIN grid", RUN)
def compiled_run(spark, sf_dir):
    """A run of two K is written in its layout and compiled; the second K has all numbers doubled."""
    s, path = ScreenL(spark, sf_dir), _folder(spark)
    for k, times in ((10, 1), (25, 2)):
        _wide(s.usage.withColumn("score", F.col("score") * times), "cell_id", "program", "score").write.text(f"{path}/r.usages.k_{k}.dt_2_0.consensus.txt")
        _wide(s.loading.withColumn("score", F.col("score") * times), "program", "gene_id", "score").write.text(f"{path}/r.gene_spectra_score.k_{k}.dt_2_0.txt")
    run = R.compile_run(spark, path, "r", [10, 25], [2.0], s.cells.select("cell_id", "condition"), s.gene_dict.withColumn("gene_id", F.col("gene_id").cast("string")))
    loading = run["loadings"].filter("score <> 0").select("K", "sel_thresh", F.lit("loading").alias("kind"), "program", F.col("gene_id").alias("key"), F.col("symbol").alias("label"), F.round("score", 5).alias("value"))
    scores = run["scores"].filter("score <> 0").groupBy("K", "sel_thresh", "program", F.col("condition").alias("key")).agg(F.count("*").cast("string").alias("label"), F.round(F.sum("score"), 2).alias("value"))
    return loading.unionByName(scores.withColumn("kind", F.lit("score")))


@register("consolidated_runs", "SELECT CAST(l_linenumber AS INTEGER) + CASE WHEN l_suppkey % 2 = 1 THEN 10 ELSE 0 END AS replicate, 'spectra_' || l_returnflag AS name, l_suppkey, l_orderkey FROM lineitem WHERE l_returnflag <> 'R'")
def consolidated_runs(spark, sf_dir):
    li = Source(spark, sf_dir).table("lineitem").select(F.col("l_linenumber").alias("replicate"), F.concat(F.lit("spectra_"), "l_returnflag").alias("name"), "l_suppkey", "l_orderkey")
    both = R.consolidate([li.filter("l_suppkey % 2 = 0"), li.filter("l_suppkey % 2 = 1")], 10, "^spectra", "_R$")
    return both.select("replicate", "name", "l_suppkey", "l_orderkey")
