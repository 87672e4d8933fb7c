"""Queries of factorisation and motif scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import factor as N
from sparkloom.plans.association import rounded
from sparkloom.plans.registry import register
from sparkloom.sources.tables import ScreenL, dealt, written


def _matrix(spark, sf_dir, n_top: int = 100):
    s = ScreenL(spark, sf_dir)
    genes = N.variable_genes(s.expr, s.cells.count(), n_top)
    return written(N.prepare(s.expr, genes), "factor-matrix"), n_top


@register("variable_genes", "SELECT gene_id, round(var / mean, 6) AS dispersion, row_number() OVER (ORDER BY var / mean DESC, gene_id) AS rank FROM (SELECT gene_id, sum(count) / any_value(n) AS mean, (sum(count * count) - sum(count) * sum(count) / any_value(n)) / (any_value(n) - 1) AS var FROM expr_l CROSS JOIN (SELECT count(*)::DOUBLE AS n FROM cells_l) GROUP BY gene_id) ORDER BY rank LIMIT 200")
def variable_genes(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    return rounded(N.variable_genes(s.expr, s.cells.count(), 200).select("gene_id", "dispersion", "rank"), "dispersion")


@register("factorise_replicates")
def factorise_replicates(spark, sf_dir):
    matrix, n = _matrix(spark, sf_dir)
    return N.replicates(matrix, n, [3], 2, rounds=5)


@register("factorise_kl_minibatch")
def factorise_kl_minibatch(spark, sf_dir):
    matrix, n = _matrix(spark, sf_dir)
    return N.replicates(matrix, n, [3], 1, loss="kl", rounds=3, inner=3, fraction=0.5)


@register("consensus_programs")
def consensus_programs(spark, sf_dir):
    matrix, n = _matrix(spark, sf_dir)
    return N.consensus(N.replicates(matrix, n, [3], 4, rounds=5), 3)


@register("consensus_usage")
def consensus_usage(spark, sf_dir):
    matrix, n = _matrix(spark, sf_dir)
    return N.usages(matrix, N.median_matrix(N.consensus(N.replicates(matrix, n, [3], 3, rounds=5), 3), n))


@register("consensus_spectra")
def consensus_spectra(spark, sf_dir):
    """Spectra of all genes, in TPM, refitted to the usages of the consensus programs."""
    matrix, n = _matrix(spark, sf_dir)
    usage = N.usages(matrix, N.median_matrix(N.consensus(N.replicates(matrix, n, [3], 3, rounds=5), 3), n))
    return N.refit_spectra(N.tpm(ScreenL(spark, sf_dir).expr), usage)


@register("factorise_solvers")
def factorise_solvers(spark, sf_dir):
    """algo, loss, init, round, objective: the course of each solver from the same matrix."""
    matrix, n = _matrix(spark, sf_dir)
    rows = []
    for algo, loss, init in (("mu", "frobenius", "random"), ("hals", "frobenius", "random"), ("halsvar", "frobenius", "nndsvd"), ("bpp", "frobenius", "nndsvd"), ("mu", "kl", "random"), ("mu", "is", "random")):
        history: list = []
        N.factorise(matrix, n, 3, 1, algo=algo, loss=loss, init=init, rounds=3, inner=4, history=history)
        rows += [(algo, loss, init, i, v) for i, v in enumerate(history[0])]
    return spark.createDataFrame(rows, "algo string, loss string, init string, round int, objective double")


@register("factorise_online")
def factorise_online(spark, sf_dir):
    """component, dim, value: spectra after two passes in which each cell is in one of four batches."""
    matrix, n = _matrix(spark, sf_dir)
    h = N.factorise_online(matrix, n, 3, 1, batches=4, passes=2)
    return spark.createDataFrame([(c, row.tolist()) for c, row in enumerate(h)], "component int, h array<double>").select("component", F.posexplode("h").alias("dim", "value"))


@register("k_selection_table")
def k_selection_table(spark, sf_dir):
    """K, silhouette, prediction_error of factorisations with two to four programs."""
    matrix, n = _matrix(spark, sf_dir)
    return N.k_selection(matrix, n, N.replicates(matrix, n, [2, 3, 4], 3, rounds=4))


@register("cluster_two_runs")
def cluster_two_runs(spark, sf_dir):
    """Cluster labels of two runs' spectra beside the overlap of their top genes."""
    matrix, n = _matrix(spark, sf_dir)
    spectra = N.replicates(matrix, n, [4], 2, rounds=4)
    run = lambda i: spectra.filter(F.col("replicate") == i).select(F.col("component").cast("string").alias("program"), F.col("dim").alias("gene_id"), F.col("value").alias("score"))
    return N.cluster_two_runs(run(0), run(1), 2, 20)


@register("expression_pca")
def expression_pca(spark, sf_dir):
    """Scores of z-scored log counts per 10,000 of the 50 most variable genes."""
    s = ScreenL(spark, sf_dir)
    genes = written(N.variable_genes(s.expr, s.cells.count(), 50), "variable-genes")
    rows, mean, scale = N.prepare_log(s.expr, genes)
    return N.pca(rows, genes.count(), 5, mean, scale)


NEAREST = {
    "gv": "SELECT gene_id, list(coalesce(score, 0.0) ORDER BY program) AS v FROM (SELECT DISTINCT gene_id FROM loading_l) CROSS JOIN (SELECT DISTINCT program FROM loading_l) LEFT JOIN loading_l USING (program, gene_id) GROUP BY gene_id",
    "gc": "SELECT gene_id, list_transform(v, lambda x: x - list_avg(v)) AS c FROM gv",
    "gu": "SELECT gene_id, list_transform(c, lambda x: x / sqrt(list_inner_product(c, c))) AS u FROM gc WHERE list_inner_product(c, c) > 0",
    "gp": "SELECT a.gene_id AS a, b.gene_id AS b, list_inner_product(a.u, b.u) AS r FROM gu a, gu b WHERE a.gene_id <> b.gene_id",
}


@register("nearest_genes", "SELECT a, b, sign, round(r, 6) AS r FROM (SELECT a, b, 1 AS sign, r FROM gp QUALIFY row_number() OVER (PARTITION BY a ORDER BY r DESC, b) <= 5 UNION ALL SELECT a, b, -1, r FROM gp QUALIFY row_number() OVER (PARTITION BY a ORDER BY r, b) <= 5)", NEAREST)
def nearest_genes(spark, sf_dir):
    """The five genes whose loadings correlate most with a gene's, and the five that correlate least."""
    s = ScreenL(spark, sf_dir)
    programs = sorted(r[0] for r in s.loading.select("program").distinct().collect())
    vectors = s.loading.groupBy("gene_id").agg(*(F.coalesce(F.sum(F.when(F.col("program") == p, F.col("score"))), F.lit(0.0)).alias(f"p{i}") for i, p in enumerate(programs)))
    vectors = written(vectors.select(F.col("gene_id").alias("id"), F.array(*(f"p{i}" for i in range(len(programs)))).alias("v")), "gene-vectors")
    return rounded(N.nearest_correlations(vectors, 5).withColumnRenamed("value", "r"), "r")


#: Keys of a range in which chunks are numbered by one task.
RANGE_KEYS = 4096


def _sequences(spark, sf_dir):
    """A genome from the digests of parts, 64 bases a chunk, numbered by ranges of keys and the ranges' totals."""
    p = ScreenL(spark, sf_dir).table("part").withColumn("_range", F.floor(F.col("p_partkey") / RANGE_KEYS))
    sizes = p.groupBy("_range").count()
    before = F.coalesce(F.sum("count").over(N.W.orderBy("_range").rowsBetween(N.W.unboundedPreceding, -1)), F.lit(0))
    bases = F.upper(F.translate(F.md5(F.col("p_partkey").cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT"))
    place = F.row_number().over(N.W.partitionBy("_range").orderBy("p_partkey"))
    genome = p.select(F.lit("chr1").alias("chromosome"), F.concat(bases, bases).alias("bases"), "p_partkey", "_range", place.alias("_k"))
    genome = genome.join(sizes.select("_range", before.alias("_before")), "_range")
    return genome.select("chromosome", "bases", "p_partkey", (F.col("_before") + F.col("_k") - 1).cast("long").alias("chunk"))


GENOME = {
    "chunks": "SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS chunk, upper(translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT')) AS half FROM part",
    "whole": "SELECT string_agg(half || half, '' ORDER BY chunk) AS g FROM chunks",
    "wins": "SELECT 's' || i AS seq_name, 'g' || (i % 7) AS gene_name, substring(g, CAST(i * 37 + 50 - 40 + 1 AS BIGINT), 80) AS seq FROM whole CROSS JOIN (SELECT chunk AS i FROM chunks)",
}


def _windows(spark, sf_dir):
    i = F.col("chunk")
    genome = _sequences(spark, sf_dir).drop("p_partkey")
    loci = genome.select(F.lit("chr1").alias("chromosome"), (i * 37).alias("start"), (i * 37 + 100).alias("end"), F.concat(F.lit("s"), i).alias("seq_name"), F.concat(F.lit("g"), i % 7).alias("gene_name"))
    return N.locus_windows(genome, loci, 80)


@register("locus_windows", "SELECT seq_name, gene_name, seq FROM wins WHERE seq <> ''", GENOME)
def locus_windows(spark, sf_dir):
    return _windows(spark, sf_dir)


MOTIFS = {"acgt": [[0.97, 0.01, 0.01, 0.01], [0.01, 0.97, 0.01, 0.01], [0.01, 0.01, 0.97, 0.01], [0.01, 0.01, 0.01, 0.97]], "caag": [[0.01, 0.97, 0.01, 0.01], [0.97, 0.01, 0.01, 0.01], [0.97, 0.01, 0.01, 0.01], [0.01, 0.01, 0.97, 0.01]]}
HITS = GENOME | {
    "subs": "SELECT seq_name, gene_name, p AS position, substring(seq, CAST(p + 1 AS BIGINT), 4) AS w FROM wins, (SELECT unnest(range(0, 77)) AS p) WHERE length(substring(seq, CAST(p + 1 AS BIGINT), 4)) = 4",
    "hits": "SELECT seq_name, gene_name, 'acgt' AS motif, position, unnest(['+', '-']) AS strand FROM subs WHERE w = 'ACGT' UNION ALL SELECT seq_name, gene_name, 'caag', position, '+' FROM subs WHERE w = 'CAAG' UNION ALL SELECT seq_name, gene_name, 'caag', position, '-' FROM subs WHERE w = 'CTTG'",
}


@register("motif_scan", "SELECT seq_name, gene_name, motif, position, strand FROM hits", HITS)
def motif_scan(spark, sf_dir):
    return N.scan_motifs(_windows(spark, sf_dir), MOTIFS, p_max=0.005).select("seq_name", "gene_name", "motif", "position", "strand")


@register("motif_counts", "SELECT gene_name, motif, count(*) AS n FROM hits GROUP BY ALL", HITS)
def motif_counts(spark, sf_dir):
    return N.motif_counts(N.scan_motifs(_windows(spark, sf_dir), MOTIFS, p_max=0.005), literal=True)


@register("hits_with_loci", "SELECT h.seq_name, h.motif, h.position, h.strand, 'class' || length(h.gene_name) AS seq_class FROM hits h", HITS)
def hits_with_loci(spark, sf_dir):
    hits = N.scan_motifs(_windows(spark, sf_dir), MOTIFS, p_max=0.005)
    loci = _sequences(spark, sf_dir).select(F.concat(F.lit("s"), "chunk").alias("seq_name"), F.concat(F.lit("class"), F.length(F.concat(F.lit("g"), F.col("chunk") % 7))).alias("seq_class"))
    return hits.join(loci, "seq_name").select("seq_name", "motif", "position", "strand", "seq_class")


ENRICH = {
    "mc": "SELECT l_partkey AS gene_id, 'm' || (l_linenumber % 5) AS motif, count(*)::DOUBLE AS n FROM lineitem GROUP BY ALL",
    "dense": "SELECT p.program, m.motif, g.gene_id, coalesce(l.score, 0) AS x, coalesce(mc.n, 0) AS y FROM (SELECT DISTINCT program FROM loading_l) p CROSS JOIN (SELECT DISTINCT motif FROM mc) m CROSS JOIN (SELECT p_partkey AS gene_id FROM part) g LEFT JOIN loading_l l ON l.program = p.program AND l.gene_id = g.gene_id LEFT JOIN mc ON mc.motif = m.motif AND mc.gene_id = g.gene_id",
}


RANKED = ENRICH | {"ranked": "SELECT program, motif, rank() OVER (PARTITION BY program, motif ORDER BY x) + (count(*) OVER (PARTITION BY program, motif, x) - 1) / 2.0 AS x, rank() OVER (PARTITION BY program, motif ORDER BY y) + (count(*) OVER (PARTITION BY program, motif, y) - 1) / 2.0 AS y FROM dense"}


def _motif_table(spark, sf_dir):
    s = ScreenL(spark, sf_dir)
    lines = s.table("lineitem").select(F.col("l_partkey").alias("gene_id"), F.concat(F.lit("m"), F.col("l_linenumber") % 5).alias("motif"))
    counts = dealt(lines, lines.count(), "gene_id").groupBy("gene_id", "motif").agg(F.count("*").alias("n"))
    return s.loading, counts, s.table("part").select(F.col("p_partkey").alias("gene_id"))


@register("motif_enrichment", "SELECT program, motif, round(corr(x, y), 6) AS stat FROM dense GROUP BY ALL", ENRICH)
def motif_enrichment(spark, sf_dir):
    return rounded(N.motif_enrichment(*_motif_table(spark, sf_dir)).select("program", "motif", "stat"), "stat")


@register("motif_enrichment_spearman", "SELECT program, motif, round(corr(x, y), 6) AS stat FROM ranked GROUP BY ALL", RANKED)
def motif_enrichment_spearman(spark, sf_dir):
    return rounded(N.motif_enrichment(*_motif_table(spark, sf_dir), correlation="spearman").select("program", "motif", "stat"), "stat")


@register("motif_enrichment_kendall")
def motif_enrichment_kendall(spark, sf_dir):
    return N.motif_enrichment(*_motif_table(spark, sf_dir), correlation="kendall")
