"""Readers of the file formats of screens. All return long tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window as W

LOCI = StructType([
    StructField("chromosome", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("seq_name", StringType()),
    StructField("seq_class", StringType()), StructField("seq_score", DoubleType()), StructField("gene_name", StringType()),
])
BATCH_LINE = "struct<custom_id: string, response: struct<content: array<struct<text: string>>>, result: struct<type: string, message: struct<content: array<struct<text: string>>>>>"


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = "\t", partitions: int | None = None) -> DataFrame:
    """Delimited text with a header; a gzip file is one split, so ask for partitions behind it."""
    reader = spark.read.option("sep", sep).option("header", True)
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    return df.repartition(partitions) if partitions else df


def read_matrix(spark: SparkSession, path: str, row: str = "program", column: str = "gene_id", value: str = "score") -> DataFrame:
    """A wide matrix, row names in the first column, as (row, column, value)."""
    df = read_delimited(spark, path)
    first, *rest = df.columns
    return df.withColumnRenamed(first, row).withColumns({c: F.col(f"`{c}`").cast("double") for c in rest}).unpivot([row], [f"`{c}`" for c in rest] if any("." in c for c in rest) else rest, column, value)


def read_results(spark: SparkSession, pattern: str, name: str = r"_([^_/]+)\.txt$", schema: StructType | str | None = None) -> DataFrame:
    """All result files of a pattern in one read, each row with the sample that its file's name holds."""
    df = read_delimited(spark, pattern, schema)
    return df.withColumn("sample", F.regexp_extract(F.col("_metadata.file_path"), name, 1))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern names a file, in any store that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def union_conditions(spark: SparkSession, base: str, samples: list[str], sample_key: str = "sample", schema: StructType | str | None = None) -> DataFrame | None:
    """The result files {base}_{sample}.txt of all conditions in one read, each row with its condition.

    None if no condition has a file; if only some have, the others are an error of the read.
    """
    if not any(exists(spark, f"{base}_{s}.txt") for s in samples):
        return None
    reader = spark.read.option("sep", "\t").option("header", True)
    df = (reader.schema(schema) if schema is not None else reader).csv([f"{base}_{s}.txt" for s in samples])
    folder = rf"^.*_({'|'.join(sorted((re.escape(s) for s in samples), key=len, reverse=True))})\.txt(?:/.*)?$"
    return df.withColumn(sample_key, F.regexp_extract(F.col("_metadata.file_path"), folder, 1))


def load_sheets(spark: SparkSession, folder: str, k: int, threshold: float, samples: list[str], n_genes: int = 300, perturbation: str = "perturbation_association_results", sample_key: str = "sample", significant: float = 0.05) -> dict[str, DataFrame | None]:
    """The result tables of one (K, threshold) by sheet name; a sheet without a file is None.

    go, geneset, trait: terms with their first n_genes genes; perturbation: all conditions, and significant ones of them;
    association and explained_variance: by program.
    """
    head = f"{folder}/{k}_{str(threshold).replace('.', '_')}/{k}_"
    sheets: dict[str, DataFrame | None] = {}
    for name, file in (("go", "GO_term_enrichment"), ("geneset", "geneset_enrichment"), ("trait", "trait_enrichment")):
        found = read_delimited(spark, f"{head}{file}.txt") if exists(spark, f"{head}{file}.txt") else None
        sheets[name] = found.withColumn("Genes", F.array_join(F.slice(F.split("Genes", ";"), 1, n_genes), ";")) if found is not None else None
    for name, file in (("association", "categorical_association_results"), ("explained_variance", "Explained_Variance")):
        sheets[name] = read_delimited(spark, f"{head}{file}.txt") if exists(spark, f"{head}{file}.txt") else None
    every = union_conditions(spark, f"{head}{perturbation}", samples, sample_key)
    sheets["perturbation"] = every
    sheets["significant"] = every.filter(F.col("adj_pval").cast("double") < significant) if every is not None else None
    return sheets


RUN_FILE = r"\.k_([0-9]+)\.dt_([0-9]+(?:_[0-9]+)?)\.[^/]*$"


def read_wide(spark: SparkSession, paths: list[str], row: str, column: str, value: str = "score") -> DataFrame:
    """K, sel_thresh, row, column, value of wide matrices named ...k_{K}.dt_{threshold}...; any number of columns, as a line is split where it lies.

    The header line of a file begins with a separator, above the row names.
    """
    lines = spark.read.text(paths).withColumn("_file", F.regexp_extract(F.col("_metadata.file_path"), r"^(.*\.k_[0-9]+\.dt_[0-9_]+\.[^/]*)", 1))
    lines = lines.withColumn("K", F.regexp_extract("_file", RUN_FILE, 1).cast("int")).withColumn("sel_thresh", F.replace(F.regexp_extract("_file", RUN_FILE, 2), F.lit("_"), F.lit(".")).cast("double"))
    head = lines.filter(F.col("value").startswith("\t")).select("_file", F.posexplode(F.split("value", "\t")).alias("_at", column))
    body = lines.filter(~F.col("value").startswith("\t") & (F.col("value") != "")).withColumn("_parts", F.split("value", "\t"))
    # the row's name is taken first, so that its entries don't carry the whole line
    named = body.select("_file", "K", "sel_thresh", F.get("_parts", F.lit(0)).alias(row), "_parts")
    cells = named.select("_file", "K", "sel_thresh", row, F.posexplode("_parts").alias("_at", value)).filter("_at > 0")
    return cells.join(head.filter("_at > 0"), ["_file", "_at"]).select("K", "sel_thresh", row, column, F.col(value).cast("double").alias(value))


def unique_symbols(genes: DataFrame, names: DataFrame) -> DataFrame:
    """gene_id, symbol: the name of each gene, its id without one; later genes of one name get -1, -2 ..."""
    named = genes.select("gene_id").distinct().join(names.select("gene_id", "symbol").dropDuplicates(["gene_id"]), "gene_id", "left").withColumn("symbol", F.coalesce("symbol", "gene_id"))
    k = F.row_number().over(W.partitionBy("symbol").orderBy("gene_id")) - 1
    return named.select("gene_id", F.when(k == 0, F.col("symbol")).otherwise(F.concat_ws("-", "symbol", k.cast("string"))).alias("symbol"))


def compile_run(spark: SparkSession, folder: str, run: str, ks: list[int], thresholds: list[float], cells: DataFrame, names: DataFrame | None = None) -> dict[str, DataFrame]:
    """Scores and loadings of all (K, threshold) of a run, as long tables aligned with the cells and gene names.

    scores: K, sel_thresh, cell_id, program, score and the columns of ``cells``, for the cells that both have;
    loadings: K, sel_thresh, program, gene_id, symbol, score. Files: {run}.usages.k_{K}.dt_{t}.consensus.txt (cells by
    programs) and {run}.gene_spectra_score.k_{K}.dt_{t}.txt (programs by genes). A missing file is an error that names it.
    """
    at = [(k, str(t).replace(".", "_")) for k in ks for t in thresholds]
    usages = [f"{folder}/{run}.usages.k_{k}.dt_{t}.consensus.txt" for k, t in at]
    spectra = [f"{folder}/{run}.gene_spectra_score.k_{k}.dt_{t}.txt" for k, t in at]
    missing = [f for f in usages + spectra if not exists(spark, f)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    scores = read_wide(spark, usages, "cell_id", "program").withColumn("cell_id", F.col("cell_id").cast(cells.schema["cell_id"].dataType)).join(cells, "cell_id")
    loadings = read_wide(spark, spectra, "program", "gene_id")
    symbols = unique_symbols(loadings, names if names is not None else loadings.select("gene_id", F.col("gene_id").alias("symbol")))
    return {"scores": scores, "loadings": loadings.join(symbols, "gene_id").select("K", "sel_thresh", "program", "gene_id", "symbol", "score")}


def expected_but_missing(found: DataFrame, ks: list[int], thresholds: list[float], samples: list[str]) -> DataFrame:
    """(K, sel_thresh, sample) that should be there and aren't."""
    spark = found.sparkSession
    grid = spark.range(1).select(F.explode(F.array(*map(F.lit, ks))).alias("K")).withColumn("sel_thresh", F.explode(F.array(*map(F.lit, thresholds)))).withColumn("sample", F.explode(F.array(*map(F.lit, samples))))
    return grid.join(found.select("K", "sel_thresh", "sample").distinct(), ["K", "sel_thresh", "sample"], "left_anti")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF lines with gene_name from the attributes; comments are skipped."""
    schema = "chromosome string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"
    df = spark.read.option("sep", "\t").option("comment", "#").option("quote", "").schema(schema).csv(path)
    return df.withColumn("gene_name", F.regexp_extract("attributes", r'gene_name "([^"]+)"', 1))


def read_loci(spark: SparkSession, path: str) -> DataFrame:
    """Loci with the columns of LOCI; a file without them is an error."""
    df = read_delimited(spark, path)
    missing = [f.name for f in LOCI if f.name not in df.columns]
    if missing:
        raise ValueError(f"loci without {missing}")
    return df.select(*(F.col(f.name).cast(f.dataType) for f in LOCI))


def sparse_entries(entries: DataFrame, cells: DataFrame, genes: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """(cell_idx, gene_idx, value) with names for indices, restricted to shared cells."""
    out = entries.join(cells, "cell_idx").join(genes, "gene_idx").select("cell_id", "gene_id", "value")
    return out if kept is None else out.join(kept.select("cell_id").distinct(), "cell_id", "left_semi")


def read_matrix_market(spark: SparkSession, path: str) -> DataFrame:
    """(row, column, value) of a coordinate Matrix Market file, numbered from 1; the size line has as many parts and is the first of the file with the banner, which can stand beside files of entries only."""
    text = spark.read.text(path).withColumn("_file", F.col("_metadata.file_path")).withColumn("_start", F.col("_metadata.file_block_start"))
    banner = text.filter(F.col("value").startswith("%%MatrixMarket")).agg(F.min("_file").alias("_banner"))
    lines = text.withColumn("_i", F.monotonically_increasing_id()).filter(~F.col("value").startswith("%") & (F.trim("value") != ""))
    placed = lines.crossJoin(F.broadcast(banner)).withColumn("_at", F.struct((~F.col("_file").eqNullSafe(F.col("_banner"))).alias("other"), "_file", "_start", "_i"))
    numbered = placed.select("_at", F.split(F.trim("value"), r"\s+").alias("p"))
    head = numbered.agg(F.min("_at").alias("_first"))
    rows = numbered.crossJoin(F.broadcast(head)).filter("_at <> _first")
    return rows.select(F.get("p", F.lit(0)).cast("long").alias("row"), F.get("p", F.lit(1)).cast("long").alias("column"), F.get("p", F.lit(2)).cast("double").alias("value"))


def read_genesets(spark: SparkSession, path: str, least: int = 1, most: int = 10**9, wholetext: bool = True) -> DataFrame:
    """(library, term, gene) of JSON {library: {term: [genes]}}, one per file or else per line, sets of least to most genes."""
    maps = spark.read.text(path, wholetext=wholetext).select(F.from_json("value", "map<string, map<string, array<string>>>").alias("m"))
    terms = maps.select(F.explode("m").alias("library", "t")).select("library", F.explode("t").alias("term", "genes"))
    return terms.filter(F.size("genes").between(least, most)).select("library", "term", F.explode("genes").alias("gene"))


def read_gmt(spark: SparkSession, path: str) -> DataFrame:
    """(term, gene) of GMT lines: term, description, genes."""
    parts = spark.read.text(path).select(F.split("value", "\t").alias("p"))
    return parts.select(F.get("p", F.lit(0)).alias("term"), F.explode(F.slice("p", F.lit(3), F.size("p"))).alias("gene")).filter("gene <> ''")


def with_lower_names(df: DataFrame) -> DataFrame:
    """Column names in lower case with '_' for spaces; of names that then agree the first stays."""
    names: dict[str, str] = {}
    for c in df.columns:
        names.setdefault(c.strip().lower().replace(" ", "_"), c)
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in names.items()))


def parse_batch_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """topic, text, status of batch results: either response.content, or result.message.content of one that succeeded; the others are errored, empty or corrupt."""
    r = F.col("r")
    text = F.coalesce(F.get(r["response"]["content"], F.lit(0))["text"], F.when(r["result"]["type"] == "succeeded", F.get(r["result"]["message"]["content"], F.lit(0))["text"]))
    df = lines.select(F.from_json(column, BATCH_LINE).alias("r"))
    status = F.when(r.isNull() | r["custom_id"].isNull(), "corrupt").when(text.isNull(), "errored").when(F.trim(text) == "", "empty").otherwise("ok")
    return df.select(F.regexp_extract(r["custom_id"], r"topic_(\d+)", 1).try_cast("int").alias("topic"), text.alias("text"), status.alias("status"))


def cache_first(requested: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the cache that are asked for, and keys that still have to be fetched."""
    return cache.join(requested.select(key).distinct(), key, "left_semi"), requested.select(key).distinct().join(cache.select(key), key, "left_anti")


def consolidate(runs: list[DataFrame], offset: int = 10, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Replicates of several runs in one table: run i's numbers are raised by i * offset; names are kept by pattern."""
    out = None
    for i, df in enumerate(runs):
        if include:
            df = df.filter(F.col("name").rlike(include))
        if exclude:
            df = df.filter(~F.col("name").rlike(exclude))
        df = df.withColumn("replicate", F.col("replicate") + i * offset)
        out = df if out is None else out.unionByName(df)
    return out
