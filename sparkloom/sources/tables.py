"""Canonical screen tables, derived from the relational tables of a data directory.

Two screens: E is built from embeddings (cells with dense program scores), L from
orders and line items (cells with sparse counts). ``program`` is always a string.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTROL = "non-targeting"
#: Rows that a task groups where tables are dealt by a key.
TASK_ROWS = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, which spark.checkpoint.dir names; one of its own only in local mode, else an error."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where:
        return where
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    where = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
    spark.sparkContext.setCheckpointDir(where)
    return where


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and a lost executor costs a re-read."""
    path = f"{shared_folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by keys into tasks of about TASK_ROWS, so that a task's memory doesn't grow with the table; groups and joins by the keys stay in them."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *keys)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table that written() wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Source:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


class ScreenE(Source):
    """Dense screen: 64 programs per cell."""

    @cached_property
    def cells(self) -> DataFrame:
        condition = F.concat(F.lit("c"), (F.col("label") % 3).cast("string"))
        return self.table("embeddings").select(F.col("vec_id").alias("cell_id"), condition.alias("condition"), F.concat(F.lit("b"), F.col("label").cast("string")).alias("category"))

    @cached_property
    def usage(self) -> DataFrame:
        e = self.table("embeddings").select(F.col("vec_id").alias("cell_id"), F.posexplode("embedding").alias("program", "e"))
        e = e.withColumn("e", F.col("e").cast("double"))
        return e.select("cell_id", F.col("program").cast("string").alias("program"), (F.col("e") * F.col("e")).alias("score"))

    @cached_property
    def signed(self) -> DataFrame:
        """Scores with their sign, for correlations."""
        e = self.table("embeddings").select(F.col("vec_id").alias("cell_id"), F.posexplode("embedding").alias("program", "e"))
        return e.select("cell_id", F.col("program").cast("string").alias("program"), F.col("e").cast("double").alias("score"))

    @cached_property
    def guides(self) -> DataFrame:
        g = self.spark.range(40).select(F.col("id").cast("int").alias("guide_name"))
        target = F.when(F.col("guide_name") % 10 == 0, CONTROL).otherwise(F.concat(F.lit("t"), (F.col("guide_name") % 10).cast("string")))
        return g.select("guide_name", target.alias("target"))

    @cached_property
    def assignment(self) -> DataFrame:
        v = self.table("embeddings").select(F.col("vec_id").alias("cell_id"))
        second = F.when(F.col("cell_id") % 5 == 0, (F.col("cell_id") * 7) % 40)
        both = F.array_distinct(F.array_compact(F.array(F.col("cell_id") % 40, second))).cast("array<int>")
        return v.select("cell_id", F.explode(both).alias("guide_name"), F.lit(1).alias("n"))


class ScreenL(Source):
    """Sparse screen: orders as cells, parts as genes, nations as programs and targets."""

    @cached_property
    def expr(self) -> DataFrame:
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"), "l_quantity")
        return dealt(lines, lines.count(), "cell_id").groupBy("cell_id", "gene_id").agg(F.sum("l_quantity").alias("count"))

    @cached_property
    def cells(self) -> DataFrame:
        o, c = self.table("orders"), self.table("customer")
        o = o.join(c, o.o_custkey == c.c_custkey)
        return o.select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderstatus").alias("condition"), F.col("o_orderpriority").alias("category"), F.col("o_totalprice").alias("total"), F.col("c_mktsegment").alias("segment"))

    @cached_property
    def _lines(self) -> DataFrame:
        li, s = self.table("lineitem"), self.table("supplier")
        return li.join(s, li.l_suppkey == s.s_suppkey)

    @cached_property
    def usage(self) -> DataFrame:
        return self._lines.groupBy(F.col("l_orderkey").alias("cell_id"), F.col("s_nationkey").cast("string").alias("program")).agg(F.sum("l_extendedprice").alias("score"))

    @cached_property
    def loading(self) -> DataFrame:
        score = (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("score")
        lines = self._lines.select(F.col("s_nationkey").cast("string").alias("program"), F.col("l_partkey").alias("gene_id"), score)
        return dealt(lines, self.table("lineitem").count(), "gene_id").groupBy("program", "gene_id").agg(F.round(F.sum("score"), 6).alias("score"))

    @cached_property
    def guides(self) -> DataFrame:
        s = self.table("supplier")
        return s.select(F.col("s_suppkey").alias("guide_name"), F.when(F.col("s_nationkey") == 0, CONTROL).otherwise(F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))).alias("target"))

    @cached_property
    def assignment(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_orderkey").alias("cell_id"), F.col("l_suppkey").alias("guide_name")).distinct().withColumn("n", F.lit(1))

    @cached_property
    def geneset(self) -> DataFrame:
        return self.table("part").select(F.col("p_brand").alias("term"), F.col("p_partkey").alias("gene_id"))

    @cached_property
    def typeset(self) -> DataFrame:
        return self.table("part").select(F.col("p_type").alias("term"), F.col("p_partkey").alias("gene_id"))

    @cached_property
    def trait(self) -> DataFrame:
        p = self.table("part")
        t = self._lines.join(p, self._lines.l_partkey == p.p_partkey)
        keys = [F.col("l_suppkey").alias("study"), F.col("p_type").alias("trait"), F.col("l_partkey").alias("gene_id"), F.col("l_discount").alias("pval")]
        return t.groupBy(*keys).agg(F.sum("l_quantity").alias("n_cases"))

    @cached_property
    def assoc(self) -> DataFrame:
        """A perturbation result table: target_name, program_name, sample, log2FC, adj_pval."""
        target = F.concat(F.lit("n"), (F.col("l_partkey") % 50).cast("string"))
        sample = F.concat(F.lit("c"), (F.col("l_linenumber") % 3).cast("string"))
        keys = [target.alias("target_name"), F.col("s_nationkey").cast("string").alias("program_name"), sample.alias("sample")]
        fold, adjusted = F.log(F.avg("l_quantity") / 25.5) * 2, F.abs(F.avg("l_tax") - 0.04) * 10
        return self._lines.groupBy(*keys).agg(F.round(fold, 6).alias("log2FC"), F.round(adjusted, 6).alias("adj_pval"))

    @cached_property
    def gene_dict(self) -> DataFrame:
        return self.table("part").filter("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("gene_id"), F.col("p_name").alias("symbol"))


class Papers(Source):
    @cached_property
    def papers(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("pmid"), F.substring("text", 1, 60).alias("title"), F.col("text").alias("abstract"))

    @cached_property
    def entities(self) -> DataFrame:
        tokens = F.explode(F.split(F.lower("text"), r"[^a-z]+"))
        return self.table("benchmark").select(tokens.alias("entity")).filter(F.length("entity") >= 5).distinct()
