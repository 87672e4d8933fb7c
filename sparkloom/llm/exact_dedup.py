"""Exact dedup by progressive refinement, in DataFrame functions only.

Groups by length, then by the hash of a prefix, then by the full hash; each step
sees only rows whose group had another row in the step before. duplicate_groups
returns the full hash of every row, so it takes it in its one scan, and all later
steps move rows of about 100 bytes. exact_dedup returns no hash and reads the full
content of surviving groups only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import SEPARATORS, bits_filter, cut, without

PREFIX_CHARS = 64
ADDED = ["keep_id", "group_size", "kept", "text_sha256"]


def normalised(text: Column) -> Column:
    """The text without the characters of SEPARATORS; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for c in SEPARATORS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size, kept, text_sha256.

    Of texts equal after normalisation the longest original stays, then the
    smallest id; a null id loses ties. Null text counts as empty, so all empty
    texts form one group. Rows that repeat an id and its text count in group_size
    and all report that document's verdict. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = normalised(F.col(text_col))
    meta = cut(
        docs.select(F.col(id_col).alias("id"), F.length(text).alias("n_code"), norm.alias("norm")).select(
            "id",
            "n_code",
            F.length("norm").alias("n"),
            F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("prefix"),
            F.sha2("norm", 256).alias("full"),
        ),
        "exact-meta",
    )

    def shared(rows: DataFrame, *keys: str) -> DataFrame:
        """Keys of groups of two rows or more; counts are pre-aggregated, so a hot key is one row a task."""
        return cut(rows.groupBy(*keys).count().filter("count > 1").drop("count"), "exact-keys")

    same_length = meta.join(shared(meta, "n"), "n", "left_semi")
    same_prefix = same_length.join(shared(same_length, "n", "prefix"), ["n", "prefix"], "left_semi")
    best = F.min(F.struct((-F.col("n_code")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("id")))
    groups = cut(
        same_prefix.groupBy("n", "prefix", "full").agg(best.alias("best"), F.count("*").alias("size")).filter("size > 1").select("n", "prefix", "full", F.col("best.id").alias("kept_id"), "size"),
        "exact-groups",
    )
    joined = meta.join(groups, ["n", "prefix", "full"], "left")
    keep = F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("kept_id"))
    return joined.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("id")).alias("kept"),
        F.col("full").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all columns: the longest original, then the smallest id, nulls last.

    Lengths and prefix hashes come first; the full hash is taken only of rows whose group
    survived both. Rows that repeat an id and its text leave one row. Dropped rows are known by id and
    text, so other rows with the same id stay.
    """
    norm, text = normalised(F.col(text_col)), F.coalesce(F.col(text_col), F.lit(""))
    level = [F.length(norm).alias("n"), F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)).alias("prefix")]
    meta = cut(docs.select(*level), "exact-levels")
    lengths = cut(meta.groupBy("n").count().filter("count > 1").select("n"), "exact-lengths")
    pairs = meta.join(lengths, "n", "left_semi").groupBy("n", "prefix").count().filter("count > 1").select("n", "prefix")
    pairs = cut(pairs, "exact-prefixes")
    digest = F.sha2(norm, 256).alias("full")
    rest = bits_filter(docs.select(F.col(id_col).alias("id"), F.col(text_col), F.length(text).alias("n_code"), *level), pairs, "n", "prefix")
    rest = cut(rest.select("id", "n", "prefix", "n_code", F.xxhash64(text).alias("original"), digest).join(pairs, ["n", "prefix"], "left_semi"), "exact-full")
    first = F.struct((-F.col("n_code")).alias("a"), F.col("id").isNull().alias("b"), "id", "original")
    copies = rest.groupBy("n", "prefix", "full", "id", "n_code", "original").agg(F.count("*").alias("copies"))
    groups = cut(copies.groupBy("n", "prefix", "full").agg(F.min(first).alias("best"), F.sum("copies").alias("size")).filter("size > 1"), "exact-groups")
    judged = cut(copies.join(groups, ["n", "prefix", "full"]).withColumn("kept", first == F.col("best")), "exact-judged")
    named = [F.col("id").alias(id_col), F.col("original").alias("__original")]
    # the text's hash is no join key, so it is taken of rows with a matching id only
    same_text = lambda row, found: F.xxhash64(F.coalesce(row[text_col], F.lit(""))).bitwiseXOR(found["__original"]) == 0
    left = without(docs, judged.filter("NOT kept").select(*named), id_col, same_text)
    repeated = judged.filter("kept AND copies > 1").select(*named)
    if not repeated.isEmpty():
        found = repeated.withColumnRenamed(id_col, "__key")
        one = left.join(found, left[id_col].eqNullSafe(found["__key"]) & same_text(left, found), "left_semi").withColumn("__text", F.xxhash64(text)).dropDuplicates([id_col, "__text"])
        left = without(left, repeated, id_col, same_text).unionByName(one.drop("__text"))
    return left.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: group and verdict of every document."""
    return duplicate_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_code,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_code DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_code DESC, doc_id NULLS LAST) = doc_id AS kept,
       text_sha256
FROM d
"""
