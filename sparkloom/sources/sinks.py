"""Writers of result tables, and the shapes that they write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

SHEET_ROWS = 1_048_575


def write_partitioned(df: DataFrame, path: str, keys: tuple[str, ...] = ("K", "sel_thresh", "sample"), form: str = "parquet") -> None:
    """A folder per key; written over per partition, so finished keys of other runs stay."""
    writer = df.repartition(*keys).write.partitionBy(*keys).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("sep", "\t").option("header", True).csv(path) if form == "csv" else writer.parquet(path)


def sheets(df: DataFrame, order: list[str], rows: int = SHEET_ROWS) -> DataFrame:
    """Adds the number of the sheet of at most ``rows`` rows that a row falls on.

    Rows are numbered range by range and the ranges' sizes are summed up, so no task holds the table.
    """
    ranged = df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id())
    sizes = ranged.groupBy("_p").count()
    before = F.coalesce(F.sum("count").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranged = ranged.withColumn("_k", F.row_number().over(W.partitionBy("_p").orderBy(*order)))
    out = ranged.join(sizes.withColumn("_b", before).drop("count"), "_p")
    return out.withColumn("sheet", F.floor((F.col("_b") + F.col("_k") - 1) / rows)).drop("_p", "_k", "_b")


def json_payload(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, file_key (safe characters only), payload: the columns as JSON, NaN and infinities as null."""
    clean = [F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(F.col(c)).alias(c) if df.schema[c].dataType.simpleString() in ("double", "float") else F.col(c) for c in columns]
    return df.select(key, F.regexp_replace(F.col(key).cast("string"), "[^A-Za-z0-9_-]", "_").alias("file_key"), F.to_json(F.struct(*clean), {"ignoreNullFields": "false"}).alias("payload"))


def long_matrix(effects: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Columns in a fixed order for the long matrix files."""
    return effects.select(*keys, *values)
