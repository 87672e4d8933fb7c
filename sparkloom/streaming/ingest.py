"""Result files as they arrive: a file stream into the partitioned result table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def result_stream(spark: SparkSession, folder: str, schema: str, name: str = r"_([^_/]+)\.txt$") -> DataFrame:
    """Rows of tab-separated result files in a folder, each with the sample that its file's name holds; new files are read once."""
    rows = spark.readStream.schema(schema).option("sep", "\t").option("header", True).csv(folder)
    return rows.withColumn("sample", F.regexp_extract(F.col("_metadata.file_path"), name, 1))


def append_results(stream: DataFrame, table: str, checkpoint: str, keys: tuple[str, ...] = ("sample",)) -> StreamingQuery:
    """Appends what has arrived, a folder per key, exactly once, and ends; run it again for later files."""
    return stream.writeStream.partitionBy(*keys).format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
