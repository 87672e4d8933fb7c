"""Small helpers shared by the text operators: words, lineage cuts, Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words in every operator here: space and \x09 to \x0D.
SEPARATORS = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Bits of the filter in bits_filter: at most 131,072 rows of two longs are sent, about 2 MB.
FILTER_BITS = 1 << 23


def words_of(text: str | None) -> list[bytes]:
    """Words of one text as UTF-8; bytes.split() separates at exactly SEPARATORS."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, which spark.checkpoint.dir names; one of its own only in local mode, where the driver is the one executor.

    Elsewhere a folder of one machine would lose rows, so an unset folder is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
        spark.sparkContext.setCheckpointDir(where)
    return where


#: Tables written within scratch(), to be deleted at its end.
_MADE: ContextVar[list | None] = ContextVar("made", default=None)


def cut(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back, which ends its lineage there.

    A lost executor then costs a re-read, not a recomputation. Within scratch() the table is deleted at its end unless kept.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if _MADE.get() is not None and not keep:
        _MADE.get().append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch() -> Iterator[None]:
    """Deletes what cut() writes inside, once that is done; a result that outlives it is cut with keep."""
    made: list = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for spark, path in made:
            _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table that cut() wrote, once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def _marked(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with __hit: false if the key is surely not in ``wanted``, with no row moved.

    A bitmap of FILTER_BITS hashed keys, of that fixed size whatever is wanted, is sent to the
    scan; when it fills up, more other rows are hit.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    placed = lambda df: df.withColumn("__word", F.floor(place / 64)).withColumn("__at", (place % 64).cast("int")).withColumn("__bit", F.expr("shiftleft(1L, __at)"))
    bitmap = placed(wanted).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    hit = F.coalesce(F.col("__bits").bitwiseAND(F.col("__bit")) != 0, F.lit(False))
    return placed(rows).join(F.broadcast(bitmap), "__word", "left").select(*rows.columns, hit.alias("__hit"))


def bits_filter(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """The rows whose key may be in ``wanted``; nearly all others are gone before any is moved. An exact semi-join has to follow."""
    return _marked(rows, wanted, *keys).filter("__hit").drop("__hit")


def without(rows: DataFrame, gone: DataFrame, key: str, same: Callable[[DataFrame, DataFrame], Column] | None = None) -> DataFrame:
    """The rows that ``gone`` does not name by ``key`` (and by the further condition ``same`` of a row and a row of gone).

    Rows that a bitmap of the keys clears stay where they are; only the others are moved to an exact
    anti-join, in the same way at any size. Rows with a null key are compared with null keys.
    """
    marked, named = _marked(rows, gone.select(key), key), gone.withColumnRenamed(key, "__key")
    maybe = marked.filter("__hit").drop("__hit")
    condition = maybe[key].eqNullSafe(named["__key"])
    left = maybe.join(named.hint("merge"), condition & same(maybe, named) if same else condition, "left_anti")
    return marked.filter("NOT __hit").drop("__hit").unionByName(left)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """About ``n`` rows (all of fewer), at most 2 n, by the hash of the whole row, so alike on any partitioning.

    Only the count is gathered; the share is a filter on the scan, not a sort.
    """
    total = df.count()
    if total <= n:
        return df
    share = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 31).cast("long")) / F.lit(float(1 << 31))
    return df.filter(share < n / total).limit(2 * n)


def batches(rows: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices Arrow batches so that ``column`` holds about ``max_bytes`` in each; a row is never cut."""
    for batch in rows:
        sizes = np.diff(np.asarray(_offsets(batch.column(batch.schema.get_field_index(column)))))
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _offsets(column: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], dtype=width) if column.buffers()[1] else np.zeros(1, width)
    return raw[column.offset : column.offset + len(column) + 1] if len(raw) > column.offset + len(column) else np.zeros(len(column) + 1, width)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser, so that hashes of equal words agree on all executors."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))
