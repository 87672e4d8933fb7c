"""Quality rules from suffix-array repetition.

Each document's words get a suffix array with longest common prefixes of
neighbours. A suffix whose larger neighbour prefix is m words long starts a
repeated substring of m words; the union of those spans is the union of the
spans of all maximal repeats. The rules limit the covered fraction and the
longest repeat.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sparkloom.llm.common import batches, words_of

COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long"
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Limits:
    """A document is rejected beyond any of these.

    min_words and max_window_percent are the base rules (too few words; words in
    repeated windows). The repeat limits are the method's own verdict: the
    percentage of words covered by maximal repeats of ``min_repeat`` words or
    more, and the longest repeat as a percentage of the document.
    """

    min_words: int = 20
    window: int = 8
    max_window_percent: int = 30
    min_repeat: int = 4
    max_covered_percent: int = 50
    max_longest_percent: int = 40


def repeats(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each position the length of the longest substring from there that its document repeats.

    ids: word numbers; doc: non-decreasing document numbers. Prefix doubling over
    all documents at once: at level j equal ranks mean equal substrings of 2**j
    words. Positions whose rank is unique leave. The last ranks give the suffix
    array, the levels the longest common prefixes with both neighbours.
    """
    n = len(ids)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    ends = np.searchsorted(doc, doc, side="right")
    alive = np.arange(n)
    rank, tied = _refine(np.zeros(n, np.int64), alive, doc * (int(ids.max()) + 1) + ids)
    levels, h = [], 1
    while len(alive := alive[tied]):
        levels.append(rank.astype(np.int32))
        ahead = alive + h
        second = np.where(ahead < ends[alive], rank[np.minimum(ahead, n - 1)] + 1, 0)
        old, rank = rank, rank.copy()
        rank[alive], tied = _refine(old[alive], alive, second)
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    a, b = suffixes[:-1], suffixes[1:]
    same = doc[a] == doc[b]
    a, b = a[same], b[same]
    lcp = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = np.maximum(x, y) + (1 << level) <= ends[a]
        x, y = np.minimum(x, n - 1), np.minimum(y, n - 1)
        lcp += (inside & (levels[level][x] == levels[level][y])).astype(np.int64) << level
    np.maximum.at(best, a, lcp)
    np.maximum.at(best, b, lcp)
    return best


def _refine(group: np.ndarray, at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Splits each group of equal ranks by key: new ranks of ``at``, and which are still tied."""
    by = np.lexsort((key, group))
    g, k = group[by], key[by]
    index = np.arange(len(by))
    new_group = np.r_[True, g[1:] != g[:-1]]
    new = new_group | np.r_[True, k[1:] != k[:-1]]
    offset = np.maximum.accumulate(np.where(new, index, 0)) - np.maximum.accumulate(np.where(new_group, index, 0))
    rank, tied = np.empty_like(group), np.empty(len(by), bool)
    rank[by] = g + offset
    tied[by] = ~(new & np.r_[new[1:], True])
    return rank, tied


def covered(spans: np.ndarray, least: int) -> np.ndarray:
    """Marks positions inside [i, i + spans[i]) for some i with spans[i] >= least."""
    index = np.arange(len(spans))
    reach = np.maximum.accumulate(np.where(spans >= least, index + spans, 0))
    return reach > index


def _measure(batch: pa.RecordBatch, column: int, limits: Limits) -> list[np.ndarray]:
    number: dict[bytes, int] = defaultdict(count().__next__)
    texts = batch.column(column).to_pylist()
    words = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ids = np.concatenate([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words] or [np.zeros(0, np.int64)])
    doc = np.repeat(np.arange(len(words)), sizes)
    spans = repeats(ids, doc)
    long = np.minimum(spans, limits.window) * (spans >= limits.window)

    def each(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=len(words)).astype(np.int64)

    longest = np.zeros(len(words), np.int64)
    np.maximum.at(longest, doc, spans)
    return [each(covered(long, limits.window)), each(covered(spans, limits.min_repeat)), longest]


def measure(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Adds the columns of COLUMNS to ``docs``, for whole texts.

    Null and empty texts have no words and all counts 0. Repeated rows are
    measured alike; an empty table gives an empty result. A column of ``docs``
    that has the name of an added one is replaced. Memory: about 1 MB of text at
    a time, or one text that is longer.
    """
    added = [c.split()[0] for c in COLUMNS.split(", ")]
    kept = docs.drop(*added)
    column = kept.columns.index(text_col)
    measured = ("n_repeat_words", "covered_words", "longest_repeat")
    names = [*kept.columns, *measured]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text_col, 1 << 20):
            found = _measure(batch, column, limits)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], names=names)

    schema = StructType([*kept.schema.fields, *(StructField(name, LongType()) for name in measured)])
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (
        kept.mapInArrow(run, schema)
        .withColumn("n_words", F.size(words).cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
    )


def verdicts(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Adds base_failed and kept; a document without words fails as too short."""
    n = F.col("n_words")
    failed = (n < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_window_percent * n)
    repetitive = (100 * F.col("covered_words") > limits.max_covered_percent * n) | (100 * F.col("longest_repeat") > limits.max_longest_percent * n)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~repetitive)


def quality_filter(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    return verdicts(measure(docs, text_col, limits), limits).filter("kept").select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: measures and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = verdicts(measure(docs))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words", "longest_repeat")
