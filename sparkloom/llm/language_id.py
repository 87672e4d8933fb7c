"""Language identification by a byte convolutional network in numpy.

A text is cut into windows of fixed length. Filters of several widths run over the
bytes of a window, each filter keeps its largest response, and a softmax layer turns
these into languages; a text's scores are the mean over all its windows. The first
layer acts on one-hot bytes, so a filter of width w is w tables of 256 weights; for
prediction neighbouring tables are summed into tables of byte pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from sparkloom.llm.common import batches

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Settings:
    """window: bytes; widths, filters: of the first layer, filters for each width. About
    sample_docs labelled documents (at most twice as many), of each at most sample_windows windows, are learnt from."""

    window: int = 128
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    sample_docs: int = 4000
    sample_windows: int = 6
    epochs: int = 6
    batch: int = 128
    rate: float = 0.05
    seed: int = 7


def windows_of(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts as rows of bytes, the last of a text filled with zeros, and the text of each."""
    lengths = np.array([len(t) for t in texts], np.int64)
    counts = -(-lengths // size)
    rows = np.zeros((int(counts.sum()), size), np.uint8)
    flat = rows.reshape(-1)
    start = (np.cumsum(counts) - counts) * size
    for text, at in zip(texts, start.tolist(), strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
    return rows, np.repeat(np.arange(len(texts)), counts)


class ByteNet:
    def __init__(self, labels: list[str], settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.labels, self.settings = labels, settings
        self.tables = [rng.normal(0, 0.3, (w, 256, settings.filters)).astype(np.float32) for w in settings.widths]
        for t in self.tables:
            t[:, 0] = 0
        n = settings.filters * len(settings.widths)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)
        self.pairs: list[list[np.ndarray]] | None = None

    def _peaks(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of each filter in each window, and where it is."""
        best, where = [], []
        for t in self.tables:
            w = len(t)
            r = sum(t[o][rows[:, o : rows.shape[1] - w + 1 + o]] for o in range(w))
            where.append(r.argmax(1))
            best.append(np.take_along_axis(r, where[-1][:, None], 1)[:, 0])
        return np.concatenate(best, 1), where

    def train(self, rows: np.ndarray, labels: np.ndarray) -> None:
        """Adagrad on the cross entropy, languages weighted alike."""
        s, rng = self.settings, np.random.default_rng(self.settings.seed)
        weight = (len(labels) / (len(self.labels) * np.maximum(1, np.bincount(labels, minlength=len(self.labels))))).astype(np.float32)
        seen = [np.full_like(x, 1e-2) for x in (*self.tables, self.bias, self.out, self.out_bias)]

        def step(x: np.ndarray, g: np.ndarray, past: np.ndarray) -> None:
            past += g * g
            x -= s.rate * g / np.sqrt(past)

        for _ in range(s.epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), s.batch):
                use = order[at : at + s.batch]
                x, y = rows[use], labels[use]
                peak, where = self._peaks(x)
                hidden = np.maximum(peak + self.bias, 0)
                p = _softmax(hidden @ self.out + self.out_bias)
                p[np.arange(len(y)), y] -= 1
                p *= (weight[y] / len(y))[:, None]
                back = (p @ self.out.T) * (hidden > 0)
                for k, t in enumerate(self.tables):
                    g, part = np.zeros_like(t), back[:, k * s.filters : (k + 1) * s.filters]
                    for o in range(len(t)):
                        np.add.at(g[o], (x[np.arange(len(y))[:, None], where[k] + o], np.arange(s.filters)[None]), part)
                    g[:, 0] = 0
                    step(t, g, seen[k])
                n = len(self.tables)
                step(self.bias, back.sum(0), seen[n])
                step(self.out, hidden.T @ p, seen[n + 1])
                step(self.out_bias, p.sum(0), seen[n + 2])

    def _summed(self) -> list[list[np.ndarray]]:
        """Tables of byte pairs of each width, and the last table of an odd one."""
        if self.pairs is None:
            self.pairs = [[(t[o][:, None] + t[o + 1][None]).reshape(65536, -1) for o in range(0, len(t) - 1, 2)] + [t[-1]] * (len(t) % 2) for t in self.tables]
        return self.pairs

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        found = []
        for at in range(0, len(rows), 256):
            x = rows[at : at + 256].T  # position first, so that the maximum runs over whole rows
            pair = x[:-1].astype(np.int32) * 256 + x[1:]
            best = []
            for tables in self._summed():
                w = 2 * (len(tables) - (len(tables[-1]) == 256)) + (len(tables[-1]) == 256)
                n = len(x) - w + 1
                r = None
                for i, t in enumerate(tables):
                    part = t[(pair if len(t) == 65536 else x)[2 * i : 2 * i + n]]
                    r = part if r is None else np.add(r, part, out=r)
                best.append(r.max(0))
            hidden = np.maximum(np.concatenate(best, 1) + self.bias, 0)
            found.append(_softmax(hidden @ self.out + self.out_bias))
        return np.concatenate(found) if found else np.zeros((0, len(self.labels)), np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of whole texts; UNKNOWN and 0 for null and for texts without letters."""
        known = [bool(t) and LETTER.search(t) is not None for t in texts]
        raw = [t.encode("utf-8", "surrogatepass") if k else b"" for t, k in zip(texts, known, strict=True)]
        label, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.labels or not any(known):
            return label, score
        rows, owner = windows_of(raw, self.settings.window)
        p = self.probabilities(rows).astype(np.float64)
        share = (rows != 0).sum(1) + 1e-9
        total = np.stack([np.bincount(owner, p[:, k] * share, len(texts)) for k in range(p.shape[1])], 1)
        total /= np.maximum(np.bincount(owner, share, len(texts)), 1e-9)[:, None]
        best = total.argmax(1)
        for i, k in enumerate(known):
            if k:
                label[i], score[i] = self.labels[best[i]], float(min(1.0, total[i, best[i]]))
        return label, score


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _sample(labelled: DataFrame, lang_col: str, n: int) -> DataFrame:
    """About ``n`` rows, at most 2 n: of each language n divided by the number of languages, or all of fewer."""
    counts = labelled.groupBy(F.col(lang_col).alias("__lang")).agg(F.count("*").alias("__n"))
    total = counts.count()
    if not total:
        return labelled.limit(0)
    shares = counts.withColumn("__share", F.lit(n / total) / F.col("__n"))
    draw = F.pmod(F.xxhash64(*labelled.columns), F.lit(1 << 31).cast("long")) / F.lit(float(1 << 31))
    return labelled.join(shares, F.col(lang_col) == F.col("__lang")).filter(draw < F.col("__share")).select(*labelled.columns).limit(2 * n)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> ByteNet:
    """A network trained on a bounded sample of rows with text and language.

    The sample is about sample_docs rows, an equal number of each language or all of a rare one, by the hash of the
    row; of each, evenly spaced windows go to the driver, so at most 2 * sample_docs * sample_windows * window bytes.
    Without labelled rows every prediction is UNKNOWN.
    """
    few = labelled.filter(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    few = _sample(few, lang_col, settings.sample_docs).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    size, most = settings.window, settings.sample_windows

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            langs, found = [], []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if LETTER.search(text):
                    own, _ = windows_of([text.encode("utf-8", "surrogatepass")], size)
                    use = np.unique(np.linspace(0, len(own) - 1, most).astype(int))
                    found += [own[i].tobytes() for i in use]
                    langs += [lang] * len(use)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], names=["lang", "bytes"])

    sample = few.mapInArrow(run, "lang string, bytes binary").toArrow().sort_by([("lang", "ascending"), ("bytes", "ascending")])
    langs = sample.column("lang").to_pylist()
    net = ByteNet(sorted(set(langs)), settings)
    if langs:
        rows = np.frombuffer(b"".join(sample.column("bytes").to_pylist()), np.uint8).reshape(-1, size)
        net.train(rows, np.array([net.labels.index(x) for x in langs]))
    return net


def identify(docs: DataFrame, net: ByteNet, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language of each whole text and its score from 0 to 1.

    Null texts and texts without letters get UNKNOWN and 0. Rows are treated one by
    one; an empty table gives an empty result; columns with the added names are replaced.
    """
    kept = docs.drop(lang_col, score_col)
    at, names = kept.columns.index(text_col), [*kept.columns, lang_col, score_col]
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text_col, 1 << 20):
            label, score = sent.value.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(label, pa.string()), pa.array(score, pa.float64())], names=names)

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(lang_col, StringType()), StructField(score_col, DoubleType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: language of every document, learnt from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    net = learn(docs.select("doc_id", "text", "lang").filter(~held_out))
    return identify(docs.select("doc_id", "text"), net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
