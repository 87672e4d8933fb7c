"""Substring dedup with repeated-phrase automata.

Removes every word that lies in a window of words which also starts earlier in the
corpus. The corpus is packed into shards of a few megabytes, each one row of a
table. Recurring passages are confirmed in two steps that move hashes only, packed
by shard: the smallest phrase hash of each window (equal windows have equal ones)
tells which windows can recur in another shard, then those windows' hashes tell
which of them start earlier elsewhere. What comes back are passages, not places: a
shard compiles all phrases of its confirmed passages into an Aho-Corasick automaton over word numbers
and streams all its documents through it. The phrases that it finds in a window, one
after the other, are the window's identity: they tell which windows are occurrences of which passage
window, word by word and without hashes. So automata grow with a shard, not with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import batches, cut, mix64, ragged

SHARD_BYTES = 4 << 20
SHARDS_A_BUCKET = 4
PHRASES = 1 << 20
LAST = np.iinfo(np.int64).max
WINDOW_ROW = np.dtype([("hash", "<u8"), ("check", "<u4"), ("doc", "<i8")])
#: Bits of a letter in _letters, and a code point from which on there are no surrogates.
BASE_BITS, FIRST_LETTER = 6, 0x10000
LETTER_VALUES = np.random.default_rng(11).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
POWERS = np.cumprod(np.full(64, 0xD6E8FEB86659FD93, np.uint64))
STEP1, STEP2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Passage:
    """window: words of a passage that may not recur. phrase: words of the phrases by which windows are found; shorter than a window."""

    window: int = 20
    phrase: int = 6

    @property
    def part(self) -> int:
        """Words of the automaton's phrases: so few that they share most of their nodes."""
        return min(3, self.window)


def _parsed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row: the documents of a batch in the order of their ids, as word numbers and the words that these stand for."""
    batch = batch.take(pc.sort_indices(pa.table({"id": batch.column(0), "at": np.arange(batch.num_rows)}), [("id", "ascending"), ("at", "ascending")]))
    pieces = pc.ascii_split_whitespace(batch.column(1))  # at exactly SEPARATORS, with '' at the ends
    flat = pieces.flatten()
    real = pc.not_equal(flat, "")
    words = flat.filter(real).dictionary_encode()
    owner = np.asarray(pc.list_parent_indices(pieces))[np.asarray(real)]
    wide = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    columns = {
        "ids": wide(batch.column(0)),
        "sizes": wide(pa.array(np.bincount(owner, minlength=batch.num_rows).astype(np.int32))),
        "numbers": wide(words.indices),
        "words": wide(words.dictionary.cast(pa.binary())),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _hashes(words: pa.BinaryArray) -> np.ndarray:
    """A 64-bit hash of each word: of short ones a polynomial over a table of random numbers, as arrays; of the others xxHash."""
    found = np.zeros(len(words), np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    length = np.diff(ends)
    short = np.flatnonzero(length <= len(POWERS))
    if len(short):
        n = length[short]
        raw = np.frombuffer(words.buffers()[2], np.uint8)
        first = np.cumsum(n) - n
        value = LETTER_VALUES[raw[ragged(ends[:-1][short], n)]] * POWERS[ragged(np.zeros(len(n), np.int64), n)]
        found[short] = mix64(np.add.reduceat(value, first) + n.astype(np.uint64))
    for i in np.flatnonzero(length > len(POWERS)).tolist():
        found[i] = xxhash.xxh3_64_intdigest(words[i].as_py())
    return found


def shards(docs: DataFrame, id_col: str, text_col: str, rules: Passage) -> DataFrame:
    """shard, payload, anchors: documents parsed and packed as compressed Arrow streams of about SHARD_BYTES of text, written once."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found, "text", SHARD_BYTES):
            parsed = _parsed(batch)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parsed.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(parsed)
            own = np.unique(Shard(parsed, rules).anchors()[0])
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([own.tobytes()], pa.binary())], names=["payload", "anchors"])

    packed = rows.mapInArrow(run, "payload binary, anchors binary")
    return cut(packed.select(F.monotonically_increasing_id().alias("shard"), "payload", "anchors"), "passages-shards")


def _grams(word: np.ndarray, size: int, step: np.uint64) -> np.ndarray:
    """Hash of each ``size`` words in a row, from hashes of halves."""
    if size > len(word):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        whole, length, part, reach, power = None, 0, word, 1, step
        while True:
            if size & reach:
                n = len(word) - length - reach + 1
                whole = part if whole is None else whole[:n] * power + part[length : length + n]
                length += reach
            if length == size:
                return mix64(whole)
            part, reach, power = part[: len(part) - reach] * power + part[reach:], reach * 2, power * power


class Shard:
    """The documents of a shard in the order of their ids, with hashes of all windows."""

    def __init__(self, parsed: pa.RecordBatch, rules: Passage):
        self.rules = rules
        self.ids, sizes, numbers, self.words = (parsed.column(i).values for i in range(4))
        self.sizes = np.asarray(sizes).astype(np.int64)
        self.number = np.asarray(numbers)
        self.word = _hashes(self.words)[self.number] if len(self.number) else np.zeros(0, np.uint64)
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.end = np.cumsum(self.sizes)
        self.start = np.flatnonzero(np.arange(len(self.number)) + rules.window <= self.end[self.owner]) if len(self.number) else np.zeros(0, np.int64)
        self.hash = _grams(self.word, rules.window, STEP1)[self.start]

    @staticmethod
    def read(payload: pa.Buffer, rules: Passage) -> Shard:
        return Shard(next(iter(pa.ipc.open_stream(payload))), rules)

    def doc_keys(self, windows: np.ndarray) -> np.ndarray:
        ids = np.array([LAST if i is None else i for i in self.ids.to_pylist()], np.int64)
        return ids[self.owner[self.start[windows]]]

    def checks(self) -> np.ndarray:
        """A second hash of each window, independent of the first."""
        return (_grams(mix64(self.word + STEP2), self.rules.window, STEP2)[self.start] >> np.uint64(32)).astype(np.uint32)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The smallest phrase hash in each window, one for each stretch of windows that share it, and the stretches' lengths."""
        least = _grams(self.word, self.rules.phrase, STEP2)
        left, reach = self.rules.window - self.rules.phrase + 1, 1
        while reach < left:  # doubles the reach of the running minimum
            step = min(reach, left - reach)
            least = np.minimum(least[: len(least) - step], least[step:])
            reach += step
        least = least[self.start]
        at = np.flatnonzero(np.r_[True, least[1:] != least[:-1]]) if len(least) else np.zeros(0, np.int64)
        return least[at], np.diff(np.r_[at, len(least)])


def _by_bucket(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that groups values by bucket, the buckets met, and where each begins (and the last ends)."""
    bucket = (mix64(values) % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    used, begin = np.unique(bucket[order], return_index=True)
    return order, used, np.r_[begin, len(values)].astype(np.int64)


def _packed(shard: int, rows: np.ndarray, keys: np.ndarray, n: int) -> pa.RecordBatch:
    """A blob of rows for each bucket; with very many shards it holds one row, as in any other shuffle."""
    order, used, begin = _by_bucket(keys, n)
    blobs = [rows[order[a:b]].tobytes() for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([shard] * len(used), pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "shard", "blob"])


def _unpacked(marks: list[dict] | None, keys: np.ndarray, n: int) -> np.ndarray:
    """The marks that came back for the rows that _packed sent."""
    found = np.zeros(len(keys), bool)
    order, used, begin = _by_bucket(keys, n)
    for m in marks or []:
        k = int(np.searchsorted(used, m["bucket"]))
        at = order[begin[k] : begin[k + 1]]
        found[at] = np.unpackbits(np.frombuffer(m["marks"], np.uint8), count=len(at)).astype(bool)
    return found


def _answer(group: pd.DataFrame, marks: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
    ends = np.cumsum(sizes)
    blobs = [np.packbits(marks[e - s : e]).tobytes() for s, e in zip(sizes, ends, strict=True)]
    return pd.DataFrame({"shard": group["shard"], "bucket": group["bucket"], "marks": blobs})


def _recurring(group: pd.DataFrame) -> pd.DataFrame:
    """Marks anchors that more than one shard has. A shard sends each anchor once."""
    parts = [np.frombuffer(b, "<u8") for b in group["blob"]]
    _, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    return _answer(group, counts[inverse] > 1, np.array([len(p) for p in parts]))


def _not_first(group: pd.DataFrame) -> pd.DataFrame:
    """Marks windows that start earlier in another shard. A shard sends each window once, with its first document."""
    parts = [np.frombuffer(b, WINDOW_ROW) for b in group["blob"]]
    rows, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
    shard = np.repeat(group["shard"].to_numpy(), sizes)
    order = np.lexsort((shard, rows["doc"], rows["check"], rows["hash"]))
    h, c = rows["hash"][order], rows["check"][order]
    marks = np.zeros(len(rows), bool)
    marks[order[1:]] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
    return _answer(group, marks, sizes)


def _candidates(shard: Shard, marks: list[dict] | None, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (first in the shard) that recur in it or can elsewhere, how often they do in the shard, and whether another shard has their anchor."""
    anchors, lengths = shard.anchors()
    own, which = np.unique(anchors, return_inverse=True)
    elsewhere = np.repeat(_unpacked(marks, own, n)[which], lengths)
    some = np.flatnonzero(elsewhere | pd.Series(shard.hash).duplicated(keep=False).to_numpy())
    _, first, times = np.unique(shard.hash[some], return_index=True, return_counts=True)
    order = np.argsort(first)
    windows = some[first[order]]
    return windows, times[order], elsewhere[windows]


def _covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Marks the places, of n, in ``length`` places from each start on."""
    marks = np.zeros(n + length + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + length, -1)
    return np.cumsum(marks[:n]) > 0


def _letters(shard: Shard, passages: np.ndarray) -> tuple[str, int]:
    """The shard's words as a string, some letters a word, and how many.

    Words of the passages are numbered from 1, all others are 0. Letters are the digits of a
    number, from code points of their own at each place, so that matches begin and end at words.
    """
    known = np.zeros(len(shard.words) + 1, np.int64)
    known[shard.number[_covered(len(shard.number), passages, shard.rules.window)]] = 1
    number = np.where(known > 0, np.cumsum(known), 0)[shard.number]
    digits = max(1, -(-int(known.sum()).bit_length() // BASE_BITS))
    shift = np.arange(digits - 1, -1, -1) * BASE_BITS
    letters = (number[:, None] >> shift & ((1 << BASE_BITS) - 1)) + FIRST_LETTER + (np.arange(digits) << BASE_BITS)
    return letters.astype("<u4").tobytes().decode("utf-32-le"), digits


def compiled(shard: Shard, passages: np.ndarray, text: str, digits: int) -> Iterator[ahocorasick.Automaton]:
    """Automata of all phrases of passages, given as starts of their windows: some words from each word on.

    One automaton at a time, of up to PHRASES phrases, so that a very long document takes no more memory for them.
    """
    size = shard.rules.part
    places = np.flatnonzero(_covered(len(shard.number), passages, shard.rules.window - size + 1))
    for begin in range(0, len(places), PHRASES):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p in places[begin : begin + PHRASES].tolist():
            automaton.add_word(text[p * digits : (p + size) * digits], p)
        automaton.make_automaton()
        yield automaton


def locate(shard: Shard, automata: Iterable[ahocorasick.Automaton], text: str, digits: int) -> np.ndarray:
    """A number for each window, from streaming all documents through the automata; -1 where one of its phrases is none of theirs.

    An automaton tells which phrase each word begins; the first one that knows a phrase numbers it everywhere. Pairs of neighbouring phrases are
    numbered as phrases of up to twice the length, until a number stands for a whole window.
    So two windows have equal numbers where all of their words are equal, and only there.
    """
    size, width = shard.rules.part, shard.rules.window
    found = np.full(len(shard.number), -1, np.int64)
    for automaton in automata:
        if len(automaton):
            hits = np.fromiter((x for hit in automaton.iter(text) for x in hit), np.int64).reshape(-1, 2)
            at = (hits[:, 0] + 1) // digits - size
            new = found[at] < 0
            found[at[new]] = hits[new, 1]
    while size < width:
        step = min(size, width - size)
        both = (found[: max(0, len(found) - step)] >= 0) & (found[step:] >= 0)
        at = np.flatnonzero(both)
        pairs = found[at] * (found.max(initial=0) + 1) + found[at + step]
        found = np.full(len(both), -1, np.int64)
        found[at] = pd.factorize(pairs)[0]
        size += step
    return found[shard.start]


def removed_words(shard: Shard, windows: np.ndarray, times: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Marks words to remove. windows: first in the shard, with their number there and whether they start earlier in another one."""
    passage = (times > 1) | earlier
    windows, earlier = windows[passage], earlier[passage]
    text, digits = _letters(shard, shard.start[windows])
    names = locate(shard, compiled(shard, shard.start[windows], text, digits), text, digits)
    confirmed, elsewhere = (np.zeros(names.max(initial=-1) + 2, bool) for _ in range(2))  # the last one is of windows without a number
    confirmed[names[windows]], elsewhere[names[windows[earlier]]] = True, True
    confirmed[-1] = False
    at = np.flatnonzero(confirmed[names])
    first = np.zeros(len(confirmed), np.int64)
    first[names[at[::-1]]] = at[::-1]
    again = at[elsewhere[names[at]] | (at != first[names[at]])]
    return _covered(len(shard.number), shard.start[again], shard.rules.window)


def _results(shard: Shard, gone: np.ndarray, names: list[str]) -> pa.RecordBatch:
    docs = len(shard.sizes)
    count = lambda owners: np.bincount(owners, minlength=docs).astype(np.int64)
    offsets = lambda sizes: pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    n_removed = count(shard.owner[gone])
    words = pa.ListArray.from_arrays(offsets(shard.sizes - n_removed), shard.words.take(pa.array(shard.number[~gone])))
    begin = shard.end - shard.sizes
    first, last = np.zeros(len(gone), bool), np.zeros(len(gone), bool)
    first[begin[shard.sizes > 0]] = last[shard.end[shard.sizes > 0] - 1] = True
    starts = np.flatnonzero(gone & (first | ~np.r_[False, gone[:-1]])) if len(gone) else np.zeros(0, np.int64)
    ends = np.flatnonzero(gone & (last | ~np.r_[gone[1:], False])) if len(gone) else np.zeros(0, np.int64)
    shift = begin[shard.owner[starts]]
    spans = pa.StructArray.from_arrays([pa.array(starts - shift), pa.array(ends - shift + 1)], names=["start", "end"])
    spans = pa.ListArray.from_arrays(offsets(count(shard.owner[starts])), spans)
    return pa.RecordBatch.from_arrays([shard.ids.cast(pa.int64()), pa.array(shard.sizes), pa.array(n_removed), pc.binary_join(words, b" ").cast(pa.string()), spans], names=names)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Passage = Passage()) -> DataFrame:
    """One row per row of ``docs``: id_col (long), n_words, n_removed, kept_text, removed.

    kept_text: the words that stay, joined by one space. removed: spans (start, end) of
    removed words, end exclusive. Earlier means a smaller id, or the same document and an
    earlier start; null ids come last; rows that repeat an id are ordered by where they
    are stored. Ids are whole numbers, another type is an error. Null and empty texts have no words; an
    empty table gives an empty result. Each action on the result runs the automata again.
    """
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{id_col} has to be a whole number")
    packed = shards(docs, id_col, text_col, rules)
    n = max(1, packed.count() // SHARDS_A_BUCKET)

    def anchors(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for number, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(own, np.uint64)
                yield _packed(number, own, own, n)

    answer = "shard long, bucket int, marks binary"
    marks = packed.select("shard", "anchors").mapInArrow(anchors, "bucket int, shard long, blob binary").groupBy("bucket").applyInPandas(_recurring, answer)
    gathered = lambda name: F.collect_list(F.struct("bucket", "marks")).alias(name)
    marks = cut(marks.groupBy("shard").agg(gathered("anchor_marks")), "passages-anchors")
    known = packed.select("shard", "payload").join(marks, "shard", "left")

    def windows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for number, payload, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                shard = Shard.read(payload.as_buffer(), rules)
                use, _, elsewhere = _candidates(shard, own, n)
                use = use[elsewhere]
                sent = np.zeros(len(use), WINDOW_ROW)
                sent["hash"], sent["check"], sent["doc"] = shard.hash[use], shard.checks()[use], shard.doc_keys(use)
                yield _packed(number, sent, sent["hash"].copy(), n)

    earlier = known.mapInArrow(windows, "bucket int, shard long, blob binary").groupBy("bucket").applyInPandas(_not_first, answer)
    earlier = earlier.groupBy("shard").agg(gathered("window_marks")).join(marks, "shard", "full")  # not cut, so that both joins of payloads read one exchange

    def remove(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for payload, later, own in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                shard = Shard.read(payload.as_buffer(), rules)
                use, times, elsewhere = _candidates(shard, own, n)
                before = np.zeros(len(use), bool)
                before[elsewhere] = _unpacked(later, shard.hash[use[elsewhere]], n)
                yield _results(shard, removed_words(shard, use, times, before), [id_col, "n_words", "n_removed", "kept_text", "removed"])

    joined = packed.select("shard", "payload").join(earlier, "shard", "left").select("payload", "window_marks", "anchor_marks")
    return joined.mapInArrow(remove, f"`{id_col}` long, n_words long, n_removed long, kept_text string, removed array<struct<start: long, end: long>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: what stays of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
