"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The symbols of many distinct pre-tokens lie in one flat array. In each round the
adjacent pairs of all of them are looked up by binary search over the sorted keys
of mergeable pairs, each pre-token merges its lowest-ranked pair everywhere, and
the array is compacted. A very long pre-token merges the lowest-ranked pair of every
neighbourhood instead. Pre-tokens met before keep their ids in a cache of
bounded size.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from sparkloom.llm.common import batches, ragged

#: Fixed values of byte-level tokenizers: the pre-token pattern, and the bytes that stand for themselves in vocabulary files.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

NONE = np.int64(1) << 40
NO_IDS = np.zeros(0, np.int64)
#: Bytes from which on a pre-token is merged by neighbourhoods.
LONG_WORD = 512
CHUNK_BYTES = 1 << 20
CACHE_SYMBOLS = 1 << 22


class Vocabulary:
    """Ids, merges and special tokens of a tokenizer file, as arrays."""

    def __init__(self, text: str):
        spec = json.loads(text)
        hidden = iter(range(256, 512))
        letters = {b: chr(b) if b in PRINTABLE else None for b in range(256)}
        letters = {b: c or chr(next(hidden)) for b, c in letters.items()}
        byte_of = {c: b for b, c in letters.items()}
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        pieces: list[bytes] = [b""] * self.size
        for token, at in vocab.items():
            pieces[at] = bytes(byte_of[c] for c in token)
        for token, at in self.special.items():
            pieces[at] = token.encode()
        self.of_byte = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_length = np.array([len(p) for p in pieces], np.int64)
        self.piece_start = np.cumsum(self.piece_length) - self.piece_length
        self.reach = max((len(pieces[i]) for i in self.merged.tolist()), default=1)
        self.pre_token = regex.compile(PRE_TOKENS)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        long = [i for i, w in enumerate(raw) if len(w) > LONG_WORD]
        if not long:
            return self._merge(raw)
        short = sorted(set(range(len(raw))).difference(long))
        parts: list[np.ndarray] = [NO_IDS] * len(raw)
        if short:
            ids, length = self._merge([raw[i] for i in short])
            for i, part in zip(short, np.split(ids, np.cumsum(length)[:-1]), strict=True):
                parts[i] = part
        for i in long:
            parts[i] = self._merge_long(raw[i])
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word.

        A merge can change a pair's fate only inside one token, of at most ``reach`` symbols. So each round
        merges all pairs with the lowest rank within that distance at once, not just those of the lowest rank of all.
        """
        symbols = self.of_byte[np.frombuffer(word, np.uint8)]
        while len(symbols) > 1:
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.ranks[at], NONE)
            if rank.min() == NONE:
                break
            pad = np.full(self.reach, NONE)
            least, left, reach = np.r_[pad, rank, pad], 2 * self.reach + 1, 1
            while reach < left:  # doubles the reach of the running minimum
                step = min(reach, left - reach)
                least = np.minimum(least[: len(least) - step], least[step:])
                reach += step
            chosen = (rank == least) & (rank < NONE)
            # a run of overlapping pairs merges from its left end on, so as far as nothing before can change that end
            index, waits = np.arange(len(rank)), np.cumsum(~chosen)
            run = np.maximum.accumulate(np.where(np.r_[True, rank[1:] != rank[:-1]], index, 0))
            where = np.flatnonzero(chosen & (waits == waits[run]) & chosen[run] & ((index - run) % 2 == 0))
            symbols = symbols.copy()
            symbols[where] = self.merged[at[where]]
            symbols = np.delete(symbols, where + 1)
        return symbols

    def _merge(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        symbols = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(raw)), np.fromiter(map(len, raw), np.int64, len(raw)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols) > 1:
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.r_[np.where(hit, self.ranks[at], NONE), NONE]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            lengths = np.diff(np.r_[first, len(symbols)])
            ready = np.repeat(lowest == NONE, lengths)
            if ready.any():
                done.append((word[ready], symbols[ready]))
            chosen = (rank == np.repeat(lowest, lengths)) & ~ready
            # of a run of overlapping pairs every second one merges, from the left
            index = np.arange(len(chosen))
            run = np.maximum.accumulate(np.where(chosen & ~np.r_[False, chosen[:-1]], index, 0))
            chosen &= (index - run) % 2 == 0
            where = np.flatnonzero(chosen)
            symbols = symbols.copy()
            symbols[where] = self.merged[at[where]]
            keep = ~ready
            keep[where + 1] = False
            symbols, word = symbols[keep], word[keep]
        done.append((word, symbols))
        words_done = np.concatenate([w for w, _ in done])
        ids = np.concatenate([s for _, s in done])
        order = np.argsort(words_done, kind="stable")
        return ids[order], np.bincount(words_done, minlength=len(raw))

    def parts(self, text: str, specials: bool) -> list[str]:
        """Pre-tokens of a text; a special token is a part of its own."""
        if not specials or self.split_special is None or not any(s in text for s in self.special):
            return self.pre_token.findall(text)
        found: list[str] = []
        for piece in self.split_special.split(text):
            if piece in self.special:
                found.append("\0" + piece)
            elif piece:
                found.extend(self.pre_token.findall(piece))
        return found


class Encoder:
    """Encodes batches of texts; remembers pre-tokens until they hold CACHE_SYMBOLS ids."""

    def __init__(self, vocabulary: Vocabulary, specials: bool = True):
        self.vocabulary, self.specials = vocabulary, specials
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.start, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, words: list[str]) -> None:
        v = self.vocabulary
        special = {w: v.special[w[1:]] for w in words if w[0] == "\0" and w[1:] in v.special} if self.specials else {}
        plain = [w for w in words if w not in special]
        ids, length = v.merge(plain) if plain else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        ids, length = np.r_[ids, np.array(list(special.values()), np.int64)], np.r_[length, np.ones(len(special), np.int64)]
        for w in [*plain, *special]:
            self.known[w] = len(self.known)
        self.start = np.r_[self.start, len(self.ids) + np.cumsum(length) - length].astype(np.int64)
        self.length = np.r_[self.length, length].astype(np.int64)
        self.ids = np.r_[self.ids, ids].astype(np.int32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has; a null text has none."""
        if len(self.ids) > CACHE_SYMBOLS:
            self.forget()
        parts = [self.vocabulary.parts(t, self.specials) if t else [] for t in texts]
        new = {w for p in parts for w in p}.difference(self.known)
        if new:
            self.learn(sorted(new))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        which = np.fromiter((self.known[w] for p in parts for w in p), np.int64, int(sizes.sum()))
        length = self.length[which]
        counts = np.bincount(np.repeat(np.arange(len(parts)), sizes), weights=length, minlength=len(parts)).astype(np.int64)
        return self.ids[ragged(self.start[which], length)], counts


def decode(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of the ids; bytes that are no UTF-8 become U+FFFD."""
    length = vocabulary.piece_length[ids]
    raw = vocabulary.piece_bytes[ragged(vocabulary.piece_start[ids], length)].tobytes()
    ends = np.r_[0, np.cumsum(length)][np.r_[0, np.cumsum(counts)]]
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _vocabulary(spark: SparkSession, path: str):
    """The tokenizer file, read once on the driver and sent to each executor: its size is the vocabulary's."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _with(df: DataFrame, drop: list[str], *fields: StructField) -> tuple[DataFrame, StructType, list[str]]:
    kept = df.drop(*drop)
    schema = StructType([*kept.schema.fields, *fields])
    return kept, schema, schema.names


def encode_decode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = "decoded", specials: bool = True) -> DataFrame:
    """Adds the token ids of each whole text and, unless None, the text that they decode to.

    path: a byte-level tokenizer file. specials: strings of special tokens in a text
    become those tokens. Null and empty texts get an empty list and ''. Rows are
    treated one by one, so repeated rows get equal results and an empty table an
    empty one; columns of ``docs`` with the added names are replaced.
    """
    fields = [StructField(ids_col, ArrayType(IntegerType())), *([StructField(decoded_col, StringType())] if decoded_col else [])]
    kept, schema, names = _with(docs, [ids_col, decoded_col or ids_col], *fields)
    at, source = kept.columns.index(text_col), _vocabulary(docs.sparkSession, path)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(source.value), specials)
        for batch in batches(rows, text_col, CHUNK_BYTES):
            ids, counts = encoder.encode(batch.column(at).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(ids))
            texts = [pa.array(decode(encoder.vocabulary, ids, counts), pa.string())] if decoded_col else []
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, *texts], names=names)

    return kept.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text of a column of token ids; a null list gives ''. Ids outside the vocabulary raise an error."""
    kept, schema, names = _with(df, [text_col], StructField(text_col, StringType()))
    at, source = kept.columns.index(ids_col), _vocabulary(df.sparkSession, path)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(source.value)
        for batch in rows:
            lists = [x or [] for x in batch.column(at).to_pylist()]
            ids = np.array([i for x in lists for i in x], np.int64)
            texts = decode(vocabulary, ids, np.array([len(x) for x in lists], np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return kept.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: token counts and digests of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(encode_decode(docs, tokenizer_path()))
