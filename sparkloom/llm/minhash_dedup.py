"""Near-duplicate detection with bottom-k sketches from one hash function.

A document's shingles are hashed once and the k smallest hashes are kept, in order.
Inverted lists run over short runs of consecutive retained values: documents that
share most shingles share such runs, documents that share one passage hardly do. A
document is compared with the centre of each of its lists, the document that shares
most runs, then with documents of other components that share a centre and may still
be similar enough; so copies by the thousand cost a comparison each and not one with
each other. The union of two sketches estimates
the similarity and drops unlikely pairs; full shingle sets confirm the rest.

What can be missed: with all shingles retained (k or fewer) two documents linked at
80 % or more always share a run, by the pigeonhole principle. Beyond that a pair
exactly at 85 % shares none of its runs of 4 at k = 64 with a probability of about
1e-8 (at 80 %: 1e-6), and the estimate drops it with one of about 1e-8. exact() gives
rules that miss nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sparkloom.llm.common import batches, bits_filter, cut, discard, mix64, scratch, without, words_of


@dataclass(frozen=True)
class Rules:
    """shingle: words in a shingle. percent: least similarity of linked documents, of their shingle sets.

    k: retained values. Documents of up to ``small`` shingles use runs of small_run
    retained values, those of more than small_from runs of ``run``; the overlap of the two
    covers pairs on either side. least_estimate: pairs whose union sketch is below
    are dropped, but for those with a centre, which all full sets are compared with.
    """

    shingle: int = 5
    percent: int = 80
    k: int = 64
    run: int = 4
    small_run: int = 2
    small: int = 24
    small_from: int = 16
    least_estimate: float = 0.55


def exact(rules: Rules) -> Rules:
    """The same rules with every shingle retained: no pair is missed or estimated away, at the cost of lists over whole sets.

    Of u shingles in the union at most a fifth differs; were all runs of common neighbours shorter than 4, there would be
    fewer than 0.6 u + 3 of them, so above 15 a run of 4 is shared, and in small documents a run of 2.
    """
    return replace(rules, k=2**31 - 1)


#: Words whose hashes a worker keeps, about 15 MB.
KNOWN_WORDS = 60_000


#: Pairs of one document that are compared in one place.
PAIRS_A_PART = 4096


class Shingler:
    """Distinct shingle hashes of a text. Words keep their hashes until many are known."""

    def __init__(self, size: int):
        self.size, self.known = size, {}

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; bytes.lower() lowers A-Z only. Fewer words than a shingle count as one."""
        words = words_of(text)
        if not words:
            return np.zeros(0, np.uint64)
        h = self.word_hashes([w.lower() for w in words])
        size = min(self.size, len(h))
        n = len(h) - size + 1
        x = np.full(n, size, np.uint64)
        for o in range(size):
            x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + h[o : o + n])
        return np.unique(x)


def _signed(x: np.ndarray) -> np.ndarray:
    """Order-preserving int64 form of uint64 hashes, as Spark has no unsigned type."""
    return (x ^ np.uint64(1 << 63)).view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, rules: Rules) -> DataFrame:
    """id, n (set size), whole (digest of the set), sketch (k smallest hashes in order, as array<long>)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["id", "n", "whole", "sketch"]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rules.shingle)
        for batch in batches(found, "text", 1 << 20):
            sets = [shingler.shingles(t) for t in batch.column(1).to_pylist()]
            kept = [_signed(s[: rules.k]) for s in sets]
            ends = np.r_[0, np.cumsum([len(s) for s in kept])].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *kept])))
            whole = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(whole, pa.binary()), lists], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n long, whole binary, sketch array<long>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, rules: Rules) -> DataFrame:
    """id, hashes: the whole shingle set of each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rules.shingle)
        for batch in batches(found, "text", 1 << 20):
            sets = [_signed(shingler.shingles(t)) for t in batch.column(1).to_pylist()]
            ends = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *sets])))], names=["id", "hashes"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, hashes array<long>")


def _of_ids(docs: DataFrame, id_col: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``wanted``, with few of the others moved."""
    return bits_filter(docs, wanted, id_col).join(wanted, id_col, "left_semi")


def _runs(sketch: Column, length: int) -> Column:
    """Digests of all runs of ``length`` consecutive retained values; the length is part of the digest."""
    starts = F.sequence(F.lit(1), F.size(sketch) - (length - 1))
    return F.when(
        F.size(sketch) >= length,
        F.transform(starts, lambda i: F.xxhash64(F.lit(length), *(F.get(sketch, i - 1 + o) for o in range(length)))),
    ).otherwise(F.array().cast("array<bigint>"))


def _possible(n: str, m: str, rules: Rules) -> Column:
    """Set sizes that allow the similarity."""
    return 100 * F.least(n, m) >= rules.percent * F.greatest(n, m)


def _likely(a: str, b: str, rules: Rules) -> Column:
    """The estimate from the union's k smallest values reaches least_estimate."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, rules.k)
    both = F.size(F.array_intersect(F.array_intersect(F.col(a), F.col(b)), union))
    return both >= rules.least_estimate * F.size(union)


def _likely_pairs(pairs: DataFrame, sketch: DataFrame, rules: Rules) -> DataFrame:
    """Pairs (a, b) with their set sizes that sizes and sketches allow."""
    small = sketch.select("id", "n", "sketch")
    left = small.withColumnsRenamed({"id": "a", "n": "n_a", "sketch": "s_a"})
    right = small.withColumnsRenamed({"id": "b", "n": "n_b", "sketch": "s_b"})
    return cut(pairs.join(left, "a").join(right, "b").filter(_possible("n_a", "n_b", rules) & _likely("s_a", "s_b", rules)).select("a", "b", "n_a", "n_b"), "near-likely")


def _compared(likely: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds the exact number of common shingles. A hot document's pairs are dealt out in parts of about PAIRS_A_PART, each with a copy of its set."""
    parts = cut(likely.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_A_PART).alias("parts")), "near-parts")
    own = sets.withColumnsRenamed({"id": "a", "hashes": "h_a"}).join(parts, "a").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    dealt = likely.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts"))).drop("parts")
    both = dealt.join(sets.withColumnsRenamed({"id": "b", "hashes": "h_b"}), "b").join(own, ["a", "part"])
    return cut(both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("h_a", "h_b")).alias("common")), "near-compared")


def _links(compared: DataFrame, rules: Rules) -> DataFrame:
    return compared.filter(100 * F.col("common") >= rules.percent * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest reachable id) of all ids in ``links`` (a, b).

    Each round takes the smallest label among neighbours and then the label of that
    label; labels are pre-aggregated, so hubs are one row a task.
    """
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-edges")
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), "cc-labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        least = labels.join(near, "id").select("id", "component", F.least("component", "near").alias("least"))
        jump = labels.select(F.col("id").alias("least"), F.col("component").alias("further"))
        moved = cut(least.join(jump, "least", "left").select("id", F.least("least", F.coalesce("further", "least")).alias("component"), F.col("component").alias("before")), "cc-labels")
        discard(labels)
        labels = moved.select("id", "component")
        if moved.filter("component <> before").isEmpty():
            discard(both)
            return labels


def _across(stars: DataFrame, labels: DataFrame, sets: DataFrame, rules: Rules) -> DataFrame:
    """Pairs (a, b) of documents that share a star's centre, lie in different components and may be linked.

    Two documents share at most the smaller of their overlaps with the centre and what they
    have in common outside it. If they share nothing outside, a stray with overlap i and size
    n links with sizes up to i / f - n only, f = percent / (100 + percent), which for most
    strays leaves none. A document that must share t shingles outside to reach the threshold has
    one of them among all but its t - 1 most common ones of those that documents of another component
    in the star have too (prefix filter); so every pair that may link meets, and no share is estimated.
    """
    f, least, step = rules.percent / (100 + rules.percent), rules.percent / 100, float(np.log(1.02))
    centre = stars.select(F.col("a").alias("c"), F.col("a").alias("id"), F.col("n_a").alias("n"), F.col("n_a").alias("i")).distinct()
    group = centre.unionByName(stars.select(F.col("a").alias("c"), F.col("b").alias("id"), F.col("n_b").alias("n"), F.col("common").cast("long").alias("i")))
    group = group.join(labels.withColumnRenamed("component", "own"), "id", "left").withColumn("own", F.coalesce("own", "id"))
    of_centre = labels.select(F.col("id").alias("c"), F.col("component").alias("main"))
    group = cut(group.join(of_centre, "c", "left").withColumn("main", F.coalesce("main", "c")), "near-groups")
    band = lambda x: F.floor(F.log(x) / step).cast("int")
    names = {"id": "x", "n": "n_x", "i": "i_x", "own": "own_x", "q": "q_x"}
    other = lambda df: df.select("c", *(F.col(k).alias(v) for k, v in names.items() if k in df.columns), *(k for k in ("band", "r") if k in df.columns))
    apart = (F.col("own") != F.col("own_x")) & _possible("n", "n_x", rules)
    enough = lambda common: (100 + rules.percent) * common >= rules.percent * (F.col("n") + F.col("n_x"))
    n, i = F.col("n").cast("double"), F.col("i").cast("double")

    top = F.least(n / least, i / f - n)
    strays = group.filter("own <> main").withColumn("top", top).filter(F.col("top") >= n * least)
    strays = strays.withColumn("band", F.explode(F.sequence(band(n * least), band(F.col("top")))))
    inside = group.withColumn("band", band(F.col("n"))).join(cut(other(strays), "near-strays"), ["c", "band"])
    inside = inside.filter(apart & enough(F.least("i", "i_x"))).select("id", "x")

    mixed = group.filter("c <> id").groupBy("c").agg(F.bool_or(F.col("own") != F.col("main")).alias("m"), F.count("*").alias("k")).filter("m AND k > 1").select("c")
    outer = group.filter("c <> id AND i < n").join(cut(mixed, "near-mixed"), "c", "left_semi")
    outer = outer.join(sets.withColumnsRenamed({"hashes": "h"}), "id").join(sets.withColumnsRenamed({"id": "c", "hashes": "h_c"}), "c")
    outer = cut(outer.withColumn("r", F.explode(F.array_except("h", "h_c"))).drop("h", "h_c"), "near-outside")
    shared = outer.groupBy("c", "r").agg(F.count("*").alias("k"), F.min("own").alias("low"), F.max("own").alias("high")).filter("k > 1 AND low <> high")
    outer = cut(outer.join(cut(shared.select("c", "r", "k"), "near-shared"), ["c", "r"]), "near-outside-shared")
    rank = W.partitionBy("c", "id")
    wants = F.greatest(F.lit(1), F.ceil((rules.percent * F.col("n") - 100 * F.col("i")) / 100))
    outer = outer.withColumn("q", F.count("*").over(rank)).withColumn("at", F.row_number().over(rank.orderBy("k", "r")))
    outer = cut(outer.filter(F.col("at") <= F.col("q") - wants + 1), "near-outside-prefix")
    # pairs that their overlaps with the centre allow are in ``inside``; others need at least the rest in common outside it
    inner = F.least("i", "i_x")
    beside = outer.join(cut(other(outer.filter("own <> main")), "near-outside-strays"), ["c", "r"])
    beside = beside.filter(apart & ~enough(inner) & enough(inner + F.least("q", "q_x"))).select("id", "x")
    return inside.union(beside).select(F.least("id", "x").alias("a"), F.greatest("id", "x").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs``: id_col, n_shingles, component_id, kept (the id is its component's smallest).

    Null and empty texts have no shingles and link with nothing; rows with a null id
    stay alone with a null component. Rows that repeat an id are that document. An empty
    table gives an empty result. The result is written; the tables on the way to it are deleted.
    """
    with scratch():
        return cut(_near_duplicates(docs, id_col, text_col, rules), "near-result", keep=True)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, rules: Rules) -> DataFrame:
    every = cut(sketches(docs, id_col, text_col, rules), "near-sketches")
    named = every.filter("n > 0 AND id IS NOT NULL")
    # equal sets: the smallest id stands for all
    classes = cut(named.groupBy("whole").agg(F.min("id").alias("first"), F.min_by("n", "id").alias("n"), F.min_by("sketch", "id").alias("sketch")), "near-classes")
    heads = classes.select(F.col("first").alias("id"), "n", "sketch")
    empty = F.array().cast("array<bigint>")
    small = F.when(F.col("n") <= rules.small, _runs(F.col("sketch"), rules.small_run)).otherwise(empty)
    large = F.when(F.col("n") > rules.small_from, _runs(F.col("sketch"), rules.run)).otherwise(empty)
    entries = heads.select("id", "n", F.explode(F.concat(small, large)).alias("run"))
    sizes = cut(entries.groupBy("run").agg(F.count("*").alias("size")).filter("size > 1"), "near-lists")
    members = cut(entries.join(sizes, "run"), "near-members")
    # the centre of a list is the member whose runs are shared most, so least edited
    weight = cut(members.groupBy("id").agg(F.sum("size").alias("weight")), "near-weights")
    best = F.min(F.struct((-F.col("weight")).alias("w"), F.col("id").alias("a"), F.col("n").alias("n_a")))
    centres = cut(members.join(weight, "id").groupBy("run").agg(best.alias("c")).select("run", "c.a", "c.n_a"), "near-centres")
    # every member stays in the star, however far from the centre: it may be linked to another one
    stars = members.join(centres, "run").filter(F.col("id") != F.col("a")).select("a", F.col("n_a"), F.col("id").alias("b"), F.col("n").alias("n_b")).distinct()
    stars = cut(stars, "near-stars")
    # sketches only of documents that meet another
    heads = cut(heads.join(weight, "id").select("id", "n", "sketch"), "near-heads")
    wanted = cut(stars.select(F.col("a").alias(id_col)).union(stars.select("b")).distinct(), "near-wanted")
    sets = cut(full_sets(_of_ids(docs, id_col, wanted), id_col, text_col, rules).dropDuplicates(["id"]), "near-sets")
    stars = _compared(stars, sets)
    links = _links(stars, rules)
    across = _likely_pairs(_across(stars, components(links), sets, rules), heads, rules)  # of documents in stars
    links = links.union(_links(_compared(across, sets), rules))
    labels = components(links).withColumnRenamed("id", "first")
    of_class = cut(classes.select("whole", "first").join(labels, "first", "left").select("whole", F.coalesce("component", "first").alias("component")), "near-components")
    joined = every.select("id", "n", "whole").join(of_class, "whole", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with all columns."""
    found = near_duplicates(docs, id_col, text_col, rules)
    dropped = cut(found.filter("NOT kept").select(id_col).distinct(), "near-dropped")
    discard(found)
    return without(docs, dropped, id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: components at 85 % over three-word shingles."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, rules=Rules(shingle=3, percent=85))
