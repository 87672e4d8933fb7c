"""Hard-negative mining by coordinate pruning.

Rows are dealt into blocks by label and length. In a block, buckets of rows of like
length hold, for each coordinate, the row numbers sorted by the normalised coordinate. An
anchor that needs a score of at least theta needs an angle to the row of at most arccos(theta / (its
length x the bucket's)); its focus coordinates then can only take values in a range,
which binary search finds in the sorted lists. Rows in all ranges are verified by exact
integer products. One block gives an anchor its first threshold, which prunes the others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sparkloom.llm.common import cut, discard


@dataclass(frozen=True)
class Mining:
    """low, high: bounds of 100 x a negative's score / its positive's. scale: entries become floor(scale x entry).
    focus: coordinates of an anchor that prune. bucket_rows: rows of a bucket of like length.
    block_rows, block_anchors: rows and anchors that meet in one task."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    focus: int = 5
    bucket_rows: int = 2048
    block_rows: int = 65_536
    block_anchors: int = 4096


class Bucket:
    """Rows of like length with their sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, lengths: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.least, self.most = float(lengths.min()), float(lengths.max())
        self.peak = float(np.abs(x).max(initial=0))
        unit = x / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(unit, self.order.T, axis=0).T
        self.unit = unit

    def candidates(self, unit: np.ndarray, length: float, focus: np.ndarray, theta: float | None) -> np.ndarray | None:
        """Rows that may score theta or more with an anchor of that direction and length; None stands for all."""
        if theta is None:
            return None
        if length == 0:
            return None if theta <= 0 else np.empty(0, np.int64)
        span = self.most if theta > 0 else self.least
        if span == 0:
            return None if theta <= 0 else np.empty(0, np.int64)
        need = theta / (length * span) - 1e-9  # rounding of lengths and angles is far below
        if need > 1:
            return np.empty(0, np.int64)
        if need <= -1:
            return None
        reach, angle = np.arccos(need), np.arccos(np.clip(unit[focus], -1, 1))
        low = np.cos(np.minimum(angle + reach, np.pi)) - 1e-9
        high = np.cos(np.maximum(angle - reach, 0)) + 1e-9
        starts = [int(np.searchsorted(self.sorted[c], b, "left")) for c, b in zip(focus, low, strict=True)]
        ends = [int(np.searchsorted(self.sorted[c], b, "right")) for c, b in zip(focus, high, strict=True)]
        widths = np.subtract(ends, starts)
        by_width = np.argsort(widths, kind="stable")
        if widths[by_width[0]] == len(self.ids):
            return None
        first = by_width[0]
        found = self.order[focus[first], starts[first] : ends[first]]
        for c in by_width[1:]:
            if widths[c] < len(self.ids) and len(found):
                at = self.unit[found, focus[c]]
                found = found[(at >= low[c]) & (at <= high[c])]
        return found

    def scores(self, found: np.ndarray | None, anchor: np.ndarray) -> np.ndarray:
        """Exact integer products, in doubles where those are exact."""
        x = self.x if found is None else self.x[found]
        if self.peak * float(np.abs(anchor).max(initial=0)) * max(len(anchor), 1) < 2**53:
            return (x.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
        return x @ anchor


def _in_order(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by falling score, then rising id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _numbers(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) if len(flat) else np.zeros((0, dims), np.int64)


FOUND = "anchor long, want long, want_score long, id long, score long"


def _search(rows: DataFrame, routed: DataFrame, how: Mining, k: int, same: bool) -> DataFrame:
    """The block's first k rows for each want of each anchor routed to a block, in FOUND.

    rows: block, id, label, x, length. routed: block, anchor, id, label, x, wants (array of want, want_score, low, high;
    null bounds are open). same: rows of the anchor's label other than itself, else of other labels. A want's
    lower bound rises with what its buckets have given, so later buckets are pruned by more.
    """

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            dims = len(right.column("x")[0])
            ids, labels = left.column("id").to_numpy(), left.column("label").to_numpy()
            x, lengths = _numbers(left.column("x"), dims), np.sqrt(left.column("length").to_numpy())
            by_length = np.argsort(-lengths, kind="stable")
            buckets = []
            for at in range(0, len(by_length), how.bucket_rows):
                part = by_length[at : at + how.bucket_rows]
                buckets.append(Bucket(ids[part], labels[part], x[part], lengths[part]))
            anchors = _numbers(right.column("x"), dims)
            keys, own, of_label = right.column("anchor").to_pylist(), right.column("id").to_pylist(), right.column("label").to_pylist()
            for a, wants in enumerate(right.column("wants").to_pylist()):
                out += _anchor(buckets, anchors[a], own[a], of_label[a], [(keys[a], w) for w in wants])
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor", "want", "want_score", "id", "score"])

    def _anchor(buckets: list[Bucket], q: np.ndarray, own: int, label: int, wants: list) -> list[tuple]:
        length = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
        unit = q / length if length else q.astype(np.float64)
        focus = np.argsort(-np.abs(unit), kind="stable")[: how.focus]
        held = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in wants]
        for bucket in buckets:
            least = []
            for (_, w), (s, _) in zip(wants, held, strict=True):
                floor = s.min() if len(s) == k else None
                bounds = [b for b in (w["low"], floor) if b is not None]
                least.append(max(bounds) if bounds else None)
            theta = None if None in least else float(min(least))
            found = bucket.candidates(unit, length, focus, theta)
            scores = bucket.scores(found, q)
            of, ids = (bucket.labels, bucket.ids) if found is None else (bucket.labels[found], bucket.ids[found])
            fits = (of == label) & (ids != own) if same else of != label
            for i, (_, w) in enumerate(wants):
                mask = fits
                if least[i] is not None:
                    mask = mask & (scores >= least[i])
                if w["high"] is not None:
                    mask = mask & (scores <= w["high"])
                if mask.any():
                    s, d = np.append(held[i][0], scores[mask]), np.append(held[i][1], ids[mask])
                    top = _in_order(s, d, k)
                    held[i] = s[top], d[top]
        return [(key, w["want"], w["want_score"], int(d), int(s)) for (key, w), (scores, ids) in zip(wants, held, strict=True) for s, d in zip(scores, ids, strict=True)]

    return rows.groupBy("block", "part").cogroup(routed.groupBy("block", "part")).applyInArrow(meet, FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each want over all blocks; Spark keeps k a task before the shuffle."""
    order = W.partitionBy("anchor", "want").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def prepare(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """id, label, x (array of long), length (squared) of the rows that take part."""
    finite = F.col(vec_col).isNotNull() & ~F.exists(vec_col, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    kept = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite)
    x = F.transform(vec_col, lambda c: F.floor(c.cast("double") * scale))
    kept = kept.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), x.alias("x"))
    lengths = kept.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    squares = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return kept.filter(F.size("x") == (lengths[0]["dims"] if lengths else -1)).withColumn("length", squares)


def mine(rows: DataFrame, anchors: DataFrame, how: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows, anchors: as prepare() returns. An anchor's positives are its first rows of the same
    label and another id; a row with a repeated id counts as often as it occurs, among positives and negatives, and an
    anchor that occurs more than once is searched for once. For each positive the first rows of other labels with
    low x positive_score <= 100 x score <= high x positive_score: a positive with a negative score has none. Scores
    are exact within long. Ties go to the smaller id. No rows or no anchors give an empty result.
    """
    spark = rows.sparkSession
    n = rows.count()
    blocks = max(-(-n // how.block_rows), min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), 1)
    # a range can't be one value only: the hash splits equal labels and lengths
    dealt = cut(rows.repartitionByRange(blocks, "label", "length", F.xxhash64("id")).withColumn("block", F.spark_partition_id()), "mine-rows")
    places = cut(dealt.groupBy("label", "block").agg(F.max("length").alias("most")), "mine-blocks")
    last = places.agg(F.coalesce(F.max("block"), F.lit(0))).first()[0]
    asked = cut(anchors.distinct().withColumn("anchor", F.monotonically_increasing_id()), "mine-anchors")
    parts = max(1, -(-asked.count() // how.block_anchors))
    part = F.pmod(F.xxhash64("anchor"), F.lit(parts)).cast("int").alias("part")
    spread = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    want = "array<struct<want:long,want_score:long,low:long,high:long>>"
    none = F.lit(None).cast("long")

    # positives: one block of the anchor's label, then those others that can reach what it gave
    own = places.groupBy("label").agg(F.min("block").alias("least"), F.max("block").alias("most_block"))
    home = asked.join(own, "label").withColumn("block", (F.col("least") + F.pmod(F.xxhash64("anchor"), F.col("most_block") - F.col("least") + 1)).cast("int"))
    open_want = F.array(F.struct(F.lit(0).cast("long").alias("want"), none.alias("want_score"), none.alias("low"), none.alias("high"))).cast(want)
    first = cut(_search(spread, home.select("block", part, "anchor", "id", "label", "x", open_want.alias("wants")), how, how.positives, True), "mine-first")
    bar = first.groupBy("anchor").agg(F.when(F.count("*") >= how.positives, F.min("score")).alias("bar"))
    others = home.select("anchor", "id", "label", "x", "length", F.col("block").alias("_home")).join(bar, "anchor", "left").join(places, "label").filter(F.col("block") != F.col("_home"))
    near = others.filter(F.col("bar").isNull() | (F.col("bar") <= F.sqrt(F.col("length")) * F.sqrt(F.col("most")) * (1 + 1e-9)))
    barred = F.array(F.struct(F.lit(0).cast("long").alias("want"), none.alias("want_score"), F.col("bar").alias("low"), none.alias("high"))).cast(want)
    more = _search(spread, near.select("block", part, "anchor", "id", "label", "x", barred.alias("wants")), how, how.positives, True)
    positives = cut(_first(first.unionByName(more), how.positives), "mine-positives")

    # negatives: the same, with a want for each positive
    share = lambda percent: F.col("score").cast("decimal(20,0)") * F.lit(percent) / F.lit(100)  # noqa: E731  exact
    low, high = F.ceil(share(how.low)).cast("long"), F.floor(share(how.high)).cast("long")
    wants = positives.select("anchor", F.struct(F.col("rank").cast("long").alias("want"), F.col("score").alias("want_score"), low.alias("low"), high.alias("high")).alias("w")).filter("w.low <= w.high")
    wanted = cut(wants.groupBy("anchor").agg(F.array_sort(F.collect_list("w")).alias("wants")).join(asked, "anchor"), "mine-wants")
    begun = wanted.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(last + 1)).cast("int"))
    early = cut(_search(spread, begun.select("block", part, "anchor", "id", "label", "x", "wants"), how, how.negatives, False), "mine-early")
    raised = early.groupBy("anchor", "want").agg(F.when(F.count("*") >= how.negatives, F.min("score")).alias("bar"))
    known = F.map_from_entries(F.filter(F.collect_list(F.struct("want", "bar")), lambda e: e["bar"].isNotNull()))
    lifted = begun.join(raised.groupBy("anchor").agg(known.alias("bars")), "anchor", "left").withColumn(
        "wants", F.transform("wants", lambda w: F.struct(w["want"].alias("want"), w["want_score"].alias("want_score"), F.greatest(w["low"], F.try_element_at(F.col("bars"), w["want"])).alias("low"), w["high"].alias("high")))
    )
    rest = lifted.withColumn("_home", F.col("block")).withColumn("block", F.explode(F.filter(F.sequence(F.lit(0), F.lit(last)), lambda b: b != F.col("_home"))))
    late = _search(spread, rest.select("block", part, "anchor", "id", "label", "x", "wants"), how, how.negatives, False)
    negatives = _first(early.unionByName(late), how.negatives)
    named = negatives.join(positives.select("anchor", F.col("rank").cast("long").alias("want"), F.col("id").alias("positive_id")), ["anchor", "want"]).join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    out = cut(named.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("want_score").alias("positive_score"), F.col("score").alias("negative_score")), "mine-out")
    for table in (dealt, places, asked, first, positives, wanted, early):
        discard(table)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: hard negatives of every row whose id is divisible by 100, against all rows; labels of ids divisible by 7 are one too high."""
    how = Mining()
    rows = prepare(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"), "vec_id", "embedding", "label", how.scale)
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(rows, rows.filter("id % 100 = 0"), how)


ORACLE = """WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
pairs AS (SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score FROM rows a, rows b WHERE a.id % 100 = 0 AND a.id <> b.id),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN pairs USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM ranked WHERE rank <= 10"""
