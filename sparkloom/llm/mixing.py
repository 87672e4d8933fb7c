"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Documents of a source form blocks in a seeded random order. Block j (from 1) of a
source with weight w, its share of all weights, may start in slot floor((j - 1) / w)
and must end by slot ceil(j / w); earliest deadline first fills one slot after the
other. So while no source has run out, its number of blocks in the first t slots
is less than one away from t * w, for every t.

Slots are planned in ranges, a row each, so that a plan is no single task. A range
is longer than every window, so a block's window crosses one border at most. At a
border each crossing block goes to one side: blocks with windows wholly before the
border leave some slots there free, and earliest deadline first deals those out.
Inside a range, earliest deadline first runs from one border's state to the next.
Weights are integers throughout, so no rounding adds up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sparkloom.llm.common import cut

BLOCK_DOCS = 16
BUCKET_DOCS = 512
RANGE_SLOTS = 1024
#: Weights that are no small whole numbers are rounded to units of this part of their sum.
UNITS = 1 << 28
#: The smallest weight that is told apart, as a part of the sum: a window is no longer than this many slots.
SMALLEST = 1 << 20
SEED = 42


def root_weights(docs: DataFrame, source_col: str = "source", power: float = 0.5) -> DataFrame:
    """source, weight: the target share of a source is its number of documents to a power."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(F.pow(F.count("*").cast("double"), F.lit(power)).alias("weight"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def units(weights: DataFrame) -> DataFrame:
    """source, s (number from 0), u (whole number), total (of all u): the target share of a source is u / total.

    Whole weights with a sum of up to UNITS are used as they are; others are rounded to
    the total's part of UNITS. Weights of less than a SMALLEST part of the sum count as that part, so that a plan stays
    finite. A null or non-positive weight has no share: u is 0 and s null. One small row a source.
    """
    every = W.partitionBy(F.lit(1))
    w = weights.select("source", F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("w"))
    w = w.withColumn("sum", F.sum("w").over(every)).withColumn("whole", F.bool_and((F.col("w") == F.floor("w")) & ((F.col("w") == 0) | (F.col("w") * SMALLEST >= F.col("sum")))).over(every) & (F.col("sum") <= UNITS))
    scaled = F.greatest(F.lit(UNITS // SMALLEST), F.round(F.col("w") / F.col("sum") * UNITS)).cast("long")
    u = F.when(F.col("w") == 0, F.lit(0).cast("long")).when(F.col("whole"), F.col("w").cast("long")).otherwise(scaled)
    w = w.select("source", u.alias("u")).withColumn("total", F.sum("u").over(every))
    number = F.row_number().over(W.partitionBy(F.col("u") > 0).orderBy(F.col("source").asc_nulls_first())) - 1
    return w.select("source", F.when(F.col("u") > 0, number).alias("s"), "u", "total")


def _frame(sized: DataFrame, range_slots: int) -> DataFrame:
    """One row: q, the sources' (s, u, blocks) in order, total, span (slots of a range) and ranges.

    Ranges are planned until all sources but the most lasting one have run out; that one goes on alone.
    """
    lasting = _div(F.col("blocks") * F.col("total") + F.col("u") - 1, F.col("u"))
    row = sized.filter("u > 0").withColumn("lasts", lasting).groupBy("total").agg(F.array_sort(F.collect_list(F.struct("s", "u", "blocks"))).alias("q"), F.min("u").alias("least"), F.array_sort(F.collect_list("lasts")).alias("lasts"))
    span = F.greatest(F.lit(range_slots).cast("long"), _div(F.col("total"), F.col("least")) + 3)
    second = F.coalesce(F.get("lasts", F.size("lasts") - 2), F.lit(0).cast("long"))
    row = row.withColumn("span", span).withColumn("ranges", _div(second + F.col("span") - 1, F.col("span")))
    return cut(row.select("total", "q", "span", "ranges"), "mix-frame")


def _borders(frame: DataFrame, ranges: int) -> DataFrame:
    """k, total, q, span, done: how many blocks of each source come before slot k * span, for k from 0 to ``ranges``."""
    spark = frame.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ks = spark.range(0, ranges + 1, 1, min(ranges + 1, most)).select(F.col("id").alias("k"), F.lit(1).alias("one"))
    rows = ks.join(F.broadcast(frame.withColumn("one", F.lit(1))), "one").drop("one")  # one row of three numbers a source
    b, total = F.col("k") * F.col("span"), F.col("total")
    base = F.transform(
        "q",
        lambda x: F.struct(
            x["s"].alias("s"),
            x["u"].alias("u"),
            _div(b * x["u"], total).alias("base"),
            (F.pmod(b * x["u"], total) > 0).alias("open"),
        ),
    )
    rows = rows.withColumn("x", base)
    crossing = F.transform(
        F.filter("x", lambda x: x["open"]),
        lambda x: F.struct(_div((x["base"] + 1) * total + x["u"] - 1, x["u"]).alias("deadline"), x["s"].alias("s"), _div(x["base"] * total, x["u"]).alias("release")),
    )
    rows = rows.withColumn("crossing", crossing).withColumn("room", b - F.aggregate("x", F.lit(0).cast("long"), lambda n, x: n + x["base"]))

    def inside(a: Column) -> Column:
        """Blocks with windows wholly in [a, border)."""
        return F.aggregate("x", F.lit(0).cast("long"), lambda n, x: n + F.greatest(F.lit(0).cast("long"), x["base"] - _div(a * x["u"] + total - 1, total)))

    def step(state: Column, a: Column) -> Column:
        left = F.least(state["left"], b - a - 1 - inside(a + 1))
        return F.struct(left.alias("left"), F.when(left < state["left"], F.array_append(state["free"], a)).otherwise(state["free"]).alias("free"))

    first = F.array_min(F.transform("crossing", lambda c: c["release"]))
    slots = F.when(F.col("room") > 0, F.sequence(first, b - 1)).otherwise(F.array().cast("array<bigint>"))
    free = F.aggregate(slots, F.struct(F.col("room").alias("left"), F.array().cast("array<bigint>").alias("free")), step, lambda s: s["free"])
    rows = rows.withColumn("free", free)

    def deal(state: Column, p: Column) -> Column:
        chosen = F.array_min(F.filter(state["rest"], lambda c: c["release"] <= p))["s"]
        return F.struct(F.filter(state["rest"], lambda c: c["s"] != chosen).alias("rest"), F.array_append(state["before"], chosen).alias("before"))

    before = F.aggregate("free", F.struct(F.col("crossing").alias("rest"), F.array().cast("array<int>").alias("before")), deal, lambda s: s["before"])
    rows = rows.withColumn("before", before)
    done = F.transform("x", lambda x: x["base"] + F.array_contains("before", x["s"]).cast("long"))
    return cut(rows.select("k", "total", "q", "span", done.alias("done")), "mix-borders")


def plan(borders: DataFrame) -> DataFrame:
    """s, block (from 0), slot: earliest deadline first in each range; blocks that their source has."""
    until = borders.select((F.col("k") - 1).alias("k"), F.col("done").alias("until"))
    rows = borders.join(until, "k")
    total, start = F.col("total"), F.col("k") * F.col("span")
    end = start + F.col("span")
    never = F.lit((1 << 62)).cast("long")

    def job(s: Column, u: Column, j: Column, last: Column) -> Column:
        """Deadline, source, number and release of a source's block j; it waits for ever beyond its last one in this range."""
        due = F.least(end, _div(j * total + u - 1, u))
        release = F.when(j <= last, _div((j - 1) * total, u)).otherwise(never)
        return F.struct(due.alias("deadline"), s.alias("s"), j.alias("j"), release.alias("release"), u.alias("u"), last.alias("last"))

    jobs = F.transform("q", lambda x, i: job(x["s"], x["u"], F.get("done", i) + 1, F.get("until", i)))

    def step(state: Column, slot: Column) -> Column:
        chosen = F.array_min(F.filter(state["jobs"], lambda x: x["release"] <= slot))
        after = F.transform(state["jobs"], lambda x: F.when(x["s"] == chosen["s"], job(x["s"], x["u"], x["j"] + 1, x["last"])).otherwise(x))
        return F.struct(after.alias("jobs"), F.array_append(state["order"], F.struct(chosen["s"].alias("s"), (chosen["j"] - 1).alias("block"), slot.alias("slot"))).alias("order"))

    def some(state: Column, at: Column) -> Column:
        """A few hundred slots at a time, so that no long array is copied for every slot."""
        part = F.aggregate(F.sequence(at, F.least(at + 255, end - 1)), F.struct(state["jobs"].alias("jobs"), none.alias("order")), step)
        return F.struct(part["jobs"].alias("jobs"), F.concat(state["order"], F.filter(part["order"], lambda x: x["block"] < F.get("q", x["s"])["blocks"])).alias("order"))

    none = F.array().cast("array<struct<s: int, block: bigint, slot: bigint>>")
    order = F.aggregate(F.sequence(start, end - 1, F.lit(256).cast("long")), F.struct(jobs.alias("jobs"), none.alias("order")), some, lambda s: s["order"])
    return rows.select(F.inline(order))


def _places(keys: DataFrame, sized: DataFrame, id_col: str, source_col: str, block_docs: int) -> DataFrame:
    """``keys`` with _s, _tail, _end, mix_block and mix_offset: rows numbered in each source by a seeded draw.

    Rows are dealt to buckets of about BUCKET_DOCS by their draw, numbered there, and sizes of buckets
    are summed in two steps, so a window task of a source holds one row for BUCKET_DOCS ** 2 documents.
    """
    small = sized.select(F.col("source").alias("_source"), F.col("n").alias("_g"), "_s", "_tail", "_end", "_buckets")
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(SEED)), F.lit(1 << 31).cast("long"))
    dealt = keys.withColumn("_draw", draw).join(small, F.col(source_col).eqNullSafe(F.col("_source"))).drop("_source")
    dealt = dealt.withColumn("_bucket", F.floor(F.col("_draw") * F.col("_buckets") / F.lit(1 << 31)))
    sizes = cut(dealt.groupBy("_g", "_bucket").count().withColumn("_part", F.floor(F.col("_bucket") / BUCKET_DOCS)), "mix-buckets")
    earlier = lambda w: F.coalesce(F.sum("count").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("_g", "_part").agg(F.sum("count").alias("count")).select("_g", "_part", earlier(W.partitionBy("_g").orderBy("_part")).alias("_base"))
    inner = sizes.select("_g", "_part", "_bucket", earlier(W.partitionBy("_g", "_part").orderBy("_bucket")).alias("_inner"))
    offsets = cut(inner.join(parts, ["_g", "_part"]).select("_g", "_bucket", (F.col("_base") + F.col("_inner")).alias("_before")), "mix-offsets")
    row = F.row_number().over(W.partitionBy("_g", "_bucket").orderBy("_draw", F.col(id_col))) - 1
    placed = dealt.withColumn("_row", row).join(offsets, ["_g", "_bucket"]).withColumn("_row", F.col("_before") + F.col("_row"))
    return placed.withColumn("mix_block", F.floor(F.col("_row") / block_docs)).withColumn("mix_offset", F.col("_row") % block_docs)


def schedule(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", source_col: str = "source", block_docs: int = BLOCK_DOCS, range_slots: int = RANGE_SLOTS) -> DataFrame:
    """``docs`` with mix_block (number of its block in the source), mix_slot and mix_offset; all rows, in no order.

    The mixed order is by (mix_slot, mix_offset). A null source is a source of its
    own. When a source has no more blocks its slots stay empty and the others go on in
    proportion; the last one left takes slot after slot. A source missing from ``weights``, or
    with a null or non-positive weight, is no part of the mix: its rows stay, with a null mix_slot. Rows
    with equal ids are separate documents. Columns of ``docs`` with the added names are replaced.
    The plan's work is slots x sources; a range is at least as long as the smallest weight's window.
    """
    docs = docs.drop("mix_block", "mix_slot", "mix_offset")
    sources = docs.groupBy(F.col(source_col).alias("source")).count()
    listed = cut(sources.alias("n").join(weights.alias("w"), F.col("n.source").eqNullSafe(F.col("w.source")), "left").select("n.source", "count", "weight"), "mix-sources")
    number = (F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.col("a.source").asc_nulls_first())) - 1).alias("n")
    sized = listed.alias("a").join(units(listed).alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
    sized = cut(sized.select(number, "a.source", "s", "u", "total", F.ceil(F.col("count") / block_docs).alias("blocks"), F.ceil(F.col("count") / BUCKET_DOCS).alias("_buckets")), "mix-units")
    frame = _frame(sized, range_slots)
    head = frame.select("ranges", "span").first()
    ranges, span = (head.ranges, head.span) if head else (0, 0)
    borders = _borders(frame, ranges)
    turns = cut(plan(borders), "mix-plan")
    last = borders.filter(F.col("k") == ranges).select(F.posexplode("done").alias("s", "_tail"))
    sized = cut(sized.join(last, "s", "left").select("n", "source", F.col("s").alias("_s"), "_tail", F.lit(ranges * span).alias("_end"), "_buckets"), "mix-sized")
    placed = _places(docs, sized, id_col, source_col, block_docs)
    turns = turns.select(F.col("s").alias("_s"), F.col("block").alias("mix_block"), F.col("slot").alias("_slot"))
    alone = F.col("_end") + F.col("mix_block") - F.col("_tail")
    return placed.join(turns, ["_s", "mix_block"], "left").withColumn("mix_slot", F.coalesce("_slot", alone)).select(*docs.columns, "mix_block", "mix_slot", "mix_offset")


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", places: str | None = None, **options) -> DataFrame:
    """All rows of ``docs`` with their own columns; the default weights are root_weights.

    Only ids and sources go through the scheduling. The other columns are moved once, at any
    size, to meet their place: rows are dealt by id, and each partition is in mixed
    order, so a file is an even share of the mix that interleaves the sources by weight. The exact
    order of all rows is in the places. Rows with equal id and source share a place; rows of
    sources outside the mix come last.
    places: a path to write the places to: id_col, source_col, mix_slot, mix_offset.
    """
    keys = docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source")).distinct()
    keys = cut(keys, "mix-keys")
    weights = root_weights(docs, source_col) if weights is None else weights
    placed = schedule(keys, weights, "__id", "__source", **options)
    placed = cut(placed.select("__id", "__source", F.col("mix_slot").alias("__slot"), F.col("mix_offset").alias("__offset")), "mix-places")
    if places:
        placed.toDF(id_col, source_col, "mix_slot", "mix_offset").write.mode("overwrite").parquet(places)
    found = docs.join(placed.hint("merge"), F.col(id_col).eqNullSafe(F.col("__id")) & F.col(source_col).eqNullSafe(F.col("__source")))
    return found.sortWithinPartitions(F.col("__slot").asc_nulls_last(), "__offset").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: block, slot and place in the block of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    return schedule(docs, root_weights(docs))
