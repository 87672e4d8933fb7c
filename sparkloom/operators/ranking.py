"""Ranks, top-k and multiple testing over groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sparkloom.sources.tables import written

#: Value ranges into which a group is cut for ranking; a task then holds one range of one group.
BUCKETS = 32
#: Rows of one p-value that a task joins; values of more rows, of which there are at most so many times fewer than rows, are sent.
HEAVY = 1 << 16
#: Where the share of null hypotheses is estimated before it is smoothed.
LAMBDAS = [i * 0.01 for i in range(96)]


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group, numbered; ``order`` must end in a tie-break.

    The filter sits directly on the rank, so Spark limits each group before the shuffle.
    """
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)


def distinct_positions(values: DataFrame, keys: list[str], value: str, weight: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``below``, the weight of smaller values of the group, and ``_b``, the value's range, to rows of one distinct value each.

    A group is cut at approximate quantiles, ranked range by range, and the ranges'
    totals are summed up, so a group of any size is ranked by many tasks. Approximate quantiles depend on the order in which
    parts arrive, so rows are written with their range: totals and rows must see the same cuts.
    """
    steps = [i / buckets for i in range(1, buckets)]
    cuts = values.groupBy(*keys).agg(F.percentile_approx(value, F.array(*map(F.lit, steps)), F.lit(1000)).alias("_cuts"))
    rows = written(values.join(cuts, keys).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts"), "ranges")
    totals = rows.groupBy(*keys, "_b").agg(F.sum(weight).alias("_t"))
    before = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    upto = W.partitionBy(*keys, "_b").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("_upto", F.sum(weight).over(upto))
    return rows.join(totals, [*keys, "_b"]).withColumn("below", F.col("_before") + F.col("_upto") - F.col(weight)).drop("_upto", "_before")


def positions(df: DataFrame, keys: list[str], value: str, weight: Column | None = None, buckets: int = BUCKETS, keep_range: bool = False) -> DataFrame:
    """Adds ``below`` and ``equal``: the weight of rows of the group with a smaller, and with the same value.

    Equal values are added up before any is ranked, so a value that most rows have is one row of a
    task; rows meet their value's place again by a join. Rows with a null or NaN value are dropped.
    """
    rows = df.filter(F.col(value).isNotNull() & ~F.isnan(value)).withColumn("_w", F.lit(1) if weight is None else weight)
    placed = distinct_positions(rows.groupBy(*keys, value).agg(F.sum("_w").alias("equal")), keys, value, "equal", buckets)
    return rows.drop("_w").join(placed if keep_range else placed.drop("_b"), [*keys, value])


def average_ranks(df: DataFrame, keys: list[str], value: str, rank: str = "rank") -> DataFrame:
    """Adds average ranks from 1 and ``equal``, the size of the tie."""
    return positions(df, keys, value).withColumn(rank, F.col("below") + (F.col("equal") + 1) / 2).drop("below")


def benjamini_hochberg(df: DataFrame, keys: list[str], p: str, out: str = "adj_pval", ties: list[str] | None = None) -> DataFrame:
    """Adds p-values adjusted within each group: the smallest of p * m / rank over equal or larger ranks, at most 1."""
    order = [F.col(p), *map(F.col, ties or [])]
    group = W.partitionBy(*keys)
    df = df.withColumn("_m", F.count("*").over(group)).withColumn("_k", F.row_number().over(group.orderBy(*order)))
    later = group.orderBy(F.desc("_k")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(out, F.least(F.lit(1.0), F.min(F.col(p) * F.col("_m") / F.col("_k")).over(later))).drop("_m", "_k")


def benjamini_hochberg_wide(df: DataFrame, p: str, out: str = "adj_pval", buckets: int = BUCKETS) -> DataFrame:
    """Benjamini-Hochberg over a whole table, range by range, so that no task holds it. Rows with a null p are dropped.

    A row's rank is that of the last of its ties, which gives ties one value, so distinct p-values are adjusted. The smallest
    value of each range is carried to the ranges below it. Values of more than HEAVY rows are sent to them, others are joined.
    """
    rows = df.filter(F.col(p).isNotNull() & ~F.isnan(p))
    values = distinct_positions(rows.groupBy(p).agg(F.count("*").alias("equal")).withColumn("_all", F.lit(1)), ["_all"], p, "equal", buckets)
    ranges = values.groupBy("_b").agg(F.sum("equal").alias("_n"))
    m = F.sum("_n").over(W.partitionBy(F.lit(1)))
    values = values.join(ranges.withColumn("_m", m).drop("_n"), "_b").withColumn("_v", F.col(p) * F.col("_m") / (F.col("below") + F.col("equal")))
    later = F.min("_v").over(W.orderBy(F.desc("_b")).rowsBetween(W.unboundedPreceding, -1))
    carried = values.groupBy("_b").agg(F.min("_v").alias("_v")).select("_b", later.alias("_later"))
    own = F.min("_v").over(W.partitionBy("_b").orderBy(F.desc(p)))
    adjusted = F.least(F.lit(1.0), own, F.coalesce("_later", F.lit(1.0)))
    values = written(values.join(carried, "_b").select(p, "equal", adjusted.alias(out)), "adjusted")
    heavy, light = values.filter(F.col("equal") > HEAVY).drop("equal"), values.filter(F.col("equal") <= HEAVY).drop("equal")
    sent = rows.join(F.broadcast(heavy), p)
    rest = rows.join(F.broadcast(heavy.select(p)), p, "left_anti").join(light, p)
    return sent.unionByName(rest).select(*df.columns, out)


def storey_steps() -> list[float]:
    """What a p-value adds to pi0 times the number of tests, by how many of LAMBDAS are below it.

    pi0 is the cubic least-squares fit to (lambda, share of p-values above lambda / (1 - lambda)) at 1, which is linear in the p-values' indicators.
    """
    x = np.array(LAMBDAS)
    powers = np.vander(x, 4)
    at_one = np.ones(4) @ np.linalg.solve(powers.T @ powers, powers.T)
    return np.r_[0.0, np.cumsum(at_one / (1 - x))].tolist()


def storey(df: DataFrame, keys: list[str], p: str, out: str = "qval", lam: float | None = None, ties: list[str] | None = None) -> DataFrame:
    """Adds q-values: pi0 times the Benjamini-Hochberg values (Storey and Tibshirani 2003).

    pi0 is the share of p-values above ``lam`` over 1 - lam, at most 1. Without lam these shares are smoothed by
    a cubic over lambda = 0, 0.01 ... 0.95 and read at 1; a value outside 0 to 1 counts as 1.
    """
    if lam is None:
        below = F.size(F.filter(F.array(*map(F.lit, LAMBDAS)), lambda x: x < F.col(p)))
        pi0 = F.avg(F.get(F.array(*map(F.lit, storey_steps())), below))
        pi0 = F.when(pi0.between(0.0, 1.0), pi0).otherwise(1.0)
    else:
        pi0 = F.least(F.lit(1.0), F.avg((F.col(p) > lam).cast("double")) / (1 - lam))
    share = df.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(pi0.alias("_pi0"))
    rows = df.crossJoin(share) if not keys else df.join(share, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]).drop(*(f"_k{i}" for i in range(len(keys))))
    return benjamini_hochberg(rows, keys, p, out, ties).withColumn(out, F.least(F.lit(1.0), F.col("_pi0") * F.col(out))).drop("_pi0")


def clean_p(p: Column) -> Column:
    """A p-value that is null, not finite, below 0 or above 1 becomes 1."""
    return F.when(p.isNull() | F.isnan(p) | ~p.between(0.0, 1.0), 1.0).otherwise(p)
