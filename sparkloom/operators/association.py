"""Association of program scores with perturbations and categories."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.special import chi2_p, normal_p, range_p, t_p
from sparkloom.operators.ranking import BUCKETS, average_ranks, benjamini_hochberg, clean_p, distinct_positions, positions, storey
from sparkloom.sources.tables import written

EPSILON = 1e-9


def cells_of_targets(assignment: DataFrame, guides: DataFrame, key: str = "target") -> DataFrame:
    """Distinct (cell_id, key): cells with any guide of the target; a cell can have several."""
    return assignment.filter("n > 0").join(guides, "guide_name").select("cell_id", key).distinct()


def reference_cells(assignment: DataFrame, guides: DataFrame, targets: list[str]) -> DataFrame:
    """Distinct cell_id with any guide of a reference target; they may be test cells too."""
    return assignment.filter("n > 0").join(guides.filter(F.col("target").isin(*targets)), "guide_name").select("cell_id").distinct()


def mann_whitney(test: DataFrame, reference: DataFrame, keys: list[str], label: str, value: str = "score") -> DataFrame:
    """Mann-Whitney U of every label's rows against the reference rows of its keys.

    test: keys, label, value; reference: keys, value. The reference is ranked once for
    all labels: a test row adds the reference rows below it and half of those equal to
    it. Ties of both enter the variance. Adds ref_mean, test_mean, log2FC, stat, z.
    """
    side = lambda df, of, ref: df.filter(F.col(value).isNotNull() & ~F.isnan(value)).select(*keys, of.alias("_label"), value, F.lit(ref).alias("_ref"))
    rows = side(test, F.col(label), 0).unionByName(side(reference, F.lit(None).cast(test.schema[label].dataType), 1))
    # equal values are counted first, so a value that most cells have is a row a label
    by_label = rows.groupBy(*keys, value, "_label", "_ref").agg(F.count("*").alias("_c"))
    tests = F.collect_list(F.when(F.col("_ref") == 0, F.struct("_label", "_c"))).alias("_tests")
    by_value = by_label.groupBy(*keys, value).agg(F.sum(F.when(F.col("_ref") == 1, F.col("_c")).otherwise(0)).alias("_r"), tests)
    placed = distinct_positions(by_value, keys, value, "_r").drop("_b")
    cube = lambda x: x * x * x - x
    r = F.col("_r").cast("double")
    ref = placed.groupBy(*keys).agg(F.sum("_r").alias("n_ref"), (F.sum(r * F.col(value)) / F.sum(r)).alias("ref_mean"), F.sum(cube(r)).alias("_ref_ties"))
    c = F.col("_c").cast("double")
    tested = placed.select(*keys, value, "below", "_r", F.inline("_tests")).groupBy(*keys, "_label").agg(
        F.sum("_c").alias("n_test"),
        (F.sum(c * F.col(value)) / F.sum(c)).alias("test_mean"),
        F.sum(c * (F.col("below") + r / 2)).alias("stat"),
        F.sum(cube(r + c) - cube(r)).alias("_more_ties"),
    )
    ref = ref.filter("n_ref > 0")
    out = tested.join(ref, keys)
    n1, n2 = F.col("n_test").cast("double"), F.col("n_ref").cast("double")
    n = n1 + n2
    ties = F.col("_ref_ties") + F.col("_more_ties")
    sd = F.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    u = F.col("stat")
    z = (F.greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sd
    fold = F.log2((F.col("test_mean") + EPSILON) / (F.col("ref_mean") + EPSILON))
    return out.withColumn("log2FC", fold).withColumn("z", F.when(sd > 0, z)).drop("_ref_ties", "_more_ties").withColumnRenamed("_label", label)


def perturbation_association(usage: DataFrame, cells: DataFrame, assignment: DataFrame, guides: DataFrame, reference_targets: list[str], collapse_targets: bool = True, balanced_seed: int | None = None, fdr: str = "BH", run_keys: list[str] | None = None) -> DataFrame:
    """Mann-Whitney per condition, target (or guide) and program, with FDR per condition.

    collapse_targets=False tests each guide. balanced_seed: the reference of each label is
    drawn to the label's size without replacement. fdr: 'BH' or 'storey'. run_keys: key columns
    of ``guides`` beside guide_name and target, such as a run number; FDR is per run too.
    """
    run_keys = run_keys or []
    label = "target" if collapse_targets else "guide_name"
    control = guides.filter(F.col("target").isin(*reference_targets))
    tested = guides.filter(~F.col("target").isin(*reference_targets))
    has = assignment.filter("n > 0").select("cell_id", "guide_name")
    member = has.join(tested, "guide_name").select(*run_keys, "cell_id", label).distinct()
    reference = has.join(control, "guide_name").select(*run_keys, "cell_id").distinct()
    scores = usage.join(cells.select("cell_id", F.col("condition").alias("sample")), "cell_id")
    keys = [*run_keys, "sample", "program"]
    test_rows = scores.join(member, "cell_id")
    reference_rows = scores.join(reference, "cell_id")
    if balanced_seed is not None:
        from pyspark.sql.window import Window as W

        size = member.join(cells.select("cell_id", F.col("condition").alias("sample")), "cell_id").groupBy(*run_keys, "sample", label).agg(F.count("*").alias("_size"))
        drawn = reference.join(cells.select("cell_id", F.col("condition").alias("sample")), "cell_id").join(size, [*run_keys, "sample"])
        draw = F.md5(F.concat_ws("|", F.lit(str(balanced_seed)), F.col(label).cast("string"), F.col("cell_id").cast("string")))
        place = F.row_number().over(W.partitionBy(*run_keys, "sample", label).orderBy(draw, "cell_id"))
        drawn = drawn.withColumn("_place", place).filter("_place <= _size").select(*run_keys, "sample", label, "cell_id")
        keys = [*keys, label]
        reference_rows = scores.join(drawn, ["cell_id", "sample"])
        test_rows = test_rows.withColumn("_own", F.col(label))
        out = mann_whitney(test_rows.withColumnRenamed("_own", "_tested"), reference_rows, keys, "_tested").drop("_tested")
    else:
        out = mann_whitney(test_rows, reference_rows, keys, label)
    out = out.withColumn("pval", clean_p(F.least(F.lit(1.0), normal_p(F.greatest(F.col("z"), F.lit(0.0))))))
    scope = [*run_keys, "sample"]
    out = out.withColumnsRenamed({label: "target_name", "program": "program_name"})
    adjust = benjamini_hochberg if fdr == "BH" else storey
    return adjust(out, scope, "pval", "adj_pval", ties=["target_name", "program_name"])


def _group_ranks(scores: DataFrame, group: str, value: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Per (keys, group): n, rank sum; per keys: N, number of groups, sum of squared ranks, sum of t^3 - t.

    Rows of one value are counted by group before values are ranked, and ranks are summed from the counts, so rows never meet their ranks again.
    """
    rows = scores.filter(F.col(group).isNotNull() & F.col(value).isNotNull() & ~F.isnan(value))
    counts = rows.groupBy(*keys, value, group).agg(F.count("*").alias("_n")).groupBy(*keys, value).agg(F.sum("_n").alias("equal"), F.collect_list(F.struct(F.col(group).alias("g"), F.col("_n").alias("n"))).alias("_groups"))
    placed = distinct_positions(counts, keys, value, "equal").withColumn("rank", F.col("below") + (F.col("equal") + 1) / 2)
    each, t = placed.select(*keys, "rank", "equal", F.inline("_groups")), F.col("equal").cast("double")
    n, rank = F.col("n"), F.col("rank")
    # what a whole needs is a sum over its groups too, so the ranks are read once
    by_group = each.groupBy(*keys, F.col("g").alias(group)).agg(F.sum("n").alias("n"), F.sum(rank * n).alias("r"), F.sum(rank * rank * n).alias("_q"), F.sum(n * (t * t - 1)).alias("_t"))
    whole = by_group.groupBy(*keys).agg(F.sum("n").cast("double").alias("total"), F.count("*").alias("groups"), F.sum("_q").alias("squares"), F.sum("_t").alias("ties"))
    return by_group.drop("_q", "_t"), whole


def kruskal_wallis(scores: DataFrame, group: str, value: str = "score", keys: tuple[str, ...] = ("program",)) -> DataFrame:
    """H with tie correction and its chi-squared p-value, per keys."""
    keys = list(keys)
    by_group, whole = _group_ranks(scores, group, value, keys)
    sums = by_group.groupBy(*keys).agg(F.sum(F.col("r") * F.col("r") / F.col("n")).alias("_s"))
    n = F.col("total")
    h = (12 / (n * (n + 1)) * F.col("_s") - 3 * (n + 1)) / (1 - F.col("ties") / (n * n * n - n))
    return sums.join(whole, keys).select(*keys, h.alias("stat"), chi2_p(h, (F.col("groups") - 1).cast("double")).alias("pval"))


def posthoc(scores: DataFrame, group: str, value: str = "score", keys: tuple[str, ...] = ("program",), test: str = "dunn") -> DataFrame:
    """Pairwise tests after Kruskal-Wallis: keys, group_a < group_b, stat, pval. test: dunn, conover or dscf."""
    keys = list(keys)
    if test == "dscf":
        return _dscf(scores, group, value, keys)
    by_group, whole = _group_ranks(scores, group, value, keys)
    mean = by_group.select(*keys, group, "n", (F.col("r") / F.col("n")).alias("m"))
    a = mean.withColumnsRenamed({group: "group_a", "n": "n_a", "m": "m_a"})
    b = mean.withColumnsRenamed({group: "group_b", "n": "n_b", "m": "m_b"})
    pairs = a.join(b, keys).filter("group_a < group_b").join(whole, keys)
    n = F.col("total")
    spread = 1 / F.col("n_a") + 1 / F.col("n_b")
    if test == "dunn":
        sd = F.sqrt((n * (n + 1) / 12 - F.col("ties") / (12 * (n - 1))) * spread)
        z = (F.col("m_a") - F.col("m_b")) / sd
        return pairs.select(*keys, "group_a", "group_b", z.alias("stat"), normal_p(z).alias("pval"))
    s2 = (F.col("squares") - n * (n + 1) * (n + 1) / 4) / (n - 1)
    h = kruskal_wallis(scores, group, value, tuple(keys)).select(*keys, F.col("stat").alias("h"))
    df = n - F.col("groups")
    t = (F.col("m_a") - F.col("m_b")) / F.sqrt(s2 * (n - 1 - F.col("h")) / df * spread)
    return pairs.join(h, keys).select(*keys, "group_a", "group_b", t.alias("stat"), t_p(t, df.cast("double")).alias("pval"))


def _dscf(scores: DataFrame, group: str, value: str, keys: list[str]) -> DataFrame:
    """Dwass, Steel, Critchlow and Fligner: each pair of groups ranked on its own, studentised range."""
    groups = scores.select(*keys, group).distinct()
    pairs = groups.withColumnRenamed(group, "group_a").join(groups.withColumnRenamed(group, "group_b"), keys).filter("group_a < group_b")
    k = groups.groupBy(*keys).agg(F.count("*").cast("double").alias("k"))
    rows = scores.join(pairs, keys).filter((F.col(group) == F.col("group_a")) | (F.col(group) == F.col("group_b")))
    own = [*keys, "group_a", "group_b"]
    ranked = average_ranks(rows, own, value)
    first = F.col(group) == F.col("group_a")
    s = ranked.groupBy(*own).agg(F.count_if(first).cast("double").alias("n"), F.count_if(~first).cast("double").alias("m"), F.sum(F.when(first, F.col("rank"))).alias("w"), F.sum((F.col("equal") * F.col("equal") - 1).cast("double")).alias("ties"))
    n, m = F.col("n"), F.col("m")
    both = n + m
    var = n * m / 24 * (both + 1 - F.col("ties") / (both * (both - 1)))
    q = F.abs(F.col("w") - n * (both + 1) / 2) / F.sqrt(var)
    return s.join(k, keys).select(*own, q.alias("stat"), range_p(q, "k").alias("pval"))


def pairwise_summary(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest and mean p-value of each group over the others."""
    both = pairs.select(*keys, F.col("group_a").alias("group"), "pval").unionByName(pairs.select(*keys, F.col("group_b").alias("group"), "pval"))
    return both.groupBy(*keys, "group").agg(F.min("pval").alias("min_pval"), F.avg("pval").alias("mean_pval"))


def pseudobulk(scores: DataFrame, sample: str, group: str, value: str = "score", least: int = 3) -> DataFrame:
    """Mean per program, sample and group; groups need ``least`` samples, else an error."""
    rows = scores.filter(F.col(group).isNotNull() & F.col(sample).isNotNull())
    few = rows.groupBy(group).agg(F.count_distinct(sample).alias("n")).filter(F.col("n") < least).limit(5).collect()
    if few:
        raise ValueError(f"fewer than {least} samples in {[r[0] for r in few]}")
    return rows.groupBy("program", sample, group).agg(F.avg(value).alias(value))


def _r_test(r: Column, n: Column) -> Column:
    return t_p(r * F.sqrt((n - 2) / (1 - r * r)), (n - 2).cast("double"))


def correlate_one_vs_all(scores: DataFrame, group: str, value: str = "score", low: float | None = None) -> DataFrame:
    """Pearson correlation of the value with membership in each group, and log2 of the means inside and outside."""
    rows = scores if low is None else scores.filter(F.col(value) > low)
    x = F.col(value)
    by_group = rows.groupBy("program", group).agg(F.count("*").alias("n1"), F.sum(x).alias("s1"))
    whole = rows.groupBy("program").agg(F.count("*").alias("n"), F.sum(x).alias("s"), F.var_pop(x).alias("v"))
    n, n1 = F.col("n").cast("double"), F.col("n1").cast("double")
    share = n1 / n
    r = (F.col("s1") / n - F.col("s") / n * share) / F.sqrt(F.col("v") * share * (1 - share))
    fold = F.log2((F.col("s1") / n1) / ((F.col("s") - F.col("s1")) / (n - n1)))
    return by_group.join(whole, "program").filter("n1 < n").select("program", group, r.alias("stat"), _r_test(r, n).alias("pval"), fold.alias("log2FC"))


def correlate_one_vs_one(scores: DataFrame, group: str, value: str = "score") -> DataFrame:
    """Pearson correlation of the value with membership in group_b, among two groups, group_a < group_b."""
    x = F.col(value)
    s = scores.groupBy("program", group).agg(F.count("*").cast("double").alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q"))
    a = s.withColumnsRenamed({group: "group_a", "n": "n_a", "s": "s_a", "q": "q_a"})
    b = s.withColumnsRenamed({group: "group_b", "n": "n_b", "s": "s_b", "q": "q_b"})
    pairs = a.join(b, "program").filter("group_a < group_b")
    n = F.col("n_a") + F.col("n_b")
    mean, share = (F.col("s_a") + F.col("s_b")) / n, F.col("n_b") / n
    var = (F.col("q_a") + F.col("q_b")) / n - mean * mean
    r = (F.col("s_b") / n - mean * share) / F.sqrt(var * share * (1 - share))
    return pairs.select("program", "group_a", "group_b", r.alias("stat"), _r_test(r, n).alias("pval"))


def spearman(scores: DataFrame, x: str, y: str, keys: tuple[str, ...] = ("program",)) -> DataFrame:
    """Spearman correlation per keys, by average ranks."""
    keys = list(keys)
    rows = average_ranks(scores, keys, x, "rank_x").drop("equal")
    rows = average_ranks(rows, keys, y, "rank_y")
    r = rows.groupBy(*keys).agg(F.corr("rank_x", "rank_y").alias("stat"), F.count("*").alias("n"))
    return r.select(*keys, "stat", _r_test(F.col("stat"), F.col("n")).alias("pval"))


def order_sum(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Sum over pairs of w w' sign(x - x') sign(y - y'), by merging runs of rows sorted by x; O(n log^2 n)."""
    order = np.lexsort((y, x))
    x, y, w = x[order], np.unique(y[order], return_inverse=True)[1], w[order].astype(float)
    n, total = len(x), 0.0
    place = np.arange(n)
    size = 1
    while size < n:
        block, late = place // (2 * size), (place // size) % 2 == 1
        by = np.lexsort((y, block))
        key = block[by].astype(np.int64) * (n + 1) + y[by]
        early = np.where(late[by], 0.0, w[by])
        upto = np.r_[0.0, np.cumsum(early)]
        own = late[by]
        first = np.searchsorted(key, block[by][own].astype(np.int64) * (n + 1), "left")
        below = upto[np.searchsorted(key, key[own], "left")] - upto[first]
        last = np.searchsorted(key, (block[by][own].astype(np.int64) + 1) * (n + 1), "left")
        above = upto[last] - upto[np.searchsorted(key, key[own], "right")]
        total += float((w[by][own] * (below - above)).sum())
        size *= 2
    # pairs of equal x are in order of y, so each pair of different y was counted once
    same = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])] if n else np.empty(0, bool)
    cell = np.add.reduceat(w, np.flatnonzero(same)) if n else np.empty(0)
    column = np.add.reduceat(w, np.flatnonzero(np.r_[True, x[1:] != x[:-1]])) if n else np.empty(0)
    return total - ((column**2).sum() - (cell**2).sum()) / 2


def kendall(scores: DataFrame, x: str, y: str, keys: tuple[str, ...] = ("program",)) -> DataFrame:
    """Kendall's tau-b per keys with its normal p-value, both with ties, for any number of levels. Null and NaN rows are dropped; a constant side has null results.

    Equal pairs of values are counted first. Both sides are cut into ranges at approximate quantiles, a value that is a cut
    being a range of its own. Pairs in one range of x are counted in a task by merging, so are pairs in one range of y but in different ones
    of x; all others follow from the numbers of rows in the ranges. No task holds more than a range of a key.
    """
    keys = list(keys)
    good = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    rows = scores.filter(good(x) & good(y)).groupBy(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).agg(F.count("*").alias("w"))
    steps = F.array(*(F.lit(i / BUCKETS) for i in range(1, BUCKETS)))
    cuts = rows.groupBy(*keys).agg(*(F.array_distinct(F.percentile_approx(c, steps, F.lit(1000))).alias(f"c{c}") for c in "xy"))
    part = lambda c: 2 * F.size(F.filter(f"c{c}", lambda v: v < F.col(c))) + F.when(F.array_contains(f"c{c}", F.col(c)), 1).otherwise(0)
    rows = written(rows.join(cuts, keys).select(*keys, "x", "y", "w", part("x").alias("bx"), part("y").alias("by")), "kendall-rows")
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys) + ", s double"

    def result(pdf: pd.DataFrame, s: float) -> pd.DataFrame:
        return pd.DataFrame([[*pdf[keys].iloc[0], s]], columns=[*keys, "s"])

    def all_pairs(pdf: pd.DataFrame) -> float:
        return order_sum(pdf["x"].to_numpy(), pdf["y"].to_numpy(), pdf["w"].to_numpy())

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        return result(pdf, all_pairs(pdf) - sum(all_pairs(p) for _, p in pdf.groupby("bx")))

    def between(pdf: pd.DataFrame) -> pd.DataFrame:
        bx, by = np.unique(pdf["bx"], return_inverse=True)[1], np.unique(pdf["by"], return_inverse=True)[1]
        m = np.zeros((bx.max() + 1, by.max() + 1))
        m[bx, by] = pdf["n"]
        upto = np.vstack([np.zeros(m.shape[1]), m.cumsum(0)[:-1]])
        less = np.c_[np.zeros(len(m)), upto.cumsum(1)[:, :-1]]
        more = upto.sum(1, keepdims=True) - upto.cumsum(1)
        return result(pdf, float((m * (less - more)).sum()))

    # a range of one value has no pair in order
    split = rows.groupBy(*keys, "bx").agg((F.min("x") < F.max("x")).alias("some")).filter("some").drop("some")
    inside = rows.join(split, [*keys, "bx"], "left_semi").groupBy(*keys, "bx").applyInPandas(lambda pdf: result(pdf, all_pairs(pdf)), schema)
    split = rows.groupBy(*keys, "by").agg(((F.min("y") < F.max("y")) & (F.min("bx") < F.max("bx"))).alias("some")).filter("some").drop("some")
    beside = rows.join(split, [*keys, "by"], "left_semi").groupBy(*keys, "by").applyInPandas(across, schema)
    rest = rows.groupBy(*keys, "bx", "by").agg(F.sum("w").alias("n")).groupBy(*keys).applyInPandas(between, schema)
    s = inside.unionByName(beside).unionByName(rest).groupBy(*keys).agg(F.sum("s").alias("s"))

    def ties(c: str) -> DataFrame:
        t = F.col("t")
        return rows.groupBy(*keys, c).agg(F.sum("w").cast("double").alias("t")).groupBy(*keys).agg(
            F.sum(t).alias(f"n{c}"), F.sum(t * (t - 1)).alias(f"a{c}"), F.sum(t * (t - 1) * (t - 2)).alias(f"b{c}"), F.sum(t * (t - 1) * (2 * t + 5)).alias(f"v{c}")
        )

    both = s.join(ties("x"), keys).join(ties("y"), keys)
    n = F.col("nx")
    pairs = n * (n - 1)
    some = lambda c: F.nullif(c, F.lit(0.0))
    tau = F.col("s") / some(F.sqrt((pairs - F.col("ax")) * (pairs - F.col("ay"))) / 2)
    var = (pairs * (2 * n + 5) - F.col("vx") - F.col("vy")) / 18 + F.col("ax") * F.col("ay") / some(2 * pairs) + F.coalesce(F.col("bx") * F.col("by") / some(9 * pairs * (n - 2)), F.lit(0.0))
    return both.select(*keys, tau.alias("stat"), F.when(tau.isNotNull(), normal_p(F.col("s") / some(F.sqrt(var)))).alias("pval"))
