"""Descriptive tables per program, target and condition. Tables drop zeros, so means divide by cells, not rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sparkloom.operators.ranking import top_k
from sparkloom.operators.recode import cp10k


def ordered_join(rank: str, value: str, sep: str = ", ") -> Column:
    """Aggregate: values joined in the order of ``rank``."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(value).cast("string").alias("v"))))
    return F.array_join(F.transform(pairs, lambda x: x["v"]), sep)


def mean_by_condition(usage: DataFrame, cells: DataFrame) -> DataFrame:
    """Mean score per program and condition over all its cells."""
    n = cells.groupBy("condition").agg(F.count("*").alias("n"))
    return usage.join(cells, "cell_id").groupBy("program", "condition").agg(F.sum("score").alias("s")).join(n, "condition").select("program", "condition", (F.col("s") / F.col("n")).alias("mean"))


def fraction_above_mean(usage: DataFrame, cells: DataFrame) -> DataFrame:
    """Share of the rows of a program and condition above their own mean."""
    rows = usage.join(cells, "cell_id").withColumn("_m", F.avg("score").over(W.partitionBy("program", "condition")))
    return rows.groupBy("program", "condition").agg(F.avg((F.col("score") > F.col("_m")).cast("double")).alias("fraction"))


def dot_plot(values: DataFrame, cells: DataFrame, feature: str, value: str) -> DataFrame:
    """Mean and share above 0 per feature and condition; cells without a row count as 0."""
    n = cells.groupBy("condition").agg(F.count("*").alias("n"))
    s = values.join(cells, "cell_id").groupBy(feature, "condition").agg(F.sum(value).alias("s"), F.count_if(F.col(value) > 0).alias("p"))
    return s.join(n, "condition").select(feature, "condition", (F.col("s") / F.col("n")).alias("mean"), (F.col("p") / F.col("n")).alias("fraction"))


def cells_per_target(assignment: DataFrame, guides: DataFrame, cells: DataFrame, conditions: list[str]) -> DataFrame:
    """Assigned guides per target, a column per condition; a cell with two guides of a target counts twice."""
    rows = assignment.join(guides, "guide_name").join(cells, "cell_id")
    return rows.groupBy("target").pivot("condition", conditions).agg(F.sum("n")).fillna(0, conditions)


def knockdown(expr: DataFrame, cells: DataFrame, assignment: DataFrame, guides: DataFrame, gene_of: DataFrame, control: str) -> DataFrame:
    """(1 - mean of perturbed / mean of control cells) * 100 of each target's own gene, per condition.

    gene_of: target, gene_id. Null without perturbed cells or with a control mean of 0.
    Adds the mean over conditions with a value.
    """
    own = cp10k(expr).join(gene_of, "gene_id").select("cell_id", "target", "norm")
    labels = assignment.filter("n > 0").join(guides, "guide_name").select("cell_id", "target").distinct()
    where = cells.select("cell_id", "condition")
    count = labels.join(where, "cell_id").groupBy("target", "condition").agg(F.count("*").alias("n"))
    total = own.join(labels, ["cell_id", "target"]).join(where, "cell_id").groupBy("target", "condition").agg(F.sum("norm").alias("s"))
    base_cells = labels.filter(F.col("target") == control).select("cell_id")
    base_n = base_cells.join(where, "cell_id").groupBy("condition").agg(F.count("*").alias("n0"))
    base = own.join(base_cells, "cell_id").join(where, "cell_id").groupBy("target", "condition").agg(F.sum("norm").alias("s0"))
    grid = gene_of.select("target").distinct().crossJoin(cells.select("condition").distinct())
    out = grid.join(count, ["target", "condition"], "left").join(total, ["target", "condition"], "left").join(base, ["target", "condition"], "left").join(base_n, "condition", "left")
    pert = F.coalesce("s", F.lit(0.0)) / F.col("n")
    ctrl = F.coalesce(F.coalesce("s0", F.lit(0.0)) / F.col("n0"), F.lit(0.0))
    kd = F.when((ctrl > 0) & F.col("n").isNotNull(), (1 - pert / F.when(ctrl > 0, ctrl)) * 100)
    return out.select("target", "condition", kd.alias("kd")).withColumn("mean_kd", F.avg("kd").over(W.partitionBy("target")))


def relative_to_control(scores: DataFrame, labels: DataFrame, cells: DataFrame, control: str) -> DataFrame:
    """Per target, program and condition, and for all conditions together: mean over the control's mean, standard error (population deviation), n."""
    rows = scores.join(labels, "cell_id").join(cells.select("cell_id", "condition"), "cell_id")
    rows = rows.select("target", "program", "score", F.explode(F.array(F.col("condition"), F.lit("All"))).alias("condition"))
    s = rows.groupBy("target", "program", "condition").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("sd"), F.count("*").alias("n"))
    base = s.filter(F.col("target") == control).select("program", "condition", F.col("mean").alias("base"))
    return s.join(base, ["program", "condition"]).select("target", "program", "condition", (F.col("mean") / F.col("base")).alias("relative"), (F.col("sd") / F.sqrt("n") / F.col("base")).alias("sem"), "n")


def contingency(values: DataFrame, labels: DataFrame, control: str, value: str = "score") -> DataFrame:
    """Per target and program: treated and control cells, zero and positive."""
    rows = labels.join(values, "cell_id")
    s = rows.groupBy("target", "program").agg(F.count_if(F.col(value) > 0).alias("positive"), F.count_if(F.col(value) <= 0).alias("stored_zero"))
    n = labels.groupBy("target").agg(F.count("*").alias("n"))
    s = s.join(n, "target").withColumn("zero", F.col("n") - F.col("positive"))
    c = s.filter(F.col("target") == control).select("program", F.col("positive").alias("control_positive"), F.col("zero").alias("control_zero"))
    return s.filter(F.col("target") != control).join(c, "program").select("target", "program", F.col("positive").alias("treated_positive"), F.col("zero").alias("treated_zero"), "control_positive", "control_zero")


def regulators_by_sign(assoc: DataFrame, bound: float = 0.05) -> DataFrame:
    hits = assoc.filter(F.col("adj_pval") <= bound)
    return hits.groupBy("program_name", "sample").agg(F.count_if(F.col("log2FC") > 0).alias("positive"), F.count_if(F.col("log2FC") < 0).alias("negative"))


def significant_programs(assoc: DataFrame, samples: list[str], bound: float = 0.05) -> DataFrame:
    """Per target the significant programs of each sample as text, and their number; '' and 0 without any."""
    hits = assoc.filter(F.col("adj_pval") < bound)
    lists = hits.groupBy("target_name").pivot("sample", samples).agg(F.array_join(F.array_sort(F.collect_list("program_name")), ", ").alias("programs"), F.count(F.lit(1)).alias("n"))
    return lists.fillna("").fillna(0)


def regulator_heatmap(assoc: DataFrame, expression: DataFrame | None = None, bound: float = 0.05) -> DataFrame:
    """Rows of regulators significant in some sample, with a flag; with mean expression (target_name, sample, mean) the effect scaled by mean over the largest mean."""
    hits = assoc.filter(F.col("adj_pval") < bound).select("target_name", "program_name").distinct()
    rows = assoc.join(hits, ["target_name", "program_name"], "left_semi").withColumn("hit", F.col("adj_pval") < bound)
    if expression is None:
        return rows
    top = F.max("mean").over(W.partitionBy("program_name"))
    rows = rows.join(expression, ["target_name", "sample"], "left").fillna(0.0, ["mean"])
    return rows.withColumn("scaled", F.col("log2FC") * F.col("mean") / F.when(top > 0, top).otherwise(1.0))


def extremes(df: DataFrame, key: str, name: str, value: str, n: int) -> DataFrame:
    """The n largest and the n smallest rows of each key, each once."""
    up = F.row_number().over(W.partitionBy(key).orderBy(F.desc(value), name))
    down = F.row_number().over(W.partitionBy(key).orderBy(F.asc(value), name))
    return df.withColumn("top", up).withColumn("bottom", down).filter((F.col("top") <= n) | (F.col("bottom") <= n))


def top_terms(df: DataFrame, key: str, term: str, p: str, n: int) -> DataFrame:
    return top_k(df, [key], [F.asc(p), F.asc(term)], n).withColumn("neg_log10_p", -F.log10(F.greatest(F.col(p), F.lit(1e-300))))


def top_of_unique(df: DataFrame, key: str, name: str, value: str, k: int) -> DataFrame:
    """Top k names of each key; a repeated name, or a key with fewer than k, is an error."""
    bad = df.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(name).alias("d")).filter((F.col("n") != F.col("d")) | (F.col("n") < k)).limit(3).collect()
    if bad:
        raise ValueError(f"repeated names, or fewer than {k}: {[r[0] for r in bad]}")
    return top_k(df, [key], [F.desc(value), F.asc(name)], k)


def robust_z(assoc: DataFrame, value: str = "log2FC") -> DataFrame:
    """Per sample and target, (x - median) / (1.4826 MAD + 1e-10) over programs."""
    keys = ["sample", "target_name"]
    med = assoc.groupBy(*keys).agg(F.median(value).alias("_med"))
    rows = assoc.join(med, keys)
    mad = rows.groupBy(*keys).agg(F.median(F.abs(F.col(value) - F.col("_med"))).alias("_mad"))
    return rows.join(mad, keys).withColumn("z", (F.col(value) - F.col("_med")) / (1.4826 * F.col("_mad") + 1e-10)).drop("_med", "_mad")


def specificity(assoc: DataFrame, temperature: float = 0.5, value: str = "log2FC") -> DataFrame:
    """Adds z, weight, joint, p_target, p_program and pmi.

    weight: exp of |z| / T less the target's largest, over the sum of the whole sample (row
    maximum, global sum). joint: its share, with the marginals and the pointwise mutual
    information, both with 1e-10 added.
    """
    a = F.abs("z") / temperature
    rows = robust_z(assoc, value)
    peak = rows.groupBy("sample", "target_name").agg(F.max(a).alias("_peak"))
    rows = rows.join(peak, ["sample", "target_name"]).withColumn("_e", F.exp(a - F.col("_peak"))).drop("_peak")
    total = rows.groupBy("sample").agg(F.sum("_e").alias("_total"))
    rows = rows.join(total, "sample").withColumn("weight", F.col("_e") / F.col("_total")).drop("_e", "_total")
    p_t = rows.groupBy("sample", "target_name").agg(F.sum("weight").alias("p_target"))
    p_p = rows.groupBy("sample", "program_name").agg(F.sum("weight").alias("p_program"))
    rows = rows.join(p_t, ["sample", "target_name"]).join(p_p, ["sample", "program_name"])
    return rows.withColumn("pmi", F.log((F.col("weight") + 1e-10) / (F.col("p_target") * F.col("p_program") + 1e-10)))


def top_specific(scored: DataFrame, key: str, name: str, n: int = 5, bound: float = 0.1) -> DataFrame:
    """Significant pairs of highest pmi per sample and key, as text of names and of scores with four digits."""
    best = top_k(scored.filter(F.col("adj_pval") < bound), ["sample", key], [F.desc("pmi"), F.asc(name)], n)
    best = best.withColumn("_s", F.format_string("%.4f", "pmi"))
    return best.groupBy("sample", key).agg(ordered_join("rank", name).alias("names"), ordered_join("rank", "_s").alias("scores"))


def fold(key: str, parts: list[DataFrame]) -> DataFrame:
    """Full outer join of tables on a text key; missing texts become ''."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, key, "full")
    return out.fillna("")
