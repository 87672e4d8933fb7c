"""Gene-set enrichment of program loadings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sparkloom.functions.special import log_gamma
from sparkloom.operators.ranking import benjamini_hochberg, top_k


def uniqueness(loading: DataFrame) -> DataFrame:
    """Adds score * ln((P + 1) / (programs with the gene + 1)); null rows are dropped, an existing column stays."""
    if "uniqueness" in loading.columns:
        return loading
    rows = loading.filter("score IS NOT NULL AND gene_id IS NOT NULL AND program IS NOT NULL")
    p = rows.agg(F.count_distinct("program").alias("_p"))
    n = rows.groupBy("gene_id").agg(F.count_distinct("program").alias("_n"))
    return rows.join(n, "gene_id").crossJoin(p).withColumn("uniqueness", F.col("score") * F.log((F.col("_p") + 1) / (F.col("_n") + 1))).drop("_p", "_n")


def fisher(loading: DataFrame, sets: DataFrame, n_top: int = 500, expressed_only: bool = False) -> DataFrame:
    """Over-representation of each program's top genes in every set that they meet.

    sets: term, gene_id. Background: all genes of the sets, or those with a loading too.
    program, term, overlap, set_size, pval (hypergeometric upper tail), odds_ratio (with 0.5
    added to each count), combined_score (-ln p * odds ratio), adj_pval (BH per program), genes.
    """
    sets = sets.select("term", "gene_id").distinct()
    background = sets.select("gene_id").distinct()
    if expressed_only:
        background = background.join(loading.select("gene_id").distinct(), "gene_id", "left_semi")
    sets = sets.join(background, "gene_id", "left_semi")
    top = top_k(loading, ["program"], [F.desc("score"), F.asc("gene_id")], n_top).join(background, "gene_id", "left_semi")
    size = sets.groupBy("term").agg(F.count("*").alias("set_size"))
    drawn = top.groupBy("program").agg(F.count("*").alias("drawn"))
    hits = top.join(sets, "gene_id").groupBy("program", "term").agg(F.count("*").alias("overlap"), F.array_sort(F.collect_list("gene_id")).alias("genes"))
    rows = hits.join(size, "term").join(drawn, "program").crossJoin(F.broadcast(background.agg(F.count("*").alias("total"))))
    choose = lambda n, k: log_gamma((n + 1).cast("double")) - log_gamma((k + 1).cast("double")) - log_gamma((n - k + 1).cast("double"))
    k = F.explode(F.sequence(F.col("overlap"), F.least("set_size", "drawn"))).alias("k")
    tail = rows.select("program", "term", "set_size", "drawn", "total", k).filter(F.col("drawn") - F.col("k") <= F.col("total") - F.col("set_size"))
    log_p = choose(F.col("set_size"), F.col("k")) + choose(F.col("total") - F.col("set_size"), F.col("drawn") - F.col("k")) - choose(F.col("total"), F.col("drawn"))
    p = tail.withColumn("_l", log_p).groupBy("program", "term").agg(F.least(F.lit(1.0), F.sum(F.exp("_l"))).alias("pval"))
    a = F.col("overlap") + 0.5
    b, c = F.col("set_size") - F.col("overlap") + 0.5, F.col("drawn") - F.col("overlap") + 0.5
    d = F.col("total") - F.col("set_size") - F.col("drawn") + F.col("overlap") + 0.5
    out = rows.join(p, ["program", "term"]).withColumn("odds_ratio", a * d / (b * c)).withColumn("combined_score", -F.log("pval") * F.col("odds_ratio"))
    return benjamini_hochberg(out, ["program"], "pval", "adj_pval", ["term"]).select("program", "term", "overlap", "set_size", "pval", "adj_pval", "odds_ratio", "combined_score", "genes")


def running_scores(loading: DataFrame, sets: DataFrame, low: float | None = None, n_top: int | None = None, least: int = 15, most: int = 500) -> DataFrame:
    """Enrichment score of every program and set with least ... most ranked genes.

    The running sum rises by |loading| over the set's total at a hit and falls by 1 / misses
    otherwise, so its extremes lie at hits: its value after hit j at rank r is the share of
    weight so far less (r - j) / misses, and before it that without the hit's own weight. Of equal extremes the first is the peak.
    """
    rows = loading if low is None else loading.filter(F.col("score") > low)
    order = W.partitionBy("program").orderBy(F.desc("score"), F.asc("gene_id"))
    rows = rows.withColumn("r", F.row_number().over(order))
    rows = rows if n_top is None else rows.filter(F.col("r") <= n_top)
    n = rows.groupBy("program").agg(F.count("*").alias("n"))
    hits = rows.join(sets.select("term", "gene_id").distinct(), "gene_id").withColumn("w", F.abs("score"))
    own = W.partitionBy("program", "term")
    upto = own.orderBy("r").rowsBetween(W.unboundedPreceding, W.currentRow)
    hits = hits.withColumn("j", F.count("*").over(upto)).withColumn("m", F.count("*").over(own)).withColumn("total", F.sum("w").over(own)).withColumn("sofar", F.sum("w").over(upto))
    hits = hits.filter((F.col("m") >= least) & (F.col("m") <= most) & (F.col("total") > 0)).join(n, "program").filter("n > m")
    miss = (F.col("r") - F.col("j")) / (F.col("n") - F.col("m"))
    hits = hits.withColumn("after", F.col("sofar") / F.col("total") - miss).withColumn("before", (F.col("sofar") - F.col("w")) / F.col("total") - miss)
    s = hits.groupBy("program", "term").agg(F.max("after").alias("hi"), F.min("before").alias("lo"), F.max_by("r", F.struct("after", -F.col("r"))).alias("peak_hi"), F.min_by("r", F.struct("before", "r")).alias("peak_lo"), F.first("m").alias("matched"), F.first("n").alias("n"))
    up = F.col("hi") >= -F.col("lo")
    return s.select("program", "term", "matched", "n", F.when(up, F.col("hi")).otherwise(F.col("lo")).alias("es"), F.when(up, F.col("peak_hi")).otherwise(F.col("peak_lo")).alias("peak"))


def judge(observed: pd.DataFrame, size: np.ndarray, null: np.ndarray) -> pd.DataFrame:
    """nes, pval, fdr and fwer of one program's sets (Subramanian et al. 2005).

    observed: matched, es. null: scores of random sets, a row for each of ``size`` and a column for each draw. Scores are
    divided by the mean null score of their size and sign. For a normalised score x of one sign, with only scores of that sign:
    fdr is the share of null scores, pooled over all sets, at least as far out, over the same share of observed ones;
    fwer is the share of draws whose most extreme score over all sets is at least as far out.
    """
    es, at = observed["es"].to_numpy(float), np.searchsorted(size, observed["matched"].to_numpy())
    sets = np.bincount(at, minlength=len(size)).astype(float)
    nes, pval, fdr, fwer = (np.full(len(es), np.nan) for _ in range(4))
    for sign in (1, -1):
        side = null * sign
        own = side >= 0 if sign == 1 else side > 0
        n = own.sum(1)
        mean = np.where(own, side, 0).sum(1) / np.maximum(n, 1)
        scale = np.where((n > 0) & (mean > 0), mean, np.nan)
        mine = np.flatnonzero((es >= 0) == (sign == 1))
        far = np.abs(es[mine])
        score = far / scale[at[mine]]
        nes[mine] = sign * score
        pval[mine] = [(side[k][own[k]] >= x).sum() / max(1, n[k]) for k, x in zip(at[mine], far, strict=True)]
        normal = np.where(own, side / scale[:, None], np.nan)
        pooled, weight = normal[~np.isnan(normal)], np.broadcast_to(sets[:, None], normal.shape)[~np.isnan(normal)]
        order = np.argsort(pooled)
        tail = np.r_[np.cumsum(weight[order][::-1])[::-1], 0]
        seen = np.sort(score[~np.isnan(score)])
        worst = np.sort(np.where(np.isnan(normal), -1, normal).max(0)) if normal.size else np.zeros(0)
        worst = worst[worst >= 0]
        for k, x in zip(mine.tolist(), score.tolist(), strict=True):
            if not np.isnan(x):
                of_null = tail[np.searchsorted(pooled[order], x)] / max(tail[0], 1e-300)
                of_seen = (len(seen) - np.searchsorted(seen, x)) / len(seen)
                fdr[k] = min(1.0, of_null / of_seen)
                fwer[k] = (len(worst) - np.searchsorted(worst, x)) / max(1, len(worst))
    return observed.assign(nes=nes, pval=pval, fdr=fdr, fwer=fwer)


def prerank(loading: DataFrame, sets: DataFrame, permutations: int = 1000, seed: int = 42, **options) -> DataFrame:
    """GSEA: es, nes, pval, fdr and fwer against sets of the same size drawn at random.

    A program's distinct set sizes are drawn for in one task per (program, size), with a
    generator seeded by both, so results don't depend on partitioning. One task per program then holds its sets
    and a null score for each size and draw (at most ``most`` - ``least`` + 1 sizes) and judges them: see judge().
    """
    observed = running_scores(loading, sets, **options)
    low, n_top = options.get("low"), options.get("n_top")
    rows = loading if low is None else loading.filter(F.col("score") > low)
    if n_top is not None:
        rows = top_k(rows, ["program"], [F.desc("score"), F.asc("gene_id")], n_top)
    ranked = rows.groupBy("program").agg(F.array_sort(F.collect_list(F.abs("score").alias("w")), lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0)).alias("weights"))
    sizes = observed.select("program", F.col("matched").alias("size")).distinct().join(ranked, "program")

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        program, size, w = pdf["program"].iloc[0], int(pdf["size"].iloc[0]), np.asarray(pdf["weights"].iloc[0], float)
        rng = np.random.default_rng([seed, size, *program.encode()])
        n = len(w)
        found = []
        for _ in range(permutations):
            r = np.sort(rng.choice(n, size, replace=False))
            share = np.cumsum(w[r]) / max(w[r].sum(), 1e-300)
            miss = (r - np.arange(size)) / max(1, n - size)
            hi, lo = (share - miss).max(), (np.r_[0, share[:-1]] - miss).min()
            found.append(hi if hi >= -lo else lo)
        return pd.DataFrame({"program": program, "size": size, "null": [found]})

    def decide(seen: pd.DataFrame, drawn: pd.DataFrame) -> pd.DataFrame:
        drawn = drawn.sort_values("size")
        return judge(seen, drawn["size"].to_numpy(), np.array(drawn["null"].tolist(), float))[["program", "term", "matched", "es", "nes", "pval", "fdr", "fwer", "peak"]]

    drawn = sizes.groupBy("program", "size").applyInPandas(draw, "program string, size long, null array<double>")
    kept = observed.select("program", "term", "matched", "es", "peak")
    return kept.groupBy("program").cogroup(drawn.groupBy("program")).applyInPandas(decide, "program string, term string, matched long, es double, nes double, pval double, fdr double, fwer double, peak long")


def enrich(loading: DataFrame, sets: DataFrame, method: str = "fisher", **options) -> DataFrame:
    """fisher or gsea by name."""
    known = {"fisher": fisher, "gsea": prerank}
    if method not in known:
        raise ValueError(f"{method} is not one of {sorted(known)}")
    return known[method](loading, sets, **options)
