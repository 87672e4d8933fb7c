"""The matched-cell analysis of all targets: one table per kind of result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.special import normal_p
from sparkloom.operators.calibration import balance, hurdle, match, screened_cells, weighted_ols
from sparkloom.operators.propagation import effects_with_errors
from sparkloom.operators.recode import transform_response
from sparkloom.sources.tables import written

METHODS = ("ols_log", "ols_pseudo", "hurdle")


def matched_screen(
    scores: DataFrame,
    cells: DataFrame,
    treated: DataFrame,
    control_cells: DataFrame,
    covariates: list[str],
    methods: tuple[str, ...] = METHODS,
    loading: DataFrame | None = None,
    propagate: tuple[str, ...] = ("ols_log",),
    ratio: int = 4,
    caliper: float | None = None,
    least: int = 10,
    permutations: int = 100,
    bootstraps: int = 500,
    seed: int = 42,
    max_controls: int | None = None,
    with_genes: bool = True,
) -> dict[str, DataFrame]:
    """rates, balance, contingency, programs and, with ``loading``, genes of every target, from one matching that all methods share.

    scores: cell_id, program, score (zeros may be left out); cells: cell_id, covariates; treated: cell_id, target. Every table has
    the target as a key, so targets are no loop. rates: target, treated, controls, matched_treated, matched_controls, rate, kept; targets with fewer than
    ``least`` cells, or matched cells of either side, are listed and not kept, and aren't in other tables. balance: of each covariate,
    weighted. contingency: matched cells with and without a score. programs: target, program, method, beta, se, stat, pval, n: least squares with the covariates and
    the propensity, clustered by pair, of the transformed score; for hurdle the marginal effect. For methods in ``propagate``, standard
    errors and p-values are the bootstrap's, and genes has their effects through the loadings, corrected for bias; without with_genes, the loadings aren't read and genes is left out.
    """
    unknown = {*methods, *propagate} - {*METHODS} | {*propagate} - {"ols_log", "ols_pseudo"}
    if unknown:
        raise ValueError(f"no such method: {sorted(unknown)}")
    rows = written(screened_cells(cells, treated, covariates, control_cells, least, seed, max_controls), "screen-cells")
    matched = match(rows, ["target"], covariates, ratio, caliper, seed, max_controls)
    sides = lambda df, prefix: df.groupBy("target").agg(F.count_if(F.col("treated") == 1).alias(f"{prefix}treated"), F.count_if(F.col("treated") == 0).alias(f"{prefix}controls"))
    every = treated.join(cells.select("cell_id"), "cell_id", "left_semi").groupBy("target").agg(F.count("*").alias("treated"))
    # controls are counted before they are thinned
    pool = control_cells.join(cells.select("cell_id"), "cell_id")
    own = treated.join(pool, "cell_id").groupBy("target").agg(F.count("*").alias("_own"))
    free = F.when(F.col("treated") >= least, F.col("_pool") - F.coalesce("_own", F.lit(0))).otherwise(0)
    rates = every.crossJoin(pool.agg(F.count("*").alias("_pool"))).join(own, "target", "left").withColumn("controls", free).drop("_pool", "_own")
    rates = rates.join(sides(matched, "matched_"), "target", "left").fillna(0, ["matched_treated", "matched_controls"])
    kept = F.least("matched_treated", "matched_controls") >= least
    rates = written(rates.select("target", "treated", "controls", "matched_treated", "matched_controls", (F.col("matched_treated") / F.col("treated")).alias("rate"), kept.alias("kept")), "screen-rates")
    full = matched.join(rates.filter("kept").select("target"), "target", "left_semi").join(cells.select("cell_id", *covariates), "cell_id")
    full = written(full, "screen-full")
    programs = scores.select("program").distinct()
    values = written(full.crossJoin(programs).join(scores.select("cell_id", "program", "score"), ["cell_id", "program"], "left").withColumn("score", F.coalesce("score", F.lit(0.0))), "screen-values")
    count = lambda side, some: F.count_if((F.col("treated") == side) & ((F.col("score") > 0) == some))
    contingency = values.groupBy("target", "program").agg(count(1, True).alias("treated_positive"), count(1, False).alias("treated_zero"), count(0, True).alias("control_positive"), count(0, False).alias("control_zero"))

    adjusted, keys, found = [*covariates, "propensity"], ["target", "program"], []
    columns = ["target", "program", "method", "beta", "se", "stat", "pval", "n"]
    if "hurdle" in methods:
        n = values.groupBy(*keys).agg(F.count("*").alias("n"))
        two = hurdle(values, keys, "score", adjusted).join(n, keys)
        found.append(two.withColumn("stat", F.col("ame") / F.nullif("se", F.lit(0.0))).withColumn("method", F.lit("hurdle")).withColumnRenamed("ame", "beta").select(*columns))
    genes = None
    for method in (m for m in ("ols_log", "ols_pseudo") if m in methods):
        transformed = transform_response(values, keys, "score", method)
        fit = weighted_ols(transformed, keys, "transformed", adjusted).withColumn("method", F.lit(method))
        if method in propagate and loading is not None:
            of_programs, of_genes = effects_with_errors(scores, loading if with_genes else None, full, ["target"], adjusted, method.removeprefix("ols_"), permutations, bootstraps, seed)
            drawn = of_programs.select(*keys, F.col("se").alias("_se"))
            fit = fit.join(drawn, keys).withColumn("se", F.col("_se")).drop("_se").withColumn("stat", F.col("beta") / F.nullif("se", F.lit(0.0)))
            fit = fit.withColumn("pval", normal_p("stat"))
            if of_genes is not None:
                of_genes = of_genes.withColumn("method", F.lit(method))
                genes = of_genes if genes is None else genes.unionByName(of_genes)
        found.append(fit.select(*columns))
    out = {"rates": rates, "balance": balance(full, ["target"], covariates, weight="weight"), "contingency": contingency}
    if found:
        programs_out = found[0]
        for f in found[1:]:
            programs_out = programs_out.unionByName(f)
        out["programs"] = programs_out
    return out if genes is None else out | {"genes": genes}
