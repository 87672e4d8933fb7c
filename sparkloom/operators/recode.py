"""Recoding, filtering and validation of screen tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Accepted names of the standard columns, in order of preference.
ALIASES = {
    "Name": ["name", "gene", "gene_name", "genename", "symbol"],
    "Score": ["score", "loading", "weight", "value"],
    "program_id": ["program_id", "program", "program_name", "topic", "topic_id", "rowid"],
    "cell_type": ["cell_type", "celltype", "cluster"],
    "log2_fc_in_vs_out": ["log2_fc_in_vs_out", "log2fc", "log2_fc", "logfc", "lfc"],
    "fdr": ["fdr", "adj_pval", "padj", "qval", "fdr_value"],
    "regulator": ["regulator", "target_name", "target", "grna_target", "gene_name"],
    "p_value": ["p_value", "pval", "pvalue", "p"],
    "significant": ["significant", "is_significant", "sig"],
}
#: Texts read as true and as false.
TRUE, FALSE = ["true", "t", "1", "yes", "y"], ["false", "f", "0", "no", "n", "nan", "none", ""]
#: Bounds of fold-change bands, and the region excluded on chromosome 6.
BANDS = {"highly": 3.0, "moderately": 1.5, "weakly": 0.5, "depleted": -0.5}
MHC = ("6", 28510120, 33480577)
#: Fixed value: wording of traits that are left out, case-sensitive.
EXCLUDED_TRAITS = r" or |conditional| and | x |pleiotropy|interaction|eg:|EA|intake| ms\]|protein quantitative|adjusted for|diet"


def resolve_columns(df: DataFrame, wanted: list[str], required: bool = True, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Renames columns to standard names by their aliases, without regard to case or spaces; a missing required one is an error."""
    present = {c.lower().strip().replace(" ", "_"): c for c in reversed(df.columns)}
    renames = {}
    for name in wanted:
        found = next((present[a] for a in [name.lower(), *(aliases or ALIASES).get(name, [])] if a in present), None)
        if found is None and required:
            raise ValueError(f"no column for {name}; there are {df.columns}")
        if found is not None:
            renames[found] = name
    return df.withColumnsRenamed(renames)


def parse_program(c: Column) -> Column:
    """A number, or one behind program, topic, p or x, else null."""
    text = F.trim(c.cast("string"))
    return F.coalesce(text.try_cast("int"), F.regexp_extract(text, r"(?i)^(?:program|topic|p|x)_?(\d+)$", 1).try_cast("int"))


def to_boolean(c: Column) -> Column:
    text = F.lower(F.trim(c.cast("string")))
    number = text.try_cast("double")
    return F.when(text.isin(TRUE), True).when(text.isin(FALSE) | text.isNull(), False).otherwise(F.coalesce(~F.isnan(number) & (number != 0), F.lit(False)))


def rename_by_dictionary(df: DataFrame, column: str, dictionary: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """Ids become their symbols and stay where there is none; of repeated keys the last by ``order`` counts."""
    latest = dictionary.groupBy(F.col(key).alias("_k")).agg(F.max_by(value, order or value).alias("_v"))
    return df.join(latest, F.col(column) == F.col("_k"), "left").withColumn(column, F.coalesce(F.col("_v").cast("string"), F.col(column).cast("string"))).drop("_k", "_v")


def convert_ids(ids: DataFrame, column: str, order: str, dictionary: DataFrame, key: str, value: str) -> DataFrame:
    """Ids by one of three rules: the first id starts with ens: look-up, else upper case; any holds ':ens': the part before ':' in upper case; else upper case."""
    flags = ids.agg(F.min_by(F.lower(column).startswith("ens"), order).alias("_first"), F.bool_or(F.lower(column).contains(":ens")).alias("_any"))
    known = dictionary.groupBy(F.upper(key).alias("_k")).agg(F.max(value).alias("_v"))
    out = ids.crossJoin(flags).join(known, F.upper(column) == F.col("_k"), "left")
    split = F.when(F.col("_any"), F.upper(F.split_part(F.col(column), F.lit(":"), F.lit(1)))).otherwise(F.upper(column))
    return out.withColumn("converted", F.when(F.col("_first"), F.coalesce("_v", F.upper(column))).otherwise(split)).drop("_first", "_any", "_k", "_v")


def best_hit(queries: DataFrame, hits: DataFrame, key: str, score: str, value: str, missing: str = "NOT FOUND") -> DataFrame:
    """The hit of highest score of each query; ties go to the smaller value; ``missing`` without one."""
    best = hits.groupBy(key).agg(F.min_by(value, F.struct(-F.col(score), F.col(value))).alias(value), F.max(score).alias(score))
    return queries.select(key).distinct().join(best, key, "left").withColumn(value, F.coalesce(F.col(value).cast("string"), F.lit(missing)))


def without_prefix(df: DataFrame, column: str, prefix: str = "ENSG") -> DataFrame:
    return df.filter(F.col(column).isNull() | ~F.col(column).startswith(prefix))


def significant(df: DataFrame, bound: float = 0.05, inclusive: bool = False, column: str = "adj_pval") -> DataFrame:
    return df.filter(F.col(column) <= bound if inclusive else F.col(column) < bound)


def standardise_regulators(df: DataFrame, bound: float = 0.05) -> DataFrame:
    """regulator, program_id, log2FC, p, significant: an explicit flag, else adjusted p, else p at most ``bound``. Rows that don't parse are an error."""
    df = resolve_columns(df, ["regulator", "program_id"])
    df = resolve_columns(df, ["log2_fc_in_vs_out", "fdr", "p_value", "significant"], required=False)
    out = df.withColumn("program_id", parse_program(F.col("program_id"))).withColumn("log2FC", F.col("log2_fc_in_vs_out").try_cast("double"))
    adjusted = F.col("fdr") if "fdr" in out.columns else F.lit(None).cast("double")
    raw = F.col("p_value") if "p_value" in out.columns else F.lit(None).cast("double")
    flag = to_boolean(F.col("significant")) if "significant" in out.columns else F.coalesce(adjusted <= bound, raw <= bound, F.lit(False))
    ok = F.col("program_id").isNotNull() & F.col("log2FC").isNotNull()
    checked = F.when(ok, F.col("program_id")).otherwise(F.raise_error(F.lit("a program or an effect can't be read")).cast("int"))
    return out.select("regulator", checked.alias("program_id"), "log2FC", F.coalesce(raw, adjusted).alias("p"), flag.alias("significant"))


def clean_traits(df: DataFrame) -> DataFrame:
    """Quality filters of trait rows: at most 2 commas in trait_efos, no excluded wording or category, cases fall back to n_initial, the largest studies of each trait (ties stay), the excluded region."""
    rows = df.withColumn("trait", F.replace("trait", F.lit('"'), F.lit(""))).filter(F.length(F.regexp_replace("trait_efos", "[^,]", "")) <= 2)
    rows = rows.filter(~F.col("trait").rlike(EXCLUDED_TRAITS) & (F.col("category") != "Uncategorised")).withColumn("n_cases", F.coalesce("n_cases", "n_initial"))
    rows = rows.withColumn("_r", F.rank().over(W.partitionBy("trait").orderBy(F.desc("n_cases")))).filter("_r = 1").drop("_r")
    return rows.filter(~((F.col("chrom") == MHC[0]) & F.col("pos").between(MHC[1], MHC[2])))


def flatten_elements(c: Column) -> Column:
    """'element' values of a nested list in text, sorted and joined; the text is read, never run."""
    return F.array_join(F.array_sort(F.regexp_extract_all(c, F.lit(r"'element': '([^']+)'"), F.lit(1))), ", ")


def repair_p(df: DataFrame, p: str, out: str = "neg_log10_p") -> DataFrame:
    """p of 0 becomes the smallest positive p of the table; adds |-log10 p|."""
    least = df.filter(F.col(p) > 0).agg(F.min(p).alias("_least"))
    df = df.crossJoin(least).withColumn(p, F.when(F.col(p) == 0, F.col("_least")).otherwise(F.col(p))).drop("_least")
    return df.withColumn(out, F.abs(-F.log10(p)))


def first_items(c: Column, n: int, sep: str = ";") -> Column:
    return F.array_join(F.slice(F.split(c, sep), 1, n), sep)


def band(fold: Column) -> Column:
    """Band of a log2 fold change; null between depleted and weak."""
    return F.when(fold >= BANDS["highly"], "highly").when(fold >= BANDS["moderately"], "moderately").when(fold >= BANDS["weakly"], "weakly").when(fold <= BANDS["depleted"], "depleted")


def bands_by_program(df: DataFrame, program: str, member: str, fold: str, fdr: str, bound: float = 0.05) -> DataFrame:
    """Members of each band as sorted '|' lists, '' without any; programs without a hit stay."""
    hits = df.filter(F.col(fdr) < bound).withColumn("_band", band(F.col(fold))).filter("_band IS NOT NULL")
    lists = [F.array_join(F.array_sort(F.collect_set(F.when(F.col("_band") == b, F.col(member)))), "|").alias(b) for b in BANDS]
    return df.select(program).distinct().join(hits.groupBy(program).agg(*lists), program, "left").fillna("", list(BANDS))


def validate_cell_types(df: DataFrame, program: str, cell_type: str, fold: str, fdr: str, least_programs: int = 10, least_types: int = 3) -> DataFrame:
    """Report (finding, n) of problems, one pass over the table."""
    f, q = F.col(fold).try_cast("double"), F.col(fdr).try_cast("double")
    row = df.agg(
        F.count_if(F.col(cell_type).isNull() | (F.trim(cell_type) == "")).alias("empty cell types"),
        F.count_if(parse_program(F.col(program)).isNull()).alias("unreadable programs"),
        F.count_if(f.isNull()).alias("non-numeric fold changes"),
        F.count_if(q.isNull()).alias("non-numeric FDR"),
        F.count_if((q < 0) | (q > 1)).alias("FDR out of range"),
        F.when(F.count_distinct(program) < least_programs, 1).otherwise(0).cast("long").alias("few programs"),
        F.when(F.count_distinct(cell_type) < least_types, 1).otherwise(0).cast("long").alias("few cell types"),
    )
    return row.unpivot([], row.columns, "finding", "n").filter("n > 0")


def missing_keys(left: DataFrame, right: DataFrame, key: str, check: str) -> DataFrame:
    """One row: check, n missing from right, the first five of them."""
    gone = left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")
    return gone.agg(F.lit(check).alias("check"), F.count("*").alias("n"), F.slice(F.array_sort(F.collect_list(F.col(key).cast("string"))), 1, 5).alias("examples"))


def validate_screen(assignment: DataFrame, guides: DataFrame, cells: DataFrame, genes: DataFrame | None = None) -> DataFrame:
    """Report of assigned guides without annotation, guides without cells, cells without guides, and targets that are no gene."""
    report = missing_keys(assignment, guides, "guide_name", "assigned guides without target")
    report = report.unionByName(missing_keys(guides, assignment, "guide_name", "guides without cells"))
    report = report.unionByName(missing_keys(cells, assignment, "cell_id", "cells without guides"))
    return report if genes is None else report.unionByName(missing_keys(guides, genes, "target", "targets that are no gene"))


def program_consistency(results: dict[str, DataFrame], programs: DataFrame) -> DataFrame:
    """Per result: programs only there, and programs of the screen that it lacks."""
    every = None
    base = programs.select(F.col("program").cast("string").alias("program")).distinct().withColumn("here", F.lit(True))
    for name, df in results.items():
        own = df.select(F.col("program_name").cast("string").alias("program")).distinct().withColumn("there", F.lit(True))
        row = own.join(base, "program", "full").agg(F.lit(name).alias("result"), F.count_if(F.col("here").isNull()).alias("unknown"), F.count_if(F.col("there").isNull()).alias("missing"))
        every = row if every is None else every.unionByName(row)
    return every


def volcano(df: DataFrame, p: str = "adj_pval", fold: str = "log2FC", low: float = -0.1, high: float = 0.1, bound: float = 0.05) -> DataFrame:
    """Adds class (up, down, ns) and -log10 of p, which is at least 1e-300."""
    hit = F.col(p) <= bound
    kind = F.when(hit & (F.col(fold) >= high), "up").when(hit & (F.col(fold) <= low), "down").otherwise("ns")
    return df.withColumn("class", kind).withColumn("neg_log10_p", -F.log10(F.greatest(F.col(p), F.lit(1e-300))))


def report_volcano(df: DataFrame, program: str, name: str, p: str, fold: str) -> DataFrame:
    """Rounded volcano points per program, by name; p of 0 counts as 1e-300, at most 300."""
    height = F.least(F.lit(300.0), -F.log10(F.when(F.col(p) == 0, 1e-300).otherwise(F.col(p))))
    point = F.struct(F.col(name).alias("name"), F.round(fold, 3).alias("x"), F.round(height, 3).alias("y"))
    return df.groupBy(program).agg(F.array_sort(F.collect_list(point)).alias("points"))


def cp10k(expr: DataFrame) -> DataFrame:
    """Counts per ten thousand of each cell; a cell without counts divides by 1."""
    total = expr.groupBy("cell_id").agg(F.sum("count").alias("_t"))
    share = F.col("count") / F.when(F.col("_t") == 0, 1.0).otherwise(F.col("_t")) * 1e4
    return expr.join(total, "cell_id").withColumn("norm", share).drop("_t")


def floored_composition(usage: DataFrame, floor: float = 1e-8) -> DataFrame:
    """Scores of all cells and programs, missing ones 0, raised to ``floor`` and divided by the cell's sum, with the centred log ratio."""
    grid = usage.select("cell_id").distinct().crossJoin(usage.select("program").distinct())
    full = grid.join(usage, ["cell_id", "program"], "left").withColumn("u", F.greatest(F.coalesce("score", F.lit(0.0)), F.lit(floor)))
    cell = W.partitionBy("cell_id")
    share = full.withColumn("share", F.col("u") / F.sum("u").over(cell))
    return share.withColumn("clr", F.log("share") - F.avg(F.log("share")).over(cell)).select("cell_id", "program", "share", "clr")


def winsorise(df: DataFrame, keys: list[str], value: str, q: float = 0.99) -> DataFrame:
    """Caps non-zero values at a percentile of the non-zero ones of the group."""
    top = df.filter(F.col(value) != 0).groupBy(*keys).agg(F.percentile(value, F.lit(q)).alias("_top"))
    return df.join(top, keys, "left").withColumn("capped", F.when(F.col(value) != 0, F.least(value, "_top")).otherwise(F.col(value))).drop("_top")


#: Response transforms by name, as functions of the value and the pseudo-count; and their inverses.
TRANSFORMS = {
    "ols_log": (lambda y, _: F.log1p(y * 1e6), lambda t, _: F.expm1(t) / 1e6),
    "ols_pseudo": (lambda y, pseudo: F.log(y * 1e6 + pseudo), lambda t, pseudo: (F.exp(t) - pseudo) / 1e6),
    "hurdle_marginal": (lambda y, _: F.log1p(y * 1e6), lambda t, _: F.expm1(t) / 1e6),
}


def transform_response(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Adds transformed and back, its inverse; the pseudo-count is the 5th percentile of the group's non-zero scaled values, 1 without any."""
    pseudo = df.groupBy(*keys).agg(F.coalesce(F.percentile(F.when(F.col(value) != 0, F.col(value) * 1e6), F.lit(0.05)), F.lit(1.0)).alias("_pseudo"))
    forth, back = TRANSFORMS[name]
    return df.join(pseudo, keys).withColumn("transformed", forth(F.col(value), F.col("_pseudo"))).withColumn("back", back(F.col("transformed"), F.col("_pseudo"))).drop("_pseudo")


def covariate_design(df: DataFrame, numeric: list[str], log1p: list[str] | None = None) -> DataFrame:
    """Numeric covariates, some as log1p too, z-scored by the sample deviation if they have over two values; a constant one is an error."""
    df = df.withColumns({f"log_{c}": F.log1p(c) for c in log1p or []})
    numeric = [*numeric, *(f"log_{c}" for c in log1p or [])]
    stats = df.agg(*(f(c).alias(f"_{n}_{c}") for c in numeric for n, f in (("m", F.avg), ("s", F.stddev_samp), ("d", F.count_distinct))))
    out = df.crossJoin(F.broadcast(stats))
    for c in numeric:
        d = F.col(f"_d_{c}")
        scaled = F.when(d > 2, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(F.col(c).cast("double"))
        out = out.withColumn(c, F.when(d > 1, scaled).otherwise(F.raise_error(F.lit(f"{c} is constant")).cast("double")))
    return out.drop(*(f"_{n}_{c}" for c in numeric for n in "msd"))


def dominant_program(usage: DataFrame) -> DataFrame:
    """Each cell's strongest program (ties: the smaller name) and all its scores as shares; a sum of 0 gives 0."""
    cell = W.partitionBy("cell_id")
    total = F.sum("score").over(cell)
    dominant = F.min_by("program", F.struct(-F.col("score"), F.col("program"))).over(cell)
    return usage.withColumn("share", F.when(total == 0, 0.0).otherwise(F.col("score") / total)).withColumn("dominant", dominant)


def loading_curves(loading: DataFrame, n_top: int = 100) -> DataFrame:
    """Positive loadings of each program by rank below n_top, their logarithm scaled to 0 ... 1."""
    program = W.partitionBy("program")
    rows = loading.filter("score > 0").withColumn("rank", F.row_number().over(program.orderBy(F.desc("score"), "gene_id"))).filter(F.col("rank") <= n_top)
    rows = rows.withColumn("_l", F.log("score"))
    return rows.withColumn("scaled", (F.col("_l") - F.min("_l").over(program)) / (F.max("_l").over(program) - F.min("_l").over(program) + 1e-15)).drop("_l")


def subsample(df: DataFrame, keys: list[str], ident: str, n: int, seed: int = 42) -> DataFrame:
    """n rows of each group without replacement, by a seeded hash, so alike on any partitioning."""
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(ident).cast("string")))
    return df.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(draw, ident))).filter(F.col("_k") <= n).drop("_k")


def search_input(summary: DataFrame, list_columns: list[str], program: str = "program") -> DataFrame:
    """Merges ';' lists of several conditions: first occurrences in order, joined by ', '."""
    lists = F.flatten(F.array(*(F.coalesce(F.split(F.col(c), ";"), F.array().cast("array<string>")) for c in list_columns)))
    merged = F.array_distinct(F.filter(F.transform(lists, lambda x: F.trim(x)), lambda x: x != ""))
    return summary.select(program, F.array_join(merged, ", ").alias("regulators"))


def file_key(k: Column, threshold: Column, covariates: list[str]) -> Column:
    tag = "_".join(covariates)
    return F.concat_ws("_", k.cast("string"), F.replace(threshold.cast("string"), F.lit("."), F.lit("_")), F.lit(tag) if tag else None)
