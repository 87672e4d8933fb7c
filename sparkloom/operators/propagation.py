"""Effects on programs and, through the loadings, on genes, with bias and errors from the same draws.

All draws (the data as they are, label permutations, bootstraps) of all keys, such as
targets, go through the same two passes. Cells of a key are dealt into buckets of
bounded size; a bucket sends weighted Gram sums for each draw, from which each draw's
coefficients follow, then meets the loadings with all coefficients at once and sends sums
for each draw and gene. No row is made for a cell, draw and gene.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.special import normal_p
from sparkloom.operators import similarity
from sparkloom.operators.calibration import bootstrap_labels, permuted_labels, standardised
from sparkloom.sources.tables import written

#: Cells that one task holds with all their draws, genes whose expression it holds for them, and cells that it multiplies at once.
BUCKET, GENES, TILE = 4096, 512, 256
METHODS = ("log", "pseudo")


def _key_schema(df: DataFrame, keys: list[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


def pseudocounts(scores: DataFrame, programs: list, scale: float = 1e6) -> dict:
    """The 5 % quantile of each program's scaled scores above zero, 1 where there are none."""
    found = scores.filter("score > 0").groupBy("program").agg(F.percentile("score", 0.05).alias("q")).collect()
    return {p: 1.0 for p in programs} | {r["program"]: scale * r["q"] for r in found}


def _rows(scores: DataFrame, cells: DataFrame, keys: list[str], covariates: list[str], offsets: dict, permutations: int, bootstraps: int, seed: int, scale: float) -> DataFrame:
    """keys, bucket, part, t, m, z, y, perm, boot: a row for each key and cell; y is log(scale * score + offset) by program, 0 for scores that the table leaves out."""
    wide = scores.groupBy("cell_id").agg(*(F.coalesce(F.sum(F.when(F.col("program") == p, F.col("score"))), F.lit(0.0)).alias(f"p{i}") for i, p in enumerate(offsets)))
    y = F.array(*(F.log(F.col(f"p{i}") * scale + o) for i, o in enumerate(offsets.values())))
    wide = wide.select("cell_id", y.alias("y"))
    own = cells.select(*keys, "cell_id", F.col("treated").cast("double").alias("t"), F.col("weight").cast("double").alias("m"), F.array(F.lit(1.0), *(F.col(c).cast("double") for c in covariates)).alias("z"))
    rows = own.join(wide, "cell_id")
    perm = permuted_labels(cells, permutations, seed, keys).select(*keys, "cell_id", F.col("on").alias("perm")) if permutations else None
    boot = bootstrap_labels(cells, bootstraps, seed, keys).select(*keys, "cell_id", F.zip_with("on", "off", lambda a, b: a + b).alias("boot")) if bootstraps else None
    for labels, name in ((perm, "perm"), (boot, "boot")):
        rows = rows.join(labels, [*keys, "cell_id"]) if labels is not None else rows.withColumn(name, F.array().cast("array<double>"))
    sizes = cells.groupBy(*keys).agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("buckets"))
    rows = rows.join(sizes, keys)
    bucket = F.pmod(F.xxhash64("cell_id"), F.col("buckets")).cast("int")
    # sums of a key's buckets are added up in two steps of about the same width
    return rows.withColumn("bucket", bucket).withColumn("part", F.pmod("bucket", F.ceil(F.sqrt("buckets"))).cast("int")).drop("buckets", "cell_id")


def _added(table: pa.Table) -> pa.Table:
    """The first row of a group with the sum of its arrays."""
    column = table.column("v").combine_chunks()
    total = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).sum(0)
    return table.slice(0, 1).set_column(table.schema.get_field_index("v"), "v", pa.array([total.tolist()], pa.list_(pa.float64())))


def _weights(table: pa.Table, permutations: int, bootstraps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label, draws' labels and draws' counts of a bucket's cells."""
    t = table.column("t").to_numpy()
    return t, _matrix(table.column("perm"), permutations), _matrix(table.column("boot"), bootstraps)


def fit_draws(rows: DataFrame, keys: list[str], n_covariates: int, n_programs: int, permutations: int, bootstraps: int) -> DataFrame:
    """keys, betas: the label's coefficient in each draw (the data, permutations, bootstraps) and program, in one array by draw.

    Weighted least squares with an intercept and the covariates, from sums only; null where a draw's label doesn't vary.
    """
    c, k, p, b = n_covariates + 1, n_programs, permutations, bootstraps
    names, schema = [*keys, "part", "v"], _key_schema(rows, keys) + "part int, v array<double>"

    def sums(table: pa.Table) -> pa.Table:
        t, perm, boot = _weights(table, p, b)
        m, z, y = table.column("m").to_numpy(), _matrix(table.column("z"), c), _matrix(table.column("y"), k)
        both = np.c_[z, y]
        square = (z[:, :, None] * both[:, None, :]).reshape(len(z), -1)
        often = np.c_[np.ones(len(t)), boot] * m[:, None]
        labels = np.c_[t, perm, boot * t[:, None]] * m[:, None]
        v = np.r_[(often.T @ square).ravel(), (labels.T @ both).ravel()]
        first = table.slice(0, 1)
        return pa.table([*(first.column(x) for x in [*keys, "part"]), pa.array([v.tolist()], pa.list_(pa.float64()))], names=names)

    def solved(table: pa.Table) -> pa.Table:
        v = np.array(_added(table).column("v")[0].as_py())
        edge = (1 + b) * c * (c + k)
        whole = v[:edge].reshape(1 + b, c, c + k)
        own = v[edge:].reshape(1 + p + b, c + k)
        whole = whole[np.r_[np.zeros(1 + p, int), np.arange(1, 1 + b)]]
        left = np.linalg.pinv(whole[:, :, :c], hermitian=True)
        turned = np.einsum("dc,dce->de", own[:, :c], left)
        size = own[:, 0] - np.einsum("de,de->d", turned, own[:, :c])  # labels are 0 or 1 and covariate 0 is 1
        beta = own[:, c:] - np.einsum("de,dek->dk", turned, whole[:, :, c:])
        beta = beta / np.where(size > 1e-9 * np.maximum(own[:, 0], 1), size, np.nan)[:, None]
        first = table.slice(0, 1)
        return pa.table([*(first.column(x) for x in [*keys, "part"]), pa.array([beta.ravel().tolist()], pa.list_(pa.float64()))], names=names)

    parts = rows.groupBy(*keys, "bucket", "part").applyInArrow(sums, schema).groupBy(*keys, "part").applyInArrow(_added, schema)
    return parts.groupBy(*keys).applyInArrow(solved, schema).select(*keys, F.col("v").alias("betas"))


def log_changes(q: np.ndarray, w: np.ndarray, betas: np.ndarray, often: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Draws x genes: sums over cells of often * log(q e^beta w / q w); place: each draw's column of often, of which the first holds ones."""
    grown = np.exp(betas)
    # a cell's change lies between the least and the largest e^beta, so changes are multiplied before a log is taken, as many as stay in range
    farthest = np.nan_to_num(np.abs(betas)).max(1, initial=0.0)
    total = np.zeros((len(betas), w.shape[1]))
    for at in range(0, len(q), TILE):
        own, times = q[at : at + TILE], often[at : at + TILE]
        orders = [o[times[o, i] > 0] for i in range(1, times.shape[1]) for o in [np.argsort(times[:, i], kind="stable")]]
        for j in range(0, w.shape[1], GENES):
            part = w[:, j : j + GENES]
            before = 1 / (own @ part)
            for i in range(len(betas)):
                change, n = own * grown[i], times[:, place[i]]
                if place[i]:
                    order = orders[place[i] - 1]
                    change, n = change[order], n[order]
                change = change @ part
                change *= before[order] if place[i] else before
                run = max(1, int(600 / max(farthest[i], 1e-3)))
                new = np.flatnonzero(np.r_[True, n[1:] != n[:-1], True]) if len(n) else ()
                for first, end in zip(new[:-1], new[1:], strict=True):
                    for x in range(first, end, run):
                        total[i, j : j + GENES] += n[x] * np.log(np.multiply.reduce(change[x : min(x + run, end)], axis=0))
    return total


def gene_draws(rows: DataFrame, betas: DataFrame, weights: np.ndarray, keys: list[str], permutations: int, bootstraps: int) -> DataFrame:
    """keys, at, effect, bias, se of gene number ``at``: of all draws, in one pass over the cells.

    A gene's effect in a draw is the mean over the draw's cells of log(Q e^beta W) - log(Q W); bias is its mean
    over permutations, se its deviation over bootstraps.
    """
    p, b = permutations, bootstraps
    d, k = 1 + p + b, len(weights)
    sent = rows.sparkSession.sparkContext.broadcast(weights)
    names, schema = [*keys, "part", "chunk", "v"], _key_schema(rows, keys) + "part int, chunk int, v array<double>"

    def sums(cells: pa.Table, found: pa.Table) -> pa.Table:
        none = pa.table([pa.array([], f.type) for f in cells.select([*keys, "part"]).schema] + [pa.array([], pa.int32()), pa.array([], pa.list_(pa.float64()))], names=names)
        if not cells.num_rows or not found.num_rows:
            return none
        w = sent.value
        q = np.exp(_matrix(cells.column("y"), k))
        _, _, boot = _weights(cells, p, b)
        often = np.c_[np.ones((len(q), 1)), boot]
        betas = np.array(found.column("betas")[0].as_py(), float).reshape(d, k)
        place = np.r_[np.zeros(1 + p, int), np.arange(1, 1 + b)]
        count = often.sum(0)[place]
        total = log_changes(q, w, betas, often, place)
        out = [(chunk, np.r_[total[:, at : at + GENES].ravel(), count].tolist()) for chunk, at in enumerate(range(0, w.shape[1], GENES))]
        first = cells.slice(0, 1)
        repeat = pa.array(np.zeros(len(out), int))
        return pa.table([*(first.column(x).take(repeat) for x in [*keys, "part"]), pa.array([c for c, _ in out], pa.int32()), pa.array([v for _, v in out], pa.list_(pa.float64()))], names=names)

    result = _key_schema(rows, keys) + "at long, effect double, bias double, se double"

    def judged(table: pa.Table) -> pa.Table:
        v = np.array(_added(table).column("v")[0].as_py())
        count = v[-d:]
        effect = v[:-d].reshape(d, -1) / np.where(count > 0, count, np.nan)[:, None]
        with np.errstate(all="ignore"):
            bias = effect[1 : 1 + p].mean(0) if p else np.zeros(effect.shape[1])
            se = effect[1 + p :].std(0, ddof=1) if b > 1 else np.full(effect.shape[1], np.nan)
        n = effect.shape[1]
        at = table.column("chunk")[0].as_py() * GENES + np.arange(n)
        first, repeat = table.slice(0, 1), pa.array(np.zeros(n, int))
        number = lambda x: pa.array(x, mask=~np.isfinite(x))
        return pa.table([*(first.column(x).take(repeat) for x in keys), pa.array(at), number(effect[0]), number(bias), number(se)], names=[*keys, "at", "effect", "bias", "se"])

    places = rows.select(*keys, "bucket", "part").distinct()
    # toDF names the columns anew, so that both sides of the cogroup can be told apart
    asked = places.join(betas, keys).select(*keys, "bucket", "part", "betas").toDF(*keys, "bucket", "part", "betas")
    by = [*keys, "bucket", "part"]
    parts = rows.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(sums, schema).groupBy(*keys, "part", "chunk").applyInArrow(_added, schema)
    return parts.groupBy(*keys, "chunk").applyInArrow(judged, result)


def effects_with_errors(scores: DataFrame, loading: DataFrame | None, cells: DataFrame, keys: list[str] | None = None, covariates: list[str] | None = None, method: str = "log", permutations: int = 100, bootstraps: int = 500, seed: int = 42, scale: float = 1e6) -> tuple[DataFrame, DataFrame | None]:
    """Program and gene effects of each key, with errors from shared draws.

    scores: cell_id, program, score; loading: program, gene_id, score, neither below zero; cells: keys, cell_id, treated
    (0/1), optionally weight (of matching), covariates. The first table has keys, program, beta, bias, se, stat, pval,
    the second keys, gene_id, effect, bias, corrected, se, stat, pval. A program's beta is the label's coefficient
    on log(1e6 score + offset), weighted; stat is beta / se. A gene's effect is the mean change of its log expression when
    programs grow by e^beta; stat is (effect - bias) / se. bias is the mean over label permutations, se the deviation over
    bootstraps (Poisson counts); p-values are two-sided normal. method: offset 1 (log) or the 5 % quantile
    of a program's positive scores (pseudo; taken once from all cells, not anew in each draw). Genes
    without loading are left out; a key whose label doesn't vary has null effects. Loadings are sent in matrices of up to
    DENSE_ENTRIES numbers, each with a pass of its own. Without loading there is no second table.
    """
    if not keys:
        found = effects_with_errors(scores, loading, cells.withColumn("_all", F.lit(0)), ["_all"], covariates, method, permutations, bootstraps, seed, scale)
        return found[0].drop("_all"), None if found[1] is None else found[1].drop("_all")
    covariates = covariates or []
    if method not in METHODS:
        raise ValueError(f"method is one of {METHODS}")
    ok = lambda c: F.when(F.col(c) < 0, F.raise_error(F.lit(f"negative {c}")).cast("double")).otherwise(F.col(c).cast("double"))
    scores = scores.select("cell_id", "program", ok("score").alias("score"))
    if "weight" not in cells.columns:
        cells = cells.withColumn("weight", F.lit(1.0))
    if covariates:  # coefficients of the label don't show it, products of unlike and nearly collinear numbers would
        cells = standardised(cells, keys, covariates)
        covariates = [f"_x{j}" for j, _ in enumerate(covariates, 2)]
    programs = sorted(r[0] for r in scores.select("program").distinct().collect())
    offsets = pseudocounts(scores, programs, scale) if method == "pseudo" else {p: 1.0 for p in programs}
    rows = _rows(scores, cells, keys, covariates, offsets, permutations, bootstraps, seed, scale)
    rows = written(rows, "draw-rows")
    betas = written(fit_draws(rows, keys, len(covariates), len(programs), permutations, bootstraps), "draw-betas")
    n = len(programs)
    named = F.array(*map(F.lit, programs))
    at = lambda first, count: F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.get(F.col("betas"), (i + first) * n + F.col("i"))) if count else F.array().cast("array<double>")
    each = betas.select(*keys, "betas", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    each = each.select(*keys, F.get(named, F.col("i")).alias("program"), F.get("betas", F.col("i")).alias("beta"), at(1, permutations).alias("p"), at(1 + permutations, bootstraps).alias("b"))
    finite = lambda c: F.filter(c, lambda x: ~F.isnan(x))
    mean = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(c), F.lit(0))
    each = each.withColumns({"beta": F.nanvl("beta", F.lit(None).cast("double")), "p": finite("p"), "b": finite("b")}).withColumn("m", mean("b"))
    se = F.sqrt(F.aggregate("b", F.lit(0.0), lambda s, x: s + (x - F.col("m")) * (x - F.col("m"))) / F.nullif(F.size("b") - 1, F.lit(0)))
    of_programs = each.select(*keys, "program", "beta", mean("p").alias("bias"), se.alias("se")).withColumn("stat", F.col("beta") / F.nullif("se", F.lit(0.0)))
    of_programs = of_programs.withColumn("pval", normal_p("stat"))
    if loading is None:
        return of_programs, None

    loading = loading.filter(F.col("program").isin(programs)).select("program", "gene_id", ok("score").alias("score"))
    n_genes = loading.agg(F.count_distinct("gene_id")).first()[0]
    todo, out = [(1, 0)] if n_genes else [], None
    while todo:  # a part of the genes that is too large for one matrix is halved
        parts, i = todo.pop()
        some = loading.filter("score > 0")
        some = some if parts == 1 else some.filter(F.pmod(F.xxhash64("gene_id"), F.lit(parts)) == i)
        sent = similarity.dense(some, "program", "gene_id", ["score"])
        if sent is None:
            if parts > n_genes:
                raise ValueError("a gene's loadings alone are beyond DENSE_ENTRIES")
            todo += [(2 * parts, i + parts), (2 * parts, i)]
            continue
        have, genes, (w,) = sent
        if not genes:
            continue
        full = np.zeros((n, w.shape[1]))
        full[[programs.index(p) for p in have]] = w
        names = rows.sparkSession.createDataFrame([(j, g) for j, g in enumerate(genes)], f"at long, gene_id {loading.schema['gene_id'].dataType.simpleString()}")
        part = gene_draws(rows, betas, full, keys, permutations, bootstraps).join(names, "at")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = of_programs.select(*keys, F.lit(None).cast(loading.schema["gene_id"].dataType).alias("gene_id"), F.col("beta").alias("effect"), "bias", "se").limit(0)
    corrected = F.col("effect") - F.coalesce("bias", F.lit(0.0))
    of_genes = out.select(*keys, "gene_id", "effect", "bias", corrected.alias("corrected"), "se").withColumn("stat", F.col("corrected") / F.nullif("se", F.lit(0.0)))
    return of_programs, of_genes.withColumn("pval", normal_p("stat"))
