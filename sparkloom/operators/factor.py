"""Consensus non-negative matrix factorisation and motif scans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType
from pyspark.sql.window import Window as W

from sparkloom.functions.special import t_p
from sparkloom.operators import similarity
from sparkloom.operators.association import kendall
from sparkloom.operators.calibration import hash_part, uniforms
from sparkloom.operators.ranking import benjamini_hochberg_wide, positions, top_k
from sparkloom.operators.similarity import cluster_medians
from sparkloom.operators.solvers import Rows, block_pivoting, objective, row_sums, solve_rows, update_spectra
from sparkloom.sources.tables import dealt, written

#: Numbers of all H that one job updates together; more replicates take turns. One H of k by high-variance genes is the caller's choice.
TOGETHER = 1 << 23
ALGOS, LOSSES = ("mu", "hals", "halsvar", "bpp"), ("frobenius", "kl", "is")
#: Rows and columns of pairs that a task holds at once.
PIECE = (256, 8192)
#: Bases that are scanned at once.
SCANNED = 1 << 20
#: Share of each base when it is not given.
BACKGROUND = 0.25


def variable_genes(expr: DataFrame, n_cells: int, n_top: int = 2000) -> DataFrame:
    """Genes of largest variance over mean, zeros included: gene_id, mean, var, dispersion, rank."""
    g = expr.groupBy("gene_id").agg(F.sum("count").alias("s"), F.sum(F.col("count") * F.col("count")).alias("q"))
    g = g.select("gene_id", (F.col("s") / n_cells).alias("mean"), ((F.col("q") - F.col("s") * F.col("s") / n_cells) / (n_cells - 1)).alias("var"))
    g = g.withColumn("dispersion", F.col("var") / F.col("mean"))
    best = g.orderBy(F.desc("dispersion"), "gene_id").limit(n_top)
    return best.withColumn("rank", F.row_number().over(W.orderBy(F.desc("dispersion"), "gene_id")))


def prepare(expr: DataFrame, genes: DataFrame) -> DataFrame:
    """One row per cell: cell_id, idx (places of genes by id), val (counts over the gene's deviation)."""
    placed = genes.select("gene_id", F.sqrt("var").alias("sd"), (F.row_number().over(W.orderBy("gene_id")) - 1).alias("i")).filter("sd > 0")
    rows = expr.join(placed, "gene_id").select("cell_id", "i", (F.col("count") / F.col("sd")).alias("v"))
    return rows.groupBy("cell_id").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("x")).select("cell_id", F.col("x.i").alias("idx"), F.col("x.v").alias("val"))


def tpm(expr: DataFrame, million: float = 1e6) -> DataFrame:
    """cell_id, gene_id, tpm: counts per million of their cell; cells without counts have none."""
    total = expr.groupBy("cell_id").agg(F.sum("count").alias("_t")).filter("_t > 0")
    return expr.join(total, "cell_id").select("cell_id", "gene_id", (F.col("count") * million / F.col("_t")).alias("tpm"))


def prepare_log(expr: DataFrame, genes: DataFrame, target: float = 1e4) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Rows as prepare() has them of log1p(counts per ``target``), and mean and deviation of each gene over all cells with a count, zeros included."""
    placed = written(genes.select("gene_id", (F.row_number().over(W.orderBy("gene_id")) - 1).alias("i")), "placed-genes")
    # one pass: a cell's total and its chosen genes come from the same rows
    wide = expr.join(placed, "gene_id", "left").groupBy("cell_id").agg(
        F.sum("count").alias("_t"),
        F.coalesce(F.bool_or(F.col("count") > 0), F.lit(False)).alias("_some"),
        F.array_sort(F.collect_list(F.when(F.col("i").isNotNull(), F.struct("i", "count")))).alias("x"),
    )
    logs = F.transform("x", lambda x: F.log1p(x["count"] * target / F.col("_t")))
    wide = written(wide.filter("_t > 0").select("cell_id", F.col("x.i").alias("idx"), logs.alias("val"), "_some"), "log-counts")
    n = wide.filter("_some").count()
    rows = wide.select(F.explode(F.arrays_zip("idx", "val")).alias("x")).select(F.col("x.idx").alias("i"), F.col("x.val").alias("v"))
    sums = rows.groupBy("i").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")).collect()  # two numbers a chosen gene
    size = placed.count()
    mean, square = np.zeros(size), np.zeros(size)
    for r in sums:
        mean[r.i], square[r.i] = r.s / n, r.q / n
    return wide.drop("_some"), mean, np.sqrt(np.maximum(square - mean**2, 0))


def summed(matrix: DataFrame, f: Callable[[Rows, pd.DataFrame], list[np.ndarray]]) -> list[np.ndarray]:
    """Sums over all cells of the arrays that ``f`` returns for a batch of rows (and its table).

    A partition sends one row an array; these are added up in two steps, and the totals, of the size of the model, come to the driver.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, part = None, 0
        for batch in batches:
            if len(batch):
                part = hash_part(batch["cell_id"].iloc[0])
                found = f(Rows.of(batch["idx"], batch["val"]), batch)
                total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        for i, g in enumerate(total or []):
            yield pd.DataFrame({"which": [i], "part": [part], "g": [np.asarray(g, float).ravel().tolist()]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"which": [pdf["which"].iloc[0]], "part": [pdf["part"].iloc[0]], "g": [np.sum(np.stack(pdf["g"].to_list()), axis=0).tolist()]})

    schema = "which int, part int, g array<double>"
    sums = matrix.mapInPandas(run, schema).groupBy("which", "part").applyInPandas(added, schema).groupBy("which").applyInPandas(added, schema)
    return [np.array(r.g) for r in sums.orderBy("which").collect()]


def singular_vectors(matrix: DataFrame, n_genes: int, k: int, mean: np.ndarray | None = None, scale: np.ndarray | None = None, seed: int = 0, passes: int = 60, enough: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """The first k right singular vectors (columns) and squared singular values of (X - mean) / scale.

    Subspace iteration with a random start: a pass sends genes x (k + 10) numbers, cells answer with sums. Means and scales
    are applied to products only, so rows stay sparse; those without an entry are counted. It ends when the k values no longer move; signs make the
    largest entry of a vector positive.
    """
    d = 1 / np.where(scale > 0, scale, np.inf) if scale is not None else np.ones(n_genes)
    shift = mean * d if mean is not None else np.zeros(n_genes)
    empty = matrix.filter(F.size("idx") == 0).count()
    matrix = matrix.filter(F.size("idx") > 0)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(n_genes, min(n_genes, k + 10))))[0]
    before = None
    for _ in range(passes):
        sent = matrix.sparkSession.sparkContext.broadcast((q * d[:, None], shift @ q))

        def f(rows: Rows, batch: pd.DataFrame, sent=sent) -> list[np.ndarray]:
            right, off = sent.value
            z = rows.times(right) - off
            return [rows.crossed(z, n_genes).T, z.sum(0)]

        found = summed(matrix, f) or ([np.zeros(q.size), np.zeros(q.shape[1])] if empty else [])
        sent.unpersist()
        if not found:
            break
        found[1] = found[1] - empty * (shift @ q)  # of rows without an entry, all alike
        y = found[0].reshape(n_genes, -1) * d[:, None] - np.outer(shift, found[1])
        values, turn = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        if before is not None and np.abs(values[:k] - before[:k]).max() <= enough * max(abs(values[0]), 1e-300):
            q = q @ turn
            break
        before = values
        q = np.linalg.qr(y @ turn)[0]
    q = q[:, :k]
    q = q * np.where(np.take_along_axis(q, np.abs(q).argmax(0)[None], 0) < 0, -1.0, 1.0)
    return q, np.maximum(values[:k], 0) if found else np.zeros(k)


def nndsvd(matrix: DataFrame, n_genes: int, k: int, seed: int = 0) -> np.ndarray:
    """Start spectra from the singular vectors: of each pair, the sides of one sign that weigh more (Boutsidis and Gallopoulos 2008).

    The first pair is taken by absolute value; zeros get a hundredth of the mean, so that multiplicative updates can move them.
    """
    v, values = singular_vectors(matrix, n_genes, k, seed=seed)
    sent = matrix.sparkSession.sparkContext.broadcast(v)

    def f(rows: Rows, batch: pd.DataFrame) -> list[np.ndarray]:
        u = rows.times(sent.value)
        return [(np.maximum(u, 0) ** 2).sum(0), (np.maximum(-u, 0) ** 2).sum(0)]

    found = summed(matrix, f) or [np.zeros(k), np.zeros(k)]
    up, down = (np.sqrt(x / np.maximum(values, 1e-300)) for x in found)
    h = np.zeros((k, n_genes))
    for j in range(k):
        plus, minus = np.maximum(v[:, j], 0), np.maximum(-v[:, j], 0)
        a, b = np.linalg.norm(plus), np.linalg.norm(minus)
        if j == 0:
            h[j] = np.sqrt(np.sqrt(values[0])) * np.abs(v[:, 0])
        elif up[j] * a >= down[j] * b:
            h[j] = np.sqrt(np.sqrt(values[j]) * up[j] * a) * plus / max(a, 1e-300)
        else:
            h[j] = np.sqrt(np.sqrt(values[j]) * down[j] * b) * minus / max(b, 1e-300)
    return np.where(h > 0, h, max(h.mean(), 1e-6) / 100)


def factorise(matrix: DataFrame, n_genes: int, k: int, seed: int, **options) -> np.ndarray:
    """H (k by genes) of one replicate: see factorise_all."""
    return factorise_all(matrix, n_genes, [(k, seed)], **options)[0]


def _checked(algo: str | None, loss: str) -> str:
    if loss not in LOSSES:
        raise ValueError(f"loss is one of {LOSSES}")
    algo = algo or ("halsvar" if loss == "frobenius" else "mu")
    if algo not in ALGOS or algo != "mu" and loss != "frobenius":
        raise ValueError(f"algo is one of {ALGOS}; other losses than frobenius have mu only")
    return algo


def factorise_all(matrix: DataFrame, n_genes: int, runs: list[tuple[int, int]], loss: str = "frobenius", algo: str | None = None, init: str = "random", rounds: int = 20, inner: int = 10, l1: float = 0.0, l2: float = 0.0, fraction: float | None = None, tol: float = 0.0, history: list | None = None) -> list[np.ndarray]:
    """H (k by genes) of each replicate (k, seed). A round is one job for all of them: cells are solved where they lie against
    the broadcast Hs, and partitions send sums of the size of the model, which are added up in two steps.

    loss: frobenius, kl (Kullback-Leibler) or is (Itakura-Saito; a cell's zeros count at their fit). algo: mu (multiplicative),
    hals (column sweeps), halsvar (sweeps until a side is settled; the default of frobenius), bpp (block pivoting, exact for each side). init: random
    or nndsvd (the same start for all seeds of a k). l1, l2: penalties on both sides. fraction: cells of each round, drawn anew by the
    replicate's seed. tol: a replicate ends when its objective falls by less than this share. history: gets a list of objectives, one
    a round before its update, for each replicate.
    """
    algo = _checked(algo, loss)
    spark = matrix.sparkSession
    if init == "nndsvd":
        starts = {k: nndsvd(matrix, n_genes, k) for k in {k for k, _ in runs}}
        hs = [starts[k].copy() for k, _ in runs]
    elif init == "random":
        hs = [np.random.default_rng([seed, k]).random((k, n_genes)) + 0.01 for k, seed in runs]
    else:
        raise ValueError("init is random or nndsvd")
    step = max(1, TOGETHER // max(1, max((h.size for h in hs), default=1)))
    if len(runs) > step:
        options = {"loss": loss, "algo": algo, "init": init, "rounds": rounds, "inner": inner, "l1": l1, "l2": l2, "fraction": fraction, "tol": tol, "history": history}
        return [h for at in range(0, len(runs), step) for h in factorise_all(matrix, n_genes, runs[at : at + step], **options)]
    seen: list[list[float]] = [[] for _ in runs]
    going = list(range(len(runs)))
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast({run: hs[run] for run in going})

        def f(rows: Rows, batch: pd.DataFrame, sent=sent, turn=turn) -> list[np.ndarray]:
            out = []
            for run, h in sent.value.items():
                own = rows
                if fraction is not None:
                    own = rows.taken(uniforms(batch["cell_id"].to_numpy(), np.array([turn]), runs[run][1], "batch")[:, 0] < fraction)
                w = solve_rows(own, h, algo, loss, inner, l1, l2)
                down, up = row_sums(own, w, h, loss)
                out.append(np.r_[down.ravel(), up.ravel(), objective(own, w, h, loss)])
            return out

        found = summed(matrix, f)
        sent.unpersist()
        ended = []
        for run, v in zip(going, found, strict=False):
            h, k = hs[run], len(hs[run])
            down, up = v[: -1 - h.size].reshape(k, -1), v[-1 - h.size : -1].reshape(k, -1)
            seen[run].append(float(v[-1]))
            if down.any():
                hs[run] = update_spectra(h, down, up, algo, loss, inner, l1, l2)
            if len(seen[run]) > 1 and tol and seen[run][-2] - seen[run][-1] <= tol * abs(seen[run][-2]):
                ended.append(run)
        going = [run for run in going if run not in ended]
        if not going or not found:
            break
    if history is not None:
        history += seen
    return hs


def factorise_online(matrix: DataFrame, n_genes: int, k: int, seed: int, batches: int = 10, passes: int = 5, forget: float = 0.7, inner: int = 10, l1: float = 0.0, l2: float = 0.0, state: str | None = None, history: list | None = None) -> np.ndarray:
    """H by online learning (Mairal et al. 2010): in a pass each cell is in exactly one batch, by a hash of its id, the pass and the seed.

    After a batch the sums of the earlier ones are kept at ``forget`` of their weight, and H takes column sweeps on all of them.
    state: a folder for H and the sums after each pass; a run that finds it there goes on after its last pass. history: gets (pass, number of cells, objective) of each batch.
    """
    spark = matrix.sparkSession
    h = np.random.default_rng([seed, k]).random((k, n_genes)) + 0.01
    down, up, first = np.zeros((k, k)), np.zeros((k, n_genes)), 0
    if state is not None:
        kept = _state(spark, state)
        if kept is not None:
            first, h, down, up = kept[0] + 1, *(np.array(x).reshape(k, -1) for x in kept[1:])
    for turn in range(first, passes):
        for number in range(batches):
            sent = spark.sparkContext.broadcast(h)

            def f(rows: Rows, batch: pd.DataFrame, sent=sent, turn=turn, number=number) -> list[np.ndarray]:
                of = np.floor(uniforms(batch["cell_id"].to_numpy(), np.array([turn]), seed, "order")[:, 0] * batches)
                own = rows.taken(of == number)
                w = solve_rows(own, sent.value, "halsvar", "frobenius", inner, l1, l2)
                gram, cross = row_sums(own, w, sent.value, "frobenius")
                return [gram, cross, np.array([len(own), objective(own, w, sent.value, "frobenius")])]

            found = summed(matrix, f)
            sent.unpersist()
            if found and found[2][0]:
                down, up = forget * down + found[0].reshape(k, k), forget * up + found[1].reshape(k, -1)
                h = update_spectra(h, down, up, "halsvar", "frobenius", inner, l1, l2)
                if history is not None:
                    history.append((turn, int(found[2][0]), float(found[2][1])))
        if state is not None:
            row = [(turn, h.ravel().tolist(), down.ravel().tolist(), up.ravel().tolist())]
            spark.createDataFrame(row, "turn int, h array<double>, down array<double>, up array<double>").write.mode("overwrite").parquet(f"{state}/turn={turn}")
    return h


def _state(spark: SparkSession, folder: str) -> tuple | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    last = spark.read.parquet(folder).orderBy(F.desc("turn")).first()
    return (last.turn, last.h, last.down, last.up) if last else None


def replicates(matrix: DataFrame, n_genes: int, ks: list[int], n_iter: int, seed: int = 14, done: DataFrame | None = None, **options) -> DataFrame:
    """Spectra of all (K, replicate) that ``done`` lacks: K, replicate, component, dim, value. All replicates go through the same jobs."""
    spark = matrix.sparkSession
    have = {(r.K, r.replicate) for r in done.select("K", "replicate").distinct().collect()} if done is not None else set()
    todo = [(k, i) for k in ks for i in range(n_iter) if (k, i) not in have]
    if not todo and done is not None:
        return done
    found = factorise_all(matrix, n_genes, [(k, seed + i) for k, i in todo], **options)
    rows = [(k, i, c, row.tolist()) for (k, i), h in zip(todo, found, strict=True) for c, row in enumerate(h)]
    out = spark.createDataFrame(rows, "K int, replicate int, component int, h array<double>")
    long = out.select("K", "replicate", "component", F.posexplode("h").alias("dim", "value"))
    return long if done is None else done.unionByName(long)


def nearest_in_blocks(vectors: DataFrame, n: int, value: Callable[[np.ndarray, np.ndarray], np.ndarray], largest: bool = False, others: DataFrame | None = None) -> DataFrame:
    """a, b, value: for each id its n others of smallest (or largest) value, ties by id; NaN pairs are left out.

    vectors, others: id, v (arrays of one length). value: of two matrices, rows by rows. Others are sent in blocks of up to
    DENSE_ENTRIES numbers, and a task keeps n for each of its ids, so pairs never leave it.
    """
    others = vectors if others is None else others
    spark = vectors.sparkSession
    size = others.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    blocks = max(1, -(-size.n * (size.d or 0) * 5 // (4 * similarity.DENSE_ENTRIES)))
    kind = vectors.schema["id"].dataType.simpleString()
    spread = vectors.select("id", "v").repartition(max(1, -(-vectors.count() * size.n // similarity.TASK_PAIRS)))
    found = None
    for i in range(blocks):
        rows = others.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).orderBy("id").collect()
        if not rows:
            continue
        names = pd.Index([r.id for r in rows], dtype=object)
        sent = spark.sparkContext.broadcast((names, np.array([r.v for r in rows], float)))

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            names, right = sent.value
            number, unique = pd.factorize(names)
            for batch in batches:
                for at in range(0, len(batch), PIECE[0]):
                    part = batch.iloc[at : at + PIECE[0]]
                    left, own = np.array(part["v"].tolist(), float), unique.get_indexer(part["id"])
                    limit = np.full(len(part), np.inf)  # what a pair of each id must reach
                    row, column, best = np.empty(0, int), np.empty(0, int), np.empty(0)
                    for first in range(0, len(right), PIECE[1]):
                        piece = slice(first, first + PIECE[1])
                        d = value(left, right[piece])
                        d = np.where(own[:, None] == number[None, piece], np.nan, -d if largest else d)
                        if not len(row) and d.shape[1] >= n:
                            limit = np.fmin(limit, np.partition(d, n - 1, axis=1)[:, n - 1])  # NaN comes last
                        r, c = np.nonzero(d <= limit[:, None])
                        row, column, best = np.r_[row, r], np.r_[column, c + first], np.r_[best, d[r, c]]
                        order = np.lexsort((column, best, row))  # names are in order
                        row, column, best = row[order], column[order], best[order]
                        place = np.arange(len(row)) - np.searchsorted(row, row, "left")
                        limit[row[place == n - 1]] = best[place == n - 1]
                        row, column, best = row[place < n], column[place < n], best[place < n]
                    yield pd.DataFrame({"a": part["id"].to_numpy(object)[row], "b": names.to_numpy()[column], "value": -best if largest else best})

        part = spread.mapInPandas(run, f"a {kind}, b {kind}, value double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("value")).limit(0)
    return top_k(found, ["a"], [F.desc("value") if largest else F.asc("value"), F.asc("b")], n) if blocks > 1 else found


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows."""
    return np.sqrt(np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T))


def correlations(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pearson correlations of the rows, NaN for constant ones."""
    with np.errstate(all="ignore"):
        unit = lambda x: (x - x.mean(1, keepdims=True)) / np.linalg.norm(x - x.mean(1, keepdims=True), axis=1, keepdims=True)
        return unit(a) @ unit(b).T


#: Pairs that a task of nearest_correlations compares.
SCREENED_PAIRS = 1 << 30


def _units(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors less their mean, of length 1; NaN for constant ones."""
    x = np.array(column.to_pylist(), float) if column.null_count else column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    with np.errstate(all="ignore"):
        x = x - x.mean(1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest_correlations(vectors: DataFrame, n: int) -> DataFrame:
    """a, b, sign, value: for each id the n others of largest (sign 1) and of smallest (-1) Pearson correlation, ties by id; constant vectors are left out.

    vectors: id, v (arrays of one length). All pairs are compared in single precision; those that could be among the n by its
    largest error are computed in double, each in the same way, so that equal vectors have equal values. One side is sent in blocks of up to
    DENSE_ENTRIES numbers, and pairs don't leave the task.
    """
    spark, kind = vectors.sparkSession, vectors.schema["id"].dataType.simpleString()
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    blocks = max(1, -(-size.n * (size.d or 0) * 5 // (4 * similarity.DENSE_ENTRIES)))
    spread = vectors.select("id", "v").repartition(max(1, -(-size.n * size.n // (blocks * SCREENED_PAIRS)), spark.sparkContext.defaultParallelism))
    margin = ((size.d or 0) + 8) * 2.0**-23  # more than a single-precision product of unit vectors is off
    found = None
    for i in range(blocks):
        table = vectors.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).select("id", "v").orderBy("id").toArrow()
        if not table.num_rows:
            continue
        units = _units(table.column("v").combine_chunks())
        kept = np.isfinite(units).all(1)
        sent = spark.sparkContext.broadcast((table.column("id").to_pandas().to_numpy()[kept], units[kept]))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names, right = sent.value
            index, small = pd.Index(names), right.astype(np.float32)
            for batch in batches:
                ids, every = batch.column("id"), _units(batch.column("v"))
                good = np.flatnonzero(np.isfinite(every).all(1))
                number = index.get_indexer(ids.to_pandas())
                for at in range(0, len(good), PIECE[0]):
                    these = good[at : at + PIECE[0]]
                    for sign, (row, column, best) in zip((1, -1), _screened(every[these], number[these], right, small, n, margin), strict=True):
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(these[row])), pa.array(names[column], ids.type), pa.array(np.full(len(row), sign), pa.int32()), pa.array(sign * best)], names=["a", "b", "sign", "value"])

        part = spread.mapInArrow(run, f"a {kind}, b {kind}, sign int, value double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1).alias("sign"), F.lit(0.0).alias("value")).limit(0)
    return top_k(found, ["a", "sign"], [F.desc(F.col("value") * F.col("sign")), F.asc("b")], n).select("a", "b", "sign", "value") if blocks > 1 else found


def _screened(left: np.ndarray, own: np.ndarray, right: np.ndarray, small: np.ndarray, n: int, margin: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, column and value of each row's n largest products with others, and of its n largest with the sign turned."""
    single = left.astype(np.float32)
    limits = [np.full(len(left), -np.inf, np.float32) for _ in range(2)]  # what a pair must reach in single precision
    met = [[(np.empty(0, int), np.empty(0, int), np.empty(0))] for _ in range(2)]

    def settle(side: int) -> None:
        row, column, best = (np.concatenate(c) for c in zip(*met[side], strict=True))
        order = np.lexsort((column, -best, row))  # names are in order
        row, column, best = row[order], column[order], best[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, "left")
        limits[side][row[place == n - 1]] = best[place == n - 1] - 2 * margin
        met[side] = [(row[place < n], column[place < n], best[place < n])]

    width = PIECE[1] // 4
    for first in range(0, len(right), width):
        d = single @ small[first : first + width].T
        for side, sign in enumerate((1, -1)):
            if not first and d.shape[1] > n:  # one more, as a row may meet itself
                limits[side] = sign * np.partition(d, -1 - n if side == 0 else n, axis=1)[:, -1 - n if side == 0 else n] - np.float32(2 * margin)
            hot = np.flatnonzero((d.max(1) if side == 0 else -d.min(1)) >= limits[side])  # a row's extreme is found faster than its places
            if not len(hot):
                continue
            own_limits = limits[side][hot, None]
            r, c = np.divmod(np.flatnonzero(d[hot] >= own_limits if side == 0 else d[hot] <= -own_limits), d.shape[1])
            r, c = hot[r], c + first
            r, c = r[c != own[r]], c[c != own[r]]
            value = np.concatenate([np.einsum("ij,ij->i", left[r[x : x + 65536]], right[c[x : x + 65536]]) for x in range(0, len(r), 65536)] or [np.empty(0)])
            met[side].append((r, c, sign * value))
            if not first or sum(len(m[0]) for m in met[side]) > 3 * n * len(left):
                settle(side)
    for side in range(2):
        settle(side)
    return [m[0] for m in met]


def _arrays(rows: DataFrame) -> DataFrame:
    """id, v: values in order of dim."""
    return rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda x: x["value"]).alias("v"))


def cluster_spectra(spectra: DataFrame, k: int, threshold: float = 2.0, neighbours: float = 0.3, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(id, dim, value) of the L2-normalised spectra without outliers and zero ones, and (id, label) of their k clusters.

    spectra: replicate, component, dim, value of one K. An outlier's mean distance to its
    nearest neighbours (a share of the replicates) is above the threshold.
    """
    spec = spectra.withColumn("id", F.concat_ws("-", "replicate", "component"))
    norm = spec.groupBy("id").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("n"))
    unit = written(spec.join(norm.filter("n > 0"), "id").select("id", "dim", (F.col("value") / F.col("n")).alias("value")), "unit-spectra")
    n = max(1, int(neighbours * spec.select("replicate").distinct().count()))
    vectors = _arrays(unit)
    near = nearest_in_blocks(vectors, n, distances)
    kept = near.groupBy(F.col("a").alias("id")).agg(F.avg("value").alias("density")).filter(F.col("density") <= threshold).select("id")
    rows = vectors.join(kept, "id", "left_semi").select("id", array_to_vector("v").alias("features")).orderBy("id")
    labels = KMeans(k=k, seed=seed, maxIter=50).fit(rows).transform(rows).select("id", F.col("prediction").alias("label"))
    return unit.join(kept, "id", "left_semi"), labels


def consensus(spectra: DataFrame, k: int, threshold: float = 2.0, neighbours: float = 0.3, seed: int = 1) -> DataFrame:
    """label, dim, median: the clusters' median spectra, of sum 1; see cluster_spectra."""
    return cluster_medians(*cluster_spectra(spectra, k, threshold, neighbours, seed))


def median_matrix(medians: DataFrame, n_genes: int) -> np.ndarray:
    """consensus() as a matrix, clusters by label: k x genes numbers on the driver."""
    rows = medians.collect()
    labels = sorted({r.label for r in rows})
    h = np.zeros((len(labels), n_genes))
    for r in rows:
        h[labels.index(r.label), r.dim] = r["median"]
    return h


def usages(matrix: DataFrame, h: np.ndarray, loss: str = "frobenius", rounds: int = 200) -> DataFrame:
    """cell_id, usage: refitted usages for fixed spectra; exact non-negative least squares, or ``rounds`` multiplicative steps for other losses."""
    sent = matrix.sparkSession.sparkContext.broadcast(h)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            w = solve_rows(Rows.of(pdf["idx"], pdf["val"]), sent.value, "bpp" if loss == "frobenius" else "mu", loss, rounds)
            yield pd.DataFrame({"cell_id": pdf["cell_id"], "usage": list(w)})

    return matrix.mapInPandas(run, StructType([matrix.schema["cell_id"], StructField("usage", ArrayType(DoubleType()))]))


def refit_spectra(values: DataFrame, usage: DataFrame, value: str = "tpm") -> DataFrame:
    """gene_id, spectrum (array by program): non-negative least squares of each gene's values on the usages, scaled to sum 1 a cell.

    values: cell_id, gene_id, value, zeros left out; usage: cell_id, usage. A gene needs its sums of values times usages only, and all genes
    share the usages' Gram matrix. Cells without usage drop out.
    """
    total = F.aggregate("usage", F.lit(0.0), lambda a, x: a + x)
    shares = written(usage.withColumn("_t", total).filter("_t > 0").select("cell_id", F.transform("usage", lambda x: x / F.col("_t")).alias("w")), "shares")
    head = shares.first()
    k = len(head.w) if head else 0
    w = [F.get("w", F.lit(i)) for i in range(k)]
    grams = shares.agg(*(F.sum(w[i] * w[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k))).first() if k else None
    gram = np.array([[grams[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
    cross = values.join(shares, "cell_id").groupBy("gene_id").agg(*(F.sum(F.col(value) * x).alias(f"c{i}") for i, x in enumerate(w)))
    cross = cross.select("gene_id", F.array(*(F.col(f"c{i}") for i in range(k))).cast("array<double>").alias("c"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = block_pivoting(gram, np.array(pdf["c"].tolist(), float).reshape(len(pdf), k))
            yield pd.DataFrame({"gene_id": pdf["gene_id"], "spectrum": list(found)})

    return cross.mapInPandas(run, StructType([cross.schema["gene_id"], StructField("spectrum", ArrayType(DoubleType()))]))


def k_selection(matrix: DataFrame, n_genes: int, spectra: DataFrame, threshold: float = 2.0, seed: int = 1, done: DataFrame | None = None) -> DataFrame:
    """K, silhouette, prediction_error of every K in ``spectra`` (K, replicate, component, dim, value) that ``done`` (the same columns) lacks, and those of done.

    silhouette: mean over a K's clustered spectra. prediction_error: squared error of the matrix against exact usages of the K's medians;
    all K are solved in one scan of the cells, from stacked medians.
    """
    todo = spectra.select("K").distinct()
    todo = sorted(r.K for r in (todo.join(done, "K", "left_anti") if done is not None else todo).collect())
    spark = matrix.sparkSession
    stable, medians = {}, {}
    for k in todo:  # a handful
        unit, labels = cluster_spectra(spectra.filter(F.col("K") == k).drop("K"), k, threshold, seed=seed)
        labels = written(labels, "labels")
        medians[k] = median_matrix(cluster_medians(unit, labels), n_genes)
        stable[k] = similarity.silhouette(unit, labels).agg(F.avg("silhouette")).first()[0]
    sent = spark.sparkContext.broadcast(medians)

    def f(rows: Rows, batch: pd.DataFrame) -> list[np.ndarray]:
        return [np.array([2 * objective(rows, solve_rows(rows, h, "bpp", "frobenius", 1), h, "frobenius") for h in sent.value.values()])]

    errors = summed(matrix, f)[0] if todo and matrix.take(1) else np.zeros(len(todo))
    out = spark.createDataFrame([(k, stable[k], float(e)) for k, e in zip(todo, errors, strict=True)], "K int, silhouette double, prediction_error double")
    return out if done is None else done.select("K", "silhouette", "prediction_error").unionByName(out)


def pca(matrix: DataFrame, n_genes: int, k: int = 50, mean: np.ndarray | None = None, scale: np.ndarray | None = None) -> DataFrame:
    """cell_id, pc: scores of the rows on their first k principal components, uncentred as MLlib has them unless a mean is given.

    mean, scale: of each gene, as prepare_log() returns them, for z-scores. Without a mean the axes are those of the centred rows.
    Rows stay sparse; the largest entry of an axis is positive.
    """
    if mean is None:
        found = summed(matrix, lambda rows, _: [rows.crossed(np.ones((len(rows), 1)), n_genes).ravel(), np.array([len(rows)])])
        centre = found[0] / max(found[1][0], 1) if found else np.zeros(n_genes)
    else:
        centre = mean
    axes, _ = singular_vectors(matrix, n_genes, k, centre, scale)
    d = 1 / np.where(scale > 0, scale, np.inf) if scale is not None else np.ones(n_genes)
    sent = matrix.sparkSession.sparkContext.broadcast((axes * d[:, None], (mean * d) @ axes if mean is not None else np.zeros(axes.shape[1])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        right, off = sent.value
        for pdf in batches:
            yield pd.DataFrame({"cell_id": pdf["cell_id"], "pc": list(Rows.of(pdf["idx"], pdf["val"]).times(right) - off)})

    return matrix.mapInPandas(run, StructType([matrix.schema["cell_id"], StructField("pc", ArrayType(DoubleType()))]))


def cluster_two_runs(left: DataFrame, right: DataFrame, k: int, n_top: int, seed: int = 1) -> DataFrame:
    """a, b, and what top_overlap() has of the programs of two runs (program, gene_id, score), with group_a and group_b: each run's k-means label over its L2-normalised loadings."""
    groups = []
    for run, name in ((left, "a"), (right, "b")):
        genes = run.select("gene_id").distinct().orderBy("gene_id")
        full = run.select("program").distinct().crossJoin(genes).join(run, ["program", "gene_id"], "left")  # loadings are as many
        rows = full.groupBy("program").agg(F.transform(F.array_sort(F.collect_list(F.struct("gene_id", F.coalesce("score", F.lit(0.0)).alias("x")))), lambda x: x["x"].cast("double")).alias("v"))
        size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
        rows = rows.withColumn("s", size).select("program", array_to_vector(F.transform("v", lambda x: x / F.when(F.col("s") > 0, F.col("s")).otherwise(1.0))).alias("features")).orderBy("program")
        model = KMeans(k=k, seed=seed).fit(rows)
        groups.append(model.transform(rows).select(F.col("program").alias(name), F.col("prediction").alias(f"group_{name}")))
    return similarity.top_overlap(left, right, n_top).join(groups[0], "a").join(groups[1], "b")


def locus_windows(genome: DataFrame, loci: DataFrame, width: int) -> DataFrame:
    """seq_name, gene_name, seq: ``width`` bases around each locus centre.

    genome: chromosome, chunk, bases in chunks of equal size. A locus meets the two or more chunks
    that its window touches through their numbers, so the range join is an equi-join.
    """
    size = genome.agg(F.max(F.length("bases")).alias("size"))
    start = F.greatest(F.lit(0), F.floor((F.col("start") + F.col("end")) / 2) - width // 2)
    rows = loci.crossJoin(F.broadcast(size)).withColumn("_s", start)
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("_s") / F.col("size")), F.floor((F.col("_s") + width - 1) / F.col("size")))))
    parts = rows.join(genome, ["chromosome", "chunk"]).withColumn("_o", F.col("chunk") * F.col("size"))
    low = F.greatest(F.col("_s"), F.col("_o"))
    cut = F.substring(F.col("bases"), (low - F.col("_o") + 1).cast("int"), (F.least(F.col("_s") + width, F.col("_o") + F.col("size")) - low).cast("int"))
    parts = parts.withColumn("_p", F.struct("chunk", cut.alias("b")))
    return parts.groupBy("seq_name", "gene_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list("_p")), lambda x: x["b"]), "").alias("seq"))


def scan_motifs(sequences: DataFrame, motifs: dict[str, list[list[float]]], p_max: float = 1e-4, pseudo: float = 0.01) -> DataFrame:
    """seq_name, gene_name, motif, position, strand, score, pval of all windows of either strand with p at most p_max; adj_pval over all hits.

    motifs: rows of A, C, G, T shares by name, a few hundred at most. Scores are log2 odds in
    steps of 1/100; their p-values come from the exact distribution of each motif's score.
    """
    tables = {}
    for name, m in motifs.items():
        odds = np.rint(100 * np.log2((np.array(m) + pseudo) / (1 + 4 * pseudo) / BACKGROUND)).astype(int)
        low = odds.min(1)
        dist = np.ones(1)
        for row, base in zip(odds, low, strict=True):
            step = np.zeros(len(dist) + int((row - base).max()))
            for x in row - base:
                step[x : x + len(dist)] += BACKGROUND * dist
            dist = step
        tables[name] = (odds, int(low.sum()), np.cumsum(dist[::-1])[::-1])
    sent = sequences.sparkSession.sparkContext.broadcast(tables)

    wide = max((len(odds) for odds, _, _ in tables.values()), default=0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = np.full(256, 4, np.int8)
        for i, c in enumerate("ACGT"):
            code[ord(c)] = code[ord(c.lower())] = i
        for pdf in batches:
            # sequences lie one behind the other with a gap that no window crosses
            texts = [(s or "").encode("latin-1", "replace") + b"-" * wide for s in pdf["seq"]]
            ends = np.cumsum([len(t) for t in texts])
            flat = np.frombuffer(b"".join(texts), np.uint8)
            for first in range(0, len(flat), SCANNED):
                x = code[flat[first : first + SCANNED + wide]]
                for motif, (odds, low, tail) in sent.value.items():
                    w, n = len(odds), min(SCANNED, len(x) - len(odds) + 1)
                    if n <= 0:
                        continue
                    clean = np.ones(n, bool)
                    for j in range(w):
                        clean &= x[j : j + n] < 4
                    at = np.flatnonzero(clean)
                    for strand in "+-":
                        s = np.zeros(len(at), odds.dtype)
                        for j in range(w):
                            s += odds[j, x[at + j]] if strand == "+" else odds[j, 3 - x[at + w - 1 - j]]
                        p = tail[s - low]
                        hit = np.flatnonzero(p <= p_max)
                        place = first + at[hit]
                        of = np.searchsorted(ends, place, "right")
                        yield pd.DataFrame({
                            "seq_name": pdf["seq_name"].to_numpy()[of], "gene_name": pdf["gene_name"].to_numpy()[of], "motif": motif,
                            "position": place - np.r_[0, ends][of], "strand": strand, "score": s[hit] / 100, "pval": p[hit],
                        })

    hits = sequences.select("seq_name", "gene_name", "seq").mapInPandas(run, "seq_name string, gene_name string, motif string, position long, strand string, score double, pval double")
    hits = written(hits, "motif-hits")  # adjusting reads them several times
    return benjamini_hochberg_wide(hits, "pval")


def motif_counts(hits: DataFrame, bound: float = 0.05, literal: bool = False) -> DataFrame:
    """gene_name, motif, n of significant hits; literal counts all hits."""
    rows = hits if literal else hits.filter(F.col("adj_pval") <= bound)
    return rows.groupBy("gene_name", "motif").agg(F.count("*").alias("n"))


def _rank_gaps(values: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """Each row's average rank among n genes less that of the genes without a value; rows of zero count as without."""
    rows = values.filter(F.col(value) != 0)
    ranked = positions(rows, [key], value)
    sizes = rows.groupBy(key).agg(F.count("*").alias("_m"), F.count_if(F.col(value) < 0).alias("_low"))
    zeros = n - F.col("_m")
    rank = F.col("below") + (F.col("equal") + 1) / 2 + F.when(F.col(value) > 0, zeros).otherwise(0)
    return ranked.join(sizes, key).withColumn(value, rank - F.col("_low") - (zeros + 1) / 2).drop("below", "equal", "_m", "_low")


def motif_enrichment(loading: DataFrame, counts: DataFrame, genes: DataFrame, num_genes: int | None = None, literal: bool = False, correlation: str = "pearson") -> DataFrame:
    """Correlation of loading and motif count over all genes, per program and motif, BH over all.

    correlation: pearson, spearman or kendall. num_genes: the top so many loadings count as 1, others as 0 (literal: the lowest ones).
    Genes without a loading or a count enter by their number; for kendall, which compares pairs of genes, as rows of each program and motif.
    """
    if correlation not in ("pearson", "spearman", "kendall"):
        raise ValueError("correlation is pearson, spearman or kendall")
    genes = genes.select("gene_id").distinct()
    n = genes.count()
    rows = loading.join(genes, "gene_id", "left_semi").select("program", "gene_id", F.col("score").cast("double").alias("score"))
    if num_genes:
        rows = top_k(rows, ["program"], [F.asc("score") if literal else F.desc("score"), F.asc("gene_id")], num_genes).select("program", "gene_id", F.lit(1.0).alias("score"))
    c = counts.select("gene_id", "motif", F.col("n").cast("double").alias("n")).join(genes, "gene_id", "left_semi")
    if correlation == "kendall":
        grid = rows.select("program").distinct().crossJoin(c.select("motif").distinct()).crossJoin(genes)
        full = grid.join(rows, ["program", "gene_id"], "left").join(c, ["motif", "gene_id"], "left").fillna(0.0, ["score", "n"])
        found = written(kendall(full, "score", "n", ("program", "motif")).filter("stat IS NOT NULL"), "motif-kendall")  # adjusting reads it several times
        return benjamini_hochberg_wide(found, "pval").select("program", "motif", "stat", "pval", "adj_pval")
    if correlation == "spearman":
        rows, c = _rank_gaps(rows, "program", "score", n), _rank_gaps(c, "motif", "n", n)
    rows, c = written(rows, "motif-loading"), written(c, "motif-counts")
    pairs = rows.count() + c.count()
    x = rows.groupBy("program").agg(F.sum("score").alias("sx"), F.sum(F.col("score") * F.col("score")).alias("qx"))
    y = c.groupBy("motif").agg(F.sum("n").alias("sy"), F.sum(F.col("n") * F.col("n")).alias("qy"))
    xy = dealt(rows, pairs, "gene_id").join(dealt(c, pairs, "gene_id"), "gene_id").groupBy("program", "motif").agg(F.sum(F.col("score") * F.col("n")).alias("xy"))
    m = x.crossJoin(y).join(xy, ["program", "motif"], "left").fillna(0.0, ["xy"])
    var = (F.col("qx") - F.col("sx") * F.col("sx") / n) * (F.col("qy") - F.col("sy") * F.col("sy") / n)
    m = m.withColumn("stat", F.when(var > 0, (F.col("xy") - F.col("sx") * F.col("sy") / n) / F.sqrt(var))).filter("stat IS NOT NULL")
    m = m.withColumn("pval", t_p(F.col("stat") * F.sqrt((n - 2) / (1 - F.col("stat") * F.col("stat"))), F.lit(float(n - 2))))
    m = written(m, "motif-tests")  # adjusting reads it several times
    return benjamini_hochberg_wide(m, "pval").select("program", "motif", "stat", "pval", "adj_pval")
