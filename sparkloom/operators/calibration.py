"""Null calibration, conditional randomisation, matched regression and moderated tests."""

from __future__ import annotations

import hashlib
import math
import tempfile
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sparkloom.functions.special import normal_p, normal_two_sided, skew_normal_p, t_p
from sparkloom.operators import similarity
from sparkloom.operators.moderation import local_trend, variance_prior
from sparkloom.operators.similarity import dense
from sparkloom.sources.tables import written

#: Rows of a group that a task holds; larger groups are fitted from sums.
GROUP_ROWS = 1 << 18
#: Cells that wait in a task's memory while it matches; those beyond are in a file.
WAITING = 1 << 16
#: Hex digits of a hash by which cells are counted before any are sorted.
PREFIX = 4


def fake_guides(guides: DataFrame, control: str, runs: int, number_guide: int = 6, seed: int = 42) -> DataFrame:
    """run, guide_name, target: in each run number_guide control guides drawn as 'targeting', the others stay control."""
    own = guides.filter(F.col("target") == control).select("guide_name")
    grid = own.crossJoin(guides.sparkSession.range(runs).select(F.col("id").cast("int").alias("run")))
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("run").cast("string"), F.col("guide_name").cast("string")))
    place = F.row_number().over(W.partitionBy("run").orderBy(draw, "guide_name"))
    return grid.select("run", "guide_name", F.when(place <= number_guide, "targeting").otherwise(control).alias("target"))


def qq(df: DataFrame, keys: list[str], p: str) -> DataFrame:
    """Observed and expected -log10 p, by rank over n + 1."""
    group = W.partitionBy(*keys)
    rank = F.row_number().over(group.orderBy(F.asc(p), *[c for c in df.columns if c not in (*keys, p)]))
    return df.withColumn("expected", -F.log10(rank / (F.count("*").over(group) + 1))).withColumn("observed", -F.log10(F.greatest(F.col(p), F.lit(1e-300))))


def matched_control_groups(guides: DataFrame, assignment: DataFrame, control: str, size: int = 6, bins: int = 10, ensembles: int = 10, seed: int = 42) -> DataFrame:
    """ensemble, group, guide_name: control guides in groups of ``size`` whose mix of frequency bins follows a real target's.

    Guides are binned by their number of cells; within a bin each ensemble shuffles the
    controls by a seeded hash and deals them to the bin's places, round by round.
    """
    n = assignment.filter("n > 0").groupBy("guide_name").agg(F.count("*").alias("cells"))
    binned = guides.join(n, "guide_name").withColumn("bin", F.ntile(bins).over(W.orderBy("cells", "guide_name")))
    controls = binned.filter(F.col("target") == control)
    total = controls.groupBy("bin").agg(F.count("*").alias("have"))
    real = binned.filter(F.col("target") != control)
    places = real.withColumn("slot", F.row_number().over(W.partitionBy("target").orderBy("guide_name"))).filter(F.col("slot") <= size)
    places = places.join(total, "bin").withColumn("turn", F.row_number().over(W.partitionBy("bin").orderBy("target", "slot")) - 1)
    runs = guides.sparkSession.range(ensembles).select(F.col("id").cast("int").alias("ensemble"))
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("ensemble").cast("string"), F.col("guide_name").cast("string")))
    dealt = controls.crossJoin(runs).withColumn("turn", F.row_number().over(W.partitionBy("ensemble", "bin").orderBy(draw, "guide_name")) - 1)
    used = places.filter("turn < have").select("bin", "turn", F.col("target").alias("group"))
    return dealt.join(used, ["bin", "turn"]).select("ensemble", "group", "guide_name")


def ols_effect(scores: DataFrame, treated: DataFrame, keys: list[str], covariate: str | None = None, value: str = "score") -> DataFrame:
    """Coefficient of the treatment indicator per keys and target, with one numeric covariate, from Gram sums.

    treated: cell_id, target. scores: keys, cell_id, value (and covariate) for all cells. The
    sums over all cells are taken once; a target adds those over its own cells.
    """
    y = F.col(value)
    z = F.col(covariate) if covariate else F.lit(0.0)
    whole = scores.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(y).alias("sy"), F.sum(z).alias("sz"), F.sum(z * z).alias("szz"), F.sum(z * y).alias("szy"))
    own = scores.join(treated, "cell_id").groupBy(*keys, "target").agg(F.count("*").alias("m"), F.sum(y).alias("ty"), F.sum(z).alias("tz"))
    s = own.join(whole, keys)
    n, m = F.col("n").cast("double"), F.col("m").cast("double")
    centred = lambda ab, a, b: ab - a * b / n
    tt, ty, tz = centred(m, m, m), centred(F.col("ty"), m, F.col("sy")), centred(F.col("tz"), m, F.col("sz"))
    zz, zy = centred(F.col("szz"), F.col("sz"), F.col("sz")), centred(F.col("szy"), F.col("sz"), F.col("sy"))
    beta = (ty * zz - tz * zy) / F.nullif(tt * zz - tz * tz, F.lit(0.0)) if covariate else ty / F.nullif(tt, F.lit(0.0))
    return s.select(*keys, "target", beta.alias("beta"), F.col("m").alias("n_treated"), F.col("n").alias("n_cells"))


def uniforms(cells: np.ndarray, draws: np.ndarray, seed: int, name: str) -> np.ndarray:
    """A number from [0, 1) for each cell (row) and draw (column), from their numbers, a seed and a name only."""
    key = np.uint64(int.from_bytes(hashlib.sha256(f"{seed}|{name}".encode()).digest()[:8], "big"))
    with np.errstate(over="ignore"):
        x = _mixed(np.asarray(cells).astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ key)[:, None]
        x = _mixed(x + (draws.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53)


def hash_part(cell: int, parts: int = 32) -> int:
    """The group in which a partition's sums are added up first, by the id of a cell of it."""
    return int(_mixed(np.array([cell], np.int64).view(np.uint64))[0] % np.uint64(parts))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums_by(rows: DataFrame, f: Callable[[str, pd.DataFrame], np.ndarray]) -> dict[str, np.ndarray]:
    """Sums over each condition's cells of the array that ``f`` returns for a batch of them; added up per partition, then in two steps. Arrays come to the driver, so they are small."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        part = 0
        for batch in batches:
            part = hash_part(batch["cell_id"].iloc[0]) if len(batch) else part
            for condition, own in batch.groupby("condition"):
                total[condition] = total.get(condition, 0) + f(condition, own)
        for condition, v in total.items():
            yield pd.DataFrame({"condition": [condition], "part": [part], "v": [v.ravel().tolist()]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"condition": [pdf["condition"].iloc[0]], "part": [0], "v": [np.sum(np.stack(pdf["v"].to_list()), axis=0).tolist()]})

    schema = "condition string, part int, v array<double>"
    found = rows.mapInPandas(run, schema).groupBy("condition", "part").applyInPandas(added, schema).groupBy("condition").applyInPandas(added, schema)
    return {r.condition: np.array(r.v) for r in found.collect()}


def _places_of(own: pd.Series, index: dict) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of each target that a cell carries, of those in ``index``."""
    pairs = [(i, index[t]) for i, o in enumerate(own) if o is not None for t in o if t in index]
    at = np.array(pairs, int).reshape(-1, 2)
    return at[:, 0], at[:, 1]


def logistic_all(rows: DataFrame, targets: list[str], k: int, ridge: float = 1.0, rounds: int = 25) -> dict[str, np.ndarray]:
    """Weights (targets x k) of logistic_weights() for every condition and target at once.

    rows: cell_id, condition, x (k numbers), own (targets of the cell). A Newton step is one pass: cells meet the weights of all
    targets of their condition in one product and send Gram sums, so neither cells x targets rows nor a condition's cells come together.
    """
    spark, n = rows.sparkSession, len(targets)
    index = {t: i for i, t in enumerate(targets)}
    penalty = ridge * np.eye(k)
    penalty[0, 0] = 1e-8

    def carried(condition: str, batch: pd.DataFrame) -> np.ndarray:
        row, at = _places_of(batch["own"], index)
        out = np.zeros((n, k))
        np.add.at(out, at, np.array(batch["x"].tolist(), float)[row])
        return out

    labels = {c: v.reshape(n, k) for c, v in _sums_by(rows, carried).items()} if n else {}
    weights = {c: np.zeros((n, k)) for c in labels}
    going = set(labels)
    for _ in range(rounds if going else 0):
        sent = spark.sparkContext.broadcast({c: weights[c] for c in going})

        def grams(condition: str, batch: pd.DataFrame, sent=sent) -> np.ndarray:
            if condition not in sent.value:
                return np.zeros((n, k * k + k))
            x = np.array(batch["x"].tolist(), float)
            out = np.zeros((n, k * k + k))
            square = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
            step = max(1, (1 << 21) // max(1, n))
            for at in range(0, len(x), step):
                p = 1 / (1 + np.exp(-np.clip(x[at : at + step] @ sent.value[condition].T, -30, 30)))
                out += np.c_[(p * (1 - p)).T @ square[at : at + step], p.T @ x[at : at + step]]
            return out

        found = _sums_by(rows, grams)
        sent.unpersist()
        for c in sorted(going):
            v = found[c].reshape(n, k * k + k)
            slope = labels[c] - v[:, k * k :] - weights[c] @ penalty
            step = np.linalg.solve(v[:, : k * k].reshape(n, k, k) + penalty, slope[:, :, None])[:, :, 0]
            weights[c] = weights[c] + step
            if np.abs(step).max(initial=0) < 1e-10:
                going.discard(c)
        if not going:
            break
    return weights


#: Numbers that a task of the randomisation test holds for the targets of one group and one condition.
HELD = 1 << 23


def randomisation_test(clr: DataFrame, cells: DataFrame, treated: DataFrame, covariates: list[str], draws: int = 1024, seed: int = 42) -> DataFrame:
    """Conditional randomisation test per condition and target for every program.

    clr: cell_id, program, clr. A cell's chance of treatment comes from a ridge logistic
    regression on the covariates; labels are drawn ``draws`` times from it and the
    effect is the least-squares coefficient of the label. p = (1 + draws at least as
    large) / (draws + 1), and a skew-normal tail fitted to the draws. condition, target, program, beta, pval, skew_pval.

    Scores stay where they lie: a partition sends sums of labels times scores and covariates, from which the coefficients
    follow, so no task holds a condition. Targets are worked off in groups whose sums have up to HELD numbers for a condition, each with a
    pass of its own. A cell's labels depend on its id, not on its partition.
    """
    spark = clr.sparkSession
    programs = sorted(r[0] for r in clr.select("program").distinct().collect())
    scale = cells.groupBy("condition").agg(F.count("*"), *(f(c).alias(f"{n}_{i}") for i, c in enumerate(covariates) for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    x = [((F.col(c) - F.col(f"m_{i}")) / F.when(F.col(f"s_{i}") > 0, F.col(f"s_{i}")).otherwise(1.0)).cast("double") for i, c in enumerate(covariates)]
    present = cells.join(clr.select("cell_id").distinct(), "cell_id", "left_semi").join(scale, "condition")
    design = present.select("cell_id", "condition", F.array(F.lit(1.0), *x).alias("x"))
    design = design.join(treated.groupBy("cell_id").agg(F.collect_set("target").alias("own")), "cell_id", "left")
    wide = clr.groupBy("cell_id").agg(F.collect_list("program").alias("p"), F.collect_list(F.col("clr").cast("double")).alias("y"))
    rows = written(wide.join(design, "cell_id"), "randomised")
    targets = sorted(r[0] for r in treated.select("target").distinct().collect())
    index, k, n_programs = pd.Index(programs), len(covariates) + 1, len(programs)
    weights = logistic_all(rows, targets, k)
    together = max(1, HELD // ((draws + 1) * (k + n_programs)))
    groups = [targets[at : at + together] for at in range(0, len(targets), together)]

    def both_of(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        y = np.zeros((len(part), n_programs))
        np.add.at(y, (np.repeat(np.arange(len(part)), part["p"].map(len)), index.get_indexer(np.concatenate(part["p"].to_list()))), np.concatenate(part["y"].to_list()))
        x = np.array(part["x"].tolist(), float)
        return x, np.c_[x, y]

    def products(condition: str, part: pd.DataFrame) -> np.ndarray:
        x, both = both_of(part)
        return x.T @ both

    grams = _sums_by(rows, products)
    sent_grams = spark.sparkContext.broadcast(grams)
    schema, keys = "condition string, target string, part int, v array<double>", ["condition", "target"]

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.sum(np.stack(pdf["v"].to_list()), axis=0)
        return pd.DataFrame({"condition": [pdf["condition"].iloc[0]], "target": [pdf["target"].iloc[0]], "part": [0], "v": [v.tolist()]})

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        g = sent_grams.value[pdf["condition"].iloc[0]].reshape(k, -1)
        inverse = np.linalg.pinv(g[:, :k])
        fit = inverse @ g[:, k:]
        v = np.sum(np.stack(pdf["v"].to_list()), axis=0).reshape(draws + 1, -1)
        lx, ly = v[:, :k], v[:, k:]
        size = lx[:, 0] - np.einsum("di,ij,dj->d", lx, inverse, lx)  # a label is 0 or 1, and covariate 0 is 1
        effect = (ly - lx @ fit) / np.where(size > 1e-9, size, np.inf)[:, None]
        beta, null = effect[0], effect[1:]
        mean, sd = null.mean(0), null.std(0)
        skew = np.where(sd > 0, ((null - mean) ** 3).mean(0) / np.where(sd > 0, sd, 1) ** 3, 0)
        pv = (1 + (np.abs(null) >= np.abs(beta) - 1e-12).sum(0)) / (draws + 1)
        return pd.DataFrame({"condition": pdf["condition"].iloc[0], "target": pdf["target"].iloc[0], "program": programs, "beta": beta, "pval": pv, "mean": mean, "sd": sd, "skew": skew})

    out = None
    for group in groups:
        sent = spark.sparkContext.broadcast((group, {c: w[[targets.index(t) for t in group]] for c, w in weights.items()}))

        def sums(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            """By condition and target: sums over cells of label * (covariates, scores), for the true label and each draw."""
            names, of_condition = sent.value
            numbers = {t: i for i, t in enumerate(names)}
            total: dict[tuple, np.ndarray] = {}
            where = 0
            for batch in batches:
                where = hash_part(batch["cell_id"].iloc[0]) if len(batch) else where
                for condition, part in batch.groupby("condition"):
                    x, both = both_of(part)
                    ids = part["cell_id"].to_numpy()
                    t = np.zeros((len(part), len(names)))
                    t[_places_of(part["own"], numbers)] = 1
                    p = 1 / (1 + np.exp(-np.clip(x @ of_condition[condition].T, -30, 30)))
                    for i, target in enumerate(names):
                        drawn = (uniforms(ids, np.arange(draws), seed, f"{condition}|{target}") < p[:, i, None]).T.astype(float)
                        total[condition, target] = total.get((condition, target), 0) + np.r_[t[None, :, i] @ both, drawn @ both]
            for (condition, target), m in total.items():
                yield pd.DataFrame({"condition": [condition], "target": [target], "part": [where], "v": [m.ravel().tolist()]})

        parts = rows.mapInPandas(sums, schema).groupBy(*keys, "part").applyInPandas(added, schema)
        judged = parts.groupBy(*keys).applyInPandas(test, "condition string, target string, program string, beta double, pval double, mean double, sd double, skew double")
        out = judged if out is None else out.unionByName(judged)
    if out is None:
        return spark.createDataFrame([], "condition string, target string, program string, beta double, pval double, skew_pval double")
    return out.withColumn("skew_pval", skew_normal_p("beta", "mean", "sd", "skew")).drop("mean", "sd", "skew")


def logistic_weights(x: np.ndarray, t: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the first column is not penalised."""
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-8
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (t - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-10:
            break
    return w


def logistic(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Fitted chances of that regression."""
    return 1 / (1 + np.exp(-np.clip(x @ logistic_weights(x, t), -30, 30)))


class FreePlaces:
    """Places of sorted scores, of which the nearest free ones are taken.

    Pointers lead over taken places to the next free one on either side, and are shortened as they are followed.
    """

    def __init__(self, scores: np.ndarray):
        self.scores, self.left = scores, len(scores)
        self.up, self.down = list(range(self.left + 1)), list(range(self.left + 1))  # down is shifted by one: down[j + 1] for place j

    @staticmethod
    def _free(next_: list[int], j: int) -> int:
        top = j
        while next_[top] != top:
            top = next_[top]
        while next_[j] != top:
            next_[j], j = top, next_[j]
        return top

    def take(self, wanted: np.ndarray, ratio: int, width: float) -> list[list[tuple[int, float]]]:
        """For each wanted score in turn its up to ``ratio`` nearest free places within ``width``, and their distances; these are then taken."""
        scores, up, down, n = self.scores, self.up, self.down, len(self.scores)
        found = []
        for x, at in zip(wanted.tolist(), np.searchsorted(scores, wanted).tolist(), strict=True):
            mine: list[tuple[int, float]] = []
            while len(mine) < ratio and self.left:
                hi, lo = self._free(up, at), self._free(down, at) - 1
                below = x - scores[lo] if lo >= 0 else np.inf
                above = scores[hi] - x if hi < n else np.inf
                distance = min(below, above)
                if distance == np.inf or distance > width:
                    break
                j = lo if below <= above else hi
                up[j], down[j + 1] = j + 1, j
                self.left -= 1
                mine.append((j, float(distance)))
            found.append(mine)
        return found


def nearest_free(scores: np.ndarray, wanted: np.ndarray, ratio: int, width: float) -> list[list[tuple[int, float]]]:
    """For each wanted score in turn its up to ``ratio`` nearest free places in the sorted ``scores``, and their distances; these are then taken."""
    return FreePlaces(scores).take(wanted, ratio, width)


class Paged:
    """Cells (number, id, number) that wait, in memory up to two pages at either end and beyond that in a file; taken from the end that grew last, or from the first."""

    KIND = np.dtype([("x", "f8"), ("id", "i8"), ("p", "f8")])

    def __init__(self):
        self.first, self.last, self.file, self.pages = deque(), [], None, (0, 0)

    def add(self, cell: tuple[float, int, float]) -> None:
        self.last.append(cell)
        if len(self.last) >= 2 * WAITING:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(self.pages[1] * WAITING * self.KIND.itemsize)
            self.file.write(np.array(self.last[:WAITING], self.KIND).tobytes())
            self.last, self.pages = self.last[WAITING:], (self.pages[0], self.pages[1] + 1)

    def _page(self, i: int) -> list:
        self.file.seek(i * WAITING * self.KIND.itemsize)
        return np.frombuffer(self.file.read(WAITING * self.KIND.itemsize), self.KIND).tolist()

    def top(self) -> tuple[float, int, float] | None:
        if not self.last and self.pages[1] > self.pages[0]:
            self.last, self.pages = self._page(self.pages[1] - 1), (self.pages[0], self.pages[1] - 1)
        return self.last[-1] if self.last else None

    def head(self) -> tuple[float, int, float] | None:
        if not self.first and self.pages[1] > self.pages[0]:
            self.first, self.pages = deque(self._page(self.pages[0])), (self.pages[0] + 1, self.pages[1])
        elif not self.first:
            self.first, self.last = deque(self.last), []
        return self.first[0] if self.first else None


class FallingMatch:
    """The matches of nearest_free() for scores that come sorted: treated and control cells together, by falling score.

    Controls that have passed wait above, the last one nearest. Those taken from below lie without a gap under the treated cell, so the nearest one below
    is the next to come, and treated cells wait for it in turn. ``found``: treated cell and its controls with their distances.
    """

    def __init__(self, ratio: int, width: float):
        self.ratio, self.width, self.above, self.waiting, self.mine, self.found = ratio, width, Paged(), Paged(), [], []

    def _next(self) -> None:
        if self.mine:
            self.found.append((self.waiting.first[0], self.mine))
        self.waiting.first.popleft()
        self.mine = []

    def _settle(self, control: tuple[float, int, float] | None) -> tuple[float, int, float] | None:
        """Treated cells in turn take from above, or this next control below them; the control if none takes it."""
        while own := self.waiting.head():
            up = self.above.top()
            above = up[0] - own[0] if up else np.inf
            below = own[0] - control[0] if control else np.inf
            distance = min(above, below)
            if distance == np.inf or distance > self.width:
                self._next()
                continue
            taken = control if below <= above else self.above.last.pop()
            self.mine.append((taken, distance))
            if len(self.mine) == self.ratio:
                self._next()
            if taken is control:
                return None
        return control

    def control(self, cell: tuple[float, int, float]) -> None:
        if self._settle(cell):
            self.above.add(cell)

    def treated(self, cell: tuple[float, int, float]) -> None:
        self.waiting.add(cell)

    def end(self) -> None:
        self._settle(None)


def _logistic_by_group(rows: DataFrame, n: int, k: int, ridge: float = 1.0, rounds: int = 25, penalty: np.ndarray | None = None) -> np.ndarray:
    """Weights (groups x k) of logistic_weights() for every group at once; rows: _g (its number), treated, _x (k numbers).

    A Newton step is one aggregate over the rows, so a group may have any size. penalty: a matrix for each group in place of the ridge.
    """
    weights, going = np.zeros((n, k)), np.arange(n)
    if penalty is None:
        one = ridge * np.eye(k)
        one[0, 0] = 1e-8
        penalty = np.repeat(one[None], n, axis=0)
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    x = [F.get("_x", F.lit(i)) for i in range(k)]
    for _ in range(rounds):
        if not len(going):
            break
        sent = rows.sparkSession.createDataFrame([(int(g), weights[g].tolist()) for g in going], "_g int, _w array<double>")
        z = sum((x[i] * F.get("_w", F.lit(i)) for i in range(1, k)), x[0] * F.get("_w", F.lit(0)))
        chance = rows.join(F.broadcast(sent), "_g").withColumn("_p", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z)))))
        p = F.col("_p")
        squares = [F.sum(p * (1 - p) * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in upper]
        found = chance.groupBy("_g").agg(*squares, *(F.sum((F.col("treated") - p) * x[i]).alias(f"s{i}") for i in range(k))).collect()
        h, slope = np.zeros((n, k, k)), np.zeros((n, k))
        for r in found:
            for i, j in upper:
                h[r["_g"], i, j] = h[r["_g"], j, i] = r[f"h{i}_{j}"]
            slope[r["_g"]] = [r[f"s{i}"] for i in range(k)]
        slope[going] -= np.einsum("gij,gj->gi", penalty[going], weights[going])
        step = np.linalg.solve(h[going] + penalty[going], slope[going][:, :, None])[:, :, 0]
        weights[going] += step
        going = going[np.abs(step).max(1) >= 1e-10]
    return weights


def _shortened(v: float) -> float:
    """Ten digits, in which the order of a sum doesn't show."""
    return float(f"{v:.10g}")


def match(cells: DataFrame, keys: list[str], covariates: list[str], ratio: int = 4, caliper: float | None = None, seed: int = 42, max_controls: int | None = None) -> DataFrame:
    """Nearest propensity matching without replacement, per keys.

    cells: keys, cell_id, treated (0/1), covariates. All controls take part, unless the caller has those beyond max_controls
    thinned by a seeded hash. Treated cells choose in order of falling propensity; a caliper is in
    standard deviations of the logit. keys, cell_id, treated, pair, weight, distance, propensity.

    Propensities come from sums of all groups at once. A task gets its groups sorted, and cells of both sides pass by in batches, by falling propensity;
    those that wait for a partner beyond WAITING are in a file of the task, so a group may have any size.
    """
    spark = cells.sparkSession
    rows = cells.select(*keys, "cell_id", F.col("treated").cast("int").alias("treated"), *(F.col(c).cast("double").alias(c) for c in covariates))
    if max_controls is not None:
        place = F.row_number().over(W.partitionBy(*keys).orderBy(_draw(seed), "cell_id"))
        thinned = rows.filter("treated <> 1").withColumn("_k", place).filter(F.col("_k") <= max_controls).drop("_k")
        rows = rows.filter("treated = 1").unionByName(thinned)
    rows = written(rows, "match-rows")
    k = len(covariates) + 1
    # two numbers a covariate and group come to the driver
    scale = rows.groupBy(*keys).agg(*(f(c).alias(f"{n}{i}") for i, c in enumerate(covariates) for n, f in (("m", F.avg), ("s", F.stddev_pop))), F.count("*").alias("n")).collect()
    numbered = [(i, *(r[c] for c in keys), [_shortened(r[f"m{j}"]) for j in range(k - 1)], [_shortened(r[f"s{j}"]) or 1.0 for j in range(k - 1)]) for i, r in enumerate(scale)]
    groups = spark.createDataFrame(numbered, f"_g int, {', '.join(f'_key{i} {cells.schema[c].dataType.simpleString()}' for i, c in enumerate(keys))}, _m array<double>, _s array<double>")
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_key{i}"))
    x = F.array(F.lit(1.0), *((F.col(c) - F.get("_m", F.lit(j))) / F.get("_s", F.lit(j)) for j, c in enumerate(covariates)))
    rows = rows.join(F.broadcast(groups), same).select("_g", "cell_id", "treated", x.alias("_x"))
    weights = _logistic_by_group(rows, len(numbered), k)
    sent = spark.createDataFrame([(i, [*map(_shortened, w.tolist())]) for i, w in enumerate(weights)], "_g int, _w array<double>")
    z = F.aggregate(F.zip_with("_x", "_w", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    rows = rows.join(F.broadcast(sent), "_g").withColumn("_p", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z)))))
    rows = rows.select("_g", "cell_id", "treated", F.col("_p").alias("propensity"), F.log(F.col("_p") / (1 - F.col("_p"))).alias("_logit"))
    width = {}
    if caliper is not None:
        width = {r["_g"]: caliper * r["s"] for r in rows.groupBy("_g").agg(F.stddev_pop("_logit").alias("s")).collect()}

    columns = ["_g", "cell_id", "treated", "pair", "weight", "distance", "propensity"]

    def pairs(g: int, found: list) -> pd.DataFrame:
        out = []
        for (_, own, p), mine in found:
            out.append((g, own, 1, own, 1.0, 0.0, p))
            out += [(g, other, 0, own, 1 / len(mine), d, q) for (_, other, q), d in mine]
        return pd.DataFrame(out, columns=columns)

    def ended(g: int | None, going: FallingMatch | None) -> Iterator[pd.DataFrame]:
        if going:
            going.end()
            if going.found:
                yield pairs(g, going.found)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, going = None, None
        for batch in batches:
            for g, part in batch.groupby("_g", sort=False):
                if g != now:
                    yield from ended(now, going)
                    now, going = g, FallingMatch(ratio, width.get(g, np.inf))
                for side, *cell in zip(*(part[c].tolist() for c in ("treated", "_logit", "cell_id", "propensity")), strict=True):
                    (going.treated if side == 1 else going.control)(tuple(cell))
                if going.found:
                    yield pairs(g, going.found)
                    going.found = []
        yield from ended(now, going)

    # by falling propensity; of equal ones the controls first, from the largest id, and treated cells from the smallest
    order = [F.desc("_logit"), "treated", F.when(F.col("treated") == 1, F.col("cell_id")).otherwise(-F.col("cell_id"))]
    dealt = rows.repartition("_g").sortWithinPartitions("_g", *order)
    found = dealt.mapInPandas(run, "_g int, cell_id long, treated int, pair long, weight double, distance double, propensity double")
    names = groups.select("_g", *(F.col(f"_key{i}").alias(c) for i, c in enumerate(keys)))
    return written(found.join(F.broadcast(names), "_g").select(*keys, "cell_id", "treated", "pair", "weight", "distance", "propensity"), "matched")


def _draw(seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("cell_id").cast("string")))


def balance(cells: DataFrame, keys: list[str], covariates: list[str], bound: float = 0.1, weight: str | None = None) -> DataFrame:
    """Standardised mean difference (pooled deviation) and variance ratio of each covariate."""
    long = cells.withColumn("_w", F.col(weight) if weight else F.lit(1.0)).unpivot([*keys, "treated", "_w"], covariates, "covariate", "x")
    w, x = F.col("_w"), F.col("x")
    side = lambda t: F.col("treated") == t
    s = long.groupBy(*keys, "covariate").agg(*(f.alias(f"{n}{t}") for t in (0, 1) for n, f in (("w", F.sum(F.when(side(t), w))), ("s", F.sum(F.when(side(t), w * x))), ("q", F.sum(F.when(side(t), w * x * x))))))
    some = lambda x: F.nullif(x, F.lit(0.0))  # constant covariates and single cells have null statistics
    mean = lambda t: F.col(f"s{t}") / some(F.col(f"w{t}"))
    var = lambda t: (F.col(f"q{t}") - F.col(f"s{t}") * mean(t)) / some(F.col(f"w{t}") - 1)
    smd = (mean(1) - mean(0)) / some(F.sqrt(F.greatest(F.lit(0.0), (var(1) + var(0)) / 2)))
    return s.select(*keys, "covariate", smd.alias("smd"), (var(1) / some(var(0))).alias("variance_ratio"), (F.abs(smd) < bound).alias("balanced"))


def collinear_pairs(df: DataFrame, columns: list[str], bound: float = 0.95) -> DataFrame:
    """a, b, r, dropped: correlations of all pairs of columns, in one pass; dropped: b goes, as its |r| with a column that stays is above the bound."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    r = df.agg(*(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs)).first() if pairs else {}
    kept: list[str] = []
    for c in columns:
        if all(abs(r[f"{a}|{c}"] or 0) <= bound for a in kept):
            kept.append(c)
    rows = [(a, b, r[f"{a}|{b}"], b not in kept) for a, b in pairs]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double, dropped boolean")


def prune_collinear(df: DataFrame, columns: list[str], bound: float = 0.95) -> list[str]:
    """Columns left when the later of each pair with |r| above the bound goes, in column order."""
    gone = {r.b for r in collinear_pairs(df, columns, bound).filter("dropped").collect()}
    return [c for c in columns if c not in gone]


def _beside(rows: DataFrame, keys: list[str], other: DataFrame) -> DataFrame:
    """Rows with the other columns of the row of ``other`` that has their keys; null is a key, too."""
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & rows[c].eqNullSafe(F.col(f"_key{i}"))
    named = other.select(*(F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)), *(c for c in other.columns if c not in keys))
    return rows.join(named, same).drop(*(f"_key{i}" for i in range(len(keys))))


def standardised(rows: DataFrame, keys: list[str], covariates: list[str]) -> DataFrame:
    """Rows with _x2, _x3, ...: the covariates by the mean _m and deviation _s (1 for constant ones) of their key, and its rows _n."""
    stats = rows.groupBy(*keys).agg(F.count("*").alias("_n"), *(f(c).alias(f"{n}{j}") for j, c in enumerate(covariates, 2) for n, f in (("_m", F.avg), ("_s", F.stddev_pop))))
    stats = written(stats.withColumns({f"_s{j}": F.when(F.col(f"_s{j}") > 0, F.col(f"_s{j}")).otherwise(1.0) for j in range(2, 2 + len(covariates))}), "covariate-scales")
    return _beside(rows, keys, stats).withColumns({f"_x{j}": (F.col(c) - F.col(f"_m{j}")) / F.col(f"_s{j}") for j, c in enumerate(covariates, 2)})


def _inverse(h: np.ndarray, mean: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pseudo-inverse of a matrix of products of 1, the treatment and standardised covariates; where coefficients aren't determined, it takes
    those that are smallest for the covariates as they were, with these means and deviations."""
    values, vectors = np.linalg.eigh(h)
    some = values > 1e-14 * values[-1]
    inv = (vectors[:, some] / values[some]) @ vectors[:, some].T
    if some.all():
        return inv
    to = np.eye(len(h))  # coefficients of the covariates as they were
    to[2:, 2:] = np.diag(1 / size)
    to[0, 2:] = -mean / size
    free = to @ vectors[:, ~some]
    back = np.linalg.solve(to, (np.eye(len(h)) - free @ np.linalg.pinv(free)) @ to)
    return back @ inv @ back.T


def weighted_ols(matched: DataFrame, keys: list[str], value: str, covariates: list[str], cluster: str | None = "pair") -> DataFrame:
    """Treatment coefficient per keys with its robust error: clustered by pair (CR1), else HC3. keys, beta, se, stat, pval, n.

    From sums over rows and clusters, so a key may have any number of rows; covariates are standardised, which the coefficient doesn't show.
    """
    k = 2 + len(covariates)
    columns = {"_y": value, "_w": "weight", "_x1": "treated"} | {f"_c{j}": c for j, c in enumerate(covariates, 2)}
    rows = matched.select(*keys, *(F.col(c).cast("double").alias(n) for n, c in columns.items()), *([F.col(cluster).alias("_cluster")] if cluster else []))
    rows = standardised(written(rows, "ols-rows"), keys, [f"_c{j}" for j in range(2, k)])
    x = [F.lit(1.0), *(F.col(f"_x{i}") for i in range(1, k))]
    w, y = F.col("_w"), F.col("_y")
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    sums = rows.groupBy(*keys).agg(F.first("_n").alias("n"), F.array(*(F.first(f"_{c}{j}") for c in "ms" for j in range(2, k))).cast("array<double>").alias("_ms"), F.array(*(F.sum(w * x[i] * x[j]) for i, j in upper), *(F.sum(w * x[i] * y) for i in range(k))).alias("_v"))

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = []
            for v, ms in zip(batch.pop("_v"), batch.pop("_ms"), strict=True):
                h = np.zeros((k, k))
                for (i, j), one in zip(upper, v, strict=False):
                    h[i, j] = h[j, i] = one
                inv = _inverse(h, *np.array(ms, float).reshape(2, -1))
                both.append(np.r_[inv @ v[len(upper) :], inv.ravel()].tolist())
            yield batch.assign(_fit=both)

    kinds = ", ".join(f"`{c}` {matched.schema[c].dataType.simpleString()}" for c in keys)
    fits = written(sums.mapInPandas(solved, f"{kinds}, n long, _fit array<double>"), "ols-fits")  # coefficients, then the inverse
    fit = lambda i: F.get("_fit", F.lit(i))
    rows = _beside(rows, keys, fits.drop("n"))
    e = w * (y - sum((fit(i) * x[i] for i in range(1, k)), fit(0)))
    if cluster:
        own = rows.groupBy(*keys, "_cluster").agg(*(F.sum(x[i] * e).alias(f"_u{i}") for i in range(k)))
        g, n = F.col("_g"), F.col("n")
        scale = g / F.greatest(F.lit(1), g - 1) * (n - 1) / F.greatest(F.lit(1), n - k)
    else:
        lever = w * sum((fit(k + k * i + j) * x[i] * x[j] for i in range(k) for j in range(k)), F.lit(0.0))
        rest = 1 - F.greatest(F.lit(0.0), F.least(lever, F.lit(1 - 1e-9)))
        own, scale = rows.select(*keys, *((x[i] * e / rest).alias(f"_u{i}") for i in range(k))), F.lit(1.0)
    # the middle matrix meets the treatment's row of the inverse on either side
    meat = own.groupBy(*keys).agg(F.count("*").alias("_g"), *(F.sum(F.col(f"_u{i}") * F.col(f"_u{j}")).alias(f"_h{i}_{j}") for i, j in upper))
    side = sum((fit(2 * k + i) * fit(2 * k + j) * F.col(f"_h{i}_{j}") * (1 if i == j else 2) for i, j in upper), F.lit(0.0))
    se = F.sqrt(F.greatest(F.lit(0.0), side * scale))
    out = _beside(fits, keys, meat).select(*keys, fit(1).alias("beta"), se.alias("se"), "n")
    stat = F.when(F.col("se") > 0, F.col("beta") / F.col("se"))
    return out.withColumn("stat", stat).withColumn("pval", normal_p("stat")).select(*keys, "beta", "se", "stat", "pval", "n")


def hurdle(matched: DataFrame, keys: list[str], value: str, covariates: list[str]) -> DataFrame:
    """Two-part model: a logit of being positive and least squares of log1p(1e6 y) among the positive; average marginal effect on their product with its delta-method error.

    A task holds groups of up to GROUP_ROWS rows; larger ones are fitted from sums.
    """
    kinds = ", ".join(f"`{k}` {matched.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, logit double, positive double, ame double, se double, pval double"

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        y = np.log1p(1e6 * pdf[value].to_numpy(float))
        t = pdf["treated"].to_numpy(float)
        c = pdf[covariates].to_numpy(float) if covariates else np.zeros((len(pdf), 0))
        x = np.c_[np.ones(len(pdf)), t, c]
        pos = y > 0
        w = np.zeros(x.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            info = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(x.shape[1])
            w = w + np.linalg.solve(info, x.T @ (pos - p) - 1e-6 * w)
        cov_w = np.linalg.inv(info)
        xp = x[pos]
        inv = np.linalg.pinv(xp.T @ xp)
        b = inv @ (xp.T @ y[pos])
        s2 = ((y[pos] - xp @ b) ** 2).sum() / max(1, pos.sum() - x.shape[1])
        on, off = x.copy(), x.copy()
        on[:, 1], off[:, 1] = 1, 0
        sig = lambda m: 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        p1, p0, m1, m0 = sig(on), sig(off), on @ b, off @ b
        ame = (p1 * m1 - p0 * m0).mean()
        gw = ((p1 * (1 - p1) * m1)[:, None] * on - (p0 * (1 - p0) * m0)[:, None] * off).mean(0)
        gb = (p1[:, None] * on - p0[:, None] * off).mean(0)
        se = float(np.sqrt(max(0.0, gw @ cov_w @ gw + gb @ (inv * s2) @ gb)))
        return pd.DataFrame([[*pdf[keys].iloc[0], float(w[1]), float(b[1]), float(ame), se, float(normal_two_sided(ame / se)) if se > 0 else np.nan]], columns=[*keys, "logit", "positive", "ame", "se", "pval"])

    matched = matched.select(*keys, value, "treated", *covariates)
    large = [tuple(r[c] for c in keys) for r in matched.groupBy(*keys).count().filter(F.col("count") > GROUP_ROWS).collect()]
    if not large:
        return matched.groupBy(*keys).applyInPandas(fit, schema)
    names = matched.sparkSession.createDataFrame([(*g, i) for i, g in enumerate(large)], f"{kinds}, _g int")
    same = F.lit(True)
    for c in keys:
        same = same & matched[c].eqNullSafe(names[c])
    small = matched.join(F.broadcast(names), same, "left_anti").groupBy(*keys).applyInPandas(fit, schema)
    return small.unionByName(_hurdle_from_sums(_beside(matched, keys, names), names, keys, value, covariates))


def _hurdle_from_sums(rows: DataFrame, names: DataFrame, keys: list[str], value: str, covariates: list[str]) -> DataFrame:
    """hurdle() of groups numbered _g, of any size. Covariates are standardised, and the penalty is turned with them."""
    k = 2 + len(covariates)
    columns = {"_y": F.log1p(F.col(value) * 1e6), "_x1": F.col("treated")} | {f"_c{j}": F.col(c) for j, c in enumerate(covariates, 2)}
    rows = standardised(written(rows.select("_g", *(c.cast("double").alias(n) for n, c in columns.items())), "hurdle-rows"), ["_g"], [f"_c{j}" for j in range(2, k)])
    x = [F.lit(1.0), *(F.col(f"_x{i}") for i in range(1, k))]
    y, positive = F.col("_y"), (F.col("_y") > 0).cast("double")
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    scales = [F.first(f"_{c}{j}").alias(f"{c}{j}") for c in "ms" for j in range(2, k)]
    squares = lambda w: [F.sum(w * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in upper]
    sums = rows.groupBy("_g").agg(*scales, F.first("_n").alias("n"), F.sum(positive).alias("n_positive"), *squares(positive), *(F.sum(positive * x[i] * y).alias(f"v{i}") for i in range(k))).orderBy("_g").collect()
    n, spark = len(sums), rows.sparkSession

    def matrix(r) -> np.ndarray:
        h = np.zeros((k, k))
        for i, j in upper:
            h[i, j] = h[j, i] = r[f"h{i}_{j}"]
        return h

    mean, size = (np.array([[r[f"{c}{j}"] for j in range(2, k)] for r in sums], float).reshape(n, k - 2) for c in "ms")
    to = np.repeat(np.eye(k)[None], n, axis=0)  # coefficients of the covariates as they were
    for j in range(2, k):
        to[:, j, j], to[:, 0, j] = 1 / size[:, j - 2], -mean[:, j - 2] / size[:, j - 2]
    penalty = 1e-6 * np.einsum("gji,gjk->gik", to, to)
    inverse = [_inverse(matrix(r), mean[i], size[i]) for i, r in enumerate(sums)]
    b = np.array([inv @ [r[f"v{i}"] for i in range(k)] for inv, r in zip(inverse, sums, strict=True)])
    weights = _logistic_by_group(rows.select("_g", positive.alias("treated"), F.array(*x).alias("_x")), n, k, penalty=penalty)
    sent = spark.createDataFrame([(g, u.tolist(), v.tolist()) for g, (u, v) in enumerate(zip(weights, b, strict=True))], "_g int, _u array<double>, _b array<double>")
    at = lambda c, t: sum((F.get(c, F.lit(i)) * x[i] for i in range(2, k)), F.get(c, F.lit(0)) + (F.get(c, F.lit(1)) * t if t is not None else 0.0))
    chance = lambda z: 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    treated = F.col("_x1")
    rows = rows.join(F.broadcast(sent), "_g").withColumns({"_p": chance(at("_u", treated)), "_p1": chance(at("_u", F.lit(1.0))), "_p0": chance(at("_u", None)), "_m1": at("_b", F.lit(1.0)), "_m0": at("_b", None), "_f": at("_b", treated)})
    p, p1, p0, m1, m0 = (F.col(c) for c in ("_p", "_p1", "_p0", "_m1", "_m0"))
    side = lambda i, on: x[i] if i != 1 else F.lit(1.0 if on else 0.0)
    slopes = [F.avg(p1 * (1 - p1) * m1 * side(i, True) - p0 * (1 - p0) * m0 * side(i, False)).alias(f"u{i}") for i in range(k)] + [F.avg(p1 * side(i, True) - p0 * side(i, False)).alias(f"b{i}") for i in range(k)]
    last = rows.groupBy("_g").agg(*squares(p * (1 - p)), *slopes, F.avg(p1 * m1 - p0 * m0).alias("ame"), F.sum(positive * (y - F.col("_f")) * (y - F.col("_f"))).alias("rest")).orderBy("_g").collect()
    out = []
    for g, r in enumerate(last):
        gu, gb = (np.array([r[f"{c}{i}"] for i in range(k)]) for c in "ub")
        s2 = r["rest"] / max(1, sums[g]["n_positive"] - k)
        se = float(np.sqrt(max(0.0, gu @ np.linalg.inv(matrix(r) + penalty[g]) @ gu + s2 * gb @ inverse[g] @ gb)))
        out.append((g, float(weights[g, 1]), float(b[g, 1]), r["ame"], se, float(normal_two_sided(r["ame"] / se)) if se > 0 else None))
    fits = spark.createDataFrame(out, "_g int, logit double, positive double, ame double, se double, pval double")
    return fits.join(F.broadcast(names), "_g").select(*keys, "logit", "positive", "ame", "se", "pval")


def gene_effects(usage: DataFrame, loading: DataFrame, betas: DataFrame, pseudo: float = 1.0) -> DataFrame:
    """Mean over cells of log(counterfactual / observed expression) of each gene when programs change by their betas.

    Q = pseudo + 1e6 * score; observed Q W, counterfactual Q e^beta W. Negative scores or loadings are an error.
    Cells meet W where they lie and only sums per gene leave a task. W of more than DENSE_ENTRIES numbers is sent in parts of the
    genes, each with a pass over the cells; only if a single gene's loadings are beyond that, they are joined.
    """
    ok = lambda c: F.when(F.col(c) < 0, F.raise_error(F.lit(f"negative {c}")).cast("double")).otherwise(F.col(c))
    q = usage.select("cell_id", "program", (F.lit(pseudo) + 1e6 * ok("score")).alias("q"))
    w = loading.select("program", "gene_id", ok("score").alias("w"))
    grown = w.join(betas.select("program", "beta"), "program", "left").select("program", "gene_id", "w", (F.exp(F.coalesce("beta", F.lit(0.0))) * F.col("w")).alias("v"))
    small = dense(grown, "program", "gene_id", ["w", "v"])
    rows = q.groupBy("cell_id").agg(F.collect_list("program").alias("p"), F.collect_list("q").alias("q")).select("p", "q")
    if small is not None:
        return _mean_changes(rows, *small)
    grown, rows = written(grown, "effect-loadings"), written(rows, "effect-cells")
    size = grown.agg(F.count_distinct("program").alias("k"), F.count_distinct("gene_id").alias("n")).first()
    if 2 * size.k > similarity.DENSE_ENTRIES:
        s = q.join(grown, "program").groupBy("cell_id", "gene_id").agg(F.sum(F.col("q") * F.col("w")).alias("o"), F.sum(F.col("q") * F.col("v")).alias("c"))
        return s.filter("o > 0 AND c > 0").groupBy("gene_id").agg(F.avg(F.log(F.col("c") / F.col("o"))).alias("effect"))
    todo, out = [(2, 1), (2, 0)], None
    while todo:  # a part of the genes that is too large for one matrix is halved
        parts, i = todo.pop()
        small = dense(grown.filter(F.pmod(F.xxhash64("gene_id"), F.lit(parts)) == i), "program", "gene_id", ["w", "v"])
        if small is None:
            todo += [(2 * parts, i + parts), (2 * parts, i)]
        elif small[1]:
            found = _mean_changes(rows, *small)
            out = found if out is None else out.unionByName(found)
    return out


def _mean_changes(rows: DataFrame, programs: list, genes: list, matrices: list[np.ndarray]) -> DataFrame:
    """gene_id, effect: mean over cells (p, q) of the log of the second matrix's expression over the first's."""
    now, then = matrices
    spark = rows.sparkSession
    sent, index = spark.sparkContext.broadcast((now, then)), pd.Index(programs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, then = sent.value
        total, n = np.zeros(now.shape[1]), np.zeros(now.shape[1], np.int64)
        step = max(1, (1 << 21) // max(1, now.shape[1]))
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.iloc[at : at + step]
                owner = np.repeat(np.arange(len(part)), part["p"].map(len))
                which = index.get_indexer(np.concatenate(part["p"].to_list()))
                amount = np.zeros((len(part), len(index)))
                np.add.at(amount, (owner[which >= 0], which[which >= 0]), np.concatenate(part["q"].to_list())[which >= 0])
                o, c = amount @ now, amount @ then
                both = (o > 0) & (c > 0)
                total += np.log(np.divide(c, o, out=np.ones_like(o), where=both)).sum(0)
                n += both.sum(0)
        yield pd.DataFrame({"at": np.arange(len(n)), "total": total, "n": n})

    sums = rows.mapInPandas(run, "at long, total double, n long").groupBy("at").agg((F.sum("total") / F.sum("n")).alias("effect"), F.sum("n").alias("n"))
    names = spark.createDataFrame(pd.DataFrame({"at": np.arange(len(genes)), "gene_id": genes}))
    return sums.filter("n > 0").join(names, "at").select("gene_id", "effect")


def refit(scores: DataFrame, labels: DataFrame, value: str = "score") -> DataFrame:
    """Mean difference treated less control per draw and program. labels: draw, cell_id, treated, weight."""
    s = scores.join(labels, "cell_id").groupBy("draw", "program").agg(
        (F.sum(F.when(F.col("treated") == 1, F.col("weight") * F.col(value))) / F.nullif(F.sum(F.when(F.col("treated") == 1, F.col("weight"))), F.lit(0.0))).alias("m1"),
        (F.sum(F.when(F.col("treated") == 0, F.col("weight") * F.col(value))) / F.nullif(F.sum(F.when(F.col("treated") == 0, F.col("weight"))), F.lit(0.0))).alias("m0"),
    )
    return s.select("draw", "program", (F.col("m1") - F.col("m0")).alias("beta"))


def _hash(draw: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), draw.cast("string"), F.col("cell_id").cast("string")))


def permuted_labels(cells: DataFrame, draws: int, seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """keys, cell_id, treated, on, off: arrays over the draws of a cell's weight as a treated one and as a control.

    A draw treats as many cells of a key as are treated, those with its smallest hashes. Its largest such hash is found by counts of hash
    prefixes and a sort of the cells of one prefix, so no task sorts all cells.
    """
    keys = keys or []
    n = cells.groupBy(*keys).agg(F.coalesce(F.sum("treated"), F.lit(0)).cast("long").alias("_n"))
    with_ = lambda df, other: df.join(other, keys) if keys else df.join(other, how="cross")
    grid = cells.select(*keys, "cell_id", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw")).withColumn("_h", _hash(F.col("draw"), seed)).withColumn("_prefix", F.substring("_h", 1, PREFIX))
    counts = grid.groupBy(*keys, "draw", "_prefix").count()
    upto = F.sum("count").over(W.partitionBy(*keys, "draw").orderBy("_prefix").rowsBetween(W.unboundedPreceding, W.currentRow))
    edge = with_(counts.withColumn("_upto", upto), n).filter("_n > 0 AND _upto >= _n AND _upto - count < _n").select(*keys, "draw", "_prefix", (F.col("_n") - F.col("_upto") + F.col("count")).alias("_k"))
    place = F.row_number().over(W.partitionBy(*keys, "draw").orderBy("_h", "cell_id"))
    last = grid.join(edge, [*keys, "draw", "_prefix"]).withColumn("_place", place).filter("_place = _k").select(*keys, "draw", F.struct("_h", "cell_id").alias("last"))
    ends = last.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("draw", "last"))).alias("_ends"))  # a row a key, an entry a draw
    drawn = lambda d: F.coalesce(F.struct(_hash(d, seed).alias("_h"), F.col("cell_id")) <= F.try_element_at("_ends", d), F.lit(False)).cast("double")
    on = F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), drawn)
    own = cells.select(*keys, "cell_id", "treated")
    rows = (own.join(ends, keys, "left") if keys else own.join(F.broadcast(ends), how="cross")).select(*keys, "cell_id", "treated", on.alias("on"))
    return rows.withColumn("off", F.transform("on", lambda x: 1 - x))


def bootstrap_labels(cells: DataFrame, draws: int, seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """keys, cell_id, treated, on, off: as permuted_labels, with the Poisson(1) weights of a bootstrap, each from a seeded hash of draw and cell."""
    cdf = [sum(np.exp(-1) / np.prod(range(1, j + 1)) for j in range(k + 1)) for k in range(9)]

    def weight(d: Column) -> Column:
        u = F.conv(F.substring(_hash(d, seed), 1, 8), 16, 10).cast("double") / 4294967296.0
        return sum(((u >= c).cast("double") for c in cdf), F.lit(0.0))

    keys = keys or []
    rows = cells.select(*keys, "cell_id", "treated", F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), weight).alias("w"))
    own = lambda side: F.when(F.col("treated") == side, F.col("w")).otherwise(F.transform("w", lambda x: x * 0.0))
    return rows.select(*keys, "cell_id", "treated", own(1).alias("on"), own(0).alias("off"))


def refit_draws(scores: DataFrame, labels: DataFrame, value: str = "score") -> DataFrame:
    """draw, program, beta: mean difference treated less control under each draw's weights.

    Scores stay with their cells; a partition sends four sums for each draw and program.
    """
    programs = sorted(r[0] for r in scores.select("program").distinct().collect())
    index = pd.Index(programs)
    rows = scores.groupBy("cell_id").agg(F.collect_list("program").alias("p"), F.collect_list(F.col(value).cast("double")).alias("y")).join(labels, "cell_id").select("p", "y", "on", "off")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0
        for batch in batches:
            at = (np.repeat(np.arange(len(batch)), batch["p"].map(len)), index.get_indexer(np.concatenate(batch["p"].to_list())))
            y, there = np.zeros((len(batch), len(index))), np.zeros((len(batch), len(index)))
            np.add.at(y, at, np.concatenate(batch["y"].to_list()))
            np.add.at(there, at, 1)
            on, off = np.array(batch["on"].tolist(), float).T, np.array(batch["off"].tolist(), float).T
            total = total + np.stack([on @ y, on @ there, off @ y, off @ there], -1)
        if isinstance(total, np.ndarray):
            draw, program = np.indices(total.shape[:2]).reshape(2, -1)
            yield pd.DataFrame(total.reshape(-1, 4), columns=["s1", "n1", "s0", "n0"]).assign(draw=draw, program=np.array(programs, object)[program])

    sums = rows.mapInPandas(run, "draw int, program string, s1 double, n1 double, s0 double, n0 double").groupBy("draw", "program").agg(*(F.sum(c).alias(c) for c in ("s1", "n1", "s0", "n0")))
    mean = lambda s, n: F.col(s) / F.when(F.col(n) > 0, F.col(n))
    return sums.select("draw", "program", (mean("s1", "n1") - mean("s0", "n0")).alias("beta"))


def permutation_bias(scores: DataFrame, cells: DataFrame, draws: int = 100, seed: int = 42) -> DataFrame:
    """Mean effect per program over label shuffles, to be subtracted."""
    return refit_draws(scores, permuted_labels(cells, draws, seed)).groupBy("program").agg(F.avg("beta").alias("bias"))


def bootstrap_effects(scores: DataFrame, cells: DataFrame, draws: int = 500, seed: int = 42) -> DataFrame:
    """program, beta, se, stat, pval: the effect with its bootstrap deviation."""
    own = refit(scores, cells.select("cell_id", "treated", F.lit(1.0).alias("weight"), F.lit(0).alias("draw"))).select("program", "beta")
    se = refit_draws(scores, bootstrap_labels(cells, draws, seed)).groupBy("program").agg(F.stddev_samp("beta").alias("se"))
    z = F.col("beta") / F.nullif("se", F.lit(0.0))
    return own.join(se, "program").withColumn("stat", z).withColumn("pval", normal_p(z))


def gene_sums(expr: DataFrame, cells: DataFrame, zero: Column, v: Column, sized: bool = False) -> DataFrame:
    """gene_id and, for control (0) and treated (1) cells, n, z, zz (cells and sums of zero and its square over all cells) and d, dd (what v and
    its square add to them in cells with the gene). sized: also _s, the gene's counts, and _n, its cells with a count.

    Counts are read once: a cell's total comes from a window over its rows, whose first adds the cell to the sums over all cells.
    """
    cell = W.partitionBy("cell_id").orderBy("cell_id")
    total, first = F.sum("count").over(cell.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)), F.row_number().over(cell) == 1
    rows = expr.withColumns({"total": total, "_first": first}).join(cells.select("cell_id", "treated"), "cell_id")
    rows = rows.select("gene_id", "count", "treated", zero.alias("zero"), v.alias("v"), "_first")
    # 0: the gene's row, 1: the cell's own zero, 2: the cell counts
    parts = F.explode(F.when(F.col("_first"), F.array(*map(F.lit, range(3)))).otherwise(F.array(F.lit(0)))).alias("_part")
    rows = rows.select("*", parts).withColumn("gene_id", F.when(F.col("_part") == 0, F.col("gene_id")))
    own = lambda a, b, c: F.when(F.col("_part") == 0, a).when(F.col("_part") == 1, b).otherwise(c)
    d = own(F.col("v") - F.col("zero"), F.col("zero"), F.lit(1.0))
    dd = own(F.col("v") * F.col("v") - F.col("zero") * F.col("zero"), F.col("zero") * F.col("zero"), F.lit(0.0))
    side = lambda x, t: F.coalesce(F.sum(F.when(F.col("treated") == t, x)), F.lit(0.0))
    size = [F.sum("count").alias("_s"), F.count_if(F.col("count") > 0).alias("_n")] if sized else []
    sums = written(rows.groupBy("_part", "gene_id").agg(*(side(x, t).alias(f"{n}{t}") for t in (0, 1) for n, x in (("d", d), ("dd", dd))), *size), "gene-sums")
    whole = lambda part, c: F.coalesce(F.sum(F.when(F.col("_part") == part, F.col(c))), F.lit(0.0))
    base = sums.filter("_part > 0").agg(*(f.alias(f"{n}{t}") for t in (0, 1) for n, f in (("n", whole(2, f"d{t}").cast("long")), ("z", whole(1, f"d{t}")), ("zz", whole(1, f"dd{t}")))))
    return sums.filter("_part = 0").drop("_part").crossJoin(F.broadcast(base))


def gene_tests(expr: DataFrame, cells: DataFrame, moderated: bool = True, weighted: bool = False, least_count: float = 0, least_cells: int = 0, trend: bool = True) -> DataFrame:
    """Per gene log CPM difference treated less control with ordinary t; moderated t with variances shrunk to a prior (Smyth 2004, see variance_prior).

    trend: the prior's variance follows the gene's mean log CPM. prior_df and prior_s2 tell the prior; moderated p-values have the gene's and the
    prior's freedom, at most that of all genes together.

    expr: cell_id, gene_id, count; cells: cell_id, treated. Cells without a count of a gene have log2(0.5 / (total + 1) * 1e6). Constant genes have null t.
    weighted: precision weights by the trend of the deviation over the mean count (Law et al. 2014), see weighted_sums().
    least_count, least_cells: genes with fewer counts, or cells with a count, are left out.
    """
    zero, v = F.log2(0.5 / (F.col("total") + 1) * 1e6), F.log2((F.col("count") + 0.5) / (F.col("total") + 1) * 1e6)
    g = gene_sums(expr, cells, zero, v, sized=bool(least_count or least_cells))
    if least_count or least_cells:
        g = g.filter((F.col("_s") >= least_count) & (F.col("_n") >= least_cells)).drop("_s", "_n")
    mean = lambda t: (F.col(f"z{t}") + F.col(f"d{t}")) / F.nullif(f"n{t}", F.lit(0))
    ss = lambda t: F.col(f"zz{t}") + F.col(f"dd{t}") - (F.col(f"z{t}") + F.col(f"d{t}")) * mean(t)
    df = F.col("n0") + F.col("n1") - 2
    g = g.select("gene_id", mean(0).alias("m0"), mean(1).alias("m1"), "n0", "n1", ((ss(0) + ss(1)) / df).alias("s2"), df.cast("double").alias("df"))
    level = (F.col("m0") * F.col("n0") + F.col("m1") * F.col("n1")) / F.nullif(F.col("n0") + F.col("n1"), F.lit(0))
    g = g.withColumn("x", F.coalesce(level, F.lit(0.0)))
    if weighted:
        g = written(g, "gene-means")
        lib = cells.join(expr.groupBy("cell_id").agg(F.sum("count").alias("total")), "cell_id").withColumn("zero", zero)
        rows = expr.join(lib, "cell_id").withColumn("v", v)
        s = weighted_sums(rows.join(g.select("gene_id"), "gene_id", "left_semi") if least_count or least_cells else rows, lib, g)
        m = lambda t: F.col(f"y{t}") / F.nullif(f"w{t}", F.lit(0.0))
        rest = lambda t: F.greatest(F.lit(0.0), F.col(f"yy{t}") - F.col(f"y{t}") * m(t))
        g = s.join(g.select("gene_id", "df", "x"), "gene_id").select("gene_id", "x", (m(1) - m(0)).alias("beta"), ((rest(0) + rest(1)) / F.col("df")).alias("s2"), "df", F.sqrt(1 / F.nullif("w0", F.lit(0.0)) + 1 / F.nullif("w1", F.lit(0.0))).alias("spread"))
    else:
        g = g.select("gene_id", "x", (F.col("m1") - F.col("m0")).alias("beta"), "s2", "df", F.sqrt(1 / F.nullif("n0", F.lit(0)) + 1 / F.nullif("n1", F.lit(0))).alias("spread"))
    t = F.when(F.col("s2") > 1e-12, F.col("beta") / (F.sqrt("s2") * F.col("spread")))
    g = g.withColumn("t", t).withColumn("pval", t_p("t", "df"))
    if not moderated:
        return g.drop("spread", "x")
    g = written(g, "gene-tests")
    prior = variance_prior(g.filter("s2 > 1e-12"), trend)
    pooled = float(g.filter("s2 > 1e-12").agg(F.coalesce(F.sum("df"), F.lit(0.0))).first()[0])
    g = g.withColumn("prior_s2", prior.variance(F.col("x"))).withColumn("prior_df", F.lit(prior.df))
    post = F.col("prior_s2") if math.isinf(prior.df) else (prior.df * F.col("prior_s2") + F.col("df") * F.col("s2")) / (prior.df + F.col("df"))
    g = g.withColumn("moderated_t", F.when(F.col("s2") > 1e-12, F.col("beta") / (F.sqrt(post) * F.col("spread"))))
    return g.withColumn("moderated_pval", t_p("moderated_t", F.least(F.col("df") + prior.df, F.lit(pooled)))).drop("spread", "x")


LOG_MILLION = float(np.log2(1e6))
#: Different library sizes, and genes about, that meet in one task.
SIZES, GENES = 4096, 1 << 14


def deviation_trend(genes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Local regression of the square root of a gene's deviation on its mean log2 count, at points between which it is a line; genes: x, s2."""
    found = local_trend(genes.filter("s2 > 1e-12").select("x", F.pow("s2", F.lit(0.25)).alias("y")))
    most = found.y.max()
    return (found.x, np.maximum(found.y, 1e-3 * most)) if most > 0 else (np.empty(0), np.empty(0))


def weighted_sums(rows: DataFrame, lib: DataFrame, genes: DataFrame) -> DataFrame:
    """gene_id and, for control (0) and treated (1) cells, sums of weights, weight * v and weight * v * v over all cells.

    An observation's weight is the trend at its fitted log2 count, to the power -4: the gene's mean of the side plus the cell's log2
    library size. So cells without a count of the gene need only the distribution of library sizes: all different ones, in
    blocks of about SIZES that meet parts of about GENES genes task by task. The trend is a line between its points, level beyond its ends.
    """
    size = F.log2(F.col("total") + 1) - LOG_MILLION
    lib = lib.withColumn("l", size)
    mean_l = lib.agg(F.avg("l").alias("l")).first().l or 0.0
    n = F.col("n0") + F.col("n1")
    x, y = deviation_trend(genes.select("s2", ((F.col("m0") * F.col("n0") + F.col("m1") * F.col("n1")) / n + mean_l).alias("x")))
    sizes = written(lib.groupBy("treated", "total").agg(F.count("*").alias("n"), F.first("l").alias("l")), "library-sizes")
    blocks = max(1, -(-sizes.count() // SIZES))
    sizes = sizes.select("treated", "n", "l", F.pmod(F.xxhash64("total"), F.lit(blocks)).alias("block"))

    def weight(fitted: np.ndarray) -> np.ndarray:
        return np.interp(fitted, x, y) ** -4.0 if len(x) else np.ones_like(fitted)

    def zeros(genes: pd.DataFrame, sizes: pd.DataFrame) -> pd.DataFrame:
        out = {"gene_id": genes["gene_id"].to_numpy()} | {c: np.zeros(len(genes)) for c in columns}
        for t, own in sizes.groupby("treated"):
            l, count = own["l"].to_numpy(float), own["n"].to_numpy(float)
            z = -1.0 - l
            mean = genes[f"m{t}"].to_numpy(float)
            for at in range(0, len(genes), 256):
                w = weight(mean[at : at + 256, None] + l) * count
                for c, v in (("w", w), ("y", w * z), ("yy", w * z * z)):
                    out[f"{c}{t}"][at : at + 256] = v.sum(1)
        return pd.DataFrame(out)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            side = batch["treated"].to_numpy()
            w = weight(np.where(side == 1, batch["m1"], batch["m0"]) + batch["l"].to_numpy(float))
            v, z = batch["v"].to_numpy(float), batch["zero"].to_numpy(float)
            out = {"gene_id": batch["gene_id"]}
            for t in (0, 1):
                own = w * (side == t)
                out |= {f"w{t}": 0.0 * own, f"y{t}": own * (v - z), f"yy{t}": own * (v * v - z * z)}
            yield pd.DataFrame(out)

    kind = rows.schema["gene_id"].dataType.simpleString()
    columns = [f"{c}{t}" for t in (0, 1) for c in ("w", "y", "yy")]
    schema = f"gene_id {kind}, " + ", ".join(f"{c} double" for c in columns)
    means = genes.select("gene_id", "m0", "m1")
    seen = rows.withColumn("l", size).join(means, "gene_id").select("gene_id", "treated", "m0", "m1", "l", "v", "zero")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    parts = max(1, -(-genes.count() // GENES))
    spread = means.withColumn("part", F.pmod(F.xxhash64("gene_id"), F.lit(parts).cast("long"))).withColumn("block", upto(blocks))
    sizes = sizes.withColumn("part", upto(parts)).repartition(parts * blocks, "block", "part")
    unseen = spread.repartition(parts * blocks, "block", "part").groupBy("block", "part").cogroup(sizes.groupBy("block", "part")).applyInPandas(zeros, schema)
    both = unseen.unionByName(seen.mapInPandas(counted, schema))
    return both.groupBy("gene_id").agg(*(F.sum(c).alias(c) for c in columns))


def screened_cells(cells: DataFrame, treated: DataFrame, covariates: list[str], control_cells: DataFrame, least: int = 10, seed: int = 42, max_controls: int | None = None) -> DataFrame:
    """target, cell_id, treated, covariates: the cells of every target with ``least`` of them, and the controls that its matching may take, all of them by default.

    With max_controls they are thinned before they meet the targets: a target's first ones by hash have its smallest hash prefixes, and what is left
    of a prefix without the target's own cells is counted, not sorted.
    """
    own = treated.join(cells, "cell_id").withColumn("treated", F.lit(1))
    big = own.groupBy("target").agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select("target")
    pool = control_cells.join(cells, "cell_id")
    mine = own.groupBy("cell_id").agg(F.collect_set("target").alias("_mine"))
    pool = pool.join(mine, "cell_id", "left")
    other = F.col("_mine").isNull() | ~F.array_contains("_mine", F.col("target"))
    if max_controls is None:
        pool = pool.join(F.broadcast(big), other)
    else:
        pool = pool.withColumn("_prefix", F.substring(_draw(seed), 1, PREFIX))
        counts = pool.groupBy("_prefix").agg(F.count("*").alias("_all"))  # at most 65,536 prefixes
        gone = own.select("target", "cell_id").join(control_cells, "cell_id").groupBy("target", F.substring(_draw(seed), 1, PREFIX).alias("_prefix")).agg(F.count("*").alias("_own"))
        left = counts.join(big, how="cross").join(gone, ["target", "_prefix"], "left").withColumn("_left", F.col("_all") - F.coalesce("_own", F.lit(0)))
        upto = F.sum("_left").over(W.partitionBy("target").orderBy("_prefix").rowsBetween(W.unboundedPreceding, W.currentRow))
        last = left.withColumn("_upto", upto).filter(F.col("_upto") >= max_controls).groupBy("target").agg(F.min("_prefix").alias("_last"))
        wanted = big.join(last, "target", "left").withColumn("_last", F.coalesce("_last", F.lit("g")))  # beyond all prefixes
        pool = pool.join(F.broadcast(wanted), (F.col("_prefix") <= F.col("_last")) & other)
    pool = pool.withColumn("treated", F.lit(0))
    columns = ["target", "cell_id", "treated", *covariates]
    return own.join(big, "target", "left_semi").select(*columns).unionByName(pool.select(*columns))


def matched_effects(scores: DataFrame, cells: DataFrame, treated: DataFrame, covariates: list[str], control_cells: DataFrame, ratio: int = 4, least: int = 10, value: str = "score", seed: int = 42, max_controls: int | None = None) -> DataFrame:
    """The matched pipeline for all targets at once: gate, match, balance, weighted regression per program.

    target, program, beta, se, stat, pval, n, worst_smd; see screened_cells for the controls.
    """
    rows = screened_cells(cells, treated, covariates, control_cells, least, seed, max_controls)
    matched = match(rows, ["target"], covariates, ratio, seed=seed, max_controls=max_controls)
    full = matched.join(cells.select("cell_id", *covariates), "cell_id")
    worst = balance(full, ["target"], covariates, weight="weight").groupBy("target").agg(F.max(F.abs("smd")).alias("worst_smd"))
    fits = weighted_ols(full.join(scores.select("cell_id", "program", value), "cell_id"), ["target", "program"], value, covariates)
    return fits.join(worst, "target")
