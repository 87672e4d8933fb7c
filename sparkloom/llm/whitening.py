"""Whitening of embeddings by an incremental eigendecomposition.

Each task keeps a mean and the spectrum of its scatter matrix and takes in a row
by one centred rank-one update: the secular equation gives the new eigenvalues,
entries that can't change are deflated. Spectra are combined, in groups, by one update
for each eigenvector of the other and one for the distance of the means. Sums over all
rows then refine the leading pairs (Rayleigh-Ritz), with the rest of the spectrum as
preconditioner. The driver sees d x d numbers, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import cut, discard

EPS = np.finfo(np.float64).eps


def roots(poles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """G[i, j] = poles[j] - root[i] of the secular equation 1 + sum_j weights[j] / (poles[j] - root) = 0.

    poles rise strictly, weights are above zero; root i lies between pole i and the next
    (the last within the sum of weights). Each root is kept as the distance from its nearer
    pole, so the differences are exact to rounding. Steps interpolate the terms on both
    sides of the root, and halve the bracket where that leaves it.
    """
    n = len(poles)
    gap = np.append(np.diff(poles), weights.sum())
    rows = np.arange(n)
    between = poles[None, :] - poles[:, None]
    middle = 1 + (weights / (between - gap[:, None] / 2)).sum(1)
    right = middle < 0
    right[-1] = False  # the last has no pole above it
    base = np.where(right, rows + 1, rows)
    away = poles[None, :] - poles[base][:, None]
    low, high = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, np.where(rows < n - 1, gap / 2, gap))
    at = (low + high) / 2
    below = rows[None, :] <= rows[:, None]
    following = np.minimum(rows + 1, n - 1)
    todo = rows
    for _ in range(100):
        d = away[todo] - at[todo, None]
        term = weights / d
        slope = term / d
        under = below[todo]
        f = 1 + term.sum(1)
        size = 1 + np.abs(term).sum(1)
        s_low = np.einsum("ij,ij->i", slope, under)
        s_high = slope.sum(1) - s_low
        low[todo] = np.where(f < 0, at[todo], low[todo])
        high[todo] = np.where(f >= 0, at[todo], high[todo])
        d0, d1 = d[np.arange(len(todo)), todo], d[np.arange(len(todo)), following[todo]]
        with np.errstate(all="ignore"):
            c = f - d0 * s_low - d1 * s_high
            a = (d0 + d1) * f - d0 * d1 * (s_low + s_high)
            b = d0 * d1 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            last = todo == n - 1
            step = np.where(last, d0 + d0 * d0 * s_low / (f - d0 * s_low), step)
            new = at[todo] + step
        inside = np.isfinite(new) & (new > low[todo]) & (new < high[todo])
        new = np.where(inside, new, (low[todo] + high[todo]) / 2)
        exact = np.abs(f) <= 4 * EPS * size
        done = exact | (np.abs(new - at[todo]) <= 2 * EPS * np.abs(new))
        at[todo] = np.where(exact, at[todo], new)
        todo = todo[~done]
        if not len(todo):
            break
    return away - at[:, None]


def update(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and vectors (columns) of vectors @ diag(values) @ vectors.T + v v'.

    Entries of v that rounding would swallow leave their pair alone; of two equal eigenvalues one
    is turned out of the way of v. Vectors come from weights recomputed from the roots, so they stay
    orthogonal however close the roots are.
    """
    z = vectors.T @ v
    weight = float(z @ z)
    if weight == 0:
        return values, vectors
    tiny = 8 * EPS * max(float(values[-1]), weight)
    z = np.where(np.abs(z) * np.sqrt(weight) <= tiny, 0.0, z)
    held = np.flatnonzero(z)
    close = np.flatnonzero(np.diff(values[held]) <= tiny) if len(held) else held
    if len(close):
        vectors = vectors.copy()
        for k in close:
            i, j = held[k], held[k + 1]
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            vectors[:, [i, j]] = np.column_stack([c * vectors[:, i] - s * vectors[:, j], s * vectors[:, i] + c * vectors[:, j]])
            z[i], z[j] = 0.0, r
        held = np.flatnonzero(z)
    if not len(held):
        return values, vectors
    poles = values[held]
    g = roots(poles, z[held] ** 2)
    n = len(held)
    apart = poles[None, :] - poles[:, None]
    np.fill_diagonal(apart, 1.0)
    ratio = np.abs(g / apart)
    exact = np.sqrt(np.prod(ratio, axis=0)) * np.sign(z[held])
    turn = exact[None, :] / g
    turn /= np.sqrt(np.einsum("ij,ij->i", turn, turn))[:, None]
    found = values.copy()
    found[held] = poles[np.arange(n)] - g[np.arange(n), np.arange(n)]
    turned = vectors.copy()
    turned[:, held] = vectors[:, held] @ turn.T
    order = np.argsort(found, kind="stable")
    return found[order], turned[:, order]


@dataclass
class Spectrum:
    """Count, sums of whole numbers and the eigenpairs of the scatter matrix around the mean."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims, np.int64), np.zeros(dims), np.eye(dims))

    def add(self, x: np.ndarray) -> None:
        """Takes in one row of whole numbers."""
        if self.n:
            away = (self.n * x - self.sums) / self.n
            self.values, self.vectors = update(self.values, self.vectors, away * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.sums = self.sums + x

    def combine(self, other: Spectrum) -> None:
        """Takes in the rows of another spectrum."""
        if not other.n:
            return
        if not self.n:
            self.n, self.sums, self.values, self.vectors = other.n, other.sums, other.values, other.vectors
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = update(self.values, self.vectors, np.sqrt(value) * vector)
        away = other.sums / other.n - self.sums / self.n
        self.values, self.vectors = update(self.values, self.vectors, away * np.sqrt(self.n * other.n / (self.n + other.n)))
        self.n += other.n
        self.sums = self.sums + other.sums

    def row(self, key: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.int64()), pa.array([self.n], pa.int64()), pa.array([self.sums.tolist()], pa.list_(pa.int64())), pa.array([self.values.tolist()], pa.list_(pa.float64())), pa.array([self.vectors.ravel().tolist()], pa.list_(pa.float64()))],
            names=["key", "n", "sums", "values", "vectors"],
        )

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        dims = len(row["sums"])
        return cls(row["n"], np.array(row["sums"], np.int64), np.array(row["values"]), np.array(row["vectors"]).reshape(dims, dims))


SPECTRUM = "key long, n long, sums array<long>, values array<double>, vectors array<double>"


def grid(vectors: DataFrame, vec_col: str, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """``vectors`` with x (array of long: floor(scale * entry) + shift) for its rows of finite entries.

    Only the most common length takes part (of equally common ones the longest): rows of another
    length have no covariance with the rest.
    """
    finite = F.col(vec_col).isNotNull() & ~F.exists(vec_col, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    kept = vectors.filter(finite)
    lengths = kept.groupBy(F.size(vec_col).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    x = F.transform(vec_col, lambda c: F.floor(c.cast("double") * scale) + shift)
    return kept.filter(F.size(vec_col) == (lengths[0]["dims"] if lengths else -1)).withColumn("x", x)


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    at = batch.column(batch.schema.get_field_index(column))
    return at.flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1) if len(at) else np.zeros((0, 0), np.int64)


def spectra(rows: DataFrame) -> DataFrame:
    """One spectrum for each partition of ``rows`` (x), by a rank-one update for each row."""

    def each(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in found:
            for x in _matrix(batch):
                kept = kept or Spectrum.empty(len(x))
                kept.add(x)
        if kept is not None:
            yield kept.row(0)

    return rows.select("x").mapInArrow(each, SPECTRUM)


def _combined(found: pa.Table) -> pa.Table:
    kept = None
    for row in sorted(found.to_pylist(), key=lambda r: (r["n"], r["sums"], r["values"])):
        if kept is None:
            kept = Spectrum.of(row)
        else:
            kept.combine(Spectrum.of(row))
    return pa.Table.from_batches([kept.row(found.column("key")[0].as_py())])


def combine(found: DataFrame, together: int = 16) -> Spectrum | None:
    """The spectrum of all rows: spectra are combined in tasks of about ``together``, level by level, until one is left.

    The levels are shuffles of one job; a lost executor costs the spectra it held.
    """
    first = cut(found, "whiten-spectra")
    left = first.count()
    level = first
    while left > 1:
        left = -(-left // together)
        dealt = level.withColumn("key", F.pmod(F.xxhash64("n", "sums", "values"), F.lit(left)))
        level = dealt.groupBy("key").applyInArrow(_combined, SPECTRUM)
    rows = level.collect()  # one row of d x d numbers
    discard(first)
    return Spectrum.of(rows[0].asDict()) if rows else None


def _sums(rows: DataFrame, total: Spectrum, right: np.ndarray) -> np.ndarray:
    """V @ right, V the covariance of x: sums of (n x - S) (n x - S)' right / n^3 over all rows, in two steps."""
    n, sums = total.n, total.sums

    def part(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in found:
            if batch.num_rows:
                away = (n * _matrix(batch) - sums) / n
                added = away.T @ (away @ right)
                kept = added if kept is None else kept + added
        if kept is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(kept.size), pa.int32()), pa.array(kept.ravel())], names=["at", "value"])

    found = rows.select("x").mapInArrow(part, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(right.size)
    for r in found:
        out[r["at"]] = r["value"]
    return out.reshape(right.shape) / n


@dataclass
class Whitening:
    """The fit: counts and sums, leading eigenpairs of the covariance by falling value, the trace, passes of the refinement, its last relative residual."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    passes: int
    residual: float


def refine(rows: DataFrame, total: Spectrum, k: int, passes: int = 6, enough: float = 1e-13) -> Whitening:
    """The first k eigenpairs (and as many again, as a guard) of the covariance, from those of ``total``.

    Each pass over the rows forms V Q, takes the pairs of Q'VQ and corrects each by its
    residual, divided in the basis of the spectrum by the distance of the eigenvalues. It ends once the
    residual is at rounding, or no longer falls. Q has as many columns as the spectrum gives
    leading pairs: a wrong spectrum isn't mended here, and ends in an error.
    """
    dims = len(total.sums)
    wide = min(dims, 2 * k)
    basis, spread = total.vectors[:, ::-1], total.values[::-1] / total.n
    q, best = basis[:, :wide], None
    for done in range(1, passes + 1):
        vq = _sums(rows, total, q)
        inner, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        inner, turn = inner[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        left = vq - q * inner
        top = max(inner[0], np.finfo(float).tiny)
        residual = float(np.sqrt((left[:, :k] ** 2).sum(0)).max() / top)
        if best is None or residual < best.residual:
            best = Whitening(total.n, total.sums, inner[:k], q[:, :k], float(spread.sum()), done, residual)
        elif done > 1:
            break
        if residual <= enough:
            break
        inside = basis.T @ left
        away = spread[:, None] - inner[None, :]
        near = np.abs(away) <= 1e-6 * top  # pairs this close are told apart by Q'VQ
        q = np.linalg.qr(q - basis @ np.where(near, 0, inside / np.where(near, 1, away)))[0]
    if best.residual > 1e-8:
        raise ArithmeticError(f"the spectrum of the updates is off: relative residual {best.residual}")
    return best


def fit(rows: DataFrame, k: int = 8) -> Whitening | None:
    """The whitening of ``rows`` (x); None without rows."""
    total = combine(spectra(rows))
    return refine(rows, total, min(k, len(total.sums))) if total is not None and len(total.sums) else None


def _projected(found: Whitening, k: int):
    """Rows to their k whitened numbers; null where the component has no variance, as nothing can be scaled to one there."""
    usable = found.values[:k] > 64 * EPS * max(found.trace, np.finfo(float).tiny)
    scaled = found.components[:, :k] / np.where(usable, np.sqrt(np.abs(found.values[:k])), 1)
    n, sums = found.n, found.sums

    def of(x: np.ndarray) -> np.ndarray:
        return ((n * x - sums) / n) @ scaled

    return usable, of


def identity_error(rows: DataFrame, found: Whitening, k: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over usable components, measured on all rows."""
    usable, of = _projected(found, k)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                y = of(_matrix(batch))
                first += y.sum(0)
                second += y.T @ y
        every = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(every)), pa.int32()), pa.array(every)], names=["at", "value"])

    sums = np.zeros(k + k * k)
    for r in rows.select("x").mapInArrow(part, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        sums[r["at"]] = r["value"]
    mean = sums[:k] / found.n
    covariance = sums[k:].reshape(k, k) / found.n - np.outer(mean, mean)
    return float(np.abs((covariance - np.eye(k))[np.ix_(usable, usable)]).max(initial=0.0))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """id_col, component (from 1), n, deviation, whitened, explained, identity_error for each usable row and each of the first k components.

    Rows whose vector is null, of another length than most or with a null or non-finite entry
    are left out; a repeated row counts and is returned as often as it occurs; null ids are kept; other columns are
    ignored; without usable rows the result is empty. Vectors of fewer than k entries have
    as many components. deviation is exact, null beyond the range of long. whitened is null for a component
    without variance (all rows alike, or fewer rows than components), explained then 0.
    Entries beyond 2^63 / scale stop at the ends of long, and means and sums must stay within long.
    """
    spark = vectors.sparkSession
    usable_rows = cut(grid(vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_vec")), "_vec", scale, shift).select("_id", "x"), "whiten-rows")
    schema = f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = fit(usable_rows, k)
    if found is None:
        return spark.createDataFrame([], schema)
    k = len(found.values)
    error = identity_error(usable_rows, found, k)
    usable, of = _projected(found, k)
    n, sums = found.n, found.sums
    explained = np.where(usable, found.values / found.trace if found.trace > 0 else 0.0, 0.0)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            away = n * x - sums
            exact = np.einsum("ij,ij->i", away, away) if float(np.abs(away).max(initial=0)) ** 2 * len(sums) < 2**62 else None
            deviation = exact.tolist() if exact is not None else [s if s < 2**63 else None for s in (sum(int(v) ** 2 for v in row) for row in away)]
            y = of(x)
            rows = np.repeat(np.arange(batch.num_rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(rows), n)),
                    pa.array(deviation, pa.int64()).take(pa.array(rows)),
                    pa.array(y.ravel(), mask=~np.tile(usable, batch.num_rows)),
                    pa.array(np.tile(explained, batch.num_rows)),
                    pa.array(np.full(len(rows), error)),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return usable_rows.mapInArrow(part, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the first eight whitened components of every embedding."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
