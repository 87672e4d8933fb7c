"""Non-negative least squares and update rules for batches of rows, from sums only.

A batch of cells is a sparse matrix in flat arrays; its products with the spectra are
sums over runs of these arrays, so no step goes row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

#: Numbers that a product of a batch holds at once.
CHUNK = 1 << 21
TINY = 1e-12


@dataclass
class Rows:
    """Rows of a sparse matrix: column numbers and values of all rows one after the other, and where each row starts (one more at the end)."""

    columns: np.ndarray
    values: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, idx: pd.Series, val: pd.Series) -> Rows:
        lengths = np.fromiter((len(x) for x in idx), np.int64, len(idx))
        flat = lambda s, kind: np.concatenate([np.asarray(x, kind) for x in s]) if lengths.sum() else np.empty(0, kind)
        return cls(flat(idx, np.int64), flat(val, np.float64), np.r_[0, np.cumsum(lengths)])

    def __len__(self) -> int:
        return len(self.starts) - 1

    def pieces(self, width: int):
        """Slices of rows with about CHUNK / width values each."""
        at = 0
        while at < len(self):
            end = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + max(1, CHUNK // max(1, width)), "right")) - 1)
            yield at, min(end, len(self))
            at = min(end, len(self))

    def slice(self, at: int, end: int) -> Rows:
        lo, hi = self.starts[at], self.starts[end]
        return Rows(self.columns[lo:hi], self.values[lo:hi], self.starts[at : end + 1] - lo)

    def taken(self, mask: np.ndarray) -> Rows:
        """The rows where mask is true."""
        lengths = np.diff(self.starts)
        inside = np.repeat(mask, lengths)
        return Rows(self.columns[inside], self.values[inside], np.r_[0, np.cumsum(lengths[mask])])

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def summed(self, terms: np.ndarray) -> np.ndarray:
        """Sums of ``terms`` (one row for each value) over the rows."""
        out = np.zeros((len(self), *terms.shape[1:]))
        full = np.flatnonzero(np.diff(self.starts))
        if len(full):
            out[full] = np.add.reduceat(terms, self.starts[:-1][full], axis=0)
        return out

    def times(self, right: np.ndarray) -> np.ndarray:
        """This matrix @ right."""
        parts = []
        for at, end in self.pieces(right.shape[1]):
            own = self.slice(at, end)
            parts.append(own.summed(right[own.columns] * own.values[:, None]))
        return np.concatenate(parts) if parts else np.zeros((0, right.shape[1]))

    def crossed(self, left: np.ndarray, n_columns: int, values: np.ndarray | None = None) -> np.ndarray:
        """left' @ this matrix; left has a row for each row."""
        values = self.values if values is None else values
        order = np.argsort(self.columns, kind="stable")
        columns, owners, values = self.columns[order], self.owners()[order], values[order]
        out = np.zeros((n_columns, left.shape[1]))
        step = max(1, CHUNK // max(1, left.shape[1]))
        for at in range(0, len(columns), step):
            c = columns[at : at + step]
            first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            out[c[first]] += np.add.reduceat(left[owners[at : at + step]] * values[at : at + step, None], first, axis=0)
        return out.T


def block_pivoting(gram: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """Rows w >= 0 that minimise w gram w' / 2 - cross w' for each row of cross: exact, by block principal pivoting.

    Rows whose free entries are the same are solved together; a row that doesn't improve for
    three exchanges goes on with single ones, which ends.
    """
    n, k = cross.shape
    gram = gram + 1e-12 * max(np.trace(gram) / max(k, 1), TINY) * np.eye(k)
    free = np.zeros((n, k), bool)
    x, y = np.zeros((n, k)), -cross.copy()
    left, best = np.full(n, 3), np.full(n, k + 1)
    scale = 1e-10 * np.maximum(np.abs(cross).max(1, initial=0), TINY)
    todo = np.arange(n)
    for _ in range(50 * (k + 1)):
        wrong = (free[todo] & (x[todo] < 0)) | (~free[todo] & (y[todo] < -scale[todo, None]))
        count = wrong.sum(1)
        todo, wrong, count = todo[count > 0], wrong[count > 0], count[count > 0]
        if not len(todo):
            break
        better = count < best[todo]
        best[todo] = np.where(better, count, best[todo])
        left[todo] = np.where(better, 3, left[todo] - 1)
        single = left[todo] < 0
        last = k - 1 - np.argmax(wrong[:, ::-1], axis=1)
        alone = np.zeros_like(wrong)
        alone[np.arange(len(todo)), last] = True
        free[todo] ^= np.where(single[:, None], alone, wrong)
        kinds, of = np.unique(free[todo], axis=0, return_inverse=True)
        for i, kind in enumerate(kinds):
            rows = todo[of.ravel() == i]
            x[rows] = 0
            if kind.any():
                x[np.ix_(rows, kind)] = np.linalg.solve(gram[np.ix_(kind, kind)], cross[np.ix_(rows, kind)].T).T
            y[rows] = x[rows] @ gram - cross[rows]
            y[np.ix_(rows, kind)] = 0
    return np.maximum(x, 0)


def coordinate_sweeps(w: np.ndarray, gram: np.ndarray, cross: np.ndarray, sweeps: int, l1: float = 0.0, l2: float = 0.0, enough: float = 0.0) -> np.ndarray:
    """Hierarchical least squares: each column of w in turn to its best value above zero, ``sweeps`` times; a row ends
    when none of its entries moves by more than ``enough`` of its largest, so its result doesn't depend on other rows."""
    size = np.diag(gram) + l2
    w, todo = w.copy(), np.arange(len(w))
    for _ in range(sweeps):
        own, goal, moved = w[todo], cross[todo], np.zeros(len(todo))
        for r in np.flatnonzero(size > 0):
            new = np.maximum(0, own[:, r] + (goal[:, r] - own @ gram[:, r] - l1 - l2 * own[:, r]) / size[r])
            moved = np.maximum(moved, np.abs(new - own[:, r]))
            own[:, r] = new
        w[todo] = own
        if enough:
            todo = todo[moved > enough * np.maximum(own.max(1), TINY)]
            if not len(todo):
                break
    return w


def solve_rows(rows: Rows, h: np.ndarray, algo: str, loss: str, inner: int, l1: float = 0.0, l2: float = 0.0) -> np.ndarray:
    """Usages of the rows for fixed spectra h (k by columns)."""
    w = np.ones((len(rows), len(h)))
    if loss == "frobenius":
        cross, gram = rows.times(h.T), h @ h.T
        if algo == "bpp":
            return block_pivoting(gram + l2 * np.eye(len(h)), cross - l1)
        if algo in ("hals", "halsvar"):
            # from the best multiple of a flat start
            share = cross.sum(1) / max(gram.sum(), TINY)
            return coordinate_sweeps(w * np.maximum(share, 0)[:, None], gram, cross, inner if algo == "hals" else 10 * inner, l1, l2, 0.0 if algo == "hals" else 1e-6)
        for _ in range(inner):
            w *= cross / np.maximum(w @ gram + l1 + l2 * w, TINY)
        return w
    for at, end in rows.pieces(len(h) if loss == "kl" else max(1, CHUNK // max(1, CHUNK // h.shape[1]))):
        own, part = rows.slice(at, end), w[at:end]
        for _ in range(inner):
            up, down = _ratios(own, part, h, loss)
            part *= np.sqrt(up / np.maximum(down + l1 + l2 * part, TINY)) if loss == "is" else up / np.maximum(down + l1 + l2 * part, TINY)
    return w


def _ratios(rows: Rows, w: np.ndarray, h: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray]:
    """Numerator and denominator of a multiplicative update of w."""
    ht = h.T[rows.columns]
    at = np.maximum(np.einsum("ij,ij->i", w[rows.owners()], ht), TINY)
    if loss == "kl":
        return rows.summed(ht * (rows.values / at)[:, None]), np.broadcast_to(h.sum(1), w.shape)
    return rows.summed(ht * (rows.values / at**2)[:, None]), (1 / np.maximum(w @ h, TINY)) @ h.T


def row_sums(rows: Rows, w: np.ndarray, h: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray]:
    """What an update of h needs of these rows: (W'W, W'X) for frobenius, else denominators and numerators."""
    k, n = h.shape
    if loss == "frobenius":
        return w.T @ w, rows.crossed(w, n)
    down, up = np.zeros((k, n)), np.zeros((k, n))
    for at, end in rows.pieces(k if loss == "kl" else n):
        own, part = rows.slice(at, end), w[at:end]
        fit = np.maximum(np.einsum("ij,ij->i", part[own.owners()], h.T[own.columns]), TINY)
        up += own.crossed(part, n, own.values / fit if loss == "kl" else own.values / fit**2)
        if loss == "is":
            down += part.T @ (1 / np.maximum(part @ h, TINY))
    return (np.diag(w.sum(0)) if loss == "kl" else down), up


def update_spectra(h: np.ndarray, down: np.ndarray, up: np.ndarray, algo: str, loss: str, inner: int, l1: float = 0.0, l2: float = 0.0) -> np.ndarray:
    """New spectra from the sums of all rows; spectra that no row uses stay as they are."""
    if loss == "frobenius":
        used = np.diag(down) > 0
        if algo == "bpp":
            return np.where(used[:, None], block_pivoting(down + l2 * np.eye(len(h)), up.T - l1).T, h)
        if algo in ("hals", "halsvar"):
            new = coordinate_sweeps(h.T, down, up.T, 1 if algo == "hals" else 10 * inner, l1, l2, 0.0 if algo == "hals" else 1e-6).T
            # a spectrum that fell to zero would stay there
            return np.where(new.any(1)[:, None], new, np.where(used[:, None], TINY, h))
        return h * up / np.maximum(down @ h + l1 + l2 * h, TINY)
    base = np.diag(down)[:, None] if loss == "kl" else down
    step = up / np.maximum(base + l1 + l2 * h, TINY)
    return h * (np.sqrt(step) if loss == "is" else step)


def objective(rows: Rows, w: np.ndarray, h: np.ndarray, loss: str) -> float:
    """Half the squared error, or the divergence; for is over the positive counts and with log-free zeros."""
    at = np.maximum(np.einsum("ij,ij->i", w[rows.owners()], h.T[rows.columns]), TINY)
    v = rows.values
    if loss == "frobenius":
        return 0.5 * float((v**2).sum() - 2 * (v * at).sum() + ((w @ (h @ h.T)) * w).sum())
    seen = v > 0
    if loss == "kl":
        return float((v[seen] * np.log(v[seen] / at[seen])).sum() - v.sum() + (w.sum(0) * h.sum(1)).sum())
    fit = 0.0
    for a, e in rows.pieces(h.shape[1]):
        fit += float(np.log(np.maximum(w[a:e] @ h, TINY)).sum())
    return float((v[seen] / at[seen] - np.log(v[seen]) - 1).sum()) + fit
