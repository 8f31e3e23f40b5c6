"""Least-squares fits from sums that add up.

A fit needs of its rows only their number, the products of the columns with
each other and with the target. One scan gives these sums for every group
of rows; the rows outside a fold are the total minus the fold, a penalty is
added to the matrix afterwards, and a squared error on other rows follows
from their sums: ``yy - 2 w.xy + w.xx.w``. So the number of scans depends
neither on the number of folds nor on that of strengths.

* ``moments``: numeric columns, products summed in one aggregate;
* ``contingency``: columns of bucket codes as one-hot features, whose
  products are the counts of code pairs; nothing is encoded.

The driver gets ``groups * columns**2`` numbers, which parameters bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest number of one-hot columns whose products the driver holds (a few hundred MB).
MAX_COLUMNS = 4096


@dataclass
class Moments:
    """Sums over rows: ``xx`` and ``xy`` have the bias (a column of ones) first."""

    n: int
    xx: np.ndarray
    xy: np.ndarray
    yy: float

    @classmethod
    def zero(cls, columns: int) -> Moments:
        return cls(0, np.zeros((columns + 1, columns + 1)), np.zeros(columns + 1), 0.0)

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.xx + other.xx, self.xy + other.xy, self.yy + other.yy)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.xx - other.xx, self.xy - other.xy, self.yy - other.yy)

    def squared_error(self, w: np.ndarray) -> float:
        """Sum of squared errors of the fit ``w`` (bias first) over these rows."""
        return max(0.0, self.yy - 2 * float(w @ self.xy) + float(w @ self.xx @ w))

    def rmse(self, w: np.ndarray) -> float | None:
        return (self.squared_error(w) / self.n) ** 0.5 if self.n else None


def total(parts: Iterable[Moments]) -> Moments:
    first, *rest = parts
    for m in rest:
        first = first + m
    return first


def moments(df: DataFrame, features: Sequence[str], label: str, groups: Sequence[str] = ()) -> dict[tuple, Moments]:
    """Sums of each group of rows, one aggregate. Rows with a null feature or label are left out."""
    cols = [f"_x{i}" for i in range(len(features) + 2)]  # the bias, the features, the label
    own = df.select(*groups, F.lit(1.0).alias(cols[0]), *[F.col(c).cast("double").alias(x)
                                                          for c, x in zip([*features, label], cols[1:], strict=True)])
    own = own.dropna(subset=cols[1:])
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    rows = own.groupBy(*groups).agg(*[F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"s{i}_{j}") for i, j in pairs]).collect()
    p, out = len(features), {}
    for r in rows:
        full = np.zeros((p + 2, p + 2))
        for i, j in pairs:
            full[i, j] = full[j, i] = r[f"s{i}_{j}"] or 0.0
        out[tuple(r[g] for g in groups)] = Moments(int(full[0, 0]), full[:-1, :-1], full[:-1, -1], float(full[-1, -1]))
    return out


def pair_counts(df: DataFrame, codes: Mapping[str, int], label: str, groups: Sequence[str] = ()) -> DataFrame:
    """``(groups, a, i, b, j, n, sum_y, sum_yy)``: rows with code i in column a and code j in column b, for a < b.

    The column ``""`` is the bias, with code 0 alone: its pairs hold every
    code's own count and target sum. Each row gives a row per pair of
    columns, counted before the shuffle. A null code belongs to no one-hot
    column; rows with a null label are left out.
    """
    names = ["", *codes]
    code = {"": F.lit(0), **{c: F.col(c).cast("int") for c in codes}}
    pairs = [(a, b) for k, a in enumerate(names) for b in names[k + 1:]] + [("", "")]
    cells = F.array(*[F.struct(F.lit(a).alias("a"), code[a].alias("i"), F.lit(b).alias("b"), code[b].alias("j"))
                      for a, b in pairs])
    y = F.col(label).cast("double")
    long = df.where(y.isNotNull()).select(*groups, y.alias("_y"), F.explode(cells).alias("_c")).select(*groups, "_y", "_c.*")
    return (long.where("i is not null and j is not null").groupBy(*groups, "a", "i", "b", "j")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("sum_y"), F.sum(F.col("_y") * F.col("_y")).alias("sum_yy")))


def contingency(df: DataFrame, codes: Mapping[str, int], label: str, groups: Sequence[str] = ()) -> dict[tuple, Moments]:
    """Sums of the one-hot columns of ``codes`` (column -> number of codes), one scan. Codes beyond the number raise."""
    size = sum(codes.values())
    if size > MAX_COLUMNS:
        raise ValueError(f"{size} one-hot columns; the driver holds at most {MAX_COLUMNS}")
    first, at = {"": 0}, 1
    for c, k in codes.items():
        first[c] = at
        at += k
    # At most (columns + 1)**2 / 2 cells a group, whatever the number of rows.
    table = pair_counts(df, codes, label, groups).toArrow().to_pydict()
    out: dict[tuple, Moments] = {}
    for k in range(len(table["n"])):
        a, b, i, j = (table[c][k] for c in "abij")
        if any(c and not 0 <= v < codes[c] for c, v in ((a, i), (b, j))):
            raise ValueError(f"code beyond the number of codes: {a}={i}, {b}={j}")
        m = out.setdefault(tuple(table[g][k] for g in groups), Moments.zero(size))
        n, x, y = table["n"][k], first[a] + i, first[b] + j
        if a == b == "":
            m.n, m.yy = n, table["sum_yy"][k]
            m.xx[0, 0], m.xy[0] = n, table["sum_y"][k]
            continue
        m.xx[x, y] = m.xx[y, x] = n
        if a == "":
            m.xx[y, y], m.xy[y] = n, table["sum_y"][k]
    return out


def ridge(m: Moments, strength: float) -> np.ndarray:
    """Weights (bias first) that minimise ``sum((y - xw)**2) / n + strength * |w|**2``; the bias is free.

    Without a penalty, and for collinear columns, the shortest solution.
    """
    penalty = np.full(len(m.xy), strength * m.n)
    penalty[0] = 0.0
    a = m.xx + np.diag(penalty)
    if strength > 0 and m.n:
        return np.linalg.solve(a, m.xy)
    return np.linalg.lstsq(a, m.xy, rcond=None)[0]


def elastic_net(m: Moments, strength: float, l1_share: float, sweeps: int = 100_000, tol: float = 1e-12) -> np.ndarray:
    """Weights (bias first) that minimise ``sum((y - xw)**2) / 2n + strength * (l1_share |w|_1 + (1 - l1_share) |w|**2 / 2)``.

    Cyclic coordinate descent on the sums; a coordinate's step needs no rows.
    """
    w = np.zeros(len(m.xy))
    if not m.n:
        return w
    lasso, square = strength * l1_share * m.n, strength * (1 - l1_share) * m.n
    scale = max(1.0, float(np.abs(m.xy).max()))
    for _ in range(sweeps):
        change = 0.0
        for j in range(len(w)):
            if not m.xx[j, j]:
                continue
            z = m.xy[j] - m.xx[j] @ w + m.xx[j, j] * w[j]
            new = z / m.xx[j, j] if j == 0 else np.sign(z) * max(abs(z) - lasso, 0.0) / (m.xx[j, j] + square)
            change = max(change, abs(new - w[j]) * m.xx[j, j])
            w[j] = new
        if change <= tol * scale:
            break
    return w


def ridge_path(folds: Mapping[object, Moments], strengths: Sequence[float]) -> list[tuple[float, float]]:
    """(strength, cross-validated RMSE): each fold is judged by the fit on the others, all from the folds' sums."""
    every = total(folds.values())
    out = []
    for s in strengths:
        error = sum(own.squared_error(ridge(every - own, s)) for own in folds.values())
        out.append((s, (error / every.n) ** 0.5))
    return out
