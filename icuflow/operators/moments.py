"""Cross-validated least squares from one aggregate: sums and products of every fold, of which all else is arithmetic.

A fold's second moments are added up once. The training rows of a fold are all rows without it, so their moments are the
total less the fold's; means, deviations, coefficients of any target and penalty, and the squared error on the fold left
out follow from these without another look at the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Rows, sums and products of some columns, as one matrix whose first row and column stand for the constant 1."""

    columns: tuple[str, ...]
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.columns, self.products + other.products)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.columns, self.products - other.products)

    @property
    def n(self) -> float:
        return float(self.products[0, 0])

    def place(self, names: Sequence[str]) -> list[int]:
        return [1 + self.columns.index(name) for name in names]

    def covariance(self, left: Sequence[str], right: Sequence[str]) -> np.ndarray:
        """Centred products, not divided by the rows."""
        p, a, b = self.products, self.place(left), self.place(right)
        return p[np.ix_(a, b)] - np.outer(p[a, 0], p[0, b]) / max(self.n, 1)

    def means(self, names: Sequence[str]) -> np.ndarray:
        return self.products[self.place(names), 0] / max(self.n, 1)


def moments(df: DataFrame, columns: Sequence[str], by: str) -> dict[object, Moments]:
    """The moments of every value of `by` (a bounded number: folds), from one aggregate with partial sums. Values are taken
    around the columns' overall means, so that nothing is lost to their size. Rows with a missing value take no part."""
    names = list(columns)
    known = df.where(F.col(by).isNotNull()).select(by, *[F.col(c).cast("double").alias(c) for c in names]).dropna()
    centre = known.agg(*[F.avg(c).alias(c) for c in names]).first()
    if centre is None or centre[names[0]] is None:
        return {}
    own = [F.lit(1.0), *[F.col(c) - F.lit(float(centre[c])) for c in names]]
    pairs = [(i, j) for i in range(len(own)) for j in range(i + 1)]
    rows = known.groupBy(by).agg(F.array(*[F.sum(own[i] * own[j]) for i, j in pairs]).alias("products")).collect()
    out = {}
    for row in rows:
        made = np.zeros((len(own), len(own)))
        for (i, j), value in zip(pairs, row["products"], strict=True):
            made[i, j] = made[j, i] = value
        out[row[by]] = Moments(tuple(names), made)
    return out


@dataclass
class Line:
    """Coefficients of features in units of their deviations, and the means that they are taken around."""

    features: tuple[str, ...]
    target: str
    weights: np.ndarray
    scale: np.ndarray
    centre: np.ndarray
    level: float


def least_squares(train: Moments, features: Sequence[str], target: str, penalty: float = 0.0) -> Line:
    """Least squares with `penalty` times the squared weights of the standardised features; the level is not penalised.
    Features without spread get no weight; of dependent ones the shortest solution is taken."""
    names = tuple(features)
    products = train.covariance(names, names)
    deviation = np.sqrt(np.maximum(np.diag(products), 0) / max(train.n - 1, 1))
    size = np.sqrt(np.diag(train.products)[train.place(names)] / max(train.n, 1))
    scale = np.divide(1, deviation, out=np.zeros_like(deviation), where=deviation > 1e-12 * np.maximum(size, 1e-300))
    scaled = products * np.outer(scale, scale) + penalty * np.eye(len(names))
    pull = train.covariance(names, [target])[:, 0] * scale
    weights = np.linalg.lstsq(scaled, pull, rcond=1e-12)[0]
    return Line(names, target, weights, scale, train.means(names), float(train.means([target])[0]))


def squared_error(line: Line, test: Moments) -> float:
    """The mean squared error on the rows of `test`, from their moments (NaN without rows)."""
    if test.n <= 0:
        return float("nan")
    coefficients = line.weights * line.scale
    # The residual as a combination of 1, the features and the target.
    way = np.zeros(len(test.products))
    way[0] = -(line.level - coefficients @ line.centre)
    way[test.place(line.features)] = -coefficients
    way[test.place([line.target])] += 1
    return float(way @ test.products @ way / test.n)


def cross_validated(
    folds: dict[object, Moments], features: Sequence[str], targets: Sequence[str], penalties: dict[str, float]
) -> list[tuple[str, str, list[float]]]:
    """For each target and named penalty the squared error on every fold, fitted on the others."""
    if not folds:
        return []
    total = sum(list(folds.values())[1:], list(folds.values())[0])
    order = sorted(folds, key=repr)
    return [
        (target, name, [squared_error(least_squares(total - folds[k], features, target, penalty), folds[k]) for k in order])
        for target in targets
        for name, penalty in penalties.items()
    ]
