"""Cross-validated least squares from fold moments, against fits of every fold in numpy."""

import numpy as np
import pytest

from icuflow.operators import moments as m

NAMES = ["a", "b", "flat", "twin"]


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(200, 4)) * [1, 50, 0, 1] + [1e6, -3, 4, 0]
    x[:, 3] = 2 * x[:, 0]
    y = x[:, 0] - 0.1 * x[:, 1] + draw.normal(size=200)
    return x, y, np.arange(200) % 4


@pytest.fixture(scope="module")
def folds(spark, rows):
    x, y, fold = rows
    data = [(*map(float, r), float(t), float(-t), int(f)) for r, t, f in zip(x, y, fold, strict=True)]
    data += [(None, 1.0, 1.0, 1.0, 1.0, 1.0, 0), (1.0, 1.0, 1.0, 1.0, None, 1.0, 1), (1.0,) * 6 + (None,)]
    frame = spark.createDataFrame(data, "a double, b double, flat double, twin double, y double, z double, fold int")
    return m.moments(frame.repartition(3), [*NAMES, "y", "z"], "fold")


def by_hand(x, y, test, penalty):
    train, names = ~test, x.std(axis=0) > 0
    z = (x[:, names] - x[train][:, names].mean(axis=0)) / x[train][:, names].std(axis=0, ddof=1)
    g = z[train].T @ z[train] + penalty * np.eye(names.sum())
    w = np.linalg.pinv(g, rcond=1e-10) @ (z[train].T @ (y[train] - y[train].mean()))
    return np.mean((z[test] @ w + y[train].mean() - y[test]) ** 2)


@pytest.mark.parametrize("penalty", [0.0, 1.0, 500.0])
def test_errors_are_those_of_single_fits(rows, folds, penalty):
    x, y, fold = rows
    got = m.cross_validated(folds, NAMES, ["y", "z"], {"ridge": penalty})
    assert [(t, n) for t, n, _ in got] == [("y", "ridge"), ("z", "ridge")]
    for _, _, errors in got:
        assert errors == pytest.approx([by_hand(x, y, fold == k, penalty) for k in range(4)], rel=1e-6)


def test_moments_add_up(rows, folds):
    x, _, fold = rows
    assert sorted(folds) == [0, 1, 2, 3] and [folds[k].n for k in range(4)] == [50] * 4
    total = sum([folds[1], folds[2], folds[3]], folds[0])
    assert total.covariance(["a"], ["b"])[0, 0] == pytest.approx(((x[:, 0] - x[:, 0].mean()) * x[:, 1]).sum(), rel=1e-6)
    assert (total - folds[0]).n == 150 and (fold == 0).sum() == 50


def test_no_rows(spark):
    empty = spark.createDataFrame([], "a double, y double, fold int")
    assert m.moments(empty, ["a", "y"], "fold") == {} and m.cross_validated({}, ["a"], ["y"], {"x": 0.0}) == []
