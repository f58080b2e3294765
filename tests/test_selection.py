"""Forward and backward selection against refits of every candidate."""

import numpy as np
import pytest

from icuflow.operators import moments, selection

NAMES = [f"x{k}" for k in range(8)]


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(150, 8)) * [1, 2, 3, 1, 100, 0.1, 1, 0]
    x[:, 6] = x[:, 0] + x[:, 1]
    x[:, 3] += 0.8 * x[:, 0]
    y = x[:, 0] - 0.7 * x[:, 1] + 0.4 * x[:, 2] + 0.3 * x[:, 3] + 5 * x[:, 5] + draw.normal(size=150)
    frame = spark.createDataFrame([(0, *map(float, r), float(t)) for r, t in zip(x, y, strict=True)], f"k int, {', '.join(f'{n} double' for n in NAMES)}, y double")
    return x, y, moments.moments(frame, [*NAMES, "y"], "k")[0]


def squares(x, y, chosen):
    if not chosen:
        return ((y - y.mean()) ** 2).sum()
    z = x[:, chosen] - x[:, chosen].mean(axis=0)
    w = np.linalg.lstsq(z, y - y.mean(), rcond=1e-10)[0]
    return ((y - y.mean() - z @ w) ** 2).sum()


def test_forward_is_that_of_refits(table):
    x, y, own = table
    got = selection.forward(own, NAMES, "y")
    chosen = []
    for name, left in got:
        free = [k for k in range(8) if k not in chosen]
        best = min(free, key=lambda k: (round(squares(x, y, [*chosen, k]), 8), k))
        assert NAMES.index(name) == best and left == pytest.approx(squares(x, y, [*chosen, best]))
        chosen.append(best)
    # One of three dependent features, and the one without spread, are never taken.
    assert len(got) == 6 and "x7" not in dict(got)
    assert selection.forward(own, NAMES, "y", 2) == got[:2]


def test_backward_is_that_of_refits(table):
    x, y, own = table
    got = selection.backward(own, NAMES, "y", keep=2)
    assert [n for n, _ in got[:2]] == ["x6", "x7"] and len(got) == 6
    inside = list(range(6))
    for name, left in got[2:]:
        best = min(inside, key=lambda k: (round(squares(x, y, [j for j in inside if j != k]), 8), k))
        assert NAMES.index(name) == best
        inside.remove(best)
        assert left == pytest.approx(squares(x, y, inside))


def test_a_sweep_is_undone_by_its_reverse():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(20, 4))
    a = x.T @ x
    assert selection.sweep(selection.sweep(a, 2), 2, out=True) == pytest.approx(a)
    inside = selection.sweep(selection.sweep(a, 0), 1)
    assert inside[:2, 2] == pytest.approx(np.linalg.lstsq(x[:, :2], x[:, 2], rcond=None)[0])
