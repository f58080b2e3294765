"""Forward selection and backward elimination for least squares, from one aggregate.

The rows are added up once to the products of all features and the target. Taking a feature in or out is a sweep of that
small matrix, after which its diagonal tells what every other feature would gain or cost; no model is fitted again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from icuflow.operators.moments import Moments

#: Part of a feature's own squares below which it is taken to depend on those chosen.
TOLERANCE = 1e-9


def sweep(a: np.ndarray, k: int, out: bool = False) -> np.ndarray:
    """The matrix after taking variable k in (or out)."""
    d = a[k, k]
    b = a - np.outer(a[:, k], a[k, :]) / d
    b[:, k] = a[:, k] / d * (-1 if out else 1)
    b[k, :] = a[k, :] / d * (-1 if out else 1)
    b[k, k] = -1 / d
    return b


def _centred(moments: Moments, features: Sequence[str], target: str) -> np.ndarray:
    names = [*features, target]
    return moments.covariance(names, names)


def forward(moments: Moments, features: Sequence[str], target: str, steps: int | None = None) -> list[tuple[str, float]]:
    """(feature, squares left) in the order of choice: each time the feature that explains most of what is left, equal ones
    by their order. Features that depend on those chosen are never taken."""
    a = _centred(moments, features, target)
    own, t, chosen, out = np.diag(a).copy(), len(features), [], []
    for _ in range(min(steps or len(features), len(features))):
        free = [k for k in range(t) if k not in chosen and a[k, k] > TOLERANCE * own[k] and own[k] > 0]
        if not free:
            break
        best = max(free, key=lambda k: (round(a[k, t] ** 2 / a[k, k] / max(own[t], 1e-300), 12), -k))
        a = sweep(a, best)
        chosen.append(best)
        out.append((features[best], float(a[t, t])))
    return out


def backward(moments: Moments, features: Sequence[str], target: str, keep: int = 1) -> list[tuple[str, float]]:
    """(feature, squares left) in the order of elimination, down to `keep` features: each time the feature that is missed
    least, equal ones by their order. Features that depend on the others are left out first, at no cost."""
    a = _centred(moments, features, target)
    own, t = np.diag(a).copy(), len(features)
    inside, out = [], []
    for k in range(t):
        if own[k] > 0 and a[k, k] > TOLERANCE * own[k]:
            a = sweep(a, k)
            inside.append(k)
    left_out = [k for k in range(t) if k not in inside]
    out += [(features[k], float(a[t, t])) for k in left_out[: max(0, t - keep)]]
    while len(inside) > keep:
        worst = min(inside, key=lambda k: (round(-(a[k, t] ** 2) / a[k, k] / max(own[t], 1e-300), 12), k))
        a = sweep(a, worst, out=True)
        inside.remove(worst)
        out.append((features[worst], float(a[t, t])))
    return out
