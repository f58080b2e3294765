"""A small network of rectified units and a two-class softmax, trained by gradient descent with momentum.

Training is data-parallel: in each step every task computes the loss and the gradient of its blocks at the same weights,
these are added up, and the driver, which holds nothing but the weights, moves them. The rows are dealt into blocks at
random when they are stored; in each epoch the blocks are dealt anew into the epoch's steps.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.operators.blocks import Blocks, partial_sums, summed
from icuflow.operators.search import Space, spaces_of


@dataclass
class Net:
    """Weights by layer (inputs by units, the last row is the constant), and the features they were fitted in."""

    space: Space
    hidden: np.ndarray
    output: np.ndarray
    losses: list[float] = field(default_factory=list)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.hidden.ravel(), self.output.ravel()])

    def moved(self, flat: np.ndarray) -> Net:
        size = self.hidden.size
        return Net(self.space, flat[:size].reshape(self.hidden.shape), flat[size:].reshape(self.output.shape), self.losses)


def _with_constant(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def _forward(net: Net, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and units with constants, and the classes' probabilities."""
    inputs = _with_constant(np.nan_to_num((x - net.space.mean) * net.space.scale))
    units = _with_constant(np.maximum(inputs @ net.hidden, 0))
    raw = units @ net.output
    raw = np.exp(raw - raw.max(axis=1, keepdims=True))
    return inputs, units, raw / raw.sum(axis=1, keepdims=True)


def gradient(net: Net, block: dict) -> dict[int, np.ndarray]:
    """Rows, summed cross entropy and its gradient, flat."""
    count = block["train"][:, net.space.group]
    own = np.flatnonzero(count)
    n, y = count[own], block["y"][own].astype(int)
    inputs, units, chance = _forward(net, block["x"][own])
    loss = -(n * np.log(np.maximum(chance[np.arange(len(y)), y], 1e-300))).sum()
    gap = chance.copy()
    gap[np.arange(len(y)), y] -= 1
    gap *= n[:, None]
    back = (gap @ net.output[:-1].T) * (units[:, :-1] > 0)
    return {0: np.concatenate([[n.sum(), loss], (inputs.T @ back).ravel(), (units.T @ gap).ravel()])}


def start(space: Space, units: int, seed: int = 0) -> Net:
    """Random weights of a size that keeps the units' spread; constants at 0."""
    draw, d = np.random.default_rng(seed), len(space.mean)
    hidden = np.vstack([draw.normal(scale=np.sqrt(2 / d), size=(d, units)), np.zeros((1, units))])
    output = np.vstack([draw.normal(scale=np.sqrt(1 / units), size=(units, 2)), np.zeros((1, 2))])
    return Net(space, hidden, output)


def fit(
    blocks: Blocks, group: int = 0, units: int = 10, epochs: int = 200, steps: int = 1, rate: float = 0.1, momentum: float = 0.9, seed: int = 0
) -> Net:
    """A network fitted on a group's training rows; `losses` has the mean cross entropy of each step before it was taken."""
    net = start(spaces_of(blocks, [(group, None)])[0], units, seed)
    speed = np.zeros(len(net.flat()))
    for epoch in range(epochs):
        for step in range(steps):
            rows = blocks.in_passes()
            if steps > 1:
                rows = rows.where(F.pmod(F.xxhash64("block", F.lit(seed), F.lit(epoch)), F.lit(steps)) == step)
            partials = rows.mapInArrow(partial(partial_sums, partial(gradient, net)), "key long, value array<double>")
            got = summed(partials).get(0)
            if got is None or not got[0]:
                continue
            net.losses.append(float(got[1] / got[0]))
            speed = momentum * speed - rate * got[2:] / got[0]
            net = net.moved(net.flat() + speed)
    return net


def _scored(net: Net, block: dict) -> dict[str, np.ndarray]:
    own = np.flatnonzero(block["test"][:, net.space.group])
    chance = _forward(net, block["x"][own])[2]
    return {"label": block["y"][own].astype(np.int32), "score": chance[:, 1], "prediction": chance.argmax(axis=1).astype(np.int32)}


def scored(blocks: Blocks, net: Net) -> DataFrame:
    """Columns label, score (the chance of class 1) and prediction of every row that the group tests."""
    return blocks.rows_of(partial(_scored, net), "label int, score double, prediction int")
