"""The small network: gradients by differences, steps against one machine, and a task that needs hidden units."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from icuflow.operators import blocks as blocks_module
from icuflow.operators import metrics, network
from icuflow.operators.blocks import Blocks, counts
from icuflow.operators.search import Space


def block(draw, n=40, d=3):
    x = draw.normal(size=(n, d))
    x[0, 0] = np.nan
    return {"x": x, "y": draw.integers(0, 2, n).astype(float), "train": draw.integers(0, 3, (n, 1)).astype(float), "test": np.ones((n, 1)), "block": 1}


def test_gradients_are_those_of_differences():
    draw = np.random.default_rng(0)
    rows = block(draw)
    net = network.start(Space(0, np.array([0.1, 0.2, 0.3]), np.array([1.0, 2.0, 0.5])), 6, seed=3)
    net = net.moved(net.flat() + draw.normal(scale=0.1, size=len(net.flat())))
    own = network.gradient(net, rows)[0]
    for k in range(len(net.flat())):
        nudge = np.zeros(len(net.flat()))
        nudge[k] = 1e-6
        up, down = (network.gradient(net.moved(net.flat() + s * nudge), rows)[0][1] for s in (1, -1))
        assert own[2 + k] == pytest.approx((up - down) / 2e-6, abs=1e-5)


@pytest.fixture(scope="module")
def rings(spark):
    draw = np.random.default_rng(1)
    rows = []
    for i in range(300):
        y, angle = i % 2, draw.uniform(0, 2 * np.pi)
        radius = (1.0 if y else 3.0) + draw.normal(scale=0.2)
        rows.append(([float(radius * np.cos(angle)), float(radius * np.sin(angle))], float(y), i))
    frame = spark.createDataFrame(rows, "x array<double>, y double, i int").repartition(3)
    train = F.col("i") % 3 > 0
    return rows, Blocks(frame, "x", "y", (counts(train), counts(~train)))


def test_steps_are_those_of_one_machine(rings):
    rows, blocks = rings
    net = network.fit(blocks, epochs=4, rate=0.2, momentum=0.9)
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    train = (np.arange(300) % 3 > 0).astype(float)[:, None]
    own = network.start(net.space, 10)
    speed = np.zeros(len(own.flat()))
    for _ in range(4):
        got = network.gradient(own, {"x": x, "y": y, "train": train})[0]
        speed = 0.9 * speed - 0.2 * got[2:] / got[0]
        own = own.moved(own.flat() + speed)
    assert net.flat() == pytest.approx(own.flat(), abs=1e-9) and len(net.losses) == 4


def test_hidden_units_tell_rings_apart(rings):
    _, blocks = rings
    net = network.fit(blocks, epochs=40, rate=0.5, steps=2)
    assert net.losses[-1] < 0.5 * net.losses[0] and len(net.losses) > 40
    area = metrics.auroc(network.scored(blocks, net), "score", "label").first()
    assert area["auroc"] > 0.95 and area["n_pos"] + area["n_neg"] == 100


def test_a_pass_starts_few_tasks_however_many_parts_are_stored(spark, rings, monkeypatch):
    rows, few = rings
    name, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(name, "48")
    try:
        frame = spark.createDataFrame(rows, "x array<double>, y double, i int").repartition(48)
        train = F.col("i") % 3 > 0
        blocks = Blocks(frame, "x", "y", (counts(train), counts(~train)))
    finally:
        spark.conf.set(name, before)
    tasks, summed = [], blocks_module.summed
    counted = lambda partials: tasks.append(partials.rdd.getNumPartitions()) or summed(partials)
    monkeypatch.setattr(blocks_module, "summed", counted)
    monkeypatch.setattr(network, "summed", counted)
    net = network.fit(blocks, epochs=3)
    assert len(tasks) > 3 and max(tasks) <= 4 * spark.sparkContext.defaultParallelism < blocks.rows.rdd.getNumPartitions()
    # All rows take part in each pass.
    assert net.flat() == pytest.approx(network.fit(few, epochs=3).flat(), abs=1e-9)
