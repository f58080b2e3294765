"""Decision trees by information gain (ID3) and gain ratio (C4.5), grown level by level from counts.

All rows of a level are counted in one aggregate by (node, attribute, value, class); what is collected is one row for each
node and attribute. A category splits a node into one branch for each of its values; a number is first replaced by its
place among exact quantiles, and splits a node in two at the best of these. Where the value is missing a row goes down all
branches with its weight shared out in proportion to theirs. Rows find their branch by joins with the splits of the level,
in training and in prediction alike.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuflow.operators.stats import ranked_values
from icuflow.session import stable

#: Standard score of the confidence (25 %) with which errors of a leaf are estimated, and the slack that pruning allows.
CONFIDENCE, SLACK = 0.6744897501960817, 0.1
#: Gains below this are rounding.
LEAST_GAIN = 1e-12


@dataclass
class Node:
    """Class weights of a node; if it is split, by which attribute, at which cut (numbers), and its children by branch."""

    number: int
    depth: int
    counts: list[float]
    attribute: int | None = None
    cut: float | None = None
    gain: float = 0.0
    children: dict[str, int] = field(default_factory=dict)
    shares: dict[str, float] = field(default_factory=dict)

    @property
    def weight(self) -> float:
        return sum(self.counts)


@dataclass
class Tree:
    attributes: list[str]
    numeric: frozenset[str]
    classes: list
    nodes: dict[int, Node] = field(default_factory=lambda: {})

    def splits(self, depth: int) -> list[Node]:
        return [n for n in self.nodes.values() if n.attribute is not None and n.depth == depth]

    @property
    def depth(self) -> int:
        return max((n.depth for n in self.nodes.values()), default=0)


def _xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.log2(x)).otherwise(0.0)


def _total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def quantile_cuts(df: DataFrame, column: str, bins: int) -> list[float]:
    """The distinct values at ranks floor(n * j / bins), which cut a column into about even parts."""
    wanted = {f"q{j}": F.floor(F.col("_n") * j / bins) for j in range(1, bins)}
    row = ranked_values(df.select(F.col(column).cast("double").alias(column)), column, [j / bins for j in range(1, bins)], wanted).first()
    found = {row[name] for name in wanted} if row else set()
    return sorted(float(v) for v in found if v is not None)


def _place(column: str, cuts: Sequence[float]) -> Column:
    """Which of the parts between cuts a number is in: how many cuts are below it."""
    value = F.col(column).cast("double")
    known = value.isNotNull() & ~F.isnan(value)
    return F.when(known, _total([F.lit(0), *[(value > F.lit(c)).cast("int") for c in cuts]]))


def _values(tree: Tree, cuts: Mapping[str, Sequence[float]]) -> Column:
    own = [_place(a, cuts[a]).cast("string") if a in tree.numeric else F.col(a).cast("string") for a in tree.attributes]
    return F.array(*own)


def _candidates(rows: DataFrame, tree: Tree) -> DataFrame:
    """For every node and attribute (a, by place) the best split: its cut, gain and split information."""
    k = range(len(tree.classes))
    long = rows.select("node", "w", "y", F.posexplode("v").alias("a", "value"))
    class_sums = [F.sum(F.when(F.col("y") == i, F.col("w")).otherwise(0.0)).alias(f"w{i}") for i in k]
    counts = long.groupBy("node", "a", "value").agg(*class_sums)
    here = [F.col(f"w{i}") for i in k]
    counts = counts.withColumn("n", _total(here)).withColumn("s", _total([_xlogx(c) for c in here]))
    every = counts.groupBy("node", "a").agg(F.sum("n").alias("whole"), *[F.sum(F.when(F.col("value").isNotNull(), c)).alias(f"t{i}") for i, c in zip(k, here)])
    every = every.withColumn("known", _total([F.col(f"t{i}") for i in k]))
    # Class entropy of what is known, times its weight.
    every = every.withColumn("mixed", _xlogx(F.col("known")) - _total([_xlogx(F.col(f"t{i}")) for i in k]))
    known = counts.where(F.col("value").isNotNull()).join(every, ["node", "a"])
    numeric = [i for i, a in enumerate(tree.attributes) if a in tree.numeric]
    missing = _xlogx(F.col("whole") - F.col("known"))
    gain = lambda rest: (F.col("mixed") - rest) / F.col("whole")
    info = lambda parts: (_xlogx(F.col("whole")) - parts - missing) / F.col("whole")
    by = ["node", "a", "whole", "known", "mixed"]
    nominal = (
        known.where(~F.col("a").isin(numeric))
        .groupBy(*by)
        .agg(F.sum(_xlogx(F.col("n")) - F.col("s")).alias("rest"), F.sum(_xlogx(F.col("n"))).alias("parts"), F.count_if(F.col("n") > 0).alias("branches"), F.sort_array(F.collect_list("n"), False).alias("sizes"))
        .select("node", "a", F.lit(None).cast("int").alias("cut"), gain(F.col("rest")).alias("gain"), info(F.col("parts")).alias("info"), "branches", F.get("sizes", F.lit(1)).alias("second"))
    )
    # A node and attribute have as many rows as there are quantiles.
    order = Window.partitionBy("node", "a").orderBy("part")
    binned = known.where(F.col("a").isin(numeric)).withColumn("part", F.col("value").cast("int"))
    low = [F.sum(c).over(order) for c in here]
    binned = binned.withColumns({f"l{i}": c for i, c in zip(k, low)})
    left = [F.col(f"l{i}") for i in k]
    right = [F.col(f"t{i}") - F.col(f"l{i}") for i in k]
    left_n, right_n = _total(left), F.col("known") - _total(left)
    rest = _xlogx(left_n) - _total([_xlogx(c) for c in left]) + _xlogx(right_n) - _total([_xlogx(c) for c in right])
    cut = binned.where(right_n > 1e-9).select(
        "node", "a", F.col("part").alias("cut"), gain(rest).alias("gain"), info(_xlogx(left_n) + _xlogx(right_n)).alias("info"), F.lit(2).cast("long").alias("branches"), F.least(left_n, right_n).alias("second")
    )
    best = F.max(F.struct(F.round("gain", 12).alias("round"), (-F.col("cut")).alias("first"), "gain", "info", "branches", "second")).alias("best")
    binary = cut.groupBy("node", "a").agg(best).select("node", "a", (-F.col("best.first")).alias("cut"), "best.gain", "best.info", "best.branches", "best.second")
    return nominal.unionByName(binary)


def _branch(tree: Tree) -> Column:
    """The branch that a row takes at its node's split (columns a and cut): a value, or `low` or `high`; null if missing."""
    value = F.get("v", F.col("a"))
    return F.when(F.col("cut").isNull(), value).otherwise(F.when(value.cast("int") <= F.col("cut"), "low").otherwise(F.when(value.isNotNull(), "high")))


def _descend(rows: DataFrame, tree: Tree, depth: int) -> DataFrame:
    """Rows at the splits of a depth go on to the children, with a missing value to all of them; a value that the split has
    not seen stays."""
    splits = tree.splits(depth)
    if not splits:
        return rows
    session = rows.sparkSession
    heads = session.createDataFrame([(n.number, n.attribute, None if n.cut is None else int(n.cut)) for n in splits], "node int, a int, cut int")
    table = [(n.number, branch, child, n.shares[branch]) for n in splits for branch, child in n.children.items()]
    tails = session.createDataFrame(table, "node int, branch string, child int, share double")
    at = rows.join(F.broadcast(heads), "node", "left").withColumn("taken", _branch(tree))
    lost = F.col("taken").isNull()
    moved = at.join(F.broadcast(tails.withColumnRenamed("node", "above")), (F.col("node") == F.col("above")) & (lost | (F.col("taken") == F.col("branch"))), "left")
    weight = F.when(F.col("child").isNotNull() & lost, F.col("w") * F.col("share")).otherwise(F.col("w"))
    return moved.select(*[c for c in rows.columns if c not in ("node", "w")], F.coalesce("child", "node").alias("node"), weight.alias("w"))


def grow(
    df: DataFrame,
    attributes: Sequence[str],
    label: str,
    numeric: Sequence[str] = (),
    ratio: bool = False,
    depth: int = 5,
    least: float = 2,
    bins: int = 16,
    weight: str | None = None,
    prune: bool = False,
) -> tuple[Tree, dict[str, list[float]]]:
    """A tree and the cuts that its numbers were placed by.

    With `ratio` (C4.5) the attribute of highest gain ratio is taken among those with at least the mean gain, and a split
    needs two branches with weight `least`; otherwise (ID3) that of highest gain. Equal ones go by the attributes' order.
    `prune` replaces subtrees whose estimated errors are not below a leaf's. Rows without a label take no part; their
    number is not bounded, those of nodes, attributes, classes and quantiles are.
    """
    known = df.where(F.col(label).isNotNull())
    classes = [r[0] for r in known.select(label).distinct().orderBy(label).collect()]
    tree = Tree(list(attributes), frozenset(numeric), classes)
    cuts = {a: quantile_cuts(known, a, bins) for a in attributes if a in tree.numeric}
    y = reduce(lambda a, b: F.coalesce(a, b), [F.when(F.col(label) == F.lit(c), F.lit(i)) for i, c in enumerate(classes)], F.lit(None).cast("int"))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = stable(known.select(F.lit(0).alias("node"), y.alias("y"), w.alias("w"), _values(tree, cuts).alias("v")))
    own = {r["y"]: r["w"] for r in rows.groupBy("y").agg(F.sum("w").alias("w")).collect()}
    tree.nodes[0] = Node(0, 0, [own.get(i, 0.0) for i in range(len(classes))])
    for level in range(depth):
        active = [n.number for n in tree.nodes.values() if n.depth == level and max(n.counts, default=0) < n.weight and n.weight >= 2 * least - 1e-9]
        if not active:
            break
        here = rows.where(F.col("node").isin(active))
        found: dict[int, list] = {}
        for r in _candidates(here, tree).collect():
            found.setdefault(r["node"], []).append(r)
        for number, options in found.items():
            _choose(tree.nodes[number], options, ratio, least)
        split = tree.splits(level)
        if not split:
            break
        _add_children(tree, here.where(F.col("node").isin([n.number for n in split])), split)
        rows = _descend(rows, tree, level)
    if prune and tree.nodes:
        _prune(tree, 0)
    return tree, cuts


def _choose(node: Node, options: list, ratio: bool, least: float) -> None:
    """The best split of a node, if any has a gain."""
    fine = [r for r in options if r["gain"] is not None and r["gain"] > LEAST_GAIN and r["branches"] > 1]
    if ratio:
        fine = [r for r in fine if (r["second"] or 0) >= least - 1e-9 and r["info"] > LEAST_GAIN]
        mean = sum(r["gain"] for r in fine) / len(fine) if fine else 0
        fine = [r for r in fine if r["gain"] >= mean - 1e-9]
    if not fine:
        return
    value = lambda r: r["gain"] / r["info"] if ratio else r["gain"]
    best = min(fine, key=lambda r: (-round(value(r), 9), r["a"]))
    node.attribute, node.gain = best["a"], value(best)
    node.cut = None if best["cut"] is None else float(best["cut"])


def _add_children(tree: Tree, rows: DataFrame, split: list[Node]) -> None:
    """Class weights of all branches, in one aggregate; what is missing is shared out by the branches' weights."""
    heads = rows.sparkSession.createDataFrame([(n.number, n.attribute, None if n.cut is None else int(n.cut)) for n in split], "node int, a int, cut int")
    taken = rows.join(F.broadcast(heads), "node").withColumn("branch", _branch(tree))
    sums: dict[int, dict] = {n.number: {} for n in split}
    for r in taken.groupBy("node", "branch", "y").agg(F.sum("w").alias("w")).collect():
        sums[r["node"]].setdefault(r["branch"], [0.0] * len(tree.classes))[r["y"]] = r["w"]
    for node in split:
        own = sums[node.number]
        lost = own.pop(None, [0.0] * len(tree.classes))
        whole = sum(sum(c) for c in own.values())
        for branch in sorted(own):
            share = sum(own[branch]) / whole
            number = len(tree.nodes)
            tree.nodes[number] = Node(number, node.depth + 1, [c + share * x for c, x in zip(own[branch], lost, strict=True)])
            node.children[branch], node.shares[branch] = number, share


def estimated_errors(counts: Sequence[float]) -> float:
    """The upper confidence limit of a leaf's errors."""
    n = sum(counts)
    if not n:
        return 0.0
    f, z = 1 - max(counts) / n, CONFIDENCE
    return n * (f + z * z / (2 * n) + z * math.sqrt(f / n - f * f / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _prune(tree: Tree, number: int) -> float:
    """Estimated errors of a subtree after those below were pruned."""
    node = tree.nodes[number]
    leaf = estimated_errors(node.counts)
    if node.attribute is None:
        return leaf
    below = sum(_prune(tree, child) for child in node.children.values())
    if leaf > below + SLACK:
        return below
    node.attribute, node.cut = None, None
    stack = list(node.children.values())
    node.children, node.shares = {}, {}
    while stack:
        gone = tree.nodes.pop(stack.pop())
        stack += gone.children.values()
    return leaf


def predict(df: DataFrame, key: str, tree: Tree, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """Columns key, prediction and certainty (one share a class, in the order of the classes) for every row; `key` must be
    unique. A value that a split has not seen, and a node without weight, are judged by the node above or the first class."""
    rows = df.select(key, F.lit(0).alias("node"), F.lit(1.0).alias("w"), _values(tree, cuts).alias("v"))
    for level in range(tree.depth + 1):
        rows = _descend(rows, tree, level)
    shares = [(n.number, [float(c) / n.weight if n.weight else 0.0 for c in n.counts]) for n in tree.nodes.values()]
    leaves = df.sparkSession.createDataFrame(shares, "node int, share array<double>")
    parts = rows.join(F.broadcast(leaves), "node")
    sums = [F.sum(F.col("w") * F.get("share", F.lit(i))).alias(f"c{i}") for i in range(len(tree.classes))]
    added = parts.groupBy(key).agg(*sums).withColumn("certainty", F.array(*[F.col(f"c{i}") for i in range(len(tree.classes))]))
    place = F.array_position(F.transform("certainty", lambda x: F.round(x, 9)), F.round(F.array_max("certainty"), 9)) - 1
    names = F.array(*[F.lit(c) for c in tree.classes])
    return added.select(key, F.get(names, place.cast("int")).alias("prediction"), "certainty")


def described(tree: Tree, cuts: Mapping[str, Sequence[float]]) -> list[tuple[str, str | None, float | None, float | None, float]]:
    """(path, attribute, cut, gain, weight) of every node; a path names the branches from the root on."""
    out = []

    def walk(number: int, path: str) -> None:
        node = tree.nodes[number]
        name = None if node.attribute is None else tree.attributes[node.attribute]
        cut = None if node.cut is None else cuts[name][int(node.cut)]
        out.append((path, name, cut, node.gain if name else None, node.weight))
        for branch, child in node.children.items():
            walk(child, f"{path}/{name}={branch}")

    walk(0, "")
    return out
