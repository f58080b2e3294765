"""ID3 and C4.5 against small recursive versions on one machine."""

import math
import random
from collections import Counter, defaultdict

import pytest

from icuflow.operators import trees

CLASSES = ["no", "perhaps", "yes"]


def entropy(weights):
    total = sum(weights)
    return -sum(w / total * math.log2(w / total) for w in weights if w > 0) if total else 0.0


def by_class(rows):
    out = Counter()
    for _, y, w in rows:
        out[y] += w
    return out


def options(rows, attributes, cuts):
    """(attribute number, cut, branches, gain, information) of each attribute's best split."""
    whole = sum(w for *_, w in rows)
    for a, name in enumerate(attributes):
        known = [r for r in rows if r[0][name] is not None]
        lost = whole - sum(w for *_, w in known)
        best = None
        for cut in (range(len(cuts[name])) if name in cuts else [None]):
            parts = defaultdict(list)
            for r in known:
                v = r[0][name]
                parts[v if cut is None else ("low" if sum(c < v for c in cuts[name]) <= cut else "high")].append(r)
            if len(parts) < 2:
                continue
            sizes = {b: sum(w for *_, w in p) for b, p in parts.items()}
            n = sum(sizes.values())
            gain = n / whole * (entropy(by_class(known).values()) - sum(s / n * entropy(by_class(parts[b]).values()) for b, s in sizes.items()))
            info = entropy([*sizes.values(), lost])
            if best is None or round(gain, 12) > round(best[3], 12):
                best = (a, cut, dict(parts), gain, info)
        if best:
            yield best


def grown(rows, attributes, cuts, ratio, depth, least, path=""):
    """Nested (path, attribute, cut, weight) tuples, top down."""
    counts = by_class(rows)
    whole = sum(counts.values())
    node = [path, None, None, whole, counts, []]
    if depth and len([c for c in counts.values() if c > 0]) > 1 and whole >= 2 * least - 1e-9:
        fine = [o for o in options(rows, attributes, cuts) if o[3] > 1e-12]
        if ratio:
            second = lambda o: sorted(sum(w for *_, w in p) for p in o[2].values())[-2]
            fine = [o for o in fine if second(o) >= least - 1e-9]
            mean = sum(o[3] for o in fine) / len(fine) if fine else 0
            fine = [o for o in fine if o[3] >= mean - 1e-9]
        if fine:
            value = lambda o: o[3] / o[4] if ratio else o[3]
            a, cut, parts, _, _ = min(fine, key=lambda o: (-round(value(o), 9), o[0]))
            name = attributes[a]
            node[1], node[2] = name, None if cut is None else cuts[name][cut]
            n = sum(w for p in parts.values() for *_, w in p)
            for branch in sorted(parts):
                share = sum(w for *_, w in parts[branch]) / n
                more = [(v, y, w * share) for v, y, w in rows if v[name] is None]
                node[5].append(grown(parts[branch] + more, attributes, cuts, ratio, depth - 1, least, f"{path}/{name}={branch}"))
    return node


def flat(node):
    yield (node[0], node[1], node[2], round(node[3], 6))
    for child in node[5]:
        yield from flat(child)


def pruned(node):
    leaf = trees.estimated_errors([node[4].get(c, 0) for c in CLASSES])
    if not node[5]:
        return leaf
    below = sum(map(pruned, node[5]))
    if leaf > below + trees.SLACK:
        return below
    node[1], node[2], node[5] = None, None, []
    return leaf


def certainty(node, value, attributes):
    total = sum(node[4].values())
    own = [node[4].get(c, 0) / total for c in CLASSES] if total else [0.0] * 3
    if not node[5]:
        return own
    v, weights = value[node[1]], [child[3] for child in node[5]]
    if v is None:
        shares = [known_weight(child, node) for child in node[5]]
        parts = [certainty(child, value, attributes) for child in node[5]]
        return [sum(s * p[k] for s, p in zip(shares, parts)) / sum(shares) for k in range(3)]
    branch = v if node[2] is None else ("low" if v <= node[2] else "high")
    for child in node[5]:
        if child[0].endswith(f"{node[1]}={branch}"):
            return certainty(child, value, attributes)
    return own


def known_weight(child, node):
    # Missing rows were shared out in proportion, so the proportions of all rows are those of the known ones.
    return child[3]


def table(seed, n=260, missing=0.1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        colour, size, number = draw.choice(["red", "green", "blue"]), draw.choice(["s", "l"]), float(draw.randrange(30))
        y = "yes" if (colour == "red") ^ (number > 14) else draw.choice(["no", "perhaps" if size == "l" else "no"])
        if draw.random() < 0.15:
            y = draw.choice(CLASSES)
        hide = lambda v: None if draw.random() < missing else v
        rows.append((i, {"colour": hide(colour), "size": hide(size), "number": hide(number)}, y))
    return rows


def frame(spark, rows):
    data = [(i, v["colour"], v["size"], v["number"], y) for i, v, y in rows] + [(-1, "red", "s", 1.0, None)]
    return spark.createDataFrame(data, "id int, colour string, size string, number double, y string").repartition(3)


def shape(tree, cuts):
    return sorted((path, name, cut, round(weight, 6)) for path, name, cut, _, weight in trees.described(tree, cuts))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(("ratio", "prune"), [(False, False), (True, False), (True, True)])
def test_trees_are_those_of_the_recursive_version(spark, seed, ratio, prune):
    rows, attributes = table(seed), ["colour", "size", "number"]
    df = frame(spark, rows)
    tree, cuts = trees.grow(df, attributes, "y", ["number"], ratio, 4, 2, 10, prune=prune)
    values = sorted(v["number"] for _, v, _ in rows if v["number"] is not None)
    assert cuts["number"] == sorted({values[len(values) * j // 10] for j in range(1, 10)})
    want = grown([(v, y, 1.0) for _, v, y in rows], attributes, cuts, ratio, 4, 2)
    if prune:
        pruned(want)
    assert shape(tree, cuts) == sorted(flat(want), key=lambda x: x[0])
    assert len(tree.nodes) > 5
    got = {r["id"]: r for r in trees.predict(df, "id", tree, cuts).collect()}
    assert len(got) == len(rows) + 1
    for i, v, _ in rows:
        expected = certainty(want, v, attributes)
        assert got[i]["certainty"] == pytest.approx(expected, abs=1e-6)
        assert expected[CLASSES.index(got[i]["prediction"])] == pytest.approx(max(expected), abs=1e-6)


def test_values_that_training_has_not_seen_are_judged_by_the_node(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "ny"[i % 2 == 0]) for i in range(20)] + [(20, "a", "n")], "id int, x string, y string")
    tree, cuts = trees.grow(df, ["x"], "y")
    new = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, x string")
    got = {r["id"]: r["certainty"] for r in trees.predict(new, "id", tree, cuts).collect()}
    assert got[1] == pytest.approx([1 / 11, 10 / 11]) and got[2] == pytest.approx([11 / 21, 10 / 21]) == got[3]


def test_degenerate_tables(spark):
    empty = spark.createDataFrame([], "id int, x string, y string")
    tree, cuts = trees.grow(empty, ["x"], "y")
    assert tree.classes == [] and len(tree.nodes) == 1
    same = spark.createDataFrame([(i, None, "y") for i in range(5)], "id int, x string, y string")
    tree, cuts = trees.grow(same, ["x"], "y")
    assert len(tree.nodes) == 1 and trees.predict(same, "id", tree, cuts).first()["certainty"] == [1.0]
    numbers = spark.createDataFrame([(i, None if i % 2 else float("nan"), str(i % 3)) for i in range(9)], "id int, x double, y string")
    tree, cuts = trees.grow(numbers, ["x"], "y", ["x"])
    assert len(tree.nodes) == 1


def test_weights_count_rows_several_times(spark):
    rows = table(5, 80, 0.0)
    data = [(i, v["colour"], v["size"], v["number"], y, 1 + i % 3) for i, v, y in rows]
    df = spark.createDataFrame(data, "id int, colour string, size string, number double, y string, w int")
    weighted, cuts = trees.grow(df, ["colour", "size"], "y", weight="w", depth=2)
    repeated = df.selectExpr("*", "explode(sequence(1, w)) AS again")
    plain, _ = trees.grow(repeated, ["colour", "size"], "y", depth=2)
    assert shape(weighted, cuts) == shape(plain, {})
