"""Range-partitioned ordered operators against plain windows and brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from icuflow.operators import ordered, stats


@pytest.fixture(scope="module")
def skewed(spark):
    """900 rows; one key holds a third of them, with ties and gaps."""
    draw = random.Random(5)
    rows = []
    for i in range(900):
        key = 0 if i % 3 == 0 else draw.randrange(1, 40)
        rows.append((i, key, draw.randrange(60), draw.choice([None, draw.random() * 10]), draw.randrange(5)))
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "id long, key long, time long, x double, n long")
    return ordered.stable(frame)


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y, abs=1e-9)


@pytest.mark.parametrize("pieces", [1, 4, 16])
@pytest.mark.parametrize("keys", [["key"], []])
def test_running_matches_window(skewed, pieces, keys):
    w = Window.partitionBy(*keys).orderBy("time", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = skewed.withColumns({"s": F.sum("n").over(w), "l": F.last("x", True).over(w)})
    got = ordered.running(skewed, ["time", "id"], keys, totals={"s": F.col("n")}, latest={"l": F.col("x")}, pieces=pieces)
    assert rows_of(got, "id", "s") == rows_of(expected, "id", "s")
    assert {r["id"]: r["l"] for r in got.collect()} == {r["id"]: r["l"] for r in expected.collect()}


@pytest.mark.parametrize("pieces", [1, 4, 16])
@pytest.mark.parametrize("keys", [["key"], []])
def test_neighbours_match_window(skewed, pieces, keys):
    def make(w):
        return {
            "back": F.lag("id", 3).over(w),
            "ahead": F.lead("id", 2).over(w),
            "low": F.min("n").over(w.rowsBetween(-6, 0)),
            "count": F.count("x").over(w.rowsBetween(-6, 0)),
        }

    expected = skewed.withColumns(make(Window.partitionBy(*keys).orderBy("time", "id")))
    got = ordered.over_neighbours(skewed, ["time", "id"], make, keys, before=6, after=2, pieces=pieces)
    pick = lambda df: {r["id"]: (r["back"], r["ahead"], r["low"], r["count"]) for r in df.collect()}
    assert pick(got) == pick(expected)


def test_neighbours_reach_over_pieces_shorter_than_the_frame(spark):
    few = spark.range(12).withColumn("v", F.col("id") * 2)
    got = ordered.over_neighbours(few, ["id"], lambda w: {"s": F.sum("v").over(w.rowsBetween(-6, 0))}, before=6, pieces=12)
    expected = {i: sum(2 * j for j in range(max(0, i - 6), i + 1)) for i in range(12)}
    assert {r["id"]: r["s"] for r in got.collect()} == expected


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("pieces", [None, 8])
def test_ranks_keep_ties(skewed, dense, pieces):
    w = Window.partitionBy("key").orderBy("time")
    expected = skewed.withColumn("r", (F.dense_rank() if dense else F.rank()).over(w))
    got = ordered.ranks(skewed, ["key"], ["time"], "r", dense, pieces)
    assert rows_of(got, "id", "r") == rows_of(expected, "id", "r")


def test_ranks_accept_missing_keys(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, None, 5), (3, None, 7), (4, 1, None)], "id int, key int, t int")
    got = {r["id"]: r["r"] for r in ordered.ranks(rows, ["key"], ["t"], "r", pieces=3).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1}


def test_positions_are_the_sorted_order(skewed):
    got = ordered.positions(skewed, [F.col("time").desc(), "id"], pieces=7).orderBy("position").collect()
    expected = sorted(((-r["time"], r["id"]) for r in skewed.collect()))
    assert [(-r["time"], r["id"]) for r in got] == expected
    assert [r["position"] for r in got] == list(range(900))


@pytest.mark.parametrize("strata", [[], ["n"]])
def test_hashed_position_is_md5_row_number(skewed, strata):
    w = Window.partitionBy(*strata).orderBy(F.md5(F.col("id").cast("string")), "id")
    expected = skewed.withColumn("position", F.row_number().over(w))
    got = ordered.hashed_position(skewed, "id", strata, digits=1)
    assert rows_of(got, "id", "position") == rows_of(expected, "id", "position")


def test_hashed_bins_follow_the_shuffle_partitions(spark, skewed):
    before, number = spark.conf.get("spark.sql.shuffle.partitions"), {}
    expected = rows_of(ordered.hashed_position(skewed, "id", ["n"], digits=1), "id", "position")
    try:
        for n in (8, 256, 257, 5000):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            number[n] = ordered.bin_digits(spark)
        spark.conf.set("spark.sql.shuffle.partitions", 257)
        found = ordered.hashed_position(skewed, "id", ["n"])
        assert "_hash" in found._jdf.queryExecution().toString() and ", 1, 4)" in found._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert number == {8: 3, 256: 3, 257: 4, 5000: 5}
    assert rows_of(found, "id", "position") == expected


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("pieces", [None, 6])
def test_latest_before_matches_brute_force(spark, inclusive, pieces):
    draw = random.Random(1)
    left = [(i, draw.randrange(4) if i % 3 else 0, draw.randrange(50)) for i in range(120)]
    right = [(draw.randrange(4) if i % 3 else 0, draw.randrange(50)) for i in range(90)]
    lf = spark.createDataFrame(left, "id int, key int, cut int")
    rf = spark.createDataFrame(right, "key int, t int")
    got = {r["id"]: r["seen"] for r in ordered.latest_before(lf, rf, ["key"], "cut", "t", "seen", inclusive, pieces).collect()}
    for i, key, cut in left:
        fits = [t for k, t in right if k == key and (t <= cut if inclusive else t < cut)]
        assert got[i] == (max(fits) if fits else None)


@pytest.mark.parametrize("sketched", [False, True])
def test_quantiles_are_exact(skewed, sketched):
    import numpy as np

    probs = {"q1": 0.25, "median": 0.5, "q99": 0.99, "low": 0.0, "top": 1.0}
    data = {}
    for r in skewed.collect():
        if r["x"] is not None:
            data.setdefault(r["key"], []).append(r["x"])
    got = {r["key"]: r for r in stats.quantiles(skewed, "x", probs, ["key"], sketched).collect()}
    assert set(got) == set(data)
    for key, values in data.items():
        assert got[key]["n"] == len(values)
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(float(np.quantile(values, p)), abs=1e-9)
    whole = stats.quantiles(skewed, "x", probs, sketched=sketched).first()
    every = [v for values in data.values() for v in values]
    for name, p in probs.items():
        assert whole[name] == pytest.approx(float(np.quantile(every, p)), abs=1e-9)


def test_sketched_quantiles_with_one_dominant_value(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    exact = rows.agg(F.percentile("x", F.array(F.lit(0.1), F.lit(0.5))).alias("p")).first()["p"]
    got = stats.quantiles(rows, "x", {"a": 0.1, "b": 0.5}, sketched=True).first()
    assert [got["a"], got["b"]] == pytest.approx(exact)


def test_results_do_not_depend_on_partitioning(spark, skewed):
    def run():
        got = ordered.running(skewed.repartition(5), ["time", "id"], ["key"], totals={"s": F.col("n")}, pieces=9)
        return rows_of(got, "id", "s")

    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("1", "4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(run())
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
