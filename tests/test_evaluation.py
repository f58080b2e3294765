"""Statistics, metrics and preparation against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from icuflow.operators import metrics, prep, stats


@pytest.fixture(scope="module")
def scored(spark):
    """Scores with many ties; one score holds a third of the rows."""
    draw = random.Random(3)
    rows = [(i, 0.5 if i % 3 == 0 else draw.randrange(12) / 12, int(draw.random() < 0.4), draw.randrange(4)) for i in range(400)]
    return spark.createDataFrame(rows, "id long, score double, label int, fold int")


def brute_auroc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auroc_counts_ties_half(scored):
    rows = [(r["score"], r["label"]) for r in scored.collect()]
    got = metrics.auroc(scored, "score", "label").first()["auroc"]
    assert got == pytest.approx(brute_auroc(rows))
    turned = metrics.auroc(scored.withColumn("score", -F.col("score")), "score", "label").first()["auroc"]
    assert got + turned == pytest.approx(1.0)


def test_auroc_per_group_and_degenerate(spark, scored):
    got = {r["fold"]: r["auroc"] for r in metrics.auroc(scored, "score", "label", ["fold"]).collect()}
    for fold in range(4):
        rows = [(r["score"], r["label"]) for r in scored.collect() if r["fold"] == fold]
        assert got[fold] == pytest.approx(brute_auroc(rows))
    assert metrics.auroc(scored.filter("label = 1"), "score", "label").first()["auroc"] is None


def curve(rows):
    fpr, tpr = [0.0], [0.0]
    p, n = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    for s in sorted({s for s, _ in rows}, reverse=True):
        tpr.append(sum(1 for v, y in rows if v >= s and y == 1) / p)
        fpr.append(sum(1 for v, y in rows if v >= s and y == 0) / n)
    return fpr, tpr


def test_roc_curve(scored):
    fpr, tpr = curve([(r["score"], r["label"]) for r in scored.collect()])
    got = metrics.roc_curve(scored, "score", "label").orderBy(F.desc("threshold")).collect()
    assert [r["fpr"] for r in got] == pytest.approx(fpr[1:]) and [r["tpr"] for r in got] == pytest.approx(tpr[1:])


def test_mean_roc_is_the_average_of_interpolated_curves(scored):
    grid = np.linspace(0, 1, 100)
    curves = []
    for fold in range(4):
        fpr, tpr = curve([(r["score"], r["label"]) for r in scored.collect() if r["fold"] == fold])
        curves.append(np.interp(grid, fpr, tpr))
    expected = np.mean(curves, axis=0)
    expected[0], expected[-1] = 0.0, 1.0
    got = metrics.mean_roc(scored, "score", "label", "fold").orderBy("point").collect()
    assert len(got) == 100
    assert [r["tpr"] for r in got] == pytest.approx(list(expected), abs=1e-9)


def test_baselines(scored):
    guessed = metrics.random_guess(scored, "label", "id")
    totals = guessed.agg(F.sum("guess"), F.sum("label")).first()
    assert totals[0] == totals[1]
    mean = metrics.mean_guess(scored, "score")
    expected = scored.agg(F.avg("score")).first()[0]
    assert mean.first()["guess"] == pytest.approx(expected)
    noisy = metrics.mean_guess(scored, "score", noise=1.0, seed=1).agg(F.avg("guess"), F.stddev("guess")).first()
    assert abs(noisy[0] - expected) < 0.3 and 0.8 < noisy[1] < 1.2


def samples(spark, first, second):
    rows = [("a", float(x)) for x in first] + [("b", float(x)) for x in second]
    return spark.createDataFrame(rows, "g string, v double")


def test_ks_matches_brute_force(spark):
    draw = random.Random(9)
    a = [round(draw.gauss(0, 1), 1) for _ in range(150)]
    b = [round(draw.gauss(0.4, 1), 1) for _ in range(90)]
    got = stats.ks_two_sample(samples(spark, a, b), "v", "g", "a", "b").first()
    d = max(abs(sum(x <= t for x in a) / 150 - sum(x <= t for x in b) / 90) for t in {*a, *b})
    en = math.sqrt(150 * 90 / 240)
    z = (en + 0.12 + 0.11 / en) * d
    p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 101))
    assert got["statistic"] == pytest.approx(d) and got["p_value"] == pytest.approx(p)


def test_ks_of_identical_samples(spark):
    got = stats.ks_two_sample(samples(spark, [1, 2, 3], [1, 2, 3]), "v", "g", "a", "b").first()
    assert (got["statistic"], got["p_value"]) == (0.0, 1.0)


def test_ks_of_an_empty_sample_is_unknown(spark):
    got = stats.ks_two_sample(samples(spark, [1, 2, 3], []), "v", "g", "a", "b").first()
    assert (got["statistic"], got["p_value"], got["n_second"]) == (None, None, 0)


def test_kde_without_spread_is_unknown(spark):
    got = stats.kde_grid(samples(spark, [2, 2, 2], [1, 2]), "v", "g", 5).collect()
    assert {r["density"] for r in got if r["g"] == "a"} == {None}
    assert all(r["density"] > 0 for r in got if r["g"] == "b")


def test_skew_is_bias_corrected(spark):
    frame = samples(spark, [1, 2, 9], [1, 2])
    got = {r["g"]: r["s"] for r in frame.groupBy("g").agg(stats.corrected_skew(F.col("v")).alias("s")).collect()}
    x = np.array([1.0, 2.0, 9.0])
    g1 = ((x - 4) ** 3).mean() / (((x - 4) ** 2).mean() ** 1.5)
    assert got["a"] == pytest.approx(g1 * math.sqrt(6) / 1) and got["b"] is None


def test_outcome_stats_skip_missing(spark):
    rows = [(1, 1.0, None), (1, 2.0, 5.0), (1, 4.0, 6.0), (0, None, 7.0)]
    got = stats.outcome_stats(spark.createDataFrame(rows, "y int, a double, b double"), ["a", "b"], "y")
    found = {(r["feature"], r["y"]): (r["n"], r["median"]) for r in got.collect()}
    assert found == {("a", 1): (3, 2.0), ("b", 1): (2, 5.5), ("b", 0): (1, 7.0)}


def test_kde_integrates_to_one_and_matches_numpy(spark):
    draw = random.Random(2)
    x = np.array([draw.gauss(5, 2) for _ in range(200)])
    got = stats.kde_grid(samples(spark, x, [0.0, 1.0]), "v", "g", 200).filter("g = 'a'").orderBy("point").collect()
    at, density = np.array([r["at"] for r in got]), np.array([r["density"] for r in got])
    h = 200 ** (-0.2) * x.std(ddof=1)
    expected = np.exp(-(((x[None, :] - at[:, None]) / h) ** 2) / 2).mean(axis=1) / (h * math.sqrt(2 * math.pi))
    assert density == pytest.approx(expected)
    assert np.trapezoid(density, at) == pytest.approx(1.0, abs=1e-3)


def test_histogram_closes_the_last_edge(spark):
    got = stats.histogram_by_group(samples(spark, [0, 1, 10], [5, 10]), "v", "g", 5)
    some = {("a", 0): 2, ("a", 4): 1, ("b", 2): 1, ("b", 4): 1}
    assert {(r["g"], r["bin"]): r["n"] for r in got.collect()} == {(g, b): some.get((g, b), 0) for g in "ab" for b in range(5)}
    flat = stats.histogram_by_group(samples(spark, [3, 3], [3]), "v", "g", 5)
    assert sum(r["n"] for r in flat.collect()) == 3


def test_box_stats(spark):
    got = {r["g"]: r for r in stats.box_stats(samples(spark, [1, 2, 3, 4, 100], [7]), "v", "g").collect()}
    a = got["a"]
    assert (a["q1"], a["median"], a["q3"], a["whisker_low"], a["whisker_high"], a["outliers"]) == (2, 3, 4, 1, 4, 1)
    assert (got["b"]["median"], got["b"]["outliers"]) == (7, 0)


def test_first_measurement_takes_the_largest_of_the_earliest(spark):
    rows = [(1, "2020-01-01 01:00:00", 5.0), (1, "2020-01-01 01:00:00", 7.0), (1, "2020-01-02 00:00:00", 9.0), (2, "2020-01-01 00:00:00", None)]
    frame = spark.createDataFrame(rows, "k int, t string, v double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert {r["k"]: r["f"] for r in stats.first_measurement(frame, ["k"], "t", "v", "f").collect()} == {1: 7.0, 2: None}


# --- preparation -----------------------------------------------------------------------------


def test_impute_fits_on_train_or_everything(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    every = spark.createDataFrame([(1.0,), (3.0,), (None,), (11.0,)], "x double")
    assert sorted(r["x"] for r in prep.mean_impute(every, ["x"], train).collect()) == [1, 2, 3, 11]
    assert sorted(r["x"] for r in prep.mean_impute(every, ["x"]).collect()) == [1, 3, 5, 11]


def test_standardize_uses_the_given_statistics(spark):
    train = spark.createDataFrame([(0.0, 5.0), (2.0, 5.0)], "x double, flat double")
    test = spark.createDataFrame([(2.0, 5.0), (4.0, 6.0)], "x double, flat double")
    by_train = prep.standardize(test, ["x", "flat"], train)
    assert by_train.columns == ["x"]
    assert [r["x"] for r in by_train.collect()] == pytest.approx([1 / math.sqrt(2), 3 / math.sqrt(2)])
    own = [r["x"] for r in prep.standardize(test, ["x"]).collect()]
    assert own == pytest.approx([-1 / math.sqrt(2), 1 / math.sqrt(2)])


def test_ordered_split_cuts_inside_a_tied_time(spark):
    days = spark.range(100).select("id", F.when(F.col("id") % 3 == 0, F.lit("2020-01-01")).otherwise(F.lit("2020-01-02")).cast("timestamp_ntz").alias("t"))
    got = prep.ordered_split(days, "t", "id", 0.7)
    order = [r["id"] for r in days.orderBy("t", "id").collect()]
    assert {r["id"] for r in got.filter("split = 'train'").collect()} == set(order[:70])


def test_folds_are_disjoint_and_balanced(spark):
    frame = spark.range(503).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    got = prep.stratified_folds(frame, "y", "id", 10)
    assert got.count() == 503
    for label in (0, 1):
        counts = [r["count"] for r in got.filter(F.col("y") == label).groupBy("fold").count().collect()]
        assert len(counts) == 10 and max(counts) - min(counts) <= 1


def test_downsample_reaches_the_share(spark):
    frame = spark.range(1000).select("id", (F.col("id") < 50).cast("int").alias("y"))
    kept = {r["y"]: r["count"] for r in prep.downsample_majority(frame, "y", "id").groupBy("y").count().collect()}
    assert kept == {1: 50, 0: 200}


def test_bootstrap_size_seed_and_source(spark):
    frame = spark.range(40).withColumnRenamed("id", "key")
    one = prep.bootstrap(frame, "key", 500, seed=1)
    again, other = prep.bootstrap(frame, "key", 500, seed=1), prep.bootstrap(frame, "key", 500, seed=2)
    pick = lambda df: sorted(r["key"] for r in df.collect())
    assert len(pick(one)) == 500 and pick(one) == pick(again) != pick(other)
    assert set(pick(one)) == set(range(40))


def test_hash_split_and_kfold_need_no_shuffle(spark):
    frame = prep.kfold(prep.hash_split(spark.range(1000), "id"), "id", 5)
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    counts = {r["split"]: r["count"] for r in frame.groupBy("split").count().collect()}
    assert sum(counts.values()) == 1000 and 400 < counts["train"] < 600


def test_sample_by_label(spark):
    frame = spark.range(2000).select("id", (F.col("id") % 2).cast("int").alias("y"))
    kept = {r["y"]: r["count"] for r in prep.sample_fraction(frame, "y", {0: 0.2, 1: 1.0}, seed=1).groupBy("y").count().collect()}
    assert kept[1] == 1000 and 140 < kept[0] < 260


def test_dictionary_as_a_table(spark):
    from icuflow.functions import items

    book = items.as_frame(spark, items.VITALS)
    row = book.filter("item = '678'").first()
    assert (row["label"], row["lo"], row["hi"], row["offset"], row["scale"]) == ("tempc", 70.0, 120.0, 32.0, 1.8)
    assert book.count() == len(items.codes(items.VITALS))


def test_hashed_normal_draws(spark):
    drawn = np.array([r["z"] for r in spark.range(4000).select(metrics.hashed_normal("id", 3).alias("z")).collect()])
    again = np.array([r["z"] for r in spark.range(4000).repartition(5).select(metrics.hashed_normal("id", 3).alias("z")).collect()])
    assert np.sort(drawn) == pytest.approx(np.sort(again))
    assert abs(drawn.mean()) < 0.05 and abs(drawn.std() - 1) < 0.05 and 0.66 < (np.abs(drawn) < 1).mean() < 0.71
    stays = spark.range(100).select(F.col("id"), (F.col("id") % 4).cast("double").alias("los"))
    guessed = metrics.mean_guess(stays, "los", stays.where("id < 40"), noise=2.0, key="id").collect()
    assert np.mean([r["guess"] for r in guessed]) == pytest.approx(1.5, abs=0.8) and len({r["guess"] for r in guessed}) == 100
