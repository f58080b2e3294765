"""Model helpers: sane results on data with a known answer."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from icuflow.operators import models, neighbours, prep
from icuflow.operators.search import Cell
from icuflow.plans import q_models
from icuflow.session import stable


@pytest.fixture(scope="module")
def blobs(spark):
    draw = np.random.default_rng(0)
    rows = []
    for i in range(400):
        y = i % 2
        x = draw.normal(loc=2.0 * y, size=4)
        rows.append((i, [float(v) for v in x], float(y)))
    frame = spark.createDataFrame(rows, "id long, v array<double>, label double")
    return stable(models.as_vector(frame, "v"))


@pytest.fixture(scope="module")
def rings(spark):
    """Classes told apart by radius only, so a linear model on the raw values fails."""
    draw = np.random.default_rng(1)
    rows = []
    for i in range(400):
        y, angle = i % 2, draw.uniform(0, 2 * np.pi)
        radius = (1.0 if y else 3.0) + draw.normal(scale=0.2)
        rows.append((i, [float(radius * np.cos(angle)), float(radius * np.sin(angle))], float(y)))
    return stable(spark.createDataFrame(rows, "id long, v array<double>, label double"))


ESTIMATORS = {
    "logistic": lambda: models.l2_logistic(400),
    "svm": lambda: models.l2_svm(400),
    "tree": lambda: models.entropy_tree(),
    "boosted": lambda: models.boosted(5),
    "net": lambda: models.small_net(4, epochs=50),
}


@pytest.mark.parametrize("name", ESTIMATORS)
def test_classifiers_separate_blobs(blobs, name):
    got = models.split_auroc(blobs, ESTIMATORS[name](), "id").first()
    assert got["auroc"] > 0.85 and got["accuracy"] > 0.8


def test_kernel_features_separate_rings(rings):
    plain = models.split_auroc(models.as_vector(rings, "v"), models.l2_svm(400, 10.0), "id").first()["auroc"]
    kernel = models.split_auroc(stable(models.fourier_features(rings, "v", 2, width=2.0)), models.l2_svm(400, 10.0), "id").first()["auroc"]
    assert plain < 0.75 < 0.95 < kernel


def test_fourier_features_approximate_the_kernel(rings):
    from pyspark.ml.functions import vector_to_array

    rows = models.fourier_features(rings, "v", 2, width=4.0, count=4000).limit(20).select("v", vector_to_array("features").alias("f")).collect()
    x, z = np.array([r["v"] for r in rows]), np.array([r["f"] for r in rows])
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / 4.0)
    assert np.abs(z @ z.T - exact).max() < 0.1


def test_majority_vote_counts_trees(blobs):
    fitted = models.forest(15).fit(blobs)
    got = models.majority_vote(fitted, blobs.limit(30)).collect()
    for r in got:
        votes = [int(t.predict(r["features"])) for t in fitted.trees]
        counts = [votes.count(0), votes.count(1)]
        assert r["vote"] == int(np.argmax(counts))


def test_majority_vote_follows_categories(spark):
    draw = np.random.default_rng(7)
    rows = [(i, float(draw.integers(0, 5)), float(draw.normal()), float(draw.integers(0, 3))) for i in range(300)]
    rows = [(i, a, b, c, float((a in (1, 3)) ^ (b > 0.3 * c))) for i, a, b, c in rows]
    frame = spark.createDataFrame(rows, "id long, a double, b double, c double, label double")
    fitted = models.prepared(["a", "b", "c"], models.forest(9), nominal=6).fit(frame)
    scored = fitted.transform(frame).select("id", "features")
    trees = fitted.stages[-1].trees
    got = models.majority_vote(fitted.stages[-1], scored).collect()
    for r in got[:80]:
        votes = [int(t.predict(r["features"])) for t in trees]
        assert r["vote"] == int(np.argmax([votes.count(0), votes.count(1)]))


def test_pipeline_scales_and_imputes(spark):
    rows = [(i, float(i % 7) if i % 5 else None, 1000.0 * (i % 2) + i % 3, 1.0, float(i % 2)) for i in range(120)]
    frame = spark.createDataFrame(rows, "id long, a double, b double, flat double, label double")
    fitted = models.prepared(["a", "b", "flat"], models.l2_logistic(120)).fit(frame)
    scored = models.scores(fitted, frame, ["id", "label"])
    assert scored.filter(F.col("prediction") != F.col("label")).count() == 0
    assert fitted.stages[2].selectedFeatures == [0, 1]


def test_cross_validation_and_grid(blobs):
    folded = prep.stratified_folds(blobs, "label", "id", 3)
    estimator = models.l2_logistic(400)
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.01, 1.0]).build()
    found = models.cross_validate(folded, estimator, "fold", 3, grid=grid)
    assert len(found) == 2 and all(0.9 < r["mean"] <= 1.0 and len(r["folds"]) == 3 for r in found)
    best = max(found, key=lambda r: r["mean"])
    assert models.best_fit(folded, estimator, found).getRegParam() == best["params"]["regParam"]


def test_several_models_are_validated_on_the_same_folds(spark):
    draw = np.random.default_rng(3)
    rows = [(i, float(draw.normal() + i % 2), None if i % 11 == 0 else float(draw.integers(0, 3)), float(i % 2), i % 3) for i in range(240)]
    frame = stable(spark.createDataFrame(rows, "id long, a double, b double, label double, fold int"))
    made = {"tree": models.entropy_tree(3), "logistic": models.l2_logistic(160)}
    got = models.cross_validate_several(frame, models.prepared(["a", "b"], None, nominal=4), made, "fold", 3)
    for name, estimator in made.items():
        one = models.cross_validate(frame, models.prepared(["a", "b"], estimator, nominal=4), "fold", 3)
        assert got[name] == pytest.approx(one[0]["folds"], abs=1e-9)


def test_regression_and_ridge(spark):
    frame = models.as_vector(spark.range(100).select("id", F.array(F.col("id").cast("double")).alias("x"), (F.col("id") * 2 + 1).cast("double").alias("label")), "x")
    fitted = models.least_squares().fit(frame)
    assert (fitted.coefficients[0], fitted.intercept) == pytest.approx((2.0, 1.0))
    sxx = sum((i - 49.5) ** 2 for i in range(100))
    assert models.ridge(*models.label_scale(frame), tau=1000.0).fit(frame).coefficients[0] == pytest.approx(2 * sxx / (sxx + 1000), rel=1e-6)
    assert models.split_mse(frame, models.least_squares(), "id").first()["mse"] == pytest.approx(0, abs=1e-12)


def test_pca_sweep_retains_more_with_more_dimensions(blobs):
    found = models.pca_sweep(blobs.drop("v"), "id", [1, 2, 4], lambda d: models.l2_logistic(400))
    kept = [r["retained"] for r in found]
    assert kept == sorted(kept) and kept[-1] == pytest.approx(1.0)


def test_feature_selection_keeps_the_informative(spark):
    draw = np.random.default_rng(4)
    rows = [(float(i % 2), [float(draw.normal()), float(i % 2 * 3 + draw.normal()), float(draw.normal())]) for i in range(200)]
    frame = models.as_vector(spark.createDataFrame(rows, "label double, v array<double>"), "v")
    assert models.select_features(frame, 1).selectedFeatures == [1]


def test_repeated_evaluation(blobs):
    found = models.repeated_auroc(blobs.select("id", "features", "label"), models.l2_logistic(200), "id", 400, [1, 2])
    assert [r["seed"] for r in found] == [1, 2] and all(r["auroc"] > 0.85 for r in found)


@pytest.mark.parametrize("block", [7, 4096])
def test_nearest_matches_brute_force_over_blocks(spark, block):
    draw = np.random.default_rng(8)
    points = np.round(draw.normal(size=(60, 3)), 1)
    points[40:50] = points[0]  # equal points: ties go to the smaller id
    rows = [(i, [float(x) for x in p], i % 3) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "id long, v array<double>, label int")
    q, t = frame.filter("id % 2 = 1"), frame.filter("id % 2 = 0")
    got = {}
    for r in neighbours.nearest(q, t, "id", "v", "label", 3, block).collect():
        got.setdefault(r["id"], {})[r["place"]] = r["neighbour"]
    for i in range(1, 60, 2):
        order = sorted(range(0, 60, 2), key=lambda j: (sum(float(a - b) ** 2 for a, b in zip(points[i], points[j])), j))[:3]
        assert [got[i][p] for p in (1, 2, 3)] == order


@pytest.mark.parametrize(("pivots", "block"), [(1, 4096), (9, 4096), (25, 11)])
def test_cells_give_the_same_neighbours(spark, pivots, block):
    """Clusters, equal points, a cell with a third of all rows, more neighbours wanted than a cell holds."""
    draw = np.random.default_rng(pivots)
    points = np.vstack([draw.normal(size=(20, 3)) + centre for centre in draw.normal(size=(6, 3)) * 8] + [np.zeros((60, 3))])
    rows = [(i, [float(x) for x in p], i % 3) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "id long, v array<double>, label int")
    q, t = frame.filter("id % 2 = 1"), frame.filter("id % 2 = 0")
    found, visits = neighbours.nearest_in_cells(q, t, "id", "v", "label", 7, pivots, block)
    key = lambda df: sorted((r["id"], r["place"], r["neighbour"], round(r["distance"], 9), r["label"]) for r in df.collect())
    assert key(found) == key(neighbours.nearest(q, t, "id", "v", "label", 7))
    met = [r["visits"] for r in visits.collect()]
    assert len(met) == q.count() and max(met) <= pivots
    # Most cells are skipped.
    assert pivots == 1 or np.mean(met) < 0.5 * pivots


def test_cells_of_few_rows(spark):
    frame = spark.createDataFrame([(1, [0.0], 1), (2, [1.0], 0)], "id long, v array<double>, label int")
    found, _ = neighbours.nearest_in_cells(frame.where("id = 1"), frame.where("id = 2"), "id", "v", "label", 5)
    assert [(r["id"], r["neighbour"], r["place"]) for r in found.collect()] == [(1, 2, 1)]
    found, visits = neighbours.nearest_in_cells(frame, frame.where("false"), "id", "v", "label")
    assert found.count() == 0 and {r["visits"] for r in visits.collect()} == {0}


def test_knn_votes(spark):
    rows = [(0, [0.0], 1), (2, [0.1], 1), (4, [5.0], 0), (6, [5.1], 0), (8, [0.2], 0)]
    train = spark.createDataFrame(rows, "id long, v array<double>, label int")
    asked = spark.createDataFrame([(1, [0.0]), (3, [5.0])], "id long, v array<double>")
    got = {r["id"]: r["prediction"] for r in neighbours.knn_classify(asked, train, "id", "v", "label").collect()}
    assert got == {1: 1, 3: 0}


def test_grid_may_depend_on_the_training_rows(blobs):
    rows = blobs.select("id", "features", "label").withColumn("fold", (F.col("id") % 4).cast("int"))
    estimator, seen = models.l2_logistic(1), []

    def grid(train):
        seen.append(train.count())
        return [{estimator.regParam: 1 / (c * seen[-1])} for c in (0.1, 1.0)]

    found = models.cross_validate(rows, estimator, "fold", 4, grid=grid)
    assert sorted(seen) == sorted(rows.count() - rows.filter(F.col("fold") == i).count() for i in range(4))
    assert len(found) == 2 and all(len(r["folds"]) == 4 for r in found)


def test_repeated_evaluation_of_several_models(blobs):
    made = {"one": models.l2_logistic(200), "two": lambda train: models.l2_svm(train.count())}
    found = models.repeated_auroc(blobs.select("id", "features", "label"), made, "id", 400, [1, 2])
    assert [(r["seed"], r["model"]) for r in found] == [(1, "one"), (1, "two"), (2, "one"), (2, "two")]
    assert all(0.5 < r["auroc"] <= 1 for r in found)


def test_grid_search_covers_the_reference_grids(spark):
    from __spark_entry__ import queries

    got = queries()["grid_search"](spark, "/root/testdata/sf0.001").collect()
    assert all(0 <= r["auroc"] <= 1 for r in got)
    cells = {}
    for r in got:
        cells.setdefault((r["model"], r["width"]), []).append(r["c"])
    assert cells == {("linear", None): list(q_models.LINEAR_C), ("kernel", 1.0): list(q_models.KERNEL_C), ("kernel", 10.0): list(q_models.KERNEL_C)}


def test_batched_areas_are_those_of_single_models(blobs):
    """Every fold and penalty at once against one MLlib model a fold, with MLlib's scaling and penalty undone."""
    rows = stable(prep.stratified_folds(blobs.select("id", "v", "label"), "label", "id", 4))
    cells = {c: Cell(0, "logistic", c) for c in (0.01, 1.0)}
    got = models.fold_areas(rows, "v", "fold", 4, cells, tol=1e-8)
    for c, areas in got.items():
        scaled = lambda train: Pipeline(
            stages=[StandardScaler(inputCol="raw", outputCol="features", withMean=True), models.l2_logistic(train.count(), c, 1e-9)]  # noqa: B023
        )
        found = models.cross_validate(models.as_vector(rows, "v", "raw"), scaled, "fold", 4)
        assert areas == pytest.approx(found[0]["folds"], abs=2e-3)


def test_bootstrap_counts_are_the_draws(blobs):
    rows = blobs.select("id", "label")
    counted = prep.bootstrap_counts(rows, "id", 300, [3, 8])
    got = {r["id"]: r["times"] for r in counted.collect()}
    assert len(got) == 400
    for k, seed in enumerate((3, 8)):
        drawn = {r["id"]: r["count"] for r in prep.bootstrap(rows, "id", 300, seed).groupBy("id").count().collect()}
        assert {i: n[k] for i, n in got.items() if n[k]} == drawn


def test_bootstrap_areas(blobs):
    rows = blobs.select("id", "v", "label")
    found = models.bootstrap_areas(rows, "id", {"svm": Cell(0, "squared_hinge", 0.1)}, {"forest": models.forest(5)}, "v", 400, [1, 2])
    assert sorted((r["seed"], r["model"]) for r in found) == [(1, "forest"), (1, "svm"), (2, "forest"), (2, "svm")]
    assert all(0.85 < r["auroc"] <= 1 for r in found)


def test_split_areas_of_several_models(rings):
    cells = {"linear": Cell(0, "squared_hinge", 1.0), "kernel": Cell(0, "squared_hinge", 1.0, 2.0)}
    got = {r["model"]: r for r in models.split_areas(rings, "v", "id", cells).collect()}
    assert got["linear"]["auroc"] < 0.75 < 0.97 < got["kernel"]["auroc"] and got["kernel"]["accuracy"] > 0.95
    assert got["linear"]["n_test"] == got["kernel"]["n_test"] > 80


def test_few_rows_of_a_cell_are_measured(monkeypatch):
    """A matrix product rules out most rows; ties and numbers that are not finite come as before."""
    import pandas as pd

    draw = np.random.default_rng(3)
    points = draw.normal(size=(500, 8)) + 1000
    points[100:110] = points[0]
    points[499, 2] = np.nan
    t = pd.DataFrame({"id": np.arange(500), "v": list(points), "label": 0.0})
    q = pd.DataFrame({"id": [1000, 1001], "v": [points[0], points[7] + 1e-3]})
    measured = []
    sort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: measured.append(len(keys[0])) or sort(keys))
    got = neighbours._nearest_of("id", "v", "label", 5)(q, t)
    assert sum(measured) < 60
    assert got[got["qid"] == 1000]["nid"].tolist() == [0, 100, 101, 102, 103]
    assert got["squared"].tolist()[5] == sum((points[7, d] + 1e-3 - points[7, d]) ** 2 for d in range(8)) and got["nid"].tolist()[5] == 7
    few = neighbours._nearest_of("id", "v", "label", 5)(q, t.tail(3))
    assert few[few["qid"] == 1000]["nid"].tolist()[-1] == 499 and len(few) == 6
