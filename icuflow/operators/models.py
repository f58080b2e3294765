"""Model fitting and evaluation on MLlib: every fit is a distributed job."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from multiprocessing.pool import ThreadPool
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    PCA,
    Imputer,
    StandardScaler,
    UnivariateFeatureSelector,
    VarianceThresholdSelector,
    VectorAssembler,
    VectorIndexer,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.operators import search
from icuflow.operators.blocks import Blocks, counts
from icuflow.operators.blocks import folds as fold_counts
from icuflow.operators.prep import bootstrap, bootstrap_counts, hash_split
from icuflow.operators.search import Cell
from icuflow.session import shared_dir, stable


def l2_logistic(n: int, c: float = 0.1, tol: float = 1e-3) -> LogisticRegression:
    """L2 logistic regression; `c` weighs the summed loss, hence the division by rows."""
    return LogisticRegression(regParam=1 / (c * n), elasticNetParam=0.0, standardization=False, tol=tol)


def l2_svm(n: int, c: float = 0.1, tol: float = 1e-3) -> LinearSVC:
    """L2 linear SVM with the plain hinge; `search` has the squared one."""
    return LinearSVC(regParam=1 / (c * n), standardization=False, tol=tol)


def entropy_tree(depth: int = 5) -> DecisionTreeClassifier:
    """Decision tree by information gain; `probability` is the certainty of a leaf."""
    return DecisionTreeClassifier(impurity="entropy", maxDepth=depth, seed=0)


def forest(trees: int = 100, depth: int = 5) -> RandomForestClassifier:
    """Random forest under the mean rule: class probabilities averaged over the trees."""
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=0)


def boosted(rounds: int = 20, depth: int = 3) -> GBTClassifier:
    return GBTClassifier(maxIter=rounds, maxDepth=depth, seed=0)


def small_net(inputs: int, hidden: int = 10, epochs: int = 200) -> MultilayerPerceptronClassifier:
    """One hidden layer and a two-class softmax."""
    return MultilayerPerceptronClassifier(layers=[inputs, hidden, 2], maxIter=epochs, seed=0)


def least_squares() -> LinearRegression:
    return LinearRegression(regParam=0.0, solver="normal")


def ridge(n: int, deviation: float, tau: float = 1.0) -> LinearRegression:
    """Squared error plus `tau` times the squared weights.

    MLlib divides its penalty by the rows and by the label's (population) deviation, which is
    undone here; see `label_scale`.
    """
    return LinearRegression(regParam=tau * deviation / n, elasticNetParam=0.0, standardization=False, solver="normal")


def label_scale(df: DataFrame, label: str = "label") -> tuple[int, float]:
    """Row count and population deviation of the label, for `ridge`."""
    row = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return int(row["n"]), float(row["s"] or 0.0)


def prepared(columns: Sequence[str], estimator: Estimator | None, nominal: int = 0) -> Pipeline:
    """Impute, assemble, drop constant features, scale, then the estimator, if one is given.

    Imputation and scaling are learnt on whatever the pipeline is fitted on. `nominal` > 0
    marks features with at most that many values as categories (for trees) instead of scaling.
    """
    names = list(columns)
    filled = [f"{c}_filled" for c in names]
    stages = [
        Imputer(strategy="mean", inputCols=names, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="assembled"),
    ]
    if nominal:
        stages.append(
            VectorIndexer(inputCol="assembled", outputCol="features", maxCategories=nominal, handleInvalid="keep")
        )
    else:
        stages.append(VarianceThresholdSelector(featuresCol="assembled", outputCol="varying", varianceThreshold=0.0))
        stages.append(StandardScaler(inputCol="varying", outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=[*stages, *([estimator] if estimator else [])])


def scores(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predicted class, and the class-1 probability or margin, per row."""
    scored = model.transform(df)
    source = "probability" if "probability" in scored.columns else "rawPrediction"
    columns = [*keep, F.col("prediction").cast("int").alias("prediction")]
    if source in scored.columns:
        columns.append(vector_to_array(source)[1].alias("score"))
    return scored.select(*columns)


def _made(estimator: Estimator | Callable[[DataFrame], Estimator], train: DataFrame) -> Estimator:
    """The estimator, or what a function makes of the training rows (a penalty by their number, say)."""
    return estimator if isinstance(estimator, Estimator) else estimator(train)


def split_auroc(df: DataFrame, estimator: Estimator | Callable[[DataFrame], Estimator], key: str, fraction: float = 0.7) -> DataFrame:
    """Fit on the md5-split training part, AUROC and accuracy on the rest; one row."""
    parts = hash_split(df, key, fraction, "_split")
    train, test = parts.filter("_split = 'train'").drop("_split"), parts.filter("_split = 'test'").drop("_split")
    scored = _made(estimator, train).fit(train).transform(test)
    raw = "rawPrediction" if "rawPrediction" in scored.columns else "probability"
    area = BinaryClassificationEvaluator(rawPredictionCol=raw, metricName="areaUnderROC", numBins=0).evaluate(scored)
    return scored.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
    ).withColumn("auroc", F.lit(float(area)))


def split_mse(df: DataFrame, estimator: Estimator, key: str, fraction: float = 0.7) -> DataFrame:
    """Fit on the md5-split training part, mean squared error on the rest; one row."""
    parts = hash_split(df, key, fraction, "_split")
    train, test = parts.filter("_split = 'train'").drop("_split"), parts.filter("_split = 'test'").drop("_split")
    scored = _made(estimator, train).fit(train).transform(test)
    gap = F.col("prediction") - F.col("label")
    return scored.agg(F.count(F.lit(1)).alias("n_test"), F.avg(gap * gap).alias("mse"))


def _nodes(forest_model, spark) -> list[dict[str, np.ndarray]]:
    """The trees of a fitted forest as arrays by node, read from its stored form: feature (-1 at a leaf), threshold, children,
    class, and which categories go left. Trees times nodes of a tree: a bounded number."""
    path = f"{shared_dir(spark).rstrip('/')}/forest-{uuid4().hex}"
    forest_model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    rows = data.select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    trees: dict[int, list] = {}
    for r in rows:
        trees.setdefault(r["treeID"], []).append(r)
    out = []
    for nodes in trees.values():
        size = len(nodes)
        made = {c: np.full(size, -1, dtype=np.int64) for c in ("feature", "left", "right", "class")}
        made["threshold"] = np.full(size, np.inf)
        most = max([n["split"]["numCategories"] for n in nodes if n["split"]["numCategories"] > 0], default=0)
        # A category that a split does not know goes right.
        made["goes"] = np.zeros((size, most + 1), dtype=bool)
        made["nominal"] = np.zeros(size, dtype=bool)
        for n in nodes:
            k, split = n["id"], n["split"]
            made["class"][k] = int(n["prediction"])
            if n["leftChild"] < 0:
                continue
            made["feature"][k], made["left"][k], made["right"][k] = split["featureIndex"], n["leftChild"], n["rightChild"]
            if split["numCategories"] < 0:
                made["threshold"][k] = split["leftCategoriesOrThreshold"][0]
            else:
                made["nominal"][k] = True
                made["goes"][k, [int(c) for c in split["leftCategoriesOrThreshold"]]] = True
        out.append(made)
    return out


def _leaf_classes(tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The class of the leaf that each row reaches."""
    node = np.zeros(len(x), dtype=np.int64)
    while True:
        inner = np.flatnonzero(tree["feature"][node] >= 0)
        if not len(inner):
            return tree["class"][node]
        at = node[inner]
        value = x[inner, tree["feature"][at]]
        most = tree["goes"].shape[1] - 1
        known = tree["goes"][at, np.clip(np.nan_to_num(value), 0, most).astype(np.int64)] & (value <= most)
        left = np.where(tree["nominal"][at], known, value <= tree["threshold"][at])
        node[inner] = np.where(left, tree["left"][at], tree["right"][at])


def majority_vote(forest_model, df: DataFrame, out: str = "vote") -> DataFrame:
    """The class most trees of a fitted forest predict; equal votes go to the smaller class. All trees are walked in one pass
    over the rows."""
    trees, classes = _nodes(forest_model, df.sparkSession), forest_model.numClasses

    @F.pandas_udf("int")
    def vote(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype="int32")
        x = np.stack(values.to_numpy()).astype("float64")
        votes = np.zeros((len(x), classes), dtype=np.int64)
        for tree in trees:
            votes[np.arange(len(x)), _leaf_classes(tree, x)] += 1
        return pd.Series(votes.argmax(axis=1).astype("int32"))

    return df.withColumn(out, vote(vector_to_array(F.col("features"))))


def cross_validate(
    df: DataFrame,
    estimator: Estimator,
    folds: str,
    k: int,
    metric: str = "areaUnderROC",
    grid: Sequence[Mapping] | Callable[[DataFrame], Sequence[Mapping]] | None = None,
    parallelism: int = 4,
) -> list[dict]:
    """Per grid cell: the metric on every fold, its mean and deviation.

    Folds come from a column, so they can be stratified and repeated. Each fold trains on the
    rows outside it; `parallelism` folds submit their jobs at a time. `df` should be a stored
    frame, as it is read once per fit. A grid that depends on the training rows is a function
    of them, with as many cells for every fold; `params` are then those of the first fold.
    """
    if metric in ("areaUnderROC", "areaUnderPR"):
        evaluator = BinaryClassificationEvaluator(metricName=metric, numBins=0)
    else:
        evaluator = RegressionEvaluator(metricName=metric)

    def one_fold(i: int) -> tuple[list[Mapping], list[float]]:
        train, test = df.filter(F.col(folds) != i), df.filter(F.col(folds) == i)
        made = _made(estimator, train)
        cells = list(grid(train) if callable(grid) else grid or [{}])
        return cells, [float(evaluator.evaluate(made.fit(train, cell).transform(test))) for cell in cells]

    with ThreadPool(parallelism) as pool:
        per_fold = pool.map(inheritable_thread_target(df.sparkSession)(one_fold), range(k))
    found = []
    for cell, values in zip(per_fold[0][0], zip(*[values for _, values in per_fold], strict=True), strict=True):
        found.append(
            {
                "params": {p.name: v for p, v in cell.items()},
                "folds": list(values),
                "mean": float(np.mean(values)),
                "deviation": float(np.std(values)),
            }
        )
    return found


def cross_validate_several(
    df: DataFrame, preparation: Pipeline, estimators: Mapping[str, Estimator], folds: str, k: int, parallelism: int = 4
) -> dict[str, list[float]]:
    """For each named estimator its AUROC on every fold. The preparation is fitted once a fold, on the rows outside it, and
    the prepared rows are stored for all estimators; `parallelism` folds submit their jobs at a time."""
    evaluator = BinaryClassificationEvaluator(numBins=0)

    def one_fold(i: int) -> dict[str, float]:
        train = df.filter(F.col(folds) != i)
        made = preparation.fit(train)
        own = stable(made.transform(df).select(folds, "label", "features"))
        parts = own.filter(F.col(folds) != i), own.filter(F.col(folds) == i)
        return {name: float(evaluator.evaluate(e.copy().fit(parts[0]).transform(parts[1]))) for name, e in estimators.items()}

    with ThreadPool(parallelism) as pool:
        found = pool.map(inheritable_thread_target(df.sparkSession)(one_fold), range(k))
    return {name: [areas[name] for areas in found] for name in estimators}


def best_fit(df: DataFrame, estimator: Estimator, found: Sequence[Mapping], larger_is_better: bool = True):
    """The estimator fitted on all rows with the parameters of the best grid cell."""
    best = (max if larger_is_better else min)(found, key=lambda r: r["mean"])
    return estimator.fit(df, {estimator.getParam(n): v for n, v in best["params"].items()})


def repeated_auroc(
    df: DataFrame, estimator: Estimator | Mapping[str, Estimator], key: str, size: int, seeds: Sequence[int], parallelism: int = 4
) -> list[dict]:
    """AUROC of `size`-row bootstrap samples, half for training, one result per seed, or one per seed and model for several
    named estimators, which all see the same samples. `parallelism` seeds submit their jobs at a time.

    Rows are split by key before drawing, so no row is in both halves.
    """
    parts = hash_split(df, key, 0.5, "_split")
    halves = [parts.filter(F.col("_split") == s).drop("_split") for s in ("train", "test")]

    def one_seed(seed: int) -> list[dict]:
        train, test = (stable(bootstrap(h, key, size // 2, seed)) for h in halves)
        score = lambda e: float(BinaryClassificationEvaluator(numBins=0).evaluate(_made(e, train).fit(train).transform(test)))
        if not isinstance(estimator, Mapping):
            return [{"seed": int(seed), "auroc": score(estimator)}]
        return [{"seed": int(seed), "model": name, "auroc": score(e)} for name, e in estimator.items()]

    with ThreadPool(parallelism) as pool:
        per_seed = pool.map(inheritable_thread_target(df.sparkSession)(one_seed), seeds)
    return [r for found in per_seed for r in found]


def bootstrap_areas(
    df: DataFrame, key: str, cells: Mapping[str, Cell], others: Mapping[str, Estimator], features: str, size: int, seeds: Sequence[int], parallelism: int = 4
) -> list[dict]:
    """AUROC of `size`-row bootstrap samples, half of them for training, one result per seed and model; all models of a
    seed see the same samples. Rows are split by key before drawing, so no row is in both halves.

    `cells` are batched models (their group is set here), fitted for all seeds together. `others` are estimators with a
    weight column, fitted on how often each row was drawn; `parallelism` seeds submit their jobs at a time.
    """
    parts = hash_split(df, key, 0.5, "_split")
    none = F.array(*[F.lit(0.0)] * len(seeds))
    halves = []
    for split, own, other in (("train", "_train", "_test"), ("test", "_test", "_train")):
        half = bootstrap_counts(parts.filter(F.col("_split") == split).drop("_split"), key, size // 2, seeds, own)
        halves.append(half.withColumn(other, none))
    rows = stable(halves[0].unionByName(halves[1]))
    blocks = Blocks(rows, features, "label", (F.col("_train"), F.col("_test")))
    named = [(seed, name, replace(cell, group=i)) for i, seed in enumerate(seeds) for name, cell in cells.items()]
    areas = search.areas(blocks, search.fit(blocks, [cell for _, _, cell in named])) if named else []
    found = [{"seed": int(seed), "model": name, "auroc": area} for (seed, name, _), area in zip(named, areas, strict=True)]
    vectors = as_vector(rows, features)

    def one_seed(i: int) -> list[dict]:
        drawn = lambda c: vectors.withColumn("_n", F.get(c, F.lit(i))).filter("_n > 0").select("features", "label", "_n")
        evaluator = BinaryClassificationEvaluator(numBins=0, weightCol="_n")
        return [
            {"seed": int(seeds[i]), "model": name, "auroc": float(evaluator.evaluate(e.copy().setWeightCol("_n").fit(drawn("_train")).transform(drawn("_test"))))}
            for name, e in others.items()
        ]

    with ThreadPool(parallelism) as pool:
        for more in pool.map(inheritable_thread_target(df.sparkSession)(one_seed), range(len(seeds))):
            found += more
    return found


def fold_areas(df: DataFrame, features: str, folds: str, k: int, cells: Mapping[str, Cell], **options) -> dict[str, list[float]]:
    """For each named model its AUROC on every fold, fitted on the others: all models and folds in the same passes."""
    blocks = Blocks(df, features, "label", fold_counts(folds, k))
    named = [(name, replace(cell, group=i)) for name, cell in cells.items() for i in range(k)]
    areas = search.areas(blocks, search.fit(blocks, [cell for _, cell in named], **options))
    out: dict[str, list[float]] = {}
    for (name, _), area in zip(named, areas, strict=True):
        out.setdefault(name, []).append(area)
    return out


def split_areas(df: DataFrame, features: str, key: str, cells: Mapping[str, Cell], fraction: float = 0.7, **options) -> DataFrame:
    """Columns model, n_test, accuracy and auroc of batched models, fitted on the md5-split training part."""
    rows = hash_split(df, key, fraction, "_split")
    train, test = (counts(F.col("_split") == s) for s in ("train", "test"))
    blocks = Blocks(rows, features, "label", (train, test))
    fitted = search.fit(blocks, list(cells.values()), **options)
    areas = search.areas(blocks, fitted)
    names = F.array(*[F.lit(name) for name in cells])
    own = F.array(*[F.lit(area) for area in areas])
    return search.accuracies(blocks, fitted).select(
        F.get(names, F.col("cell")).alias("model"), "n_test", "accuracy", F.get(own, F.col("cell")).alias("auroc")
    )


def fourier_features(df: DataFrame, vector: str, dims: int, width: float, count: int = 256, seed: int = 0) -> DataFrame:
    """Random Fourier features approximating the kernel exp(-|x-y|^2 / width).

    Adds `features`; a linear model on them stands in for the kernel model (Rahimi and Recht,
    2007). The projection is dims x count numbers; rows are projected batch by batch.
    """
    draw = np.random.default_rng(seed)
    weights = draw.normal(scale=np.sqrt(2.0 / width), size=(dims, count))
    phases = draw.uniform(0.0, 2 * np.pi, size=count)
    factor = np.sqrt(2.0 / count)

    @F.pandas_udf("array<double>")
    def project(values: pd.Series) -> pd.Series:
        points = np.stack(values.to_numpy()).astype("float64")
        return pd.Series(list(factor * np.cos(points @ weights + phases)))

    return df.withColumn("features", array_to_vector(project(F.col(vector))))


def as_vector(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))


def pca_fit(df: DataFrame, k: int):
    """Principal components of `features`: model with `pc` and `explainedVariance`."""
    return PCA(k=k, inputCol="features", outputCol="components").fit(df)


def pca_sweep(
    df: DataFrame, key: str, dims: Sequence[int], estimator: Estimator | Callable[[DataFrame], Estimator], fraction: float = 0.7
) -> list[dict]:
    """Retained variance and AUROC for several target dimensions from one decomposition of the training part."""
    parts = hash_split(df, key, fraction, "_split")
    model = pca_fit(parts.filter("_split = 'train'"), max(dims))
    variance = np.asarray(model.explainedVariance.toArray())
    projected = model.transform(df).drop("features")
    found = []
    for d in dims:
        reduced = VectorSlicer(inputCol="components", outputCol="features", indices=list(range(d))).transform(projected)
        result = split_auroc(reduced, estimator, key, fraction).first()
        found.append({"dims": int(d), "retained": float(variance[:d].sum()), "auroc": float(result["auroc"])})
    return found


def select_features(df: DataFrame, keep: int):
    """The features most associated with the label."""
    selector = UnivariateFeatureSelector(featuresCol="features", outputCol="selected", labelCol="label", selectionMode="numTopFeatures")
    return selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(keep).fit(df)


def simple_regression(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope and intercept of one feature, as aggregates."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
    )

