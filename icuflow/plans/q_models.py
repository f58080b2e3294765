"""Queries: model fitting, validation, projection and scoring."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.functions import scalar as fn
from icuflow.operators import kernel_ridge, metrics, models, moments, neighbours, network, prep, search, selection
from icuflow.operators.blocks import Blocks, counts
from icuflow.operators.search import Cell
from icuflow.plans.q_series import HOURLY, LABELLED, hours
from icuflow.plans.bindings import TYPES, with_
from icuflow.plans.q_tables import rounded
from icuflow.plans.registry import query
from icuflow.session import stable

DIMS = 64


def embeddings(t) -> DataFrame:
    """Embeddings, label 1 for the upper half of the classes."""
    return t.embeddings.select("vec_id", "embedding", (F.col("label") >= 5).cast("double").alias("label"))


def vectors(t) -> DataFrame:
    """The same with the embedding as a vector of features."""
    return models.as_vector(embeddings(t), "embedding")


def doc_features(t) -> DataFrame:
    """Numeric and coded document columns with the quality label."""
    rows = t.documents.select("doc_id", "lang", "source", "n_chars", F.size(F.split("text", " ")).alias("n_words"))
    coded = fn.category_codes(fn.category_codes(rows.join(t.labels, "doc_id"), "lang"), "source")
    names = ["n_chars", "n_words", "lang", "source"]
    return coded.select("doc_id", F.col("quality").cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in names])


DOC_COLUMNS = ["n_chars", "n_words", "lang", "source"]


def order_features(t) -> DataFrame:
    """Line aggregates of an order with two targets: its price and the days until its last line is shipped."""
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("price"),
        F.count(F.lit(1)).cast("double").alias("lines"),
        F.max("l_shipdate").alias("shipped"),
    )
    rows = lines.join(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey"))
    days = F.date_diff("shipped", "o_orderdate").cast("double")
    return rows.select("o_orderkey", "quantity", "price", "lines", F.col("o_totalprice").alias("total"), days.alias("days"))


def result(df: DataFrame) -> DataFrame:
    return rounded(df)


@query(
    with_(LABELLED, HOURLY)
    + f" SELECT user_id, hour, {len(TYPES)} AS size, round({' + '.join(f'coalesce({x}, -1)' for x in TYPES)}, 6) AS total FROM hr"
)
def assemble(t):
    rows = hours(t).select("user_id", "hour", *[F.coalesce(c, F.lit(-1.0)).alias(c) for c in TYPES])
    values = vector_to_array("features")
    made = VectorAssembler(inputCols=TYPES, outputCol="features").transform(rows)
    total = F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    return rounded(made.select("user_id", "hour", F.size(values).alias("size"), total.alias("total")))


@query()
def fit_logreg(t):
    rows = stable(vectors(t))
    return result(models.split_auroc(rows, lambda train: models.l2_logistic(train.count()), "vec_id"))


@query()
def fit_linear_svm(t):
    return result(models.split_areas(embeddings(t), "embedding", "vec_id", {"linear_svm": Cell(0, "squared_hinge", 0.1)}, tol=1e-6))


@query()
def fit_kernel_svm(t):
    cells = {"width_15": Cell(0, "squared_hinge", 0.1, 15.0), "width_2": Cell(0, "squared_hinge", 1.0, 2.0)}
    return result(models.split_areas(embeddings(t), "embedding", "vec_id", cells, tol=1e-6))


@query(
    """WITH g AS (SELECT CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS flag, avg(CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END) AS p,
      count(*) AS n FROM lineitem GROUP BY 1)
    SELECT sum(n)::BIGINT AS n, round(max(ln(p / (1 - p))) FILTER (WHERE flag = 0), 4) AS level,
      round(max(ln(p / (1 - p))) FILTER (WHERE flag = 1) - max(ln(p / (1 - p))) FILTER (WHERE flag = 0), 4) AS slope FROM g"""
)
def logit_on_flag(t):
    # Hardly penalised, a logistic model of one 0/1 feature gives the log odds of both sides.
    flag = F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0)
    rows = t.lineitem.select(F.array(flag).alias("x"), F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("y"))
    blocks = Blocks(rows, "x", "y", (counts(F.lit(True)), counts(F.lit(False))))
    fitted = search.fit(blocks, [Cell(0, "logistic", 1e6)], tol=1e-12)
    (space,), (slope, level) = fitted.spaces, fitted.weights[0]
    slope *= space.scale[0]
    found = [(t.lineitem.count(), float(level - slope * space.mean[0]), float(slope))]
    return rounded(t.spark.createDataFrame(found, "n long, level double, slope double"), 4)


@query()
def fit_rff_svm(t):
    rows = stable(models.fourier_features(vectors(t).drop("features"), "embedding", DIMS, width=15))
    return result(models.split_auroc(rows, lambda train: models.l2_svm(train.count()), "vec_id"))


@query()
def fit_tree(t):
    rows = stable(doc_features(t))
    return result(models.split_auroc(rows, models.prepared(DOC_COLUMNS, models.entropy_tree(), nominal=8), "doc_id"))


@query()
def fit_forest(t):
    rows = stable(doc_features(t))
    parts = prep.hash_split(rows, "doc_id", 0.7)
    fitted = models.prepared(DOC_COLUMNS, models.forest(), nominal=8).fit(parts.filter("split = 'train'"))
    scored = fitted.transform(parts.filter("split = 'test'"))
    kept = scored.select("doc_id", "label", "features", "prediction", vector_to_array("probability")[1].alias("score"))
    voted = models.majority_vote(fitted.stages[-1], kept)
    return rounded(voted.select("doc_id", "label", F.col("prediction").cast("int").alias("mean_rule"), "vote", "score"))


@query()
def fit_gbt(t):
    rows = stable(vectors(t))
    return result(models.split_auroc(rows, models.boosted(), "vec_id"))


@query()
def fit_mlp(t):
    rows = stable(vectors(t))
    return result(models.split_auroc(rows, models.small_net(DIMS), "vec_id"))


@query()
def fit_relu_net(t):
    # Ten rectified units, 200 epochs, momentum 0.9.
    rows = prep.hash_split(embeddings(t), "vec_id", 0.7)
    blocks = Blocks(rows, "embedding", "label", (counts(F.col("split") == "train"), counts(F.col("split") == "test")))
    scored = stable(network.scored(blocks, network.fit(blocks)))
    area = metrics.auroc(scored, "score", "label").select("auroc")
    right = metrics.accuracy(scored, "prediction", "label").select(F.col("n").alias("n_test"), "accuracy")
    return rounded(right.withColumn("auroc", area.scalar()))


@query(
    """SELECT count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
    round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem"""
)
def fit_ols(t):
    found = models.simple_regression(t.lineitem, "l_quantity", "l_extendedprice")
    return found.select("n", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query(
    """WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my,
      covar_pop(l_extendedprice, l_quantity) * count(*) AS sxy, var_pop(l_quantity) * count(*) AS sxx FROM lineitem)
    SELECT n, round(sxy / (sxx + 1), 3) AS slope, round(my - mx * sxy / (sxx + 1), 3) AS intercept FROM m"""
)
def fit_ridge(t):
    rows = t.lineitem.select("l_quantity", F.col("l_extendedprice").alias("label"))
    made = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(rows)
    n, deviation = models.label_scale(rows)
    fitted = models.ridge(n, deviation).fit(made)
    return t.spark.createDataFrame(
        [(n, round(float(fitted.coefficients[0]), 3), round(float(fitted.intercept), 3))], "n long, slope double, intercept double"
    )


@query()
def fit_rff_ridge(t):
    rows = stable(models.fourier_features(vectors(t).drop("features"), "embedding", DIMS, width=15))
    return result(models.split_mse(rows, lambda train: models.ridge(*models.label_scale(train)), "vec_id"))


@query()
def fit_kernel_ridge(t):
    # The exact kernel; `products` of the kernel matrix were needed for the residual.
    rows = prep.hash_split(embeddings(t), "vec_id", 0.7)
    blocks = Blocks(rows, "embedding", "label", (counts(F.col("split") == "train"), counts(F.col("split") == "test")))
    model = kernel_ridge.fit(blocks, width=15.0, tau=1.0, tol=1e-8)
    errors = metrics.mse(kernel_ridge.predict(blocks, model), "prediction", "label")
    return rounded(errors.select(F.col("n").alias("n_test"), "mse").withColumns({"products": F.lit(model.products), "residual": F.lit(model.residual)}))


@query()
def score_rows(t):
    rows = stable(vectors(t))
    parts = prep.hash_split(rows, "vec_id", 0.7)
    train = parts.filter("split = 'train'")
    fitted = models.l2_logistic(train.count()).fit(train)
    return rounded(models.scores(fitted, parts, ["vec_id", "split", "label"]))


@query()
def cv_auc(t):
    rows = stable(prep.stratified_folds(doc_features(t), "label", "doc_id", 10))
    cells = {
        "logistic": Cell(0, "logistic", 0.1),
        "linear_svm": Cell(0, "squared_hinge", 0.1),
        "kernel_svm": Cell(0, "squared_hinge", 0.1, 15.0),
    }
    areas = models.fold_areas(rows.withColumn("x", F.array(*DOC_COLUMNS)), "x", "fold", 10, cells)
    made = {"tree": models.entropy_tree(), "boosted": models.boosted(), "forest": models.forest()}
    areas |= models.cross_validate_several(rows, models.prepared(DOC_COLUMNS, None, nominal=8), made, "fold", 10, parallelism=8)
    found = [(name, float(np.mean(own)), float(np.std(own))) for name, own in areas.items()]
    return t.spark.createDataFrame(found, "model string, auroc double, deviation double")


def cv_mse_sql(features: dict[str, str], targets: dict[str, str], rows: str) -> str:
    """SQL for the errors of least squares and ridge on ten folds: training sums are all less the fold's, the normal
    equations of the standardised features are solved by determinants (of up to three features)."""
    x = list(features)
    pairs = [(i, j) for k, i in enumerate(x) for j in x[: k + 1]]
    cell = lambda i, j: f"a_{i}_{j}" if (i, j) in pairs else f"a_{j}_{i}"

    def determinant(matrix: list[list[str]]) -> str:
        if len(matrix) == 1:
            return matrix[0][0]
        minors = [[row[:c] + row[c + 1 :] for row in matrix[1:]] for c in range(len(matrix))]
        return "(" + "".join(f"{'+-'[c % 2]} {matrix[0][c]} * {determinant(m)} " for c, m in enumerate(minors)) + ")"

    whole = [[cell(i, j) for j in x] for i in x]
    solved = [determinant([[f"b_{i}" if c == k else v for c, v in enumerate(row)] for i, row in zip(x, whole)]) for k in range(len(x))]
    sums = ["count(*) AS n", "sum(y) AS s_y", *[f"sum({i}) AS s_{i}" for i in x], *[f"sum({i} * {j}) AS p_{i}_{j}" for i, j in pairs]]
    sums += [f"sum({i} * y) AS p_{i}_y" for i in x]
    names = [part.split(" AS ")[1] for part in sums]
    centred = [f"p_{i}_{j} - s_{i} * s_{j} / n AS c_{i}_{j}" for i, j in pairs] + [f"p_{i}_y - s_{i} * s_y / n AS c_{i}_y" for i in x]
    scaled = [f"c_{i}_{j} / (d_{i} * d_{j})" + (" + penalty" if i == j else "") + f" AS a_{i}_{j}" for i, j in pairs]
    guess = " + ".join(f"w_{i} * (r.{i} - s_{i} / n)" for i in x)
    return f"""WITH source AS ({rows}),
    middle AS (SELECT {", ".join(f"avg({v}) AS {k}" for k, v in (features | targets).items())} FROM source),
    r AS (SELECT fold, target, y, {", ".join(x)} FROM (
      {" UNION ALL ".join(f"SELECT fold, '{k}' AS target, {v} - (SELECT {k} FROM middle) AS y, " + ", ".join(f"{w} - (SELECT {i} FROM middle) AS {i}" for i, w in features.items()) + " FROM source" for k, v in targets.items())})),
    f AS (SELECT fold, target, {", ".join(sums)} FROM r GROUP BY fold, target),
    t AS (SELECT f.fold, f.target, {", ".join(f"o.{c} - f.{c} AS {c}" for c in names)} FROM f
      JOIN (SELECT target, {", ".join(f"sum({c}) AS {c}" for c in names)} FROM f GROUP BY target) o USING (target)),
    c AS (SELECT *, {", ".join(centred)} FROM t),
    d AS (SELECT *, {", ".join(f"sqrt(c_{i}_{i} / (n - 1)) AS d_{i}" for i in x)} FROM c),
    a AS (SELECT *, {", ".join(scaled)}, {", ".join(f"c_{i}_y / d_{i} AS b_{i}" for i in x)}
      FROM d, (VALUES ('least_squares', 0.0), ('ridge', 1.0)) AS v(model, penalty)),
    w AS (SELECT *, {", ".join(f"{top} / {determinant(whole)} / d_{i} AS w_{i}" for i, top in zip(x, solved))} FROM a),
    e AS (SELECT w.target, w.model, w.fold, avg(power(r.y - s_y / n - ({guess}), 2)) AS mse
      FROM w JOIN r USING (fold, target) GROUP BY w.target, w.model, w.fold)
    SELECT target, model, round(avg(mse), 2) AS mse, round(stddev_pop(mse), 2) AS deviation FROM e GROUP BY target, model"""


ORDER_ROWS = """SELECT o_orderkey, quantity, price, lines, o_totalprice AS total, date_diff('day', o_orderdate, shipped)::DOUBLE AS days,
  ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 10 AS fold
  FROM (SELECT l_orderkey, sum(l_quantity) AS quantity, sum(l_extendedprice) AS price, count(*)::DOUBLE AS lines, max(l_shipdate) AS shipped
    FROM lineitem GROUP BY l_orderkey) JOIN orders ON l_orderkey = o_orderkey"""
ORDER_FEATURES = {"q": "quantity", "p": "price", "l": "lines"}
ORDER_TARGETS = {"total": "total", "days": "days"}


def fold_errors(t, columns: list[str]) -> DataFrame:
    """Least squares and ridge of both targets on ten folds, from the moments of the folds."""
    rows = prep.kfold(order_features(t), "o_orderkey", 10)
    own = moments.moments(rows, [*columns, *ORDER_TARGETS], "fold")
    found = moments.cross_validated(own, columns, list(ORDER_TARGETS), {"least_squares": 0.0, "ridge": 1.0})
    cells = [(target, name, float(np.mean(e)), float(np.std(e))) for target, name, e in found]
    return rounded(t.spark.createDataFrame(cells, "target string, model string, mse double, deviation double"), 2)


@query(cv_mse_sql(ORDER_FEATURES, ORDER_TARGETS, ORDER_ROWS))
def cv_mse(t):
    return fold_errors(t, ["quantity", "price", "lines"])


@query(cv_mse_sql({"p": "price"}, ORDER_TARGETS, ORDER_ROWS))
def cv_mse_one_feature(t):
    return fold_errors(t, ["price"])


#: The reference's grids: penalties of the linear model; penalties and widths of the kernel model.
LINEAR_C = (0.01, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0)
KERNEL_C = (0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0)
KERNEL_WIDTHS = (1.0, 10.0)


@query()
def grid_search(t):
    # Every cell and fold in the same passes.
    rows = stable(prep.stratified_folds(embeddings(t), "label", "vec_id", 10))
    cells = {("linear", c, None): Cell(0, "squared_hinge", c) for c in LINEAR_C}
    cells |= {("kernel", c, w): Cell(0, "squared_hinge", c, w) for w in KERNEL_WIDTHS for c in KERNEL_C}
    areas = models.fold_areas(rows, "embedding", "fold", 10, cells)
    found = [(*name, float(np.mean(own)), float(np.std(own))) for name, own in areas.items()]
    return t.spark.createDataFrame(found, "model string, c double, width double, auroc double, deviation double")


@query(
    """WITH x AS (SELECT vec_id, label >= 5 AS y, i, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) r(i)),
    g AS (SELECT i, y, count(*) AS n, sum(v) AS s, sum(v * v) AS q FROM x GROUP BY i, y),
    f AS (SELECT i, (sum(s * s / n) - sum(s) * sum(s) / sum(n)) / ((sum(q) - sum(s * s / n)) / (sum(n) - 2)) AS f FROM g GROUP BY i),
    top AS (SELECT i FROM f ORDER BY f DESC LIMIT 10)
    SELECT vec_id, count(*)::INTEGER AS kept, round(sum(v), 6) AS total FROM x WHERE i IN (SELECT i FROM top) GROUP BY vec_id"""
)
def select_features(t):
    fitted = models.select_features(vectors(t), 10)
    chosen = fitted.transform(vectors(t)).select("vec_id", vector_to_array("selected").alias("v"))
    return rounded(chosen.select("vec_id", F.size("v").alias("kept"), F.aggregate("v", F.lit(0.0), lambda a, b: a + b).alias("total")))


LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]


def line_moments(t):
    rows = t.lineitem.select(*LINE_FEATURES, "l_extendedprice", F.lit(0).alias("all"))
    return moments.moments(rows, [*LINE_FEATURES, "l_extendedprice"], "all")[0]


_R = {x: f"corr({x}, l_extendedprice)" for x in LINE_FEATURES}


@query(
    f"""WITH one AS ({" UNION ALL ".join(f"SELECT {k} AS a, '{x}' AS feature, {_R[x]} AS r FROM lineitem" for k, x in enumerate(LINE_FEATURES))}),
    whole AS (SELECT var_pop(l_extendedprice) * count(*) AS s FROM lineitem),
    first AS (SELECT * FROM one QUALIFY row_number() OVER (ORDER BY round(r * r, 12) DESC, a) = 1),
    pair AS ({" UNION ALL ".join(f"SELECT {i} AS a, {j} AS b, corr({x}, {y}) AS r FROM lineitem" for i, x in enumerate(LINE_FEATURES) for j, y in enumerate(LINE_FEATURES) if i != j)}),
    second AS (SELECT o.feature, o.a, (f.r * f.r + o.r * o.r - 2 * f.r * o.r * p.r) / (1 - p.r * p.r) AS explained
      FROM first f JOIN pair p ON p.a = f.a JOIN one o ON o.a = p.b QUALIFY row_number() OVER (ORDER BY round(explained, 12) DESC, o.a) = 1)
    SELECT 1 AS step, feature, round((1 - r * r) * s / 1e9, 3) AS squares_left FROM first, whole
    UNION ALL SELECT 2, feature, round((1 - explained) * s / 1e9, 3) FROM second, whole"""
)
def forward_selection(t):
    found = selection.forward(line_moments(t), LINE_FEATURES, "l_extendedprice", 2)
    rows = [(k, name, left / 1e9) for k, (name, left) in enumerate(found, 1)]
    return rounded(t.spark.createDataFrame(rows, "step int, feature string, squares_left double"), 3)


@query()
def backward_elimination(t):
    found = selection.backward(line_moments(t), LINE_FEATURES, "l_extendedprice")
    rows = [(k, name, left / 1e9) for k, (name, left) in enumerate(found, 1)]
    return rounded(t.spark.createDataFrame(rows, "step int, feature string, squares_left double"), 3)


@query()
def pca_project(t):
    rows = stable(vectors(t))
    fitted = models.pca_fit(rows, 2)
    return rounded(
        fitted.transform(rows).select("vec_id", vector_to_array("components").alias("c")).select(
            "vec_id", F.col("c")[0].alias("pc1"), F.col("c")[1].alias("pc2")
        )
    )


@query()
def pca_sweep(t):
    rows = stable(vectors(t))
    dims = [2, 4, 8, 12, 16, 24, 32, 40, 48, 56, 64]
    found = models.pca_sweep(rows.drop("embedding"), "vec_id", dims, lambda train: models.l2_logistic(train.count()))
    return t.spark.createDataFrame([(r["dims"], r["retained"], r["auroc"]) for r in found], "dims int, retained double, auroc double")


@query()
def repeat_eval(t):
    rows = stable(embeddings(t))
    cells = {"linear_svm": Cell(0, "squared_hinge", 0.1), "logistic": Cell(0, "logistic", 0.1)}
    found = models.bootstrap_areas(rows, "vec_id", cells, {"forest": models.forest()}, "embedding", 2 * rows.count(), range(10))
    return t.spark.createDataFrame([(r["seed"], r["model"], r["auroc"]) for r in found], "seed int, model string, auroc double")


@query(
    """WITH d AS (SELECT q.vec_id, n.vec_id AS nid, n.label,
      list_sum(list_transform(range(1, 65), lambda i: pow(q.embedding[i]::DOUBLE - n.embedding[i]::DOUBLE, 2))) AS dist
      FROM embeddings q, embeddings n WHERE q.vec_id % 2 = 1 AND n.vec_id % 2 = 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nid) AS place FROM d),
    v AS (SELECT vec_id, label, count(*) AS votes FROM k WHERE place <= 3 GROUP BY vec_id, label),
    b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, label) AS r FROM v)
    SELECT vec_id, label::INTEGER AS prediction FROM b WHERE r = 1"""
)
def knn_classify(t):
    # Even ids are the training half, odd ids the queries.
    rows = t.embeddings.select("vec_id", "embedding", "label")
    return neighbours.knn_classify(rows.filter("vec_id % 2 = 1"), rows.filter("vec_id % 2 = 0"), "vec_id", "embedding", "label")
