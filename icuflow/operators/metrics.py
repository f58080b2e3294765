"""Evaluation of scores against 0/1 labels, exact and distributed."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.operators.ordered import hashed_position, over_neighbours, running


def _by_score(df: DataFrame, score: str, label: str, groups: Sequence[str], weight: str | None = None) -> DataFrame:
    known = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*groups, F.col(score).alias("_s"))
    if weight:
        often = lambda c: F.coalesce(F.sum(F.when(c, F.col(weight))), F.lit(0))
        return known.agg(often(F.col(label) == 1).alias("_pos"), often(F.col(label) != 1).alias("_neg"))
    return known.agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("_pos"),
        F.count(F.when(F.col(label) != 1, 1)).alias("_neg"),
    )


def auroc(df: DataFrame, score: str, label: str, groups: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Area under the ROC curve: the share of (positive, negative) pairs in the right order.

    Ties count one half; a row counts `weight` times if given. Rows shrink to distinct scores first; the pairs are counted through
    the running number of negatives below each score.
    """
    ranked = running(_by_score(df, score, label, groups, weight), ["_s"], groups, totals={"_below": F.col("_neg")})
    wins = F.col("_pos") * (F.col("_below") - F.col("_neg") / 2)
    pairs = F.try_divide(F.sum(wins), F.sum("_pos") * F.sum("_neg"))
    return ranked.groupBy(*groups).agg(
        F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"), pairs.alias("auroc")
    )


def _curve(df, score, label, groups) -> DataFrame:
    points = running(
        _by_score(df, score, label, groups),
        [F.col("_s").desc()],
        groups,
        totals={"tp": F.col("_pos"), "fp": F.col("_neg")},
    )
    return points.select(*groups, F.col("_s").alias("threshold"), "tp", "fp")


def _with_totals(points: DataFrame, groups: Sequence[str]) -> DataFrame:
    if not groups:
        totals = points.agg(F.max("tp").alias("p"), F.max("fp").alias("n"))
        return points.withColumns({"_p": totals.select("p").scalar(), "_n": totals.select("n").scalar()})
    totals = points.groupBy(*groups).agg(F.max("tp").alias("_p"), F.max("fp").alias("_n"))
    return points.join(totals, [*groups])


def roc_curve(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """True and false positive rate at every distinct threshold (predict 1 if score >= it)."""
    points = _with_totals(_curve(df, score, label, groups), groups)
    return points.select(
        *groups,
        "threshold",
        F.try_divide("fp", "_n").alias("fpr"),
        F.try_divide("tp", "_p").alias("tpr"),
    )


def mean_roc(df: DataFrame, score: str, label: str, fold: str, points: int = 100) -> DataFrame:
    """Fold curves interpolated onto an even false-positive grid and averaged.

    The ends are fixed at 0 and 1. Each curve step covers the grid points between its own
    and the next step's rate, so every fold yields `points` rows whatever its size.
    """
    last = points - 1
    curve = _curve(df, score, label, [fold])
    origin = curve.select(fold).distinct().withColumns({"tp": F.lit(0), "fp": F.lit(0)})
    steps = (
        curve.select(fold, "tp", "fp")
        .unionByName(origin)
        .groupBy(fold, "fp")
        .agg(F.min("tp").alias("_low"), F.max("tp").alias("_high"))
    )
    ahead = over_neighbours(
        steps,
        ["fp"],
        lambda w: {"_next_fp": F.lead("fp").over(w), "_next_tp": F.lead("_low").over(w)},
        keys=[fold],
        after=1,
    )
    totals = steps.groupBy(fold).agg(F.max("_high").alias("_p"), F.max("fp").alias("_n"))
    known = ahead.join(totals, fold).filter((F.col("_n") > 0) & (F.col("_p") > 0))

    def first_grid_point(fp):
        return F.ceil(F.col(fp) * last / F.col("_n"))

    start = first_grid_point("fp")
    end = F.when(F.col("_next_fp").isNull(), F.lit(last)).otherwise(first_grid_point("_next_fp") - 1)
    spread = known.filter(start <= end).withColumn("point", F.explode(F.sequence(start, end)))
    ahead_by = F.try_divide(
        F.col("point") * F.col("_n") / last - F.col("fp"), F.col("_next_fp") - F.col("fp")
    )
    tpr = (F.col("_high") + F.coalesce((F.col("_next_tp") - F.col("_high")) * ahead_by, F.lit(0.0))) / F.col("_p")
    mean = F.when(F.col("point") == 0, F.lit(0.0)).when(F.col("point") == last, F.lit(1.0)).otherwise(F.avg(tpr))
    return spread.groupBy("point").agg(F.avg(tpr).alias("_tpr")).select(
        F.col("point").cast("int").alias("point"),
        (F.col("point") / last).alias("fpr"),
        F.when(F.col("point") == 0, F.lit(0.0))
        .when(F.col("point") == last, F.lit(1.0))
        .otherwise(F.col("_tpr"))
        .alias("tpr"),
    )


def accuracy(df: DataFrame, prediction: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"),
    )


def mse(df: DataFrame, prediction: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    gap = F.col(prediction) - F.col(target)
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.avg(gap * gap).alias("mse"))


def random_guess(df: DataFrame, label: str, key: str) -> DataFrame:
    """Guesses with the true prevalence: as many ones as there are positives, shuffled by md5."""
    positives = df.agg(F.sum(F.col(label).cast("long")).alias("p")).scalar()
    shuffled = hashed_position(df, key).withColumn("_positives", positives)
    return shuffled.withColumn("guess", (F.col("position") <= F.col("_positives")).cast("int")).drop(
        "position", "_positives"
    )


def hashed_normal(key: str, seed: int = 0) -> Column:
    """A draw from the standard normal for each key, from two even numbers of its md5 (Box and Muller): the same wherever
    and however often it is drawn."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))
    part = lambda first: F.conv(F.substring(digest, first, 12), 16, 10).cast("double")
    return F.sqrt(-2 * F.log((part(1) + 1) / 2.0**48)) * F.cos(2 * pi * part(13) / 2.0**48)


def mean_guess(df: DataFrame, target: str, train: DataFrame | None = None, noise: float = 0.0, seed: int = 0, key: str | None = None) -> DataFrame:
    """The training mean as a guess, with normal noise around it if asked for (drawn by `key` if given)."""
    center = (train or df).agg(F.avg(target).alias("m")).scalar()
    guessed = df.withColumn("guess", center)
    if not noise:
        return guessed
    return guessed.withColumn("guess", F.col("guess") + (hashed_normal(key, seed) if key else F.randn(seed)) * noise)
