"""Preparing feature tables: imputing, scaling, splitting, folding, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Imputer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.functions.scalar import micros
from icuflow.operators.ordered import hashed_position
from icuflow.operators.stats import value_at


def mean_impute(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Fill missing numbers with the column mean, taken from `train` if given."""
    names = list(columns)
    model = Imputer(strategy="mean", inputCols=names, outputCols=names).fit(train if train is not None else df)
    return model.transform(df)


def standardize(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """(x - mean) / deviation with statistics from `train` (default: the frame itself).

    Columns without variance are dropped. The fit is one aggregate of two numbers per column.
    """
    fitted = (train if train is not None else df).agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"s_{c}") for c in columns]
    ).first()
    flat = [c for c in columns if not fitted[f"s_{c}"]]
    scaled = {c: (F.col(c) - fitted[f"m_{c}"]) / fitted[f"s_{c}"] for c in columns if c not in flat}
    return df.withColumns(scaled).drop(*flat)


def ordered_split(df: DataFrame, time: str, key: str, fraction: float = 0.7, out: str = "split") -> DataFrame:
    """'train' for the first floor(fraction * n) rows in (time, key) order, 'test' for the rest.

    Rows without a time come last, by key. Only the border is looked up (exact selections); the
    rows are not sorted.
    """
    rows = df.select(micros(time).alias("_t"), F.col(key))
    timed, untimed = rows.filter(F.col("_t").isNotNull()), rows.filter(F.col("_t").isNull())
    total, whole = rows.agg(F.count("_t"), F.count(F.lit(1))).first()
    size = int(whole * fraction)
    if size >= whole:
        return df.withColumn(out, F.lit("train"))
    if size >= total:
        first_test = value_at(untimed, key, size - total, whole - total)
        before = F.col(time).isNotNull() | (F.col(key) < first_test)
        return df.withColumn(out, F.when(before, "train").otherwise("test"))
    border = value_at(timed, "_t", size, total)
    earlier, same = timed.agg(F.count_if(F.col("_t") < border), F.count_if(F.col("_t") == border)).first()
    first_test = value_at(timed.filter(F.col("_t") == border), key, size - earlier, same)
    before = (micros(time) < border) | ((micros(time) == border) & (F.col(key) < first_test))
    return df.withColumn(out, F.when(before, "train").otherwise("test"))


def _hash_fraction(key: str):
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")


def hash_split(df: DataFrame, key: str, fraction: float = 0.5, out: str = "split") -> DataFrame:
    """Random-like split by md5 of the key: reproducible, row by row, no shuffle."""
    return df.withColumn(out, F.when(_hash_fraction(key) < int(fraction * 2**32), "train").otherwise("test"))


def kfold(df: DataFrame, key: str, k: int = 10, out: str = "fold") -> DataFrame:
    """Fold number by md5 of the key; no shuffle."""
    return df.withColumn(out, (_hash_fraction(key) % k).cast("int"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 10, out: str = "fold") -> DataFrame:
    """Folds whose label counts differ by at most one."""
    numbered = hashed_position(df, key, [label], "_p")
    return numbered.withColumn(out, ((F.col("_p") - 1) % k).cast("int")).drop("_p")


def downsample_majority(df: DataFrame, label: str, key: str, majority=0, share: float = 0.8) -> DataFrame:
    """Keep every other row and as many majority rows as make up `share` of the result."""
    others = df.agg(F.count_if(F.col(label) != majority).alias("n")).scalar()
    numbered = hashed_position(df, key, [label], "_p").withColumn("_others", others)
    limit = F.floor(F.col("_others") * F.lit(share / (1 - share)) + 1e-9)
    return numbered.filter((F.col(label) != majority) | (F.col("_p") <= limit)).drop("_p", "_others")


def bootstrap(df: DataFrame, key: str, size: int, seed: int = 0) -> DataFrame:
    """`size` rows drawn with replacement; the same seed draws the same rows.

    Each draw picks a position in md5 order, so drawing is a join of draw numbers to row
    positions. Split first and draw from the parts where a row must not be in both.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-"), F.col("draw").cast("string"))), 1, 12), 16, 10)
    draws = (
        df.sparkSession.range(size)
        .withColumnRenamed("id", "draw")
        .withColumn("_total", total)
        .select("draw", (draw.cast("long") % F.col("_total") + 1).alias("_p"))
    )
    return hashed_position(df, key, out="_p").join(draws, "_p").drop("_p")


def bootstrap_counts(df: DataFrame, key: str, size: int, seeds: Sequence[int], out: str = "times") -> DataFrame:
    """Add an array: how often `bootstrap` draws the row under each of the seeds. All seeds are drawn in one join of drawn
    positions, counted first, to the rows' positions in md5 order."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    own = F.array(*[F.lit(int(s)) for s in seeds])
    drawn = (
        df.sparkSession.range(size * len(seeds))
        .withColumn("_total", total)
        .select((F.col("id") % size).alias("_draw"), F.floor(F.col("id") / size).cast("int").alias("_seed"), "_total")
        .where(F.col("_total") > 0)
    )
    text = F.concat(F.get(own, F.col("_seed")).cast("string"), F.lit("-"), F.col("_draw").cast("string"))
    place = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") % F.col("_total") + 1
    often = F.array(*[F.count_if(F.col("_seed") == i).cast("double") for i in range(len(seeds))])
    times = drawn.select("_seed", place.alias("_p")).groupBy("_p").agg(often.alias(out))
    never = F.array(*[F.lit(0.0)] * len(seeds))
    rows = hashed_position(df, key, out="_p").join(times, "_p", "left")
    return rows.withColumn(out, F.coalesce(out, never)).drop("_p")


def sample_fraction(df: DataFrame, label: str, fractions: dict, seed: int = 0) -> DataFrame:
    """Random share of the rows of each label."""
    return df.sampleBy(label, fractions, seed)
