"""Distribution statistics: exact quantiles, shares, histograms, densities, tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import pi, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuflow.operators.ordered import null_safe_join, running

# A quantile sketch of this accuracy is wrong by at most n / ACCURACY ranks; the bracket put
# around each wanted rank is wider than that on both sides.
ACCURACY, MARGIN = 10_000, 0.001


def _attach(df: DataFrame, table: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Add a per-group table's columns to every row; without groups it is one row of literals."""
    if groups:
        return null_safe_join(df, table, groups)
    row = table.first()
    return df.withColumns({c: F.lit(row[c]).cast(table.schema[c].dataType) for c in table.columns})


def ranked_values(
    df: DataFrame,
    column: str,
    near: Sequence[float],
    wanted: Mapping[str, Column],
    groups: Sequence[str] = (),
    sketched: bool = True,
) -> DataFrame:
    """Exact values at 0-based sorted positions, per group.

    `wanted` gives each position as an expression over the group's non-null count `_n`;
    `near` the fractions those positions lie close to. With sketched=False each group is sorted
    in one task. Otherwise nothing is sorted whole: a mergeable sketch proposes
    narrow brackets around the positions, an exact count per bracket finds the one each
    position falls in, and only the distinct values inside those brackets are ordered. The
    result does not depend on the sketch, only the amount of work does.
    """
    data = df.select(*groups, F.col(column).alias("_v")).filter(F.col("_v").isNotNull())
    if not sketched:
        whole = Window.partitionBy(*groups)
        placed = data.withColumns(
            {"_at": F.row_number().over(whole.orderBy("_v")) - 1, "_n": F.count(F.lit(1)).over(whole)}
        )
        return placed.groupBy(*groups).agg(
            F.first("_n").alias("_n"),
            *[F.max(F.when(F.col("_at") == k, F.col("_v"))).alias(name) for name, k in wanted.items()],
        )
    fractions = sorted({min(max(p + d, 0.0), 1.0) for p in near for d in (-MARGIN, MARGIN)})
    sketch = data.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_distinct(
            F.percentile_approx("_v", [float(f) for f in fractions], ACCURACY)
        ).alias("_bounds"),
    )
    binned = _attach(data, sketch, groups).withColumn(
        "_bin", F.size(F.filter("_bounds", lambda b: b < F.col("_v")))
    )
    # At most 2 * len(near) + 1 bins per group.
    earlier = Window.partitionBy(*groups).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy(*groups, "_bin").agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"))
    bins = bins.withColumn("_before", F.coalesce(F.sum("_c").over(earlier), F.lit(0)))
    hit = F.exists(
        F.array(*wanted.values()),
        lambda k: (k >= F.col("_before")) & (k < F.col("_before") + F.col("_c")),
    )
    chosen = bins.filter(hit).select(*groups, "_bin", "_before")
    values = (
        null_safe_join(binned, chosen, [*groups, "_bin"])
        .groupBy(*groups, "_bin", "_v")
        .agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"), F.first("_before").alias("_before"))
    )
    in_bin = Window.partitionBy(*groups, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = values.withColumn("_end", F.col("_before") + F.sum("_c").over(in_bin)).withColumn(
        "_begin", F.col("_end") - F.col("_c")
    )
    return placed.groupBy(*groups).agg(
        F.first("_n").alias("_n"),
        *[
            F.max(F.when((F.col("_begin") <= k) & (k < F.col("_end")), F.col("_v"))).alias(name)
            for name, k in wanted.items()
        ],
    )


def quantiles(
    df: DataFrame,
    column: str,
    probs: Mapping[str, float],
    groups: Sequence[str] = (),
    sketched: bool = True,
) -> DataFrame:
    """Exact linearly interpolated quantiles, one column per name, with the count `n`."""
    last = F.col("_n") - 1
    wanted = {}
    for name, p in probs.items():
        wanted[f"_lo_{name}"] = F.floor(last * F.lit(float(p)))
        wanted[f"_hi_{name}"] = F.ceil(last * F.lit(float(p)))
    found = ranked_values(df, column, list(probs.values()), wanted, groups, sketched)
    out = []
    for name, p in probs.items():
        low, high = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        share = last * F.lit(float(p)) - F.floor(last * F.lit(float(p)))
        out.append((low + (high - low) * share).alias(name))
    return found.select(*groups, F.col("_n").alias("n"), *out)


def value_at(df: DataFrame, column: str, position: int, total: int):
    """The value at a 0-based sorted position of a whole column, as a Python value."""
    near = [position / max(total - 1, 1)]
    return ranked_values(df, column, near, {"_found": F.lit(position)}).first()["_found"]


def corrected_skew(c: str | Column) -> Column:
    """Bias-corrected sample skewness (G1); NULL below three values."""
    n = F.count(c)
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def outcome_stats(df: DataFrame, features: Sequence[str], outcome: str) -> DataFrame:
    """n, median, variance, skew and 99 % quantile of every feature by outcome, in long form."""
    long = df.select(outcome, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        [outcome], list(features), "feature", "value"
    ).filter(F.col("value").isNotNull())
    moments = long.groupBy("feature", outcome).agg(
        F.var_samp("value").alias("variance"), corrected_skew(F.col("value")).alias("skew")
    )
    ranks = quantiles(long, "value", {"median": 0.5, "q99": 0.99}, ["feature", outcome])
    return null_safe_join(moments, ranks, ["feature", outcome])


def group_share(df: DataFrame, keys: Sequence[str], parent: Sequence[str] = ()) -> DataFrame:
    """Row count per group, its percentage of the parent group, of all rows if none."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy(*parent)) if parent else counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.col("n") * 100 / whole)


def histogram_by_group(df: DataFrame, value: str, group: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the range of all groups together; the last edge is closed.

    Every group has every bin, with 0 where it has no rows there; no bins without any value.
    """
    edges = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    v = F.col(value)
    ranged = df.filter(v.isNotNull()).withColumns({"_lo": lo, "_hi": hi})
    width = (F.col("_hi") - F.col("_lo")) / bins
    spot = F.when(width == 0, F.lit(bins // 2)).otherwise(
        F.least(F.floor(F.try_divide(v - F.col("_lo"), width)), F.lit(bins - 1))
    )
    found = ranged.select(group, spot.cast("int").alias("bin")).groupBy(group, "bin").agg(F.count(F.lit(1)).alias("n"))
    every = ranged.select(group).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    filled = null_safe_join(every, found, [group, "bin"], "left")
    return filled.select(group, "bin", F.coalesce("n", F.lit(0)).alias("n"))


def kde_grid(df: DataFrame, value: str, group: str, points: int = 50) -> DataFrame:
    """Gaussian kernel density per group on an even grid half a range beyond the data.

    Bandwidth n^(-1/5) times the sample deviation; a group without spread has no density
    (NULL). Each row adds to every grid point, and the
    sums are built map-side, so only (group, point) partials are shuffled.
    """
    v = F.col(value).cast("double")
    data = df.select(F.col(group), v.alias("_x")).filter(F.col("_x").isNotNull())
    facts = data.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.stddev_samp("_x").alias("_s"),
        F.min("_x").alias("_lo"),
        F.max("_x").alias("_hi"),
    )
    spread = F.col("_hi") - F.col("_lo")
    grid = facts.select(
        F.col(group),
        "_n",
        (F.pow(F.col("_n"), F.lit(-0.2)) * F.col("_s")).alias("_h"),
        F.transform(
            F.sequence(F.lit(0), F.lit(points - 1)),
            lambda i: F.struct(
                i.alias("point"),
                (F.col("_lo") - spread / 2 + spread * 2 * i / (points - 1)).alias("at"),
            ),
        ).alias("_grid"),
    )
    each = _attach(data, grid, [group]).select(group, "_n", "_h", "_x", F.explode("_grid").alias("_g"))
    bump = F.exp(-F.pow(F.try_divide(F.col("_x") - F.col("_g.at"), F.col("_h")), 2) / 2)
    summed = each.groupBy(group, F.col("_g.point").alias("point")).agg(
        F.first("_g.at").alias("at"), F.sum(bump).alias("_sum"), F.first("_n").alias("_n"), F.first("_h").alias("_h")
    )
    return summed.select(
        group, "point", "at", F.try_divide("_sum", F.col("_n") * F.col("_h") * sqrt(2 * pi)).alias("density")
    )


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and outlier count per group."""
    quartiles = quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group])
    rows = _attach(df.select(group, value).filter(F.col(value).isNotNull()), quartiles, [group])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.groupBy(group).agg(
        *[F.first(c).alias(c) for c in ("n", "q1", "median", "q3")],
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"),
    )


def ks_two_sample(df: DataFrame, value: str, group: str, first, second) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and asymptotic p-value, one row.

    Both distribution functions are running totals over the distinct values. An empty sample
    gives NULL.
    """
    one, two = F.col(group) == first, F.col(group) == second
    counts = (
        df.filter((one | two) & F.col(value).isNotNull())
        .groupBy(F.col(value).alias("_v"))
        .agg(F.count(F.when(one, 1)).alias("_a"), F.count(F.when(two, 1)).alias("_b"))
    )
    steps = running(counts, ["_v"], totals={"_ca": F.col("_a"), "_cb": F.col("_b")})
    sizes = counts.agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))
    na, nb = sizes.select("na").scalar(), sizes.select("nb").scalar()
    gaps = steps.withColumns({"na": na, "nb": nb}).agg(
        F.max(F.abs(F.try_divide("_ca", "na") - F.try_divide("_cb", "nb"))).alias("statistic"),
        F.first("na").alias("n_first"),
        F.first("nb").alias("n_second"),
    )
    en = F.sqrt(F.try_divide(F.col("n_first") * F.col("n_second"), F.col("n_first") + F.col("n_second")))
    z = (en + 0.12 + F.try_divide(F.lit(0.11), en)) * F.col("statistic")
    tail = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * k * k * z * z),
    )
    # Below z = 0.2 the probability is 1 to double precision and the series converges slowly.
    p = F.when(z < 0.2, F.lit(1.0)).when(z >= 0.2, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * tail)))
    return gaps.withColumn("p_value", p)


def range_share(df: DataFrame, label: str, value: str, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Per label with a reference range: rows and shares below, inside and above it."""
    low = high = None
    for name, (a, b) in ranges.items():
        hit = F.col(label) == name
        low = F.when(hit, F.lit(float(a))) if low is None else low.when(hit, F.lit(float(a)))
        high = F.when(hit, F.lit(float(b))) if high is None else high.when(hit, F.lit(float(b)))
    v = F.col(value)
    known = df.filter(F.col(label).isin(*ranges) & v.isNotNull())
    return known.groupBy(label).agg(
        F.first(low).alias("lower"),
        F.first(high).alias("upper"),
        F.count(F.lit(1)).alias("n"),
        F.avg((v < low).cast("double")).alias("below"),
        F.avg(v.between(low, high).cast("double")).alias("inside"),
        F.avg((v > high).cast("double")).alias("above"),
    )


def nonnull_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count(c).alias(c) for c in columns])


def top_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The k most frequent values; ties in value order."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(k)


def first_measurement(df: DataFrame, keys: Sequence[str], time: str, value: str, out: str) -> DataFrame:
    """Greatest value at the key's earliest time, as one partial aggregate.

    A NULL at that time only wins if nothing else was measured then.
    """
    earliest_then_largest = F.struct((-F.unix_micros(F.col(time).cast("timestamp"))).alias("t"), F.col(value).alias("v"))
    return df.groupBy(*keys).agg(F.max(earliest_then_largest).alias("_m")).select(*keys, F.col("_m.v").alias(out))
