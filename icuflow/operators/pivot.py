"""Long-to-wide aggregation with conditional aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.functions.scalar import col

_AGGREGATES = {"min": F.min, "max": F.max, "mean": F.avg}


def pivot_stats(
    df: DataFrame,
    by: Sequence[str],
    label: str,
    value: str,
    labels: Sequence[str],
    stats: Sequence[str] = ("min", "max", "mean"),
) -> DataFrame:
    """One row per key with `<label>_<stat>` for every label and statistic.

    It goes through (key, label) partial results, so a row updates one label instead of all.
    """
    narrow = df.groupBy(*by, label).agg(*[_AGGREGATES[s](value).alias(f"_{s}") for s in stats])
    return narrow.groupBy(*by).agg(
        *[F.max(F.when(F.col(label) == name, F.col(f"_{s}"))).alias(f"{name}_{s}") for name in labels for s in stats]
    )


def pivot_max(df: DataFrame, by: Sequence[str], label: str, values: Mapping[str, str]) -> DataFrame:
    """One row per key with the greatest value of each label; `values` maps label to column.

    Lets some labels read a text column and others a number.
    """
    return df.groupBy(*by).agg(
        *[F.max(F.when(F.col(label) == name, F.col(source))).alias(name) for name, source in values.items()]
    )


def signed_sum(df: DataFrame, by: Sequence[str], negative: Column, value: str, out: str) -> DataFrame:
    """Sum per key in which rows matching `negative` count with opposite sign."""
    signed = F.when(negative, -F.col(value)).otherwise(F.col(value))
    return df.groupBy(*by).agg(F.sum(signed).alias(out))


def banded_counts(df: DataFrame, value: str | Column, edges: Sequence[float]) -> DataFrame:
    """Row total and the count in each half-open band [a, b); the last band is open-ended."""
    v = col(value)
    bands = [
        F.count(F.when((v >= a) & (v < b), 1)).alias(f"from_{a}_to_{b}")
        for a, b in zip(edges, edges[1:])
    ]
    return df.agg(F.count(F.lit(1)).alias("total"), *bands, F.count(F.when(v >= edges[-1], 1)).alias(f"from_{edges[-1]}"))
