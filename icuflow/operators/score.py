"""Scores summed from components charted at the same time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from icuflow.functions.scalar import shift
from icuflow.operators.ordered import over_neighbours


def component_sum(df: DataFrame, by: Sequence[str], parts: Sequence[str], out: str = "score") -> DataFrame:
    """Lowest and highest plain sum per key; a missing component makes that sum unknown."""
    total = F.col(parts[0])
    for p in parts[1:]:
        total = total + F.col(p)
    return df.groupBy(*by).agg(F.min(total).alias(f"{out}_min"), F.max(total).alias(f"{out}_max"))


def carry_forward(
    df: DataFrame,
    by: Sequence[str],
    time: str,
    normal: Mapping[str, int],
    tube: str,
    full: int,
    memory: str = "6 hours",
    out: str = "score",
    bounded: bool = False,
) -> DataFrame:
    """Score per (key, time) with missing components taken from the previous time.

    The previous row counts only if it is less than `memory` old. A component missing on
    both sides takes its `normal` value. `tube` is the component whose value 0 means
    "cannot be assessed": the score is then `full`, as it is when the component is missing
    now and was 0 before; after such a row nothing is carried over.
    Expects one row per key and time. `bounded` says that the clock bounds the times of a key (those of a day): one window
    by key then serves, which needs no shuffle where the rows already lie by key.
    """

    def previous_row(window: WindowSpec) -> dict:
        recent = F.lag(time).over(window) > shift(time, f"-{memory}")
        return {f"{p}_prev": F.when(recent, F.lag(p).over(window)) for p in normal}

    if bounded:
        with_previous = df.withColumns(previous_row(Window.partitionBy(*by).orderBy(time)))
    else:
        with_previous = over_neighbours(df, [time], previous_row, by, before=1)

    def summed(sources):
        total = None
        for p, default in normal.items():
            term = F.coalesce(*sources(p), F.lit(default))
            total = term if total is None else total + term
        return total

    now, previous = F.col(tube), F.col(f"{tube}_prev")
    tubed = (now == 0) | (now.isNull() & (previous == 0))
    score = (
        F.when(tubed, F.lit(full))
        .when(previous == 0, summed(lambda p: [F.col(p)]))
        .otherwise(summed(lambda p: [F.col(p), F.col(f"{p}_prev")]))
    )
    return with_previous.withColumn(out, score)


def lowest(df: DataFrame, by: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The row with the smallest `order` values per key, missing ones last, as one partial aggregate."""
    sorted_by = F.struct(*[x for n, c in enumerate(order) for x in (F.col(c).isNull().alias(f"_missing_{n}"), F.col(c))])
    row = F.struct(*order, *[c for c in keep if c not in order])
    return df.groupBy(*by).agg(F.min_by(row, sorted_by).alias("_row")).select(
        *by, *[F.col(f"_row.{c}").alias(c) for c in keep]
    )
