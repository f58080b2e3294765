"""Regular time series from irregular events: hourly means, lags, rolling statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from icuflow.functions import scalar as fn
from icuflow.functions.scalar import hour_of, seconds_between
from icuflow.operators.ordered import over_neighbours


def hourly(
    df: DataFrame,
    by: Sequence[str],
    time: str,
    label: str,
    value: str,
    labels: Sequence[str],
    distinct: bool = True,
    out: str = "timestamp",
) -> DataFrame:
    """Mean per (key, hour) of every label, one column each.

    distinct=True averages the distinct values of an hour. Rows with a NULL label still make
    their hour appear, with NULLs.
    """
    slim = df.select(*by, hour_of(time).alias(out), label, value)
    if distinct:
        slim = slim.dropDuplicates()
    return slim.groupBy(*by, out).agg(
        *[F.avg(F.when(F.col(label) == name, F.col(value))).alias(name) for name in labels]
    )


def wide_rows(df: DataFrame, by: Sequence[str], label: str, value: str, labels: Sequence[str]) -> DataFrame:
    """Distinct time-stamped rows with the value moved to its label's column."""
    return df.dropDuplicates([*by, label, value]).select(
        *by, *[F.when(F.col(label) == name, F.col(value)).alias(name) for name in labels]
    )


def _history(
    values: Sequence[str], lags: Sequence[int], frame: int, stats: Sequence[str], exact: Sequence[str] = ()
) -> tuple[Callable[[WindowSpec], dict[str, Column]], dict[str, Column]]:
    """Window columns with earlier values, and what is made of them. Means of the `exact` (decimals) are windows of their own."""
    reach = sorted({*lags, *(range(1, frame + 1) if stats else ())})

    def make(window: WindowSpec) -> dict[str, Column]:
        earlier = {f"_{v}_{k}": F.lag(v, k).over(window) for v in values for k in reach}
        return earlier | {f"_{v}_mean": F.avg(v).over(window.rowsBetween(-frame, 0)) for v in exact}

    named = {}
    for v in values:
        named.update({f"{v}_{k}h": F.col(f"_{v}_{k}") for k in lags})
        rows = [*[F.col(f"_{v}_{k}") for k in range(frame, 0, -1)], F.col(v)]
        count = reduce(add, [r.isNotNull().cast("int") for r in rows])
        # Missing values come first.
        ordered = F.sort_array(F.array(*rows))
        first = F.lit(len(rows)) - count
        every = {
            "mean": lambda v=v, rows=rows, count=count: (
                F.col(f"_{v}_mean")
                if v in exact
                else F.try_divide(reduce(add, [F.coalesce(r.cast("double"), F.lit(0.0)) for r in rows], F.lit(0.0)), count)
            ),
            "min": lambda rows=rows: F.least(*rows) if len(rows) > 1 else rows[0],
            "max": lambda rows=rows: F.greatest(*rows) if len(rows) > 1 else rows[0],
            "median": lambda ordered=ordered, first=first, count=count: (
                F.get(ordered, first + F.shiftright(count - 1, 1)) + F.get(ordered, first + F.shiftright(count, 1))
            ) / 2,
        }
        named.update({f"{v}_{s}_{frame}h": every[s]() for s in stats})
    return make, named


def with_history(
    df: DataFrame,
    values: Sequence[str],
    stay: Sequence[str],
    order: Sequence[str],
    lags: Sequence[int] = (1, 2, 3),
    frame: int = 6,
    stats: Sequence[str] = ("mean", "min", "max", "median"),
    scope: str = "stay",
) -> DataFrame:
    """Lags and rolling statistics over the current and the `frame` previous rows.

    scope='stay' keeps each stay's history to itself. The input has one row per stay and
    hour, so a stay's rows are bounded by its hours whatever the event volume, and one window
    sort serves all columns. scope='global' runs over all stays in (stay, order) sequence, so
    the first rows of a stay see the previous stay's; it is cut into range pieces with a halo.
    """
    kinds = dict(df.dtypes)
    exact = [v for v in values if kinds[v].startswith("decimal")] if "mean" in stats else []
    make, named = _history(values, lags, frame, stats, exact)
    if not named:
        return df
    if scope == "stay":
        rows = df.withColumns(make(Window.partitionBy(*stay).orderBy(*order)))
    else:
        rows = over_neighbours(df, [*stay, *order], make, before=max([frame if stats else 0, *lags]))
    first, *rest = df.columns
    kept = [fn.apart(first).alias(first), *rest]
    return rows.select(*kept, *[c.alias(name) for name, c in named.items()])


def elapsed_from_first(df: DataFrame, keys: Sequence[str], time: str, out: str = "elapsed_seconds") -> DataFrame:
    """Seconds since the key's first row. The first times are a partial aggregate joined back."""
    first = df.groupBy(*keys).agg(F.min(time).alias("_first"))
    return df.join(first, [*keys]).withColumn(out, seconds_between("_first", time)).drop("_first")


def next_within(df: DataFrame, keys: Sequence[str], time: str, tiebreak: str, days: int, out: str = "readmitted") -> DataFrame:
    """Days to the key's next row and a flag if it comes within `days`."""
    ahead = over_neighbours(
        df, [time, tiebreak], lambda w: {"_next": F.lead(time).over(w)}, keys=keys, after=1
    )
    gap = seconds_between(time, "_next") / 86400
    return ahead.withColumn("days_to_next", gap).withColumn(
        out, F.when(gap <= days, 1).otherwise(0)
    ).drop("_next")
