"""Scalar expressions: elapsed time, outcome flags, recoding, caps. All JVM-side columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.functions.items import AGE_CAP, AGE_CAP_VALUE, DAYS_PER_YEAR


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970. Zone-less times are read as UTC (the session zone)."""
    return F.unix_micros(col(ts).cast("timestamp"))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return (micros(end) - micros(start)) / 1e6


def hours_between(start, end) -> Column:
    return seconds_between(start, end) / 3600


def days_between(start, end) -> Column:
    return seconds_between(start, end) / 86400


def length_of_stay(start, end) -> Column:
    """Days between two times, four decimals."""
    return F.round(days_between(start, end), 4)


def age_years(birth, at) -> Column:
    return days_between(birth, at) / DAYS_PER_YEAR


def age_from_fields(birth, at) -> Column:
    """Age from the whole-day, hour and minute fields of the elapsed interval."""
    minutes = F.floor(seconds_between(birth, at) / 60)
    days, rest = F.floor(minutes / 1440), F.pmod(minutes, F.lit(1440))
    return (days + F.floor(rest / 60) / 24 + F.pmod(rest, F.lit(60)) / 24 / 60) / 365.25


def hour_of(ts) -> Column:
    """Start of the hour, zone-less like the event times."""
    return F.date_trunc("hour", col(ts)).cast("timestamp_ntz")


def shift(ts, amount: str) -> Column:
    """`ts` plus an interval such as '12 hours', '-6 hours', '1 year'."""
    return col(ts) + F.expr(f"interval {amount}")


def within(ts, start, end) -> Column:
    """Closed window test."""
    return col(ts).between(col(start), col(end))


def distinct_from(c, value) -> Column:
    """IS DISTINCT FROM: keeps NULLs, unlike `!=`."""
    return ~col(c).eqNullSafe(F.lit(value))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def sentinel(item, text, value, sentinels: Mapping, number: float = 0.0) -> Column:
    """`number` where an item carries its sentinel text, else the numeric value."""
    result = col(value)
    for code, word in sentinels.items():
        result = F.when((col(item) == code) & (col(text) == word), F.lit(number)).otherwise(result)
    return result


def surgical(service, suffix: str, names: Sequence[str]) -> Column:
    return flag(col(service).endswith(suffix) | col(service).isin(*names))


def rounded(value: str | Column, places: int) -> Column:
    """`round(value, places)` of a double, to the last bit, by decimal numbers only where the next digits are near a half.

    A product below 1e12 is off by less than 0.0003, and a whole number over a power of ten is the double next to the decimal.
    """
    x, scale = col(value), F.lit(10.0**places)
    scaled = x * scale
    whole = F.rint(scaled)
    plain = (F.abs(scaled) < 1e12) & (F.abs(scaled - whole) < 0.499)
    return F.when(plain, (whole + 0.0) / scale).otherwise(F.round(x, places))


def apart(value: str | Column) -> Column:
    """The value, by a higher-order function: Spark leaves its projection out of whole-stage code, where all columns are one
    method, which the JVM does not compile if it is long, and cuts it into short methods."""
    return F.transform(F.array(col(value)), lambda x: x)[0]


def cap_age(age) -> Column:
    return F.when(col(age) > AGE_CAP, F.lit(AGE_CAP_VALUE)).otherwise(col(age))


def died_in_stay(death, start, end, slack: str = "6 hours") -> Column:
    """Death between the stay's borders, widened on both sides."""
    return flag((col(death) >= shift(start, f"-{slack}")) & (col(death) <= shift(end, slack)))


def died_within(death, start, span: str) -> Column:
    """Death before `start` plus the span (strict)."""
    return flag(col(death) < shift(start, span))


def dead_by(ts, death, span: str = "0 days") -> Column:
    """Death at or before `ts` plus the span (inclusive); no death gives 0."""
    return flag(shift(ts, span) >= col(death))


def horizon_labels(ts, death, horizons: Sequence[int] = (1, 7, 30)) -> dict[str, Column]:
    """Outcome labels that move with the time point: dead, dead_in_1d, ..."""
    named = {"dead": dead_by(ts, death)}
    named.update({f"dead_in_{d}d": dead_by(ts, death, f"{d} days") for d in horizons})
    return named


def category_codes(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """0-based code of each value in sorted order, -1 for missing.

    The codebook is the distinct values (a dictionary column has few); each value's code is
    the count of smaller ones.
    """
    from icuflow.operators.ordered import running

    book = df.select(column).where(F.col(column).isNotNull()).distinct()
    book = running(book, [column], totals={"_upto": F.lit(1)}).select(
        F.col(column).alias("_value"), (F.col("_upto") - 1).cast("int").alias("_code")
    )
    coded = df.join(book, F.col(column) == F.col("_value"), "left").drop("_value")
    return coded.withColumn(out or column, F.coalesce("_code", F.lit(-1))).drop("_code")


def drop_after(df: DataFrame, ts: str, event: str) -> DataFrame:
    """Drop rows later than the event; rows without an event stay."""
    return df.filter(F.col(event).isNull() | (F.col(ts) <= F.col(event)))


def overwrite_after(ts: str, event: str, value: str, number: float = 0.0) -> Column:
    """`number` for rows later than their entity's event, else the value."""
    return F.when(F.col(ts) > F.col(event), F.lit(number)).otherwise(F.col(value))


def select_matching(df: DataFrame, pattern: str, without: Sequence[str] = ()) -> DataFrame:
    """Columns whose whole name matches a regex, minus the listed ones."""
    return df.select(df.colRegex(f"`{pattern}`")).drop(*without)
