"""Joining event streams and episodes to the time windows of stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.functions.scalar import flag, micros, shift, within


def events_in_window(
    stays: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    time: str,
    start: Column,
    end: Column,
    how: str = "inner",
    agreeing: Sequence[str] = (),
) -> DataFrame:
    """Events of each stay inside its closed window, joined on the stay's own key.

    For event tables that carry the stay key: each event meets one stay, so the pair count
    never exceeds the event count. Spark broadcasts the stays if they are small and splits
    a hot stay's events otherwise (adaptive skew join).
    `agreeing` names columns that must be equal too, but that `keys` settle but for a few rows: written as a range, they do
    not deal the rows, so events that lie by key stay where they are.
    """
    s, e = stays.alias("s"), events.alias("e")
    on = within(F.col(f"e.{time}"), start, end)
    for key in keys:
        on = on & (F.col(f"s.{key}") == F.col(f"e.{key}"))
    for c in agreeing:
        on = on & within(F.col(f"e.{c}"), F.col(f"s.{c}"), F.col(f"s.{c}"))
    kept = [F.col(f"s.{c}") for c in stays.columns]
    kept += [F.col(f"e.{c}") for c in events.columns if c not in keys and c not in agreeing]
    return s.join(e, on, how).select(*kept)


def range_join(
    windows: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    bucket: int = 86_400,
) -> DataFrame:
    """Inner join of events to every closed [start, end] window of the same key.

    Several windows may share a key, so a plain equi-join would test every window against
    every event of it. Both sides also join on a time bucket (`bucket` seconds): a window is
    listed under each bucket it touches, an event has one, hence no pair is met twice and a
    hot key spreads over its buckets. Take a bucket near the usual window length.
    """
    width = bucket * 1_000_000
    w = windows.filter(F.col(start) <= F.col(end)).withColumn(
        "_bucket",
        F.explode(F.sequence(F.floor(micros(start) / width), F.floor(micros(end) / width))),
    )
    e = events.withColumn("_bucket", F.floor(micros(time) / width))
    shared = [*keys, "_bucket"]
    return w.join(e, shared).filter(within(time, start, end)).drop("_bucket")


def overlap_flag(
    stays: DataFrame,
    episodes: DataFrame,
    key: str,
    stay_id: str,
    intime: str,
    start: str,
    end: str,
    span: str = "1 day",
    out: str = "flag",
) -> DataFrame:
    """1 if any episode of the key covers the admission or starts in the first `span`.

    `key` is the stay's own key, so each episode meets one stay; the hits are reduced to
    one row per stay before anything else is joined.
    """
    s = stays.select(key, stay_id, intime).alias("s")
    e = episodes.select(key, start, end).alias("e")
    covers = (F.col(start) <= F.col(intime)) & (F.col(end) >= F.col(intime))
    begins = within(start, intime, shift(intime, span))
    hits = s.join(e, [key]).filter(covers | begins).select(stay_id).distinct().withColumn("_hit", F.lit(1))
    return stays.join(hits, stay_id, "left").withColumn(out, F.coalesce("_hit", F.lit(0))).drop("_hit")


def first_events(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in `order`, missing values last, as a partial aggregate instead of a sort."""
    rest = [c for c in df.columns if c not in keys]
    sorted_by = [x for n, c in enumerate(order) for x in (F.col(c).isNull().alias(f"_missing_{n}"), F.col(c))]
    lead = [*sorted_by, *[c for c in rest if c not in order]]
    return df.groupBy(*keys).agg(F.min(F.struct(*lead)).alias("_row")).select(
        *keys, *[F.col(f"_row.{c}").alias(c) for c in rest]
    )


def event_in_interval(event: str, start: str, end: str) -> Column:
    """1 if the event time lies in the closed interval."""
    return flag(within(event, start, end))
