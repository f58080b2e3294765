"""Queries: hourly series, lags, rolling frames, order-dependent columns, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuflow.functions import items
from icuflow.operators import series, stats
from icuflow.plans.bindings import LABEL, RULES, TYPES, with_
from icuflow.plans.q_tables import rounded
from icuflow.plans.registry import query
from icuflow.streaming import live

MEANS = ", ".join(f"avg(CASE WHEN label = '{x}' THEN value END) AS {x}" for x in TYPES)
LABELLED = f"lab AS (SELECT user_id, date_trunc('hour', ts) AS hour, {LABEL} AS label, value FROM events)"
HOURLY = f"hr AS (SELECT user_id, hour, {MEANS} FROM (SELECT DISTINCT * FROM lab) x GROUP BY user_id, hour)"
FRAME = "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"


def labelled(t):
    label = items.valid_label(F.col("event_type"), F.col("value"), RULES)
    return t.events.select("user_id", "ts", label.alias("label"), "value")


def hours(t, distinct=True):
    return series.hourly(labelled(t), ["user_id"], "ts", "label", "value", TYPES, distinct, out="hour")


def rounded_sql(columns):
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


@query(with_(LABELLED, HOURLY) + f" SELECT user_id, hour, {rounded_sql(TYPES)} FROM hr")
def hourly_distinct_avg(t):
    return rounded(hours(t))


@query(with_(LABELLED) + f", hr AS (SELECT user_id, hour, {MEANS} FROM lab GROUP BY user_id, hour) SELECT user_id, hour, {rounded_sql(TYPES)} FROM hr")
def hourly_resample(t):
    return rounded(hours(t, distinct=False))


WIDE = ", ".join(f"CASE WHEN label = '{x}' THEN value END AS {x}" for x in TYPES)


@query(f"SELECT DISTINCT user_id, ts, {WIDE} FROM (SELECT user_id, ts, {LABEL} AS label, value FROM events) x")
def wide_timeseries(t):
    return series.wide_rows(labelled(t), ["user_id", "ts"], "label", "value", TYPES)


def history_sql(over, lags=(1, 2, 3, 5), named=("mean", "min", "max")):
    agg = {"mean": "avg", "min": "min", "max": "max", "median": "median"}
    parts = []
    for v in TYPES:
        parts += [f"round(lag({v}, {k}) OVER ({over}), 6) AS {v}_{k}h" for k in lags]
        parts += [f"round({agg[s]}({v}) OVER ({over} {FRAME}), 6) AS {v}_{s}_6h" for s in named]
    return ", ".join(parts)


PER_STAY = "PARTITION BY user_id ORDER BY hour"


def history(t, lags=(), stats_=(), scope="stay"):
    slim = hours(t).select("user_id", "hour", *TYPES)
    return rounded(series.with_history(slim, TYPES, ["user_id"], ["hour"], lags, 6, stats_, scope).drop(*TYPES))


@query(with_(LABELLED, HOURLY) + f" SELECT user_id, hour, {history_sql(PER_STAY, named=())} FROM hr")
def lag_features(t):
    return history(t, lags=(1, 2, 3, 5))


@query(with_(LABELLED, HOURLY) + f" SELECT user_id, hour, {history_sql(PER_STAY, lags=())} FROM hr")
def rolling_stats(t):
    return history(t, stats_=("mean", "min", "max"))


@query(with_(LABELLED, HOURLY) + f" SELECT user_id, hour, {history_sql(PER_STAY, lags=(), named=('median',))} FROM hr")
def rolling_median(t):
    return history(t, stats_=("median",))


@query(with_(LABELLED, HOURLY) + f" SELECT user_id, hour, {history_sql('ORDER BY user_id, hour', lags=(1, 2, 3))} FROM hr")
def rolling_global(t):
    return history(t, lags=(1, 2, 3), stats_=("mean", "min", "max"), scope="global")


@query(
    """SELECT event_id, user_id, round((epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id))) / 1e6, 6) AS elapsed_seconds
    FROM events"""
)
def elapsed_from_first(t):
    slim = t.events.select("event_id", "user_id", "ts")
    return rounded(series.elapsed_from_first(slim, ["user_id"], "ts").drop("ts"))


@query(
    """WITH n AS (SELECT o_orderkey, o_custkey, o_orderdate,
      lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt FROM orders),
    g AS (SELECT o_orderkey, (epoch_us(nxt) - epoch_us(o_orderdate)) / 86400e6 AS days_to_next FROM n)
    SELECT o_orderkey, days_to_next, CASE WHEN days_to_next <= 30 THEN 1 ELSE 0 END AS readmitted FROM g"""
)
def readmission_label(t):
    slim = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    labelled_ = series.next_within(slim, ["o_custkey"], "o_orderdate", "o_orderkey", 30)
    return labelled_.select("o_orderkey", "days_to_next", "readmitted")


@query(
    """SELECT user_id, event_type, max(value) AS first_value FROM (SELECT *, dense_rank() OVER
    (PARTITION BY user_id, event_type ORDER BY date_trunc('hour', ts)) AS r FROM events) x WHERE r = 1 GROUP BY user_id, event_type"""
)
def first_measurement(t):
    hourly = t.events.select("user_id", "event_type", F.date_trunc("hour", "ts").alias("hour"), "value")
    return stats.first_measurement(hourly, ["user_id", "event_type"], "hour", "value", "first_value")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def ordered_head(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    """SELECT user_id, event_type, date_trunc('hour', ts) AS hour, round(avg(value), 6) AS mean, count(*) AS n
    FROM events GROUP BY user_id, event_type, date_trunc('hour', ts)"""
)
def stream_hourly(t):
    return rounded(
        windows_of_a_feed(t, ["user_id", "event_type"], lambda: F.window("ts", "1 hour")).select("user_id", "event_type", F.col("start").alias("hour"), "mean", "n")
    )


def windows_of_a_feed(t, keys, window):
    """Windows of the events as a feed of many files in no order of time, taken in two at a time."""
    folder = live.many_files(t.events)
    sink = live.PartialWindows(f"{folder}-windows", keys, "value", window)
    sink.take_in(live.feed(t.spark, folder))
    return sink.read(t.spark).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    """WITH spread AS (SELECT user_id, date_trunc('hour', ts) - to_hours(CAST(k AS INTEGER)) AS start, value
      FROM events, range(6) r(k))
    SELECT user_id, start, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high, count(*) AS n
    FROM spread GROUP BY user_id, start"""
)
def stream_sliding(t):
    return rounded(windows_of_a_feed(t, ["user_id"], lambda: F.window("ts", "6 hours", "1 hour")), keep=("low", "high"))


CARRIED = ", ".join(
    f"CASE WHEN epoch_us(ts) - epoch_us(last_value(CASE WHEN event_type = '{x}' THEN ts END IGNORE NULLS) OVER w) < 21600000000 "
    f"THEN last_value(CASE WHEN event_type = '{x}' THEN value END IGNORE NULLS) OVER w END AS {x}"
    for x in TYPES
)


@query(
    f"""SELECT user_id, event_id, ts, FALSE AS late, {CARRIED} FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def stream_carry_forward(t):
    # Files come in the order of time, as a live feed delivers them.
    folder = live.many_files(t.events, 4, "ts")
    found = live.with_rocks(t.spark, lambda: live.stored(live.carry_forward(live.feed(t.spark, folder, files=1), tuple(TYPES))))
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_distinct(t):
    # Every reading arrives twice.
    feed = live.event_stream(t.spark, t.folder).select("event_id", "user_id", "event_type", "ts", "value")
    twice = feed.unionByName(live.event_stream(t.spark, t.folder).select(feed.columns))
    return live.stored(live.distinct_readings(twice, ["event_id"])).drop("ts")


@query(
    """WITH spread AS (SELECT user_id, date_trunc('hour', ts) - to_hours(CAST(k AS INTEGER)) AS start, value
      FROM events, range(6) r(k))
    SELECT user_id, start, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high, count(*) AS n
    FROM spread GROUP BY user_id, start"""
)
def sliding_6h(t):
    zoned = t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    found = live.sliding(zoned, ["user_id"], "value")
    return rounded(found.withColumn("start", F.col("start").cast("timestamp_ntz")), keep=("low", "high"))


