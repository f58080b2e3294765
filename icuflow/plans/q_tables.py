"""Queries: sources and sinks, projection, predicates, scalar functions."""

from __future__ import annotations

from pathlib import Path
from uuid import uuid4

from pyspark.sql import functions as F

from icuflow.functions import items, scalar as fn
from icuflow.operators import pivot, windows
from icuflow.plans.bindings import (
    ADM, CONVERTED, DAY, DEATH, ICU, LABEL, OBS, PAT, RULES, ST, TYPES,
    admissions, deaths, icustays, observations, patients, stays, with_,
)
from icuflow.plans.registry import query
from icuflow.session import shared_dir
from icuflow.sources import io

SQL_FOLDER = Path(__file__).parent / "sql"
#: Columns that are rounded in one method of whole-stage code.
WIDE = 30


def scratch(t) -> str:
    return f"{shared_dir(t.spark)}/icuflow-{uuid4().hex}"


def first_day(t):
    """Valid, converted first-day observations of every stay."""
    kept = observations(t).filter(fn.distinct_from("err", 1))
    item, value = F.col("event_type"), F.col("value")
    rows = windows.events_in_window(stays(t), kept, ["user_id"], "ts", F.col("s.intime"), fn.shift("s.intime", "1 day"))
    return rows.withColumns(
        {"label": items.valid_label(item, value, RULES), "converted": items.convert(item, value, RULES)}
    )


def first_day_vitals(t):
    return pivot.pivot_stats(first_day(t), ["user_id"], "label", "converted", TYPES)


def rounded(df, places: int = 6, keep=()):
    made = [
        fn.rounded(c, places).alias(c) if kind == "double" and c not in keep else F.col(c)
        for c, kind in df.dtypes
    ]
    if len(made) > WIDE:
        made[0] = fn.apart(made[0]).alias(df.columns[0])
    return df.select(*made)


PIVOT_SQL = ",\n".join(
    f"round({f}(CASE WHEN label = '{x}' THEN converted END), 6) AS {x}_{n}"
    for x in TYPES
    for f, n in (("min", "min"), ("max", "max"), ("avg", "mean"))
)


@query(
    """SELECT o_orderpriority AS priority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority"""
)
def src_sql_file(t):
    t.register("orders")
    return io.query_file(t.spark, SQL_FOLDER / "orders_above.sql", floor=100000.0)


@query(
    """SELECT c_custkey AS subject_id, c_name AS name, c_mktsegment AS segment, round(c_acctbal / 100, 4) AS hundreds,
    c_nationkey + 1 AS nation_no FROM customer"""
)
def scan_project(t):
    return t.customer.select(
        F.col("c_custkey").alias("subject_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.round(F.col("c_acctbal") / 100, 4).alias("hundreds"),
        (F.col("c_nationkey") + 1).alias("nation_no"),
    )


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(t):
    kept = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    folder = scratch(t)
    io.write_csv(kept, folder, index="c_custkey")
    return io.read_csv(t.spark, folder, "c_custkey long, c_name string, c_acctbal double, c_mktsegment string")


@query(
    with_(ST, OBS, DAY, f"v AS (SELECT user_id, {PIVOT_SQL} FROM day1 GROUP BY user_id)")
    + " SELECT st.user_id, st.intime, v.click_min, v.view_max, v.error_mean FROM st LEFT JOIN v ON v.user_id = st.user_id"
)
def materialize_views(t):
    built = io.build_views({"vitals": lambda: first_day_vitals(t), "stays": lambda: stays(t)}, scratch(t))
    joined = built["stays"].join(built["vitals"], "user_id", "left")
    return rounded(joined.select("user_id", "intime", "click_min", "view_max", "error_mean"))


@query(
    with_(ST)
    + """ SELECT e.event_id, e.event_type, e.value, round((epoch_us(e.ts) - epoch_us(st.intime)) / 3600e6, 4) AS icu_hours
    FROM events e JOIN st ON st.user_id = e.user_id WHERE e.user_id = 7"""
)
def one_stay_events(t):
    # The feature is the look-up of one entity by a bound id.
    t.register("events")
    stay = io.query_text(t.spark, "SELECT * FROM events WHERE user_id = :id", id=7)
    timed = stay.withColumn("intime", stay.agg(F.min("ts")).scalar())
    return timed.select("event_id", "event_type", "value", F.round(fn.hours_between("intime", "ts"), 4).alias("icu_hours"))


def _elapsed(t):
    return t.events.join(stays(t).select("user_id", "intime"), "user_id")


@query(
    with_(ST)
    + """ SELECT e.event_id, e.user_id, round((epoch_us(e.ts) - epoch_us(st.intime)) / 3600e6, 4) AS icu_hours
    FROM events e JOIN st ON st.user_id = e.user_id"""
)
def elapsed_hours(t):
    return _elapsed(t).select("event_id", "user_id", F.round(fn.hours_between("intime", "ts"), 4).alias("icu_hours"))


@query(
    with_(ST)
    + """ SELECT e.event_id, e.user_id, e.value FROM events e JOIN st ON st.user_id = e.user_id
    WHERE floor((epoch_us(e.ts) - epoch_us(st.intime)) / 86400e6) <= 5"""
)
def snip_days(t):
    whole = F.floor(fn.days_between("intime", "ts"))
    return _elapsed(t).filter(whole <= 5).select("event_id", "user_id", "value")


@query("SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('click', 'view', 'signup')")
def item_filter(t):
    chosen = [r for r in RULES if r.label in ("click", "view", "signup")]
    return t.events.filter(F.col("event_type").isin(*items.codes(chosen))).select("event_id", "user_id", "event_type", "value")


@query(
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'browse'
    WHEN event_type IN ('purchase', 'signup') THEN 'convert' END AS label FROM events"""
)
def item_fuse(t):
    fused = (items.Rule("browse", ("click", "view")), items.Rule("convert", ("purchase", "signup")))
    return t.events.select("event_id", items.fuse(F.col("event_type"), fused).alias("label"))


@query(f"SELECT event_id, {LABEL} AS label FROM events")
def valid_range_label(t):
    return t.events.select("event_id", items.valid_label(F.col("event_type"), F.col("value"), RULES).alias("label"))


@query(f"SELECT event_id, round({CONVERTED}, 6) AS value FROM events")
def unit_convert(t):
    return t.events.select("event_id", F.round(items.convert(F.col("event_type"), F.col("value"), RULES), 6).alias("value"))


@query(
    with_(OBS)
    + """ SELECT event_id, CASE WHEN event_type = 'error' AND code = 0 THEN 0.0
    WHEN event_type = 'view' AND code = 1 THEN 0.0 ELSE value END AS value FROM obs"""
)
def sentinel_map(t):
    mapped = fn.sentinel("event_type", "code", "value", {"error": 0, "view": 1})
    return observations(t).select("event_id", mapped.alias("value"))


@query(
    with_(OBS)
    + """ SELECT event_type, count(CASE WHEN err IS DISTINCT FROM 1 THEN 1 END) AS kept_null_safe,
    count(CASE WHEN err != 1 THEN 1 END) AS kept_plain, count(CASE WHEN err IS NULL THEN 1 END) AS unknown,
    count(CASE WHEN err IS NOT NULL THEN 1 END) AS known FROM obs GROUP BY event_type"""
)
def null_safe_filter(t):
    return observations(t).groupBy("event_type").agg(
        F.count_if(fn.distinct_from("err", 1)).alias("kept_null_safe"),
        F.count_if(F.col("err") != 1).alias("kept_plain"),
        F.count_if(F.col("err").isNull()).alias("unknown"),
        F.count_if(F.col("err").isNotNull()).alias("known"),
    )


@query(
    with_(OBS, f"lab AS (SELECT event_id, err, {LABEL} AS label FROM obs)")
    + """ SELECT 'any' AS rule, event_id FROM lab WHERE err IS NOT NULL AND label IS NOT NULL
    UNION ALL SELECT 'subset' AS rule, event_id FROM lab WHERE label IS NOT NULL"""
)
def drop_nulls(t):
    label = items.valid_label(F.col("event_type"), F.col("value"), RULES).alias("label")
    rows = observations(t).select("event_id", "err", label)
    complete = rows.na.drop("any").select(F.lit("any").alias("rule"), "event_id")
    return complete.unionByName(rows.na.drop("any", subset=["label"]).select(F.lit("subset").alias("rule"), "event_id"))


@query("SELECT event_id, CASE WHEN value > 89 THEN 91.6 ELSE value END AS value FROM events")
def cap_value(t):
    return t.events.select("event_id", fn.cap_age("value").alias("value"))


@query("SELECT doc_id, CASE WHEN quality = 0 THEN -1 ELSE quality END AS quality FROM labels")
def recode_label(t):
    return t.labels.select("doc_id", F.when(F.col("quality") == 0, -1).otherwise(F.col("quality")).alias("quality"))


@query(
    """SELECT p_type, count(CASE WHEN p_name LIKE '%ring' THEN 1 END) AS n_suffix,
    count(CASE WHEN p_brand LIKE 'Brand#1%' THEN 1 END) AS n_prefix,
    sum(CASE WHEN p_name LIKE '%ring' THEN 1 WHEN p_brand IN ('Brand#2') THEN 1 ELSE 0 END)::BIGINT AS n_surgical
    FROM part GROUP BY p_type"""
)
def like_flags(t):
    like_service = F.when(F.col("p_name").endswith("ring") | F.col("p_brand").isin("Brand#2"), 1).otherwise(0)
    return t.part.groupBy("p_type").agg(
        F.count_if(F.col("p_name").like("%ring")).alias("n_suffix"),
        F.count_if(F.col("p_brand").like("Brand#1%")).alias("n_prefix"),
        F.sum(like_service).alias("n_surgical"),
    )


@query(
    """SELECT event_id, user_id, value FROM events WHERE user_id IN
    (SELECT user_id FROM (SELECT DISTINCT user_id FROM events) u
     WHERE substr(md5(CAST(user_id AS VARCHAR)), 1, 1) < '4')"""
)
def semi_join_ids(t):
    # A reproducible random sample of entities, then all their rows.
    ids = t.events.select("user_id").distinct().filter(F.substring(F.md5(F.col("user_id").cast("string")), 1, 1) < "4")
    return t.events.join(ids, "user_id", "left_semi").select("event_id", "user_id", "value")


@query("SELECT c_custkey FROM customer")
def select_regex(t):
    return fn.select_matching(t.customer, "c_.*key", without=["c_nationkey"])


@query(
    with_(ST, DEATH)
    + """ SELECT e.event_id, e.user_id, e.value FROM events e JOIN death d ON d.user_id = e.user_id
    WHERE d.death IS NULL OR e.ts <= d.death"""
)
def drop_after_event(t):
    timed = t.events.join(deaths(t).select("user_id", "death"), "user_id")
    return fn.drop_after(timed, "ts", "death").select("event_id", "user_id", "value")


@query(
    with_(ICU, ADM)
    + """ SELECT icu.icustay_id, round((epoch_us(adm.dischtime) - epoch_us(adm.admittime)) / 86400e6, 4) AS hosp_los,
    round((epoch_us(icu.outtime) - epoch_us(icu.intime)) / 86400e6, 4) AS icu_los
    FROM icu JOIN adm ON adm.hadm_id = icu.hadm_id"""
)
def los_days(t):
    both = icustays(t).join(admissions(t).drop("subject_id"), "hadm_id")
    return both.select(
        "icustay_id",
        fn.length_of_stay("admittime", "dischtime").alias("hosp_los"),
        fn.length_of_stay("intime", "outtime").alias("icu_los"),
    )


@query(
    with_(ICU, PAT)
    + """ SELECT icu.icustay_id, round((epoch_us(icu.intime) - epoch_us(pat.dob)) / 86400e6 / 365.242, 6) AS age
    FROM icu JOIN pat ON pat.subject_id = icu.subject_id"""
)
def age_years(t):
    both = icustays(t).join(patients(t), "subject_id")
    return both.select("icustay_id", F.round(fn.age_years("dob", "intime"), 6).alias("age"))


AGE_FIELDS = """(floor(m / 1440) + floor((m % 1440) / 60) / 24 + (m % 60) / 24 / 60) / 365.25"""


@query(
    with_(
        ICU,
        PAT,
        """gap AS (SELECT icu.icustay_id, (epoch_us(icu.intime) - epoch_us(pat.dob)) // 60000000 AS m
        FROM icu JOIN pat ON pat.subject_id = icu.subject_id)""",
    )
    + f" SELECT icustay_id, round({AGE_FIELDS}, 6) AS age FROM gap"
)
def age_from_fields(t):
    both = icustays(t).join(patients(t), "subject_id")
    return both.select("icustay_id", F.round(fn.age_from_fields("dob", "intime"), 6).alias("age"))


@query(
    with_(ST, DEATH)
    + """ SELECT user_id,
    CASE WHEN death >= intime - INTERVAL 6 HOUR AND death <= outtime + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS icu_expire_flag,
    CASE WHEN death < intime + INTERVAL 1 DAY THEN 1 ELSE 0 END AS in_1d,
    CASE WHEN death < intime + INTERVAL 7 DAY THEN 1 ELSE 0 END AS in_7d,
    CASE WHEN death < intime + INTERVAL 30 DAY THEN 1 ELSE 0 END AS in_30d,
    CASE WHEN death < intime + INTERVAL 1 YEAR THEN 1 ELSE 0 END AS in_1y FROM death"""
)
def interval_flags(t):
    spans = {"in_1d": "1 day", "in_7d": "7 days", "in_30d": "30 days", "in_1y": "1 year"}
    return deaths(t).select(
        "user_id",
        fn.died_in_stay("death", "intime", "outtime").alias("icu_expire_flag"),
        *[fn.died_within("death", "intime", span).alias(name) for name, span in spans.items()],
    )


@query(
    with_(ST, DEATH)
    + """ SELECT e.event_id, CASE WHEN e.ts >= d.death THEN 1 ELSE 0 END AS dead,
    CASE WHEN e.ts + INTERVAL 1 DAY >= d.death THEN 1 ELSE 0 END AS dead_in_1d,
    CASE WHEN e.ts + INTERVAL 7 DAY >= d.death THEN 1 ELSE 0 END AS dead_in_7d,
    CASE WHEN e.ts + INTERVAL 30 DAY >= d.death THEN 1 ELSE 0 END AS dead_in_30d
    FROM events e JOIN death d ON d.user_id = e.user_id"""
)
def horizon_labels(t):
    timed = t.events.join(deaths(t).select("user_id", "death"), "user_id")
    return timed.select("event_id", *[c.alias(n) for n, c in fn.horizon_labels("ts", "death").items()])


SEGMENT = "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END"


@query(
    f"""WITH s AS (SELECT c_custkey, {SEGMENT} AS segment FROM customer),
    book AS (SELECT segment, CAST(row_number() OVER (ORDER BY segment) - 1 AS INTEGER) AS code
             FROM (SELECT DISTINCT segment FROM s WHERE segment IS NOT NULL) x)
    SELECT s.c_custkey, s.segment, coalesce(book.code, -1) AS code FROM s LEFT JOIN book ON book.segment = s.segment"""
)
def category_codes(t):
    segment = F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("segment")
    return fn.category_codes(t.customer.select("c_custkey", segment), "segment", "code")
