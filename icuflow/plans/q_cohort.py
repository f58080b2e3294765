"""Queries: joins, cohort building, views and assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuflow.functions import items, scalar as fn
from icuflow.operators import cohort, pivot, score, windows
from icuflow.plans import views
from icuflow.plans.bindings import (
    ADM, DAY, DEATH, ICU, OBS, PAT, ST, SVC, TYPES,
    admissions, days, deaths, icustays, observations, patients, stays, transfers, with_,
)
from icuflow.plans.q_tables import PIVOT_SQL, first_day, first_day_vitals, rounded
from icuflow.plans.registry import query

SURGICAL = ("R",)


def base(t):
    return cohort.cohort_base(icustays(t), patients(t), admissions(t))


def service(t, per="stay"):
    return cohort.latest_service(icustays(t), transfers(t), per)


def flagged(t):
    return cohort.with_exclusions(base(t), service(t), min_los_days=2, min_age=40, surgical=fn.surgical("curr_service", "~", SURGICAL))


CO = """co AS (SELECT icu.subject_id, icu.hadm_id, icu.icustay_id, first_careunit, admission_type, gender, intime AS icu_intime,
  los AS icu_los, round((epoch_us(dischtime) - epoch_us(admittime)) / 86400e6, 4) AS hosp_los,
  (epoch_us(intime) - epoch_us(dob)) / 86400e6 / 365.242 AS age_icu_in, dod AS dod_hosp,
  CAST(rank() OVER (PARTITION BY icu.subject_id ORDER BY intime) AS INTEGER) AS icustay_id_order, hospital_expire_flag,
  CASE WHEN dod >= intime - INTERVAL 6 HOUR AND dod <= outtime + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS icu_expire_flag,
  CASE WHEN dod < admittime + INTERVAL 1 DAY THEN 1 ELSE 0 END AS hospital1day_expire_flag,
  CASE WHEN dod < admittime + INTERVAL 7 DAY THEN 1 ELSE 0 END AS hospital7day_expire_flag,
  CASE WHEN dod < admittime + INTERVAL 30 DAY THEN 1 ELSE 0 END AS hospital30day_expire_flag,
  CASE WHEN dod < admittime + INTERVAL 1 YEAR THEN 1 ELSE 0 END AS hospital1year_expire_flag
  FROM icu JOIN pat ON pat.subject_id = icu.subject_id JOIN adm ON adm.hadm_id = icu.hadm_id)"""
SERV = """ranked AS (SELECT icu.hadm_id, icu.icustay_id, svc.curr_service,
  rank() OVER (PARTITION BY icu.icustay_id ORDER BY svc.transfertime DESC NULLS FIRST) AS r
  FROM icu LEFT JOIN svc ON svc.hadm_id = icu.hadm_id AND svc.transfertime < icu.intime + INTERVAL 12 HOUR),
  serv AS (SELECT DISTINCT hadm_id, icustay_id, curr_service FROM ranked WHERE r = 1)"""
EXCL = """excl AS (SELECT co.*, serv.curr_service,
  CASE WHEN icu_los < 2 THEN 1 ELSE 0 END AS exclusion_los, CASE WHEN age_icu_in < 40 THEN 1 ELSE 0 END AS exclusion_age,
  CASE WHEN icustay_id_order != 1 THEN 1 ELSE 0 END AS exclusion_first_stay,
  CASE WHEN curr_service IN ('R') THEN 1 ELSE 0 END AS exclusion_surgical
  FROM co LEFT JOIN (SELECT icustay_id, min(curr_service) AS curr_service FROM serv GROUP BY icustay_id) serv
  ON serv.icustay_id = co.icustay_id)"""
CO_COLUMNS = """subject_id, hadm_id, icustay_id, first_careunit, admission_type, gender, icu_intime, icu_los, hosp_los,
  round(age_icu_in, 6) AS age_icu_in, dod_hosp, icustay_id_order, hospital_expire_flag, icu_expire_flag,
  hospital1day_expire_flag, hospital7day_expire_flag, hospital30day_expire_flag, hospital1year_expire_flag"""


@query(with_(ICU, ADM, PAT, CO) + f" SELECT {CO_COLUMNS} FROM co")
def cohort_base(t):
    return base(t).withColumn("age_icu_in", F.round("age_icu_in", 6))


@query(with_(ICU) + " SELECT icustay_id, CAST(rank() OVER (PARTITION BY subject_id ORDER BY intime) AS INTEGER) AS icustay_id_order FROM icu")
def stay_order(t):
    return cohort.stay_order(icustays(t)).select("icustay_id", "icustay_id_order")


# Stays of one customer share an admission in the admission-wide variant.
@query(
    with_(
        ICU,
        SVC,
        SERV,
        """shared AS (SELECT o_custkey AS hadm_id, o_orderkey AS icustay_id, o_orderdate AS intime FROM orders),
        moves AS (SELECT o_custkey AS hadm_id, l_shipdate AS transfertime, l_returnflag AS curr_service
                  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
        wide AS (SELECT s.hadm_id, s.icustay_id, m.curr_service,
          rank() OVER (PARTITION BY s.hadm_id ORDER BY m.transfertime DESC NULLS FIRST) AS r
          FROM shared s LEFT JOIN moves m ON m.hadm_id = s.hadm_id AND m.transfertime < s.intime + INTERVAL 12 HOUR)""",
    )
    + """ SELECT 'stay' AS per, hadm_id, icustay_id, curr_service FROM serv
    UNION ALL SELECT DISTINCT 'admission' AS per, hadm_id, icustay_id, curr_service FROM wide WHERE r = 1"""
)
def asof_service(t):
    per_stay = service(t).select(F.lit("stay").alias("per"), "*")
    shared = icustays(t).withColumn("hadm_id", F.col("subject_id"))
    keyed = t.orders.select(F.col("o_orderkey").alias("hadm_id"), "o_custkey")
    moves = transfers(t).join(keyed, "hadm_id").withColumn("hadm_id", F.col("o_custkey")).drop("o_custkey")
    per_admission = cohort.latest_service(shared, moves, "admission").select(F.lit("admission").alias("per"), "*")
    return per_stay.unionByName(per_admission)


@query(
    with_(ICU, ADM, PAT, CO, SVC, SERV, EXCL)
    + """ SELECT icustay_id, curr_service, exclusion_los, exclusion_age, exclusion_first_stay, exclusion_surgical FROM excl"""
)
def exclusion_flags(t):
    return flagged(t).select("icustay_id", "curr_service", *cohort.EXCLUSIONS)


REPORT_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS flag, sum({value})::BIGINT AS excluded, count(*) AS stays, round(sum({value}) * 100 / count(*), 4) AS percent FROM excl"
    for name, value in [
        *[(f, f) for f in cohort.EXCLUSIONS],
        ("any", "greatest(exclusion_los, exclusion_age, exclusion_first_stay, exclusion_surgical)"),
    ]
)


@query(with_(ICU, ADM, PAT, CO, SVC, SERV, EXCL) + " " + REPORT_SQL)
def exclusion_report(t):
    return cohort.exclusion_report(flagged(t))


@query(
    with_(ICU, ADM, PAT, CO, SVC, SERV, EXCL)
    + """ SELECT icustay_id, subject_id, round(age_icu_in, 6) AS age_icu_in, icu_los FROM excl
    WHERE exclusion_los = 0 AND exclusion_age = 0 AND exclusion_first_stay = 0"""
)
def cohort_select(t):
    kept = cohort.select_cohort(flagged(t))
    return kept.select("icustay_id", "subject_id", F.round("age_icu_in", 6).alias("age_icu_in"), "icu_los")


@query(
    with_(ST, OBS, DAY)
    + " SELECT event_id, user_id, event_type, label, round(converted, 6) AS value FROM day1"
)
def first_day_events(t):
    return first_day(t).select("event_id", "user_id", "event_type", "label", F.round("converted", 6).alias("value"))


@query(
    with_(ICU, SVC)
    + """ SELECT icu.icustay_id, svc.curr_service, svc.value, svc.transfertime FROM icu
    JOIN svc ON svc.hadm_id = icu.hadm_id
    AND svc.transfertime BETWEEN icu.intime - INTERVAL 90 DAY AND icu.intime + INTERVAL 90 DAY"""
)
def lookback_join(t):
    borders = icustays(t).select(
        "hadm_id", "icustay_id", fn.shift("intime", "-90 days").alias("_from"), fn.shift("intime", "90 days").alias("_to")
    )
    joined = windows.range_join(borders, transfers(t), ["hadm_id"], "transfertime", "_from", "_to", bucket=90 * 86400)
    return joined.select("icustay_id", "curr_service", "value", "transfertime")


NEAR = "svc.transfertime BETWEEN icu.intime - INTERVAL 90 DAY AND icu.intime + INTERVAL 90 DAY"


@query(
    with_(
        ICU,
        SVC,
        f"""w AS (SELECT icu.icustay_id FROM icu LEFT JOIN svc ON svc.hadm_id = icu.hadm_id AND {NEAR}
        WHERE svc.curr_service IN ('A', 'R')),
        o AS (SELECT icu.icustay_id, svc.value FROM icu LEFT JOIN svc ON svc.hadm_id = icu.hadm_id AND {NEAR}
        AND svc.curr_service IN ('A', 'R'))""",
    )
    + """ SELECT 'where' AS form, count(DISTINCT icustay_id) AS stays, count(*) AS n, count(*) AS matched FROM w
    UNION ALL SELECT 'on' AS form, count(DISTINCT icustay_id) AS stays, count(*) AS n, count(value) AS matched FROM o"""
)
def left_vs_inner(t):
    chosen = transfers(t).filter(F.col("curr_service").isin("A", "R"))
    keyed = icustays(t).select("hadm_id", "icustay_id", "intime")
    start, end = fn.shift("s.intime", "-90 days"), fn.shift("s.intime", "90 days")

    def counted(how, name):
        rows = windows.events_in_window(keyed, chosen, ["hadm_id"], "transfertime", start, end, how)
        per_stay = rows.groupBy("icustay_id").agg(F.count(F.lit(1)).alias("_n"), F.count("value").alias("_m"))
        return per_stay.agg(
            F.count(F.lit(1)).alias("stays"), F.sum("_n").alias("n"), F.sum("_m").alias("matched")
        ).select(F.lit(name).alias("form"), "*")

    return counted("inner", "where").unionByName(counted("left", "on"))


@query(
    """WITH per AS (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey),
    first AS (SELECT o_custkey, o_orderkey AS stay FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM orders) x WHERE rn = 1)
    SELECT first.stay, b.o_orderkey AS other, per.quantity FROM first JOIN orders b ON b.o_custkey = first.o_custkey
    JOIN per ON per.l_orderkey = b.o_orderkey"""
)
def coarse_key_join(t):
    # The stay's own key is left out, so the subject's first stay meets all its admissions' rows.
    # One stay per subject on the left: the result has one row per right-hand row.
    per = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))
    keyed = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    first = windows.first_events(keyed, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    first = first.select("o_custkey", F.col("o_orderkey").alias("stay"))
    others = t.orders.select("o_custkey", F.col("o_orderkey").alias("other"))
    return others.join(per, F.col("other") == F.col("l_orderkey")).join(first, "o_custkey").select("stay", "other", "quantity")


@query(
    with_(ST, OBS, DAY, f"v AS (SELECT user_id, {PIVOT_SQL} FROM day1 GROUP BY user_id)")
    + """ SELECT c_custkey, c_mktsegment, click_min, click_max, view_mean FROM v
    JOIN customer ON c_custkey = v.user_id WHERE c_acctbal > 0"""
)
def cohort_vitals(t):
    v = rounded(first_day_vitals(t)).select("user_id", "click_min", "click_max", "view_mean")
    chosen = t.customer.filter("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    return v.join(chosen, v.user_id == chosen.c_custkey).drop("user_id")


@query(
    with_(
        ICU,
        """ep AS (SELECT l_orderkey AS icustay_id, l_shipdate AS starttime,
        l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS endtime FROM lineitem)""",
    )
    + """ SELECT icu.icustay_id, max(CASE WHEN ep.icustay_id IS NOT NULL THEN 1 ELSE 0 END) AS vent
    FROM icu LEFT JOIN ep ON ep.icustay_id = icu.icustay_id AND ((ep.starttime <= icu.intime AND ep.endtime >= icu.intime)
    OR (ep.starttime >= icu.intime AND ep.starttime <= icu.intime + INTERVAL 1 DAY)) GROUP BY icu.icustay_id"""
)
def overlap_flag(t):
    episodes = t.lineitem.select(
        F.col("l_orderkey").alias("icustay_id"),
        F.col("l_shipdate").alias("starttime"),
        (F.col("l_shipdate") + days(F.col("l_quantity"))).alias("endtime"),
    )
    return views.ventilation_first_day(icustays(t), episodes).select("icustay_id", "vent")


@query(
    """WITH w AS (SELECT o_orderkey, o_custkey,
      TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS starts,
      TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 + 1 + o_orderkey % 9 AS INTEGER)) AS ends FROM orders)
    SELECT w.o_orderkey, e.event_id, e.value FROM w JOIN events e ON e.user_id = w.o_custkey AND e.ts BETWEEN w.starts AND w.ends"""
)
def range_join_stay(t):
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    offset = F.col("o_orderkey") % 30
    spans = t.orders.select(
        "o_orderkey",
        F.col("o_custkey").alias("user_id"),
        (first + days(offset)).alias("starts"),
        (first + days(offset + 1 + F.col("o_orderkey") % 9)).alias("ends"),
    )
    joined = windows.range_join(spans, t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], "ts", "starts", "ends")
    return joined.select("o_orderkey", "event_id", "value")


@query(
    with_(ST, DEATH)
    + """ SELECT user_id, CASE WHEN death BETWEEN intime AND outtime THEN 1 ELSE 0 END AS mort_stay,
    CASE WHEN death BETWEEN intime AND intime + INTERVAL 7 DAY THEN 1 ELSE 0 END AS mort_week FROM death"""
)
def event_in_interval_flag(t):
    week = deaths(t).withColumn("week", fn.shift("intime", "7 days"))
    return week.select(
        "user_id",
        windows.event_in_interval("death", "intime", "outtime").alias("mort_stay"),
        windows.event_in_interval("death", "intime", "week").alias("mort_week"),
    )


# Three event types per (user, hour) play the score's components.
PARTS = {"motor": 6, "verbal": 5, "eyes": 4}
COMP = """comp AS (SELECT user_id, date_trunc('hour', ts) AS hour,
  max(CASE WHEN event_type = 'click' THEN code % 7 END) AS motor, max(CASE WHEN event_type = 'view' THEN code % 6 END) AS verbal,
  max(CASE WHEN event_type = 'error' THEN code % 5 END) AS eyes
  FROM obs WHERE event_type IN ('click', 'view', 'error') GROUP BY user_id, date_trunc('hour', ts))"""
SCORED = """prev AS (SELECT *, lag(hour) OVER w AS h, lag(motor) OVER w AS m, lag(verbal) OVER w AS v, lag(eyes) OVER w AS e
  FROM comp WINDOW w AS (PARTITION BY user_id ORDER BY hour)),
  kept AS (SELECT user_id, hour, motor, verbal, eyes, CASE WHEN h > hour - INTERVAL 6 HOUR THEN m END AS motor_prev,
  CASE WHEN h > hour - INTERVAL 6 HOUR THEN v END AS verbal_prev, CASE WHEN h > hour - INTERVAL 6 HOUR THEN e END AS eyes_prev FROM prev),
  scored AS (SELECT *, CASE WHEN verbal = 0 OR (verbal IS NULL AND verbal_prev = 0) THEN 15
  WHEN verbal_prev = 0 THEN coalesce(motor, 6) + coalesce(verbal, 5) + coalesce(eyes, 4)
  ELSE coalesce(motor, motor_prev, 6) + coalesce(verbal, verbal_prev, 5) + coalesce(eyes, eyes_prev, 4) END AS score FROM kept)"""


def components(t):
    rules = (items.Rule("motor", ("click",)), items.Rule("verbal", ("view",)), items.Rule("eyes", ("error",)))
    part = items.fuse(F.col("event_type"), rules)
    number = F.when(part == "motor", F.col("code") % 7).when(part == "verbal", F.col("code") % 6).otherwise(F.col("code") % 5)
    rows = observations(t).filter(F.col("event_type").isin(*items.codes(rules)))
    rows = rows.select("user_id", fn.hour_of("ts").alias("hour"), part.alias("part"), number.alias("number"))
    return pivot.pivot_max(rows, ["user_id", "hour"], "part", dict.fromkeys(PARTS, "number"))


def scored(t):
    return score.carry_forward(components(t), ["user_id"], "hour", PARTS, "verbal", 15)


@query(with_(OBS, COMP, SCORED) + " SELECT user_id, hour, motor, verbal, eyes, score FROM scored")
def carry_forward_score(t):
    return scored(t).select("user_id", "hour", "motor", "verbal", "eyes", "score")


@query(
    with_(OBS, COMP)
    + " SELECT user_id, min(motor + verbal + eyes) AS score_min, max(motor + verbal + eyes) AS score_max FROM comp GROUP BY user_id"
)
def component_sum_score(t):
    return score.component_sum(components(t), ["user_id"], list(PARTS))


@query(
    with_(OBS, COMP, SCORED, "n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score, hour) AS rn FROM scored)")
    + " SELECT user_id, score, hour, coalesce(motor, motor_prev) AS motor FROM n WHERE rn = 1"
)
def argmin_row(t):
    shown = scored(t).withColumn("motor", F.coalesce("motor", "motor_prev"))
    return score.lowest(shown, ["user_id"], ["score", "hour"], ["score", "hour", "motor"])


@query(
    """SELECT o.o_orderkey, n.n_name AS nation, r.r_name AS region FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey"""
)
def dict_label_join(t):
    # The dictionaries are small enough for Spark's own size-checked broadcast.
    labels = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region")
    )
    who = t.customer.select("c_custkey", "c_nationkey").join(labels, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "nation", "region")


@query(with_(ST, OBS, DAY) + f" SELECT user_id, {PIVOT_SQL} FROM day1 GROUP BY user_id")
def vitals_pivot(t):
    return rounded(first_day_vitals(t))


LAB_COLUMNS = ", ".join(f"{f}(CASE WHEN curr_service = '{s}' THEN v END) AS {s.lower()}_{f}" for s in "ANR" for f in ("min", "max"))


@query(
    with_(
        ICU,
        SVC,
        f"""near AS (SELECT icu.icustay_id, curr_service, CASE WHEN value > 40 THEN NULL ELSE value END AS v
        FROM icu LEFT JOIN svc ON svc.hadm_id = icu.hadm_id AND {NEAR} AND value > 5)""",
    )
    + f" SELECT icustay_id, {LAB_COLUMNS} FROM near GROUP BY icustay_id"
)
def lab_pivot(t):
    rules = tuple(items.Rule(s.lower(), (s,), 5, 40, hi_closed=True) for s in "ANR")
    item, value = F.col("curr_service"), F.col("value")
    labs = transfers(t).filter(value > 5).select(
        "hadm_id", "transfertime", items.fuse(item, rules).alias("label"), items.valid_value(item, value, rules).alias("v")
    )
    keyed = icustays(t).select("hadm_id", "icustay_id", "intime")
    rows = windows.events_in_window(
        keyed, labs, ["hadm_id"], "transfertime", fn.shift("s.intime", "-90 days"), fn.shift("s.intime", "90 days"), "left"
    )
    return pivot.pivot_stats(rows, ["icustay_id"], "label", "v", ["a", "n", "r"], ("min", "max"))


@query(
    with_(OBS)
    + """ SELECT user_id, date_trunc('hour', ts) AS hour, max(CASE WHEN event_type = 'error' THEN event_type || '-' || code END) AS specimen,
    max(CASE WHEN event_type = 'click' THEN value END) AS click, max(CASE WHEN event_type = 'view' THEN value END) AS view,
    max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase FROM obs GROUP BY user_id, date_trunc('hour', ts)"""
)
def bloodgas_pivot(t):
    named = F.when(F.col("event_type") == "error", "specimen").otherwise(F.col("event_type"))
    rows = observations(t).select(
        "user_id", fn.hour_of("ts").alias("hour"), named.alias("label"), "value", F.concat_ws("-", "event_type", "code").alias("text")
    )
    return pivot.pivot_max(
        rows, ["user_id", "hour"], "label", {"specimen": "text", "click": "value", "view": "value", "purchase": "value"}
    )


PLAIN = "count(*) AS n, min(value) AS low, max(value) AS high, round(avg(value), 8) AS mean"


@query(
    with_(ST, OBS)
    + f""" SELECT 'whole' AS span, st.user_id, {PLAIN} FROM st JOIN obs o ON o.user_id = st.user_id GROUP BY st.user_id
    UNION ALL SELECT 'day' AS span, st.user_id, {PLAIN} FROM st JOIN obs o ON o.user_id = st.user_id
    AND o.ts BETWEEN st.intime AND st.intime + INTERVAL 1 DAY GROUP BY st.user_id"""
)
def whole_vs_day(t):
    day = windows.events_in_window(
        stays(t), observations(t), ["user_id"], "ts", F.col("s.intime"), fn.shift("s.intime", "1 day")
    )

    def summary(rows, name):
        return rows.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.round(F.avg("value"), 8).alias("mean"),
        ).select(F.lit(name).alias("span"), "*")

    return summary(observations(t), "whole").unionByName(summary(day, "day"))


URINE = "round(sum(CASE WHEN event_type = 'error' THEN -1 * value ELSE value END), 6)"


@query(with_(ST, OBS, DAY) + f" SELECT user_id, {URINE} AS output FROM day1 GROUP BY user_id")
def signed_sum(t):
    return rounded(pivot.signed_sum(first_day(t), ["user_id"], F.col("event_type") == "error", "value", "output"))


@query(
    with_(
        ST,
        OBS,
        DAY,
        DEATH,
        COMP,
        SCORED,
        f"""v AS (SELECT user_id, {PIVOT_SQL} FROM day1 GROUP BY user_id),
    u AS (SELECT user_id, {URINE} AS output FROM day1 GROUP BY user_id),
    g AS (SELECT user_id, score AS mingcs, motor AS gcsmotor FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score, hour) AS rn FROM scored) x WHERE rn = 1),
    l AS (SELECT user_id, min(code) AS code_min, max(code) AS code_max FROM obs WHERE err = 0 GROUP BY user_id),
    f AS (SELECT d.user_id, max(CASE WHEN o.event_id IS NOT NULL THEN 1 ELSE 0 END) AS vent FROM death d
      LEFT JOIN obs o ON o.user_id = d.user_id AND o.event_type = 'purchase'
      AND o.ts BETWEEN d.intime AND d.intime + INTERVAL 1 DAY GROUP BY d.user_id)""",
    )
    + """ SELECT d.user_id, v.* EXCLUDE (user_id), u.output, g.mingcs, g.gcsmotor, l.code_min, l.code_max, f.vent,
    round((epoch_us(d.outtime) - epoch_us(d.intime)) / 86400e6, 4) AS icu_los, c.c_mktsegment AS first_careunit,
    CASE WHEN d.death >= d.intime - INTERVAL 6 HOUR AND d.death <= d.outtime + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS icu_expire_flag
    FROM death d LEFT JOIN v ON v.user_id = d.user_id LEFT JOIN u ON u.user_id = d.user_id LEFT JOIN g ON g.user_id = d.user_id
    LEFT JOIN l ON l.user_id = d.user_id LEFT JOIN f ON f.user_id = d.user_id LEFT JOIN customer c ON c.c_custkey = d.user_id"""
)
def star_features(t):
    rows = first_day(t)
    lowest = score.lowest(scored(t), ["user_id"], ["score", "hour"], ["score", "hour", "motor"]).select(
        "user_id", F.col("score").alias("mingcs"), F.col("motor").alias("gcsmotor")
    )
    codes = observations(t).filter("err = 0").groupBy("user_id").agg(F.min("code").alias("code_min"), F.max("code").alias("code_max"))
    # A purchase is an instant, so the overlap reduces to "starts in the first day".
    purchases = t.events.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("starttime"), F.col("ts").alias("endtime"))
    people = deaths(t)
    vent = windows.overlap_flag(people.select("user_id", "intime").withColumn("stay", F.col("user_id")), purchases,
                                "user_id", "stay", "intime", "starttime", "endtime", out="vent").select("user_id", "vent")
    base_columns = people.select(
        "user_id",
        fn.length_of_stay("intime", "outtime").alias("icu_los"),
        fn.died_in_stay("death", "intime", "outtime").alias("icu_expire_flag"),
    )
    unit = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("first_careunit"))
    urine = pivot.signed_sum(rows, ["user_id"], F.col("event_type") == "error", "value", "output")
    vitals = pivot.pivot_stats(rows, ["user_id"], "label", "converted", TYPES)
    return rounded(views.assemble(base_columns, [vitals, urine, lowest, codes, vent, unit], "user_id"), keep=("icu_los",))
