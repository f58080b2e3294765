"""The clinical roles played by the test tables, for Spark and (as SQL text) for the oracle.

events   -> charted events of a stay (user); orders -> admissions and stays of a customer;
lineitem -> service transfers and lab rows of an order; documents/labels, embeddings ->
feature rows with outcomes. What the tables lack (missing values, error marks, deaths,
birth dates) is derived from the keys, the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.functions.items import Rule
from icuflow.sources.io import Tables

RULES = (
    Rule("click", ("click",), 0, 300),
    Rule("view", ("view",), 0, 400),
    Rule("error", ("error",), 0, 100, hi_closed=True),
    Rule("purchase", ("purchase",), 0),
    Rule("signup", ("signup",), 70, 120, offset=32.0, scale=1.8),
)
TYPES = ["click", "view", "error", "purchase", "signup"]
RANGES = {"click": (20.0, 80.0), "view": (10.0, 60.0), "error": (5.0, 40.0)}


def days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


def stays(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.min("ts").alias("intime"), F.max("ts").alias("outtime"))


def observations(t: Tables) -> DataFrame:
    error = F.when(F.col("event_id") % 7 == 1, 1).when(F.col("event_id") % 7 != 0, 0)
    return t.events.select(
        "event_id",
        "user_id",
        "ts",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("code"),
        error.alias("err"),
    )


def deaths(t: Tables) -> DataFrame:
    died = F.when(F.col("user_id") % 3 == 0, F.col("intime") + days(F.col("user_id") % 20))
    return stays(t).withColumn("death", died)


def icustays(t: Tables) -> DataFrame:
    los = F.col("o_orderkey") % 9 + 1
    return t.orders.select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderkey").alias("icustay_id"),
        F.col("o_orderpriority").alias("first_careunit"),
        F.col("o_orderdate").alias("intime"),
        (F.col("o_orderdate") + days(los)).alias("outtime"),
        los.cast("double").alias("los"),
    )


def admissions(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderdate").alias("admittime"),
        (F.col("o_orderdate") + days(F.col("o_orderkey") % 9 + 3)).alias("dischtime"),
        F.col("o_orderstatus").alias("admission_type"),
        (F.col("o_orderstatus") == "F").cast("int").alias("hospital_expire_flag"),
    )


def patients(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    born = F.lit("1920-01-01 06:30:00").cast("timestamp_ntz") + days(key * 37 % 25000)
    dead = F.when(key % 3 == 0, F.lit("1996-01-01 00:00:00").cast("timestamp_ntz") + days(key * 11 % 2000))
    return t.customer.select(
        key.alias("subject_id"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
        born.alias("dob"),
        dead.alias("dod"),
        dead.alias("dod_hosp"),
    )


def transfers(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_shipdate").alias("transfertime"),
        F.col("l_returnflag").alias("curr_service"),
        F.col("l_quantity").alias("value"),
    )


ST = "st AS (SELECT user_id, min(ts) AS intime, max(ts) AS outtime FROM events GROUP BY user_id)"
OBS = """obs AS (SELECT event_id, user_id, ts, event_type, value,
  CAST(json_extract(props, '$.k') AS INTEGER) AS code,
  CASE WHEN event_id % 7 = 1 THEN 1 WHEN event_id % 7 != 0 THEN 0 END AS err FROM events)"""
DEATH = """death AS (SELECT user_id, intime, outtime,
  CASE WHEN user_id % 3 = 0 THEN intime + to_days(CAST(user_id % 20 AS INTEGER)) END AS death FROM st)"""
ICU = """icu AS (SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderkey AS icustay_id,
  o_orderpriority AS first_careunit, o_orderdate AS intime,
  o_orderdate + to_days(CAST(o_orderkey % 9 + 1 AS INTEGER)) AS outtime,
  CAST(o_orderkey % 9 + 1 AS DOUBLE) AS los FROM orders)"""
ADM = """adm AS (SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderdate AS admittime,
  o_orderdate + to_days(CAST(o_orderkey % 9 + 3 AS INTEGER)) AS dischtime, o_orderstatus AS admission_type,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS hospital_expire_flag FROM orders)"""
PAT = """pat AS (SELECT c_custkey AS subject_id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  TIMESTAMP '1920-01-01 06:30:00' + to_days(CAST(c_custkey * 37 % 25000 AS INTEGER)) AS dob,
  CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '1996-01-01 00:00:00' + to_days(CAST(c_custkey * 11 % 2000 AS INTEGER)) END AS dod
  FROM customer)"""
SVC = """svc AS (SELECT l_orderkey AS hadm_id, l_shipdate AS transfertime, l_returnflag AS curr_service,
  l_quantity AS value FROM lineitem)"""
# Valid label and converted value of an observation, per item.
LABEL = """CASE WHEN event_type = 'click' AND value > 0 AND value < 300 THEN 'click'
  WHEN event_type = 'view' AND value > 0 AND value < 400 THEN 'view'
  WHEN event_type = 'error' AND value > 0 AND value <= 100 THEN 'error'
  WHEN event_type = 'purchase' AND value > 0 THEN 'purchase'
  WHEN event_type = 'signup' AND value > 70 AND value < 120 THEN 'signup' END"""
CONVERTED = "CASE WHEN event_type = 'signup' THEN (value - 32) / 1.8 ELSE value END"
# First-day rows of every stay, without error-marked ones.
DAY = f"""day1 AS (SELECT o.*, st.intime, {LABEL} AS label, {CONVERTED} AS converted
  FROM st JOIN obs o ON o.user_id = st.user_id AND o.ts BETWEEN st.intime AND st.intime + INTERVAL 1 DAY
  WHERE o.err IS DISTINCT FROM 1)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)
