"""Queries: the clinical views as they are, over the clinical tables that `clinic` fills."""

from __future__ import annotations

from icuflow.functions import items
from icuflow.plans import views
from icuflow.plans.bindings import with_
from icuflow.plans.clinic import SOURCES, clinical, codes, converted, in_range, labelled, pivoted
from icuflow.plans.q_tables import rounded
from icuflow.plans.registry import query

KEYS = "subject_id, hadm_id, icustay_id"
STATS = {"min": "min", "max": "max", "mean": "avg"}
VITALS = items.labels(items.VITALS)
SERIES = [x for x in VITALS if x != "glucose"]
LABS = items.labels(items.LABS)
GAS = items.labels(items.BLOOD_GAS)
ENDS = {"min": "min", "max": "max"}

VITAL_ROWS = f"""vital AS (SELECT i.subject_id, i.hadm_id, i.icustay_id, charttime, {labelled(items.VITALS, "valuenum")} AS label,
  {converted(items.VITALS, "valuenum")} AS v FROM icu i JOIN chart c USING ({KEYS})
  WHERE charttime BETWEEN intime AND intime + INTERVAL 1 DAY AND error IS DISTINCT FROM 1 AND itemid IN ({codes(items.VITALS)}))"""
VITAL_DAY = f"vitals AS (SELECT {KEYS}, {pivoted(VITALS, STATS, 'v')} FROM vital GROUP BY {KEYS})"
LAB_DAY = f"""lab AS (SELECT i.subject_id, i.hadm_id, i.icustay_id, {labelled(items.LABS)} AS label, {in_range(items.LABS, "valuenum")} AS v
  FROM icu i LEFT JOIN labs l ON l.subject_id = i.subject_id AND l.hadm_id = i.hadm_id
  AND charttime BETWEEN intime - INTERVAL 6 HOUR AND intime + INTERVAL 1 DAY AND itemid IN ({codes(items.LABS)}) AND valuenum > 0),
  lab_day AS (SELECT {KEYS}, {pivoted(LABS, ENDS, 'v')} FROM lab GROUP BY {KEYS})"""
GCS_PARTS = ", ".join(f"max(CASE WHEN {labelled(items.GCS)} = '{p}' THEN v END) AS {p}" for p in items.GCS_NORMAL)
PREVIOUS = ", ".join(
    f"CASE WHEN lag(charttime) OVER w > charttime - INTERVAL 6 HOUR THEN lag({p}) OVER w END AS {p}_prev" for p in items.GCS_NORMAL
)
CARRIED = " + ".join(f"coalesce({p}, {p}_prev, {d})" for p, d in items.GCS_NORMAL.items())
ALONE = " + ".join(f"coalesce({p}, {d})" for p, d in items.GCS_NORMAL.items())
SENTINEL = " ".join(f"WHEN itemid = {code} AND value = '{text}' THEN 0" for code, text in items.GCS_SENTINELS.items())
GCS_DAY = f"""part AS (SELECT i.icustay_id, charttime, itemid, CASE {SENTINEL} ELSE valuenum END AS v FROM icu i JOIN chart c USING (icustay_id)
    WHERE charttime BETWEEN i.intime AND i.intime + INTERVAL 1 DAY AND error IS DISTINCT FROM 1 AND itemid IN ({codes(items.GCS)})),
  parts AS (SELECT icustay_id, charttime, {GCS_PARTS} FROM part GROUP BY icustay_id, charttime),
  ahead AS (SELECT *, {PREVIOUS} FROM parts WINDOW w AS (PARTITION BY icustay_id ORDER BY charttime)),
  scored AS (SELECT *, CASE WHEN gcsverbal = 0 OR (gcsverbal IS NULL AND gcsverbal_prev = 0) THEN {items.GCS_FULL}
    WHEN gcsverbal_prev = 0 THEN {ALONE} ELSE {CARRIED} END AS mingcs FROM ahead),
  lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY icustay_id ORDER BY mingcs, charttime) = 1),
  gcs_day AS (SELECT i.subject_id, i.hadm_id, i.icustay_id, mingcs, {", ".join(f"coalesce({p}, {p}_prev) AS {p}" for p in items.GCS_NORMAL)},
    CASE WHEN l.icustay_id IS NULL THEN NULL WHEN gcsverbal = 0 THEN 1 ELSE 0 END AS endotrachflag FROM icu i LEFT JOIN lowest l USING (icustay_id))"""
URINE_DAY = f"""urine AS (SELECT {KEYS}, sum(CASE WHEN itemid = {items.URINE_IRRIGANT} THEN -value ELSE value END) AS urineoutput
  FROM icu i JOIN output o USING ({KEYS}) WHERE charttime BETWEEN i.intime AND i.intime + INTERVAL 1 DAY
  AND itemid IN ({", ".join(map(str, items.URINE_OUTPUT))}) GROUP BY {KEYS})"""
VENT_DAY = """vent AS (SELECT i.icustay_id, max(CASE WHEN (starttime <= intime AND endtime >= intime)
  OR starttime BETWEEN intime AND intime + INTERVAL 1 DAY THEN 1 ELSE 0 END) AS vent FROM icu i LEFT JOIN vents v USING (icustay_id) GROUP BY i.icustay_id)"""
DEATHS = ", ".join(
    f"CASE WHEN dod < admittime + INTERVAL {span} THEN 1 ELSE 0 END AS hospital{name}_expire_flag"
    for name, span in {"1day": "1 DAY", "7day": "7 DAY", "30day": "30 DAY", "1year": "1 YEAR"}.items()
)
COHORT = f"""latest AS (SELECT i.icustay_id, curr_service FROM icu i JOIN moves m ON m.hadm_id = i.hadm_id AND transfertime < intime + INTERVAL 12 HOUR
    QUALIFY rank() OVER (PARTITION BY i.icustay_id ORDER BY transfertime DESC) = 1),
  service AS (SELECT icustay_id, min(curr_service) AS curr_service FROM latest GROUP BY icustay_id),
  people AS (SELECT i.icustay_id, first_careunit, admission_type, gender, intime, i.los AS icu_los,
    round(epoch_us(dischtime - admittime) / 86400e6, 4) AS hosp_los, epoch_us(intime - dob) / 86400e6 / {items.DAYS_PER_YEAR} AS age_icu_in, dod,
    CAST(rank() OVER (PARTITION BY i.subject_id ORDER BY intime) AS BIGINT) AS icustay_id_order, hospital_expire_flag,
    CASE WHEN dod >= intime - INTERVAL 6 HOUR AND dod <= outtime + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS icu_expire_flag, {DEATHS}
    FROM icu i JOIN pat p ON p.subject_id = i.subject_id JOIN adm a ON a.hadm_id = i.hadm_id),
  cohort AS (SELECT p.*, CASE WHEN icu_los < 1 THEN 1 ELSE 0 END AS exclusion_los, CASE WHEN age_icu_in < 16 THEN 1 ELSE 0 END AS exclusion_age,
    CASE WHEN icustay_id_order <> 1 THEN 1 ELSE 0 END AS exclusion_first_stay,
    CASE WHEN s.curr_service LIKE '%{items.SURGICAL_SUFFIX}' OR s.curr_service IN ({", ".join(f"'{x}'" for x in items.SURGICAL_SERVICES)}) THEN 1 ELSE 0 END AS exclusion_surgical
    FROM people p LEFT JOIN service s USING (icustay_id))"""


def text_of(select: str, *steps: str) -> str:
    """A query over the clinical tables, numbers rounded like Spark's side."""
    return with_(*SOURCES, *steps) + " " + select


def numbers(names: list[str], of: str = "") -> str:
    return ", ".join(f"round({of}{x}, 6) AS {x}" for x in names)


def columns(labels: list[str], stats: dict[str, str]) -> list[str]:
    return [f"{x}_{s}" for x in labels for s in stats]


@query(text_of(f"SELECT {KEYS}, {numbers(columns(VITALS, STATS))} FROM vitals", VITAL_ROWS, VITAL_DAY))
def vitals_first_day(t):
    source = clinical(t)
    return rounded(views.vitals_first_day(source["icustays"], source["chartevents"]))


@query(text_of(f"SELECT {KEYS}, {numbers(columns(LABS, ENDS))} FROM lab_day", LAB_DAY))
def labs_first_day(t):
    source = clinical(t)
    return rounded(views.labs_first_day(source["icustays"], source["labevents"]))


@query(
    text_of(
        f"SELECT {KEYS}, charttime, "
        + ", ".join(f"max(CASE WHEN label = '{x}' THEN {'value' if x == 'specimen' else 'round(v, 6)'} END) AS {x}" for x in GAS)
        + f" FROM gas GROUP BY {KEYS}, charttime",
        f"""gas AS (SELECT i.subject_id, i.hadm_id, i.icustay_id, charttime, value, {labelled(items.BLOOD_GAS)} AS label,
        {in_range(items.BLOOD_GAS, "valuenum")} AS v FROM icu i LEFT JOIN labs l ON l.subject_id = i.subject_id AND l.hadm_id = i.hadm_id
        AND charttime BETWEEN intime - INTERVAL 6 HOUR AND intime + INTERVAL 1 DAY AND itemid IN ({codes(items.BLOOD_GAS, *items.BLOOD_GAS_UNLABELLED)}))""",
    )
)
def blood_gas_first_day(t):
    source = clinical(t)
    return rounded(views.blood_gas_first_day(source["icustays"], source["labevents"]))


@query(text_of(f"SELECT {KEYS}, mingcs, {', '.join(items.GCS_NORMAL)}, endotrachflag FROM gcs_day", GCS_DAY))
def gcs_first_day(t):
    source = clinical(t)
    return views.gcs_first_day(source["icustays"], source["chartevents"])


PEOPLE = """first_careunit, admission_type, gender, icu_los, hosp_los, round(age_icu_in, 6) AS age_icu_in, icustay_id_order, hospital_expire_flag,
  icu_expire_flag, hospital1day_expire_flag, hospital7day_expire_flag, hospital30day_expire_flag, hospital1year_expire_flag,
  exclusion_los, exclusion_age, exclusion_first_stay, exclusion_surgical"""


@query(
    text_of(
        f"""SELECT v.subject_id, v.hadm_id, v.icustay_id, {numbers(columns(SERIES, STATS), "v.")}, {numbers(columns(LABS, ENDS), "l.")},
        mingcs, {", ".join(items.GCS_NORMAL)}, endotrachflag, urineoutput, vent, {PEOPLE}, height_first, weight_first
        FROM vitals v LEFT JOIN lab_day l USING (icustay_id) LEFT JOIN gcs_day g USING (icustay_id) LEFT JOIN urine u USING (icustay_id)
        LEFT JOIN vent USING (icustay_id) LEFT JOIN cohort USING (icustay_id) LEFT JOIN hw USING (icustay_id)""",
        VITAL_ROWS,
        VITAL_DAY,
        LAB_DAY,
        GCS_DAY,
        URINE_DAY,
        VENT_DAY,
        COHORT,
    )
)
def feature_table(t):
    return rounded(views.feature_table(clinical(t)))


def _history() -> str:
    parts = []
    for x in ["hr" if s == "heartrate" else s for s in SERIES]:
        parts += [f"lag({x}, {k}) OVER h AS {x}_{k}h" for k in (1, 2, 3)]
        parts += [f"{sql}({x}) OVER f AS {x}_{name}_6h" for name, sql in {**STATS, "median": "median"}.items()]
    return ", ".join(parts)


_NAMES = ["hr" if s == "heartrate" else s for s in SERIES]
_HISTORY = [f"{x}_{k}" for x in _NAMES for k in ("1h", "2h", "3h", "mean_6h", "min_6h", "max_6h", "median_6h")]
_SERIES_RULES = [r for r in items.VITALS if r.label != "glucose"]


@query(
    text_of(
        f"""SELECT s.subject_id, s.hadm_id, s.icustay_id, s.timestamp, {numbers(_NAMES)}, {numbers(_HISTORY)}, {PEOPLE}, curr_service, intime AS icu_intime,
        dod AS dod_hosp, height_first, weight_first, round(epoch_us(s.timestamp - intime) / 86400e6 / {items.DAYS_PER_YEAR}, 6) AS icu_elapsed_years,
        CASE WHEN s.timestamp >= dod THEN 1 ELSE 0 END AS dead, {", ".join(f"CASE WHEN s.timestamp + INTERVAL {d} DAY >= dod THEN 1 ELSE 0 END AS dead_in_{d}d" for d in (1, 7, 30))}
        FROM history s LEFT JOIN cohort USING (icustay_id) LEFT JOIN service USING (icustay_id) LEFT JOIN hw USING (icustay_id)""",
        f"""hour AS (SELECT DISTINCT i.subject_id, i.hadm_id, i.icustay_id, date_trunc('hour', charttime) AS timestamp, {labelled(_SERIES_RULES, "valuenum")} AS label,
        {converted(_SERIES_RULES, "valuenum")} AS v FROM icu i JOIN chart c USING ({KEYS})
        WHERE charttime BETWEEN i.intime AND i.intime + INTERVAL 1 DAY AND error IS DISTINCT FROM 1 AND itemid IN ({codes(_SERIES_RULES)})),
        series AS (SELECT {KEYS}, timestamp, {", ".join(f"avg(CASE WHEN label = '{s}' THEN v END) AS {n}" for s, n in zip(SERIES, _NAMES, strict=True))}
        FROM hour GROUP BY {KEYS}, timestamp),
        history AS (SELECT *, {_history()} FROM series WINDOW h AS (PARTITION BY icustay_id ORDER BY timestamp),
        f AS (PARTITION BY icustay_id ORDER BY timestamp ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""",
        COHORT,
    )
)
def timeseries_table(t):
    return rounded(views.timeseries_table(clinical(t)))
