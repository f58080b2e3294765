"""Exploratory reports over the clinical tables: one stay, one diagnosis, one lab value."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.functions import items, scalar as fn
from icuflow.operators import pivot, series, stats, windows
from icuflow.plans.views import STAY

# Lower ends of the age bands; the last band is open.
AGE_BANDS = [0, 16, *range(21, 92, 5)]


def stay_admission(t: Mapping[str, DataFrame], icustay_id: int) -> DataFrame:
    """Admissions of the stay's subject with the stay and the subject's fate."""
    stay = t["icustays"].filter(F.col("icustay_id") == icustay_id)
    return (
        t["admissions"]
        .select("subject_id", "admission_type", "diagnosis", "hospital_expire_flag")
        .join(stay.select("subject_id", "icustay_id", "first_careunit", "last_careunit", F.col("intime").alias("icu_intime")), "subject_id")
        .join(t["patients"].select("subject_id", "expire_flag"), "subject_id")
    )


def _timed(stay: DataFrame, rows: DataFrame, dictionary: DataFrame, columns) -> DataFrame:
    named = rows.join(dictionary, "itemid")
    hours = F.round(fn.hours_between("intime", "charttime"), 4).alias("icu_hours")
    return named.join(stay.select("icustay_id", "intime"), "icustay_id").select("icustay_id", "charttime", hours, "label", *columns)


def stay_chart(t: Mapping[str, DataFrame], icustay_id: int, any_error: bool = False) -> DataFrame:
    """Charted rows of one stay with label and hours since admission.

    Rows must be marked as free of error; any_error=True takes all.
    """
    rows = t["chartevents"].filter(F.col("icustay_id") == icustay_id)
    rows = rows if any_error else rows.filter(F.col("error") != 1)
    return _timed(t["icustays"], rows, t["d_items"], ["value", "valuenum", "valueuom"])


def stay_outputs(t: Mapping[str, DataFrame], icustay_id: int) -> DataFrame:
    rows = t["outputevents"].filter(F.col("icustay_id") == icustay_id)
    return _timed(t["icustays"], rows, t["d_items"], ["value", "valueuom"])


def stay_labs(t: Mapping[str, DataFrame], icustay_id: int) -> DataFrame:
    """Lab rows of the stay's subject between its admission to and discharge from the unit."""
    stay = t["icustays"].filter(F.col("icustay_id") == icustay_id).select("subject_id", "icustay_id", "intime", "outtime")
    rows = windows.range_join(stay, t["labevents"].drop("hadm_id"), ["subject_id"], "charttime", "intime", "outtime")
    return _timed(stay, rows.drop("intime", "outtime"), t["d_labitems"], ["value", "valuenum", "valueuom"])


def first_days(df: DataFrame, days: int = 5) -> DataFrame:
    """Rows with at most `days` whole days since admission."""
    return df.filter(F.floor(F.col("icu_hours") / 24) <= days)


def observations_per_admission(chart: DataFrame) -> DataFrame:
    """Mean number of charted rows and of distinct items per admission."""
    per = chart.groupBy("hadm_id").agg(F.count("hadm_id").alias("obs"), F.count_distinct("itemid").alias("variable"))
    return per.agg(F.avg("obs").alias("avg_obs"), F.avg("variable").alias("avg_variable"))


def diagnosed(diagnoses: DataFrame, prefix: str) -> DataFrame:
    """Number of patients with a diagnosis code of this prefix."""
    return diagnoses.filter(F.col("icd9_code").startswith(prefix)).agg(F.count_distinct("subject_id").alias("patients"))


def diagnosis_ages(t: Mapping[str, DataFrame], prefix: str) -> DataFrame:
    """Age of each diagnosed patient at the first admission on record."""
    who = t["diagnoses_icd"].filter(F.col("icd9_code").startswith(prefix)).select("subject_id").distinct()
    first = t["admissions"].groupBy("subject_id").agg(F.min("admittime").alias("admittime"))
    known = who.join(first, "subject_id").join(t["patients"].select("subject_id", "dob"), "subject_id")
    return known.select("subject_id", fn.age_from_fields("dob", "admittime").alias("age"))


def diagnosis_age_bands(t: Mapping[str, DataFrame], prefix: str) -> DataFrame:
    return pivot.banded_counts(diagnosis_ages(t, prefix), "age", AGE_BANDS)


def first_lab(t: Mapping[str, DataFrame], label: str) -> DataFrame:
    """First value of a lab around admission per stay, with death in the unit and in hospital."""
    rule = [r for r in items.LABS if r.label == label]
    item, value = F.col("itemid"), F.col("valuenum")
    rows = t["labevents"].filter(item.isin(*items.codes(rule)) & (value > 0)).select(
        "subject_id", "hadm_id", "charttime", items.valid_value(item, value, rule).alias("value")
    )
    borders = t["icustays"].select(*STAY, fn.shift("intime", "-6 hours").alias("_from"), fn.shift("intime", "1 day").alias("_to"))
    near = windows.range_join(borders, rows, ["subject_id", "hadm_id"], "charttime", "_from", "_to")
    first = stats.first_measurement(near, ["icustay_id"], "charttime", "value", f"{label}_1st")
    visits = t["admissions"].select("hadm_id", "admittime", "dischtime", "deathtime")
    return (
        t["icustays"]
        .select(*STAY, "intime", "outtime")
        .join(visits, "hadm_id", "left")
        .join(first, "icustay_id", "left")
        .select(
            *STAY,
            windows.event_in_interval("deathtime", "intime", "outtime").alias("mort_icu"),
            windows.event_in_interval("deathtime", "admittime", "dischtime").alias("mort_hosp"),
            f"{label}_1st",
        )
    )


def heart_rate_series(t: Mapping[str, DataFrame], hadm_id: int, itemid: int = 211) -> DataFrame:
    """Hourly heart rate of one admission over all its stays, with lags and rolling statistics."""
    stays = t["icustays"].filter(F.col("hadm_id") == hadm_id).select("icustay_id")
    rows = t["chartevents"].filter(F.col("itemid") == itemid).join(stays, "icustay_id", "left_semi")
    distinct = rows.select("icustay_id", fn.hour_of("charttime").alias("timestamp"), "valuenum").dropDuplicates()
    hours = distinct.groupBy("timestamp").agg(F.avg("valuenum").alias("hr")).withColumn("hadm_id", F.lit(hadm_id))
    return series.with_history(hours, ["hr"], ["hadm_id"], ["timestamp"], lags=(1, 5)).drop("hadm_id")
