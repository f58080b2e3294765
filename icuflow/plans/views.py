"""The first-day views, the hourly series and the feature tables over the clinical schema.

Each view is a function of source frames, so it can be used as is or stored with
`icuflow.sources.io.build_views` / `materialize_bucketed`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.functions import items, scalar as fn
from icuflow.operators import cohort, pivot, prep, score, series, windows

STAY = ["subject_id", "hadm_id", "icustay_id"]


def _clean(events: DataFrame) -> DataFrame:
    """Drop rows marked as error; unmarked (NULL) ones stay."""
    return events.filter(fn.distinct_from("error", 1))


def _chart_first_day(stays: DataFrame, chart: DataFrame, rules, columns: Sequence[str]) -> DataFrame:
    wanted = _clean(chart.filter(F.col("itemid").isin(*items.codes(rules)))).select(*STAY, "itemid", "charttime", *columns)
    return windows.events_in_window(
        stays.select(*STAY, "intime"), wanted, STAY[2:], "charttime", F.col("s.intime"), fn.shift("s.intime", "1 day"), agreeing=STAY[:2]
    )


def _labelled_vitals(stays: DataFrame, chart: DataFrame, rules) -> DataFrame:
    rows = _chart_first_day(stays, chart, rules, ["valuenum"])
    item, value = F.col("itemid"), F.col("valuenum")
    return rows.select(
        *STAY,
        "charttime",
        items.valid_label(item, value, rules).alias("label"),
        items.convert(item, value, rules).alias("value"),
    )


def vitals_first_day(stays: DataFrame, chart: DataFrame) -> DataFrame:
    """min/max/mean of eight vital signs in the first day; stays without any are absent."""
    rows = _labelled_vitals(stays, chart, items.VITALS)
    return pivot.pivot_stats(rows, STAY, "label", "value", items.labels(items.VITALS))


def _labs_around_admission(stays: DataFrame, labs: DataFrame) -> DataFrame:
    """Lab rows from 6 h before to 1 day after admission; labs carry no stay id.

    A lab row of an admission with one stay meets that stay alone; where stays share an admission, only rows near in time meet.
    """
    borders = stays.select(
        *STAY, fn.shift("intime", "-6 hours").alias("_from"), fn.shift("intime", "1 day").alias("_to")
    )
    shared = stays.groupBy("hadm_id").count().filter("count > 1 AND hadm_id IS NOT NULL").select("hadm_id")

    def near(of: DataFrame, rows: DataFrame) -> DataFrame:
        return windows.range_join(of, rows, ["subject_id", "hadm_id"], "charttime", "_from", "_to")

    def own(of: DataFrame) -> DataFrame:
        return windows.events_in_window(of, labs, ["hadm_id"], "charttime", F.col("s._from"), F.col("s._to"), agreeing=["subject_id"])

    if shared.isEmpty():
        rows = own(borders)
    else:
        among = [x.join(shared, "hadm_id", "left_semi") for x in (borders, labs)]
        rows = own(borders.join(shared, "hadm_id", "left_anti")).unionByName(near(*among))
    return rows.drop("_from", "_to")


def labs_first_day(stays: DataFrame, labs: DataFrame, rules=items.LABS) -> DataFrame:
    """min/max of the lab values around admission; every stay has a row."""
    item, value = F.col("itemid"), F.col("valuenum")
    wanted = labs.filter(item.isin(*items.codes(rules)) & (value > 0)).select(
        "subject_id",
        "hadm_id",
        "charttime",
        items.fuse(item, rules).alias("label"),
        items.valid_value(item, value, rules).alias("value"),
    )
    wide = pivot.pivot_stats(
        _labs_around_admission(stays, wanted), STAY, "label", "value", items.labels(rules), ("min", "max")
    )
    return stays.select(*STAY).join(wide.drop("subject_id", "hadm_id"), "icustay_id", "left")


def blood_gas_first_day(stays: DataFrame, labs: DataFrame) -> DataFrame:
    """Greatest value of 28 blood gas labels per stay and time; the specimen is text.

    Non-positive numbers count as missing. A stay without blood gas has one empty row.
    """
    item, value = F.col("itemid"), F.col("valuenum")
    fetched = [*items.codes(items.BLOOD_GAS), *items.BLOOD_GAS_UNLABELLED]
    wanted = labs.filter(item.isin(*fetched)).select(
        "subject_id",
        "hadm_id",
        "charttime",
        items.fuse(item, items.BLOOD_GAS).alias("label"),
        "value",
        items.valid_value(item, value, items.BLOOD_GAS).alias("number"),
    )
    sources = {name: "value" if name == "specimen" else "number" for name in items.labels(items.BLOOD_GAS)}
    wide = pivot.pivot_max(_labs_around_admission(stays, wanted), [*STAY, "charttime"], "label", sources)
    return stays.select(*STAY).join(wide.drop("subject_id", "hadm_id"), "icustay_id", "left")


def _gcs_components(stays: DataFrame, chart: DataFrame, clean: bool) -> DataFrame:
    wanted = chart.filter(F.col("itemid").isin(*items.codes(items.GCS)))
    wanted = _clean(wanted) if clean else wanted
    number = fn.sentinel("itemid", "value", "valuenum", items.GCS_SENTINELS) if clean else F.col("valuenum")
    slim = wanted.select(
        "icustay_id", "charttime", items.fuse(F.col("itemid"), items.GCS).alias("label"), number.alias("number")
    )
    rows = windows.events_in_window(
        stays.select("icustay_id", "intime"), slim, ["icustay_id"], "charttime", F.col("s.intime"), fn.shift("s.intime", "1 day")
    )
    return pivot.pivot_max(rows, ["icustay_id", "charttime"], "label", dict.fromkeys(items.GCS_NORMAL, "number"))


def gcs_first_day(stays: DataFrame, chart: DataFrame) -> DataFrame:
    """Lowest coma score of the first day with carry-forward, and its components.

    Equal lowest scores: the earliest row. Stays without a score have NULLs.
    """
    parts = _gcs_components(stays, chart, clean=True)
    scored = score.carry_forward(
        parts, ["icustay_id"], "charttime", items.GCS_NORMAL, "gcsverbal", items.GCS_FULL, out="mingcs", bounded=True
    )
    shown = {p: F.coalesce(p, f"{p}_prev") for p in items.GCS_NORMAL}
    flagged = scored.withColumn("endotrachflag", fn.flag(F.col("gcsverbal") == 0)).withColumns(shown)
    lowest = score.lowest(
        flagged, ["icustay_id"], ["mingcs", "charttime"], ["mingcs", "gcsmotor", "gcsverbal", "gcseyes", "endotrachflag"]
    )
    return stays.select(*STAY).join(lowest, "icustay_id", "left")


def gcs_plain(stays: DataFrame, chart: DataFrame) -> DataFrame:
    """Lowest and highest plain component sum of the first day; every stay has a row."""
    parts = _gcs_components(stays, chart, clean=False)
    summed = score.component_sum(parts, ["icustay_id"], list(items.GCS_NORMAL), "gcs")
    return stays.select(*STAY).join(summed, "icustay_id", "left")


def urine_output_first_day(stays: DataFrame, outputs: DataFrame) -> DataFrame:
    """Urine volume of the first day, irrigant counted negative; stays without any are absent."""
    wanted = outputs.filter(F.col("itemid").isin(*items.URINE_OUTPUT)).select(*STAY, "itemid", "charttime", "value")
    rows = windows.events_in_window(
        stays.select(*STAY, "intime"), wanted, STAY[2:], "charttime", F.col("s.intime"), fn.shift("s.intime", "1 day"), agreeing=STAY[:2]
    )
    return pivot.signed_sum(rows, STAY, F.col("itemid") == items.URINE_IRRIGANT, "value", "urineoutput")


def ventilation_first_day(stays: DataFrame, episodes: DataFrame) -> DataFrame:
    """1 if a ventilation episode covers the admission or starts in the first day."""
    flagged = windows.overlap_flag(
        stays.select(*STAY, "intime"), episodes, "icustay_id", "icustay_id", "intime", "starttime", "endtime", out="vent"
    )
    return flagged.select(*STAY, "vent")


def vitals_timeseries(stays: DataFrame, chart: DataFrame, scope: str = "stay") -> DataFrame:
    """Hourly means of seven vital signs with lags and rolling statistics."""
    rules = [r for r in items.VITALS if r.label != "glucose"]
    names = items.labels(rules)
    hourly = series.hourly(_labelled_vitals(stays, chart, rules), STAY, "charttime", "label", "value", names)
    hourly = hourly.withColumnRenamed("heartrate", "hr")
    names = ["hr" if n == "heartrate" else n for n in names]
    return series.with_history(hourly, names, ["icustay_id"], ["subject_id", "timestamp"], scope=scope)


def vitals_timestamped(stays: DataFrame, chart: DataFrame) -> DataFrame:
    """Distinct charted rows with each value in its vital sign's column, not truncated to hours."""
    rules = [r for r in items.VITALS if r.label != "glucose"]
    return series.wide_rows(
        _labelled_vitals(stays, chart, rules), [*STAY, "charttime"], "label", "value", items.labels(rules)
    )


BASIC_VITALS = ("heartrate", "meanbp", "resprate")
BASIC_LABS = ("bilirubin", "creatinine", "hemoglobin", "sodium", "wbc")


def admission_vitals(
    admissions: DataFrame, stays: DataFrame, chart: DataFrame, first_day: bool = False, labels: Sequence[str] = BASIC_VITALS
) -> DataFrame:
    """min/max per admission of vital signs as charted: no validity check, errors included.

    Covers the whole admission; first_day=True keeps only the first day of each stay, which
    is what the name "first day vitals" promises. Admissions without any have a row of NULLs.
    """
    rules = [r for r in items.VITALS if r.label in labels]
    rows = chart.filter(F.col("itemid").isin(*items.codes(rules))).select(
        "hadm_id", "icustay_id", "charttime", items.fuse(F.col("itemid"), rules).alias("label"), "valuenum"
    )
    if first_day:
        rows = windows.events_in_window(
            stays.select("icustay_id", "intime"), rows, ["icustay_id"], "charttime", F.col("s.intime"), fn.shift("s.intime", "1 day")
        )
    wide = pivot.pivot_stats(rows, ["hadm_id"], "label", "valuenum", list(labels), ("min", "max"))
    return admissions.select("hadm_id").join(wide, "hadm_id", "left")


def cohort_table(t: Mapping[str, DataFrame], per: str = "stay", min_los_days: float = 1) -> DataFrame:
    """Cohort with outcome and exclusion flags from the source tables."""
    base = cohort.cohort_base(t["icustays"], t["patients"], t["admissions"])
    service = cohort.latest_service(t["icustays"], t["services"], per)
    return cohort.with_exclusions(base, service, min_los_days)


def assemble(base: DataFrame, views: Sequence[DataFrame], key: str = "icustay_id") -> DataFrame:
    """Left-join per-stay views to the base on the stay; shared columns come from the base."""
    table = base
    for view in views:
        fresh = [c for c in view.columns if c == key or c not in table.columns]
        table = table.join(view.select(*fresh), key, "left")
    return table


def feature_table(t: Mapping[str, DataFrame], views: Mapping[str, DataFrame] | None = None, per: str = "stay") -> DataFrame:
    """The wide per-stay table: vitals, labs, coma score, urine, ventilation, cohort columns.

    `views` are the stored views if they have been built; else they are computed in place.
    Glucose is taken from the labs.
    """
    stays = t["icustays"]
    views = views or {
        "vitals": vitals_first_day(stays, t["chartevents"]),
        "labs": labs_first_day(stays, t["labevents"]),
        "gcs": gcs_first_day(stays, t["chartevents"]),
        "urine": urine_output_first_day(stays, t["outputevents"]),
        "vent": ventilation_first_day(stays, t["ventdurations"]),
    }
    vitals = views["vitals"].drop("glucose_min", "glucose_max", "glucose_mean")
    cohort_columns = cohort_table(t, per).drop("curr_service", "icu_intime", "dod_hosp")
    return assemble(
        vitals,
        [views["labs"], views["gcs"], views["urine"], views["vent"], cohort_columns, t["heightweight"]],
    )


def basic_feature_table(t: Mapping[str, DataFrame]) -> DataFrame:
    """The small per-stay table: vitals, plain coma score, five labs without caps, cohort columns.

    Every stay with a patient and an admission has a row.
    """
    stays = t["icustays"]
    uncapped = tuple(items.Rule(r.label, r.items, 0) for r in items.LABS if r.label in BASIC_LABS)
    vitals = vitals_first_day(stays, t["chartevents"]).drop("glucose_min", "glucose_max", "glucose_mean")
    people = cohort.cohort_base(stays, t["patients"], t["admissions"])
    return assemble(
        people.drop("icu_intime", "dod_hosp", "admission_type"),
        [vitals, gcs_plain(stays, t["chartevents"]), labs_first_day(stays, t["labevents"], uncapped)],
    )


def cohort_with_admission_vitals(t: Mapping[str, DataFrame], min_los_days: float = 2) -> DataFrame:
    """Selected cohort with the vitals of its admission, joined on the admission.

    The selection keeps first stays, so each cohort row meets the rows of one admission.
    """
    chosen = cohort.select_cohort(cohort_table(t, min_los_days=min_los_days))
    return chosen.join(admission_vitals(t["admissions"], t["icustays"], t["chartevents"]), "hadm_id", "left")


def cohort_with_stay_vitals(t: Mapping[str, DataFrame], min_los_days: float = 1) -> DataFrame:
    """Selected cohort with first-day vitals joined on the admission instead of the stay.

    A cohort row repeats for every stay of its admission that has vitals.
    """
    chosen = cohort.select_cohort(cohort_table(t, min_los_days=min_los_days))
    vitals = vitals_first_day(t["icustays"], t["chartevents"]).drop("subject_id", "icustay_id")
    return chosen.join(vitals, "hadm_id", "left")


def model_frame(
    table: DataFrame,
    features: Sequence[str],
    outcomes: Sequence[str],
    nominal: Sequence[str] = ("gender", "first_careunit", "admission_type"),
    impute: str = "features",
    key: str = "icustay_id",
) -> DataFrame:
    """From a feature table to numbers: codes for categories, cohort filter, age cap, imputation.

    impute='features' leaves the outcomes alone; 'all' fills them with their mean too.
    """
    for name in nominal:
        table = fn.category_codes(table, name)
    kept = cohort.select_cohort(table).withColumn("age_icu_in", fn.cap_age("age_icu_in"))
    numbers = [*features, *outcomes]
    rows = kept.select(key, *[F.col(c).cast("double").alias(c) for c in numbers])
    return prep.mean_impute(rows, numbers if impute == "all" else features)


def timeseries_table(t: Mapping[str, DataFrame], per: str = "stay", scope: str = "stay") -> DataFrame:
    """Hourly series with demographics and outcome labels relative to each hour.

    `icu_elapsed_years` is the time since admission; `icu_los` the length of the stay in days.
    """
    hours = vitals_timeseries(t["icustays"], t["chartevents"], scope)
    table = assemble(hours, [cohort_table(t, per), t["heightweight"]])
    return table.withColumns(
        {
            "icu_elapsed_years": fn.age_years("icu_intime", "timestamp"),
            **fn.horizon_labels("timestamp", "dod_hosp"),
        }
    )
