"""Cohort building: stays with demographics, outcomes, service and exclusion flags.

Frames use the clinical column names (see icuflow.sources.schema); other tables are renamed
on the way in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuflow.functions import scalar as fn
from icuflow.functions.items import SURGICAL_SERVICES, SURGICAL_SUFFIX
from icuflow.operators.ordered import latest_before, ranks
from icuflow.operators.stats import quantiles

EXCLUSIONS = ("exclusion_los", "exclusion_age", "exclusion_first_stay", "exclusion_surgical")


def stay_order(stays: DataFrame, out: str = "icustay_id_order") -> DataFrame:
    """Rank of each stay among its subject's stays by admission time; ties share a rank."""
    return ranks(stays, ["subject_id"], ["intime"], out)


def cohort_base(stays: DataFrame, patients: DataFrame, admissions: DataFrame) -> DataFrame:
    """Stays with demographics, lengths of stay, order and outcome flags (inner joins)."""
    person = patients.select("subject_id", "gender", "dob", "dod", "dod_hosp")
    visit = admissions.select("hadm_id", "admittime", "dischtime", "admission_type", "hospital_expire_flag")
    joined = stay_order(stays).join(person, "subject_id").join(visit, "hadm_id")
    return joined.select(
        "subject_id",
        "hadm_id",
        "icustay_id",
        "first_careunit",
        "admission_type",
        "gender",
        F.col("intime").alias("icu_intime"),
        F.col("los").alias("icu_los"),
        fn.length_of_stay("admittime", "dischtime").alias("hosp_los"),
        fn.age_years("dob", "intime").alias("age_icu_in"),
        "dod_hosp",
        "icustay_id_order",
        "hospital_expire_flag",
        fn.died_in_stay("dod", "intime", "outtime").alias("icu_expire_flag"),
        fn.died_within("dod", "admittime", "1 day").alias("hospital1day_expire_flag"),
        fn.died_within("dod", "admittime", "7 days").alias("hospital7day_expire_flag"),
        fn.died_within("dod", "admittime", "30 days").alias("hospital30day_expire_flag"),
        fn.died_within("dod", "admittime", "1 year").alias("hospital1year_expire_flag"),
    )


def latest_service(
    stays: DataFrame,
    services: DataFrame,
    per: str = "stay",
    grace: str = "12 hours",
) -> DataFrame:
    """(hadm_id, icustay_id, curr_service): the service in charge `grace` after admission.

    per='stay' takes the last transfer before each stay's cut-off; a stay without one has a
    NULL service. per='admission' ranks the transfers of all stays of an admission together,
    missing ones first: only the stays that saw the admission's last counted transfer keep a
    service, and any stay without a transfer hides the others' services.
    Equal transfer times give one row per service. No stay-transfer pairs are formed beyond
    the rows returned: an admission with one cut-off takes its last transfer by an aggregate,
    stays of admissions with several go through an as-of join.
    """
    cut = stays.select("hadm_id", "icustay_id", fn.shift("intime", grace).alias("_cut"))
    rows = services.select("hadm_id", "transfertime", "curr_service").filter("transfertime IS NOT NULL")
    bounds = cut.groupBy("hadm_id").agg(F.min("_cut").alias("_first_cut"), F.max("_cut").alias("_last_cut"))
    if per == "stay":
        several = bounds.filter("_first_cut < _last_cut").select("hadm_id")
        if several.isEmpty():
            return _service_at_cut(cut, rows, bounds)
        one = bounds.filter("_first_cut = _last_cut")
        alone = cut.join(several, "hadm_id", "left_anti")
        return _service_at_cut(alone, rows, one).unionByName(
            _service_by_stay(cut.join(several, "hadm_id", "left_semi"), rows.join(several, "hadm_id", "left_semi"))
        )
    moves = rows.distinct()
    seen = (
        rows.join(bounds, "hadm_id")
        .filter(F.col("transfertime") < F.col("_last_cut"))
        .groupBy("hadm_id")
        .agg(F.min("transfertime").alias("_earliest"), F.max("transfertime").alias("_at"))
    )
    facts = cut.join(bounds, "hadm_id").join(seen, "hadm_id", "left")
    bare = F.col("_earliest").isNull() | (F.col("_cut") <= F.col("_earliest"))
    hidden = F.col("_earliest").isNull() | (F.col("_first_cut") <= F.col("_earliest"))
    without = facts.filter(bare).select("hadm_id", "icustay_id", F.lit(None).cast("string").alias("curr_service"))
    serving = (
        facts.filter(~hidden & (F.col("_cut") > F.col("_at")))
        .select("hadm_id", "icustay_id", "_at")
        .join(moves.withColumnRenamed("transfertime", "_at"), ["hadm_id", "_at"])
        .select("hadm_id", "icustay_id", "curr_service")
    )
    return without.unionByName(serving)


def _service_at_cut(cut: DataFrame, rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Services of stays whose admission has one cut-off, `_last_cut` of its bounds."""
    last = (
        rows.join(bounds, "hadm_id")
        .filter(F.col("transfertime") < F.col("_last_cut"))
        .groupBy("hadm_id", "curr_service")
        .agg(F.max("transfertime").alias("_at"), F.max("_last_cut").alias("_last_cut"))
    )
    # An admission has a row for each of its services here.
    latest = last.withColumn("_latest", F.max("_at").over(Window.partitionBy("hadm_id"))).filter("_at = _latest").alias("l")
    on = (F.col("c.hadm_id") == F.col("l.hadm_id")) & fn.within("_cut", "_last_cut", "_last_cut")
    return cut.alias("c").join(latest, on, "left").select("c.hadm_id", "icustay_id", "curr_service")


def _service_by_stay(cut: DataFrame, rows: DataFrame) -> DataFrame:
    timed = latest_before(cut, rows, ["hadm_id"], "_cut", "transfertime", "_at")
    named = rows.distinct().withColumnRenamed("transfertime", "_at")
    return timed.join(named, ["hadm_id", "_at"], "left").select("hadm_id", "icustay_id", "curr_service")


def with_exclusions(
    co: DataFrame,
    service: DataFrame,
    min_los_days: float = 1,
    min_age: float = 16,
    surgical: Column | None = None,
) -> DataFrame:
    """The cohort with its four exclusion flags, one row per stay.

    The service side is left-joined by stay; of several services at one time the first by name counts.
    """
    surgical = fn.surgical("curr_service", SURGICAL_SUFFIX, SURGICAL_SERVICES) if surgical is None else surgical
    named = service.groupBy("icustay_id").agg(F.min("curr_service").alias("curr_service"))
    flagged = co.join(named, "icustay_id", "left")
    return flagged.withColumns(
        {
            "exclusion_los": fn.flag(F.col("icu_los") < min_los_days),
            "exclusion_age": fn.flag(F.col("age_icu_in") < min_age),
            "exclusion_first_stay": fn.flag(F.col("icustay_id_order") != 1),
            "exclusion_surgical": surgical,
        }
    )


def select_cohort(df: DataFrame, flags: Sequence[str] = EXCLUSIONS[:3]) -> DataFrame:
    """Rows with every listed exclusion flag at 0."""
    for f in flags:
        df = df.filter(F.col(f) == 0)
    return df


def exclusion_report(df: DataFrame, flags: Sequence[str] = EXCLUSIONS) -> DataFrame:
    """Count and percentage per flag and for the union of all flags, in one pass."""
    named = {**{f: F.col(f) for f in flags}, "any": F.greatest(*[F.col(f) for f in flags])}
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_{n}") for n, c in named.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("flag"), F.col(f"_{n}").alias("excluded")) for n in named])
    return wide.select(F.col("_n").alias("stays"), F.explode(pairs).alias("_p")).select(
        "_p.flag",
        "_p.excluded",
        "stays",
        F.round(F.col("_p.excluded") * 100 / F.col("stays"), 4).alias("percent"),
    )


def cohort_summary(
    df: DataFrame,
    distinct: Mapping[str, str],
    medians: Mapping[str, str],
    shares: Mapping[str, Column],
) -> DataFrame:
    """One row: distinct counts, exact medians and percentages of flags."""
    facts = df.agg(
        F.lit(0).alias("_k"),
        *[F.count_distinct(F.col(c)).alias(n) for n, c in distinct.items()],
        *[F.round(F.avg(c) * 100, 6).alias(n) for n, c in shares.items()],
    )
    result = facts
    for name, column in medians.items():
        result = result.withColumn(name, quantiles(df, column, {name: 0.5}).select(name).scalar())
    return result.drop("_k")
