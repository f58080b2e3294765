"""Pinned semantics of the clinical views, one small fixture each."""

from datetime import timedelta

import pytest
from conftest import at
from pyspark.sql import functions as F

from icuflow.functions import items, scalar as fn
from icuflow.operators import cohort, pivot, prep, score, series, windows
from icuflow.plans import reports, views


def by(df, key, *columns):
    rows = df.collect()
    return {r[key]: (r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns)) for r in rows}


# --- item dictionaries -------------------------------------------------------------------


def edges(rule):
    step = 0.5
    cases = []
    if rule.lo is not None:
        cases += [(rule.lo - step, False), (rule.lo, rule.lo_closed), (rule.lo + step, True)]
    if rule.hi is not None:
        cases += [(rule.hi - step, True), (rule.hi, rule.hi_closed), (rule.hi + step, False)]
    return cases


@pytest.mark.parametrize("rules", [items.VITALS, items.LABS, items.BLOOD_GAS], ids=["vitals", "labs", "gas"])
def test_every_bound_of_the_dictionary(spark, rules):
    cases = [(i, float(v), r.label if ok else None) for r in rules for i in r.items for v, ok in edges(r)]
    frame = spark.createDataFrame(cases, "item int, v double, expected string")
    got = frame.withColumn("label", items.valid_label(F.col("item"), F.col("v"), rules))
    assert got.filter(~F.col("label").eqNullSafe(F.col("expected"))).count() == 0
    kept = frame.withColumn("kept", items.valid_value(F.col("item"), F.col("v"), rules))
    assert kept.filter(F.col("kept").isNotNull() != F.col("expected").isNotNull()).count() == 0


def test_named_edges(spark, stay, chart):
    got = views.vitals_first_day(
        stay((1, 0), (2, 0)),
        chart((1, 646, 1, 100.0), (1, 211, 1, 300.0), (1, 220045, 2, 299.5), (2, 211, 1, 0.0)),
    )
    assert by(got, "icustay_id", "spo2_max", "heartrate_max") == {1: (100.0, 299.5), 2: (None, None)}


def test_temperature_units(stay, chart):
    got = views.vitals_first_day(
        stay((1, 0), (2, 0), (3, 0), (4, 0)),
        chart((1, 678, 1, 98.6), (2, 676, 1, 37.0), (3, 678, 1, 60.0), (4, 676, 1, 9.0)),
    )
    means = by(got, "icustay_id", "tempc_mean")
    assert means[1] == pytest.approx(37.0) and means[2] == 37.0 and means[3] is None and means[4] is None


def test_error_marks(spark, stay, chart):
    events = chart((1, 211, 1, 60.0, None, None), (1, 211, 2, 70.0, None, 0), (1, 211, 3, 200.0, None, 1))
    assert events.filter(fn.distinct_from("error", 1)).count() == 2
    assert events.filter(F.col("error") != 1).count() == 1
    assert by(views.vitals_first_day(stay((1, 0)), events), "icustay_id", "heartrate_max") == {1: 70.0}


def test_first_day_is_closed_on_both_ends(stay, chart):
    events = chart((1, 211, -0.001, 10.0), (1, 211, 0, 20.0), (1, 211, 24, 30.0), (1, 211, 24.001, 40.0))
    got = views.vitals_first_day(stay((1, 0)), events)
    assert by(got, "icustay_id", "heartrate_min", "heartrate_max", "heartrate_mean") == {1: (20.0, 30.0, 25.0)}


def test_stays_without_events(stay, chart, lab):
    stays = stay((1, 0), (2, 0))
    assert by(views.vitals_first_day(stays, chart((1, 211, 1, 60.0))), "icustay_id", "heartrate_max") == {1: 60.0}
    assert by(views.labs_first_day(stays, lab((1, 50885, 1, 2.0))), "icustay_id", "bilirubin_max") == {1: 2.0, 2: None}


def test_labs_reach_back_six_hours_and_serve_every_stay_of_the_admission(stay, lab):
    stays = stay((1, 0, 9, 9), (2, 30, 9, 9))
    labs = lab((9, 50912, -6, 1.0), (9, 50912, -6.001, 9.0), (9, 50912, 24, 2.0), (9, 50912, 25, 3.0), (9, 50912, 1, -1.0))
    got = by(views.labs_first_day(stays, labs), "icustay_id", "creatinine_min", "creatinine_max")
    assert got == {1: (1.0, 2.0), 2: (2.0, 3.0)}


def test_fused_labs_and_caps(stay, lab):
    labs = lab((1, 50811, 1, 10.0), (1, 51222, 2, 12.0), (1, 51222, 3, 50.5))
    got = views.labs_first_day(stay((1, 0)), labs)
    assert by(got, "icustay_id", "hemoglobin_min", "hemoglobin_max") == {1: (10.0, 12.0)}


def test_blood_gas_rows(stay, lab):
    labs = lab(
        (1, 50800, 1, None, "ART"),
        (1, 50802, 1, -3.0),
        (1, 50820, 1, 7.4),
        (1, 50807, 2, 5.0),
        (1, 50816, 1, 100.5),
    )
    rows = {r["charttime"]: r for r in views.blood_gas_first_day(stay((1, 0)), labs).collect()}
    first, second = rows[at(1)], rows[at(2)]
    assert (first["specimen"], first["baseexcess"], first["ph"], first["fio2"]) == ("ART", None, 7.4, None)
    values = {k: v for k, v in second.asDict().items() if k not in (*views.STAY, "charttime")}
    assert set(values.values()) == {None}
    assert views.blood_gas_first_day(stay((5, 0)), labs).first()["charttime"] is None


def test_urine_counts_irrigant_negative(table, stay):
    def row(item, hour, value):
        return {"subject_id": 1, "hadm_id": 1, "icustay_id": 1, "itemid": item, "charttime": at(hour), "value": value}

    outputs = table("outputevents", row(40055, 1, 300.0), row(227488, 2, 100.0), row(40055, 25, 50.0), row(1, 2, 9.0))
    got = views.urine_output_first_day(stay((1, 0), (2, 0)), outputs)
    assert by(got, "icustay_id", "urineoutput") == {1: 200.0}


def test_ventilation_overlap(table, stay):
    spans = {1: (-5, -1), 2: (-5, 1), 3: (2, 3), 4: (24, 30), 5: (24.001, 30), 6: (-1, 0)}
    episodes = table("ventdurations", *[{"icustay_id": i, "starttime": at(a), "endtime": at(b)} for i, (a, b) in spans.items()])
    got = views.ventilation_first_day(stay(*[(i, 0) for i in range(1, 8)]), episodes)
    assert by(got, "icustay_id", "vent") == {1: 0, 2: 1, 3: 1, 4: 1, 5: 0, 6: 1, 7: 0}


# --- scores ------------------------------------------------------------------------------------


MOTOR, VERBAL, EYES = 454, 723, 184


def test_carry_forward_rules(stay, chart):
    full = [(MOTOR, 3.0), (VERBAL, 2.0), (EYES, 1.0)]
    tube = "1.0 ET/Trach"
    events = []
    # 1: previous row 5 h 59 min ago fills the missing parts; 2: exactly 6 h ago does not; 3: 7 h ago does not.
    for who, gap in ((1, 5 + 59 / 60), (2, 6), (3, 7)):
        events += [(who, item, 1, value) for item, value in full]
        events.append((who, MOTOR, 1 + gap, 5.0))
    # 4: tube now; 5: tube before and verbal missing now; 6: tube before, verbal back: nothing carried.
    events += [(4, VERBAL, 1, 1.0, tube), (4, MOTOR, 1, 1.0)]
    events += [(5, VERBAL, 1, 1.0, tube), (5, MOTOR, 2, 4.0)]
    events += [(6, VERBAL, 1, 1.0, tube), (6, MOTOR, 1, 1.0), (6, VERBAL, 2, 4.0)]
    stays = stay(*[(i, 0) for i in range(1, 8)])
    parts = views._gcs_components(stays, chart(*events), clean=True)
    scored = score.carry_forward(parts, ["icustay_id"], "charttime", items.GCS_NORMAL, "gcsverbal", 15)
    last = {r["icustay_id"]: r["score"] for r in scored.orderBy("charttime").collect()}
    assert last == {1: 5 + 2 + 1, 2: 5 + 5 + 4, 3: 5 + 5 + 4, 4: 15, 5: 15, 6: 6 + 4 + 4}
    shown = by(views.gcs_first_day(stays, chart(*events)), "icustay_id", "mingcs", "endotrachflag")
    assert shown[1] == (6, 0) and shown[4] == (15, 1) and shown[6] == (14, 0) and shown[7] == (None, None)


def test_plain_sum_is_unknown_when_a_part_is_missing(stay, chart):
    events = chart((1, MOTOR, 1, 6.0), (1, VERBAL, 1, 5.0), (2, MOTOR, 1, 6.0), (2, VERBAL, 1, 5.0), (2, EYES, 1, 4.0), (2, EYES, 2, 1.0))
    got = views.gcs_plain(stay((1, 0), (2, 0), (3, 0)), events)
    assert by(got, "icustay_id", "gcs_min", "gcs_max") == {1: (None, None), 2: (15.0, 15.0), 3: (None, None)}


# --- series ---------------------------------------------------------------------------------------


def test_hour_means_use_distinct_values(stay, chart):
    events = chart((1, 211, 0.1, 80.0), (1, 211, 0.2, 80.0), (1, 211, 0.3, 100.0))
    got = views.vitals_timeseries(stay((1, 0)), events).first()
    assert got["hr"] == 90.0
    labelled = views._labelled_vitals(stay((1, 0)), events, items.VITALS)
    plain = series.hourly(labelled, ["icustay_id"], "charttime", "label", "value", ["heartrate"], distinct=False).first()
    assert plain["heartrate"] == pytest.approx(260 / 3)


def test_an_hour_with_only_invalid_readings_stays(stay, chart):
    got = views.vitals_timeseries(stay((1, 0)), chart((1, 211, 0, 80.0), (1, 211, 1, 999.0), (1, 211, 2, 90.0)))
    rows = {r["timestamp"]: r for r in got.collect()}
    assert rows[at(1)]["hr"] is None
    assert rows[at(2)]["hr_1h"] is None and rows[at(2)]["hr_2h"] == 80.0
    assert rows[at(2)]["hr_mean_6h"] == 85.0 and rows[at(2)]["hr_median_6h"] == 85.0


def test_lags_count_observed_hours_and_frames_hold_seven_rows(spark):
    hours = [(1, at(h), float(h)) for h in (0, 1, 5, 6, 7, 8, 9, 10, 14)]
    frame = spark.createDataFrame(hours, "stay int, hour timestamp_ntz, v double")
    rows = {r["hour"]: r for r in series.with_history(frame, ["v"], ["stay"], ["hour"]).collect()}
    assert rows[at(5)]["v_1h"] == 1.0
    assert rows[at(14)]["v_min_6h"] == 5.0 and rows[at(14)]["v_max_6h"] == 14.0
    assert rows[at(14)]["v_median_6h"] == 8.0


@pytest.mark.parametrize("scope, expected", [("stay", None), ("global", 2.0)])
def test_stay_border(spark, scope, expected):
    rows = [(1, at(0), 1.0), (1, at(1), 2.0), (2, at(0), 3.0), (2, at(1), 4.0)]
    frame = spark.createDataFrame(rows, "stay int, hour timestamp_ntz, v double")
    got = series.with_history(frame, ["v"], ["stay"], ["hour"], scope=scope)
    assert got.filter((F.col("stay") == 2) & (F.col("hour") == F.lit(at(0)).cast("timestamp_ntz"))).first()["v_1h"] == expected


def test_time_stamped_rows(stay, chart):
    got = views.vitals_timestamped(stay((1, 0)), chart((1, 211, 0.5, 80.0), (1, 211, 0.5, 80.0), (1, 646, 0.5, 99.0)))
    assert sorted((r["heartrate"] or 0, r["spo2"] or 0) for r in got.collect()) == [(0, 99.0), (80.0, 0)]


# --- cohort ------------------------------------------------------------------------------------------


@pytest.fixture
def people(table):
    def make(*rows):
        return table("patients", *[{"subject_id": s, "gender": "F", "dob": born, "dod": died, "dod_hosp": died} for s, born, died in rows])

    return make


@pytest.fixture
def visits(table):
    def make(*rows):
        return table(
            "admissions",
            *[
                {"subject_id": s, "hadm_id": h, "admittime": at(a), "dischtime": at(b), "admission_type": "EMERGENCY", "hospital_expire_flag": 0}
                for s, h, a, b in rows
            ],
        )

    return make


def moved(table, *rows):
    return table("services", *[{"hadm_id": h, "transfertime": at(t), "curr_service": s} for h, t, s in rows])


def services(df):
    return {(r["icustay_id"], r["curr_service"]) for r in df.collect()}


def test_service_ranks_missing_first(table, stay):
    stays = stay((1, 0), (2, 0))
    moves = moved(table, (1, 20, "MED"), (2, 1, "MED"), (2, 5, "CSURG"), (2, 12, "ORTHO"))
    for per in ("stay", "admission"):
        assert services(cohort.latest_service(stays, moves, per)) == {(1, None), (2, "CSURG")}


def test_two_stays_in_one_admission(table, stay):
    stays = stay((1, 0, 9, 9), (2, 48, 9, 9))
    moves = moved(table, (9, -5, "MED"), (9, 1, "TSURG"), (9, 30, "NMED"))
    assert services(cohort.latest_service(stays, moves, "stay")) == {(1, "TSURG"), (2, "NMED")}
    assert services(cohort.latest_service(stays, moves, "admission")) == {(2, "NMED")}
    late = moved(table, (9, 30, "NMED"))
    assert services(cohort.latest_service(stays, late, "admission")) == {(1, None)}


def test_equal_transfer_times_keep_both(table, stay):
    moves = moved(table, (1, 1, "MED"), (1, 1, "SURG"))
    for per in ("stay", "admission"):
        assert services(cohort.latest_service(stay((1, 0)), moves, per)) == {(1, "MED"), (1, "SURG")}


def test_tied_stays_are_both_first(stay):
    got = cohort.stay_order(stay((1, 0, 7, 1), (2, 0, 7, 2), (3, 5, 7, 3)))
    assert by(got, "icustay_id", "icustay_id_order") == {1: 1, 2: 1, 3: 3}


def test_cohort_flags(table, stay, people, visits):
    second = timedelta(seconds=1)
    out = at(72)
    stays = stay((1, 0), (2, 0), (3, 0), (4, 0))
    born = at(days=-365.242 * 50)
    patients = people(
        (1, born, out + timedelta(hours=6)), (2, born, out + timedelta(hours=6) + second), (3, born, None), (4, at(days=-365.242 * 10), at(days=30))
    )
    got = cohort.cohort_base(stays, patients, visits(*[(i, i, 0, 36) for i in (1, 2, 3, 4)]))
    assert by(got, "icustay_id", "icu_expire_flag") == {1: 1, 2: 0, 3: 0, 4: 0}
    assert by(got, "icustay_id", "hospital30day_expire_flag") == {1: 1, 2: 1, 3: 0, 4: 0}
    assert by(got, "icustay_id", "hosp_los")[1] == 1.5
    assert by(got, "icustay_id", "age_icu_in")[1] == pytest.approx(50.0)
    service = cohort.latest_service(stays, moved(table, (1, 1, "VSURG"), (2, 1, "ORTHO"), (3, 1, "MED")))
    flagged = cohort.with_exclusions(got, service, min_los_days=4)
    assert by(flagged, "icustay_id", *cohort.EXCLUSIONS) == {1: (1, 0, 0, 1), 2: (1, 0, 0, 1), 3: (1, 0, 0, 0), 4: (1, 1, 0, 0)}
    report = by(cohort.exclusion_report(flagged), "flag", "excluded", "percent")
    assert report["any"] == (4, 100.0) and report["exclusion_surgical"] == (2, 50.0)
    assert cohort.select_cohort(cohort.with_exclusions(got, service, 1)).count() == 3


def test_horizon_labels_are_inclusive(spark):
    rows = [(1, at(0), at(0)), (2, at(0), at(days=1)), (3, at(0), at(days=7.01)), (4, at(0), None)]
    frame = spark.createDataFrame(rows, "id int, ts timestamp_ntz, death timestamp_ntz").withColumns(fn.horizon_labels("ts", "death"))
    got = by(frame, "id", "dead", "dead_in_1d", "dead_in_7d", "dead_in_30d")
    assert got == {1: (1, 1, 1, 1), 2: (0, 1, 1, 1), 3: (0, 0, 0, 1), 4: (0, 0, 0, 0)}


def test_leap_year_and_old_age(spark):
    one = spark.sql("SELECT TIMESTAMP_NTZ '2024-02-29 00:00:00' AS t").select(fn.shift("t", "1 year").alias("t")).first()["t"]
    assert (one.year, one.month, one.day) == (2025, 2, 28)
    ages = spark.createDataFrame([(89.0,), (89.1,), (300.0,), (None,)], "age double").select(fn.cap_age("age").alias("a")).collect()
    assert [r["a"] for r in ages] == [89.0, 91.6, 91.6, None]


def test_category_codes(spark):
    rows = spark.createDataFrame([("B",), ("A",), (None,)], "c string").withColumn("raw", F.col("c"))
    assert by(fn.category_codes(rows, "c"), "raw", "c") == {"B": 1, "A": 0, None: -1}


def test_drop_after_event(spark):
    rows = spark.createDataFrame([(1, at(0), at(1)), (2, at(1), at(1)), (3, at(2), at(1)), (4, at(9), None)], "id int, ts timestamp_ntz, e timestamp_ntz")
    assert {r["id"] for r in fn.drop_after(rows, "ts", "e").collect()} == {1, 2, 4}


# --- joins -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bucket", [1800, 86_400])
def test_range_join_with_a_hot_key_meets_each_pair_once(spark, bucket):
    spans = [(i, 0 if i % 3 == 0 else i, at(i * 0.5), at(i * 0.5 + 5)) for i in range(60)]
    events = [(i, 0 if i % 3 == 0 else i % 60, at(i * 0.25)) for i in range(200)]
    w = spark.createDataFrame(spans, "w int, key int, a timestamp_ntz, b timestamp_ntz")
    e = spark.createDataFrame(events, "e int, key int, t timestamp_ntz")
    got = sorted((r["w"], r["e"]) for r in windows.range_join(w, e, ["key"], "t", "a", "b", bucket).collect())
    assert got == sorted((i, j) for i, k, a, b in spans for j, m, t in events if k == m and a <= t <= b)


def test_range_join_has_no_cross_join(spark):
    w = spark.range(5).select(F.col("id").alias("key"), F.current_timestamp().alias("a"), F.current_timestamp().alias("b"))
    e = spark.range(5).select(F.col("id").alias("key"), F.current_timestamp().alias("t"))
    plan = windows.range_join(w, e, ["key"], "t", "a", "b")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pivot_statistics(spark):
    rows = [(i % 7, f"l{i % 4}", float(i)) for i in range(200)]
    got = pivot.pivot_stats(spark.createDataFrame(rows, "k int, label string, v double"), ["k"], "label", "v", ["l0", "l3", "l9"])
    for r in got.collect():
        for name in ("l0", "l3"):
            own = [v for k, x, v in rows if (k, x) == (r["k"], name)]
            assert (r[f"{name}_min"], r[f"{name}_max"], r[f"{name}_mean"]) == (min(own), max(own), sum(own) / len(own))
        assert r["l9_min"] is None


def test_missing_order_values_come_last(spark):
    frame = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 3, "c"), (2, None, "d")], "k int, t int, x string")
    assert sorted((r["k"], r["x"]) for r in windows.first_events(frame, ["k"], ["t"]).collect()) == [(1, "c"), (2, "d")]
    assert sorted((r["k"], r["x"]) for r in score.lowest(frame, ["k"], ["t"], ["x"]).collect()) == [(1, "c"), (2, "d")]


def test_untimed_rows_are_split_last(spark):
    times = [f"2020-01-01 0{i}:00:00" if i < 6 else None for i in range(10)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    for fraction, train in ((0.5, 5), (0.7, 7)):
        got = {r["id"]: r["split"] for r in prep.ordered_split(frame, "t", "id", fraction).collect()}
        assert got == {i: "train" if i < train else "test" for i in range(10)}


# --- assembly ----------------------------------------------------------------------------------------------


@pytest.fixture
def clinic(table, stay, chart, lab, people, visits):
    stays = stay((1, 0), (2, 0))
    chartevents = chart((1, 211, 1, 80.0), (1, 211, 2, 90.0), (2, 211, 1, 60.0), (1, MOTOR, 1, 6.0), (1, VERBAL, 1, 5.0), (1, EYES, 1, 4.0))
    out = {"subject_id": 1, "hadm_id": 1, "icustay_id": 1, "itemid": 40055, "charttime": at(1), "value": 300.0}
    return {
        "icustays": stays,
        "chartevents": chartevents,
        "labevents": lab((1, 50912, 1, 1.0)),
        "outputevents": table("outputevents", out),
        "ventdurations": table("ventdurations", {"icustay_id": 2, "starttime": at(1), "endtime": at(2)}),
        "patients": people((1, at(days=-20000), at(3)), (2, at(days=-20000), None)),
        "admissions": visits((1, 1, 0, 24), (2, 2, 0, 24)),
        "services": moved(table, (1, 1, "MED")),
        "heightweight": table("heightweight", {"icustay_id": 1, "height_first": 170.0, "weight_first": 70.0}),
    }


def test_feature_table(clinic):
    got = views.feature_table(clinic)
    assert len(got.columns) == len(set(got.columns))
    rows = {r["icustay_id"]: r for r in got.collect()}
    assert set(rows) == {1, 2}
    one = rows[1]
    assert (one["heartrate_mean"], one["creatinine_max"], one["mingcs"], one["urineoutput"], one["vent"]) == (85.0, 1.0, 15, 300.0, 0)
    assert (one["weight_first"], one["icu_expire_flag"], rows[2]["vent"], rows[2]["urineoutput"]) == (70.0, 1, 1, None)
    for r in rows.values():
        assert r["heartrate_min"] <= r["heartrate_mean"] <= r["heartrate_max"]


def test_timeseries_table(clinic):
    got = views.timeseries_table(clinic)
    assert "icu_elapsed_years" in got.columns and len(got.columns) == len(set(got.columns))
    rows = {(r["icustay_id"], r["timestamp"]): r for r in got.collect()}
    assert rows[(1, at(1))]["dead"] == 0 and rows[(1, at(1))]["dead_in_1d"] == 1 and rows[(2, at(1))]["dead_in_30d"] == 0
    assert rows[(1, at(2))]["hr_1h"] == 80.0
    for r in rows.values():
        assert r["dead"] <= r["dead_in_1d"] <= r["dead_in_7d"] <= r["dead_in_30d"]


def test_whole_admission_and_first_day_variants(stay, chart, visits):
    events = chart((1, 211, 1, 80.0), (1, 211, 40, 500.0, None, 1))
    admitted = visits((1, 1, 0, 99), (2, 2, 0, 99))
    whole = by(views.admission_vitals(admitted, stay((1, 0)), events), "hadm_id", "heartrate_max")
    day = by(views.admission_vitals(admitted, stay((1, 0)), events, first_day=True), "hadm_id", "heartrate_max")
    assert (whole, day) == ({1: 500.0, 2: None}, {1: 80.0, 2: None})


def test_basic_table_keeps_every_stay_and_large_values(clinic, lab):
    clinic["labevents"] = lab((1, 50912, 1, 500.0), (1, 50885, 1, 2.0))
    rows = {r["icustay_id"]: r for r in views.basic_feature_table(clinic).collect()}
    assert (rows[1]["creatinine_max"], rows[1]["gcs_min"], rows[1]["heartrate_mean"]) == (500.0, 15.0, 85.0)
    assert (rows[2]["creatinine_max"], rows[2]["gcs_min"], rows[2]["heartrate_mean"]) == (None, None, 60.0)


def test_admission_level_join_repeats_rows(table, clinic, stay, chart):
    clinic["icustays"] = stay((1, 0, 1, 1), (3, 40, 1, 1), (2, 0, 2, 2))
    first = clinic["chartevents"].filter("icustay_id = 1")
    second = first.withColumn("icustay_id", F.lit(3).cast("long")).withColumn("charttime", fn.shift("charttime", "40 hours"))
    clinic["chartevents"] = first.unionByName(second)
    assert views.cohort_with_stay_vitals(clinic).filter("hadm_id = 1").count() == 2
    assert views.cohort_with_admission_vitals(clinic).filter("hadm_id = 1").count() == 1


def test_model_frame(clinic):
    table = views.feature_table(clinic)
    got = views.model_frame(table, ["age_icu_in", "gender", "heartrate_mean", "creatinine_max"], ["icu_expire_flag"])
    rows = {r["icustay_id"]: r for r in got.collect()}
    assert rows[2]["creatinine_max"] == 1.0 and rows[1]["gender"] == 0.0
    assert {r["icu_expire_flag"] for r in rows.values()} == {0.0, 1.0}


def test_overwrite_after(spark):
    rows = spark.createDataFrame([(1, at(0), at(1), 5.0), (2, at(2), at(1), 5.0), (3, at(2), None, 5.0)], "id int, ts timestamp_ntz, e timestamp_ntz, v double")
    assert by(rows.withColumn("v", fn.overwrite_after("ts", "e", "v")), "id", "v") == {1: 5.0, 2: 0.0, 3: 5.0}


# --- reports ------------------------------------------------------------------------------------------------


@pytest.fixture
def dictionary(table):
    rows = [{"itemid": 211, "label": "Heart Rate"}, {"itemid": 40055, "label": "Urine Out Foley"}, {"itemid": 50912, "label": "Creatinine"}]
    return {"d_items": table("d_items", *rows[:2]), "d_labitems": table("d_labitems", rows[2])}


def test_single_stay_reports(clinic, dictionary, chart):
    t = {**clinic, **dictionary}
    t["chartevents"] = chart((1, 211, 1.5, 80.0, "80", 0), (1, 211, 2, 90.0, "90", 1), (1, 211, 3, 95.0), (2, 211, 1, 50.0, "50", 0))
    rows = reports.stay_chart(t, 1).collect()
    assert [(r["label"], r["valuenum"], r["icu_hours"]) for r in rows] == [("Heart Rate", 80.0, 1.5)]
    assert reports.stay_outputs(t, 1).first()["value"] == 300.0
    assert [(r["label"], r["valuenum"]) for r in reports.stay_labs(t, 1).collect()] == [("Creatinine", 1.0)]
    assert reports.stay_admission(t, 1).first()["first_careunit"] == "MICU"


def test_observations_per_admission(clinic):
    row = reports.observations_per_admission(clinic["chartevents"]).first()
    assert (row["avg_obs"], row["avg_variable"]) == (3.0, 2.5)


def test_diagnosis_ages(table, people, visits):
    t = {
        "diagnoses_icd": table("diagnoses_icd", *[{"subject_id": s, "icd9_code": c} for s, c in ((1, "4010"), (1, "4019"), (2, "4011"), (3, "5000"))]),
        "patients": people(*[(s, at(days=-365.25 * age), None) for s, age in ((1, 20.5), (2, 95), (3, 50))]),
        "admissions": visits((1, 1, 0, 9), (1, 2, 9000, 9009), (2, 3, 0, 9), (3, 4, 0, 9)),
    }
    assert reports.diagnosed(t["diagnoses_icd"], "401").first()["patients"] == 2
    bands = reports.diagnosis_age_bands(t, "401").first().asDict()
    assert (bands["total"], bands["from_16_to_21"], bands["from_91"]) == (2, 1, 1)


def test_first_lab_by_outcome(table, clinic, lab, visits):
    t = dict(clinic)
    t["labevents"] = lab((1, 50868, 2, 12.0), (1, 50868, 2, 14.0), (1, 50868, 5, 30.0))
    t["admissions"] = t["admissions"].withColumn("deathtime", F.when(F.col("hadm_id") == 1, F.lit(at(3)).cast("timestamp_ntz")))
    got = by(reports.first_lab(t, "aniongap"), "icustay_id", "mort_icu", "mort_hosp", "aniongap_1st")
    assert got == {1: (1, 1, 14.0), 2: (0, 0, None)}


def test_heart_rate_of_one_admission(stay, chart):
    events = chart((1, 211, 0.1, 80.0), (1, 211, 0.2, 80.0), (1, 211, 0.3, 100.0), (1, 211, 1, 60.0), (1, 220045, 1, 10.0), (2, 211, 0, 50.0))
    rows = {r["timestamp"]: r for r in reports.heart_rate_series({"icustays": stay((1, 0), (2, 0)), "chartevents": events}, 1).collect()}
    assert set(rows) == {at(0), at(1)}
    assert (rows[at(1)]["hr"], rows[at(1)]["hr_1h"], rows[at(1)]["hr_median_6h"]) == (60.0, 90.0, 75.0)


@pytest.mark.parametrize("rules", [items.VITALS, items.LABS, items.BLOOD_GAS, items.GCS])
def test_item_look_ups_are_the_branches(spark, rules):
    """Look-ups give what a branch for each rule gives, and are no branches."""
    ends = sorted({float(e) for r in rules for e in (r.lo, r.hi) if e is not None} | {-1.0, 50.5})
    values = [x for e in ends for x in (e, e - 1e-9, e + 1e-9)] + [float("nan"), None]
    item, value = F.col("item"), F.col("value")
    rows = spark.createDataFrame([(i,) for i in [*items.codes(rules), 1, None]], "item int").crossJoin(spark.createDataFrame([(v,) for v in values], "value double"))
    first = items._first_match
    branches = {
        "fused": first([(item.isin(*r.items), F.lit(r.label)) for r in rules]),
        "label": first([(item.isin(*r.items) & r.valid(value), F.lit(r.label)) for r in rules]),
        "valid": first([(item.isin(*r.items) & ~r.valid(value), F.lit(None).cast("double")) for r in rules]).otherwise(value),
    }
    made = {"fused": items.fuse(item, rules), "label": items.valid_label(item, value, rules), "valid": items.valid_value(item, value, rules)}
    both = rows.select("item", "value", *[made[n].eqNullSafe(branches[n]).alias(n) for n in made])
    assert both.where("NOT (fused AND label AND valid)").count() == 0
    plan = rows.select(made["fused"], made["label"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("WHEN") <= 3 < 2 * len(rules)


def test_clinical_items_are_looked_up(spark):
    from icuflow.plans import clinic

    rows = spark.createDataFrame([(-4,), (0,), (1,), (5,), (None,)], "l_partkey long")
    code = clinic.pick([7, 8, 9], "l_partkey * 2")
    got = rows.select(code.column().alias("a"), F.expr(str(code)).alias("b"), code.column()).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] == [None, 7, 9, 8, None]


def test_the_coma_score_needs_no_range_pieces(spark, stay, chart):
    plan = views.gcs_first_day(stay((1, 0)), chart((1, 723, 1, 1.0)))._jdf.queryExecution().toString()
    assert "Window" in plan and "_piece" not in plan and "rangepartitioning" not in plan
    parts = spark.createDataFrame([(k, at(h), a, b) for k in (1, 2) for h, a, b in ((0, 0, None), (3, None, 2), (8, 1, None), (20, None, None))], "k int, t timestamp_ntz, a int, b int")
    made = [score.carry_forward(parts, ["k"], "t", {"a": 5, "b": 6}, "a", 15, bounded=bounded) for bounded in (True, False)]
    assert sorted(map(str, made[0].collect())) == sorted(map(str, made[1].select(made[0].columns).collect()))
