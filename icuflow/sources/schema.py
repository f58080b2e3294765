"""Explicit schemas of the clinical source tables (times without zone)."""

from __future__ import annotations

CLINICAL = {
    "patients": "subject_id long, gender string, dob timestamp_ntz, dod timestamp_ntz, dod_hosp timestamp_ntz, expire_flag int",
    "admissions": "subject_id long, hadm_id long, admittime timestamp_ntz, dischtime timestamp_ntz, deathtime timestamp_ntz,"
    " admission_type string, diagnosis string, hospital_expire_flag int",
    "icustays": "subject_id long, hadm_id long, icustay_id long, first_careunit string, last_careunit string,"
    " intime timestamp_ntz, outtime timestamp_ntz, los double",
    "services": "hadm_id long, transfertime timestamp_ntz, curr_service string",
    "chartevents": "subject_id long, hadm_id long, icustay_id long, itemid int, charttime timestamp_ntz, value string,"
    " valuenum double, valueuom string, error int",
    "labevents": "subject_id long, hadm_id long, itemid int, charttime timestamp_ntz, value string, valuenum double, valueuom string",
    "outputevents": "subject_id long, hadm_id long, icustay_id long, itemid int, charttime timestamp_ntz, value double, valueuom string",
    "d_items": "itemid int, label string",
    "d_labitems": "itemid int, label string",
    "diagnoses_icd": "subject_id long, icd9_code string",
    "ventdurations": "icustay_id long, starttime timestamp_ntz, endtime timestamp_ntz",
    "heightweight": "icustay_id long, height_first double, weight_first double",
}

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
