"""Item dictionaries: which codes mean what, which values are valid, how to convert them."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One measurement: its item codes, its valid range and its unit conversion.

    `(value - offset) / scale` is the converted value. `lo`/`hi` apply to the raw value;
    None leaves that end open. The ends are exclusive unless `lo_closed`/`hi_closed`.
    """

    label: str
    items: tuple
    lo: float | None = None
    hi: float | None = None
    lo_closed: bool = False
    hi_closed: bool = False
    offset: float = 0.0
    scale: float = 1.0

    def valid(self, value: Column) -> Column:
        ok = F.lit(True)
        if self.lo is not None:
            ok = ok & (value >= self.lo if self.lo_closed else value > self.lo)
        if self.hi is not None:
            ok = ok & (value <= self.hi if self.hi_closed else value < self.hi)
        return ok


def codes(rules: Iterable[Rule]) -> list:
    """All item codes, for a literal IN filter that reaches the scan."""
    return [item for rule in rules for item in rule.items]


def labels(rules: Iterable[Rule]) -> list[str]:
    """Distinct labels in dictionary order."""
    return list(dict.fromkeys(rule.label for rule in rules))


def _first_match(branches: Sequence[tuple[Column, Column]]) -> Column | None:
    chosen = None
    for condition, result in branches:
        chosen = F.when(condition, result) if chosen is None else chosen.when(condition, result)
    return chosen


def _place(item: Column, rules: Sequence[Rule]) -> Column:
    """Item code -> place of its rule, as a look-up: branches for every rule, several times in one projection, are more code
    than the JVM compiles."""
    return F.try_element_at(F.create_map(*[F.lit(x) for n, r in enumerate(rules) for i in r.items for x in (i, n)]), item)


def _of(place: Column, values: Iterable, kind: str) -> Column:
    """The value at a place of a list that may have gaps."""
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), place)


def _in_range(place: Column, value: Column, rules: Sequence[Rule]) -> Column:
    """`Rule.valid` of the rule at a place; true without a rule. A closed end is an open one at the next number."""
    lo = _of(place, [math.nextafter(r.lo, -math.inf) if r.lo is not None and r.lo_closed else r.lo for r in rules], "double")
    hi = _of(place, [math.nextafter(r.hi, math.inf) if r.hi is not None and r.hi_closed else r.hi for r in rules], "double")
    return (lo.isNull() | (value > lo)) & (hi.isNull() | (value < hi))


def _once(rules: Sequence[Rule]) -> bool:
    """No item stands in two rules."""
    return len(codes(rules)) == len(set(codes(rules)))


def fuse(item: Column, rules: Sequence[Rule]) -> Column:
    """Item code -> label; codes outside the dictionary give NULL."""
    if _once(rules):
        return _of(_place(item, rules), [r.label for r in rules], "string")
    return _first_match([(item.isin(*r.items), F.lit(r.label)) for r in rules])


def valid_label(item: Column, value: Column, rules: Sequence[Rule]) -> Column:
    """Item code -> label if the value is in range, else NULL."""
    if _once(rules):
        place = _place(item, rules)
        return F.when(_in_range(place, value, rules), _of(place, [r.label for r in rules], "string"))
    return _first_match([(item.isin(*r.items) & r.valid(value), F.lit(r.label)) for r in rules])


def valid_value(item: Column, value: Column, rules: Sequence[Rule]) -> Column:
    """The value if it is in range for its item, else NULL; unlisted items pass."""
    if _once(rules):
        return F.when(~_in_range(_place(item, rules), value, rules), F.lit(None).cast("double")).otherwise(value)
    bad = [(item.isin(*r.items) & ~r.valid(value), F.lit(None).cast("double")) for r in rules]
    return _first_match(bad).otherwise(value)


def convert(item: Column, value: Column, rules: Sequence[Rule]) -> Column:
    """Unit conversion of the items that have one."""
    scaled = [
        (item.isin(*r.items), (value - r.offset) / r.scale)
        for r in rules
        if (r.offset, r.scale) != (0.0, 1.0)
    ]
    return _first_match(scaled).otherwise(value) if scaled else value


def as_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The dictionary as a table, one row per item code (for label joins and reports)."""

    def number(x):
        return None if x is None else float(x)

    rows = [
        (str(i), r.label, number(r.lo), r.lo_closed, number(r.hi), r.hi_closed, r.offset, r.scale)
        for r in rules
        for i in r.items
    ]
    return spark.createDataFrame(
        rows,
        "item string, label string, lo double, lo_closed boolean, hi double, hi_closed boolean,"
        " offset double, scale double",
    )


# ---------------------------------------------------------------------------------------
# Item codes, labels and limits of the clinical source tables.
# ---------------------------------------------------------------------------------------

VITALS = (
    Rule("heartrate", (211, 220045), 0, 300),
    Rule("sysbp", (51, 442, 455, 6701, 220179, 220050), 0, 400),
    Rule("diasbp", (8368, 8440, 8441, 8555, 220180, 220051), 0, 300),
    Rule("meanbp", (456, 52, 6702, 443, 220052, 220181, 225312), 0, 300),
    Rule("resprate", (615, 618, 220210, 224690), 0, 70),
    Rule("tempc", (223761, 678), 70, 120, offset=32.0, scale=1.8),
    Rule("tempc", (223762, 676), 10, 50),
    Rule("spo2", (646, 220277), 0, 100, hi_closed=True),
    Rule("glucose", (807, 811, 1529, 3745, 3744, 225664, 220621, 226537), 0),
)

LABS = (
    Rule("aniongap", (50868,), 0, 10000, hi_closed=True),
    Rule("albumin", (50862,), 0, 10, hi_closed=True),
    Rule("bands", (51144,), 0, 100, hi_closed=True),
    Rule("bicarbonate", (50882,), 0, 10000, hi_closed=True),
    Rule("bilirubin", (50885,), 0, 150, hi_closed=True),
    Rule("creatinine", (50912,), 0, 150, hi_closed=True),
    Rule("chloride", (50806, 50902), 0, 10000, hi_closed=True),
    Rule("glucose", (50809, 50931), 0, 10000, hi_closed=True),
    Rule("hematocrit", (50810, 51221), 0, 100, hi_closed=True),
    Rule("hemoglobin", (50811, 51222), 0, 50, hi_closed=True),
    Rule("lactate", (50813,), 0, 50, hi_closed=True),
    Rule("platelet", (51265,), 0, 10000, hi_closed=True),
    Rule("potassium", (50822, 50971), 0, 30, hi_closed=True),
    Rule("ptt", (51275,), 0, 150, hi_closed=True),
    Rule("inr", (51237,), 0, 50, hi_closed=True),
    Rule("pt", (51274,), 0, 150, hi_closed=True),
    Rule("sodium", (50824, 50983), 0, 200, hi_closed=True),
    Rule("bun", (51006,), 0, 300, hi_closed=True),
    Rule("wbc", (51300, 51301), 0, 1000, hi_closed=True),
)

BLOOD_GAS = (
    Rule("specimen", (50800,)),
    Rule("aado2", (50801,), 0),
    Rule("baseexcess", (50802,), 0),
    Rule("bicarbonate", (50803,), 0),
    Rule("totalco2", (50804,), 0),
    Rule("carboxyhemoglobin", (50805,), 0),
    Rule("chloride", (50806,), 0),
    Rule("calcium", (50808,), 0),
    Rule("glucose", (50809,), 0),
    Rule("hematocrit", (50810,), 0, 100, hi_closed=True),
    Rule("hemoglobin", (50811,), 0),
    Rule("intubated", (50812,), 0),
    Rule("lactate", (50813,), 0),
    Rule("methemoglobin", (50814,), 0),
    Rule("o2flow", (50815,), 0, 70, hi_closed=True),
    Rule("fio2", (50816,), 0, 100, hi_closed=True),
    Rule("so2", (50817,), 0, 100, hi_closed=True),
    Rule("pco2", (50818,), 0),
    Rule("peep", (50819,), 0),
    Rule("ph", (50820,), 0),
    Rule("po2", (50821,), 0, 800, hi_closed=True),
    Rule("potassium", (50822,), 0),
    Rule("requiredo2", (50823,), 0),
    Rule("sodium", (50824,), 0),
    Rule("temperature", (50825,), 0),
    Rule("tidalvolume", (50826,), 0),
    Rule("ventilationrate", (50827,), 0),
    Rule("ventilator", (50828,), 0),
)
# Fetched without a label: they only make (stay, time) rows.
BLOOD_GAS_UNLABELLED = (50807, 51545)

GCS = (
    Rule("gcsverbal", (723, 223900)),
    Rule("gcsmotor", (454, 223901)),
    Rule("gcseyes", (184, 220739)),
)
# Text that stands for "no verbal response, tube in place", scored 0.
GCS_SENTINELS = {723: "1.0 ET/Trach", 223900: "No Response-ETT"}
GCS_NORMAL = {"gcsmotor": 6, "gcsverbal": 5, "gcseyes": 4}
GCS_FULL = 15

URINE_OUTPUT = (
    40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405, 40428, 40086, 40096,
    40651, 226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558,
    227488, 227489,
)
URINE_IRRIGANT = 227488  # volume put in, counted negative

SURGICAL_SUFFIX = "SURG"
SURGICAL_SERVICES = ("ORTHO",)

REFERENCE_RANGES = {
    "bicarbonate": (22, 32),
    "bun": (6, 20),
    "calcium": (8.4, 10.3),
    "chloride": (96, 108),
    "creatinine": (0.4, 1.1),
    "hemoglobin": (11.2, 15.7),
    "lactate": (0.5, 2.0),
    "phosphate": (2.7, 4.5),
    "platelet": (150, 400),
    "potassium": (3.3, 5.1),
    "sodium": (133, 145),
}

# Ages above the cap are date-shifted for privacy; their true median stands in for them.
AGE_CAP, AGE_CAP_VALUE = 89, 91.6
DAYS_PER_YEAR = 365.242
