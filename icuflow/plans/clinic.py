"""The clinical schema filled from the test tables, for Spark and (as SQL text) for the oracle.

orders -> stays and admissions, customer -> patients, lineitem -> charted values, coma scores, labs, outputs, ventilation
and transfers around the start of their order's stay. Items, values and times follow from the keys by expressions that
both dialects read alike; they reach every item code, values in and out of range, missing ones and error marks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.functions import items
from icuflow.plans.bindings import ADM, ICU, PAT, admissions, icustays, patients
from icuflow.sources.io import Tables

U, S, N = "l_partkey", "l_suppkey", "l_linenumber"


@dataclass(frozen=True)
class Pick:
    """The code at a place, counted round; none at a negative place."""

    codes: Sequence[int]
    place: str

    def __str__(self) -> str:
        """SQL that both dialects read."""
        return f"CASE ({self.place}) % {len(self.codes)} " + " ".join(f"WHEN {i} THEN {code}" for i, code in enumerate(self.codes)) + " END"

    def column(self) -> Column:
        """The same as a look-up: as branches, the items of some rows are more code than the JVM compiles."""
        return F.get(F.lit(list(self.codes)), F.expr(f"({self.place}) % {len(self.codes)}"))


def pick(codes: Sequence, place: str) -> Pick:
    return Pick(tuple(codes), place)


_VITALS = items.codes(items.VITALS)
_LABS = list(dict.fromkeys([*items.codes(items.LABS), *items.codes(items.BLOOD_GAS), *items.BLOOD_GAS_UNLABELLED]))
_URINE = [*items.URINE_OUTPUT[:12], items.URINE_IRRIGANT]
_GCS_TIME = f"(({U} + {N} * 5) % 24) * 60 + ({S} % 3) * 20"
_ERROR = f"CASE WHEN {U} % 19 = 0 THEN 1 WHEN {U} % 3 = 0 THEN 0 END"

#: Rows that each line gives: item, minutes after the stay's start, number, text, error mark.
CHART = [
    (pick(_VITALS, f"{U} * 7 + {N}"), f"({U} * 31 + {S} * 17 + {N} * 101) % 2400 - 300", f"({U} * 13 + {S}) % 130 * CASE WHEN {S} % 17 = 0 THEN 4.0 ELSE 1.0 END", "NULL", _ERROR),
    (pick(_VITALS, f"{U} * 3 + {S} * 5 + {N}"), f"({U} * 11 + {S} * 29 + {N} * 53) % 1800", f"({U} + {S} * 7 + {N} * 19) % 125 + 0.5", "NULL", _ERROR),
    (pick(_VITALS, f"{U} + {S}"), f"({U} * 11 + {S} * 29 + {N} * 53) % 1800 + {N}", f"CASE WHEN {U} % 23 > 0 THEN ({U} * 3 + {S}) % 110 + 0.25 END", "NULL", "NULL"),
    (f"CASE WHEN {U} % 2 = 0 THEN 723 ELSE 223900 END", _GCS_TIME, f"CASE WHEN {U} % 7 > 0 THEN 1.0 + {U} % 5 END",
     f"CASE WHEN {S} % 11 = 0 THEN CASE WHEN {U} % 2 = 0 THEN '{items.GCS_SENTINELS[723]}' ELSE '{items.GCS_SENTINELS[223900]}' END END", _ERROR),
    (f"CASE WHEN {S} % 2 = 0 THEN 454 ELSE 223901 END", _GCS_TIME, f"CASE WHEN {S} % 5 > 0 THEN 1.0 + {S} % 6 END", "NULL", "NULL"),
    (f"CASE WHEN {S} % 2 = 0 THEN 184 ELSE 220739 END", _GCS_TIME, f"CASE WHEN {N} % 4 > 0 THEN 1.0 + ({U} + {S}) % 4 END", "NULL", "0"),
]
LABS = [
    (pick(_LABS, f"{U} * 5 + {N}"), f"({U} * 37 + {S} * 11) % 2400 - 600", f"({U} * 7 + {N}) % 220 * CASE WHEN {S} % 13 = 0 THEN 100.0 ELSE 0.5 END - 3", f"CASE WHEN {U} % 3 > 0 THEN 'ART' ELSE 'VEN' END"),
    (pick(_LABS, f"{U} + {S} * 3 + {N}"), f"({U} * 37 + {S} * 11) % 2400 - 600", f"({S} * 17 + {U}) % 150 + 0.125", "'MIX'"),
    (pick(_LABS, f"{U} * 2 + {S} + {N}"), f"({U} * 41 + {S} * 5 + {N} * 60) % 2000 - 400", f"CASE WHEN {U} % 9 > 0 THEN ({S} * 3 + {U} * 11) % 90 * 0.1 END", "NULL"),
]
OUTPUT = (pick(_URINE, f"{U} + {N}"), f"({U} * 19 + {S}) % 2000 - 100", "l_quantity")
VENT = (f"({U} * 23 + {S}) % 4000 - 1000", f"60 + {S} % 900", "l_returnflag = 'R'")
MOVE = (f"({U} * 43 + {S} * 3) % 3000 - 1500", "CASE l_returnflag WHEN 'R' THEN 'CSURG' WHEN 'A' THEN 'ORTHO' ELSE 'MED' END")


def _later(minutes: str) -> Column:
    return F.expr(f"intime + make_dt_interval(0, 0, CAST({minutes} AS INT), 0)")


def _lines(t: Tables) -> DataFrame:
    """Lines with their order's stay."""
    stay = t.orders.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"), F.col("o_orderdate").alias("intime"))
    lines = t.lineitem.select("l_orderkey", U, S, N, "l_quantity", "l_returnflag")
    return lines.join(stay, F.col("l_orderkey") == F.col("hadm_id")).withColumn("icustay_id", F.col("hadm_id"))


def _exploded(lines: DataFrame, rows: Sequence[Sequence[str]], names: Sequence[str], kinds: Sequence[str], keys: Sequence[str]) -> DataFrame:
    made = []
    for item, minutes, *rest in rows:
        code = item.column() if isinstance(item, Pick) else F.expr(item)
        values = [code.cast("int").alias("itemid"), F.expr(f"CAST({minutes} AS INT)").alias("minutes")]
        values += [F.expr(text).cast(kind).alias(name) for text, name, kind in zip(rest, names, kinds, strict=True)]
        made.append(F.struct(*values))
    rows = lines.select(*keys, "intime", F.inline(F.array(*made)))
    return rows.select(*keys, "itemid", _later("minutes").alias("charttime"), *names)


def clinical(t: Tables) -> dict[str, DataFrame]:
    """The clinical source tables."""
    lines = _lines(t)
    stay = ["subject_id", "hadm_id", "icustay_id"]
    start, length, vent = VENT
    order = t.orders.select(F.col("o_orderkey").alias("icustay_id"))
    return {
        "icustays": icustays(t),
        "patients": patients(t),
        "admissions": admissions(t),
        "chartevents": _exploded(lines, CHART, ["valuenum", "value", "error"], ["double", "string", "int"], stay),
        "labevents": _exploded(lines, LABS, ["valuenum", "value"], ["double", "string"], stay[:2]),
        "outputevents": _exploded(lines, [OUTPUT], ["value"], ["double"], stay),
        "ventdurations": lines.where(vent).select(
            "icustay_id", _later(start).alias("starttime"), _later(f"{start} + {length}").alias("endtime")
        ),
        "services": lines.select("hadm_id", _later(MOVE[0]).alias("transfertime"), F.expr(MOVE[1]).alias("curr_service")),
        "heightweight": order.where("icustay_id % 4 > 0").select(
            "icustay_id", (F.col("icustay_id") % 50 + 150).cast("double").alias("height_first"), (F.col("icustay_id") % 70 + 45).cast("double").alias("weight_first")
        ),
    }


def _union(rows: Sequence[Sequence[str]], names: Sequence[str], kinds: Sequence[str], keys: str) -> str:
    made = []
    for item, minutes, *rest in rows:
        values = ", ".join(f"CAST({text} AS {kind}) AS {name}" for text, name, kind in zip(rest, names, kinds, strict=True))
        made.append(f"SELECT {keys}, CAST({item} AS INTEGER) AS itemid, intime + to_minutes(CAST({minutes} AS BIGINT)) AS charttime, {values} FROM li")
    return " UNION ALL ".join(made)


_KEYS = "subject_id, hadm_id, icustay_id"
#: The same tables as steps of a query.
SOURCES = (
    ICU,
    ADM,
    PAT,
    """li AS (SELECT l.*, o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderkey AS icustay_id, o_orderdate AS intime
      FROM lineitem l JOIN orders ON l_orderkey = o_orderkey)""",
    f"chart AS ({_union(CHART, ['valuenum', 'value', 'error'], ['DOUBLE', 'VARCHAR', 'INTEGER'], _KEYS)})",
    f"labs AS ({_union(LABS, ['valuenum', 'value'], ['DOUBLE', 'VARCHAR'], 'subject_id, hadm_id')})",
    f"output AS ({_union([OUTPUT], ['value'], ['DOUBLE'], _KEYS)})",
    f"""vents AS (SELECT icustay_id, intime + to_minutes(CAST({VENT[0]} AS BIGINT)) AS starttime,
      intime + to_minutes(CAST({VENT[0]} + {VENT[1]} AS BIGINT)) AS endtime FROM li WHERE {VENT[2]})""",
    f"moves AS (SELECT hadm_id, intime + to_minutes(CAST({MOVE[0]} AS BIGINT)) AS transfertime, {MOVE[1]} AS curr_service FROM li)",
    """hw AS (SELECT o_orderkey AS icustay_id, CAST(o_orderkey % 50 + 150 AS DOUBLE) AS height_first,
      CAST(o_orderkey % 70 + 45 AS DOUBLE) AS weight_first FROM orders WHERE o_orderkey % 4 > 0)""",
)


def condition(rule: items.Rule, item: str = "itemid", value: str | None = None) -> str:
    """SQL: the item is the rule's and, if a value is named, it is in range."""
    out = f"{item} IN ({', '.join(map(str, rule.items))})"
    if value and rule.lo is not None:
        out += f" AND {value} {'>=' if rule.lo_closed else '>'} {rule.lo}"
    if value and rule.hi is not None:
        out += f" AND {value} {'<=' if rule.hi_closed else '<'} {rule.hi}"
    return out


def labelled(rules: Sequence[items.Rule], value: str | None = None) -> str:
    return "CASE " + " ".join(f"WHEN {condition(r, value=value)} THEN '{r.label}'" for r in rules) + " END"


def converted(rules: Sequence[items.Rule], value: str) -> str:
    scaled = [r for r in rules if (r.offset, r.scale) != (0.0, 1.0)]
    return "CASE " + " ".join(f"WHEN {condition(r)} THEN ({value} - {r.offset}) / {r.scale}" for r in scaled) + f" ELSE {value} END"


def in_range(rules: Sequence[items.Rule], value: str) -> str:
    """SQL: the value unless it is out of range for its item."""
    limited = [r for r in rules if r.lo is not None or r.hi is not None]
    return "CASE " + " ".join(f"WHEN {condition(r)} AND NOT ({condition(r, value=value)}) THEN NULL" for r in limited) + f" ELSE {value} END"


def codes(rules: Sequence[items.Rule], *more: int) -> str:
    return ", ".join(map(str, [*items.codes(rules), *more]))


def pivoted(labels: Sequence[str], stats: dict[str, str], value: str) -> str:
    return ", ".join(f"{sql}(CASE WHEN label = '{x}' THEN {value} END) AS {x}_{name}" for x in labels for name, sql in stats.items())
