"""Work that must not grow out of proportion: rows dealt once, short code, one pass."""

import math
import random
import statistics

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from icuflow.functions import scalar as fn
from icuflow.operators import cohort, kernel_ridge, series, windows
from icuflow.operators.kernels import gaussian
from icuflow.plans import views
from icuflow.plans.q_tables import rounded
from tests.conftest import at


@pytest.fixture
def shuffled(spark):
    """Joins by shuffles, as of large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_hours_of_a_stay_are_dealt_once(shuffled, table, stay):
    chart = table("chartevents", {"subject_id": 1, "hadm_id": 1, "icustay_id": 1, "itemid": 211, "charttime": at(1), "valuenum": 80.0})
    hours = views.vitals_timeseries(stay((1, 0)), chart)
    assert exchanges(hours) == 2 and "collect_list" not in hours._jdf.queryExecution().toString()


def test_events_of_another_subject_are_left_out(spark, stay):
    rows = [(1, 1, 1, at(1)), (2, 1, 1, at(1)), (None, 1, 1, at(1)), (1, 1, 1, at(30)), (1, None, 1, at(1))]
    events = spark.createDataFrame(rows, "subject_id long, hadm_id long, icustay_id long, charttime timestamp_ntz")
    stays = stay((1, 0)).select(*views.STAY, "intime")
    got = windows.events_in_window(stays, events, ["icustay_id"], "charttime", F.col("s.intime"), fn.shift("s.intime", "1 day"), agreeing=views.STAY[:2])
    assert [tuple(r) for r in got.select(*views.STAY, "charttime").collect()] == [(1, 1, 1, at(1))]


@pytest.mark.parametrize("scope", ["stay", "global"])
def test_history_by_brute_force(spark, scope):
    draw = random.Random(4)
    rows = [(s, h, draw.choice([None, draw.uniform(-9, 9), 0.0])) for s in range(4) for h in range(12)]
    frame = spark.createDataFrame(rows, "stay long, hour long, v double")
    got = {(r["stay"], r["hour"]): r for r in series.with_history(frame, ["v"], ["stay"], ["hour"], scope=scope).collect()}
    for place, (s, h, v) in enumerate(rows):
        back = [x for t, _, x in rows[:place] if scope == "global" or t == s][::-1]
        r = got[s, h]
        assert r["v"] == v and [r[f"v_{k}h"] for k in (1, 2, 3)] == [*back, None, None, None][:3]
        seen = [x for x in [v, *back[:6]] if x is not None]
        want = [statistics.mean(seen), min(seen), max(seen), statistics.median(seen)] if seen else [None] * 4
        assert [r[f"v_{k}_6h"] for k in ("mean", "min", "max", "median")] == (pytest.approx(want) if seen else want)


def test_rounding_is_that_of_decimals(spark):
    draw = random.Random(1)
    values = [0.0, -0.0, 0.5e-6, 1.5e-6, 2.5e-6, -0.5e-6, 1e-9, -1e-9, 0.0078125, -0.0234375, 1.0000005, 123456.7890125, 1e11, 1e15, -1e300, math.inf, -math.inf, math.nan, None]
    values += [draw.uniform(-1, 1) * 10 ** draw.randint(-8, 12) for _ in range(4000)] + [draw.randint(-(10**7), 10**7) / 128 for _ in range(2000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        *[F.struct(fn.rounded("v", p).alias("got"), F.round("v", p).alias("want")).alias(f"p{p}") for p in (0, 3, 6)]
    )
    for r in rows.collect():
        for pair in r:
            assert repr(pair["got"]) == repr(pair["want"])


def test_wide_frames_are_rounded_in_short_methods(spark):
    """A method of more than 8,000 bytes is never compiled by the JVM."""
    wide = rounded(spark.range(9).select("id", *[(F.rand(i) * 9).alias(f"c{i}") for i in range(70)]))
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(wide._jdf.queryExecution().executedPlan())
    assert all(code.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(code.size()))
    assert wide.columns == ["id", *[f"c{i}" for i in range(70)]] and wide.count() == 9


def test_services_of_admissions_with_one_and_several_cut_offs(table, stay):
    stays = stay((1, 0), (2, 0, 2, 20), (3, 48, 2, 20), (4, 0, 4, 40), (5, 0, 4, 40), (6, 0, 6, None), (7, 0)).unionByName(
        stay((8, 0)).withColumn("intime", F.lit(None).cast("timestamp_ntz"))
    )
    moves = [(1, -5, "MED"), (1, 2, "CSURG"), (1, 2, None), (1, 12, "ORTHO"), (20, 1, "TSURG"), (20, 30, "NMED"), (40, 3, "A"), (40, 3, "B"), (40, 1, "C"), (8, 1, "D")]
    services = table("services", *[{"hadm_id": h, "transfertime": at(t), "curr_service": s} for h, t, s in [*moves, *moves, (None, 1, "X")]])
    want = [(1, "CSURG"), (1, None), (2, "TSURG"), (3, "NMED"), (4, "A"), (4, "B"), (5, "A"), (5, "B"), (6, None), (7, None), (8, None)]
    got = [(r["icustay_id"], r["curr_service"]) for r in cohort.latest_service(stays, services).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_one_cut_off_needs_no_ordered_pieces(shuffled, table, stay, monkeypatch):
    def never(*_, **__):
        raise AssertionError("an admission with one cut-off was put in order")

    monkeypatch.setattr(cohort, "latest_before", never)
    services = table("services", {"hadm_id": 1, "transfertime": at(1), "curr_service": "MED"})
    assert [r["curr_service"] for r in cohort.latest_service(stay((1, 0)), services).collect()] == ["MED"]


def blocks_of(z, v, size, **more):
    rows = [{"block": b, "z": z[i : i + size].astype("<f8").tobytes(), "v": v[i : i + size].tolist(), **more} for b, i in enumerate(range(0, len(z), size))]
    return rows


@pytest.mark.parametrize("alone", [True, False])
def test_a_tile_holds_small_kernels(monkeypatch, alone):
    draw = np.random.default_rng(2)
    z, v = draw.normal(size=(50, 3)) * 4, draw.normal(size=50)
    z[7] = z[30]
    shapes, kernel = [], kernel_ridge._kernel

    def seen(*sides):
        found = kernel(*sides)
        shapes.append(found.shape)
        return found

    monkeypatch.setattr(kernel_ridge, "_kernel", seen)
    monkeypatch.setattr(kernel_ridge, "STEP", 7)
    rows = [r | {"part": 0 if alone else r["block"] % 2, "gi": 0, "gj": 0 if alone else 1} for r in blocks_of(z, v, 11)]
    found = [r for batch in kernel_ridge._square_tile(2.0, iter([pa.RecordBatch.from_pylist(rows)])) for r in batch.to_pylist()]
    whole = gaussian(z, z, 2.0)
    part = np.arange(50) // 11 % 2
    want = whole @ v if alone else np.where(part[:, None] != part[None, :], whole, 0) @ v
    assert sorted(r["block"] for r in found) == [0, 1, 2, 3, 4] and max(max(s) for s in shapes) == 7
    assert all(r["q"] == pytest.approx(want[11 * r["block"] :][:11], abs=1e-12) for r in found)
    # Of a part alone, half of the kernel.
    assert sum(a * b for a, b in shapes) < (1800 if alone else 700)


def test_a_tile_is_a_task(spark):
    draw = np.random.default_rng(3)
    z, v = draw.normal(size=(60, 2)), draw.normal(size=60)
    rows = spark.createDataFrame([(r["block"], r["z"], r["v"], r["v"]) for r in blocks_of(z, v, 1)], "block long, z binary, v array<double>, y array<double>")
    grid = kernel_ridge._grid(60, 2 * spark.sparkContext.defaultParallelism)
    tiles = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(kernel_ridge, "_added", lambda found: tiles.append(found) or found)
        kernel_ridge.square_product(rows, "v", 2.0)
        kernel_ridge.product(rows, rows, "v", 2.0)
    half = kernel_ridge._grid(60, spark.sparkContext.defaultParallelism)
    assert [t.rdd.getNumPartitions() for t in tiles] == [grid * (grid + 1) // 2, half * half]


def labs_of(table, *rows):
    return table("labevents", *[{"subject_id": s, "hadm_id": h, "itemid": 50912, "charttime": at(t), "valuenum": v} for s, h, t, v in rows])


def test_labs_of_an_admission_with_one_stay_are_dealt_once(shuffled, table, stay):
    found = views.labs_first_day(stay((1, 0), (2, 0)), labs_of(table, (1, 1, 1, 2.0)))
    assert exchanges(found) == 4 and "_bucket" not in found._jdf.queryExecution().toString()


def test_labs_of_shared_and_own_admissions(table, stay):
    # Stays 2 and 3 share an admission, so do 4 and 5 of two subjects; 6 comes twice; 7 has no admission.
    stays = stay((1, 0), (2, 0, 20, 20), (3, 48, 20, 20), (4, 0, 40, 50), (5, 0, 41, 50), (6, 0), (6, 0), (7, 0, 7, None))
    rows = [(1, 1, -6, 1.0), (1, 1, 24, 2.0), (1, 1, 25, 9.0), (1, 1, -7, 8.0), (3, 1, 1, 7.0), (20, 20, 0, 1.5), (20, 20, 24, 2.5), (20, 20, 42, 3.5), (20, 20, 71, 4.5)]
    rows += [(40, 50, 1, 3.0), (41, 50, 1, 4.0), (6, 6, 1, 5.0), (7, None, 1, 6.0)]
    got = views.labs_first_day(stays, labs_of(table, *rows)).select("icustay_id", "creatinine_min", "creatinine_max").collect()
    want = [(1, 1.0, 2.0), (2, 1.5, 2.5), (3, 3.5, 4.5), (4, 3.0, 3.0), (5, 4.0, 4.0), (6, 5.0, 5.0), (6, 5.0, 5.0), (7, None, None)]
    assert sorted(map(tuple, got)) == want
    assert "_bucket" in views._labs_around_admission(stays, labs_of(table, *rows))._jdf.queryExecution().toString()
