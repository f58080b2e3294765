import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from icuflow.session import build_session  # noqa: E402
from icuflow.sources.schema import CLINICAL  # noqa: E402

T0 = datetime(2020, 1, 1, 0, 0, 0)


def at(hours: float = 0, days: float = 0) -> datetime:
    return T0 + timedelta(days=days, hours=hours)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__default__parallelism="2",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows of one clinical table; each row names only the columns it sets."""

    def make(name, *rows):
        columns = [c.strip().split(" ")[0] for c in CLINICAL[name].split(",")]
        full = [tuple(row.get(c) for c in columns) for row in rows]
        return spark.createDataFrame(full, CLINICAL[name])

    return make


@pytest.fixture
def stay(table):
    """icustays frame from (icustay_id, start hour) pairs, one subject and admission each unless given."""

    def make(*specs):
        rows = []
        for spec in specs:
            icustay, start, *rest = spec
            subject, hadm = rest if rest else (icustay, icustay)
            rows.append(
                {
                    "subject_id": subject,
                    "hadm_id": hadm,
                    "icustay_id": icustay,
                    "intime": at(start),
                    "outtime": at(start + 72),
                    "los": 3.0,
                    "first_careunit": "MICU",
                }
            )
        return table("icustays", *rows)

    return make


@pytest.fixture
def chart(table):
    """chartevents from (icustay, item, hour, number[, text[, error]])."""

    def make(*specs):
        rows = []
        for icustay, item, hour, number, *rest in specs:
            rows.append(
                {
                    "subject_id": icustay,
                    "hadm_id": icustay,
                    "icustay_id": icustay,
                    "itemid": item,
                    "charttime": at(hour),
                    "valuenum": number,
                    "value": rest[0] if rest else None,
                    "error": rest[1] if len(rest) > 1 else None,
                }
            )
        return table("chartevents", *rows)

    return make


@pytest.fixture
def lab(table):
    """labevents from (admission, item, hour, number[, text])."""

    def make(*specs):
        rows = []
        for hadm, item, hour, number, *rest in specs:
            rows.append(
                {
                    "subject_id": hadm,
                    "hadm_id": hadm,
                    "itemid": item,
                    "charttime": at(hour),
                    "valuenum": number,
                    "value": rest[0] if rest else None,
                }
            )
        return table("labevents", *rows)

    return make
