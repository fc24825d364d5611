import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sensorloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
READING = (
    "id string, time string, event_time timestamp, "
    "temperature double, pressure double, motor_power double"
)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "sensorloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def make_readings(spark):
    """Readings from ``(id, 'HH:MM:SS[.ffffff]', temperature, pressure, motor_power)`` rows."""

    def make(*rows):
        data = []
        for id, clock, *values in rows:
            moment = dt.datetime.fromisoformat(f"2024-03-01 {clock}") if clock else None
            text = str(moment) if moment else None
            aware = moment.replace(tzinfo=dt.timezone.utc) if moment else None
            data.append((id, text, aware, *[None if v is None else float(v) for v in values]))
        return spark.createDataFrame(data, READING)

    return make
