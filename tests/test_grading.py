import json
import math

import pytest
from pyspark.sql import functions as F

from model import RULES, colour
from sensorloom.functions.grading import DEFAULT_RANGES, StatusRange, load_ranges, range_of
from sensorloom.operators.alerts import window_alerts
from sensorloom.operators.combine import grade
from sensorloom.plans.views import grade_readings

BOUNDARIES = {
    "temperature": {
        "green": [45, 46, 47],
        "yellow": [44, 44.99, 47.01, 48],
        "red": [43.99, 48.01, float("nan"), float("inf"), -1],
    },
    "pressure": {
        "green": [60, 65, 70],
        "yellow": [58, 59.99, 70.01, 72],
        "red": [57.99, 72.01, float("nan")],
    },
    "motor_power": {
        "green": [11, 12, 13],
        "yellow": [9, 10.99, 13.01, 15],
        "red": [8.99, 15.01, float("nan")],
    },
}


@pytest.mark.parametrize("measure", BOUNDARIES)
def test_every_limit(spark, measure):
    rows = [(measure, float(x), c) for c, xs in BOUNDARIES[measure].items() for x in xs]
    # The neighbours of each limit, as near as a double allows.
    for limit in RULES[measure][:4]:
        for x in (math.nextafter(limit, -1e9), float(limit), math.nextafter(limit, 1e9)):
            rows.append((measure, x, colour(measure, x)))
    df = spark.createDataFrame(rows, "measure string, mean double, expected string")
    prefix, noun = RULES[measure][4:]
    for row in grade(df).collect():
        assert row.colour == row.expected, row
        assert row.status == f"{prefix}_{row.expected}"
        assert f" {noun} is " in row.notification
        start = {"green": "The ", "yellow": "Caution! ", "red": "Error! "}[row.colour]
        assert row.notification.startswith(start)
    assert grade(df).count() == len(rows)


def test_null_is_left_out(spark):
    df = spark.createDataFrame([("pressure", None)], "measure string, mean double")
    assert grade(df).count() == 0


def test_texts(spark):
    df = spark.createDataFrame(
        [("motor_power", 12.0), ("motor_power", 10.0), ("motor_power", 1.0)],
        "measure string, mean double",
    )
    assert [r.notification for r in grade(df).orderBy(F.desc("mean")).collect()] == [
        "The motor power is in the optimum range.",
        "Caution! Actions might be neccessary, as the measured motor power is out of the "
        "optimum range.",
        "Error! Machine is not working properly, the motor power is way out of the optimum "
        "range. Help is needed.",
    ]


def test_other_ranges(spark, tmp_path):
    path = tmp_path / "ranges.json"
    entry = {
        "measure": "speed",
        "noun": "speed",
        "status_prefix": "rpm",
        "summary_prefix": "rpm",
        "green": [1, 2],
        "yellow": [0, 3],
    }
    path.write_text(json.dumps([entry]))
    ranges = load_ranges(path)
    assert ranges == (StatusRange("speed", "speed", "rpm", "rpm", (1, 2), (0, 3)),)
    means = spark.createDataFrame([(1, 2.5)], "w int, speed double")
    row = window_alerts(means, ranges, keep=["w"]).first()
    assert (row.w, row.measure, row.mean, row.status) == (1, "speed", 2.5, "rpm_yellow")
    with pytest.raises(KeyError):
        range_of("speed", DEFAULT_RANGES)


def test_readings_are_graded_one_by_one(make_readings):
    rows = make_readings(("a", "10:00:00", 45, 59, None))
    got = {(r.measure, r.status) for r in grade_readings(rows).collect()}
    assert got == {("temperature", "temp_green"), ("pressure", "pressure_yellow")}
