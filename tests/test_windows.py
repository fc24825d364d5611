import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

import model
from sensorloom.operators.alerts import window_alerts
from sensorloom.operators.joins import first_of_windows
from sensorloom.operators.windows import (
    assign_windows,
    first_reading_per_window,
    tumbling_counts,
    window_mean,
    window_means,
)

UTC = dt.timezone.utc


def text_starts(df):
    return df.withColumn("w", F.date_format("window_start", "HH:mm:ss"))


def test_bounds_and_empty_minute(make_readings):
    rows = make_readings(
        ("a", "00:00:59.999999", 45, 60, 11),
        ("b", "00:01:00", 47, 60, 11),
        ("c", "00:03:30", 48, 60, 11),
    )
    got = {r.w: (r.mean, r.n) for r in text_starts(window_mean(rows, "temperature")).collect()}
    assert got == {"00:00:00": (45.0, 1), "00:01:00": (47.0, 1), "00:03:00": (48.0, 1)}
    assert tumbling_counts(rows).count() == 3
    ends = assign_windows(rows).select(
        "id", (F.col("window_end").cast("long") - F.col("window_start").cast("long")).alias("s")
    )
    assert {r.s for r in ends.collect()} == {60}


def test_no_rows_no_windows(make_readings):
    empty = make_readings(("a", "00:00:00", 1, 1, 1)).filter("false")
    assert window_means(empty).count() == 0
    assert window_alerts(window_means(empty)).count() == 0


def test_null_and_nan(make_readings):
    rows = make_readings(
        ("a", "00:00:01", 45, None, float("nan")),
        ("b", "00:00:02", 46, None, 12),
        ("c", None, 99, 99, 99),
        ("d", "00:01:00", None, 61, None),
    )
    wide = {r.w: r for r in text_starts(window_means(rows)).collect()}
    first, second = wide["00:00:00"], wide["00:01:00"]
    assert (first.temperature, first.pressure, first.n) == (45.5, None, 2)
    assert math.isnan(first.motor_power)
    assert (second.temperature, second.pressure, second.motor_power) == (None, 61.0, None)
    statuses = {r.status for r in window_alerts(window_means(rows)).collect()}
    assert statuses == {"temp_green", "mpower_red", "pressure_green"}
    assert window_mean(rows, "temperature").count() == 1


def test_assign_keeps_rows_without_time(make_readings):
    rows = make_readings(("a", None, 1, 1, 1), ("b", "00:00:30", 1, 1, 1))
    got = {r.id: r.window_start is None for r in assign_windows(rows).collect()}
    assert got == {"a": True, "b": False}


@pytest.mark.parametrize("first", [first_reading_per_window, first_of_windows])
def test_first_reading(make_readings, first):
    rows = make_readings(
        ("z", "00:00:10", 1, 1, 1),
        ("y", "00:00:05", 1, 1, 1),
        ("x", "00:00:05", 1, 1, 1),
        ("a", "00:01:59", 1, 1, 1),
        ("none", None, 1, 1, 1),
        (None, "00:02:00", 1, 1, 1),
    )
    got = {r.w: r.id for r in text_starts(first(rows)).collect()}
    assert got == {"00:00:00": "x", "00:01:00": "a", "00:02:00": None}


@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_first_of_windows_with_and_without_broadcast(spark, limit):
    """A third of the readings in one window, and many at one instant."""
    rng = random.Random(4)
    rows = [(str(rng.randrange(10**6)), rng.randrange(60) if i % 3 else rng.randrange(5_000)) for i in range(3_000)]
    df = spark.createDataFrame(rows, "id string, s int").withColumn("event_time", F.timestamp_seconds("s"))
    expected = {}
    for id, at in rows:
        expected[at // 60] = min(expected.get(at // 60, (at, id)), (at, id))
    got = first_of_windows(df, broadcast_rows=limit).collect()
    assert {int(r.window_start.timestamp()) // 60: r.id for r in got} == {w: id for w, (_, id) in expected.items()}


def test_first_of_windows_sorts_no_raw_readings(make_readings):
    rows = make_readings(("a", "00:00:01", 1, 1, 1))
    plan = first_of_windows(rows)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("BroadcastHashJoin") :]
    assert "Sort [" not in below and "SortAggregate" not in below and "Exchange hash" not in below


@pytest.mark.parametrize("seed,length,seconds", [(1, "1 minute", 60), (2, "7 minutes", 420)])
def test_random_readings_against_model(spark, seed, length, seconds):
    rng = random.Random(seed)
    plain, data = [], []
    for i in range(3000):
        # A third of all rows share one minute.
        at = rng.uniform(0, 60) if i % 3 == 0 else rng.uniform(0, 20_000)
        at = round(at, 6)
        values = {
            "temperature": rng.choice([None, rng.uniform(42, 50)]),
            "pressure": rng.uniform(55, 75),
            "motor_power": rng.uniform(7, 17) if rng.random() > 0.01 else float("nan"),
        }
        plain.append((at, values))
        moment = dt.datetime(1970, 1, 1, tzinfo=UTC) + dt.timedelta(microseconds=round(at * 1e6))
        data.append((moment, *values.values()))
    df = spark.createDataFrame(
        data, "event_time timestamp, temperature double, pressure double, motor_power double"
    ).repartition(8)
    # fsum and the engine sum in different orders, so compare means by tolerance; a status may
    # differ only if its mean is that close to a limit, which the seeds here avoid.
    expected = model.alerts(plain, seconds)
    got = window_alerts(window_means(df, length=length)).collect()
    assert len(got) == len(expected)
    for row in got:
        start = int(row.window_start.timestamp())
        mean, status = expected[start, row.measure]
        assert status == row.status
        assert (math.isnan(mean) and math.isnan(row.mean)) or abs(mean - row.mean) < 1e-9


def test_means_are_combined_before_the_shuffle(make_readings):
    rows = make_readings(("a", "00:00:01", 1, 1, 1))
    plan = window_means(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_avg" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize(
    "length", ["1 minute", "90 seconds", "1 hour 30 minutes", "interval 7 minutes", "1 day"]
)
def test_bounds_are_those_of_the_window_function(spark, sf_dir, length):
    from sensorloom.plans.event_readings import readings_from_events

    readings = readings_from_events(spark, sf_dir)
    window = F.window("event_time", length)
    expected = readings.groupBy(window).count().select("window.start", "window.end", "count")
    got = tumbling_counts(readings, length)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assigned = assign_windows(readings, length).select("window_start", "window_end").distinct()
    assert sorted(map(tuple, assigned.collect())) == sorted(r[:2] for r in expected.collect())
