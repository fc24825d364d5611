import json
import math
import random

import pytest
from pyspark.sql import functions as F

from sensorloom.functions.records import (
    first_item,
    last_wins,
    one_entry_map,
    one_item_list,
    pair,
    pairs_to_map,
    update_map,
    without_key,
)
from sensorloom.operators.alerts import (
    BODY_BREAK,
    alert_outbox,
    encode_records,
    stamp,
    window_alerts,
)
from sensorloom.operators.combine import (
    combine_pairs,
    explode_pairs,
    measure_pairs,
    merge_records,
    nested_alert,
    window_summary,
)
from sensorloom.operators.joins import cogroup, cogroup_measures, enrich_with_window
from sensorloom.operators.measures import (
    extract_measures,
    keyed_records,
    rounded_measures,
    stack_measures,
    time_pairs,
    union_all,
)
from sensorloom.operators.windows import window_mean, window_means
from sensorloom.schemas import MEASURES, SUMMARY_SCHEMA
from sensorloom.sinks.metrics import alert_counts

# The four pair lists whose merge is one record of ten fields.
PAIR_LISTS = [
    [("time", "12:00:00")],
    [("pressure_mean", "23"), ("pressure_status", "red"), ("pressure_notification", "Error! ")],
    [("temp_mean", "24"), ("temp_status", "red"), ("temp_notification", "Warning")],
    [("m_mean", "25"), ("m_status", "red"), ("m_notification", "OK! ")],
]


def test_pair_lists_make_one_record(spark):
    frames = [
        spark.createDataFrame([(1, k, v) for k, v in pairs], "w int, k string, v string")
        for pairs in PAIR_LISTS
    ]
    (row,) = combine_pairs(union_all(*frames), ["w"]).collect()
    expected = {k: v for pairs in PAIR_LISTS for k, v in pairs}
    assert row.record == expected and len(expected) == 10
    sent = encode_records(combine_pairs(union_all(*frames), ["w"]), ["record"])
    assert json.loads(sent.first().value.decode()) == {"record": expected}


def test_later_pair_wins(spark):
    rows = [(1, 2, "a", "new"), (1, 1, "a", "old"), (1, 1, "b", None), (2, 1, "a", "x")]
    df = spark.createDataFrame(rows, "w int, at int, k string, v string")
    got = {r.w: r.record for r in combine_pairs(df, ["w"], "at").collect()}
    assert got == {1: {"a": "new", "b": None}, 2: {"a": "x"}}


def test_hot_group_of_pairs_is_reduced_before_it_is_listed(spark):
    df = spark.range(200_000).select(
        F.lit(1).alias("w"),
        "id",
        F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    combined = combine_pairs(df, ["w"], "id")
    assert combined.first().record == {"k0": "199998", "k1": "199999", "k2": "199997"}
    plan = combined._jdf.queryExecution().executedPlan().toString()
    assert plan.index("collect_list") < plan.index("partial_max")


def test_merge_records(spark):
    rows = [
        (1, 1, {"a": "1", "b": "1"}),
        (1, 2, {"b": "2", "c": "2"}),
        (2, 1, {"a": "9"}),
    ]
    df = spark.createDataFrame(rows, "w int, at int, record map<string,string>")
    got = {r.w: r.record for r in merge_records(df, keys=["w"], order="at").collect()}
    assert got == {1: {"a": "1", "b": "2", "c": "2"}, 2: {"a": "9"}}


def test_record_functions(spark):
    df = spark.range(1).select(
        F.array(
            pair("a", F.lit(1)), pair("b", F.lit(2)), pair("a", F.lit(3)), pair("a", F.lit(4))
        ).alias("p"),
        F.create_map(F.lit("time"), F.lit("t"), F.lit("x"), F.lit("1")).alias("m"),
        F.create_map(F.lit("x"), F.lit("2"), F.lit("y"), F.lit("3")).alias("n"),
    )
    row = df.select(
        last_wins(F.col("p")).alias("last"),
        pairs_to_map(F.col("p")).alias("map"),
        update_map(F.col("m"), F.col("n")).alias("updated"),
        without_key(F.col("m"), "time").alias("dropped"),
        one_entry_map(F.col("p")[0]).alias("one"),
        one_item_list(F.lit(5)).alias("list"),
        first_item(F.col("p"))["v"].alias("first"),
        first_item(F.array().cast("array<int>")).alias("none"),
    ).first()
    assert [tuple(x) for x in row["last"]] == [("b", "2"), ("a", "4")]
    assert row["map"] == {"a": "4", "b": "2"}
    assert row.updated == {"time": "t", "x": "2", "y": "3"}
    assert row.dropped == {"x": "1"} and row.one == {"a": "1"}
    assert (row["list"], row["first"], row["none"]) == ([5], "1", None)


@pytest.fixture
def gappy(make_readings):
    return make_readings(
        ("a", "10:00:01", 45, None, 12),
        ("b", "10:00:31.25", 46, None, 16),
        ("c", "10:01:00", None, 59, None),
        ("d", "10:02:00", None, None, None),
    )


def test_summary(gappy):
    rows = window_summary(window_means(gappy)).orderBy("window_start").collect()
    assert [f for f in rows[0].__fields__][2:] == SUMMARY_SCHEMA.names
    a, c, d = rows
    assert a.time == "2024-03-01 10:00:31.250000"
    assert (a.temp_mean, a.pressure_mean, a.m_mean) == (45.5, None, 14.0)
    assert (a.temp_status, a.pressure_status, a.m_status) == ("green", None, "yellow")
    assert a.pressure_notification is None and "motor power" in a.m_notification
    assert (c.pressure_status, c.temp_status) == ("yellow", None)
    assert (d.time, d.temp_mean, d.temp_status) == ("2024-03-01 10:02:00.000000", None, None)


def test_summary_time_may_be_the_reported_one(gappy):
    later = gappy.withColumn("sent", F.col("event_time") + F.expr("interval 1 day"))
    means = window_means(later, reported_time="sent")
    assert window_summary(means).orderBy("window_start").first().time.startswith("2024-03-02")


def test_nested(gappy):
    a = nested_alert(window_means(gappy)).orderBy("window_start").first()
    assert a.temperature.asDict() == {
        "mean": 45.5,
        "status": "temp_green",
        "notification": "The temperature is in the optimum range.",
    }
    assert a.motorpower.status == "mpower_yellow"
    assert a.pressure.mean is None and a.pressure.status is None
    fields = ["processingTime", "temperature", "pressure", "motorpower"]
    sent = encode_records(stamp(nested_alert(window_means(gappy))), fields)
    record = json.loads(sent.first().value.decode())
    assert list(record) == fields
    assert list(record["temperature"]) == ["mean", "status", "notification"]


def test_measure_pairs(gappy):
    rows = measure_pairs(window_means(gappy), with_time=True)
    per_window = {
        r.w: r.record
        for r in combine_pairs(explode_pairs(rows))
        .withColumn("w", F.date_format("window_start", "HH:mm"))
        .collect()
    }
    assert set(per_window) == {"10:00", "10:01", "10:02"}
    assert per_window["10:02"] == {"time": "2024-03-01 10:02:00.000000"}
    assert set(per_window["10:00"]) == {
        "time", "temp_mean", "temp_status", "temp_notification",
        "m_mean", "m_status", "m_notification",
    }
    assert per_window["10:00"]["temp_mean"] == "45.5"
    assert per_window["10:01"]["pressure_status"] == "yellow"


def test_alerts_without_values(gappy):
    rows = window_alerts(window_means(gappy))
    assert {(r.measure, r.colour) for r in rows.collect()} == {
        ("temperature", "green"), ("motor_power", "yellow"), ("pressure", "yellow"),
    }
    counts = {(r.measure, r.colour): r.n for r in alert_counts(rows).collect()}
    assert counts == {
        ("temperature", "green"): 1, ("motor_power", "yellow"): 1, ("pressure", "yellow"): 1,
    }


def test_outbox(spark):
    df = spark.createDataFrame(
        [("P", 48.5, "temp_red"), ("P", 58.0, "pressure_yellow"), ("P", 12.0, "mpower_green")],
        "processingTime string, mean double, status string",
    )
    red, yellow = alert_outbox(df, F.lit("R")).orderBy("status", ascending=False).collect()
    assert red.subject == "Critical failure detected! Please repare immediately"
    assert red.body == BODY_BREAK.join(["", "Status: temp_red", "Mean: 48.5", "Registry time: R"])
    assert yellow.subject == "Warning! Error detected!"
    assert yellow.body == BODY_BREAK.join(
        ["", "Status: pressure_yellow", "Processing time: P", "Registry time: R"]
    )
    assert "Registry time: 20" in alert_outbox(df).first().body


def test_cogroup_forms_agree(gappy):
    def text(df):
        return {
            (str(r.window_start), r.temperature, r.pressure, r.motor_power) for r in df.collect()
        }

    single = {m: window_mean(gappy, m) for m in MEASURES}
    joined = None
    for name, frame in single.items():
        frame = frame.select("window_start", "window_end", F.col("mean").alias(name))
        joined = frame if joined is None else joined.join(
            frame, ["window_start", "window_end"], "full_outer"
        )
    assert text(cogroup_measures(gappy)) == text(cogroup(single)) == text(joined)
    assert cogroup_measures(gappy).count() == 2


def test_measure_shapes(gappy):
    assert extract_measures(gappy, ["pressure"]).columns == ["id", "pressure"]
    assert stack_measures(gappy, keep=["id"]).count() == 12
    pairs = time_pairs(gappy)
    assert pairs.columns == ["k", "v"] and {r.k for r in pairs.collect()} == {"time"}
    keyed = keyed_records(gappy).filter("record.id = 'a'").first()
    assert keyed.key == keyed.record.time == "2024-03-01 10:00:01"
    assert union_all(gappy, gappy, gappy).count() == 12


def test_rounding(spark):
    df = spark.createDataFrame([("a", "2.675", "x", None)], "id string, a string, b string, c string")
    row = rounded_measures(df, ["a", "b", "c"]).first()
    # Half up on the decimal text, where a binary float would go down.
    assert (row.a, row.b, row.c) == (2.68, None, None)


@pytest.mark.parametrize("limit", [1_000_000, 4, 1])
def test_enrich_broadcast_and_split_agree_with_a_loop(spark, limit):
    rng = random.Random(5)
    rows = []
    for i in range(2000):
        # A third of the rows in one window, some without time, some without a value.
        second = rng.randrange(60) if i % 3 == 0 else rng.randrange(3600)
        at = None if i % 50 == 1 else second
        rows.append((str(i), at, None if i % 40 == 2 else float(i % 7)))
    df = spark.createDataFrame(rows, "id string, s int, temperature double").withColumn(
        "event_time", F.timestamp_seconds("s")
    )
    groups = {}
    for _, at, value in rows:
        if at is not None and value is not None:
            groups.setdefault(at // 60, []).append(value)
    expected = {
        id: math.fsum(groups[at // 60]) / len(groups[at // 60]) if at is not None else None
        for id, at, _ in rows
    }
    enriched = enrich_with_window(df, "temperature", broadcast_rows=limit)
    got = enriched.select("id", "window_mean").collect()
    assert len(got) == len(rows)
    for row in got:
        want = expected[row.id]
        assert row.window_mean == want or abs(row.window_mean - want) < 1e-9


def test_enrich_shuffles_readings_only_beyond_the_limit(spark, sf_dir):
    from sensorloom.plans.event_readings import readings_from_events

    readings = readings_from_events(spark, sf_dir)
    plan = enrich_with_window(readings, "temperature")._jdf.queryExecution()
    assert "BroadcastHashJoin" in plan.executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan.executedPlan().toString()
