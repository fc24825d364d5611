import json
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sensorloom.operators.alerts import alert_outbox, encode_readings, stamp, window_alerts
from sensorloom.operators.combine import window_summary
from sensorloom.operators.joins import cogroup_measures
from sensorloom.operators.windows import first_reading_per_window, tumbling_counts, window_means
from sensorloom.plans.event_readings import readings_from_events
from sensorloom.plans.job import Settings, Sinks, merged_messages, run_batch
from sensorloom.plans.publish import publish_history
from sensorloom.plans.views import dashboard_series
from sensorloom.schemas import ARCHIVE_SCHEMA, READING_FIELDS, SUMMARY_SCHEMA
from sensorloom.session import ensure_checkpoint_dir
from sensorloom.sinks.metrics import observe_parsed, totals
from sensorloom.sinks.tables import Sink, conform, print_rows
from sensorloom.sources.history import read_readings_csv
from sensorloom.sources.messages import (
    as_messages,
    decode_envelope,
    parse_alerts,
    parse_messages,
    read_messages,
)
from sensorloom.streaming.job import checkpoint_root, run_to_end, start_job
from sensorloom.streaming.submit import arguments, main, settings_of, sink_of, sinks_of

DRAIN = {"availableNow": True}
OUTPUTS = ("archive", "alerts", "merged", "summary", "outbox", "metrics", "rejects", "counts")
EXACT = Settings(places=6)


def send(readings, folder, extra=()):
    """Write readings, and raw payloads, as one file of messages."""
    spark = readings.sparkSession
    rows = encode_readings(readings).withColumnRenamed("value", "data")
    if extra:
        raw = spark.createDataFrame([(bytearray(p),) for p in extra], "data binary")
        rows = rows.unionByName(raw)
    rows.coalesce(1).write.mode("append").parquet(str(folder))


def sinks_in(folder, **changes):
    places = {o: Sink(path=str(folder / o)) for o in OUTPUTS}
    return Sinks(**{**places, **changes})


def read(spark, folder, output, columns="*"):
    df = spark.read.parquet(str(folder / output))
    return df.drop("query_id", "batch_id") if columns == "*" else df.select(*columns)


def bag(df):
    return sorted(map(str, df.collect()))


def alerts_of(spark, folder):
    return bag(parse_alerts(read(spark, folder, "alerts")).select("mean", "status", "notification"))


@pytest.fixture
def sentinel(make_readings):
    # Ten minutes after the last real row; its own window stays open.
    return make_readings(("sentinel", "23:59:00", 1, 1, 1))


@pytest.fixture
def day(spark, sf_dir):
    """All event readings, their dates moved to one day so that a sentinel can follow them."""
    readings = readings_from_events(spark, sf_dir)
    seconds = F.pmod(F.unix_micros("event_time"), F.lit(23 * 3600 * 1_000_000))
    moment = F.timestamp_micros(F.lit(1709251200_000000) + seconds)
    return readings.withColumn("event_time", moment).withColumn(
        "time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def test_batch_job(spark, day, tmp_path):
    send(day, tmp_path / "in", [b"broken"])
    run_batch(read_messages(spark, path=str(tmp_path / "in")), sinks_in(tmp_path), EXACT)
    means = window_means(day, places=6)
    expected = window_alerts(means)
    assert alerts_of(spark, tmp_path) == bag(expected.select("mean", "status", "notification"))
    assert bag(read(spark, tmp_path, "archive")) == bag(conform(day, ARCHIVE_SCHEMA))
    assert bag(read(spark, tmp_path, "summary")) == bag(
        conform(window_summary(means), SUMMARY_SCHEMA)
    )
    merged = [json.loads(r.value.decode()) for r in read(spark, tmp_path, "merged").collect()]
    assert len(merged) == means.count()
    assert list(merged[0]) == ["processingTime", "temperature", "pressure", "motorpower"]
    assert sorted(m["motorpower"]["status"] for m in merged) == sorted(
        r.status for r in expected.filter("measure = 'motor_power'").collect()
    )
    assert read(spark, tmp_path, "outbox").count() == expected.filter("colour <> 'green'").count()
    assert bag(read(spark, tmp_path, "metrics")) == bag(
        expected.groupBy("measure", "colour").agg(F.count("*").alias("n"))
    )
    assert [r._corrupt for r in read(spark, tmp_path, "rejects").collect()] == ["broken"]
    series = dashboard_series(read(spark, tmp_path, "archive"), places=6)
    assert bag(series) == bag(means.select("window_start", "window_end", "temperature", "pressure",
                                           "motor_power"))


def test_flat_merged_message(spark, make_readings):
    means = stamp(window_means(make_readings(("a", "10:00:01", 45, None, 16))), F.timestamp_seconds(F.lit(0)))
    sent = merged_messages(means, Settings(merged="flat")).collect()
    assert [json.loads(r.value.decode()) for r in sent] == [
        {
            "time": "2024-03-01 10:00:01.000000",
            "temp_mean": 45.0,
            "pressure_mean": None,
            "m_mean": 16.0,
            "temp_status": "green",
            "pressure_status": None,
            "m_status": "red",
            "temp_notification": "The temperature is in the optimum range.",
            "pressure_notification": None,
            "m_notification": "Error! Machine is not working properly, the motor power is way out "
            "of the optimum range. Help is needed.",
            "mpower_processingTime": "1970-01-01 00:00:00.000000",
        }
    ]


def test_job_by_the_time_of_the_broker(spark, make_readings, tmp_path):
    rows = encode_readings(make_readings(("a", "10:00:01", 45, 60, 11), ("b", "09:00:00", 47, 60, 11)))
    arrived = rows.select(
        F.col("value").alias("data"), F.lit("2024-03-01 12:00:30").cast("timestamp").alias("publish_time")
    )
    run_batch(as_messages(arrived), sinks_in(tmp_path), Settings(event_time="publish_time"))
    (row,) = read(spark, tmp_path, "summary").collect()
    assert (row.time, float(row.temp_mean)) == ("2024-03-01 10:00:01.000000", 46.0)


def test_published_history_reaches_the_archive(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        "Par agitador,P abs SW mb,Tª SW\n12,60.5,45\n13,61,46\n", encoding="utf-8"
    )
    history = read_readings_csv(spark, str(tmp_path / "h.csv"))
    publish_history(history, Sink(path=str(tmp_path / "topic")))
    messages = as_messages(spark.read.parquet(str(tmp_path / "topic")))
    run_batch(messages, sinks_in(tmp_path))
    rows = read(spark, tmp_path, "archive").select("motor_power", "pressure", "temperature")
    assert sorted(tuple(map(float, r)) for r in rows.collect()) == [(12, 60.5, 45), (13, 61, 46)]
    assert len(alerts_of(spark, tmp_path)) == 3


def test_outbox_follows_the_alert_messages(spark, make_readings, tmp_path):
    """The alert messages of one job, in envelopes, are the input of the outbox stream."""
    send(make_readings(("a", "10:00:01", 45, 59, 16)), tmp_path / "in")
    run_batch(read_messages(spark, path=str(tmp_path / "in")), sinks_in(tmp_path))
    read(spark, tmp_path, "alerts").select(F.base64("value").alias("data")).write.parquet(
        str(tmp_path / "events")
    )
    events = spark.readStream.schema("data string").parquet(str(tmp_path / "events"))
    outbox = alert_outbox(decode_envelope(events))
    query = Sink(path=str(tmp_path / "mail")).start(outbox, str(tmp_path / "cp"), "mail", DRAIN)
    query.awaitTermination()
    got = {(r.status, r.subject) for r in read(spark, tmp_path, "mail").collect()}
    assert got == {
        ("pressure_yellow", "Warning! Error detected!"),
        ("mpower_red", "Critical failure detected! Please repare immediately"),
    }


def test_stream_equals_batch(spark, day, sentinel, tmp_path):
    # Several files in time order, then the sentinel.
    for part in range(3):
        hours = F.hour("event_time")
        send(day.filter((hours >= part * 8) & (hours < part * 8 + 8)), tmp_path / "in")
    send(sentinel, tmp_path / "in", [b"broken", b"\xff"])
    source = read_messages(
        spark, path=str(tmp_path / "in"), options={"maxFilesPerTrigger": "1"}, streaming=True
    )
    sinks = sinks_in(tmp_path)
    queries = start_job(source, sinks, EXACT, str(tmp_path / "cp"), DRAIN, "equal")
    run_to_end(queries)
    expected = window_alerts(window_means(day, places=6))
    assert alerts_of(spark, tmp_path) == bag(expected.select("mean", "status", "notification"))
    assert bag(read(spark, tmp_path, "archive")) == bag(
        conform(day.unionByName(sentinel), ARCHIVE_SCHEMA)
    )
    assert bag(read(spark, tmp_path, "summary")) == bag(
        conform(window_summary(window_means(day, places=6)), SUMMARY_SCHEMA)
    )
    assert read(spark, tmp_path, "outbox").count() == expected.filter("colour <> 'green'").count()
    assert read(spark, tmp_path, "rejects").count() == 2
    folders = [p.name for p in (tmp_path / "alerts").iterdir() if p.is_dir()]
    assert folders == [f"query_id={queries['windows'].id}"]
    counted = totals(sinks.counts.read(spark)).first()
    assert tuple(counted) == (day.count() + 3, 2, 0)

    # A restart from the checkpoints finds nothing new and writes nothing twice.
    before = {o: read(spark, tmp_path, o).count() for o in OUTPUTS}
    run_to_end(start_job(source, sinks, EXACT, str(tmp_path / "cp"), DRAIN, "equal"))
    assert {o: read(spark, tmp_path, o).count() for o in OUTPUTS} == before


def test_late_row_is_archived_but_changes_no_mean(spark, make_readings, tmp_path):
    def drain():
        source = read_messages(spark, path=str(tmp_path / "in"), streaming=True)
        run_to_end(start_job(source, sinks_in(tmp_path), EXACT, str(tmp_path / "cp"), DRAIN, "late"))

    send(make_readings(("a", "10:00:01", 45, 60, 11), ("b", "10:20:00", 45, 60, 11)), tmp_path / "in")
    drain()
    first = alerts_of(spark, tmp_path)
    assert len(first) == 3
    send(make_readings(("late", "10:00:02", 99, 99, 99), ("c", "10:40:00", 1, 1, 1)), tmp_path / "in")
    drain()
    rows = parse_alerts(read(spark, tmp_path, "alerts")).collect()
    assert sorted(r.mean for r in rows) == [11.0, 11.0, 45.0, 45.0, 60.0, 60.0]
    assert {r.id for r in read(spark, tmp_path, "archive").collect()} == {"a", "b", "c", "late"}


def test_delay_keeps_a_window_open(spark, make_readings, tmp_path):
    def drain():
        source = read_messages(spark, path=str(tmp_path / "in"), streaming=True)
        settings = Settings(delay="30 minutes")
        run_to_end(start_job(source, sinks_in(tmp_path), settings, str(tmp_path / "cp"), DRAIN, "open"))

    send(make_readings(("a", "10:00:01", 44, 60, 11), ("b", "10:20:00", 45, 60, 11)), tmp_path / "in")
    drain()
    assert not (tmp_path / "alerts").exists()
    send(make_readings(("c", "10:00:02", 46, 60, 11), ("d", "10:45:00", 1, 1, 1)), tmp_path / "in")
    drain()
    means = {r.mean for r in parse_alerts(read(spark, tmp_path, "alerts")).collect()}
    assert means == {45.0, 60.0, 11.0}


def test_repeated_batch_replaces_its_output(spark, tmp_path):
    sink = Sink(path=str(tmp_path / "out"))
    for _ in range(2):
        sink.put_batch(spark.range(3), "q", 7)
    sink.put_batch(spark.range(2), "q", 8)
    sink.put_batch(spark.range(5), "other", 7)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_restarted_batch_is_written_once(spark, day, sentinel, tmp_path):
    """A batch whose commit is lost runs again under the same number."""
    send(day, tmp_path / "in")
    send(sentinel, tmp_path / "in")
    source = read_messages(
        spark, path=str(tmp_path / "in"), options={"maxFilesPerTrigger": "1"}, streaming=True
    )

    def drain():
        run_to_end(start_job(source, sinks_in(tmp_path, archive=None, rejects=None), EXACT,
                             str(tmp_path / "cp"), DRAIN, "again"))

    drain()
    once = alerts_of(spark, tmp_path)
    commits = tmp_path / "cp" / "again" / "windows" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    drain()
    assert alerts_of(spark, tmp_path) == once


@pytest.mark.parametrize(
    "operator",
    [
        lambda df: tumbling_counts(df, delay="0 seconds"),
        lambda df: first_reading_per_window(df, delay="0 seconds"),
        lambda df: cogroup_measures(df, delay="0 seconds", places=6),
    ],
)
def test_other_operators_stream(spark, day, sentinel, tmp_path, operator):
    day.write.parquet(str(tmp_path / "in"))
    sentinel.write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(day.schema).parquet(str(tmp_path / "in"))
    query = (
        operator(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(**DRAIN).start()
    )
    query.awaitTermination()
    assert bag(spark.read.parquet(str(tmp_path / "out"))) == bag(operator(day))


def test_archive_by_date(spark, day, tmp_path):
    send(day, tmp_path / "in")
    archive = Sink(path=str(tmp_path / "archive"), partition_by=("event_date",))
    run_batch(read_messages(spark, path=str(tmp_path / "in")), Sinks(archive=archive))
    assert [p.name for p in (tmp_path / "archive").iterdir() if p.is_dir()] == [
        "event_date=2024-03-01"
    ]
    assert read(spark, tmp_path, "archive", READING_FIELDS).count() == day.count()


def test_append_to_a_table(spark, make_readings, tmp_path):
    name = f"archive_{time.time_ns()}"
    sink = Sink(table=name, options={"path": str(tmp_path / "t")})
    rows = conform(make_readings(("a", "10:00:01", 45, 60, float("nan"))), ARCHIVE_SCHEMA)
    sink.append(rows)
    sink.append(rows)
    table = spark.table(name)
    assert table.schema == ARCHIVE_SCHEMA and table.count() == 2
    assert table.first().motor_power is None and str(table.first().temperature) == "45.000000000"
    spark.sql(f"drop table {name}")


def test_observation_of_a_table(spark):
    rows = [(bytearray(b'{"id": "a"}'),), (bytearray(b"x"),)]
    df = spark.createDataFrame(rows, "data binary")
    seen = Observation("parsed")
    observe_parsed(parse_messages(df), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"messages": 2, "rejected": 1, "untimed": 1}


def test_print_sink(spark, sentinel, tmp_path, capsys):
    assert print_rows(sentinel, 20) is None
    assert "sentinel" in capsys.readouterr().out
    sentinel.write.parquet(str(tmp_path / "in"))
    query = print_rows(spark.readStream.schema(sentinel.schema).parquet(str(tmp_path / "in")), 20)
    query.processAllAvailable()
    assert query.lastProgress.numInputRows == 1
    query.stop()


def test_a_format_alone_asks_for_an_output_and_none_is_an_error():
    args, _ = arguments(["--alerts-format", "console", "--places", "3"])
    assert sinks_of(args) == Sinks(alerts=Sink("console"))
    assert settings_of(args).places == 3
    with pytest.raises(SystemExit):
        main(["--source-path", "/in"])


class Cluster:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, named=None, current=None, master="yarn"):
        self.named, self.current, self.master = named, current, master
        self.conf = self.sparkContext = self.sparkSession = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, folder):
        self.current = folder


def test_shared_folder():
    assert checkpoint_root(Cluster("/shared"), "/mine/") == "/mine"
    assert checkpoint_root(Cluster("/shared"), None) == "/shared"
    with pytest.raises(ValueError):
        checkpoint_root(Cluster(), None)
    assert ensure_checkpoint_dir(Cluster("/shared")) == "/shared"
    assert ensure_checkpoint_dir(Cluster("/shared", "/shared/run-1")) == "/shared/run-1"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Cluster())
    assert ensure_checkpoint_dir(Cluster(master="local[2]")).count("sensorloom-checkpoint-")


def test_arguments(tmp_path):
    fields = [{"name": "id", "type": "STRING"}]
    (tmp_path / "s.json").write_text(json.dumps({"fields": fields}))
    args, rest = arguments(
        ["--source-format", "kafka", "--source-option", "subscribe=readings",
         "--alerts-format", "kafka", "--alerts-option", "topic=alerts",
         "--archive-path", "/a", "--archive-by-date", "--archive-schema", str(tmp_path / "s.json"),
         "--window", "5 minutes", "--delay", "10 seconds", "--spark.x=y"]
    )
    assert rest == ["--spark.x=y"]
    assert sink_of(args, "alerts") == Sink("kafka", options={"topic": "alerts"})
    assert sink_of(args, "archive") == Sink(path="/a", partition_by=("event_date",))
    assert sink_of(args, "summary") is None
    settings = settings_of(args)
    assert (settings.length, settings.delay) == ("5 minutes", "10 seconds")
    assert settings.archive_schema.names == ["id"]


@pytest.mark.parametrize("mode", [["--batch"], ["--trigger", "available-now"]])
def test_command_line(spark, make_readings, tmp_path, mode):
    send(make_readings(("a", "10:00:01", 45, 60, 11), ("b", "10:20:00", 1, 1, 1)), tmp_path / "in")
    main(
        ["--source-path", str(tmp_path / "in"), "--alerts-path", str(tmp_path / "alerts"),
         "--archive-path", str(tmp_path / "archive"), "--checkpoint", str(tmp_path / "cp"), *mode]
    )
    assert read(spark, tmp_path, "archive").count() == 2
    assert len(alerts_of(spark, tmp_path)) == (6 if mode == ["--batch"] else 3)
