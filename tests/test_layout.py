"""Batch jobs and streams on the same paths and tables, repeated runs, and counts that last."""

import time

import pytest
from pyspark.sql import functions as F

from sensorloom.operators.alerts import encode_readings, keyed_alerts, stamp, window_alerts, without_repeats
from sensorloom.operators.windows import window_means
from sensorloom.plans.job import Settings, Sinks, run_batch
from sensorloom.schemas import ARCHIVE_SCHEMA
from sensorloom.sinks.metrics import totals
from sensorloom.sinks.tables import Sink, conform
from sensorloom.sources.messages import as_messages, parse_messages, read_messages
from sensorloom.streaming.job import run_to_end, start_job

DRAIN = {"availableNow": True}
OUTPUTS = ("archive", "alerts", "merged", "summary", "outbox", "metrics", "rejects", "counts")


def bag(df):
    return sorted(map(str, df.collect()))


def send(readings, folder, *raw):
    spark = readings.sparkSession
    rows = encode_readings(readings).withColumnRenamed("value", "data")
    if raw:
        rows = rows.unionByName(spark.createDataFrame([(bytearray(p),) for p in raw], "data binary"))
    rows.coalesce(1).write.mode("append").parquet(str(folder))


@pytest.fixture
def minutes(make_readings):
    """Readings of so many minutes from an hour on, one a minute."""

    def make(hour, count):
        return make_readings(*[(f"{hour}-{i}", f"{hour:02}:{i:02}:00", 45, 60, 16) for i in range(count)])

    return make


def sinks_in(folder, kind):
    if kind == "path":
        return Sinks(**{o: Sink(path=str(folder / o)) for o in OUTPUTS})
    mark = time.time_ns()
    return Sinks(
        **{o: Sink(table=f"t_{o}_{mark}", options={"path": str(folder / o)}) for o in OUTPUTS}
    )


def drop(spark, sinks):
    for output in OUTPUTS:
        if (sink := getattr(sinks, output)) and sink.table:
            spark.sql(f"DROP TABLE IF EXISTS {sink.table}")


@pytest.mark.parametrize("kind", ["path", "table"])
@pytest.mark.parametrize("order", [("batch", "stream"), ("stream", "batch")])
def test_batch_and_stream_write_side_by_side(spark, minutes, tmp_path, kind, order):
    send(minutes(1, 5), tmp_path / "old", b"broken")
    send(minutes(3, 4), tmp_path / "new", b"{}", b'{"id": "untimed"}')
    sinks = sinks_in(tmp_path / "out", kind)

    def batch():
        run_batch(read_messages(spark, path=str(tmp_path / "old")), sinks, run_id="old's")

    def stream():
        source = read_messages(spark, path=str(tmp_path / "new"), streaming=True)
        run_to_end(start_job(source, sinks, Settings(), str(tmp_path / "cp"), DRAIN))

    for job in order:
        {"batch": batch, "stream": stream}[job]()

    def found():
        spark.catalog.clearCache()
        return {o: getattr(sinks, o).read(spark).count() for o in OUTPUTS}

    # the stream's last window is still open
    assert found() == {
        "archive": 10, "alerts": 24, "merged": 8, "summary": 8, "outbox": 8, "metrics": 6,
        "rejects": 2, "counts": 2,
    }
    assert tuple(totals(sinks.counts.read(spark)).first()) == (12, 2, 1)
    archive = sinks.archive.read(spark)
    assert archive.columns == ARCHIVE_SCHEMA.names
    expected = minutes(1, 5).unionByName(minutes(3, 4))
    assert bag(archive.where("id <> 'untimed'")) == bag(conform(expected, ARCHIVE_SCHEMA))

    before = found()
    batch()
    stream()
    assert found() == before
    run_batch(read_messages(spark, path=str(tmp_path / "old")), sinks)
    assert found()["archive"] == before["archive"] + 5
    drop(spark, sinks)


def test_a_repetition_replaces_partitions_of_its_own_alone(spark, tmp_path):
    sink = Sink(path=str(tmp_path / "t"), partition_by=("day",))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
    for run, batch in (("x", 0), ("x", 1), ("y", 0), ("x", 1)):
        sink.put_batch(rows, run, batch)
    sink.append(rows)
    assert sink.read(spark).groupBy("day").count().count() == 2
    assert sink.read(spark).count() == 8
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["day=a", "day=b"]


def test_a_repetition_in_a_table_by_day(spark, tmp_path):
    name = f"by_day_{time.time_ns()}"
    sink = Sink(table=name, options={"path": str(tmp_path / "t")}, partition_by=("day",))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
    sink.put_batch(rows, "x", 0)
    sink.put_batch(rows, "x", 1)
    sink.put_batch(rows.where("v = 1"), "x", 1)
    assert sorted(map(tuple, sink.read(spark).collect())) == [(1, "a"), (1, "a"), (2, "b")]
    spark.sql(f"DROP TABLE {name}")


def test_a_table_without_run_columns_is_appended_to(spark, tmp_path):
    name = f"plain_{time.time_ns()}"
    rows = spark.createDataFrame([(1,)], "v int")
    rows.write.option("path", str(tmp_path / "t")).saveAsTable(name)
    Sink(table=name).put_batch(rows, "x", 0)
    assert spark.table(name).count() == 2 and spark.table(name).columns == ["v"]
    spark.sql(f"DROP TABLE {name}")


def test_a_sink_without_a_place_cannot_be_read(spark):
    with pytest.raises(ValueError, match="console"):
        Sink("console").read(spark)


def test_counts_of_a_long_stream_are_exact(spark, make_readings, tmp_path):
    """More batches than Spark keeps progress of."""
    rows = spark.range(150 * 4).select(
        (F.col("id") % 150).alias("file"),
        F.when(F.col("id") < 150, F.lit("junk"))
        .when(F.col("id") < 300, F.lit('{"id": "no time"}'))
        .otherwise(F.lit('{"id": "a", "time": "2024-03-01 10:00:00", "pressure": 1}'))
        .cast("binary").alias("data"),
    )
    rows.repartition(8, "file").write.partitionBy("file").parquet(str(tmp_path / "parts"))
    source = read_messages(
        spark, path=f"{tmp_path}/parts/*", options={"maxFilesPerTrigger": "1"}, streaming=True
    )
    counts = Sink(path=str(tmp_path / "counts"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        queries = start_job(source, Sinks(counts=counts), Settings(), str(tmp_path / "cp"), DRAIN)
        run_to_end(queries)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert counts.read(spark).count() == 150
    assert tuple(totals(counts.read(spark)).first()) == (600, 150, 150)
    assert len(queries["readings"].recentProgress) <= 5


def test_jobs_on_no_messages(spark, tmp_path):
    sinks = sinks_in(tmp_path, "path")
    nothing = as_messages(spark.createDataFrame([], "data binary"))
    run_batch(nothing, sinks)
    assert tuple(totals(sinks.counts.read(spark)).first()) == (0, 0, 0)
    assert sinks.archive.read(spark, ARCHIVE_SCHEMA).count() == 0


def test_readings_are_parsed_once_for_archive_rejects_and_counts(spark, minutes, tmp_path):
    """Two readers of the source: the readings and the windows."""
    send(minutes(1, 3), tmp_path / "in")
    source = read_messages(spark, path=str(tmp_path / "in"), streaming=True)
    queries = start_job(source, sinks_in(tmp_path / "out", "path"), Settings(), str(tmp_path / "cp"), DRAIN)
    run_to_end(queries)
    assert sorted(queries) == ["readings", "windows"]


def test_a_repeated_batch_carries_the_same_keys(spark, make_readings):
    alerts = window_alerts(window_means(make_readings(("a", "10:00:01", 45, 60, 16), ("b", "10:01:00", 45, 60, 11))))
    first = keyed_alerts(stamp(alerts, F.lit("2024-01-01 00:00:00").cast("timestamp")))
    again = keyed_alerts(stamp(alerts, F.lit("2024-01-01 00:00:09").cast("timestamp")))
    assert first.columns == ["key", "value"] and bag(first.select("key")) == bag(again.select("key"))
    assert not {r.value for r in first.collect()} & {r.value for r in again.collect()}
    assert first.select("key").distinct().count() == 6
    assert without_repeats(first.unionByName(again)).count() == 6
    nameless = first.union(again).withColumn("key", F.lit(None).cast("string"))
    assert without_repeats(nameless).count() == 12


def test_a_stream_drops_repeated_messages(spark, tmp_path):
    def arrive(*rows):
        spark.createDataFrame(rows, "key string, minute int").select(
            "key", F.timestamp_seconds(F.col("minute") * 60).alias("publish_time")
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def drain():
        stream = spark.readStream.schema("key string, publish_time timestamp").parquet(str(tmp_path / "in"))
        kept = without_repeats(stream, delay="5 minutes")
        query = kept.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        query.option("checkpointLocation", str(tmp_path / "cp")).trigger(**DRAIN).start().awaitTermination()
        return sorted((r.key or "-") for r in spark.read.parquet(str(tmp_path / "out")).collect())

    arrive(("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1))
    assert drain() == ["-", "-", "a", "b"]
    arrive(("a", 3), ("c", 3))
    assert drain() == ["-", "-", "a", "b", "c"]
    with pytest.raises(ValueError, match="delay"):
        without_repeats(spark.readStream.schema("key string, publish_time timestamp").parquet(str(tmp_path / "in")))


@pytest.mark.parametrize(
    "faulty",
    [
        b'{"id": "a"} junk {"b": 1}', b'{"id": "a"}{"id": "b"}', b'{"id": "a"},{"id": "b"}',
        b'{"id": "a"},"x":{"b": 1}', b'{"id": "a"}],"x":[{"b": 1}', b'{"id": "a"}] , [{"b": 1}',
        b'{"id": "a"},"r":{"id": "b"}', b'{"id": "a"} }', b'{"foo": 1}', b"{}", b'{"id": null}',
        b'{"id": "a"},"end":true,"x":{"y":1}', b'\xa0{"id": "a"}',
    ],
)
def test_what_follows_an_object_or_holds_no_field_is_rejected(spark, faulty):
    (row,) = parse_messages(spark.createDataFrame([(bytearray(faulty),)], "data binary")).collect()
    assert row._corrupt is not None and row.id is None


@pytest.mark.parametrize(
    "good",
    [
        b'{"id": "a", "more": {"x": [1, {"y": 2}]}}', b' {"id": "a", "t": "}{"} \n',
        b'{"id": "a", "t": "}"}', b'{"more": [{}, {}], "id": "a"}', b'{"id": "a", "end": {"end": false}}',
    ],
)
def test_braces_inside_of_an_object_are_no_fault(spark, good):
    (row,) = parse_messages(spark.createDataFrame([(bytearray(good),)], "data binary")).collect()
    assert row._corrupt is None and row.id == "a"


def test_the_same_bytes_whatever_zone_the_session_has(spark, tmp_path):
    """02:30 does not exist in Berlin on that day, and 02:30 in October exists twice."""
    times = ["2024-03-31 02:30:00.5", "2024-10-27 02:30:00", "2024-10-27 01:59:59.999999", "2024-07-01 12:00:00"]
    payloads = [f'{{"id": "{i}", "time": "{t}", "pressure": 61, "temperature": 45}}' for i, t in enumerate(times)]
    rows = spark.createDataFrame([(p,) for p in payloads], "p string").select(F.col("p").cast("binary").alias("data"))
    found = {}
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            place = tmp_path / zone.replace("/", "-")
            sinks = Sinks(
                archive=Sink(path=str(place / "archive"), partition_by=("event_date",)),
                summary=Sink(path=str(place / "summary")),
            )
            run_batch(as_messages(rows), sinks)
            seen = parse_messages(rows).select(F.unix_micros("event_time").alias("at"))
            keys = keyed_alerts(stamp(window_alerts(window_means(parse_messages(rows))))).select("key")
            found[zone] = [
                bag(sinks.archive.read(spark).withColumn("event_date", F.col("event_date").cast("string"))),
                bag(sinks.summary.read(spark)), bag(seen), bag(keys),
            ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found["UTC"] == found["Europe/Berlin"] == found["America/New_York"]
    assert "2024-03-31 02:30:00.500000" in str(found["UTC"][1])
