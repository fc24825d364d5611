"""What the job computes and writes, shared by its batch and its streaming form."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.grading import DEFAULT_RANGES, StatusRange
from ..functions.scalars import parse_time, time_text
from ..operators.alerts import (
    alert_outbox,
    encode_records,
    keyed_alerts,
    message_id,
    stamp,
    window_alerts,
)
from ..operators.combine import nested_alert, window_summary
from ..operators.windows import WINDOW, WINDOW_LENGTH, window_means
from ..schemas import ARCHIVE_SCHEMA, SUMMARY_SCHEMA
from ..session import ensure_checkpoint_dir
from ..sinks.metrics import alert_counts, counts_of, observe_parsed
from ..sinks.tables import Sink, conform, with_date
from ..sources.messages import bad_readings, good_readings, parse_messages


@dataclass(frozen=True)
class Settings:
    """What is computed. ``merged`` is the form of the one message per window: ``nested``, an
    object per measure, or ``flat``, the fields of the summary and, under ``flat_time``, the
    processing time."""

    ranges: tuple[StatusRange, ...] = DEFAULT_RANGES
    length: str = WINDOW_LENGTH
    delay: str = "0 seconds"
    event_time: str = "time"
    places: int | None = None
    merged: str = "nested"
    flat_time: str = "mpower_processingTime"
    archive_schema: T.StructType = ARCHIVE_SCHEMA
    summary_schema: T.StructType = SUMMARY_SCHEMA


@dataclass(frozen=True)
class Sinks:
    """Where it goes; an output without a sink is not computed. ``metrics`` has the number of means
    by colour, ``counts`` that of messages, rejected ones, and readings without a time."""

    archive: Sink | None = None
    alerts: Sink | None = None
    merged: Sink | None = None
    summary: Sink | None = None
    outbox: Sink | None = None
    metrics: Sink | None = None
    rejects: Sink | None = None
    counts: Sink | None = None

    def read(self) -> bool:
        return any((self.archive, self.rejects, self.counts))

    def windowed(self) -> bool:
        return any((self.alerts, self.merged, self.summary, self.outbox, self.metrics))


def archive_rows(parsed: DataFrame, settings: Settings, sink: Sink) -> DataFrame:
    """Readings as rows of the archive table, with the day if the table is laid out by it."""
    rows = conform(good_readings(parsed), settings.archive_schema)
    return with_date(rows) if "event_date" in sink.partition_by else rows


def stamped_means(parsed: DataFrame, settings: Settings, watermark: bool) -> DataFrame:
    """The wide means of every window, stamped: all window outputs derive from these rows.

    The last time of a window is that of its readings, whichever time the windows follow.
    """
    readings, reported = good_readings(parsed), None
    if settings.event_time == "publish_time":
        reported = "reported_time"
        readings = readings.withColumn(reported, parse_time(F.col("time")))
    means = window_means(
        readings,
        [r.measure for r in settings.ranges],
        settings.length,
        delay=settings.delay if watermark else None,
        places=settings.places,
        reported_time=reported,
    )
    return stamp(means)


def merged_messages(means: DataFrame, settings: Settings) -> DataFrame:
    """All measures of a window in one payload, in place of one payload per measure, with a key
    that a repetition has too."""
    window, time = time_text(F.col("window_start")).alias("window_start"), "processingTime"
    keep = ["window_start", time]
    if settings.merged == "flat":
        records = window_summary(means, settings.ranges, keep=keep)
        fields = [c for c in records.columns if c not in keep]
        sent = [*fields, settings.flat_time]
        records = records.withColumnRenamed(time, settings.flat_time)
    else:
        records = nested_alert(means, settings.ranges, keep=keep)
        fields = [c for c in records.columns if c not in keep]
        sent = [time, *fields]
    key = message_id(window, *[F.col(c) for c in fields])
    return encode_records(records.withColumn("key", key), sent, keep=["key"])


def window_outputs(
    means: DataFrame, settings: Settings, sinks: Sinks
) -> Iterator[tuple[Sink, DataFrame]]:
    """Each requested window output with its sink. ``means`` is read once per output."""
    alerts = window_alerts(means, settings.ranges, keep=(*WINDOW, "processingTime"))
    if sinks.alerts:
        yield sinks.alerts, keyed_alerts(alerts)
    if sinks.merged:
        yield sinks.merged, merged_messages(means, settings)
    if sinks.summary:
        yield sinks.summary, conform(
            window_summary(means, settings.ranges, keep=()), settings.summary_schema
        )
    if sinks.outbox:
        yield sinks.outbox, alert_outbox(alerts, keep=(*WINDOW, "measure"))
    if sinks.metrics:
        yield sinks.metrics, alert_counts(alerts)


def write_readings(
    parsed: DataFrame, sinks: Sinks, settings: Settings, query_id: str, batch_id: int
) -> None:
    """Archive, rejects and counts of one batch of parsed messages, parsed once.

    The counts are observed by the first write, whose tasks each count once however often they are
    tried, and written under the number of the batch.
    """
    seen = Observation()
    rows = observe_parsed(parsed, seen)
    twice = bool(sinks.archive and sinks.rejects)
    if twice:
        rows.persist()
    try:
        if sinks.archive:
            archive = archive_rows(rows, settings, sinks.archive)
            sinks.archive.put_batch(archive, query_id, batch_id)
        if sinks.rejects:
            sinks.rejects.put_batch(bad_readings(rows), query_id, batch_id)
        if sinks.counts:
            if not (sinks.archive or sinks.rejects):
                rows.write.format("noop").mode("overwrite").save()
            counts = counts_of(parsed.sparkSession, seen)
            sinks.counts.put_batch(counts.coalesce(1), query_id, batch_id)
    finally:
        if twice:
            rows.unpersist()


def run_batch(
    messages: DataFrame, sinks: Sinks, settings: Settings = Settings(), run_id: str | None = None
) -> None:
    """The job on a table of messages.

    The messages are read once for the readings and once for the windows. The means are
    checkpointed in the shared folder, one row per window, before the outputs are written. A run
    that is repeated under its ``run_id`` replaces what it wrote; without one, every run is new.
    """
    run_id = run_id or uuid.uuid4().hex
    parsed = parse_messages(messages, settings.event_time)
    if sinks.read():
        write_readings(parsed, sinks, settings, run_id, 0)
    if sinks.windowed():
        ensure_checkpoint_dir(messages.sparkSession)
        means = stamped_means(parsed, settings, watermark=False).checkpoint()
        for sink, rows in window_outputs(means, settings, sinks):
            sink.put_batch(rows, run_id, 0)
