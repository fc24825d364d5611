"""Alerts: long graded rows, their payloads, and the outbox of messages to send."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grading import DEFAULT_RANGES, StatusRange
from ..functions.scalars import json_payload, time_text
from ..schemas import READING_FIELDS
from .combine import grade
from .windows import WINDOW

# Subjects and the line break between the body's paragraphs.
RED_SUBJECT = "Critical failure detected! Please repare immediately"
YELLOW_SUBJECT = "Warning! Error detected!"
BODY_BREAK = "\n        \n        "


def window_alerts(
    means: DataFrame,
    ranges: Sequence[StatusRange] = DEFAULT_RANGES,
    keep: Sequence[str] = WINDOW,
) -> DataFrame:
    """One graded row per window and measure from the wide means; a measure without a mean
    gives none."""
    rows = means.unpivot(list(keep), [r.measure for r in ranges], "measure", "mean")
    return grade(rows, ranges)


def stamp(rows: DataFrame, moment: Column | None = None) -> DataFrame:
    """Add the processing time text; on a stream it is fixed per micro-batch."""
    return rows.withColumn(
        "processingTime", time_text(F.current_timestamp() if moment is None else moment)
    )


def encode_alerts(alerts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Stamped alerts as ``value``, the UTF-8 JSON payload."""
    payload = json_payload(*[F.col(c) for c in ("processingTime", "mean", "status", "notification")])
    return alerts.select(*keep, payload.alias("value"))


def message_id(*content: Column) -> Column:
    """A key that the same content has each time it is sent: the hash of its JSON text."""
    return F.sha2(json_payload(*content), 256)


def keyed_alerts(alerts: DataFrame) -> DataFrame:
    """Stamped alerts as ``key, value``: the payload, and the same key for the same alert of the
    same window. The processing time is no part of the key, as a repetition has another."""
    content = [F.col(c) for c in ("measure", "mean", "status", "notification")]
    key = message_id(time_text(F.col("window_start")).alias("window_start"), *content)
    return encode_alerts(alerts.withColumn("key", key), keep=["key"])


def without_repeats(messages: DataFrame, key: str = "key", delay: str | None = None) -> DataFrame:
    """Messages with each key once, for readers of a topic that got some of them twice.

    On a stream, repetitions are looked for as long as ``delay`` after the first by
    ``publish_time``; no state is kept beyond that. A message without a key is always kept.
    """
    own = messages.withColumn("_own", F.when(F.col(key).isNull(), F.uuid()))
    if not messages.isStreaming:
        return own.dropDuplicates([key, "_own"]).drop("_own")
    if delay is None:
        raise ValueError("a stream needs a delay")
    timed = own.withWatermark("publish_time", delay)
    return timed.dropDuplicatesWithinWatermark([key, "_own"]).drop("_own")


def encode_readings(readings: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Readings as ``value``, the UTF-8 JSON payload of a sensor message."""
    payload = json_payload(*[F.col(c) for c in READING_FIELDS])
    return readings.select(*keep, payload.alias("value"))


def encode_records(records: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Any merged record (columns, structs or maps) as one UTF-8 JSON payload per row."""
    return records.select(*keep, json_payload(*[F.col(c) for c in fields]).alias("value"))


def alert_outbox(
    alerts: DataFrame, registry_time: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Messages to send for stamped alerts: critical for red, a warning for yellow, no row for
    green. ``registry_time`` is the text of the moment of handling."""
    registered = time_text(F.current_timestamp()) if registry_time is None else registry_time
    red = F.col("status").contains("red")
    yellow = F.col("status").contains("yellow")

    def body(*lines: tuple[str, Column]) -> Column:
        parts = [part for label, value in lines for part in (F.lit(BODY_BREAK + label), value)]
        return F.concat(*parts)

    status = ("Status: ", F.col("status"))
    registry = ("Registry time: ", registered)
    return alerts.filter(red | yellow).select(
        *keep,
        "status",
        F.when(red, RED_SUBJECT).otherwise(YELLOW_SUBJECT).alias("subject"),
        F.when(red, body(status, ("Mean: ", F.col("mean").cast("string")), registry))
        .otherwise(body(status, ("Processing time: ", F.col("processingTime")), registry))
        .alias("body"),
    )
