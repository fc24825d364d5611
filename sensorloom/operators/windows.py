"""Tumbling event-time windows and their means.

Every aggregate here is combined on the map side first, so a window that holds a large share
of all rows reaches its reducer as one row per input task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MEASURES

WINDOW_LENGTH = "1 minute"
WINDOW = ("window_start", "window_end")


def _per_window(
    readings: DataFrame, length: str, event_time: str, delay: str | None, *aggregates: Column
) -> DataFrame:
    """One row per window with its bounds and the aggregates."""
    window = F.window(event_time, length)
    if readings.isStreaming:
        # The watermark closes windows only if the whole window is the grouping key.
        if delay is not None:
            readings = readings.withWatermark(event_time, delay)
        return readings.groupBy(window).agg(*aggregates).withColumns(
            {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
        )
    # A plain timestamp sorts by prefix, a struct does not: that counts wherever an aggregate
    # of texts, or one that has run out of memory, falls back to sorting.
    rows = readings.groupBy(window["start"].alias("window_start")).agg(*aggregates)
    return rows.withColumn("window_end", F.col("window_start") + F.lit(length).cast("interval"))


def assign_windows(
    readings: DataFrame, length: str = WINDOW_LENGTH, event_time: str = "event_time"
) -> DataFrame:
    """The readings with the bounds of their window, ``[start, end)``; no row is dropped.

    A reading without an event time belongs to no window and has NULL bounds.
    """
    # window() filters out NULL times; as a column it needs a time in every row.
    bounds = F.window(F.coalesce(event_time, F.timestamp_seconds(F.lit(0))), length)
    known = F.col(event_time).isNotNull()
    return (
        readings.withColumn("_window", bounds)
        .withColumns(
            {
                "window_start": F.when(known, F.col("_window.start")),
                "window_end": F.when(known, F.col("_window.end")),
            }
        )
        .drop("_window")
    )


def window_means(
    readings: DataFrame,
    measures: Sequence[str] = MEASURES,
    length: str = WINDOW_LENGTH,
    event_time: str = "event_time",
    delay: str | None = None,
    places: int | None = None,
    reported_time: str | None = None,
) -> DataFrame:
    """Mean of every measure per window, one row per window, in one shuffle.

    A NULL measure is left out of its own mean only; NaN makes the mean NaN. ``n`` counts the
    readings and ``last_time`` is the latest ``reported_time`` (by default the event time).
    ``delay`` sets the watermark of a stream and does nothing to a table. ``places`` rounds the
    means, which makes them independent of the order of summation.
    """

    def mean(measure: str) -> Column:
        value = F.avg(measure)
        return (value if places is None else F.round(value, places)).alias(measure)

    aggregates = (
        *[mean(m) for m in measures],
        F.count(F.lit(1)).alias("n"),
        F.max(reported_time or event_time).alias("last_time"),
    )
    means = _per_window(readings, length, event_time, delay, *aggregates)
    return means.select(*WINDOW, *measures, "n", "last_time")


def window_mean(
    readings: DataFrame,
    measure: str,
    length: str = WINDOW_LENGTH,
    event_time: str = "event_time",
    delay: str | None = None,
    places: int | None = None,
) -> DataFrame:
    """Mean and count of one measure; a window without a value of it gives no row."""
    present = readings.filter(F.col(measure).isNotNull())
    means = window_means(present, [measure], length, event_time, delay, places)
    return means.select(*WINDOW, F.col(measure).alias("mean"), "n")


def tumbling_counts(
    readings: DataFrame,
    length: str = WINDOW_LENGTH,
    event_time: str = "event_time",
    delay: str | None = None,
) -> DataFrame:
    count = F.count(F.lit(1)).alias("n")
    return _per_window(readings, length, event_time, delay, count).select(*WINDOW, "n")


def first_reading_per_window(
    readings: DataFrame,
    value: str = "id",
    length: str = WINDOW_LENGTH,
    event_time: str = "event_time",
    delay: str | None = None,
) -> DataFrame:
    """The earliest ``value`` of each window of a stream; the smallest one where two share the
    instant. ``joins.first_of_windows`` gives the same of a table without sorting its readings."""
    earliest = F.min(F.struct(F.col(event_time), F.col(value)))[value].alias(value)
    return _per_window(readings, length, event_time, delay, earliest).select(*WINDOW, value)


def earliest_times(
    readings: DataFrame, length: str = WINDOW_LENGTH, event_time: str = "event_time"
) -> DataFrame:
    """The first instant of each window of a table, and ``n``, how many readings the window has."""
    first = F.min(event_time).alias("first_time")
    return _per_window(readings, length, event_time, None, first, F.count(F.lit(1)).alias("n"))
