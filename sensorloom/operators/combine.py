"""Grading, and the merge of the measures of a window into one record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grading import DEFAULT_RANGES, StatusRange, per_measure
from ..functions.records import pair
from ..functions.scalars import time_text
from .windows import WINDOW


def grade(
    rows: DataFrame, ranges: Sequence[StatusRange] = DEFAULT_RANGES, value: str = "mean"
) -> DataFrame:
    """Add ``colour``, ``status`` and ``notification`` to long rows; NULL values are left out."""
    measure, colour = F.col("measure"), F.col("colour")
    return (
        rows.filter(F.col(value).isNotNull())
        .withColumn("colour", per_measure(measure, ranges, lambda r: r.colour(F.col(value))))
        .withColumns(
            {
                "status": per_measure(measure, ranges, lambda r: r.status(colour)),
                "notification": per_measure(measure, ranges, lambda r: r.notification(colour)),
            }
        )
    )


def _with_colours(means: DataFrame, ranges: Sequence[StatusRange]) -> DataFrame:
    return means.withColumns(
        {
            f"_{r.measure}": F.when(
                F.col(r.measure).isNotNull(), r.colour(F.col(r.measure))
            )
            for r in ranges
        }
    )


def window_summary(
    means: DataFrame,
    ranges: Sequence[StatusRange] = DEFAULT_RANGES,
    keep: Sequence[str] = WINDOW,
) -> DataFrame:
    """One flat record per window: its last time, then mean, bare colour and text per measure."""
    coloured = _with_colours(means, ranges)
    return coloured.select(
        *keep,
        time_text(F.col("last_time")).alias("time"),
        *[F.col(r.measure).alias(f"{r.summary_prefix}_mean") for r in ranges],
        *[F.col(f"_{r.measure}").alias(f"{r.summary_prefix}_status") for r in ranges],
        *[
            r.notification(F.col(f"_{r.measure}")).alias(f"{r.summary_prefix}_notification")
            for r in ranges
        ],
    )


def nested_alert(
    means: DataFrame,
    ranges: Sequence[StatusRange] = DEFAULT_RANGES,
    keep: Sequence[str] = WINDOW,
) -> DataFrame:
    """One record per window with a ``mean, status, notification`` struct per measure."""
    coloured = _with_colours(means, ranges)

    def block(r: StatusRange):
        colour = F.col(f"_{r.measure}")
        return F.struct(
            F.col(r.measure).alias("mean"),
            r.status(colour).alias("status"),
            r.notification(colour).alias("notification"),
        )

    return coloured.select(*keep, *[block(r).alias(r.nested_key) for r in ranges])


def measure_pairs(
    means: DataFrame,
    ranges: Sequence[StatusRange] = DEFAULT_RANGES,
    keep: Sequence[str] = WINDOW,
    with_time: bool = False,
) -> DataFrame:
    """One ``pairs`` array per window and measure that has a mean, its three fields as text;
    ``with_time`` adds an array with the last time of the window."""
    coloured = _with_colours(means, ranges)

    def fields(r: StatusRange):
        colour = F.col(f"_{r.measure}")
        return F.when(
            colour.isNotNull(),
            F.array(
                pair(f"{r.summary_prefix}_mean", F.col(r.measure)),
                pair(f"{r.summary_prefix}_status", colour),
                pair(f"{r.summary_prefix}_notification", r.notification(colour)),
            ),
        )

    times = [F.array(pair("time", time_text(F.col("last_time"))))] if with_time else []
    lists = F.array_compact(F.array(*times, *[fields(r) for r in ranges]))
    return coloured.select(*keep, F.explode(lists).alias("pairs"))


def explode_pairs(
    df: DataFrame, pairs: str = "pairs", keep: Sequence[str] = WINDOW
) -> DataFrame:
    """Arrays of pairs as ``k, v`` rows."""
    return df.select(*keep, F.inline(F.col(pairs)))


def combine_pairs(
    pairs: DataFrame, keys: Sequence[str] = WINDOW, order: str | None = None
) -> DataFrame:
    """All pairs of a group as one map ``record``; of a repeated key the later value wins.

    Later is the greater ``order``; of equal ones the greater value wins, or the greater JSON text
    of a VARIANT. Without an order a repeated key is an error, as rows come in none. Values are
    reduced per key before any list is built: the list of a group is as long as its record has
    fields, however many pairs the group holds.
    """
    return _combined(pairs, keys, order, F.struct("k", "v"))


def _combined(
    pairs: DataFrame, keys: Sequence[str], order: str | None, entry: Column
) -> DataFrame:
    if order is None:
        message = F.concat(F.lit("no order is given and this key repeats: "), F.col("k"))
        repeated = F.when((F.count("k") > 1), F.raise_error(message))
        value = F.when(repeated.isNull(), F.first("v"))
    elif pairs.schema["v"].dataType.typeName() == "variant":
        value = F.max_by("v", F.struct(order, F.to_json("v")))
    else:
        value = F.max(F.struct(order, "v"))["v"]
    return (
        pairs.groupBy(*keys, "k")
        .agg(value.alias("v"))
        .groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list(entry)).alias("record"))
    )


def merge_records(
    records: DataFrame,
    record: str = "record",
    keys: Sequence[str] = WINDOW,
    order: str | None = None,
) -> DataFrame:
    """All map records of a group as one; of a repeated key the later value wins, as in
    ``combine_pairs``. A group whose records are all empty, or NULL, has an empty record."""
    carried = [order] if order else []
    entries = records.select(*keys, *carried, F.explode_outer(record).alias("k", "v"))
    return _combined(entries, keys, order, F.when(F.col("k").isNotNull(), F.struct("k", "v")))
