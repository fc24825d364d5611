"""Bringing the measures of a window together, and window means back to the readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MEASURES
from ..session import ensure_checkpoint_dir
from .measures import union_all
from .windows import WINDOW, WINDOW_LENGTH, assign_windows, earliest_times, window_means

# Values that the list of one key and frame may have.
MOST = 1_000_000

# A row of window means takes about 64 bytes in a broadcast relation: at most 32 MB.
BROADCAST_ROWS = 500_000


def cogroup_measures(
    readings: DataFrame,
    measures: Sequence[str] = MEASURES,
    length: str = WINDOW_LENGTH,
    event_time: str = "event_time",
    delay: str | None = None,
    places: int | None = None,
) -> DataFrame:
    """The means of all measures side by side, with NULL where a measure has none.

    Same rows as a full outer join of the single means on the window. As they come from one
    frame, one aggregation gives them without a join. A window with no mean at all is no row.
    """
    means = window_means(readings, measures, length, event_time, delay, places)
    return means.filter(F.coalesce(*measures).isNotNull()).select(*WINDOW, *measures)


def cogroup(
    frames: Mapping[str, DataFrame], keys: Sequence[str] = WINDOW, value: str = "mean"
) -> DataFrame:
    """Full outer co-group of frames that hold at most one row per key, one column per frame; the
    greatest value where a frame has more. ``cogroup_lists`` keeps them all.

    A union and one grouping shuffle every frame once, where a chain of full outer joins
    shuffles the growing result again at each step.
    """
    tagged = [
        frame.select(
            *keys, *[(F.col(value) if n == name else F.lit(None)).alias(n) for n in frames]
        )
        for name, frame in frames.items()
    ]
    return union_all(*tagged).groupBy(*keys).agg(*[F.max(n).alias(n) for n in frames])


def cogroup_lists(
    frames: Mapping[str, DataFrame],
    keys: Sequence[str] = WINDOW,
    value: str = "mean",
    most: int = MOST,
) -> DataFrame:
    """Full outer co-group that keeps every value: a sorted list per frame and key, NULL values
    first, empty where a frame has none of the key.

    The lists of a key are one row, so their length has a bound. A table is counted before any
    list is built, and a key with over ``most`` values in a frame is an error that names it. The
    frames of a stream carry a watermark, and their keys hold the window: its lists are kept until
    it closes, and are checked then.
    """
    tagged = [
        frame.select(*keys, F.lit(name).alias("_frame"), F.struct(F.col(value).alias("v")).alias("_v"))
        for name, frame in frames.items()
    ]
    return _listed(union_all(*tagged), keys, {n: F.col("_frame") == n for n in frames}, most)


def cogroup_values(
    readings: DataFrame,
    measures: Sequence[str] = MEASURES,
    length: str = WINDOW_LENGTH,
    event_time: str = "event_time",
    delay: str | None = None,
    most: int = MOST,
) -> DataFrame:
    """All values of every measure per window, on a table or a stream: the same co-group for
    measures that come in one frame, from a single scan. NULL is no value of a measure."""
    rows = readings.filter(F.col(event_time).isNotNull() & F.coalesce(*measures).isNotNull())
    if rows.isStreaming:
        rows = rows.withWatermark(event_time, delay) if delay is not None else rows
        rows = rows.withColumn("_window", F.window(event_time, length))
        keys, bounds = ["_window"], [F.col(f"_window.{b}").alias(f"window_{b}") for b in ("start", "end")]
    else:
        rows, keys, bounds = assign_windows(rows, length, event_time), [*WINDOW], [*WINDOW]
    pairs = [
        F.struct(F.lit(m).alias("_frame"), F.struct(F.col(m).alias("v")).alias("_v"))
        for m in measures
    ]
    values = rows.select(*keys, F.inline(F.array(*pairs)))
    values = values.filter(F.col("_v.v").isNotNull())
    lists = _listed(values, keys, {m: F.col("_frame") == m for m in measures}, most)
    return lists.select(*bounds, *measures)


def _listed(
    rows: DataFrame, keys: Sequence[str], sides: Mapping[str, Column], most: int
) -> DataFrame:
    """The values ``_v`` of each key as one sorted list per side."""
    name = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    if not rows.isStreaming:
        sizes = [F.count(F.when(side, 1)) for side in sides.values()]
        largest = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
        counted = rows.groupBy(*keys).agg(largest.alias("_n")).filter(F.col("_n") > most)
        if found := counted.select(name.alias("key"), "_n").head():
            raise ValueError(f"{found['_n']} values for {found['key']}: more than {most}")
    lists = [F.sort_array(F.collect_list(F.when(side, F.col("_v")))).alias(n) for n, side in sides.items()]
    rows = rows.groupBy(*keys).agg(*lists)
    error = F.raise_error(F.concat(F.lit(f"more than {most} values for "), name))
    return rows.select(
        *keys, *[F.when(F.size(n) > most, error).otherwise(F.col(f"{n}.v")).alias(n) for n in sides]
    )


def enrich_stream(
    readings: DataFrame,
    measure: str,
    length: str = WINDOW_LENGTH,
    event_time: str = "event_time",
    delay: str = "0 seconds",
    places: int | None = None,
) -> DataFrame:
    """Every reading of a stream with the mean of its window in ``window_mean``; NULL where there
    is none. The rows of ``enrich_with_window``, each as soon as its window has closed.

    The readings are joined to the means of the same stream, two watermarks and a time range apart:
    a reading is kept until its window's mean can no longer come, a mean until no reading of its
    window can. A reading too late for its window is too late for the join. Readings without an
    event time wait for nothing and keep no state.
    """
    placed = assign_windows(readings, length, event_time)
    untimed = placed.filter(F.col(event_time).isNull())
    timed = readings.filter(F.col(event_time).isNotNull()).withWatermark(event_time, delay)
    value = F.avg(measure)
    means = (
        timed.groupBy(F.window(event_time, length).alias("_window"))
        .agg((value if places is None else F.round(value, places)).alias("window_mean"))
        .select(
            F.window_time("_window").alias("_last"),
            F.col("_window.start").alias("_start"),
            "window_mean",
        )
    )
    left = assign_windows(timed, length, event_time)
    # a literal, which Spark must see to know how far apart the watermarks may be
    step = F.expr(f"INTERVAL '{length.removeprefix('interval ')}'")
    same = (
        (F.col("window_start") == F.col("_start"))
        & (F.col(event_time) <= F.col("_last"))
        & (F.col(event_time) > F.col("_last") - step)
    )
    joined = left.join(means, same, "left_outer").drop("_start", "_last")
    nothing = joined.schema["window_mean"].dataType
    return joined.unionByName(untimed.withColumn("window_mean", F.lit(None).cast(nothing)))


def enrich_with_window(
    readings: DataFrame,
    measure: str,
    length: str = WINDOW_LENGTH,
    event_time: str = "event_time",
    places: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Every reading with the mean of its window in ``window_mean``; NULL where there is none.

    For tables. Runs the aggregation at once: the means are checkpointed in the shared folder,
    so their number is known before the join is planned and they are not computed twice.
    """
    ensure_checkpoint_dir(readings.sparkSession)
    # windows weigh what they hold, readings without a value included: all of them are joined
    means = (
        window_means(readings, [measure], length, event_time, places=places)
        .select("window_start", F.col(measure).alias("window_mean"), "n")
        .checkpoint()
    )
    placed = assign_windows(readings, length, event_time)
    return left_lookup(placed, means, "window_start", "n", broadcast_rows)


def first_of_windows(
    readings: DataFrame,
    value: str = "id",
    length: str = WINDOW_LENGTH,
    event_time: str = "event_time",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The earliest ``value`` of each window of a table; the smallest one where two share the
    instant, and NULL only where all of these are.

    In two steps: the first instant of each window, which a hash aggregate of fixed-width values
    finds without sorting, then the smallest text of the few readings at that instant. The first
    step runs at once, as in ``enrich_with_window``, and is looked up in the same way.
    """
    ensure_checkpoint_dir(readings.sparkSession)
    first = earliest_times(readings, length, event_time).select("window_start", "first_time", "n")
    placed = assign_windows(readings.select(event_time, value), length, event_time)
    found = left_lookup(placed, first.checkpoint(), "window_start", "n", broadcast_rows)
    there = found.filter(F.col(event_time) == F.col("first_time"))
    return there.groupBy(*WINDOW).agg(F.min(value).alias(value))


def left_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of ``facts`` to a stored ``lookup`` with one row per key.

    ``weight`` is the number of facts of each key. A lookup of at most ``broadcast_rows`` rows
    is broadcast and the facts are not shuffled. A larger one is split: the keys holding more
    than one ``broadcast_rows``-th of all facts, which are fewer than ``broadcast_rows``
    whatever the data, are broadcast, and only the facts of the rest, none of them heavy, are
    shuffled. Facts without a key are kept and never shuffled.
    """
    size = lookup.agg(F.count(F.lit(1)).alias("rows"), F.sum(weight).alias("facts")).first()
    values = lookup.drop(weight)
    if size["rows"] <= broadcast_rows:
        return facts.join(F.broadcast(values), key, "left")

    heavy = F.col(weight) > F.lit(size["facts"] / broadcast_rows)
    hot = lookup.filter(heavy).drop(weight)
    cold = lookup.filter(~heavy).drop(weight)
    marked = facts.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    settled = marked.filter(F.col("_hot") | F.col(key).isNull()).drop("_hot")
    rest = facts.filter(F.col(key).isNotNull()).join(
        F.broadcast(hot.select(key)), key, "left_anti"
    )
    return union_all(settled, rest.join(cold, key, "left"))
