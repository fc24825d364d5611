"""Choosing, rounding, pairing and stacking the measures of readings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.records import pair
from ..functions.scalars import rounded
from ..schemas import MEASURES


def extract_measures(
    readings: DataFrame, measures: Sequence[str] = MEASURES, keep: Sequence[str] = ("id",)
) -> DataFrame:
    """Only the named measures, so that the scan reads nothing else."""
    return readings.select(*keep, *measures)


def rounded_measures(
    readings: DataFrame,
    measures: Sequence[str] = MEASURES,
    places: int = 2,
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """The measures, numbers or number texts, as DOUBLE rounded half up."""
    return readings.select(*keep, *[rounded(F.col(m), places).alias(m) for m in measures])


def time_pairs(readings: DataFrame, column: str = "time", keep: Sequence[str] = ()) -> DataFrame:
    """One ``('time', value)`` pair per reading."""
    entry = pair("time", F.col(column))
    return readings.select(*keep, entry["k"].alias("k"), entry["v"].alias("v"))


def keyed_records(readings: DataFrame, key: str = "time") -> DataFrame:
    """Whole records beside a key column taken from them."""
    return readings.select(F.col(key).alias("key"), F.struct("*").alias("record"))


def stack_measures(
    readings: DataFrame, measures: Sequence[str] = MEASURES, keep: Sequence[str] = ()
) -> DataFrame:
    """The bag union of the measures of one frame: ``measure, value`` rows from a single scan."""
    return readings.unpivot(list(keep), list(measures), "measure", "value")


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union of frames by column name, nothing removed."""
    return reduce(lambda left, right: left.unionByName(right), frames)
