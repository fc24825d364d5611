"""Read side of the archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grading import DEFAULT_RANGES, StatusRange
from ..functions.scalars import parse_time
from ..operators.combine import grade
from ..operators.measures import stack_measures
from ..operators.windows import WINDOW, WINDOW_LENGTH, window_means
from ..schemas import MEASURES


def dashboard_series(
    archive: DataFrame,
    measures: Sequence[str] = MEASURES,
    length: str = WINDOW_LENGTH,
    places: int | None = None,
) -> DataFrame:
    """The measures over time from archive rows, as means per window.

    Decimals are averaged as DOUBLE: the archive's scale is far below the sensors' noise.
    """
    readings = archive.select(
        parse_time(F.col("time")).alias("event_time"),
        *[F.col(m).cast("double").alias(m) for m in measures],
    )
    return window_means(readings, measures, length, places=places).select(*WINDOW, *measures)


def grade_readings(
    readings: DataFrame,
    ranges: Sequence[StatusRange] = DEFAULT_RANGES,
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """The status of every single measured value."""
    rows = stack_measures(readings, [r.measure for r in ranges], keep)
    return grade(rows, ranges, value="value").select(*keep, "measure", "value", "status")
