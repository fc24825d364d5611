"""Status rule: one table of ranges, turned into CASE expressions."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

# The notification texts consumers match on, spelling included.
GREEN_TEXT = "The {noun} is in the optimum range."
YELLOW_TEXT = (
    "Caution! Actions might be neccessary, as the measured {noun} is out of the optimum range."
)
RED_TEXT = (
    "Error! Machine is not working properly, the {noun} is way out of the optimum range. "
    "Help is needed."
)


@dataclass(frozen=True)
class StatusRange:
    """Limits of one measure, all inclusive; green lies inside yellow, the rest is red."""

    measure: str
    noun: str
    status_prefix: str
    summary_prefix: str
    green: tuple[float, float]
    yellow: tuple[float, float]

    @property
    def nested_key(self) -> str:
        """Name of the measure in the nested record: its noun as one word."""
        return self.noun.replace(" ", "")

    def colour(self, value: Column) -> Column:
        """Colour of a value. NaN is red; callers leave NULL out before grading."""
        return (
            F.when(value.between(*map(float, self.green)), "green")
            .when(value.between(*map(float, self.yellow)), "yellow")
            .otherwise("red")
        )

    def status(self, colour: Column) -> Column:
        return F.concat(F.lit(f"{self.status_prefix}_"), colour)

    def notification(self, colour: Column) -> Column:
        return (
            F.when(colour == "green", GREEN_TEXT.format(noun=self.noun))
            .when(colour == "yellow", YELLOW_TEXT.format(noun=self.noun))
            .when(colour == "red", RED_TEXT.format(noun=self.noun))
        )


# Measure, noun, status prefix, summary prefix, green limits, yellow limits.
DEFAULT_RANGES = (
    StatusRange("temperature", "temperature", "temp", "temp", (45, 47), (44, 48)),
    StatusRange("pressure", "pressure", "pressure", "pressure", (60, 70), (58, 72)),
    StatusRange("motor_power", "motor power", "mpower", "m", (11, 13), (9, 15)),
)


def range_of(measure: str, ranges: Sequence[StatusRange] = DEFAULT_RANGES) -> StatusRange:
    for entry in ranges:
        if entry.measure == measure:
            return entry
    raise KeyError(f"no status range for the measure {measure!r}")


def load_ranges(path: str | Path) -> tuple[StatusRange, ...]:
    """Read a table of ranges from a JSON list of objects with the fields of ``StatusRange``."""
    rows = json.loads(Path(path).read_text(encoding="utf-8"))
    return tuple(
        StatusRange(**{**row, "green": tuple(row["green"]), "yellow": tuple(row["yellow"])})
        for row in rows
    )


def per_measure(measure: Column, ranges: Sequence[StatusRange], of_range) -> Column:
    """CASE over the measure name, with one expression per range."""
    first, *rest = ranges
    case = F.when(measure == first.measure, of_range(first))
    return reduce(lambda done, r: done.when(measure == r.measure, of_range(r)), rest, case)
