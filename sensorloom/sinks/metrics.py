"""Counts of what passed each stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.messages import CORRUPT

# Of the messages, those that are no readings, and readings that belong to no window.
COUNTS = ("messages", "rejected", "untimed")


def alert_counts(graded: DataFrame) -> DataFrame:
    """Number of graded means per measure and colour, green included."""
    return graded.groupBy("measure", "colour").agg(F.count(F.lit(1)).alias("n"))


def _counts() -> list:
    untimed = F.col(CORRUPT).isNull() & F.col("event_time").isNull()
    counted = (F.lit(1), F.col(CORRUPT), F.when(untimed, 1))
    return [F.count(column).alias(name) for name, column in zip(COUNTS, counted)]


def parsed_counts(parsed: DataFrame) -> DataFrame:
    """The counts of parsed messages as one row."""
    return parsed.agg(*_counts())


def observe_parsed(parsed: DataFrame, target: str | Observation = "parsed") -> DataFrame:
    """The same counts as a side product of the run itself.

    A table reports into the ``Observation``, a stream into the progress of its query, which
    Spark forgets after a while. What is to last goes through ``counts_of`` into a table.
    """
    return parsed.observe(target, *_counts())


def counts_of(spark: SparkSession, seen: Observation) -> DataFrame:
    """What has been observed as one row, to be written under the number of its batch."""
    found = seen.get
    row = tuple(int(found[name]) for name in COUNTS)
    return spark.createDataFrame([row], ", ".join(f"{name} long" for name in COUNTS))


def totals(counts: DataFrame) -> DataFrame:
    """The sums of the counts of all batches."""
    return counts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in COUNTS])
