"""Sensor readings derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import time_text
from ..session import pin_utc


def event_columns() -> dict[str, Column]:
    """The reading columns as expressions over ``events``; the values cross every limit."""
    k = F.round(F.col("value") * 100).cast("bigint")

    def measure(start: float, span: int) -> Column:
        return F.lit(start) + (k % span) / F.lit(100.0)

    moment = F.col("ts").cast("timestamp")
    return {
        "id": F.col("event_id").cast("string"),
        "time": time_text(moment),
        "event_time": moment,
        "temperature": measure(43.0, 600),
        "pressure": measure(56.0, 1800),
        "motor_power": measure(7.0, 1000),
    }


def readings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(*[column.alias(name) for name, column in event_columns().items()])


def faulty_readings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings with one sensor silent for three of the event types."""
    pin_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    silent = {"temperature": "signup", "pressure": "error", "motor_power": "purchase"}
    return events.select(
        *[
            (
                F.when(F.col("event_type") != silent[name], column) if name in silent else column
            ).alias(name)
            for name, column in event_columns().items()
        ]
    )
