"""Named queries over the driver's tables; every one reads the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grading import DEFAULT_RANGES, range_of
from ..functions.scalars import time_text
from ..operators.alerts import (
    alert_outbox,
    encode_alerts,
    encode_readings,
    encode_records,
    stamp,
    window_alerts,
)
from ..operators.combine import (
    combine_pairs,
    explode_pairs,
    measure_pairs,
    merge_records,
    nested_alert,
    window_summary,
)
from ..operators.joins import cogroup, cogroup_measures, enrich_with_window, first_of_windows
from ..operators.measures import (
    extract_measures,
    rounded_measures,
    stack_measures,
    time_pairs,
    union_all,
)
from ..operators.windows import (
    WINDOW,
    assign_windows,
    tumbling_counts,
    window_mean,
    window_means,
)
from ..schemas import ARCHIVE_SCHEMA, MEASURES, READING_FIELDS, SUMMARY_SCHEMA
from ..sinks.metrics import alert_counts
from ..sinks.tables import conform
from ..sources.history import HISTORY_COLUMNS, shape_readings
from ..sources.messages import decode_envelope, good_readings, parse_alerts, parse_messages
from . import registered_jobs
from .event_readings import faulty_readings_from_events, readings_from_events
from .views import dashboard_series, grade_readings

# Means are rounded before grading, so that the order of summation cannot move one over a limit.
PLACES = 6

Query = Callable[[SparkSession, str], DataFrame]
ALERT = (*WINDOW, "measure", "mean", "status", "notification")


def _means(spark: SparkSession, sf_dir: str, length: str = "1 minute") -> DataFrame:
    return window_means(readings_from_events(spark, sf_dir), length=length, places=PLACES)


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts stamped with the end of their window in place of the clock."""
    return stamp(window_alerts(_means(spark, sf_dir)), F.col("window_end"))


def window_alerts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_alerts(_means(spark, sf_dir)).select(*ALERT)


def hourly_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_alerts(_means(spark, sf_dir, "1 hour")).select(*ALERT)


def mean_query(measure: str) -> Query:
    return lambda spark, sf_dir: window_mean(
        readings_from_events(spark, sf_dir), measure, places=PLACES
    )


def status_query(measure: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        means = window_means(readings_from_events(spark, sf_dir), [measure], places=PLACES)
        return window_alerts(means, [range_of(measure)]).drop("measure", "colour")

    return run


def hourly_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _means(spark, sf_dir, "1 hour").select(*WINDOW, *MEASURES, "n")


def tumbling_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_counts(readings_from_events(spark, sf_dir))


def assign_windows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_windows(readings_from_events(spark, sf_dir)).select("id", *WINDOW)


def grade_readings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade_readings(readings_from_events(spark, sf_dir))


def extract_measures_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_measures(readings_from_events(spark, sf_dir))


def rounded_measures_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures given as text with a third fraction digit, never one that makes a tie."""
    texts = readings_from_events(spark, sf_dir).withColumns(
        {
            m: (F.col(m) + (F.col("id").cast("bigint") % 5) / F.lit(1000.0)).cast("string")
            for m in MEASURES
        }
    )
    return rounded_measures(texts)


def time_pairs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_pairs(readings_from_events(spark, sf_dir))


def shape_readings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = readings_from_events(spark, sf_dir)
    history = readings.select(
        "id", "time", *[F.col(m).alias(name) for m, name in HISTORY_COLUMNS.items()]
    )
    return shape_readings(history, id=F.col("id"), time=F.col("time"))


def parse_messages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = encode_readings(readings_from_events(spark, sf_dir)).withColumnRenamed("value", "data")
    return good_readings(parse_messages(sent)).select(*READING_FIELDS, "event_time")


def encode_readings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each payload beside its reading's id, shown by its fields."""
    sent = encode_readings(readings_from_events(spark, sf_dir), keep=["id"])
    schema = "time string, temperature double, pressure double, motor_power double"
    fields = F.from_json(F.col("value").cast("string"), schema)
    return sent.select("id", fields.alias("r")).select("id", "r.*")


def encode_alerts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = encode_alerts(_alerts(spark, sf_dir), keep=[*WINDOW, "measure"])
    return parse_alerts(sent).drop("_corrupt")


def decode_envelope_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = encode_alerts(_alerts(spark, sf_dir))
    envelopes = sent.select(F.base64("value").alias("data"))
    return decode_envelope(envelopes).select("mean", "status", "notification")


def _decimals_as_text(rows: DataFrame) -> DataFrame:
    """Decimals as text, so that a comparison sees every digit of their scale."""
    return rows.withColumns(
        {
            f.name: F.col(f.name).cast("string")
            for f in rows.schema
            if f.dataType.typeName() == "decimal"
        }
    )


def archive_readings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decimals_as_text(conform(readings_from_events(spark, sf_dir), ARCHIVE_SCHEMA))


def window_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_summary(_means(spark, sf_dir))


def summary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary as the rows of its declared table."""
    summary = window_summary(_means(spark, sf_dir), keep=())
    return _decimals_as_text(conform(summary, SUMMARY_SCHEMA))


def nested_alert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = nested_alert(_means(spark, sf_dir))
    return nested.select(
        *WINDOW,
        *[
            F.col(f"{r.nested_key}.{leaf}").alias(f"{r.measure}_{leaf}")
            for r in DEFAULT_RANGES
            for leaf in ("mean", "status", "notification")
        ],
    )


def encode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One merged payload per window, shown by the leaves read back from its text."""
    nested = stamp(nested_alert(_means(spark, sf_dir)), F.col("window_end"))
    keys = [r.nested_key for r in DEFAULT_RANGES]
    sent = encode_records(nested, ["processingTime", *keys], keep=WINDOW)
    block = "struct<mean: double, status: string, notification: string>"
    schema = "processingTime string, " + ", ".join(f"{key} {block}" for key in keys)
    read = sent.select(*WINDOW, F.from_json(F.col("value").cast("string"), schema).alias("r"))
    return read.select(
        *WINDOW,
        F.col("r.processingTime").alias("processingTime"),
        *[
            F.col(f"r.{r.nested_key}.{leaf}").alias(f"{r.measure}_{leaf}")
            for r in DEFAULT_RANGES
            for leaf in ("mean", "status")
        ],
    )


def flatten_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time pair of every reading and the field pairs of every graded mean, in one bag."""
    readings = readings_from_events(spark, sf_dir)
    times = time_pairs(assign_windows(readings), keep=WINDOW)
    return union_all(times, explode_pairs(measure_pairs(_means(spark, sf_dir))))


def pairs_to_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of each window from its bag of pairs; the window's last time comes out of
    the aggregation of the means, where it costs no second scan of the readings."""
    bag = explode_pairs(measure_pairs(_means(spark, sf_dir), with_time=True))
    return combine_pairs(bag).select(*WINDOW, F.explode("record").alias("k", "v"))


def merge_records_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One map per window and measure, merged to one map per window."""
    alerts = window_alerts(_means(spark, sf_dir))
    records = alerts.select(
        *WINDOW, F.create_map("measure", F.col("mean").cast("string")).alias("record")
    )
    return merge_records(records).select(*WINDOW, F.explode("record").alias("k", "v"))


def cogroup_measures_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cogroup_measures(faulty_readings_from_events(spark, sf_dir), places=PLACES)


def cogroup_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-group of means that come as frames of their own, over hours."""
    readings = readings_from_events(spark, sf_dir)
    return cogroup({m: window_mean(readings, m, "1 hour", places=PLACES) for m in MEASURES})


def enrich_with_window_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = readings_from_events(spark, sf_dir)
    enriched = enrich_with_window(readings, "temperature", places=PLACES)
    return enriched.select("id", "temperature", "window_mean")


def first_reading_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_of_windows(readings_from_events(spark, sf_dir))


def union_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stack_measures(readings_from_events(spark, sf_dir))


def alert_outbox_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_outbox(
        _alerts(spark, sf_dir), time_text(F.col("window_end")), keep=(*WINDOW, "measure")
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_counts(window_alerts(_means(spark, sf_dir)))


def dashboard_series_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = conform(readings_from_events(spark, sf_dir), ARCHIVE_SCHEMA)
    return dashboard_series(archive, places=PLACES)


QUERIES: dict[str, Query] = {
    "window_alerts": window_alerts_query,
    "hourly_alerts": hourly_alerts,
    "mean_temperature": mean_query("temperature"),
    "mean_pressure": mean_query("pressure"),
    "mean_motor_power": mean_query("motor_power"),
    "hourly_means": hourly_means,
    "status_temperature": status_query("temperature"),
    "status_pressure": status_query("pressure"),
    "status_motor_power": status_query("motor_power"),
    "grade_readings": grade_readings_query,
    "tumbling_counts": tumbling_counts_query,
    "assign_windows": assign_windows_query,
    "extract_measures": extract_measures_query,
    "rounded_measures": rounded_measures_query,
    "time_pairs": time_pairs_query,
    "shape_readings": shape_readings_query,
    "parse_messages": parse_messages_query,
    "decode_envelope": decode_envelope_query,
    "encode_readings": encode_readings_query,
    "encode_alerts": encode_alerts_query,
    "archive_readings": archive_readings_query,
    "window_summary": window_summary_query,
    "summary_rows": summary_rows,
    "nested_alert": nested_alert_query,
    "encode_nested": encode_nested,
    "flatten_pairs": flatten_pairs,
    "pairs_to_record": pairs_to_record,
    "merge_records": merge_records_query,
    "cogroup_measures": cogroup_measures_query,
    "cogroup_frames": cogroup_frames,
    "enrich_with_window": enrich_with_window_query,
    "first_reading_per_window": first_reading_query,
    "union_measures": union_measures,
    "alert_outbox": alert_outbox_query,
    "run_metrics": run_metrics,
    "dashboard_series": dashboard_series_query,
    **registered_jobs.QUERIES,
}
