"""The streaming job: one query archives readings, one grades windows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.job import Settings, Sinks, stamped_means, window_outputs, write_readings
from ..sources.messages import parse_messages

EVERY_TEN_SECONDS = {"processingTime": "10 seconds"}


def checkpoint_root(messages: DataFrame, given: str | None) -> str:
    """Where the queries keep their progress: as given, else under the cluster's shared folder."""
    root = given or messages.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("name a checkpoint folder or set spark.checkpoint.dir")
    return root.rstrip("/")


def start_job(
    messages: DataFrame,
    sinks: Sinks,
    settings: Settings = Settings(),
    checkpoint: str | None = None,
    trigger: Mapping[str, object] = EVERY_TEN_SECONDS,
    name: str = "sensors",
) -> dict[str, StreamingQuery]:
    """Start the queries the sinks ask for, each with its own checkpoint.

    ``readings`` writes archive, rejects and counts from one parse of each micro-batch; ``windows``
    is the second reader of the source. All window outputs come from one aggregation and one state
    store: every micro-batch of closed windows is kept for as long as its outputs are written.
    """
    root = f"{checkpoint_root(messages, checkpoint)}/{name}"
    parsed = parse_messages(messages, settings.event_time)
    queries: dict[str, StreamingQuery] = {}

    def started(output: str, rows: DataFrame, write: Callable[[DataFrame, int], None]) -> None:
        queries[output] = (
            rows.writeStream.outputMode("append")
            .queryName(f"{name}_{output}")
            .option("checkpointLocation", f"{root}/{output}")
            .trigger(**trigger)
            .foreachBatch(write)
            .start()
        )

    if sinks.read():
        started("readings", parsed, _write_readings(sinks, settings))
    if sinks.windowed():
        started("windows", stamped_means(parsed, settings, watermark=True), _write_windows(sinks, settings))
    return queries


def _query_id(batch: DataFrame) -> str:
    """The number of the query that runs this batch; it outlives a restart."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _write_readings(sinks: Sinks, settings: Settings):
    def write(batch: DataFrame, batch_id: int) -> None:
        write_readings(batch, sinks, settings, _query_id(batch), batch_id)

    return write


def _write_windows(sinks: Sinks, settings: Settings):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                for sink, rows in window_outputs(batch, settings, sinks):
                    sink.put_batch(rows, _query_id(batch), batch_id)
        finally:
            batch.unpersist()

    return write


def run_to_end(queries: Mapping[str, StreamingQuery]) -> None:
    """Wait until every query has ended, as those with ``availableNow`` do by themselves."""
    for query in queries.values():
        query.awaitTermination()
