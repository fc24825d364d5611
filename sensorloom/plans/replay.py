"""A table of messages or readings sent again in parts, and drained by the streaming job.

Each part is one delivery: all that a broker had when the job looked. Rows may come in a later part
than their time says; what is late is then decided by the watermark, as it was in the stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sinks.tables import Sink
from ..sources.messages import read_messages
from ..streaming.job import run_to_end, start_job
from .job import Settings, Sinks

DRAIN = {"availableNow": True}


def shared_place(rows: DataFrame, what: str) -> str:
    """A new folder under the cluster's shared one."""
    return f"{ensure_checkpoint_dir(rows.sparkSession).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def delivered(rows: DataFrame, part: str, parts: int, place: str) -> Callable[[int], None]:
    """Write ``rows`` once, by the number of their part; gives what sends a part on."""
    rows.write.partitionBy(part).parquet(f"{place}/parts")
    stored = rows.sparkSession.read.parquet(f"{place}/parts")

    def send(number: int) -> None:
        if not 0 <= number < parts:
            raise ValueError(f"there are {parts} parts")
        some = stored.filter(F.col(part) == number).drop(part)
        some.write.mode("append").parquet(f"{place}/arrived")

    return send


def replay_job(
    messages: DataFrame, part: str, parts: int, sinks: Sinks, settings: Settings, place: str
) -> None:
    """Run the streaming job on the parts of ``messages``, in turn and each to its end.

    ``part`` is a column with the numbers from 0. Every drain starts the job anew from its
    checkpoint, so that a part is one micro-batch whatever the number of its files.
    """
    send = delivered(messages, part, parts, place)
    for number in range(parts):
        send(number)
        source = read_messages(messages.sparkSession, path=f"{place}/arrived", streaming=True)
        run_to_end(start_job(source, sinks, settings, f"{place}/checkpoint", DRAIN))


def replay_rows(
    rows: DataFrame,
    part: str,
    parts: int,
    operator: Callable[[DataFrame], DataFrame],
    place: str,
) -> DataFrame:
    """What a streaming operator gives for rows that arrive in parts."""
    send = delivered(rows, part, parts, place)
    spark, schema = rows.sparkSession, rows.drop(part).schema
    out = Sink(path=f"{place}/out")
    for number in range(parts):
        send(number)
        result = operator(spark.readStream.schema(schema).parquet(f"{place}/arrived"))

        def put(batch: DataFrame, batch_id: int) -> None:
            out.put_batch(batch, "replay", batch_id)

        query = result.writeStream.outputMode("append").foreachBatch(put)
        query.option("checkpointLocation", f"{place}/checkpoint").trigger(
            **DRAIN
        ).start().awaitTermination()
    return out.read(spark, result.schema)
