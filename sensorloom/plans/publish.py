"""History files published as sensor messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..operators.alerts import encode_readings
from ..sinks.tables import Sink
from ..sources.history import shape_readings


def publish_history(history: DataFrame, sink: Sink, time: Column | None = None) -> None:
    """Append one JSON message per history row to any sink, in parallel and at once.

    ``time`` gives each row its own moment; without it all rows carry the job's.
    """
    sink.append(encode_readings(shape_readings(history, time=time)))
