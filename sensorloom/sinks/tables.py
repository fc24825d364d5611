"""Appending frames to tables, paths and topics, from batch jobs and streams."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import date_text, parse_time


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, cast to their types; what does not fit becomes NULL.

    NaN has no decimal form and is archived as NULL.
    """
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def with_date(df: DataFrame, time: str = "time", name: str = "event_date") -> DataFrame:
    """Add the day of a time text as a column to partition a table by; NULL for no readable time."""
    return df.withColumn(name, date_text(parse_time(F.col(time))))


# Partition columns of everything a job writes: whose rows they are, and in which batch they came.
RUN = ("query_id", "batch_id")


@dataclass(frozen=True)
class Sink:
    """Where rows go: a path or a table of any format, or a format that needs neither.

    Tables and paths are created when absent. Batch jobs and streams write one layout, partitions
    by run and batch, so that whatever was written in whatever order is read together, and a batch
    that is written again replaces itself.
    """

    format: str = "parquet"
    path: str | None = None
    table: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()

    def append(self, df: DataFrame) -> None:
        """Add rows once. A path gets them as a run of its own; a table just as they are."""
        if self.path and not self.table:
            self.put_batch(df, uuid.uuid4().hex, 0)
            return
        writer = df.write.format(self.format).options(**self.options).mode("append")
        if self.table:
            if self.partition_by:
                writer = writer.partitionBy(*self.partition_by)
            writer.saveAsTable(self.table)
        else:
            writer.save()

    def put_batch(self, df: DataFrame, query_id: str, batch_id: int) -> None:
        """Write one batch of a run so that its repetition leaves no second copy.

        A path or table is overwritten in the partitions of this run and batch and nowhere else.
        Each write is staged in a folder of its own, so runs may share a path. A repetition is
        taken to have the rows of the first time, as a restarted batch has. A table that was made
        without the columns of ``RUN`` is only appended to; it and a topic get rows at least once.
        """
        rows = df.withColumns({"query_id": F.lit(query_id), "batch_id": F.lit(batch_id)})
        if self.table:
            self._put_in_table(df, rows, query_id, batch_id)
        elif self.path:
            (
                rows.write.format(self.format)
                .options(**self.options)
                .option("partitionOverwriteMode", "dynamic")
                .mode("overwrite")
                .partitionBy(*self.partition_by, *RUN)
                .save(self.path)
            )
        else:
            self.append(df)

    def _put_in_table(
        self, df: DataFrame, rows: DataFrame, query_id: str, batch_id: int
    ) -> None:
        spark = df.sparkSession
        if not spark.catalog.tableExists(self.table):
            writer = rows.write.format(self.format).options(**self.options)
            writer.partitionBy(*RUN, *self.partition_by).saveAsTable(self.table)
            return
        columns = spark.table(self.table).columns
        if not set(RUN) <= set(columns):
            self.append(df)
            return
        quoted = query_id.replace("\\", "\\\\").replace("'", "\\'")
        parts = [f"query_id = '{quoted}'", f"batch_id = {batch_id}", *self.partition_by]
        view = f"batch_{uuid.uuid4().hex}"
        names = ", ".join(f"`{c}`" for c in columns if c not in RUN)
        df.createOrReplaceTempView(view)
        try:
            spark.sql(
                f"INSERT OVERWRITE TABLE {self.table} PARTITION ({', '.join(parts)}) "
                f"SELECT {names} FROM {view}"
            )
        finally:
            spark.catalog.dropTempView(view)

    def read(self, spark: SparkSession, schema: T.StructType | str | None = None) -> DataFrame:
        """All rows written to the path or table, by whichever runs, without the columns of ``RUN``.

        A path that may hold no row yet needs the ``schema``, as there is no file to take it from.
        """
        if not (self.table or self.path):
            raise ValueError(f"a sink of format {self.format} can't be read back")
        reader = spark.read.format(self.format).options(**self.options)
        reader = reader.schema(schema) if schema else reader
        return (spark.table(self.table) if self.table else reader.load(self.path)).drop(*RUN)

    def start(
        self, df: DataFrame, checkpoint: str, name: str, trigger: Mapping[str, object]
    ) -> StreamingQuery:
        """Append a stream as it comes, with Spark's own sink.

        That sink keeps a list of its files in the path, and readers see no others: a path or table
        that other jobs write to as well takes ``put_batch`` from a ``foreachBatch`` instead.
        """
        writer = (
            df.writeStream.format(self.format)
            .options(**self.options)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .queryName(name)
            .trigger(**trigger)
        )
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        if self.table:
            return writer.toTable(self.table)
        return writer.start(self.path) if self.path else writer.start()


def print_rows(df: DataFrame, rows: int, name: str | None = None) -> StreamingQuery | None:
    """Show the first ``rows`` of a table, or start showing those of each batch of a stream, on the
    console. They pass through the driver, so the caller names the bound."""
    if not df.isStreaming:
        df.show(rows, truncate=False)
        return None
    writer = df.writeStream.format("console").option("truncate", "false").option("numRows", rows)
    if name:
        writer = writer.queryName(name)
    return writer.outputMode("append").start()
