"""Sensor history kept as CSV files, shaped to reading messages."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import time_text
from ..operators.measures import union_all

# Different headers that one read may meet: each is a frame of its own in the plan.
MOST_HEADERS = 100

# Header of the history file and the measure it holds.
HISTORY_COLUMNS = {
    "motor_power": "Par agitador",
    "pressure": "P abs SW mb",
    "temperature": "Tª SW",
}


def read_readings_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: dict[str, str] | None = None,
    empty_as_nan: bool = True,
    headers: int = MOST_HEADERS,
    **options: str,
) -> DataFrame:
    """The measure columns of CSV history, found by header name in each file, as DOUBLE.

    Files of one header are read together, whatever the order of their columns and whatever else
    they hold; columns not asked for are pruned and no values are sampled. A file without one of
    the columns, or with two of one name, is an error that names them, and so are more than
    ``headers`` different headers. An empty cell is NaN, as in a data-frame reader; text that is no
    number is NULL.
    """
    names = columns or HISTORY_COLUMNS
    groups = headers_of(spark, path, headers, **options)
    if not groups:
        empty = ", ".join(f"`{name}` double" for name in names.values())
        return spark.createDataFrame([], empty)

    def number(name: str) -> Column:
        cell = F.col(f"`{name}`")
        value = cell.try_cast("double")
        return F.when(cell.isNull(), float("nan")).otherwise(value) if empty_as_nan else value

    frames = []
    for header, files in groups.items():
        for name in names.values():
            if (times := header.count(name)) != 1:
                some = f"{len(files)} files such as {files[0]}"
                raise ValueError(f"column {name!r} stands {times} times in the header of {some}")
        # names that occur twice, or not at all, belong to columns that nobody asked for
        unique = [n if n in names.values() else f"_{i}" for i, n in enumerate(header)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in unique])
        rows = spark.read.csv(files, schema=schema, **{**options, "header": True, "enforceSchema": True})
        frames.append(rows.select(*[number(name).alias(name) for name in names.values()]))
    return union_all(*frames)


def headers_of(
    spark: SparkSession, path: str | Sequence[str], most: int = MOST_HEADERS, **options: str
) -> dict[tuple[str, ...], list[str]]:
    """The different headers of CSV files, each with the files that have it.

    One pass over the files as text keeps the first line of each, in the order in which Spark
    numbers lines of a file; only the headers, and the names of the files, come to the driver.
    Empty files have none.
    """
    lines = spark.read.text(path, wholetext=False).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    # only the first block of a file can hold its first line
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    grouped = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    found = grouped.orderBy("header").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} different headers")
    return {
        _cells(spark, row["header"], options): [_as_path(f) for f in row["files"]]
        for row in found
        if row["header"]
    }


def _cells(spark: SparkSession, line: str, options: dict[str, str]) -> tuple[str, ...]:
    """The names in a header, read by the rules of the files' own cells."""
    rows = spark.read.csv(
        spark.sparkContext.parallelize([line.removeprefix("\ufeff")], 1),
        **{**options, "header": False, "inferSchema": False},
    )
    return tuple(name or "" for name in rows.first())


def _as_path(uri: str) -> str:
    """The path of a file as readers take it: its URI without the escapes, and with the signs that
    readers would take for a pattern escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def shape_readings(
    history: DataFrame,
    columns: dict[str, str] | None = None,
    id: Column | None = None,
    time: Column | None = None,
) -> DataFrame:
    """History rows as reading messages: an id, a time text and the three renamed measures.

    Without ``id`` each row gets a random UUID; without ``time`` all rows carry the moment the
    job started, so a replay over several windows passes its own column.
    """
    names = columns or HISTORY_COLUMNS
    return history.select(
        (F.uuid() if id is None else id.cast("string")).alias("id"),
        (time_text(F.current_timestamp()) if time is None else time).alias("time"),
        *[F.col(f"`{name}`").alias(measure) for measure, name in names.items()],
    )
