"""Schemas of messages, archive, alerts and summaries, and the loader of declared schemas."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import types as T

MEASURES = ("temperature", "pressure", "motor_power")

NUMERIC = T.DecimalType(38, 9)

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("data", T.BinaryType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("publish_time", T.TimestampType()),
    ]
)

ARCHIVE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("motor_power", NUMERIC),
        T.StructField("pressure", NUMERIC),
        T.StructField("temperature", NUMERIC),
    ]
)

SUMMARY_SCHEMA = T.StructType(
    [T.StructField("time", T.StringType())]
    + [T.StructField(f"{p}_mean", NUMERIC) for p in ("temp", "pressure", "m")]
    + [T.StructField(f"{p}_status", T.StringType()) for p in ("temp", "pressure", "m")]
    + [T.StructField(f"{p}_notification", T.StringType()) for p in ("temp", "pressure", "m")]
)

ALERT_FIELDS = ("processingTime", "mean", "status", "notification")
READING_FIELDS = ("id", "time", "motor_power", "pressure", "temperature")

# Type names of a declared table schema and their Spark types.
_DECLARED_TYPES = {
    "STRING": T.StringType(),
    "NUMERIC": NUMERIC,
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "BYTES": T.BinaryType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def schema_from_declaration(declaration: dict) -> T.StructType:
    """Turn ``{"fields": [{"name", "type", "mode"}, ...]}`` into a ``StructType``."""
    fields, seen = [], set()
    for field in declaration["fields"]:
        name = field["name"]
        if name.lower() in seen:
            raise ValueError(f"column {name!r} is declared twice")
        seen.add(name.lower())
        kind = field["type"].upper()
        if kind in ("RECORD", "STRUCT"):
            data_type: T.DataType = schema_from_declaration(field)
        elif kind in _DECLARED_TYPES:
            data_type = _DECLARED_TYPES[kind]
        else:
            raise ValueError(f"column {name!r} has the unknown type {field['type']!r}")
        mode = field.get("mode", "NULLABLE").upper()
        if mode == "REPEATED":
            data_type = T.ArrayType(data_type)
        fields.append(T.StructField(name, data_type, mode != "REQUIRED"))
    return T.StructType(fields)


def load_schema(path: str | Path) -> T.StructType:
    """Read a declared schema file."""
    return schema_from_declaration(json.loads(Path(path).read_text(encoding="utf-8")))
