"""Broker messages in, readings or alerts out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import parse_time, safe_double
from ..schemas import MESSAGE_SCHEMA

CORRUPT = "_corrupt"

# Fields of the wire formats: numbers are read as numbers first.
_READING = "id string, time string, motor_power double, pressure double, temperature double"
_ALERT = "processingTime string, mean double, status string, notification string"

# Sources with a fixed schema of their own; all others hold the message columns.
_OWN_SCHEMA = ("kafka", "text", "rate")


def read_messages(
    spark: SparkSession,
    format: str = "parquet",
    path: str | None = None,
    options: dict[str, str] | None = None,
    streaming: bool = False,
) -> DataFrame:
    """Messages from any Spark source, batch or stream, as ``data, attributes, publish_time``."""
    reader = (spark.readStream if streaming else spark.read).format(format)
    reader = reader.options(**(options or {}))
    if format not in _OWN_SCHEMA:
        reader = reader.schema(MESSAGE_SCHEMA)
    return as_messages(reader.load(path) if path else reader.load())


def as_messages(df: DataFrame) -> DataFrame:
    """Bring the columns of a broker source (``value``, ``headers``, ``timestamp``) to ours."""
    columns = set(df.columns)
    data = F.col("data" if "data" in columns else "value")
    if "attributes" in columns:
        attributes = F.col("attributes")
    elif "headers" in columns:
        # Header keys may repeat; keep the last and let nothing fail the stream.
        headers = F.col("headers")
        attributes = F.map_from_entries(
            F.transform(
                F.filter(
                    headers,
                    lambda h, i: ~F.exists(
                        F.slice(headers, i + 2, F.size(headers)), lambda x: x["key"] == h["key"]
                    ),
                ),
                lambda h: F.struct(h["key"], F.try_validate_utf8(h["value"].cast("string"))),
            )
        )
    else:
        attributes = F.lit(None).cast("map<string,string>")
    if "publish_time" in columns:
        published = F.col("publish_time")
    elif "timestamp" in columns:
        published = F.col("timestamp")
    else:
        published = F.lit(None).cast("timestamp")
    return df.select(
        data.cast("binary").alias("data"),
        attributes.alias("attributes"),
        published.cast("timestamp").alias("publish_time"),
    )


def _parse_once(df: DataFrame, name: str, text: Column, schema: str) -> DataFrame:
    """Add the JSON object of ``text``. Exploding a list of one keeps the optimizer from
    copying the parse into every later filter and field."""
    record = F.from_json(
        text,
        f"{schema}, {CORRUPT} string",
        {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT,
            "allowSingleQuotes": "false",
        },
    )
    return df.select("*", F.explode(F.array(record)).alias(name))


def _one_object(text: Column) -> Column:
    """Whether the text, whose first and last signs are braces, is one JSON value and no more.

    The parser stops at the end of the first value and says nothing of what follows it. With one
    brace of either kind nothing can follow, as the last sign closes the first. Otherwise the text
    is read twice more: as a value before a sentinel in an object, where only more fields could
    follow it, and as the item of a list, where only more items could.
    """
    flat = (F.locate("{", text, 2) == 0) & (F.locate("}", text) == F.length(text))
    wrapped = F.concat(F.lit('{"r":'), text, F.lit(',"end":true}'))
    sentinel = F.get_json_object(wrapped, "$.end") == "true"
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return flat | F.coalesce(sentinel & alone, F.lit(False))


def _parse(df: DataFrame, raw: Column, schema: str) -> tuple[DataFrame, dict[str, Column]]:
    """Parse payloads by ``schema``; gives the frame and an expression per field.

    A payload that is no single UTF-8 JSON object, or one without a value for any field, keeps its
    text in ``_corrupt`` and has NULL fields. The rare record that does not fit the schema is
    parsed again with all fields as text, so that one number in quotes does not void the record.
    """
    fields = dict(field.split() for field in schema.split(", "))
    text, strict, lenient = F.col("_text"), F.col("_strict"), F.col("_lenient")

    def braced(value: Column) -> Column:
        return value.startswith("{") & value.endswith("}")

    bare = F.when(braced(text), text).otherwise(F.trim(text, F.lit(" \t\r\n")))
    is_object = braced(bare) & _one_object(bare)
    df = df.withColumn("_text", raw.cast("string"))
    df = _parse_once(df, "_strict", F.when(F.is_valid_utf8(text) & is_object, text), schema)
    retry = F.when(strict[CORRUPT].isNotNull(), text)
    df = _parse_once(df, "_lenient", retry, schema.replace("double", "string"))
    read = F.coalesce(*[record[f].cast("string") for record in (strict, lenient) for f in fields])
    broken = strict.isNull() | lenient[CORRUPT].isNotNull() | read.isNull()
    df = df.withColumn(
        CORRUPT, F.when(broken, F.coalesce(F.make_valid_utf8(text), F.lit("")))
    )

    def field(name: str, kind: str) -> Column:
        second = lenient[name] if kind == "string" else safe_double(lenient[name])
        return F.when(strict[CORRUPT].isNull(), strict[name]).otherwise(
            F.when(lenient[CORRUPT].isNull(), second)
        )

    return df, {name: field(name, kind) for name, kind in fields.items()}


def parse_messages(messages: DataFrame, event_time: str = "time") -> DataFrame:
    """JSON payloads to typed readings.

    ``event_time`` names what the windows follow: ``time``, the text inside the payload, or
    ``publish_time``, the broker's own. ``good_readings`` and ``bad_readings`` split the result.
    """
    if event_time not in ("time", "publish_time"):
        raise ValueError("event_time is 'time' or 'publish_time'")
    parsed, fields = _parse(messages, F.col("data"), _READING)
    moment = parse_time(fields["time"]) if event_time == "time" else F.col("publish_time")
    return parsed.select(
        *[column.alias(name) for name, column in fields.items()],
        moment.alias("event_time"),
        CORRUPT,
    )


def good_readings(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_readings(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def parse_alerts(alerts: DataFrame, payload: str = "value") -> DataFrame:
    """JSON alert payloads back to columns; the other columns of the frame are kept."""
    others = [c for c in alerts.columns if c != payload]
    parsed, fields = _parse(alerts, F.col(payload), _ALERT)
    return parsed.select(
        *others, *[column.alias(name) for name, column in fields.items()], CORRUPT
    )


def decode_envelope(events: DataFrame, payload: str = "data") -> DataFrame:
    """Trigger events, whose payload is base64 text, to alert columns."""
    raw = F.try_to_binary(F.col(payload), F.lit("base64"))
    decoded = events.withColumns({"_payload": raw, "_envelope": F.col(payload)}).drop(payload)
    parsed = parse_alerts(decoded, "_payload")
    # Text that is no base64 has no payload to show; keep the envelope itself.
    undecoded = (F.col(CORRUPT) == "") & F.col("_envelope").isNotNull()
    shown = F.when(undecoded, F.col("_envelope")).otherwise(F.col(CORRUPT))
    return parsed.withColumn(CORRUPT, shown).drop("_envelope")
