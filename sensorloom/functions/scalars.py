"""Text, number, time and payload conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_text(moment: Column) -> Column:
    """A timestamp as text in UTC, always with six fraction digits, whatever zone the session has.

    The way there is a timestamp without zone: formatting one with a zone goes by that of the
    session, and shifting it first fails in the hour that a change of clocks leaves out.
    """
    utc = F.timestamp_add(
        "MICROSECOND", F.unix_micros(moment), F.lit("1970-01-01").cast("timestamp_ntz")
    ).cast("string")
    # the cast leaves trailing zeros out, and the point with them
    fraction = F.rpad(F.substring(utc, 21, 6), 6, "0")
    return F.concat(F.substring(utc, 1, 19), F.lit("."), fraction)


def date_text(moment: Column) -> Column:
    """The day of a timestamp in UTC."""
    return F.substring(time_text(moment), 1, 10)


def parse_time(text: Column) -> Column:
    """Time text, with or without a fraction, as a timestamp; NULL if it is unreadable.

    A text without a zone is read as UTC, whatever zone the session has; one that names its zone,
    by that. The shape test keeps out texts the cast would complete by itself, such as a bare year
    or a bare clock time.
    """
    dated = (F.length(text) >= 19) & (F.substring(text, 5, 1) == "-")
    zoneless = F.concat(F.trim(text), F.lit("Z")).try_cast("timestamp")
    return F.when(dated, F.coalesce(zoneless, text.try_cast("timestamp")))


def safe_double(text: Column) -> Column:
    """A number given as JSON text, bare or quoted, as DOUBLE; NULL if it is no number."""
    return F.btrim(text, F.lit('"')).try_cast("double")


def rounded(value: Column, places: int = 2) -> Column:
    """``value`` as DOUBLE, rounded half up."""
    return F.round(value.try_cast("double"), places)


def utf8_bytes(text: Column) -> Column:
    # Spark keeps text as UTF-8, so the cast copies nothing; encode() would go by UTF-16.
    return text.cast("binary")


def json_payload(*fields: Column) -> Column:
    """A UTF-8 JSON object of the fields; a NULL is written as ``null``, not left out."""
    return utf8_bytes(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))
