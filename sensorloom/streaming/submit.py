"""Command line of the job, for ``spark-submit`` or ``python -m sensorloom.streaming.submit``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from sensorloom.functions.grading import DEFAULT_RANGES, load_ranges
from sensorloom.plans.job import Settings, Sinks, run_batch
from sensorloom.schemas import ARCHIVE_SCHEMA, SUMMARY_SCHEMA, load_schema
from sensorloom.session import pin_utc
from sensorloom.sinks.tables import Sink
from sensorloom.sources.messages import read_messages
from sensorloom.streaming.job import run_to_end, start_job

OUTPUTS = ("archive", "alerts", "merged", "summary", "outbox", "metrics", "rejects", "counts")


def key_value(text: str) -> tuple[str, str]:
    key, found, value = text.partition("=")
    if not found:
        raise argparse.ArgumentTypeError(f"{text!r} is not key=value")
    return key, value


def arguments(argv: Sequence[str] | None = None) -> tuple[argparse.Namespace, list[str]]:
    """The job's own options, and the rest, which are settings of the session."""
    parser = argparse.ArgumentParser(description="Archive, average and grade sensor messages.")
    parser.add_argument("--source-format", default="parquet")
    parser.add_argument("--source-path")
    parser.add_argument("--source-option", type=key_value, action="append", default=[])
    for output in OUTPUTS:
        parser.add_argument(f"--{output}-format", help="parquet unless given")
        parser.add_argument(f"--{output}-path")
        parser.add_argument(f"--{output}-table")
        parser.add_argument(f"--{output}-option", type=key_value, action="append", default=[])
    parser.add_argument("--archive-by-date", action="store_true")
    parser.add_argument("--archive-schema", help="declared schema file of the archive table")
    parser.add_argument("--summary-schema", help="declared schema file of the summary table")
    parser.add_argument("--ranges", help="JSON file with the table of status ranges")
    parser.add_argument("--window", default="1 minute")
    parser.add_argument("--delay", default="0 seconds")
    parser.add_argument("--event-time", choices=("time", "publish_time"), default="time")
    parser.add_argument("--merged", choices=("nested", "flat"), default="nested")
    parser.add_argument("--places", type=int, help="decimal places means are rounded to")
    parser.add_argument("--checkpoint")
    parser.add_argument("--trigger", default="10 seconds", help="an interval, or 'available-now'")
    parser.add_argument("--run-id", help="of a batch run: a repetition under it replaces the first")
    parser.add_argument("--batch", action="store_true", help="read the source once, as a table")
    return parser.parse_known_args(argv)


def sink_of(args: argparse.Namespace, output: str) -> Sink | None:
    path, table = getattr(args, f"{output}_path"), getattr(args, f"{output}_table")
    options, format = dict(getattr(args, f"{output}_option")), getattr(args, f"{output}_format")
    if not (path or table or options or format):
        return None
    by_date = output == "archive" and args.archive_by_date
    return Sink(
        format or "parquet",
        path,
        table,
        options,
        ("event_date",) if by_date else (),
    )


def sinks_of(args: argparse.Namespace) -> Sinks:
    """All outputs asked for, by a path, a table, an option or a format; it is an error to ask for
    none."""
    found = {output: sink_of(args, output) for output in OUTPUTS}
    if not any(found.values()):
        raise SystemExit(f"no output: give a path, table or format for one of {', '.join(OUTPUTS)}")
    return Sinks(**found)


def settings_of(args: argparse.Namespace) -> Settings:
    return Settings(
        ranges=load_ranges(args.ranges) if args.ranges else DEFAULT_RANGES,
        length=args.window,
        delay=args.delay,
        event_time=args.event_time,
        merged=args.merged,
        places=args.places,
        archive_schema=load_schema(args.archive_schema) if args.archive_schema else ARCHIVE_SCHEMA,
        summary_schema=load_schema(args.summary_schema) if args.summary_schema else SUMMARY_SCHEMA,
    )


def main(argv: Sequence[str] | None = None) -> None:
    args, rest = arguments(argv)
    sinks = sinks_of(args)
    builder = SparkSession.builder.appName("sensorloom")
    for option in rest:
        key, value = key_value(option.removeprefix("--"))
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    pin_utc(spark)
    messages = read_messages(
        spark, args.source_format, args.source_path, dict(args.source_option), not args.batch
    )
    if args.batch:
        run_batch(messages, sinks, settings_of(args), args.run_id)
        return
    trigger = (
        {"availableNow": True}
        if args.trigger == "available-now"
        else {"processingTime": args.trigger}
    )
    run_to_end(start_job(messages, sinks, settings_of(args), args.checkpoint, trigger))


if __name__ == "__main__":
    main()
