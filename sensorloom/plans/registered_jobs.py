"""Named queries that run a whole job, or keep more than one value for a key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import (
    first_item,
    last_wins,
    one_entry_map,
    one_item_list,
    pair,
    pairs_to_map,
    typed_pair,
    update_map,
    without_key,
)
from ..operators.alerts import encode_readings
from ..operators.combine import (
    combine_pairs,
    explode_pairs,
    measure_pairs,
    merge_records,
    nested_alert,
    window_summary,
)
from ..operators.joins import cogroup_lists, cogroup_values, enrich_stream, enrich_with_window
from ..operators.measures import keyed_records
from ..operators.windows import WINDOW, assign_windows, window_means
from ..schemas import ARCHIVE_SCHEMA, MEASURES, READING_FIELDS, schema_from_declaration
from ..sinks.metrics import totals
from ..sinks.tables import Sink, conform
from ..sources.history import HISTORY_COLUMNS, read_readings_csv, shape_readings
from ..sources.messages import CORRUPT, as_messages, parse_alerts, parse_messages
from .event_readings import faulty_readings_from_events, readings_from_events
from .job import Settings, Sinks, run_batch
from .replay import replay_job, replay_rows, shared_place

PLACES = 6
HOUR = "1 hour"
# Replay: parts, days in each, the rows that come with the last part whenever they were, and how
# long a window waits.
PARTS, DAYS, LATE, DELAY = 4, 8, 40, "10 minutes"
# Kinds of payload that a row can have, by its number.
FAULTS = 16


def faulty_payload() -> Column:
    """The payload of a reading from an event, in one of the forms that senders get wrong."""
    time = F.concat(F.lit('"time":"'), "time", F.lit('"'))
    head = F.concat(F.lit('{"id":"'), "id", F.lit('"'))
    values = {m: F.col(m).cast("string") for m in MEASURES}

    def measures(**changed: Column) -> Column:
        fields = [F.concat(F.lit(f'"{m}":'), v) for m, v in {**values, **changed}.items()]
        return F.concat_ws(",", time, *fields)

    good = F.concat(head, F.lit(","), measures(), F.lit("}"))
    quoted = F.concat(F.lit('"'), values["pressure"], F.lit('"'))
    forms = [
        F.concat(good, F.lit(" and more {}")),
        F.concat(good, good),
        F.concat(good, F.lit(',"x":{"y":1}')),
        F.concat(F.lit("["), good, F.lit("]")),
        F.concat(F.lit('{"number":'), "id", F.lit("}")),
        F.concat(head, F.lit(","), measures(pressure=quoted), F.lit("}")),
        F.concat(head, F.lit(","), time, F.lit("}")),
        F.concat(head, F.lit(","), measures(temperature=F.lit("null")), F.lit("}")),
        F.concat(head, F.lit(","), measures(motor_power=F.lit('"high"')), F.lit("}")),
        F.concat(head, F.lit(',"time":"soon","pressure":'), values["pressure"], F.lit("}")),
        F.concat(F.lit(" \n"), good, F.lit("\t")),
        F.concat(head, F.lit(',"more":{"time":["}"]},'), measures(), F.lit("}")),
        F.substring(good, F.lit(1), F.length(good) - 1),
    ]
    kind = F.col("id").cast("bigint") % FAULTS
    case = F.when(kind == 0, forms[0])
    for number, form in enumerate(forms[1:], 1):
        case = case.when(kind == number, form)
    return case.otherwise(good)


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = readings_from_events(spark, sf_dir)
    return as_messages(readings.select(faulty_payload().cast("binary").alias("data")))


def parse_faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_messages(faulty_messages(spark, sf_dir))
    return parsed.select(*READING_FIELDS, "event_time", F.col(CORRUPT).alias("rejected"))


def job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run over faulty messages counts, beside the rows it wrote; run twice under one name,
    it has written them once."""
    messages = faulty_messages(spark, sf_dir)
    place = shared_place(messages, "job-counts")
    sinks = Sinks(**{o: Sink(path=f"{place}/{o}") for o in ("archive", "rejects", "counts")})
    for _ in range(2):
        run_batch(messages, sinks, run_id="once")
    archived = sinks.archive.read(spark, ARCHIVE_SCHEMA).agg(F.count("*").alias("archived"))
    rejects = sinks.rejects.read(spark, f"{CORRUPT} string").agg(F.count("*").alias("kept_rejects"))
    return totals(sinks.counts.read(spark)).join(archived).join(rejects)


def _part() -> Column:
    """Eight days to a part; every fortieth row of the first one comes with the last."""
    day = F.floor((F.day("event_time") - 1) / DAYS).cast("int")
    late = (F.col("id").cast("bigint") % LATE == 0) & (day == 0)
    return F.when(late, PARTS - 1).otherwise(F.least(day, F.lit(PARTS - 1)))


def replayed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts of the streaming job for events that arrive in parts, some too late."""
    readings = readings_from_events(spark, sf_dir).withColumn("part", _part())
    sent = encode_readings(readings, keep=["part"]).withColumnRenamed("value", "data")
    place = shared_place(sent, "replayed-alerts")
    alerts = Sink(path=f"{place}/alerts")
    settings = Settings(places=PLACES, delay=DELAY)
    replay_job(sent, "part", PARTS, Sinks(alerts=alerts), settings, place)
    rows = parse_alerts(alerts.read(spark, "key string, value binary"))
    return rows.select("key", "mean", "status", "notification")


def replayed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading of the same stream with the mean of its window."""
    readings = readings_from_events(spark, sf_dir).withColumn("part", _part())

    def looked_up(rows: DataFrame) -> DataFrame:
        return enrich_stream(rows, "temperature", delay=DELAY, places=PLACES)

    place = shared_place(readings, "replayed-lookup")
    found = replay_rows(readings, "part", PARTS, looked_up, place)
    return found.select("id", "temperature", "window_mean")


def _listed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Lists as rows, each value with its place."""
    lists = rows.unpivot(["window_start"], columns, "measure", "values")
    return lists.select("window_start", "measure", F.posexplode("values").alias("place", "value"))


def cogroup_values_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    faulty = faulty_readings_from_events(spark, sf_dir)
    return _listed(cogroup_values(faulty, length=HOUR), list(MEASURES))


def cogroup_lists_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-group of measures that come as frames of their own, all values kept."""
    placed = assign_windows(faulty_readings_from_events(spark, sf_dir), HOUR)
    frames = {m: placed.filter(F.col(m).isNotNull()).select(*WINDOW, m) for m in MEASURES}
    frames = {m: frame.withColumnRenamed(m, "mean") for m, frame in frames.items()}
    return _listed(cogroup_lists(frames), list(MEASURES))


def _moment() -> Column:
    """An order in which no two readings are equal."""
    return F.struct("event_time", F.col("id").cast("bigint").alias("number"))


def _typed(records: DataFrame) -> DataFrame:
    """Records as rows that show the type of each value; an empty record is a row without a key."""
    rows = records.select(*WINDOW, F.explode_outer("record").alias("k", "v"))
    return rows.withColumns({"kind": F.schema_of_variant("v"), "v": F.to_json("v")})


def pairs_later_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value of every key in each hour, numbers as numbers."""
    placed = assign_windows(readings_from_events(spark, sf_dir), HOUR)
    number = F.col("id").cast("bigint")
    pairs = [
        typed_pair("temperature", F.col("temperature")),
        typed_pair("number", number % 1000),
        F.when(number % 3 == 0, typed_pair("third", F.col("time"))),
    ]
    bag = placed.select(*WINDOW, _moment().alias("at"), F.inline(F.array_compact(F.array(*pairs))))
    return _typed(combine_pairs(bag, order="at"))


def merge_later_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of each minute merged; every second reading has an empty one."""
    placed = assign_windows(readings_from_events(spark, sf_dir))
    number = F.col("id").cast("bigint")
    entry = typed_pair("pressure", F.col("pressure"))
    name = F.concat(F.lit("n"), (number % 3).cast("string"))
    count = F.struct(name.alias("k"), number.cast("variant").alias("v"))
    none = F.slice(F.array(entry), 1, 0)
    record = F.map_from_entries(F.when(number % 2 == 0, F.array(entry, count)).otherwise(none))
    records = placed.select(*WINDOW, _moment().alias("at"), record.alias("record"))
    return _typed(merge_records(records, order="at"))


def record_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The functions on pairs, maps and lists, on the fields of every reading."""
    readings = keyed_records(readings_from_events(spark, sf_dir))

    def field(name: str) -> Column:
        return F.col(f"record.{name}")

    kind = F.concat(F.lit("k"), (field("id").cast("bigint") % 2).cast("string"))
    pairs = F.array(
        pair("k0", field("temperature")),
        F.struct(kind.alias("k"), field("pressure").cast("string").alias("v")),
        pair("time", field("time")),
    )
    rows = readings.select("key", field("id").alias("id"), pairs.alias("pairs"))
    base = pairs_to_map(F.col("pairs"))
    changes = F.create_map(F.lit("k0"), F.col("id"), F.lit("new"), F.lit("x"))
    updated = update_map(base, changes)
    return rows.select(
        "id",
        F.col("key").alias("time"),
        F.size(last_wins(F.col("pairs"))).alias("kept"),
        base["k0"].alias("k0"),
        F.try_element_at(base, F.lit("k1")).alias("k1"),
        updated["k0"].alias("updated_k0"),
        updated["new"].alias("updated_new"),
        F.size(updated).alias("updated_size"),
        F.size(without_key(base, "time")).alias("without_time"),
        one_entry_map(F.col("pairs")[1])["k1"].alias("one_entry"),
        F.size(one_item_list(F.col("id"))).alias("one_item"),
        first_item(F.col("pairs"))["v"].alias("first"),
        first_item(F.filter("pairs", lambda p: p["k"] == "k1"))["v"].alias("first_k1"),
    )


def history_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings written as CSV history with columns in two orders, and read back by their names."""
    readings = readings_from_events(spark, sf_dir)
    names = {m: F.col(m).alias(name) for m, name in HISTORY_COLUMNS.items()}
    place = shared_place(readings, "history")
    number = F.col("id").cast("bigint")
    for part, order in enumerate((list(names), [*reversed(names)])):
        some = readings.where(number % 2 == part).select("id", *[names[m] for m in order])
        some.write.option("header", True).csv(f"{place}/{part}")
    history = read_readings_csv(spark, [f"{place}/{part}" for part in (0, 1)])
    return history.select(*[F.col(f"`{name}`").alias(m) for m, name in HISTORY_COLUMNS.items()])


def declared_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as the rows of a table declared field by field, what does not fit being NULL."""
    declared = schema_from_declaration(
        {
            "fields": [
                {"name": "id", "type": "INTEGER", "mode": "REQUIRED"},
                {"name": "time", "type": "DATE"},
                {"name": "temperature", "type": "NUMERIC"},
                {"name": "pressure", "type": "INT64"},
                {"name": "motor_power", "type": "STRING"},
                {"name": "kind", "type": "FLOAT"},
            ]
        }
    )
    readings = readings_from_events(spark, sf_dir)
    number = F.col("id").cast("bigint")
    kind = F.when(number % 3 == 0, F.lit("none")).otherwise(F.col("temperature").cast("string"))
    rows = conform(readings.withColumn("kind", kind), declared)
    return rows.withColumns({c: F.col(c).cast("string") for c in ("time", "temperature")})


def message_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be said of random ids: every history row has one of its own, of the usual form."""
    readings = readings_from_events(spark, sf_dir)
    history = readings.select(*[F.col(m).alias(name) for m, name in HISTORY_COLUMNS.items()])
    form = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return shape_readings(history).agg(
        F.count("*").alias("n"),
        F.count_distinct("id").alias("ids"),
        F.count(F.when(F.col("id").rlike(form), 1)).alias("formed"),
        F.count_distinct("time").alias("times"),
    )


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_means(readings_from_events(spark, sf_dir), length=HOUR, places=PLACES)


def hourly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_summary(_hourly(spark, sf_dir))


def hourly_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_pairs(measure_pairs(_hourly(spark, sf_dir), with_time=True))


def hourly_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = nested_alert(_hourly(spark, sf_dir))
    names = {"temperature": "temperature", "pressure": "pressure", "motorpower": "motor_power"}
    leaves = [(k, n, leaf) for k, n in names.items() for leaf in ("mean", "status", "notification")]
    return nested.select(*WINDOW, *[F.col(f"{k}.{leaf}").alias(f"{n}_{leaf}") for k, n, leaf in leaves])


def hourly_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = readings_from_events(spark, sf_dir)
    found = enrich_with_window(readings, "pressure", HOUR, places=PLACES)
    return found.select("id", "pressure", "window_mean")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_faulty_messages": parse_faulty_messages,
    "job_counts": job_counts,
    "replayed_alerts": replayed_alerts,
    "replayed_lookup": replayed_lookup,
    "cogroup_values": cogroup_values_query,
    "cogroup_lists": cogroup_lists_query,
    "pairs_later_wins": pairs_later_wins,
    "merge_later_wins": merge_later_wins,
    "record_functions": record_functions,
    "history_by_name": history_by_name,
    "declared_rows": declared_rows,
    "message_ids": message_ids,
    "hourly_summary": hourly_summary,
    "hourly_pairs": hourly_pairs,
    "hourly_nested": hourly_nested,
    "hourly_lookup": hourly_lookup,
}
