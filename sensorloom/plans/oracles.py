"""The registered queries as plain SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

READINGS = """
SELECT CAST(event_id AS VARCHAR) AS id, ts, event_type,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time,
       CAST(43.0 AS DOUBLE) + (k % 600) / CAST(100 AS DOUBLE) AS temperature,
       CAST(56.0 AS DOUBLE) + (k % 1800) / CAST(100 AS DOUBLE) AS pressure,
       CAST(7.0 AS DOUBLE) + (k % 1000) / CAST(100 AS DOUBLE) AS motor_power
FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS k FROM events) AS e
"""

# measure: noun, status prefix, summary prefix, green from, green to, yellow from, yellow to
LIMITS = {
    "temperature": ("temperature", "temp", "temp", 45, 47, 44, 48),
    "pressure": ("pressure", "pressure", "pressure", 60, 70, 58, 72),
    "motor_power": ("motor power", "mpower", "m", 11, 13, 9, 15),
}


def bucket(minutes: int) -> str:
    return f"time_bucket(INTERVAL {minutes} MINUTE, ts)"


def bounds(minutes: int = 1) -> str:
    return f"{bucket(minutes)} AS window_start, {bucket(minutes)} + INTERVAL {minutes} MINUTE AS window_end"


def colour(measure: str, value: str) -> str:
    _, _, _, g1, g2, y1, y2 = LIMITS[measure]
    return (
        f"CASE WHEN {value} IS NULL THEN NULL WHEN {value} >= {g1} AND {value} <= {g2} THEN 'green' "
        f"WHEN {value} >= {y1} AND {value} < {g1} OR {value} > {g2} AND {value} <= {y2} THEN 'yellow' "
        "ELSE 'red' END"
    )


def status(measure: str, value: str) -> str:
    return f"'{LIMITS[measure][1]}_' || {colour(measure, value)}"


def notification(measure: str, value: str) -> str:
    noun = LIMITS[measure][0]
    return (
        f"CASE {colour(measure, value)} "
        f"WHEN 'green' THEN 'The {noun} is in the optimum range.' "
        "WHEN 'yellow' THEN 'Caution! Actions might be neccessary, as the measured "
        f"{noun} is out of the optimum range.' "
        f"WHEN 'red' THEN 'Error! Machine is not working properly, the {noun} is way out of the "
        "optimum range. Help is needed.' END"
    )


def means(minutes: int = 1) -> str:
    columns = ", ".join(f"round(avg({m}), 6) AS {m}" for m in LIMITS)
    return (
        f"SELECT {bounds(minutes)}, {columns}, count(*) AS n, max(time) AS time "
        "FROM r GROUP BY 1, 2"
    )


def alerts(measures=tuple(LIMITS), extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT window_start, window_end, '{m}' AS measure, {m} AS mean, {status(m, m)} AS status, "
        f"{notification(m, m)} AS notification{extra} FROM w WHERE {m} IS NOT NULL"
        for m in measures
    )


def with_readings(body: str) -> str:
    return f"WITH r AS ({READINGS}) {body}"


def with_means(body: str, minutes: int = 1) -> str:
    return f"WITH r AS ({READINGS}), w AS ({means(minutes)}) {body}"


def with_alerts(body: str) -> str:
    return with_means("").rstrip() + f", a AS ({alerts()}) {body}"


def each(template: str, joiner: str = ", ") -> str:
    """The template once per measure."""
    return joiner.join(
        template.format(
            m=m,
            p=LIMITS[m][2],
            colour=colour(m, m),
            status=status(m, m),
            note=notification(m, m),
        )
        for m in LIMITS
    )


def mean_of(measure: str) -> str:
    return with_readings(
        f"SELECT {bounds()}, round(avg({measure}), 6) AS mean, count({measure}) AS n FROM r GROUP BY 1, 2"
    )


def status_of(measure: str) -> str:
    return with_means(
        f"SELECT window_start, window_end, mean, status, notification FROM ({alerts((measure,))}) AS a"
    )


SUMMARY_COLUMNS = ", ".join(
    [each("{m} AS {p}_mean"), each("{colour} AS {p}_status"), each("{note} AS {p}_notification")]
)

FIELD_PAIRS = each(
    "SELECT window_start, window_end, '{p}_mean' AS k, CAST({m} AS VARCHAR) AS v FROM w "
    "UNION ALL SELECT window_start, window_end, '{p}_status', {colour} FROM w "
    "UNION ALL SELECT window_start, window_end, '{p}_notification', {note} FROM w",
    " UNION ALL ",
)

END_TEXT = "strftime(window_end, '%Y-%m-%d %H:%M:%S.%f')"
BREAK = "chr(10) || '        ' || chr(10) || '        '"

SILENT = {"temperature": "signup", "pressure": "error", "motor_power": "purchase"}


def lone_mean(measure: str) -> str:
    return (
        f"SELECT {bounds()}, round(avg({measure}), 6) AS mean FROM r "
        f"WHERE event_type <> '{SILENT[measure]}' GROUP BY 1, 2"
    )


COGROUP = (
    f"SELECT window_start, window_end, t.mean AS temperature, p.mean AS pressure, "
    f"m.mean AS motor_power FROM ({lone_mean('temperature')}) AS t "
    f"FULL OUTER JOIN ({lone_mean('pressure')}) AS p USING (window_start, window_end) "
    f"FULL OUTER JOIN ({lone_mean('motor_power')}) AS m USING (window_start, window_end)"
)

ORACLES: dict[str, str] = {
    "window_alerts": with_means(alerts()),
    "hourly_alerts": with_means(alerts(), 60),
    "mean_temperature": mean_of("temperature"),
    "mean_pressure": mean_of("pressure"),
    "mean_motor_power": mean_of("motor_power"),
    "hourly_means": with_means(
        "SELECT window_start, window_end, temperature, pressure, motor_power, n FROM w", 60
    ),
    "status_temperature": status_of("temperature"),
    "status_pressure": status_of("pressure"),
    "status_motor_power": status_of("motor_power"),
    "grade_readings": with_readings(
        each("SELECT id, '{m}' AS measure, {m} AS value, {status} AS status FROM r", " UNION ALL ")
    ),
    "tumbling_counts": with_readings(f"SELECT {bounds()}, count(*) AS n FROM r GROUP BY 1, 2"),
    "assign_windows": with_readings(f"SELECT id, {bounds()} FROM r"),
    "extract_measures": with_readings("SELECT id, temperature, pressure, motor_power FROM r"),
    "rounded_measures": with_readings(
        "SELECT id, "
        + each(
            "round(TRY_CAST(CAST({m} + (CAST(id AS BIGINT) % 5) / CAST(1000 AS DOUBLE) AS VARCHAR) "
            "AS DOUBLE), 2) AS {m}"
        )
        + " FROM r"
    ),
    "time_pairs": with_readings("SELECT 'time' AS k, time AS v FROM r"),
    "shape_readings": with_readings("SELECT id, time, motor_power, pressure, temperature FROM r"),
    "parse_messages": with_readings(
        "SELECT id, time, motor_power, pressure, temperature, ts AS event_time FROM r"
    ),
    "decode_envelope": with_alerts("SELECT mean, status, notification FROM a"),
    "encode_readings": with_readings(
        "SELECT id, time, temperature, pressure, motor_power FROM r"
    ),
    "encode_alerts": with_alerts(
        f"SELECT window_start, window_end, measure, {END_TEXT} AS \"processingTime\", mean, status, "
        "notification FROM a"
    ),
    "archive_readings": with_readings(
        "SELECT id, time, " + each("CAST(CAST({m} AS DECIMAL(38, 9)) AS VARCHAR) AS {m}") + " FROM r"
    ),
    "window_summary": with_means(
        f"SELECT window_start, window_end, time, {SUMMARY_COLUMNS} FROM w"
    ),
    "summary_rows": with_means(
        "SELECT time, "
        + each("CAST(CAST({m} AS DECIMAL(38, 9)) AS VARCHAR) AS {p}_mean")
        + ", "
        + each("{colour} AS {p}_status, {note} AS {p}_notification")
        + " FROM w"
    ),
    "nested_alert": with_means(
        "SELECT window_start, window_end, "
        + each("{m} AS {m}_mean, {status} AS {m}_status, {note} AS {m}_notification")
        + " FROM w"
    ),
    "encode_nested": with_means(
        f"SELECT window_start, window_end, {END_TEXT} AS \"processingTime\", "
        + each("{m} AS {m}_mean, {status} AS {m}_status")
        + " FROM w"
    ),
    "flatten_pairs": with_means(
        f"SELECT {bounds()}, 'time' AS k, time AS v FROM r UNION ALL {FIELD_PAIRS}"
    ),
    "pairs_to_record": with_means(
        f"SELECT window_start, window_end, 'time' AS k, time AS v FROM w UNION ALL {FIELD_PAIRS}"
    ),
    "merge_records": with_means(
        each(
            "SELECT window_start, window_end, '{m}' AS k, CAST({m} AS VARCHAR) AS v FROM w",
            " UNION ALL ",
        )
    ),
    "cogroup_measures": with_readings(COGROUP),
    "cogroup_frames": with_means(
        "SELECT window_start, window_end, temperature, pressure, motor_power FROM w", 60
    ),
    "enrich_with_window": with_means(
        "SELECT id, r.temperature, w.temperature AS window_mean FROM r "
        f"LEFT JOIN w ON w.window_start = {bucket(1)}"
    ),
    "first_reading_per_window": with_readings(
        f"SELECT window_start, window_end, id FROM (SELECT {bounds()}, id, "
        f"row_number() OVER (PARTITION BY {bucket(1)} ORDER BY ts, id) AS place FROM r) AS o "
        "WHERE place = 1"
    ),
    "union_measures": with_readings(
        each("SELECT '{m}' AS measure, {m} AS value FROM r", " UNION ALL ")
    ),
    "alert_outbox": with_alerts(
        "SELECT window_start, window_end, measure, status, "
        "CASE WHEN status LIKE '%red%' THEN 'Critical failure detected! Please repare immediately' "
        "ELSE 'Warning! Error detected!' END AS subject, "
        f"{BREAK} || 'Status: ' || status || {BREAK} || "
        "CASE WHEN status LIKE '%red%' THEN 'Mean: ' || CAST(mean AS VARCHAR) "
        f"ELSE 'Processing time: ' || {END_TEXT} END || {BREAK} || 'Registry time: ' || {END_TEXT} "
        "AS body FROM a WHERE status LIKE '%red%' OR status LIKE '%yellow%'"
    ),
    "run_metrics": with_alerts(
        "SELECT measure, split_part(status, '_', 2) AS colour, count(*) AS n FROM a GROUP BY 1, 2"
    ),
    "dashboard_series": with_means(
        "SELECT window_start, window_end, temperature, pressure, motor_power FROM w"
    ),
}

# Payloads in the forms that senders get wrong, by the number of the row; then what is read of them.
GOOD = (
    """'{"id":"' || id || '",' || body || '}'"""
)
BODY = """'"time":"' || time || '","temperature":' || {t} || ',"pressure":' || {p} || ',"motor_power":' || {m}"""
TEXTS = {m: f"CAST({m} AS VARCHAR)" for m in LIMITS}


def body(**changed: str) -> str:
    v = {**TEXTS, **changed}
    return BODY.format(t=v["temperature"], p=v["pressure"], m=v["motor_power"])


REJECTED = {
    0: f"{GOOD} || ' and more {{}}'",
    1: f"{GOOD} || {GOOD}",
    2: f"{GOOD} || ',\"x\":{{\"y\":1}}'",
    3: f"'[' || {GOOD} || ']'",
    4: """'{"number":' || id || '}'""",
    12: f"({GOOD})[:-2]",
}
PAYLOADS = (
    f"SELECT *, CAST(id AS BIGINT) % 16 AS kind, {body()} AS body FROM r"
)
PARSED = (
    "SELECT kind, CASE kind "
    + " ".join(f"WHEN {kind} THEN {text}" for kind, text in REJECTED.items())
    + " END AS rejected, id, CASE kind WHEN 9 THEN 'soon' ELSE time END AS time, "
    "CASE WHEN kind IN (6, 8, 9) THEN NULL ELSE motor_power END AS motor_power, "
    "CASE WHEN kind = 6 THEN NULL ELSE pressure END AS pressure, "
    "CASE WHEN kind IN (6, 7, 9) THEN NULL ELSE temperature END AS temperature, "
    f"CASE WHEN kind <> 9 THEN ts END AS event_time FROM ({PAYLOADS})"
)
READ = ", ".join(
    f"CASE WHEN rejected IS NULL THEN {c} END AS {c}"
    for c in ("id", "time", "motor_power", "pressure", "temperature", "event_time")
)

# The stream of a replay: eight days to a delivery; what comes too late is left out, and so is what
# the last watermark does not close.
ON_TIME = "NOT (CAST(id AS BIGINT) % 40 = 0 AND day(ts) <= 8)"
CLOSED = "window_end <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM r)"
REPLAYED = (
    f"WITH r AS ({READINGS}), w AS (SELECT * FROM ({means().replace('FROM r', f'FROM r WHERE {ON_TIME}')}) "
    f"WHERE {CLOSED}), a AS ({alerts()}) "
)
KEY = (
    """sha256('{"window_start":"' || strftime(window_start, '%Y-%m-%d %H:%M:%S.%f') || '","measure":"' """
    """|| measure || '","mean":' || CAST(mean AS VARCHAR) || ',"status":"' || status || '","notification":"' """
    """|| notification || '"}')"""
)

HOURLY_VALUES = with_readings(
    "SELECT window_start, measure, CAST(row_number() OVER (PARTITION BY window_start, measure ORDER BY value) - 1 "
    "AS INTEGER) AS place, value FROM ("
    + " UNION ALL ".join(
        f"SELECT {bucket(60)} AS window_start, '{m}' AS measure, {m} AS value FROM r "
        f"WHERE event_type <> '{kind}'"
        for m, kind in SILENT.items()
    )
    + ")"
)


def latest(minutes: int, entries: str, windows: str = "") -> str:
    """The last entry of every key in each window; ``windows`` are those without entries."""
    return with_readings(
        f"SELECT window_start, window_end, k, kind, v FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY window_start, k ORDER BY ts DESC, number DESC) AS place FROM (SELECT {bounds(minutes)}, "
        f"ts, number, k, kind, v FROM (SELECT *, CAST(id AS BIGINT) AS number FROM r), LATERAL ({entries}))) "
        f"WHERE place = 1{windows}"
    )


ORACLES |= {
    "parse_faulty_messages": with_readings(f"SELECT {READ}, rejected FROM ({PARSED})"),
    "job_counts": with_readings(
        "SELECT count(*) AS messages, count(rejected) AS rejected, "
        "count(*) FILTER (rejected IS NULL AND event_time IS NULL) AS untimed, "
        "count(*) FILTER (rejected IS NULL) AS archived, count(rejected) AS kept_rejects "
        f"FROM ({PARSED})"
    ),
    "replayed_alerts": f"{REPLAYED} SELECT {KEY} AS key, mean, status, notification FROM a",
    "replayed_lookup": f"{REPLAYED} SELECT id, r.temperature, w.temperature AS window_mean FROM r "
    f"JOIN w ON w.window_start = {bucket(1)} WHERE {ON_TIME}",
    "cogroup_values": HOURLY_VALUES,
    "cogroup_lists": HOURLY_VALUES,
    "pairs_later_wins": latest(
        60,
        "SELECT 'temperature' AS k, 'DOUBLE' AS kind, CAST(temperature AS VARCHAR) AS v "
        "UNION ALL SELECT 'number', 'BIGINT', CAST(number % 1000 AS VARCHAR) "
        """UNION ALL SELECT 'third', 'STRING', '"' || time || '"' WHERE number % 3 = 0""",
    ),
    "merge_later_wins": latest(
        1,
        "SELECT 'pressure' AS k, 'DOUBLE' AS kind, CAST(pressure AS VARCHAR) AS v WHERE number % 2 = 0 "
        "UNION ALL SELECT 'n' || (number % 3), 'BIGINT', CAST(number AS VARCHAR) WHERE number % 2 = 0",
        f" UNION ALL SELECT {bounds()}, NULL, NULL, NULL FROM r GROUP BY 1, 2 "
        "HAVING bool_and(CAST(id AS BIGINT) % 2 = 1)",
    ),
    "record_functions": with_readings(
        "SELECT id, time, CAST(CASE WHEN even THEN 2 ELSE 3 END AS INTEGER) AS kept, "
        "CASE WHEN even THEN p ELSE t END AS k0, CASE WHEN NOT even THEN p END AS k1, id AS updated_k0, "
        "'x' AS updated_new, CAST(CASE WHEN even THEN 3 ELSE 4 END AS INTEGER) AS updated_size, "
        "CAST(CASE WHEN even THEN 1 ELSE 2 END AS INTEGER) AS without_time, "
        "CASE WHEN NOT even THEN p END AS one_entry, CAST(1 AS INTEGER) AS one_item, t AS first, "
        "CASE WHEN NOT even THEN p END AS first_k1 FROM (SELECT *, CAST(id AS BIGINT) % 2 = 0 AS even, "
        "CAST(temperature AS VARCHAR) AS t, CAST(pressure AS VARCHAR) AS p FROM r)"
    ),
    "history_by_name": with_readings("SELECT motor_power, pressure, temperature FROM r"),
    "declared_rows": with_readings(
        "SELECT CAST(id AS BIGINT) AS id, strftime(ts, '%Y-%m-%d') AS time, "
        "CAST(CAST(temperature AS DECIMAL(38, 9)) AS VARCHAR) AS temperature, "
        "CAST(trunc(pressure) AS BIGINT) AS pressure, CAST(motor_power AS VARCHAR) AS motor_power, "
        "CASE WHEN CAST(id AS BIGINT) % 3 <> 0 THEN temperature END AS kind FROM r"
    ),
    "message_ids": "SELECT count(*) AS n, count(*) AS ids, count(*) AS formed, CAST(1 AS BIGINT) AS times FROM events",
    "hourly_summary": with_means(
        f"SELECT window_start, window_end, time, {SUMMARY_COLUMNS} FROM w", 60
    ),
    "hourly_pairs": with_means(
        f"SELECT window_start, window_end, 'time' AS k, time AS v FROM w UNION ALL {FIELD_PAIRS}", 60
    ),
    "hourly_nested": with_means(
        "SELECT window_start, window_end, "
        + each("{m} AS {m}_mean, {status} AS {m}_status, {note} AS {m}_notification")
        + " FROM w",
        60,
    ),
    "hourly_lookup": with_means(
        "SELECT id, r.pressure, w.pressure AS window_mean FROM r "
        f"LEFT JOIN w ON w.window_start = {bucket(60)}",
        60,
    ),
}
