"""DuckDB SQL answering the same questions as ``catalog.QUERIES``.

Written independently of the Spark code: plain SQL over the driver's
tables (views ``events`` etc.). Means and rates are computed the same
exact way on both sides (decimal sums, one double division) so results
compare value for value. Table decimals use the text form of the double
(``cast(cast(x as varchar) as decimal)``) to round half-up like Spark.
"""

from __future__ import annotations

from tidemark.functions.time import duration_seconds, epoch_ms
from tidemark.plans import derived as P
from tidemark.schemas import WATERMARK_DELAY

DAY_MS = 86_400_000
RANGE_S, STEP_S, LOOKBACK_S = 2 * 86400, 6 * 3600, 86400
RANGE_US, STEP_US, LOOKBACK_US = RANGE_S * 10**6, STEP_S * 10**6, LOOKBACK_S * 10**6


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


READINGS = """readings AS (
  SELECT event_id, 'Sensor-' || CAST(user_id AS VARCHAR) AS sensor_id, ts AS "timestamp",
         CAST(value AS DOUBLE) AS temperature,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity
  FROM events)"""

ACCEPTED = """accepted AS (
  SELECT * FROM readings
  WHERE sensor_id IS NOT NULL AND "timestamp" IS NOT NULL
    AND temperature IS NOT NULL AND humidity IS NOT NULL
    AND length(sensor_id) BETWEEN 1 AND 100
    AND temperature BETWEEN -273.15 AND 200 AND humidity BETWEEN 0 AND 100)"""


def _mean(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(24,6))) AS DOUBLE) / COUNT({col})"


def window_cte(name: str, width_ms: int, source: str = "accepted") -> str:
    return f"""{name} AS (
  SELECT sensor_id, epoch_us("timestamp") // {width_ms * 1000} * {width_ms} AS "timestamp",
         {_mean('temperature')} AS temperature, {_mean('humidity')} AS humidity
  FROM {source} GROUP BY 1, 2)"""


def _table_decimal(col: str) -> str:
    return f"CAST(round(CAST(CAST({col} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DECIMAL(5,2))"


TABLE = f"""tbl AS (
  SELECT sensor_id, "timestamp", {_table_decimal('temperature')} AS temperature,
         {_table_decimal('humidity')} AS humidity, TIMESTAMP '{P.TABLE_AS_OF}' AS created_at
  FROM wm30
  WHERE sensor_id IS NOT NULL AND length(sensor_id) <= 50
    AND temperature IS NOT NULL AND humidity IS NOT NULL)"""

TABLE_CTES = (READINGS, ACCEPTED, window_cte("wm30", 30_000), TABLE)

AS_OF = f"TIMESTAMP '{P.INGEST_AS_OF}'"
CHECKED = f"""checked AS (
  SELECT *, concat_ws(';',
    CASE WHEN sensor_id IS NULL THEN 'missing:sensor_id' END,
    CASE WHEN "timestamp" IS NULL THEN 'missing:timestamp' END,
    CASE WHEN temperature IS NULL THEN 'missing:temperature' END,
    CASE WHEN humidity IS NULL THEN 'missing:humidity' END,
    CASE WHEN sensor_id IS NOT NULL AND NOT (length(sensor_id) BETWEEN 1 AND 100) THEN 'sensor_id_length' END,
    CASE WHEN "timestamp" > {AS_OF} + INTERVAL 1 DAY THEN 'timestamp_future' END,
    CASE WHEN "timestamp" < {AS_OF} - INTERVAL 1 DAY THEN 'timestamp_past' END,
    CASE WHEN temperature IS NOT NULL AND NOT (temperature BETWEEN -273.15 AND 200) THEN 'temperature_out_of_range' END,
    CASE WHEN humidity IS NOT NULL AND NOT (humidity BETWEEN 0 AND 100) THEN 'humidity_out_of_range' END
  ) AS reason
  FROM readings)"""

STATS_SQL = """(SELECT count(*) AS attempted,
          count(*) FILTER (WHERE reason = '') AS accepted,
          count(*) FILTER (WHERE reason <> '') AS rejected,
          coalesce((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / CAST(1000000.0 AS DOUBLE), 0.0) AS span_seconds
          {select_by}
   FROM checked {group_by})"""


def _ingest_stats(by: str | None) -> str:
    inner = STATS_SQL.format(
        select_by=f", {by}" if by else "",
        group_by=f"GROUP BY {by}" if by else "",
    )
    cols = f"{by}, " if by else ""
    return _with(READINGS, CHECKED) + f"""
SELECT {cols}attempted, accepted, rejected, span_seconds,
       CASE WHEN span_seconds > 0 THEN accepted / span_seconds ELSE 0.0 END AS rate_per_second
FROM {inner} s"""


# The stream over defective messages: four arrivals by event_id, each one batch.
CHANGELOG = f"""bounds AS (SELECT min(event_id) AS lo, max(event_id) + 1 AS hi FROM accepted),
sent AS (
  SELECT * REPLACE (CASE WHEN sensor_id LIKE '%7' THEN sensor_id || '-' || repeat('x', 50) ELSE sensor_id END AS sensor_id),
         (event_id - lo) // greatest(1, (hi - lo + 3) // 4) AS batch_id
  FROM accepted, bounds WHERE event_id % 29 NOT IN (7, 11, 13)),
parts AS (
  SELECT sensor_id, epoch_us("timestamp") // {DAY_MS * 1000} * {DAY_MS} AS "timestamp", batch_id,
         SUM(CAST(temperature AS DECIMAL(24,6))) AS t_sum, COUNT(temperature) AS t_n,
         SUM(CAST(humidity AS DECIMAL(24,6))) AS h_sum, COUNT(humidity) AS h_n
  FROM sent GROUP BY 1, 2, 3),
means AS (
  SELECT sensor_id, "timestamp", batch_id,
         CAST(SUM(t_sum) OVER w AS DOUBLE) / CAST(SUM(t_n) OVER w AS DOUBLE) AS temperature,
         CAST(SUM(h_sum) OVER w AS DOUBLE) / CAST(SUM(h_n) OVER w AS DOUBLE) AS humidity
  FROM parts
  WINDOW w AS (PARTITION BY sensor_id, "timestamp" ORDER BY batch_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
log AS (
  SELECT sensor_id, "timestamp", batch_id, {_table_decimal('temperature')} AS temperature,
         {_table_decimal('humidity')} AS humidity
  FROM means WHERE length(sensor_id) <= 50)"""


# Four interleaved parts of the accepted readings, each stored as one batch.
BATCH_ROWS = f"""upd AS (
  SELECT sensor_id, epoch_us("timestamp") // {DAY_MS * 1000} * {DAY_MS} AS "timestamp", event_id % 4 AS batch_id,
         {_mean('temperature')} AS temperature, {_mean('humidity')} AS humidity
  FROM accepted GROUP BY ALL)"""


# Text input of clients: what each kind of event becomes, and which of it fails to parse.
CLIENT = f"""client AS (
  SELECT event_id,
         CASE event_id % 17 WHEN 1 THEN '' WHEN 2 THEN repeat(sensor_id, 30) ELSE sensor_id END AS sensor_id,
         CASE WHEN event_id % 17 IN (5, 6) THEN NULL ELSE "timestamp" END AS "timestamp",
         "timestamp" IS NULL AS no_time,
         CASE WHEN event_id % 17 IN (7, 8, 11) THEN NULL WHEN event_id % 17 = 9 THEN CAST('Infinity' AS DOUBLE)
              WHEN event_id % 17 = 10 THEN 12.5 ELSE temperature END AS temperature,
         temperature IS NULL AND event_id % 17 NOT IN (8, 9, 10, 11) AS no_temperature,
         CASE WHEN event_id % 17 IN (13, 14) THEN NULL WHEN event_id % 17 = 12 THEN CAST('NaN' AS DOUBLE) ELSE humidity END AS humidity,
         event_id % 17 = 13 OR (humidity IS NULL AND event_id % 17 NOT IN (12, 14)) AS no_humidity
  FROM readings),
judged AS (
  SELECT *, concat_ws(';',
    CASE WHEN sensor_id IS NULL THEN 'missing:sensor_id' END,
    CASE WHEN no_time THEN 'missing:timestamp' END,
    CASE WHEN no_temperature THEN 'missing:temperature' END,
    CASE WHEN no_humidity THEN 'missing:humidity' END,
    CASE WHEN sensor_id IS NOT NULL AND NOT (length(sensor_id) BETWEEN 1 AND 100) THEN 'sensor_id_length' END,
    CASE WHEN NOT no_time AND "timestamp" IS NULL THEN 'timestamp_unparseable' END,
    CASE WHEN "timestamp" > {AS_OF} + INTERVAL 1 DAY THEN 'timestamp_future' END,
    CASE WHEN "timestamp" < {AS_OF} - INTERVAL 1 DAY THEN 'timestamp_past' END,
    CASE WHEN NOT no_temperature AND temperature IS NULL THEN 'temperature_invalid' END,
    CASE WHEN temperature IS NOT NULL AND NOT (temperature BETWEEN -273.15 AND 200) THEN 'temperature_out_of_range' END,
    CASE WHEN NOT no_humidity AND humidity IS NULL THEN 'humidity_invalid' END,
    CASE WHEN humidity IS NOT NULL AND NOT (humidity BETWEEN 0 AND 100) THEN 'humidity_out_of_range' END
  ) AS reason
  FROM client)"""


def _stored_batches(direction: str = "DESC") -> str:
    return _with(READINGS, ACCEPTED, BATCH_ROWS) + f"""
SELECT sensor_id, "timestamp", {_table_decimal('temperature')} AS temperature, {_table_decimal('humidity')} AS humidity,
       TIMESTAMP '{P.TABLE_AS_OF}' + to_minutes(batch_id::INT) AS created_at
FROM upd QUALIFY row_number() OVER (PARTITION BY sensor_id, "timestamp" ORDER BY batch_id {direction}) = 1"""


# The stream with delayed messages: three arrivals by event_id, some messages one or two arrivals late.
LATE = """bounds AS (SELECT min(event_id) AS lo, max(event_id) + 1 AS hi FROM accepted),
judged AS (
  SELECT event_id, "timestamp", temperature, humidity, event_id % 29 IN (7, 11, 13) AS rejected,
         CASE WHEN sensor_id LIKE '%7' THEN sensor_id || '-' || repeat('x', 50) ELSE sensor_id END AS sensor_id,
         dense_rank() OVER (ORDER BY (event_id - lo) // greatest(1, (hi - lo + 2) // 3)
                                     + CASE event_id % 17 WHEN 5 THEN 1 WHEN 9 THEN 2 ELSE 0 END) - 1 AS batch_id
  FROM accepted, bounds),
seen AS (
  SELECT batch_id, max(max(epoch_ms("timestamp")) FILTER (WHERE NOT rejected))
           OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS seen_ms
  FROM judged GROUP BY batch_id),
marked AS (
  SELECT judged.*, NOT rejected AND epoch_us("timestamp") // 30000000 * 30000 + 30000 <= greatest(0, coalesce(seen_ms, 0) - 60000) AS late
  FROM judged JOIN seen USING (batch_id)),
kept AS (SELECT * FROM marked WHERE NOT rejected AND NOT late AND length(sensor_id) <= 50)"""


def _collapse(direction: str) -> str:
    return _with(READINGS, ACCEPTED, CHANGELOG) + f"""
SELECT sensor_id, "timestamp", batch_id, temperature, humidity FROM log
QUALIFY row_number() OVER (PARTITION BY sensor_id, "timestamp" ORDER BY batch_id {direction}) = 1"""


def _ms(bound: str) -> int:
    return epoch_ms(bound)


def _stats(where: str, start: str, end: str) -> str:
    def agg(m: str) -> str:
        return (
            f"coalesce(CAST(min({m}) AS DOUBLE), 0.0) AS {m}_min, "
            f"coalesce(CAST(max({m}) AS DOUBLE), 0.0) AS {m}_max, "
            f"coalesce(CAST(sum({m}) AS DOUBLE) / CAST(count({m}) AS DOUBLE), 0.0) AS {m}_avg"
        )

    return _with(*TABLE_CTES) + f"""
SELECT sensor_id, TIMESTAMP '{start}' AS period_start, TIMESTAMP '{end}' AS period_end,
       {agg('temperature')}, {agg('humidity')}, count(*) AS reading_count
FROM tbl WHERE "timestamp" BETWEEN {_ms(start)} AND {_ms(end)} {where}
GROUP BY sensor_id"""


# --- metric samples and rates (F8, M1) ---------------------------------------
SAMPLES = """ev AS (
  SELECT user_id, event_id, ts, CAST(value AS DECIMAL(38,6)) AS amount FROM events),
first_ns AS (
  SELECT user_id, first(event_type ORDER BY ts, event_id) AS namespace FROM events GROUP BY user_id),
counters AS (
  SELECT user_id, event_id, ts, SUM(amount) OVER w AS vsum, COUNT(*) OVER w AS vcnt
  FROM ev
  WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
samples AS (
  SELECT 'events_value_total' AS metric, f.namespace, CAST(c.user_id AS VARCHAR) AS pod,
         CASE WHEN c.user_id % 7 <> 3 THEN 'sensor' END AS container, c.ts,
         CASE WHEN c.event_id % 13 <> 5 THEN CAST(c.vsum AS DECIMAL(38,6)) END AS value
  FROM counters c JOIN first_ns f ON c.user_id IS NOT DISTINCT FROM f.user_id
  UNION ALL
  SELECT 'events_count_total', f.namespace, CAST(c.user_id AS VARCHAR),
         CASE WHEN c.user_id % 7 <> 3 THEN 'sensor' END, c.ts,
         CASE WHEN c.event_id % 13 <> 5 THEN CAST(c.vcnt AS DECIMAL(38,6)) END
  FROM counters c JOIN first_ns f ON c.user_id IS NOT DISTINCT FROM f.user_id)"""

RATES = f"""prev AS (
  SELECT *, lag(ts) OVER s AS prev_ts, lag(value) OVER s AS prev_value
  FROM samples WHERE value IS NOT NULL
  WINDOW s AS (PARTITION BY metric, namespace, pod, container ORDER BY ts, value)),
pairs AS (
  SELECT metric, namespace, pod, container,
         CASE WHEN value >= prev_value THEN value - prev_value ELSE value END AS delta,
         (epoch_us(ts) + {STEP_US} - 1) // {STEP_US} AS lo,
         (epoch_us(prev_ts) + {RANGE_US} + {STEP_US} - 1) // {STEP_US} - 1 AS hi
  FROM prev WHERE prev_ts IS NOT NULL),
fan AS (
  SELECT metric, namespace, pod, container, delta, unnest(range(lo, hi + 1)) AS k
  FROM pairs WHERE lo <= hi),
rates AS (
  SELECT metric, namespace, pod, container, make_timestamp(k * {STEP_US}) AS t,
         SUM(delta) AS increase
  FROM fan GROUP BY metric, namespace, pod, container, k)"""

RATE_CTES = (SAMPLES, RATES)


def _rate(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE) / CAST({RANGE_S} AS DOUBLE)"


def _instant(metric: str) -> str:
    return f"""inst AS (
  SELECT metric, namespace, pod, container, make_timestamp(k * {STEP_US}) AS t,
         max(struct_pack(a := ts, b := value)).b AS value
  FROM (SELECT *, unnest(range((epoch_us(ts) + {STEP_US} - 1) // {STEP_US},
                              (epoch_us(ts) + {LOOKBACK_US} + {STEP_US} - 1) // {STEP_US})) AS k
        FROM samples WHERE metric = '{metric}' AND value IS NOT NULL)
  GROUP BY metric, namespace, pod, container, k)"""


VALUE_BY_NS = """by_ns AS (
  SELECT t, namespace, SUM(increase) AS increase FROM rates
  WHERE metric = 'events_value_total' GROUP BY t, namespace)"""

FULL_LO, FULL_HI = _ms(P.FULL_PERIOD[0]), _ms(P.FULL_PERIOD[1])


# The damaged table of ``audit_findings``.
DAMAGED = """damaged AS (
  SELECT CASE "timestamp" // 30000 % 503 WHEN 20 THEN sensor_id || '-x' ELSE sensor_id END AS sensor_id, "timestamp",
         CASE "timestamp" // 30000 % 503 WHEN 18 THEN NULL ELSE temperature END AS temperature,
         CASE "timestamp" // 30000 % 503 WHEN 19 THEN 1.25 ELSE humidity END AS humidity
  FROM tbl WHERE "timestamp" // 30000 % 503 <> 17)"""


# The watermark after the last message (one row).
CLOSING = f"""closing AS (SELECT epoch_ms(max("timestamp")) - {duration_seconds(WATERMARK_DELAY) * 1000} AS watermark FROM accepted)"""


def _upkeep(listed: str, integrity: str, day_means: str, stream_rows: str) -> dict[str, str]:
    stats = ", ".join(f"min({m}) AS {m}_min, max({m}) AS {m}_max, {_mean(m)} AS {m}_avg" for m in ("temperature", "humidity"))
    return {
        "list_sensors_maintained": listed,
        "overview_maintained": _with(READINGS, ACCEPTED, BATCH_ROWS)
        + """SELECT sensor_id, min("timestamp") AS first_ts, max("timestamp") AS latest_ts,
       count(DISTINCT "timestamp") AS reading_count FROM upd GROUP BY sensor_id""",
        "audit_integrity_digests": integrity,
        "audit_findings": _with(*TABLE_CTES, DAMAGED)
        + f"""SELECT * FROM (
  SELECT coalesce(w.sensor_id, t.sensor_id) AS sensor_id, coalesce(w."timestamp", t."timestamp") AS "timestamp",
         CASE WHEN t.sensor_id IS NULL THEN 'missing' WHEN w.sensor_id IS NULL THEN 'unexpected'
              WHEN {_table_decimal('w.temperature')} IS NOT DISTINCT FROM t.temperature
                   AND {_table_decimal('w.humidity')} IS NOT DISTINCT FROM t.humidity THEN 'match'
              ELSE 'mismatch' END AS status
  FROM wm30 w FULL OUTER JOIN damaged t ON w.sensor_id = t.sensor_id AND w."timestamp" = t."timestamp")
WHERE status <> 'match'""",
        "window_mean_merged": day_means.replace("SELECT * FROM wm", """SELECT wm.*, n.readings FROM wm JOIN (
  SELECT sensor_id, epoch_us("timestamp") // 86400000000 * 86400000 AS "timestamp", count(*) AS readings FROM accepted GROUP BY 1, 2) n
  ON wm.sensor_id = n.sensor_id AND wm."timestamp" = n."timestamp\""""),
        "weighted_sensor_stats": _with(READINGS, ACCEPTED) + f"SELECT sensor_id, {stats}, count(*) AS readings FROM accepted GROUP BY sensor_id",
        "stream_limited": stream_rows,
        "stream_archive": _with(READINGS, ACCEPTED, window_cte("wm", DAY_MS), CLOSING)
        + """SELECT wm.*, CAST(make_timestamp("timestamp" * 1000) AS DATE) AS date FROM wm, closing WHERE "timestamp" + 86400000 <= watermark""",
        "stream_open_windows": _with(READINGS, ACCEPTED, window_cte("wm", DAY_MS), CLOSING)
        + """SELECT wm.* FROM wm, closing WHERE "timestamp" + 86400000 > watermark""",
        "ingest_client_input": _with(READINGS, CLIENT)
        + """SELECT event_id, reason, CASE WHEN reason = '' THEN sensor_id END AS key, CASE WHEN reason = '' THEN sensor_id END AS sensor_id,
       CASE WHEN reason = '' THEN "timestamp" END AS "timestamp", CASE WHEN reason = '' THEN temperature END AS temperature,
       CASE WHEN reason = '' THEN humidity END AS humidity
FROM judged""",
    }


def oracle_sql() -> dict[str, str]:
    sql = _oracle_sql()
    return {**sql, **_upkeep(*(sql[q] for q in ("list_sensors", "audit_integrity", "window_mean_1d", "stream_window_mean")))}


def _oracle_sql() -> dict[str, str]:
    lo, hi = _ms(P.PERIOD[0]), _ms(P.PERIOD[1])
    purged = ", ".join(f"'{s}'" for s in P.PURGED)
    stats_end = P.STATS_AS_OF
    import datetime as _dt

    stats_start = (_dt.datetime.fromisoformat(stats_end) - _dt.timedelta(days=7)).isoformat()
    matched = (
        _with(
            SAMPLES,
            """matched AS (SELECT * FROM samples WHERE metric = 'events_value_total'
  AND regexp_full_match(coalesce(namespace, ''), '(?:click|view)')
  AND coalesce(container, '') <> '' AND coalesce(pod, '') <> '1')""",
            RATES.replace("FROM samples", "FROM matched"),
        )
        + f"""SELECT t, namespace, SUM(increase) AS increase, {_rate('SUM(increase)')} AS rate FROM rates
WHERE t BETWEEN TIMESTAMP '{P.RATE_PERIOD[0]}' AND TIMESTAMP '{P.RATE_PERIOD[1]}' GROUP BY t, namespace"""
    )
    return {
        "window_mean_30s": _with(READINGS, ACCEPTED, window_cte("wm", 30_000)) + "SELECT * FROM wm",
        "window_mean_1d": _with(READINGS, ACCEPTED, window_cte("wm", DAY_MS)) + "SELECT * FROM wm",
        "ingest_valid": _with(READINGS, CHECKED)
        + 'SELECT event_id, sensor_id, "timestamp", temperature, humidity FROM checked WHERE reason = \'\'',
        "ingest_rejects": _with(READINGS, CHECKED)
        + 'SELECT event_id, sensor_id, "timestamp", reason FROM checked WHERE reason <> \'\'',
        "ingest_suspicious": _with(READINGS, CHECKED)
        + f"""SELECT event_id, sensor_id, "timestamp", suspicious, lead_seconds FROM (
  SELECT *, CASE WHEN "timestamp" > {AS_OF} + INTERVAL 5 MINUTE THEN 'future'
                 WHEN "timestamp" < {AS_OF} - INTERVAL 10 HOUR THEN 'past' END AS suspicious,
            (epoch_us("timestamp") - epoch_us({AS_OF})) / CAST(1000000.0 AS DOUBLE) AS lead_seconds
  FROM checked WHERE reason = '') WHERE suspicious IS NOT NULL""",
        "ingest_stats": _ingest_stats(None),
        "ingest_stats_by_sensor": _ingest_stats("sensor_id"),
        "message_roundtrip": _with(READINGS)
        + 'SELECT event_id, sensor_id AS key, sensor_id, "timestamp", temperature, humidity FROM readings',
        "envelope_roundtrip": _with(READINGS, ACCEPTED, window_cte("wm", 30_000))
        + "SELECT *, 'analytics_data' AS schema_name, '' AS reason FROM wm",
        "table_rows": _with(*TABLE_CTES) + "SELECT * FROM tbl",
        "stream_window_mean": _with(READINGS, ACCEPTED, window_cte("wm", DAY_MS))
        + f"""SELECT sensor_id, "timestamp", {_table_decimal('temperature')} AS temperature,
       {_table_decimal('humidity')} AS humidity FROM wm""",
        "archive_readback": _with(READINGS, ACCEPTED, window_cte("wm", 30_000))
        + 'SELECT *, CAST(make_timestamp("timestamp" * 1000) AS DATE) AS date FROM wm',
        "dead_letters": _with(READINGS, ACCEPTED, CHANGELOG)
        + """SELECT sensor_id, "timestamp", batch_id, 'sensor_id_too_long' AS reason FROM means WHERE length(sensor_id) > 50
UNION ALL
SELECT sensor_id, "timestamp", batch_id, 'duplicate_key' FROM (SELECT * FROM log
  QUALIFY row_number() OVER (PARTITION BY sensor_id, "timestamp" ORDER BY batch_id) > 1)""",
        "stream_rejects": _with(READINGS, ACCEPTED)
        + """SELECT 'sensor-data' AS topic, 0 AS partition, event_id AS "offset",
       CASE event_id % 29 WHEN 7 THEN 'message_malformed' WHEN 11 THEN 'timestamp_unparseable' ELSE 'missing:sensor_id' END AS reason
FROM accepted WHERE event_id % 29 IN (7, 11, 13)""",
        "envelope_dead_letters": _with(READINGS, ACCEPTED, window_cte("wm", 30_000))
        + """SELECT CASE "timestamp" // 30000 % 17 WHEN 3 THEN 'schema_missing' WHEN 5 THEN 'payload_missing:temperature'
            WHEN 8 THEN 'envelope_malformed' ELSE 'payload_missing:timestamp' END AS reason, count(*) AS rows
FROM wm WHERE "timestamp" // 30000 % 17 IN (3, 5, 8, 9) GROUP BY 1""",
        "compacted_readback": _stored_batches(),
        "compacted_first": _stored_batches("ASC"),
        "purged_store": f"SELECT * FROM ({_stored_batches()}) WHERE sensor_id NOT IN ({purged})",
        "recent_arrivals": f'SELECT * FROM ({_stored_batches()}) ORDER BY created_at DESC, "timestamp" DESC, sensor_id LIMIT 25',
        "late_rows": _with(READINGS, ACCEPTED, LATE)
        + """SELECT 'sensor-data' AS topic, 0 AS partition, event_id AS "offset", sensor_id, "timestamp" AS event_time, batch_id, 'late' AS reason
FROM marked WHERE late""",
        "stream_accounts": _with(READINGS, ACCEPTED, LATE)
        + """SELECT batch_id, count(*) AS messages, count(*) FILTER (WHERE NOT rejected AND NOT late) AS accepted,
       count(*) FILTER (WHERE rejected) AS rejected, count(*) FILTER (WHERE late) AS late FROM marked GROUP BY batch_id""",
        "late_window_mean": _with(READINGS, ACCEPTED, LATE, window_cte("wm", 30_000, "kept"))
        + f"""SELECT sensor_id, "timestamp", {_table_decimal('temperature')} AS temperature,
       {_table_decimal('humidity')} AS humidity FROM wm""",
        "collapse_last": _collapse("DESC"),
        "collapse_first": _collapse("ASC"),
        "list_sensors": _with(*TABLE_CTES)
        + """SELECT sensor_id, epoch_ms(first_ts) AS first_reading, epoch_ms(latest_ts) AS latest_reading,
       reading_count
FROM (SELECT sensor_id, min("timestamp") AS first_ts, max("timestamp") AS latest_ts,
             count(*) AS reading_count FROM tbl GROUP BY sensor_id)
ORDER BY latest_ts DESC, sensor_id LIMIT 50""",
        "sensor_overview": _with(*TABLE_CTES)
        + """SELECT sensor_id, min("timestamp") AS first_ts, max("timestamp") AS latest_ts,
       count(*) AS reading_count FROM tbl GROUP BY sensor_id""",
        "sensor_data": _with(*TABLE_CTES)
        + f"""SELECT sensor_id, epoch_ms("timestamp") AS "timestamp", CAST(temperature AS DOUBLE) AS temperature,
       CAST(humidity AS DOUBLE) AS humidity
FROM tbl WHERE sensor_id = '{P.SENSOR}' AND "timestamp" BETWEEN {lo} AND {hi}
ORDER BY tbl."timestamp" DESC LIMIT 100""",
        "sensor_stats": _stats(f"AND sensor_id = '{P.SENSOR}'", P.PERIOD[0], P.PERIOD[1]),
        "all_sensor_stats": _stats("", stats_start, stats_end),
        "recent_rows": _with(*TABLE_CTES)
        + 'SELECT * FROM tbl ORDER BY created_at DESC, "timestamp" DESC, sensor_id LIMIT 5',
        "purged_table": _with(*TABLE_CTES)
        + f'SELECT sensor_id, "timestamp", temperature, humidity FROM tbl WHERE sensor_id NOT IN ({purged})',
        "reading_counts": _with(*TABLE_CTES) + "SELECT count(*) AS reading_count FROM tbl",
        "sensor_reading_count": _with(*TABLE_CTES)
        + f"SELECT count(*) AS reading_count FROM tbl WHERE sensor_id = '{P.SENSOR}'",
        "counter_rate": _with(*RATE_CTES)
        + f"SELECT metric, namespace, pod, t, increase, {_rate('increase')} AS rate FROM rates",
        "rollup_rate": _with(*RATE_CTES)
        + f"SELECT metric, namespace, pod, t, increase, {_rate('increase')} AS rate FROM rates",
        "stream_counter_rate": _with(*RATE_CTES)
        + f"SELECT metric, namespace, pod, t, increase, {_rate('increase')} AS rate FROM rates",
        "rollup_rate_bounded": _with(*RATE_CTES, VALUE_BY_NS)
        + f"""SELECT t, namespace, increase, {_rate('increase')} AS rate FROM by_ns
WHERE t BETWEEN TIMESTAMP '{P.RATE_PERIOD[0]}' AND TIMESTAMP '{P.RATE_PERIOD[1]}'""",
        "rate_by_label": _with(*RATE_CTES, VALUE_BY_NS)
        + f"""SELECT t, namespace, increase, {_rate('increase')} AS rate,
       {_rate('increase')} / 1024.0 / 1024.0 AS rate_mib FROM by_ns""",
        "rate_total": _with(*RATE_CTES)
        + f"""SELECT t, SUM(increase) AS increase, {_rate('SUM(increase)')} AS rate FROM rates
WHERE metric = 'events_value_total' GROUP BY t""",
        "active_series": _with(SAMPLES, _instant("events_count_total"))
        + "SELECT t, count(*) AS series FROM (SELECT t, pod FROM inst GROUP BY t, pod) GROUP BY t",
        "gauge_by_label": _with(SAMPLES, _instant("events_count_total"))
        + "SELECT t, namespace, SUM(value) AS value FROM inst GROUP BY t, namespace",
        "combined_rate": _with(*RATE_CTES)
        + f"""SELECT t, namespace, SUM(a + b) AS increase, {_rate('SUM(a + b)')} AS rate FROM (
  SELECT t, namespace, pod, container,
         SUM(CASE WHEN metric = 'events_value_total' THEN increase END) AS a,
         SUM(CASE WHEN metric = 'events_count_total' THEN increase END) AS b
  FROM rates GROUP BY t, namespace, pod, container)
WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY t, namespace""",
        "topk_series": _with(*RATE_CTES)
        + f"""SELECT t, namespace, pod, rate,
       row_number() OVER (PARTITION BY t ORDER BY rate DESC, namespace, pod) AS rank
FROM (SELECT t, namespace, pod, {_rate('SUM(increase)')} AS rate FROM rates
      WHERE metric = 'events_value_total' GROUP BY t, namespace, pod)
QUALIFY rank <= 5""",
        "counter_rate_bounded": _with(*RATE_CTES)
        + f"""SELECT metric, namespace, pod, t, increase, {_rate('increase')} AS rate FROM rates
WHERE t BETWEEN TIMESTAMP '{P.RATE_PERIOD[0]}' AND TIMESTAMP '{P.RATE_PERIOD[1]}'""",
        "matched_rate": matched,
        "matched_rate_by_series": matched,
        "series_dictionary": _with(SAMPLES) + "SELECT DISTINCT metric, namespace, pod, container FROM samples",
        "gauge_total": _with(SAMPLES, _instant("events_value_total"))
        + """SELECT t, value, CAST(value AS DOUBLE) / 1024.0 / 1024.0 AS mib,
       CAST(value AS DOUBLE) / 1024.0 / 1024.0 / 1024.0 AS gib
FROM (SELECT t, SUM(value) AS value FROM inst GROUP BY t)""",
        "organized_rates": _with(*RATE_CTES)
        + f"""SELECT pod, namespace, SUM(increase) AS increase, {_rate('SUM(increase)')} AS rate FROM rates
WHERE metric = 'events_value_total' AND t = TIMESTAMP '{P.TOPK_AT}' GROUP BY pod, namespace""",
        "share_overall": _with(SAMPLES, _instant("events_value_total"))
        + f"""SELECT namespace, value, share, share * 100.0 AS percent FROM (
  SELECT namespace, value, CAST(value AS DOUBLE) / CAST(SUM(value) OVER () AS DOUBLE) AS share
  FROM (SELECT namespace, SUM(value) AS value FROM inst WHERE t = TIMESTAMP '{P.TOPK_AT}' GROUP BY namespace))""",
        "topk_instant": _with(*RATE_CTES)
        + f"""SELECT namespace, pod, {_rate('SUM(increase)')} AS rate FROM rates
WHERE metric = 'events_value_total' AND t = TIMESTAMP '{P.TOPK_AT}'
GROUP BY namespace, pod ORDER BY rate DESC, namespace, pod LIMIT 10""",
        "last_value": _with(SAMPLES)
        + """SELECT metric, namespace, pod, max(ts) AS ts, max(struct_pack(a := ts, b := value)).b AS value
FROM samples WHERE value IS NOT NULL GROUP BY metric, namespace, pod""",
        "share_by_label": _with(*RATE_CTES, VALUE_BY_NS)
        + """SELECT t, namespace, increase, share, share * 100.0 AS percent FROM (
  SELECT b.t, b.namespace, b.increase,
         CASE WHEN CAST(tot.total AS DOUBLE) = 0 THEN NULL
              ELSE CAST(b.increase AS DOUBLE) / CAST(tot.total AS DOUBLE) END AS share
  FROM by_ns b JOIN (SELECT t, SUM(increase) AS total FROM by_ns GROUP BY t) tot ON b.t = tot.t)""",
        "banded_series": _with(SAMPLES, _instant("events_value_total"))
        + """SELECT t, namespace, value,
       CASE WHEN value >= 1024 THEN 'red' WHEN value >= 512 THEN 'yellow' ELSE 'green' END AS band
FROM (SELECT t, namespace, SUM(value) AS value FROM inst GROUP BY t, namespace)""",
        "matched_series": _with(SAMPLES)
        + """SELECT metric, namespace, pod, count(*) AS samples FROM samples
WHERE regexp_full_match(coalesce(namespace, ''), '(?:click|view)')
  AND coalesce(pod, '') <> '1' AND coalesce(container, '') <> ''
GROUP BY metric, namespace, pod""",
        "audit_counts": _with(*TABLE_CTES)
        + f"""SELECT sensor_id, overview_count, series_count, series_count AS stats_count,
       coalesce(overview_count = series_count, false) AS ok
FROM (SELECT sensor_id, count(*) AS overview_count FROM tbl GROUP BY sensor_id) o
FULL OUTER JOIN (SELECT sensor_id, count(*) AS series_count FROM tbl
                 WHERE "timestamp" BETWEEN {FULL_LO} AND {FULL_HI} GROUP BY sensor_id) s
USING (sensor_id)""",
        "audit_ranges": _with(*TABLE_CTES)
        + f"""SELECT sensor_id, count(*) AS readings,
       count(*) FILTER (WHERE r.temperature < tmin OR r.temperature > tmax
                           OR r.humidity < hmin OR r.humidity > hmax) AS violations,
       count(*) FILTER (WHERE r.temperature < tmin OR r.temperature > tmax
                           OR r.humidity < hmin OR r.humidity > hmax) = 0 AS ok
FROM (SELECT * FROM tbl WHERE "timestamp" BETWEEN {FULL_LO} AND {FULL_HI}) r
JOIN (SELECT sensor_id, min(temperature) AS tmin, max(temperature) AS tmax,
             min(humidity) AS hmin, max(humidity) AS hmax
      FROM tbl WHERE "timestamp" BETWEEN {FULL_LO} AND {FULL_HI} GROUP BY sensor_id) st
USING (sensor_id) GROUP BY sensor_id""",
        "audit_integrity": _with(*TABLE_CTES)
        + """SELECT status, count(*) AS rows FROM (
  SELECT CASE WHEN t.sensor_id IS NULL THEN 'missing'
              WHEN w.sensor_id IS NULL THEN 'unexpected'
              WHEN """
        + _table_decimal("w.temperature")
        + """ IS NOT DISTINCT FROM t.temperature
               AND """
        + _table_decimal("w.humidity")
        + """ IS NOT DISTINCT FROM t.humidity THEN 'match'
              ELSE 'mismatch' END AS status
  FROM wm30 w FULL OUTER JOIN tbl t ON w.sensor_id = t.sensor_id AND w."timestamp" = t."timestamp")
GROUP BY status""",
    }
