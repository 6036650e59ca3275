"""The same results in SQL, for DuckDB over the given tables.

The typed columns come straight from ``events``; no line is printed or parsed.
"""

from __future__ import annotations

from checks.adapter import HOST, PORT_POOL, UNKNOWN
from checks.queries import (
    AS_DOUBLE,
    GEO_MIN_ROWS,
    MIN_BYTES,
    MIN_ROWS,
    PEAK_MINUTES,
    STREAM_DELAY_DAYS,
    TIME_RANGE,
)
from emberwall import schema

POOL = "[" + ", ".join(f"'{p}'" for p in PORT_POOL) + "]"


def address(key: str) -> str:
    return f"'10.' || ({key} // 65536) || '.' || ({key} // 256) % 256 || '.' || {key} % 256"


BASE = f"""
e AS (
  SELECT event_id AS id, ts, user_id, event_type, props,
         CAST(floor(value) AS INTEGER) AS amount,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
raw4 AS (
  SELECT *, k NOT BETWEEN 1 AND 3 AS whole,
    CASE event_type WHEN 'click' THEN 'tcp' WHEN 'view' THEN 'udp' WHEN 'error' THEN 'icmp'
      WHEN 'signup' THEN 'sctp' WHEN 'purchase' THEN 'igmp' END AS protocol,
    CASE WHEN k = 4 THEN '' WHEN k = 5 THEN ' '
      WHEN event_type IN ('error', 'purchase') THEN 'request'
      ELSE {POOL}[(user_id + k) % 15 + 1] END AS sport,
    {POOL}[(user_id * 7 + k) % 15 + 1] AS dport,
    CASE WHEN k = 0 THEN '' WHEN k = 7 THEN 'abc' ELSE CAST(amount - 2 AS VARCHAR) END AS len,
    CASE WHEN event_type IN ('click', 'view') THEN 'mss;nop;wscale'
      WHEN event_type = 'signup' THEN 'mss' WHEN event_type = 'error' THEN '' END AS opts
  FROM e WHERE k < 90 AND k NOT IN (8, 9)
),
v4 AS (
  SELECT id,
    CASE WHEN k <> 6 THEN date_trunc('second', ts) END AS "timestamp",
    CAST(k AS VARCHAR) AS rule_number, '10000' || (k // 20) AS tracker_id,
    'em' || user_id % 4 AS real_interface, 'r' || k % 3 AS reason, 'b' || k % 5 AS action,
    CASE WHEN event_type = 'purchase' THEN 'out' ELSE 'in' END AS traffic_direction,
    4 AS ip_version, '0x' || user_id % 16 AS tos, CASE WHEN k % 2 = 1 THEN 'CE' ELSE '' END AS ecn,
    CAST(50 + k % 7 AS VARCHAR) AS ttl, CAST(user_id * 3 + k AS VARCHAR) AS ipv4_id,
    k % 8 AS "offset", 'F' || user_id % 3 AS flags, CAST(k + 100 AS VARCHAR) AS protocoll_id,
    protocol AS protocoll_text,
    amount + 20 AS length,
    CASE WHEN whole THEN {address('user_id')} END AS source_ip,
    CASE WHEN whole THEN '192.0.2.' || (user_id % 7) END AS destination_ip,
    CASE WHEN whole THEN sport END AS source_port,
    CASE WHEN whole THEN dport END AS destination_port,
    CASE WHEN whole AND k NOT IN (0, 7) THEN amount - 2 END AS data_length,
    CASE WHEN whole THEN 'S' || k % 4 END AS tcp_flag,
    CASE WHEN whole THEN CAST(user_id * 1000 + k AS VARCHAR) END AS sequence_num,
    CASE WHEN whole AND k % 3 = 0 THEN '' WHEN whole THEN CAST(k + 7 AS VARCHAR) END AS ack,
    CASE WHEN whole THEN CAST(1024 + k AS VARCHAR) END AS "window",
    CASE WHEN whole THEN '[' || replace(opts, ';', ', ') || ']' END AS options
  FROM raw4
),
v6 AS (
  SELECT id, date_trunc('second', ts) AS "timestamp", CAST(k AS VARCHAR) AS rule_number,
    '10000' || (k // 20) AS tracker_id, 'em' || user_id % 4 AS real_interface,
    'r' || k % 3 AS reason, 'b' || k % 5 AS action,
    CASE WHEN event_type = 'purchase' THEN 'out' ELSE 'in' END AS traffic_direction,
    6 AS ip_version, CAST(NULL AS VARCHAR) AS class,
    CAST(user_id * 100 + k AS VARCHAR) AS flow_label, 1 + k % 9 AS hop_limit,
    'U' || k % 2 AS protocol, CAST(user_id % 100 AS VARCHAR) AS protocol_id,
    amount + 20 AS length, 'fd00::' || user_id AS source_ip,
    'ff02::' || user_id % 11 AS destination_ip
  FROM e WHERE k >= 90
),
places AS (
  SELECT *, 0 AS again, c_nationkey AS "key" FROM customer
  UNION ALL SELECT *, 1, (c_nationkey + 7) % 25 FROM customer WHERE c_custkey % 5 = 0
),
customers AS (
  SELECT *, {address(f'(c_custkey + CASE WHEN c_acctbal < -500 THEN {UNKNOWN} ELSE 0 END)')} AS ip
  FROM places JOIN nation ON "key" = n_nationkey
),
all_geo AS (
  SELECT ip, CASE WHEN c_mktsegment = 'AUTOMOBILE' AND again = 0 THEN 'timeout'
      WHEN c_mktsegment = 'BUILDING' THEN 'error' ELSE 'ok' END AS status,
    CASE WHEN c_mktsegment <> 'BUILDING' AND (c_mktsegment <> 'AUTOMOBILE' OR again = 1)
      THEN n_name END AS country_code
  FROM customers
),
geo AS (
  SELECT * FROM all_geo QUALIFY row_number() OVER (PARTITION BY ip
    ORDER BY status <> 'ok', country_code IS NULL, country_code, status) = 1
),
buckets AS (
  SELECT source_ip, date_trunc('day', "timestamp") AS window_start,
    date_trunc('day', "timestamp") + INTERVAL 1 DAY AS window_end,
    CAST(sum(data_length) AS BIGINT) AS bytes, count(*) AS n
  FROM v4 WHERE "timestamp" IS NOT NULL GROUP BY 1, 2, 3
),
hot_bytes AS (SELECT DISTINCT source_ip FROM buckets WHERE bytes >= {MIN_BYTES}),
hot_rows AS (SELECT DISTINCT source_ip FROM buckets WHERE n >= {MIN_ROWS}),
frequent AS (
  SELECT source_ip, count(*) AS "count" FROM v4 GROUP BY 1 HAVING count(*) >= {GEO_MIN_ROWS}
),
countries AS (
  SELECT source_ip, country_code FROM frequent JOIN geo ON source_ip = ip
),
enriched AS (
  SELECT v4.*,
    CASE WHEN EXISTS (SELECT 1 FROM hot_bytes h WHERE h.source_ip IS NOT DISTINCT FROM v4.source_ip)
      THEN '1' ELSE '0' END AS threat_type_bandwith,
    CASE WHEN EXISTS (SELECT 1 FROM hot_rows h WHERE h.source_ip IS NOT DISTINCT FROM v4.source_ip)
      THEN '1' ELSE '0' END AS threat_type_frequency,
    country_code AS source_country_code
  FROM v4 LEFT JOIN countries c ON c.source_ip = v4.source_ip
),
clean AS (
  SELECT * REPLACE (CASE WHEN trim(source_port) <> '' THEN source_port END AS source_port) FROM v4
),
usable AS (
  SELECT * FROM clean WHERE source_port IS NULL OR source_port <> 'request'
),
classed AS (
  SELECT *,
    CASE WHEN CAST(source_port AS INTEGER) >= 49152 THEN 'private-port'
      WHEN CAST(source_port AS INTEGER) >= 1024 THEN 'registered-port'
      WHEN CAST(source_port AS INTEGER) >= 1 THEN 'standard-port' ELSE '0'
    END AS source_port_class,
    CASE WHEN CAST(destination_port AS INTEGER) >= 49152 THEN 'private-port'
      WHEN CAST(destination_port AS INTEGER) >= 1024 THEN 'registered-port'
      WHEN CAST(destination_port AS INTEGER) >= 1 THEN 'standard-port' ELSE '0'
    END AS destination_port_class
  FROM usable
),
port_names AS (
  SELECT CAST(p_partkey AS VARCHAR) AS port, p_name AS name FROM part
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier
),
blocklist AS (
  SELECT {address('s_suppkey')} AS ip, 'poor' AS list_name FROM supplier WHERE s_acctbal < 4000
  UNION ALL
  SELECT {address('s_suppkey')}, 'near' FROM supplier WHERE s_nationkey < 8
),
minutes AS (
  SELECT *, strftime("timestamp", '%m-%d %H:%M') AS minute FROM v4
),
per_minute AS (
  SELECT minute, count(*) AS n, CAST(coalesce(sum(data_length), 0) AS BIGINT) AS bytes
  FROM minutes WHERE minute IS NOT NULL GROUP BY 1
)
"""

_SQL: dict[str, str] = {}


def add(name: str, select: str) -> None:
    sql = f"WITH {BASE.strip()}\n{select.strip()}"
    if name in AS_DOUBLE:
        casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in AS_DOUBLE[name])
        sql = f"SELECT * REPLACE ({casts}) FROM ({sql})"
    _SQL[name] = sql


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def quoted(names: list[str]) -> str:
    return ", ".join(f'"{n}"' for n in names)


# --- parsing -----------------------------------------------------------------

add("filter_log_lines", "SELECT id FROM e")
add(
    "assign_id",
    "SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(0 AS BIGINT) AS n_null FROM e",
)
add(
    "parse_ip_version",
    """
SELECT id, CASE WHEN k >= 90 THEN '6' WHEN k = 8 THEN 'x' WHEN k <> 9 THEN '4' END
  AS ip_version FROM e
""",
)
add(
    "split_ip_version",
    "SELECT id, ip_version AS version FROM v4 UNION ALL SELECT id, ip_version FROM v6",
)

TIME_TEXT = """strftime(ts, '%b ') || lpad(CAST(day(ts) AS VARCHAR), 2, ' ')
    || strftime(ts, ' %H:%M:%S')"""
HEADER = f"""CASE WHEN k = 6 THEN 'Foo 99 00:00:00' ELSE {TIME_TEXT} END
    || ' {HOST} filterlog' || CASE WHEN k = 10 THEN '[123]' ELSE '' END || ': ' || k"""

add(
    "parse_fields_v4",
    f"""
SELECT v4.id, {HEADER} AS timestamp_rule, 's' || k % 30 AS sub_rule_number,
  'a' || user_id % 9 AS anchor, tracker_id,
  real_interface, reason, action, traffic_direction, '4' AS ip_version, tos, ecn, ttl,
  ipv4_id, CAST("offset" AS VARCHAR) AS "offset", flags, protocoll_id, protocoll_text,
  CAST(length AS VARCHAR) AS length, source_ip, destination_ip, source_port,
  destination_port, CASE WHEN whole THEN len END AS data_length, tcp_flag, sequence_num,
  ack, "window", CASE WHEN whole THEN 'u' || k % 50 END AS urg,
  CASE WHEN whole THEN opts END AS options,
  CASE WHEN whole AND event_type <> 'purchase' THEN '' END AS extra
FROM v4 JOIN raw4 ON v4.id = raw4.id
""",
)
add(
    "parse_fields_v6",
    f"""
SELECT v6.id, {HEADER} AS timestamp_rule, '' AS sub_rule_number, '' AS anchor, tracker_id,
  real_interface, reason, action, traffic_direction, '6' AS ip_version, '' AS class,
  flow_label, CAST(hop_limit AS VARCHAR) AS hop_limit, protocol, protocol_id,
  CAST(length AS VARCHAR) AS length, source_ip, destination_ip
FROM v6 JOIN e ON v6.id = e.id
""",
)
add(
    "parse_header",
    """
SELECT id, CASE WHEN k = 6 THEN 'Foo 99 00:00:00'
  ELSE strftime(ts, '%b ') || day(ts) || strftime(ts, ' %H:%M:%S') END AS time_text,
  CAST(k AS VARCHAR) AS rule_number
FROM raw4
""",
)
add("parse_timestamp", 'SELECT id, "timestamp" FROM v4')
add(
    "blank_to_null",
    """
SELECT id, CAST(NULL AS VARCHAR) AS sub_rule_number, CAST(NULL AS VARCHAR) AS anchor, class,
  flow_label, source_ip FROM v6
""",
)
add(
    "whitespace_to_null",
    """
SELECT id, nullif(ecn, '') AS ecn, nullif(ack, '') AS ack, source_port, protocoll_text
FROM clean
""",
)
add(
    "drop_null_columns",
    f"""
SELECT v6.id, CASE WHEN k = 6 THEN 'Foo 99 00:00:00'
    ELSE strftime(ts, '%b ') || day(ts) || strftime(ts, ' %H:%M:%S') END AS "timestamp",
  rule_number, tracker_id, real_interface, reason, action, traffic_direction,
  '6' AS ip_version, flow_label, CAST(hop_limit AS VARCHAR) AS hop_limit, protocol, protocol_id,
  CAST(length AS VARCHAR) AS length, source_ip, destination_ip
FROM v6 JOIN e ON v6.id = e.id
""",
)
add(
    "cast_columns",
    """
SELECT id, ip_version, CAST("offset" AS DOUBLE) AS "offset", CAST(length AS DOUBLE) AS length,
  CAST(data_length AS DOUBLE) AS data_length, ttl FROM v4
""",
)
add(
    "split_options",
    """
SELECT v4.id,
  CAST(CASE WHEN v4.options IS NOT NULL THEN len(string_split(opts, ';')) END AS INTEGER) AS n_options,
  CASE WHEN v4.options IS NOT NULL THEN string_split(opts, ';')[1] END AS first_option,
  CASE WHEN v4.options IS NOT NULL THEN string_split(opts, ';')[3] END AS third_option,
  v4.options AS options_text
FROM v4 JOIN raw4 ON v4.id = raw4.id
""",
)
add("typed_v4", f"SELECT {quoted(schema.V4_COLUMNS)} FROM v4")
add("typed_v4_from_text", f"SELECT {quoted(schema.V4_COLUMNS[1:])} FROM v4")
add("typed_v6", f"SELECT {quoted(schema.V6_COLUMNS)} FROM v6")
add("minute_key", "SELECT id, minute FROM minutes")
add(
    "json_field",
    "SELECT id AS event_id, json_extract_string(props, '$.k') AS k, '0' AS absent FROM e",
)

# --- detection ---------------------------------------------------------------

add(
    "bandwidth_per_window",
    'SELECT source_ip, window_start, window_end, bytes AS "count" FROM buckets',
)
add(
    "logs_per_window",
    'SELECT source_ip, window_start, window_end, n AS "count" FROM buckets',
)
add("hot_sources_bandwidth", "SELECT source_ip FROM hot_bytes")
add("hot_sources_frequency", "SELECT source_ip FROM hot_rows")
add("flag_bandwidth", "SELECT id, source_ip, threat_type_bandwith FROM enriched")
add("flag_frequency", "SELECT id, source_ip, threat_type_frequency FROM enriched")
add(
    "flag_both",
    "SELECT id, source_ip, threat_type_bandwith, threat_type_frequency FROM enriched",
)
add(
    "source_profile",
    """
SELECT source_ip, count(*) AS "rows", bool_or(threat_type_bandwith = '1') AS hot_bytes,
  bool_or(threat_type_frequency = '1') AS hot_rows
FROM enriched GROUP BY source_ip
""",
)
add(
    "calibrate_thresholds",
    """
SELECT avg(bytes) AS mean_bytes, avg(n) AS mean_rows FROM (
  SELECT date_trunc('minute', "timestamp") AS m, count(*) AS n,
    coalesce(sum(data_length), 0) AS bytes
  FROM v4 WHERE "timestamp" IS NOT NULL GROUP BY 1)
""",
)

# --- enrichment --------------------------------------------------------------

add("frequent_sources", 'SELECT source_ip, "count" FROM frequent')
add(
    "geo_lookup",
    """
SELECT source_ip, country_code AS source_country_code, coalesce(status, 'missing') AS geo_status
FROM (SELECT DISTINCT source_ip FROM v4) LEFT JOIN geo ON source_ip = ip
""",
)
add(
    "geo_lookup_failure_codes",
    """
SELECT source_ip, CASE status WHEN 'timeout' THEN 'Timeout' WHEN 'error' THEN '404'
    ELSE country_code END AS source_country_code,
  coalesce(status, 'missing') AS geo_status
FROM (SELECT DISTINCT source_ip FROM v4) LEFT JOIN geo ON source_ip = ip
""",
)
add("enrich_country", "SELECT id, source_ip, source_country_code FROM enriched")
add("enriched_ip4", f"SELECT {quoted(schema.ENRICHED_COLUMNS)} FROM enriched")
add(
    "top_sources_metadata",
    f"""
, top AS (
  SELECT source_ip AS ip, count(*) AS frequency FROM v4 WHERE source_ip IS NOT NULL
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1000
),
meta AS (
  SELECT ip, c_name || CASE WHEN again = 1 THEN ' branch' ELSE '' END AS org, n_name,
    n_regionkey, c_mktsegment
  FROM customers QUALIFY row_number() OVER (PARTITION BY ip ORDER BY org, n_name) = 1
)
SELECT top.ip, frequency, coalesce(org, '0') AS org, '0' AS city,
  coalesce(n_name, '0') AS country, coalesce(CAST(n_regionkey AS VARCHAR), '0') AS region,
  '0' AS postal,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN lower(c_mktsegment) ELSE '0' END AS hostname,
  '0' AS location, CASE WHEN meta.ip IS NULL THEN '0' ELSE 'UTC' END AS timezone
FROM top LEFT JOIN meta ON top.ip = meta.ip
""",
)
add(
    "port_names_source",
    """
SELECT id, source_port, destination_port, port, name
FROM v4 LEFT JOIN port_names ON source_port = port
""",
)
add(
    "port_names_both",
    """
SELECT id, source_port, destination_port, s.port, s.name,
  d.port AS port_destination_name, d.name AS name_destination_name
FROM v4 LEFT JOIN port_names s ON source_port = s.port
  LEFT JOIN port_names d ON destination_port = d.port
""",
)
IN_LIST = "coalesce(source_ip IN (SELECT ip FROM blocklist {where}), false)"
add(
    "flag_blocklist",
    f"""
SELECT id, source_ip, {IN_LIST.format(where='')} AS dangerous,
  {IN_LIST.format(where="WHERE list_name = 'poor'")} AS dangerous_poor,
  {IN_LIST.format(where="WHERE list_name = 'near'")} AS dangerous_near
FROM v4
""",
)
add(
    "blocklist_hits",
    "SELECT id, source_ip FROM v4 WHERE source_ip IN (SELECT ip FROM blocklist)",
)

# --- ports -------------------------------------------------------------------

TOP_PORTS = """
, s AS (SELECT source_port AS p, count(*) AS n FROM clean WHERE source_port IS NOT NULL
  GROUP BY 1 ORDER BY 2 DESC, 1 {limit}),
d AS (SELECT destination_port AS p, count(*) AS n FROM clean WHERE destination_port IS NOT NULL
  GROUP BY 1 ORDER BY 2 DESC, 1 {limit})
"""
add("numeric_ports", "SELECT id, source_port, destination_port FROM usable")
add(
    "rejected_ports",
    """
SELECT id, 'source_port' AS side, source_port AS port FROM clean WHERE source_port = 'request'
""",
)
add(
    "port_class",
    """
SELECT id, source_port,
  CASE WHEN TRY_CAST(source_port AS INTEGER) >= 49152 THEN 'private-port'
    WHEN TRY_CAST(source_port AS INTEGER) >= 1024 THEN 'registered-port'
    WHEN TRY_CAST(source_port AS INTEGER) >= 1 THEN 'standard-port' ELSE '0'
  END AS source_port_class,
  CASE WHEN TRY_CAST(destination_port AS INTEGER) >= 49152 THEN 'private-port'
    WHEN TRY_CAST(destination_port AS INTEGER) >= 1024 THEN 'registered-port'
    WHEN TRY_CAST(destination_port AS INTEGER) >= 1 THEN 'standard-port' ELSE '0'
  END AS destination_port_class
FROM clean
""",
)
PORT_COUNTS = """
SELECT id, source_port, destination_port, s.n AS source_port_counted,
  d.n AS destination_port_counted
FROM {rows} LEFT JOIN s ON source_port = s.p LEFT JOIN d ON destination_port = d.p
"""
add(
    "port_counts_joined",
    TOP_PORTS.format(limit="LIMIT 50") + PORT_COUNTS.format(rows="usable"),
)
add("port_counts_all", TOP_PORTS.format(limit="") + PORT_COUNTS.format(rows="clean"))
add(
    "notable_ports",
    TOP_PORTS.format(limit="LIMIT 50")
    + """
, rows_of AS (
  SELECT 'source_port' AS side, source_port_class AS class, source_port AS port, n
  FROM classed JOIN s ON source_port = p
  UNION ALL
  SELECT 'destination_port', destination_port_class, destination_port, n
  FROM classed JOIN d ON destination_port = p)
SELECT side, class, port, avg(n) AS n FROM rows_of
WHERE n > CASE WHEN class = 'standard-port' THEN 10
  WHEN class = 'private-port' AND side = 'destination_port' THEN 10
  WHEN class <> '0' THEN 100 END
GROUP BY 1, 2, 3
""",
)

# --- counts and top lists ----------------------------------------------------


def counts(name: str, column: str, source: str = "v4", where: str = "true", k: int = 0):
    limit = f"ORDER BY 2 DESC, 1 LIMIT {k}" if k else ""
    add(
        name,
        f"""
SELECT {column}, count(*) AS n FROM {source} WHERE {column} IS NOT NULL AND {where}
GROUP BY 1 {limit}
""",
    )


counts("counts_source_ip", "source_ip")
counts("counts_destination_ip", "destination_ip")
counts("counts_protocol", "protocoll_text")
counts("counts_source_port", "source_port")
counts("counts_destination_port", "destination_port")
counts("counts_minute", "minute", "minutes")
counts("counts_source_port_class", "source_port_class", "classed")
counts("counts_destination_port_class", "destination_port_class", "classed")
counts("top_source_ips", "source_ip", k=50)
counts("top_destination_ips", "destination_ip", k=50)
counts("top_source_ports", "source_port", k=50)
counts("top_destination_ports", "destination_port", k=50)
counts("top_minutes_logs", "minute", "minutes", k=50)
counts("icmp_sources", "source_ip", where="protocoll_text = 'icmp'")
counts("sctp_sources", "source_ip", where="protocoll_text = 'sctp'")
counts("port_sources", "source_ip", where="source_port = '61337'")
counts("port_destinations", "destination_ip", where="destination_port = '3478'")
counts(
    "minute_sources",
    "source_ip",
    "minutes",
    f"minute IN (SELECT minute FROM per_minute ORDER BY n DESC, minute LIMIT {PEAK_MINUTES})",
)
add("bytes_per_minute", "SELECT minute, bytes FROM per_minute")
add(
    "top_minutes_bytes",
    "SELECT minute, bytes FROM per_minute ORDER BY bytes DESC, minute LIMIT 50",
)

# --- descriptions ------------------------------------------------------------


def text_description(column: str, extra: str = "") -> str:
    return f"""
, f AS (SELECT {column} AS v, count(*) AS n FROM v4 WHERE {column} IS NOT NULL GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
  (SELECT v FROM f ORDER BY n DESC, v LIMIT 1) AS "top",
  (SELECT max(n) FROM f) AS freq {extra}
FROM f
"""


add("describe_source_ip", text_description("source_ip"))
add("describe_destination_ip", text_description("destination_ip"))
add(
    "describe_time",
    text_description('"timestamp"', ', min(v) AS "first", max(v) AS "last"'),
)


def number_description(name: str, column: str, source: str) -> None:
    statistics = {
        "count": f"CAST(count({column}) AS DOUBLE)",
        "mean": f"avg({column})",
        "std": f"stddev_samp({column})",
        "min": f"CAST(min({column}) AS DOUBLE)",
        "25%": f"CAST(quantile_cont({column}, 0.25) AS DOUBLE)",
        "50%": f"CAST(quantile_cont({column}, 0.5) AS DOUBLE)",
        "75%": f"CAST(quantile_cont({column}, 0.75) AS DOUBLE)",
        "max": f"CAST(max({column}) AS DOUBLE)",
    }
    add(
        name,
        " UNION ALL ".join(
            f"SELECT '{s}' AS statistic, round({x}, 6) AS value FROM {source}"
            for s, x in statistics.items()
        ),
    )


number_description("describe_data_length", "data_length", "v4")
number_description("describe_bytes_per_minute", "bytes", "per_minute")
number_description("describe_logs_per_minute", "n", "per_minute")
add(
    "column_max",
    "SELECT " + ", ".join(f'max("{c}") AS "{c}"' for c in schema.V4_COLUMNS) + " FROM v4",
)
add(
    "frame_info",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count("{c}") AS non_null FROM v4"""
        for c in schema.V4_COLUMNS
    ),
)

# --- tables ------------------------------------------------------------------

LOG = quoted(schema.LOG_COLUMNS)
MERGED = f"SELECT {LOG} FROM v4 UNION ALL SELECT {LOG} FROM v6"
IP4 = [c for c in schema.ENRICHED_COLUMNS if c not in schema.LOG_COLUMNS and c != "tos"]
IP6 = [c for c in schema.V6_COLUMNS if c not in schema.LOG_COLUMNS and c != "class"]

add("divide_log", f"SELECT {LOG} FROM v4")
add("divide_ip4", f"SELECT id, {quoted(IP4)} FROM enriched")
add("divide_ip6", f"SELECT id, {quoted(IP6)} FROM v6")
add("merged_log", MERGED)
add("join_log_ip4", f"SELECT {LOG}, {quoted(IP4)} FROM enriched")
add(
    "load_tables",
    """
SELECT table_name, count(*) AS n_rows, count(*) AS n_ids, count(*) AS n_in_log
FROM (SELECT 'pfsense_log' AS table_name, id FROM v4
  UNION ALL SELECT 'pfsense_log', id FROM v6
  UNION ALL SELECT 'ip4', id FROM v4 UNION ALL SELECT 'ip6', id FROM v6)
GROUP BY 1
""",
)

# --- dashboard ---------------------------------------------------------------

BY_YEAR = """
SELECT CAST(extract(year FROM "timestamp") AS INTEGER) AS "time", count({flag}) AS "count"
FROM enriched WHERE {flag} = '1' GROUP BY 1
"""
COUNTRY = f"""
SELECT "timestamp" AS "time", count(data_length) AS "value", source_country_code AS "metric"
FROM enriched WHERE source_country_code IS NOT NULL
  AND "timestamp" BETWEEN TIMESTAMP '{TIME_RANGE[0]}' AND TIMESTAMP '{TIME_RANGE[1]}'
GROUP BY 1, 3
"""
OVER_TIME = """
SELECT "timestamp" AS "time", count(source_ip) AS "value" FROM enriched WHERE {where} GROUP BY 1
"""
add("dash_threat_bandwidth", BY_YEAR.format(flag="threat_type_bandwith"))
add("dash_threat_frequency", BY_YEAR.format(flag="threat_type_frequency"))
add("dash_country", COUNTRY)
add("dash_bandwidth_over_time", OVER_TIME.format(where="threat_type_bandwith = '1'"))
add("dash_frequency_over_time", OVER_TIME.format(where="threat_type_frequency = '1'"))
add("dash_logs_over_time", OVER_TIME.format(where="true"))
add(
    "panel_threat_means",
    f"""
SELECT 'bandwidth' AS panel, avg("count") AS mean FROM ({BY_YEAR.format(flag="threat_type_bandwith")})
UNION ALL
SELECT 'frequency', avg("count") FROM ({BY_YEAR.format(flag="threat_type_frequency")})
""",
)
add(
    "panel_country_totals",
    f'SELECT "metric", CAST(sum("value") AS BIGINT) AS total FROM ({COUNTRY}) GROUP BY 1',
)

# --- what the load wrote, and the panels as SQL text ---------------------------

add("load_log", f"""SELECT {LOG}, strftime("timestamp", '%Y-%m-%d') AS "date" FROM ({MERGED})""")
for name in list(_SQL):
    if name.startswith("dash_"):
        _SQL[name.replace("dash_", "sql_dash_")] = _SQL[name]

# --- long lists, blocks of addresses, streams ------------------------------------

_SQL["top_source_ips_by_buckets"] = _SQL["top_source_ips"]
_SQL["top_destination_ports_by_buckets"] = _SQL["top_destination_ports"]
_SQL["flag_bandwidth_long_list"] = _SQL["flag_bandwidth"]
_SQL["flag_blocklist_long_list"] = _SQL["flag_blocklist"]
add(
    "country_by_block",
    """
SELECT id, name AS source_country_code, length AS geo_block_length
FROM (SELECT v4.id, v4.source_ip, min(user_id) AS key FROM v4 JOIN e ON e.id = v4.id GROUP BY 1, 2) AS r
LEFT JOIN (
  SELECT length, low, min(n_name) AS name FROM (
    SELECT 24 AS length, (n_nationkey * 256 + 7) // 256 * 256 AS low, n_name FROM nation
    UNION ALL SELECT 28, s_suppkey * 3 // 16 * 16, n_name
      FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT 30, s_suppkey * 7 // 4 * 4, n_name
      FROM supplier JOIN nation ON s_nationkey = n_nationkey)
  GROUP BY 1, 2
) AS b ON source_ip IS NOT NULL AND key >= low AND key < low + (1 << (32 - length))
QUALIFY row_number() OVER (PARTITION BY id ORDER BY length DESC NULLS LAST) = 1
""",
)
add(
    "stream_windows",
    f"""
SELECT source_ip, window_start, window_end, bytes, n AS "rows" FROM buckets
WHERE window_end <= (SELECT max("timestamp") FROM v4) - INTERVAL {STREAM_DELAY_DAYS} DAY
""",
)

# --- the store -----------------------------------------------------------------

NO_ID = quoted([c for c in schema.LOG_COLUMNS if c != "id"])
add("store_rows", f"SELECT {NO_ID}, {quoted(IP4)} FROM enriched")
add("store_ip6", f"SELECT {quoted(IP6)} FROM v6")
_SQL["store_tables"] = _SQL["load_tables"]
add(
    "store_rejects",
    """
SELECT kind, CAST(count(*) FILTER (found) AS BIGINT) AS n FROM (
  SELECT kind, CASE kind WHEN 'lines' THEN true WHEN 'short' THEN k = 9
    WHEN 'bad_version' THEN k = 8 WHEN 'bad_time' THEN k = 6 ELSE false END AS found
  FROM e, (VALUES ('lines'), ('short'), ('bad_version'), ('bad_header'), ('bad_time')) AS v (kind)
) GROUP BY 1
""",
)
for name in list(_SQL):
    if name.startswith("dash_"):
        _SQL[name.replace("dash_", "counted_")] = _SQL[name]
_SQL["store_dash_country"] = _SQL["dash_country"]
