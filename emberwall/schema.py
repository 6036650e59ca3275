"""Field lists of the firewall log and columns of the tables made from it."""

from __future__ import annotations

# Names by position in a comma-separated line.
V4_FIELDS = [
    "timestamp_rule", "sub_rule_number", "anchor", "tracker_id", "real_interface",
    "reason", "action", "traffic_direction", "ip_version", "tos", "ecn", "ttl",
    "ipv4_id", "offset", "flags", "protocoll_id", "protocoll_text", "length",
    "source_ip", "destination_ip", "source_port", "destination_port", "data_length",
    "tcp_flag", "sequence_num", "ack", "window", "urg", "options", "extra",
]
V6_FIELDS = [
    "timestamp_rule", "sub_rule_number", "anchor", "tracker_id", "real_interface",
    "reason", "action", "traffic_direction", "ip_version", "class", "flow_label",
    "hop_limit", "protocol", "protocol_id", "length", "source_ip", "destination_ip",
]

# The columns that are not text.
V4_TYPES = {"ip_version": "int", "offset": "int", "length": "int", "data_length": "int"}
V6_TYPES = {"ip_version": "int", "hop_limit": "int", "length": "int"}

# Columns both versions share; ``LOG_COLUMNS`` is the log table.
LOG_COLUMNS = [
    "id", "timestamp", "rule_number", "tracker_id", "real_interface", "reason",
    "action", "traffic_direction", "ip_version",
]

# Read from the line but kept in no table.
UNUSED_FIELDS = {"timestamp_rule", "sub_rule_number", "anchor", "urg", "extra"}


def _typed(fields: list[str]) -> list[str]:
    own = [f for f in fields if f not in UNUSED_FIELDS and f not in LOG_COLUMNS]
    return LOG_COLUMNS + own


V4_COLUMNS = _typed(V4_FIELDS)
V6_COLUMNS = _typed(V6_FIELDS)

# First version-specific column; left out when the tables are split.
BOUNDARY_COLUMNS = {4: "tos", 6: "class"}

# The flags added to IPv4 rows.
THREAT_COLUMNS = ["threat_type_bandwith", "threat_type_frequency"]
ENRICHED_COLUMNS = V4_COLUMNS + THREAT_COLUMNS + ["source_country_code"]

# Thresholds and cut-offs used when the caller names none.
DEFAULT_YEAR = 2020
DEFAULT_WINDOW = "1 minute"
DEFAULT_MIN_BYTES = 98971
DEFAULT_MIN_ROWS = 117
DEFAULT_GEO_MIN_ROWS = 100
DEFAULT_TOP = 50
DEFAULT_TOP_METADATA = 1000
