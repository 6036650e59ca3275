"""Column expressions; all run inside the JVM."""

from emberwall.functions.text import (
    blank_to_null,
    fields_of,
    is_number,
    json_struct,
    options_list,
    options_text,
    whitespace_to_null,
)
from emberwall.functions.ports import port_class
from emberwall.functions.times import minute_key, syslog_timestamp

__all__ = [
    "blank_to_null",
    "fields_of",
    "is_number",
    "json_struct",
    "minute_key",
    "options_list",
    "options_text",
    "port_class",
    "syslog_timestamp",
    "whitespace_to_null",
]
