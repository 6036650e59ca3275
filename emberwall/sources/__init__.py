from emberwall.sources.dimensions import (
    read_blocklist,
    read_geo,
    read_metadata,
    read_port_names,
)
from emberwall.sources.log import read_log, read_table

__all__ = [
    "read_blocklist",
    "read_geo",
    "read_log",
    "read_metadata",
    "read_port_names",
    "read_table",
]
