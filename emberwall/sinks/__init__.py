from emberwall.sinks.tables import (
    write_bucketed,
    write_csv,
    write_database,
    write_parquet,
    write_table,
)

__all__ = [
    "write_bucketed",
    "write_csv",
    "write_database",
    "write_parquet",
    "write_table",
]
