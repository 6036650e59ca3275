"""The three tables made from the typed frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwall import schema


def divide(
    df: DataFrame, version: int, keep_boundary: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split a typed frame into the columns of the log and the id with the rest.
    The first column of the rest (``tos`` or ``class``) goes unless kept."""
    left_out = set(schema.LOG_COLUMNS)
    if not keep_boundary:
        left_out.add(schema.BOUNDARY_COLUMNS[version])
    rest = [c for c in df.columns if c not in left_out]
    return df.select(*schema.LOG_COLUMNS), df.select("id", *rest)


def by_time(log: DataFrame) -> DataFrame:
    """Order by time. The id breaks ties, so that one busy second can still be
    spread over several tasks."""
    return log.orderBy("timestamp", "id")


def merged_log(
    v4_log: DataFrame, v6_log: DataFrame, ordered: bool = True
) -> DataFrame:
    """All log rows of both versions, by time."""
    log = v4_log.unionByName(v6_log)
    return by_time(log) if ordered else log


def split_tables(
    v4: DataFrame, v6: DataFrame, keep_boundary: bool = False, ordered: bool = True
) -> dict[str, DataFrame]:
    """``pfsense_log``, ``ip4`` and ``ip6``. Give it stored frames: the tables
    share ids, which must not be made anew for each of them."""
    v4_log, ip4 = divide(v4, 4, keep_boundary)
    v6_log, ip6 = divide(v6, 6, keep_boundary)
    return {"pfsense_log": merged_log(v4_log, v6_log, ordered), "ip4": ip4, "ip6": ip6}


def with_date(df: DataFrame) -> DataFrame:
    """Add ``date``, the day of ``timestamp``, by which tables are partitioned."""
    return df.withColumn("date", F.to_date("timestamp"))


def join_log_ip4(log: DataFrame, ip4: DataFrame) -> DataFrame:
    """Both tables joined on the id; what else both have, the columns they are partitioned
    by, is taken from the log."""
    both = [c for c in ("date", "segment", "first_day", "last_day") if c in log.columns]
    return log.join(ip4.drop(*both), "id")
