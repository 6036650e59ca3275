from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def syslog_timestamp(text: Column, year: int) -> Column:
    """``MMM d HH:mm:ss`` in the given year, null where the text is no such time."""
    dated = F.concat(F.lit(f"{year} "), text)
    return F.try_to_timestamp(dated, F.lit("yyyy MMM d HH:mm:ss"))


def minute_key(timestamp: Column) -> Column:
    """Minute without the year, so the same minute of two years falls together."""
    return F.date_format(timestamp, "MM-dd HH:mm")
