"""The queries a dashboard over the loaded tables asks.

Each takes the tables ``pfsense_log`` and ``ip4`` and joins them on the id. Tables
that ``load`` wrote as ``dashboard``, or that a ``LogStore`` holds, join without a
shuffle, and a time range reads the partitions of its days only, of both tables.

The same panels can be had from counts (``panel_counts``), which a ``LogStore`` keeps up
to date: one row per second of the log, country and pair of flags, so no row of the log
is read. The log has no times between seconds, so a time range cuts no count in two.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwall.operators.tables import join_log_ip4

TimeRange = tuple[object, object] | None


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def in_range(timestamp: Column, time_range: TimeRange) -> Column:
    """Within both bounds, which belong to the range."""
    if time_range is None:
        return F.lit(True)
    first, last = time_range
    return timestamp.between(F.lit(first), F.lit(last))


def _on_days_of(df: DataFrame, time_range: TimeRange) -> DataFrame:
    """Keep the partitions of the days of the range, if there are any: partitions of one
    ``date``, or of the days from ``first_day`` to ``last_day``."""
    if time_range is None:
        return df
    first, last = (F.lit(bound).cast("timestamp").cast("date") for bound in time_range)
    if "first_day" in df.columns:
        return df.filter((F.col("first_day") <= last) & (F.col("last_day") >= first))
    return df.filter(F.col("date").between(first, last)) if "date" in df.columns else df


def _rows(
    log: DataFrame, ip4: DataFrame, time_range: TimeRange, where: Column | None = None
) -> DataFrame:
    log = log.filter(in_range(F.col("timestamp"), time_range))
    ip4 = ip4 if where is None else ip4.filter(where)
    log, ip4 = (_on_days_of(df, time_range) for df in (log, ip4))
    return join_log_ip4(log.select("id", "timestamp"), ip4)


def _per_year(log, ip4, flag: str, time_range: TimeRange) -> DataFrame:
    rows = _rows(log, ip4, time_range, F.col(flag) == "1")
    return rows.groupBy(F.year("timestamp").alias("time")).agg(
        F.count(flag).alias("count")
    )


def dash_threat_bandwidth(
    log: DataFrame, ip4: DataFrame, time_range: TimeRange = None
) -> DataFrame:
    """Rows of sources with high bandwidth per year."""
    return _per_year(log, ip4, "threat_type_bandwith", time_range)


def dash_threat_frequency(
    log: DataFrame, ip4: DataFrame, time_range: TimeRange = None
) -> DataFrame:
    """Rows of sources with high log frequency per year."""
    return _per_year(log, ip4, "threat_type_frequency", time_range)


def dash_country(
    log: DataFrame, ip4: DataFrame, time_range: TimeRange = None
) -> DataFrame:
    """Rows with a length per time and country; all traffic, flagged or not."""
    rows = _rows(log, ip4, time_range, F.col("source_country_code").isNotNull())
    return rows.groupBy(
        F.col("timestamp").alias("time"), F.col("source_country_code").alias("metric")
    ).agg(F.count("data_length").alias("value"))


def _over_time(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("timestamp").alias("time")).agg(
        F.count("source_ip").alias("value")
    )


def dash_bandwidth_over_time(
    log: DataFrame, ip4: DataFrame, time_range: TimeRange = None
) -> DataFrame:
    rows = _rows(log, ip4, time_range, F.col("threat_type_bandwith") == "1")
    return _over_time(rows).orderBy("time")


def dash_frequency_over_time(
    log: DataFrame, ip4: DataFrame, time_range: TimeRange = None
) -> DataFrame:
    rows = _rows(log, ip4, time_range, F.col("threat_type_frequency") == "1")
    return _over_time(rows).orderBy("time")


def dash_logs_over_time(
    log: DataFrame, ip4: DataFrame, time_range: TimeRange = None
) -> DataFrame:
    """All IPv4 rows with a source per time."""
    return _over_time(_rows(log, ip4, time_range))


# What the rows of a panel are told apart by.
COUNT_KEYS = ["time", "source_country_code", "threat_type_bandwith", "threat_type_frequency"]
COUNTS = {"rows": "*", "sources": "source_ip", "lengths": "data_length"}


def panel_counts(log: DataFrame, ip4: DataFrame) -> DataFrame:
    """Rows, rows with a source and rows with a length per ``COUNT_KEYS``. Counts of parts
    of the log can be put together; panels add them up, so negative ones correct others."""
    rows = join_log_ip4(log.select("id", F.col("timestamp").alias("time")), ip4)
    counts = [F.count(what).alias(name) for name, what in COUNTS.items()]
    return rows.groupBy(*COUNT_KEYS).agg(*counts)


def _summed(counts: DataFrame, keys: list, value: str, name: str) -> DataFrame:
    """Groups that hold any row, with the sum of a count."""
    sums = counts.groupBy(*keys).agg(F.sum(value).alias(name), F.sum("rows").alias("_rows"))
    return sums.filter(F.col("_rows") > 0).drop("_rows")


def _counted(counts: DataFrame, time_range: TimeRange) -> DataFrame:
    return counts.filter(in_range(F.col("time"), time_range))


def counted_per_year(counts: DataFrame, flag: str, time_range: TimeRange = None) -> DataFrame:
    """``dash_threat_bandwidth`` and ``dash_threat_frequency`` from counts, by the name of
    the flag's column."""
    hot = _counted(counts, time_range).filter(F.col(flag) == "1")
    return _summed(hot, [F.year("time").alias("time")], "rows", "count")


def counted_country(counts: DataFrame, time_range: TimeRange = None) -> DataFrame:
    """``dash_country`` from counts."""
    known = _counted(counts, time_range).filter(F.col("source_country_code").isNotNull())
    keys = ["time", F.col("source_country_code").alias("metric")]
    return _summed(known, keys, "lengths", "value")


def counted_over_time(
    counts: DataFrame, flag: str | None = None, time_range: TimeRange = None
) -> DataFrame:
    """``dash_logs_over_time`` from counts, or, with the name of a flag's column, the panel
    over time of rows with that flag, ordered by time."""
    counts = _counted(counts, time_range)
    if flag is None:
        return _summed(counts, ["time"], "sources", "value")
    return _summed(counts.filter(F.col(flag) == "1"), ["time"], "sources", "value").orderBy("time")


def panel_mean(series: DataFrame, value: str = "value") -> DataFrame:
    """The single number a panel shows: the mean of its series."""
    return series.agg(F.avg(value).alias("mean"))


def panel_total(series: DataFrame, metric: str = "metric") -> DataFrame:
    """Sum of a series per metric."""
    return series.groupBy(metric).agg(F.sum("value").alias("total"))


def _year_sql(flag: str) -> str:
    return f"""
SELECT year(l.timestamp) AS time, count(i.{flag}) AS count
FROM pfsense_log l JOIN ip4 i ON i.id = l.id WHERE i.{flag} = '1' GROUP BY 1"""


def _time_sql(where: str) -> str:
    return f"""
SELECT l.timestamp AS time, count(i.source_ip) AS value
FROM pfsense_log l JOIN ip4 i ON i.id = l.id WHERE {where} GROUP BY 1 ORDER BY 1"""


def panel_sql(time_range: TimeRange = None) -> dict[str, str]:
    """The six panels as SQL over the views ``register_views`` makes. A time range
    needs tables with ``date``."""
    within = "true"
    if time_range is not None:
        first, last = (f"TIMESTAMP '{bound}'" for bound in time_range)
        within = " AND ".join(
            [f"l.timestamp BETWEEN {first} AND {last}"]
            + [f"{t}.date BETWEEN date({first}) AND date({last})" for t in "li"]
        )
    country = f"""
SELECT l.timestamp AS time, i.source_country_code AS metric, count(i.data_length) AS value
FROM pfsense_log l JOIN ip4 i ON i.id = l.id
WHERE i.source_country_code IS NOT NULL AND {within} GROUP BY 1, 2"""
    bandwidth, frequency = "threat_type_bandwith", "threat_type_frequency"
    return {
        "dash_threat_bandwidth": _year_sql(bandwidth),
        "dash_threat_frequency": _year_sql(frequency),
        "dash_country": country,
        "dash_bandwidth_over_time": _time_sql(f"i.{bandwidth} = '1'"),
        "dash_frequency_over_time": _time_sql(f"i.{frequency} = '1'"),
        "dash_logs_over_time": _time_sql(within),
    }
