"""Sources whose traffic or log frequency passes a threshold in some window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwall import schema
from emberwall.operators.heavy import join_long_list
from emberwall.session import store


def _per_window(df: DataFrame, window: str, measure: Column) -> DataFrame:
    """Rows without a time belong to no window."""
    grouped = df.groupBy("source_ip", F.window("timestamp", window).alias("bucket"))
    return grouped.agg(measure).select(
        "source_ip",
        F.col("bucket.start").alias("window_start"),
        F.col("bucket.end").alias("window_end"),
        "count",
    )


def bandwidth_per_window(
    df: DataFrame, window: str = schema.DEFAULT_WINDOW
) -> DataFrame:
    """Bytes per source and window, in ``count``."""
    return _per_window(df, window, F.sum("data_length").alias("count"))


def logs_per_window(df: DataFrame, window: str = schema.DEFAULT_WINDOW) -> DataFrame:
    """Rows per source and window, in ``count``."""
    return _per_window(df, window, F.count(F.lit(1)).alias("count"))


def _reaching(counts: DataFrame, least: int) -> DataFrame:
    return counts.filter(F.col("count") >= least).select("source_ip").distinct()


def hot_sources_bandwidth(
    df: DataFrame,
    window: str = schema.DEFAULT_WINDOW,
    min_bytes: int = schema.DEFAULT_MIN_BYTES,
) -> DataFrame:
    return _reaching(bandwidth_per_window(df, window), min_bytes)


def hot_sources_frequency(
    df: DataFrame,
    window: str = schema.DEFAULT_WINDOW,
    min_rows: int = schema.DEFAULT_MIN_ROWS,
) -> DataFrame:
    return _reaching(logs_per_window(df, window), min_rows)


def mark_sources(
    df: DataFrame, sources: DataFrame, flag: str, long_list: bool = False
) -> DataFrame:
    """``'1'`` on every row of a listed source, else ``'0'``. The null source
    counts as a source like any other. Of a ``long_list``, too long to be broadcast, a
    bitmap is, so that only rows that may be of it are shuffled."""
    listed = store(
        sources.select(F.col("source_ip").alias("_listed"), F.lit(True).alias("_hit")),
        flag,
    )
    if long_list:
        joined = join_long_list(df, "source_ip", listed, "_listed")
        return joined.withColumn(flag, flag_text("_hit")).drop("_hit")
    joined = df.join(listed, df["source_ip"].eqNullSafe(listed["_listed"]), "left")
    return joined.withColumn(
        flag, F.when(F.col("_hit"), F.lit("1")).otherwise(F.lit("0"))
    ).drop("_listed", "_hit")


def flag_bandwidth(
    df: DataFrame,
    window: str = schema.DEFAULT_WINDOW,
    min_bytes: int = schema.DEFAULT_MIN_BYTES,
) -> DataFrame:
    hot = hot_sources_bandwidth(df, window, min_bytes)
    return mark_sources(df, hot, "threat_type_bandwith")


def flag_frequency(
    df: DataFrame,
    window: str = schema.DEFAULT_WINDOW,
    min_rows: int = schema.DEFAULT_MIN_ROWS,
) -> DataFrame:
    hot = hot_sources_frequency(df, window, min_rows)
    return mark_sources(df, hot, "threat_type_frequency")


def window_sums(df: DataFrame, window: str = schema.DEFAULT_WINDOW) -> DataFrame:
    """``bytes`` and ``rows`` per source and window, by the window's ``start``; rows
    without a time, which belong to no window, have a null ``start``. Sums of parts of the
    log can be added up."""
    timed = df.select(
        "source_ip",
        "data_length",
        F.col("timestamp").isNotNull().alias("timed"),
        # window() drops rows without a time, but they count as rows of a source
        F.coalesce("timestamp", F.timestamp_seconds(F.lit(0))).alias("timestamp"),
    )
    sums = timed.groupBy(
        "source_ip", "timed", F.window("timestamp", window).alias("bucket")
    ).agg(
        F.sum("data_length").alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
    )
    return sums.select(
        "source_ip", F.when(F.col("timed"), F.col("bucket.start")).alias("start"), "bytes", "rows"
    )


def profile_of(
    sums: DataFrame,
    min_bytes: int = schema.DEFAULT_MIN_BYTES,
    min_rows: int = schema.DEFAULT_MIN_ROWS,
) -> DataFrame:
    """``source_profile`` from ``window_sums``."""
    timed = F.col("start").isNotNull()
    return sums.groupBy("source_ip").agg(
        F.sum("rows").alias("rows"),
        F.coalesce(
            F.bool_or(timed & (F.col("bytes") >= min_bytes)), F.lit(False)
        ).alias("hot_bytes"),
        F.bool_or(timed & (F.col("rows") >= min_rows)).alias("hot_rows"),
    )


def source_profile(
    df: DataFrame,
    window: str = schema.DEFAULT_WINDOW,
    min_bytes: int = schema.DEFAULT_MIN_BYTES,
    min_rows: int = schema.DEFAULT_MIN_ROWS,
) -> DataFrame:
    """One row per source: ``rows`` of all its log lines, ``hot_bytes`` and
    ``hot_rows`` for the two detectors.

    One shuffle serves both detectors and the row count: the sums per source and
    window are combined before they move, so a source with a third of the log
    sends one partial row per window and task.
    """
    return profile_of(window_sums(df, window), min_bytes, min_rows)


def flag_both(
    df: DataFrame,
    window: str = schema.DEFAULT_WINDOW,
    min_bytes: int = schema.DEFAULT_MIN_BYTES,
    min_rows: int = schema.DEFAULT_MIN_ROWS,
) -> DataFrame:
    """Both flags from one aggregation and one join."""
    profile = source_profile(df, window, min_bytes, min_rows)
    hot = store(
        profile.filter("hot_bytes OR hot_rows").select(
            F.col("source_ip").alias("_listed"), "hot_bytes", "hot_rows"
        ),
        "hot_sources",
    )
    joined = df.join(hot, df["source_ip"].eqNullSafe(hot["_listed"]), "left")
    return joined.select(
        *[df[c] for c in df.columns],
        flag_text("hot_bytes").alias("threat_type_bandwith"),
        flag_text("hot_rows").alias("threat_type_frequency"),
    )


def flag_text(column: str) -> Column:
    return F.when(F.col(column), F.lit("1")).otherwise(F.lit("0"))


def calibrate_thresholds(
    df: DataFrame, window: str = schema.DEFAULT_WINDOW
) -> DataFrame:
    """Mean bytes and mean rows per window over all sources, as one row."""
    per_window = df.groupBy(F.window("timestamp", window).alias("bucket")).agg(
        F.coalesce(F.sum("data_length"), F.lit(0)).alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
    )
    return per_window.agg(
        F.avg("bytes").alias("mean_bytes"), F.avg("rows").alias("mean_rows")
    )
