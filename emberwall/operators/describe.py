"""Counts, top lists and descriptions of columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwall import schema
from emberwall.functions import minute_key
from emberwall.operators.quantiles import count_values, quantiles_of
from emberwall.session import store

QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def value_counts(
    df: DataFrame,
    column: str,
    where: Column | None = None,
    k: int | None = None,
) -> DataFrame:
    """Rows per value in ``n``, most frequent first, without null; the ``k`` first
    if given. Equal counts are ordered by value."""
    rows = df if where is None else df.filter(where)
    counts = (
        rows.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ordered = counts.orderBy(F.desc("n"), column)
    return ordered if k is None else ordered.limit(k)


def with_minute_key(df: DataFrame) -> DataFrame:
    return df.withColumn("minute", minute_key(F.col("timestamp")))


def _per_minute(df: DataFrame) -> DataFrame:
    """Rows and bytes per minute key. Minutes are counted as times first: a key is
    made as text once per minute, not once per row."""
    exact = (
        df.filter(F.col("timestamp").isNotNull())
        .groupBy(F.date_trunc("minute", "timestamp").alias("at"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("data_length").alias("bytes"))
    )
    return exact.groupBy(minute_key(F.col("at")).alias("minute")).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    )


def logs_per_minute(df: DataFrame, k: int | None = None) -> DataFrame:
    """Rows per minute in ``n``, busiest minute first."""
    ordered = _per_minute(df).select("minute", "n").orderBy(F.desc("n"), "minute")
    return ordered if k is None else ordered.limit(k)


def bytes_per_minute(df: DataFrame, k: int | None = None) -> DataFrame:
    """Bytes of all sources per minute; 0 where no row of the minute has a length."""
    sums = _per_minute(df).select("minute", "bytes")
    return sums if k is None else sums.orderBy(F.desc("bytes"), "minute").limit(k)


def _minute_code(month, day, hour, minute) -> Column:
    """A minute key as a number."""
    return ((month * 100 + day) * 100 + hour) * 100 + minute


def _code_of_key(key: Column) -> Column:
    """The number of a key ``MM-dd HH:mm``; null for other text."""
    parts = [F.substring(key, at, 2).try_cast("int") for at in (1, 4, 7, 10)]
    return _minute_code(*parts)


def minute_sources(df: DataFrame, minutes: DataFrame | Sequence[str]) -> DataFrame:
    """Sources active in the given minutes: a list of keys, or a frame with a
    ``minute`` column such as a top list. Rows are compared by numbers taken from
    their time; no text is made of it."""
    parts = [f("timestamp") for f in (F.month, F.dayofmonth, F.hour, F.minute)]
    code = _minute_code(*parts)
    if isinstance(minutes, DataFrame):
        wanted = minutes.select(_code_of_key(F.col("minute")).alias("_code")).distinct()
        rows = df.join(wanted, code == F.col("_code"), "left_semi")
    else:
        keys = [k.replace("-", " ").replace(":", " ").split() for k in minutes]
        codes = [_minute_code(*map(int, k)) for k in keys if len(k) == 4]
        rows = df.filter(code.isin(*codes)) if codes else df.limit(0)
    return value_counts(rows, "source_ip")


def peak_minute_sources(df: DataFrame, k: int = schema.DEFAULT_TOP) -> DataFrame:
    """Sources active in the ``k`` minutes with the most rows."""
    return minute_sources(df, store(logs_per_minute(df, k), "peak_minutes"))


def _frequencies(df: DataFrame, column: str) -> DataFrame:
    values = df.filter(F.col(column).isNotNull())
    return values.groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _top() -> Column:
    """The most frequent value, the smallest of those equally frequent."""
    return F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("value")))


def describe_text(df: DataFrame, column: str) -> DataFrame:
    """count, unique, top and freq, from one count per value."""
    summary = _frequencies(df, column).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.count(F.lit(1)).alias("unique"),
        _top().alias("top"),
    )
    return summary.select(
        "count",
        "unique",
        F.col("top.value").alias("top"),
        (-F.col("top.minus_n")).alias("freq"),
    )


def describe_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """count, unique, top, freq, first and last of a time column."""
    summary = _frequencies(df, column).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.count(F.lit(1)).alias("unique"),
        _top().alias("top"),
        F.min("value").alias("first"),
        F.max("value").alias("last"),
    )
    return summary.select(
        "count",
        "unique",
        F.col("top.value").alias("top"),
        (-F.col("top.minus_n")).alias("freq"),
        "first",
        "last",
    )


def describe_number(df: DataFrame, column: str) -> DataFrame:
    """Rows (``statistic``, ``value``): count, mean, std, min, quartiles, max of the
    values that are neither null nor NaN. The quartiles are exact.

    The rows are read once: different values are counted and stored, and all
    statistics come from the counts.
    """
    counted = store(count_values(df, column), "values")
    sums = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ).first()
    total, mean = sums["count"], sums["mean"]
    std = None
    if total > 1:
        off = F.col("value") - F.lit(mean)
        std = math.sqrt(counted.agg(F.sum(off * off * F.col("n"))).first()[0] / (total - 1))
    found = quantiles_of(counted, list(QUARTILES.values()))
    rows = [
        ("count", float(total)), ("mean", mean), ("std", std), ("min", sums["min"]),
        *[(name, found[p]) for name, p in QUARTILES.items()], ("max", sums["max"]),
    ]
    return df.sparkSession.createDataFrame(rows, "statistic string, value double")


def column_max(df: DataFrame) -> DataFrame:
    """Largest value of every column, as one row."""
    return df.agg(*[F.max(c).alias(c) for c in df.columns])


def frame_info(df: DataFrame) -> DataFrame:
    """Rows (``column``, ``type``, ``non_null``), one per column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(name).alias("non_null"),
        )
        for name, kind in df.dtypes
    ]
    return counts.select(F.inline(F.array(*rows)))
