"""Bytes and rows per source and window of a growing log folder, and the sources that
pass a threshold.

A window is written once, when the watermark has passed its end: the latest time seen
less a delay. What comes later than that is dropped, so the delay is how late a line may
be. The state holds the sums of open windows only, one per source and window, combined
before they are shuffled; it and what was read so far are kept in the checkpoint, so a
stream that was stopped, or whose executors were lost, goes on without losing or doubling
a line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emberwall import schema
from emberwall.operators.parse import by_ip_version, extract, parse_v4

WINDOWS = "source_ip string, window_start timestamp, window_end timestamp, bytes long, rows long"


def read_log_stream(spark: SparkSession, folder: str, files_at_once: int | None = None) -> DataFrame:
    """Lines of the files in a folder and of those that are added to it."""
    reader = spark.readStream
    if files_at_once is not None:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.text(folder)


def _sums(
    lines: DataFrame, host: str, year: int, window: str, delay: str
) -> DataFrame:
    # rows of a stream have no numbers, and sums need none
    numbered = lines.withColumn("id", F.lit(0).cast("long"))
    rows = parse_v4(by_ip_version(extract(numbered, host), 4), host, year)
    timed = rows.select("source_ip", "timestamp", "data_length").withWatermark("timestamp", delay)
    sums = timed.groupBy(F.window("timestamp", window).alias("bucket"), "source_ip").agg(
        F.sum("data_length").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    return sums.select(
        "source_ip",
        F.col("bucket.start").alias("window_start"),
        F.col("bucket.end").alias("window_end"),
        "bytes",
        "rows",
    )


def window_stream(
    lines: DataFrame,
    host: str,
    target: str,
    checkpoint: str,
    year: int = schema.DEFAULT_YEAR,
    window: str = schema.DEFAULT_WINDOW,
    delay: str = "5 minutes",
    once: bool = False,
) -> StreamingQuery:
    """Start writing closed windows to the folder ``target``. ``once`` reads what is there
    and stops; else it goes on until it is stopped. ``checkpoint`` must be a folder all
    executors reach, of this stream alone."""
    writer = _sums(lines, host, year, window, delay).writeStream.outputMode("append")
    writer = writer.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def closed_windows(spark: SparkSession, target: str) -> DataFrame:
    """The windows written so far. Only files that the stream has committed are read."""
    return spark.read.schema(WINDOWS).parquet(target)


def hot_sources(
    windows: DataFrame,
    min_bytes: int = schema.DEFAULT_MIN_BYTES,
    min_rows: int = schema.DEFAULT_MIN_ROWS,
) -> DataFrame:
    """Sources that passed a threshold in some closed window: ``hot_bytes``, ``hot_rows``
    and when they first did, ``since``."""
    of_bytes, of_rows = F.col("bytes") >= min_bytes, F.col("rows") >= min_rows
    hot = windows.filter(of_bytes | of_rows)
    return hot.groupBy("source_ip").agg(
        F.coalesce(F.bool_or(of_bytes), F.lit(False)).alias("hot_bytes"),
        F.bool_or(of_rows).alias("hot_rows"),
        F.min("window_start").alias("since"),
    )
