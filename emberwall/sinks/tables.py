"""Where results go."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_database(
    df: DataFrame,
    table: str,
    url: str,
    properties: Mapping[str, str],
    connections: int | None = None,
) -> None:
    """Replace a table over JDBC. ``connections`` bounds how many tasks write at
    the same time; credentials come in ``properties``."""
    writer = df.write.mode("overwrite")
    if connections is not None:
        writer = writer.option("numPartitions", connections)
    writer.jdbc(url=url, table=table, mode="overwrite", properties=dict(properties))


def write_table(
    df: DataFrame,
    name: str,
    write_mode: str | None = None,
    db_url: str | None = None,
    db_properties: Mapping[str, str] | None = None,
    connections: int | None = None,
) -> None:
    """Write to a database if ``write_mode`` is ``database``, else to Parquet,
    where ``name`` is the path."""
    if write_mode == "database":
        write_database(df, name, db_url, db_properties or {}, connections)
    else:
        write_parquet(df, name)


def write_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    path: str | None = None,
    partition_by: str | None = None,
) -> DataFrame:
    """Store a table by buckets of ``id``, within partitions of a column if one is
    named. Two tables stored with the same number of buckets join on the id without
    a shuffle, however often they are joined.

    A task of such a join reads one bucket of all partitions it wants, so take as
    many buckets as make a bucket of the whole table about 1 GB; each partition then
    has that many files.
    """
    writer = (
        df.repartition(buckets, "id")
        .write.mode("overwrite")
        .bucketBy(buckets, "id")
        .sortBy("id")
        .format("parquet")
    )
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
