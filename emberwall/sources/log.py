from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_log(spark: SparkSession, path: str, sample: int | None = None) -> DataFrame:
    """One row per line in ``value``. ``sample`` keeps that many raw lines, before
    any filter; without it every line is read."""
    lines = spark.read.text(path)
    return lines if sample is None else lines.limit(sample)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
