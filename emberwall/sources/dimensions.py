"""Lookup tables. Their files have a size, by which Spark decides to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwall.operators.enrich import METADATA_COLUMNS

PORT_NAMES = "port int, name string"


def read_port_names(
    spark: SparkSession, path: str, schema: str = PORT_NAMES
) -> DataFrame:
    """CSV with a header line; a port may have several names."""
    return spark.read.csv(path, header=True, schema=schema)


def read_blocklist(spark: SparkSession, path: str, list_name: str) -> DataFrame:
    """Addresses of a block list without header. The banner lines start with
    ``#``; they are told by that, as a split file has no first lines to skip."""
    lines = spark.read.text(path).select(F.trim("value").alias("line"))
    used = lines.filter((F.col("line") != "") & ~F.col("line").startswith("#"))
    ip = F.trim(F.substring_index("line", ",", 1))
    return used.select(ip.alias("ip"), F.lit(list_name).alias("list_name"))


def read_geo(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header: ip, country_code, status (ok, timeout, error)."""
    schema = "ip string, country_code string, status string"
    return spark.read.csv(path, header=True, schema=schema)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header: ip and the metadata columns, one row per address."""
    schema = ", ".join(f"{c} string" for c in ["ip", *METADATA_COLUMNS])
    return spark.read.csv(path, header=True, schema=schema)
