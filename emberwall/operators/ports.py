"""Port numbers: which are numeric, their class, and how often they occur."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwall import schema
from emberwall.functions import is_number
from emberwall.functions import port_class as class_of
from emberwall.functions.ports import PRIVATE, REGISTERED, STANDARD
from emberwall.session import store

PORTS = ["source_port", "destination_port"]

# Fixed values: (side, class, count a port must exceed to be listed).
NOTABLE = [
    ("source_port", STANDARD, 10),
    ("destination_port", STANDARD, 10),
    ("source_port", PRIVATE, 100),
    ("destination_port", PRIVATE, 10),
    ("source_port", REGISTERED, 100),
    ("destination_port", REGISTERED, 100),
]


def _usable(port: str) -> Column:
    """A missing port is kept; text that is no number is not."""
    return F.col(port).isNull() | is_number(F.col(port))


def numeric_ports(df: DataFrame) -> DataFrame:
    """Rows whose two ports are numbers or missing."""
    return df.filter(_usable("source_port") & _usable("destination_port"))


def rejected_ports(df: DataFrame) -> DataFrame:
    """The ports ``numeric_ports`` drops rows for, in (``id``, ``side``, ``port``).
    A row rejected for its source port is not looked at again."""
    side = F.when(~_usable("source_port"), F.lit("source_port")).when(
        ~_usable("destination_port"), F.lit("destination_port")
    )
    port = F.when(F.col("side") == "source_port", F.col("source_port")).otherwise(
        F.col("destination_port")
    )
    return (
        df.withColumn("side", side)
        .filter(F.col("side").isNotNull())
        .select("id", "side", port.alias("port"))
    )


def port_class(df: DataFrame) -> DataFrame:
    """Add ``source_port_class`` and ``destination_port_class``."""
    return df.select("*", *[class_of(F.col(p)).alias(f"{p}_class") for p in PORTS])


def port_counts(df: DataFrame) -> DataFrame:
    """(``side``, ``port``, ``n``, ``usable``), from one pass over the rows: how often a
    port occurs, and whether it does in a row both of whose ports are numbers or
    missing. Counts are combined before they move."""
    usable = _usable("source_port") & _usable("destination_port")
    sides = [F.struct(F.lit(p).alias("side"), F.col(p).alias("port")) for p in PORTS]
    rows = df.select(usable.alias("usable"), F.inline(F.array(*sides)))
    return (
        rows.filter(F.col("port").isNotNull())
        .groupBy("side", "port")
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or("usable").alias("usable"))
    )


def _most_frequent(counts: DataFrame, side: str, k: int | None) -> DataFrame:
    own = counts.filter(F.col("side") == side)
    return own if k is None else own.orderBy(F.desc("n"), "port").limit(k)


def with_port_counts(
    df: DataFrame, k: int | None = schema.DEFAULT_TOP, counted_on: DataFrame | None = None
) -> DataFrame:
    """Add how often the source and the destination port occur; null for ports
    outside the ``k`` most frequent (``None``: count all ports). Counts are taken
    on ``counted_on``, by default the frame itself, for both sides at once."""
    counts = store(port_counts(df if counted_on is None else counted_on), "ports")
    result = df
    for port in PORTS:
        own = _most_frequent(counts, port, k).select(
            F.col("port").alias(f"_{port}"), F.col("n").alias(f"{port}_counted")
        )
        result = result.join(own, F.col(port) == F.col(f"_{port}"), "left")
        result = result.drop(f"_{port}")
    return result


def all_notable_ports(
    df: DataFrame, k: int | None = schema.DEFAULT_TOP, counts: DataFrame | None = None
) -> DataFrame:
    """Every list of ``NOTABLE`` in one frame: (``side``, ``class``, ``port``, ``n``).

    Ports are counted on all rows of ``df``, in one pass whose counts are stored;
    listed are those of rows whose ports are numbers or missing. ``n`` is the mean of
    the joined count over the rows of the port, which is the same on each of them,
    so no row of the log is joined.
    """
    if counts is None:
        counts = store(port_counts(df), "ports")
    top = _most_frequent(counts, PORTS[0], k).unionByName(_most_frequent(counts, PORTS[1], k))
    classed = top.filter("usable").withColumn("class", class_of(F.col("port")))
    limit = F.lit(None).cast("int")
    for side, kind, above in NOTABLE:
        limit = F.when(
            (F.col("side") == side) & (F.col("class") == kind), above
        ).otherwise(limit)
    return classed.filter(F.col("n") > limit).select(
        "side", "class", "port", F.col("n").cast("double").alias("n")
    )


def notable_ports(
    df: DataFrame,
    side: str,
    port_class: str,
    above: int,
    k: int | None = schema.DEFAULT_TOP,
) -> DataFrame:
    """Ports of one class that occur more than ``above`` times, as one list of
    ``all_notable_ports``."""
    top = _most_frequent(port_counts(df), side, k).filter("usable")
    classed = top.withColumn("class", class_of(F.col("port")))
    return classed.filter((F.col("class") == port_class) & (F.col("n") > above)).select(
        "side", "class", "port", F.col("n").cast("double").alias("n")
    )
