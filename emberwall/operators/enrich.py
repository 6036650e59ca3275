"""Country, metadata, port names and block lists joined to the log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwall import schema
from emberwall.functions import json_struct
from emberwall.operators.describe import value_counts
from emberwall.operators.heavy import join_long_list, top_values
from emberwall.session import store

# Columns of the metadata lookup.
METADATA_COLUMNS = [
    "org", "city", "country", "region", "postal", "hostname", "location", "timezone",
]


def frequent_sources(
    df: DataFrame, min_rows: int = schema.DEFAULT_GEO_MIN_ROWS
) -> DataFrame:
    """Sources with at least ``min_rows`` rows, most frequent first."""
    counts = df.groupBy("source_ip").agg(F.count(F.lit(1)).alias("count"))
    frequent = counts.filter(F.col("count") >= min_rows)
    return frequent.orderBy(F.desc("count"), "source_ip")


def country_of(code: Column, status: Column, failure_codes: bool = False) -> Column:
    """The country of a looked-up address. ``failure_codes`` writes the two
    failures of a lookup into the code itself instead of leaving it null."""
    if not failure_codes:
        return F.when(status == "ok", code)
    # How a failed lookup was written as a country.
    return (
        F.when(status == "timeout", F.lit("Timeout"))
        .when(status == "error", F.lit("404"))
        .otherwise(code)
    )


def one_country_per_ip(geo: DataFrame) -> DataFrame:
    """``geo(ip, country_code, status)`` with one row per address: status ``ok``
    first, then rows with a country, then the smallest country and status."""
    order = F.struct(
        F.coalesce(F.col("status") != "ok", F.lit(True)).alias("failed"),
        F.col("country_code").isNull().alias("unknown"),
        "country_code",
        "status",
    )
    best = geo.groupBy("ip").agg(F.min(order).alias("best"))
    return best.select("ip", "best.country_code", "best.status")


def _lookup(df: DataFrame, known: DataFrame, failure_codes: bool) -> DataFrame:
    found = df.join(known, df["source_ip"] == known["ip"], "left")
    return found.select(
        *[df[c] for c in df.columns],
        country_of(known["country_code"], known["status"], failure_codes).alias(
            "source_country_code"
        ),
        F.coalesce(known["status"], F.lit("missing")).alias("geo_status"),
    )


def geo_lookup(
    df: DataFrame, geo: DataFrame, failure_codes: bool = False
) -> DataFrame:
    """Country of every ``source_ip`` of ``df`` from the table ``geo(ip,
    country_code, status)``; the status of an address not in it is ``missing``.
    An address that ``geo`` repeats is looked up as by ``one_country_per_ip``, so
    no row of ``df`` is ever doubled. The sources are stored first, to cut ``geo`` down
    to them before any of it moves."""
    sources = store(df.select("source_ip").distinct(), "looked_up")
    return _lookup(df, one_country_per_ip(geo_of(sources, geo)), failure_codes)


def geo_of(sources: DataFrame, geo: DataFrame) -> DataFrame:
    """The rows of ``geo`` for stored ``sources``: cut down in place where the list
    is small, so a large lookup table is not shuffled whole."""
    wanted = sources.select(F.col("source_ip").alias("ip"))
    return geo.join(wanted, "ip", "left_semi")


def ip_number(ip: Column) -> Column:
    """An IPv4 address as a number; null for any other text."""
    valid = ip.rlike(r"^(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}$")
    parts = F.split(ip, r"\.")
    number = F.lit(0).cast("long")
    for i in range(4):
        number = number * 256 + F.get(parts, F.lit(i)).try_cast("long")
    return F.when(valid, number)


def address_blocks(blocks: DataFrame) -> DataFrame:
    """``blocks(cidr, country_code)`` as (``length``, ``prefix``, ``country_code``), one row
    per block: the smallest country of several, null last. A block whose address has bits
    beyond its length is the block that holds the address; what is no IPv4 block goes."""
    length = F.substring_index("cidr", "/", -1).try_cast("int")
    number = ip_number(F.substring_index("cidr", "/", 1))
    known = blocks.filter(F.col("cidr").contains("/")).select(
        length.alias("length"), number.alias("number"), "country_code"
    )
    known = known.filter(F.col("length").between(0, 32) & F.col("number").isNotNull())
    prefix = F.call_function("shiftright", "number", 32 - F.col("length"))
    return known.groupBy("length", prefix.alias("prefix")).agg(
        F.min("country_code").alias("country_code")
    )


def geo_by_block(df: DataFrame, blocks: DataFrame) -> DataFrame:
    """Country of every ``source_ip`` of ``df`` by the longest of ``blocks(cidr,
    country_code)`` that holds it, and that block's length in ``geo_block_length``; both
    null if none does or the source is no IPv4 address.

    Different sources are looked up once each. A source is looked up by its prefix of
    every length that occurs, of which there are 33 at most, so this is a join on equal
    values: no range is searched, and large lists of blocks are joined by shuffle.
    """
    known = store(address_blocks(blocks), "blocks")
    lengths = sorted(r.length for r in known.select("length").distinct().collect())
    sources = df.select("source_ip").distinct().withColumn("_number", ip_number(F.col("source_ip")))
    probes = F.array(
        *[
            F.struct(
                F.lit(n).alias("length"),
                F.shiftright(F.col("_number"), 32 - n).alias("prefix"),
            )
            for n in lengths or [0]
        ]
    )
    probed = sources.filter(F.col("_number").isNotNull()).select("source_ip", F.inline(probes))
    met = probed.join(known, ["length", "prefix"])
    longest = met.groupBy("source_ip").agg(
        F.max("length").alias("geo_block_length"),
        F.max_by("country_code", "length").alias("source_country_code"),
    )
    longest = store(longest.withColumnRenamed("source_ip", "_source"), "longest")
    joined = df.join(longest, df["source_ip"] == longest["_source"], "left")
    return joined.select(*[df[c] for c in df.columns], "source_country_code", "geo_block_length")


def enrich_country(
    df: DataFrame,
    geo: DataFrame,
    min_rows: int = schema.DEFAULT_GEO_MIN_ROWS,
    failure_codes: bool = False,
) -> DataFrame:
    """Add ``source_country_code``; only frequent sources carry one."""
    counts = df.groupBy("source_ip").agg(F.count(F.lit(1)).alias("_rows"))
    frequent = counts.filter(F.col("_rows") >= min_rows).select("source_ip")
    frequent = store(frequent, "frequent")
    countries = _lookup(frequent, one_country_per_ip(geo_of(frequent, geo)), failure_codes)
    countries = store(
        countries.filter("source_country_code IS NOT NULL").drop("geo_status"),
        "countries",
    )
    return df.join(countries, "source_ip", "left").select(
        *df.columns, "source_country_code"
    )


def one_metadata_per_ip(metadata: DataFrame) -> DataFrame:
    """One row per address: the smallest in the order of the columns, null first."""
    best = metadata.groupBy("ip").agg(F.min(F.struct(*METADATA_COLUMNS)).alias("best"))
    return best.select("ip", "best.*")


def top_sources_metadata(
    df: DataFrame,
    metadata: DataFrame,
    k: int = schema.DEFAULT_TOP_METADATA,
    many_sources: bool = False,
) -> DataFrame:
    """The ``k`` most frequent sources with their metadata, ``'0'`` where unknown;
    one row each, whatever ``metadata`` repeats.

    The stored top list is small, so a large ``metadata`` is cut down to it in
    place, without a shuffle, before the two are joined. With ``many_sources`` the list is
    found without shuffling them all (``heavy.top_values``).
    """
    top = (top_values if many_sources else value_counts)(df, "source_ip", k=k)
    top = store(
        top.select(F.col("source_ip").alias("ip"), F.col("n").alias("frequency")),
        "top_sources",
    )
    known = one_metadata_per_ip(metadata.join(top, "ip", "left_semi"))
    return top.join(known, "ip", "left").select(
        "ip",
        "frequency",
        *[F.coalesce(c, F.lit("0")).alias(c) for c in METADATA_COLUMNS],
    )


def json_field(
    df: DataFrame, column: str, name: str | Sequence[str], default: str | None = "0"
) -> DataFrame:
    """Take keys of a JSON column into columns of their own; the text is parsed once."""
    names = [name] if isinstance(name, str) else list(name)
    parsed = df.select("*", json_struct(F.col(column), names).alias("_parsed"))
    return parsed.withColumns(
        {n: F.coalesce(F.col("_parsed").getField(n), F.lit(default)) for n in names}
    ).drop("_parsed")


def _with_names(
    df: DataFrame, names: DataFrame, on: str, taken: list[str], suffix: str
) -> DataFrame:
    """Left join; a name column that clashes with one of ``taken`` gets the suffix."""
    renamed = names.withColumn("port", F.col("port").cast("string")).select(
        *[F.col(c).alias(c + suffix if c in taken else c) for c in names.columns]
    )
    key = "port" + suffix if "port" in taken else "port"
    return df.join(renamed, df[on] == renamed[key], "left")


def add_source_port_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Name columns of the source port; a port with several names gives several rows."""
    return _with_names(df, names, "source_port", df.columns, "_source_name")


def add_port_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Names of both ports; those of the destination get ``_destination_name``."""
    first = add_source_port_names(df, names)
    return _with_names(
        first, names, "destination_port", first.columns, "_destination_name"
    )


def flag_blocklist(
    df: DataFrame,
    blocklist: DataFrame,
    lists: Sequence[str] = (),
    long_list: bool = False,
) -> DataFrame:
    """``dangerous`` is true where the source is on any list of ``blocklist(ip,
    list_name)``; every name in ``lists`` gives ``dangerous_<name>`` as well. Of a
    ``long_list``, too long to be broadcast, a bitmap is, so that only rows that may be on
    it are shuffled (``heavy.join_long_list``)."""
    flags = ["dangerous"] + [f"dangerous_{name}" for name in lists]
    on_list = [F.lit(True)] + [F.col("list_name") == name for name in lists]
    per_ip = blocklist.groupBy(F.col("ip").alias("_ip")).agg(
        *[F.bool_or(test).alias(flag) for flag, test in zip(flags, on_list)]
    )
    if long_list:
        listed = store(per_ip.filter(F.col("_ip").isNotNull()), "blocklist")
        joined = join_long_list(df, "source_ip", listed, "_ip")
    else:
        joined = df.join(per_ip, df["source_ip"] == per_ip["_ip"], "left")
    return joined.select(
        *df.columns, *[F.coalesce(flag, F.lit(False)).alias(flag) for flag in flags]
    )


def blocklist_hits(df: DataFrame, blocklist: DataFrame) -> DataFrame:
    """``source_ip`` of every row whose source is on a list."""
    return flag_blocklist(df, blocklist).filter("dangerous").select("id", "source_ip")
