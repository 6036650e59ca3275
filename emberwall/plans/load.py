"""From log text to the three tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from emberwall import schema
from emberwall.operators.detect import flag_text, source_profile
from emberwall.operators.enrich import country_of, geo_of, one_country_per_ip
from emberwall.operators.parse import extract, log_of, parse_versions, rows_of
from emberwall.operators.tables import by_time, divide, with_date
from emberwall.session import scratch, store, store_sized
from emberwall.sinks import write_bucketed, write_table


def parse_and_store(
    lines: DataFrame,
    host: str,
    year: int = schema.DEFAULT_YEAR,
    load: int | None = None,
    rejects: Observation | None = None,
) -> DataFrame:
    """The parsed log of both versions, for ``rows_of`` and ``log_of``.

    The text is read and split once. Ids are given in that pass and stored with
    the rows, so all that is taken from the result agrees on them; ``rejects`` counts
    lines that are not understood (see ``parse_versions``).
    """
    return store(parse_versions(extract(lines, host, load), host, year, rejects), "parsed")


def enrich_v4(
    v4: DataFrame,
    geo: DataFrame,
    window: str = schema.DEFAULT_WINDOW,
    min_bytes: int = schema.DEFAULT_MIN_BYTES,
    min_rows: int = schema.DEFAULT_MIN_ROWS,
    geo_min_rows: int = schema.DEFAULT_GEO_MIN_ROWS,
    failure_codes: bool = False,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Add both threat flags and the country of frequent sources.

    One aggregation per source gives all three. Only sources that get a flag or
    a country are stored and joined back, by one join. If the stored files are at
    most ``broadcast_bytes``, the list is broadcast to spare a shuffle of the log,
    where else Spark decides by its own threshold; in memory it is up to ten times
    as large.
    """
    profile = source_profile(v4, window, min_bytes, min_rows)
    frequent = F.col("rows") >= geo_min_rows
    flagged = F.col("hot_bytes") | F.col("hot_rows")
    kept = store(profile.filter(flagged | frequent), "profile")
    known = one_country_per_ip(geo_of(kept.filter(frequent), geo))
    found = kept.join(known, kept["source_ip"] == known["ip"], "left")
    country = country_of(F.col("country_code"), F.col("status"), failure_codes)
    sources, size = store_sized(
        found.select(
            F.col("source_ip").alias("_source"),
            "hot_bytes",
            "hot_rows",
            F.when(frequent, country).alias("source_country_code"),
        ).filter(flagged | F.col("source_country_code").isNotNull()),
        "sources",
    )
    if broadcast_bytes is not None and size <= broadcast_bytes:
        sources = F.broadcast(sources)
    joined = v4.join(sources, v4["source_ip"].eqNullSafe(sources["_source"]), "left")
    return joined.select(
        *[v4[c] for c in schema.V4_COLUMNS],
        flag_text("hot_bytes").alias("threat_type_bandwith"),
        flag_text("hot_rows").alias("threat_type_frequency"),
        "source_country_code",
    )


def build_tables(
    lines: DataFrame,
    host: str,
    geo: DataFrame,
    year: int = schema.DEFAULT_YEAR,
    keep_boundary: bool = False,
    ordered: bool = True,
    dated: bool = False,
    **detection,
) -> dict[str, DataFrame]:
    """``pfsense_log``, ``ip4`` and ``ip6`` from log lines, not yet written; with the
    column ``date`` if ``dated``. ``detection`` takes the keywords of ``enrich_v4``."""
    parsed = parse_and_store(lines, host, year)
    log = log_of(parsed)
    v4 = enrich_v4(rows_of(parsed, 4), geo, **detection)
    v6 = rows_of(parsed, 6)
    if dated:
        log, v4, v6 = with_date(log), with_date(v4), with_date(v6)
    return {
        "pfsense_log": by_time(log) if ordered else log,
        "ip4": divide(v4, 4, keep_boundary)[1],
        "ip6": divide(v6, 6, keep_boundary)[1],
    }


def load(
    lines: DataFrame,
    host: str,
    geo: DataFrame,
    targets: Mapping[str, str],
    write_mode: str | None = None,
    db_url: str | None = None,
    db_properties: Mapping[str, str] | None = None,
    connections: int | None = None,
    buckets: int | None = None,
    table_names: Mapping[str, str] | None = None,
    **options,
) -> None:
    """Build the three tables and write each to its target: a path, or a table
    name if ``write_mode`` is ``database``. What is stored on the way is removed.

    ``write_mode`` ``dashboard`` lays the tables out for the panels: at the path of
    the target, with a column ``date``, partitioned by it, in ``buckets`` by id
    (see ``write_bucketed``; by default as many as a shuffle has parts). They are
    tables of the catalog, named as in ``table_names``, else like the targets' keys.
    """
    spark = lines.sparkSession
    with scratch(spark):
        if write_mode != "dashboard":
            made = build_tables(lines, host, geo, **options)
            for name, df in made.items():
                write_table(df, targets[name], write_mode, db_url, db_properties, connections)
            return
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        made = build_tables(lines, host, geo, ordered=False, dated=True, **options)
        for name, df in made.items():
            table = (table_names or {}).get(name, name)
            write_bucketed(df, table, buckets, targets[name], partition_by="date")
