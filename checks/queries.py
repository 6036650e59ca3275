"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapter
from checks.adapter import HOST, YEAR
from emberwall import schema
from emberwall.operators import describe, detect, enrich, heavy, parse, ports, tables
from emberwall.plans import dashboard, load
from emberwall.plans.log_store import LogStore
from emberwall.session import apply_settings, new_path, store
from emberwall.sources import read_log
from emberwall.streaming import closed_windows, read_log_stream, window_stream

# The tables have about two rows per source and day, so the thresholds are low
# and the window is a day.
WINDOW = "1 day"
MIN_ROWS = 7
MIN_BYTES = 450
GEO_MIN_ROWS = 60
DETECTION = {
    "window": WINDOW,
    "min_bytes": MIN_BYTES,
    "min_rows": MIN_ROWS,
    "geo_min_rows": GEO_MIN_ROWS,
}
TIME_RANGE = ("2024-01-05 00:00:00", "2024-01-20 12:00:00")
PEAK_MINUTES = 20

# Whole numbers that may be null, by query. Data frames outside Spark often have no
# such type and show them as doubles, so both sides of the comparison give doubles.
AS_DOUBLE = {
    "split_options": ["n_options"],
    "typed_v4": ["data_length"],
    "typed_v4_from_text": ["data_length"],
    "bandwidth_per_window": ["count"],
    "enriched_ip4": ["data_length"],
    "port_counts_joined": ["source_port_counted", "destination_port_counted"],
    "port_counts_all": ["source_port_counted", "destination_port_counted"],
    "divide_ip4": ["data_length"],
    "join_log_ip4": ["data_length"],
    "dash_threat_bandwidth": ["time"],
    "dash_threat_frequency": ["time"],
    "sql_dash_threat_bandwidth": ["time"],
    "sql_dash_threat_frequency": ["time"],
    "store_rows": ["data_length"],
    "country_by_block": ["geo_block_length"],
    "stream_windows": ["bytes"],
    "counted_threat_bandwidth": ["time"],
    "counted_threat_frequency": ["time"],
}

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register under the name of the function."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(run(apply_settings(spark), sf_dir), run.__name__)

    _QUERIES[run.__name__] = prepared
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _comparable(df: DataFrame, name: str) -> DataFrame:
    """Types both sides of the comparison have: times without a zone, as in the
    SQL, and doubles where ``AS_DOUBLE`` says so."""
    kinds = {c: "timestamp_ntz" for c, kind in df.dtypes if kind == "timestamp"}
    kinds.update({c: "double" for c in AS_DOUBLE.get(name, [])})
    return df.select(
        *[
            F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


# --- tables loaded once per session and folder, as dashboards find them -------

class _Loaded(dict):
    """Typed frames ``v4`` and ``v6``, ``enriched``, and the tables that ``load`` writes
    from the log text for the dashboard. Each is made when it is first asked for, so a
    query that reads the typed rows does not wait for the tables, nor the other way."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name in ("v4", "v6"):
            parsed = load.parse_and_store(adapter.log_lines(self.spark, self.sf_dir), HOST, YEAR)
            self.update(v4=parse.rows_of(parsed, 4), v6=parse.rows_of(parsed, 6))
        elif name == "enriched":
            geo = adapter.geo(self.spark, self.sf_dir)
            self[name] = store(load.enrich_v4(self["v4"], geo, **DETECTION), "enriched")
        elif name in TABLE_NAMES:
            self.update(self._tables())
        else:
            raise KeyError(name)
        return self[name]

    def _tables(self) -> dict[str, DataFrame]:
        spark, suffix = self.spark, uuid.uuid4().hex
        names = {n: f"{n}_{suffix}" for n in TABLE_NAMES}
        targets = {name: new_path(spark, name) for name in names}
        load.load(
            adapter.log_lines(spark, self.sf_dir), HOST, adapter.geo(spark, self.sf_dir),
            targets, "dashboard", year=YEAR,
            buckets=spark.sparkContext.defaultParallelism, table_names=names, **DETECTION,
        )
        return {name: spark.table(table) for name, table in names.items()}


TABLE_NAMES = ("pfsense_log", "ip4", "ip6")
_LOADED: dict[tuple[str, str], _Loaded] = {}


def loaded(spark: SparkSession, sf_dir: str) -> _Loaded:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        _LOADED[key] = _Loaded(spark, sf_dir)
    return _LOADED[key]


def _v4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(spark, sf_dir)["v4"]


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.extract(adapter.log_lines(spark, sf_dir), HOST)


def _lines_of(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    return parse.by_ip_version(_extracted(spark, sf_dir), version)


# --- parsing -----------------------------------------------------------------


@query
def filter_log_lines(spark, sf_dir):
    return parse.filter_log_lines(adapter.log_lines(spark, sf_dir), HOST).select("id")


@query
def assign_id(spark, sf_dir):
    lines = read_log(spark, adapter.log_text(spark, sf_dir))
    return parse.extract(lines, HOST).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        F.count_if(F.col("id").isNull()).alias("n_null"),
    )


@query
def parse_ip_version(spark, sf_dir):
    return _extracted(spark, sf_dir).select("id", "ip_version")


@query
def split_ip_version(spark, sf_dir):
    lines = _extracted(spark, sf_dir)
    v4, v6 = (
        parse.by_ip_version(lines, v).select("id", F.lit(v).alias("version"))
        for v in (4, 6)
    )
    return v4.unionByName(v6)


@query
def parse_fields_v4(spark, sf_dir):
    return parse.parse_fields(_lines_of(spark, sf_dir, 4), schema.V4_FIELDS)


@query
def parse_fields_v6(spark, sf_dir):
    return parse.parse_fields(_lines_of(spark, sf_dir, 6), schema.V6_FIELDS)


def _headed(spark, sf_dir, version: int) -> DataFrame:
    fields = schema.V4_FIELDS if version == 4 else schema.V6_FIELDS
    raw = parse.parse_fields(_lines_of(spark, sf_dir, version), fields)
    return parse.parse_header(raw, HOST)


@query
def parse_header(spark, sf_dir):
    return _headed(spark, sf_dir, 4).select(
        "id", F.col("timestamp").alias("time_text"), "rule_number"
    )


@query
def parse_timestamp(spark, sf_dir):
    return parse.parse_timestamp(_headed(spark, sf_dir, 4), YEAR).select(
        "id", "timestamp"
    )


@query
def blank_to_null(spark, sf_dir):
    return parse.blanks_to_null(_headed(spark, sf_dir, 6)).select(
        "id", "sub_rule_number", "anchor", "class", "flow_label", "source_ip"
    )


@query
def whitespace_to_null(spark, sf_dir):
    return parse.clean_whitespace(_v4(spark, sf_dir)).select(
        "id", "ecn", "ack", "source_port", "protocoll_text"
    )


@query
def drop_null_columns(spark, sf_dir):
    raw = parse.blanks_to_null(_headed(spark, sf_dir, 6))
    return parse.drop_null_columns(raw)


@query
def cast_columns(spark, sf_dir):
    raw = parse.parse_fields(_lines_of(spark, sf_dir, 4), schema.V4_FIELDS)
    typed = parse.cast_columns(
        raw,
        {"ip_version": "int", "offset": "double", "length": "double", "data_length": "double"},
    )
    return typed.select("id", "ip_version", "offset", "length", "data_length", "ttl")


@query
def split_options(spark, sf_dir):
    raw = parse.parse_fields(_lines_of(spark, sf_dir, 4), schema.V4_FIELDS)
    options = parse.split_options(raw)
    return options.select(
        "id",
        F.size("options").alias("n_options"),
        F.get("options", F.lit(0)).alias("first_option"),
        F.get("options", F.lit(2)).alias("third_option"),
        F.col("options").cast("string").alias("options_text"),
    )


@query
def typed_v4(spark, sf_dir):
    return parse.parse_v4(_lines_of(spark, sf_dir, 4), HOST, YEAR)


@query
def typed_v4_from_text(spark, sf_dir):
    """As ``typed_v4``, from text files; their lines carry no id to compare."""
    lines = parse.extract(read_log(spark, adapter.log_text(spark, sf_dir)), HOST)
    return parse.parse_v4(parse.by_ip_version(lines, 4), HOST, YEAR).drop("id")


@query
def typed_v6(spark, sf_dir):
    return parse.parse_v6(_lines_of(spark, sf_dir, 6), HOST, YEAR)


@query
def minute_key(spark, sf_dir):
    return describe.with_minute_key(_v4(spark, sf_dir)).select("id", "minute")


@query
def json_field(spark, sf_dir):
    events = adapter.table(spark, sf_dir, "events").select("event_id", "props")
    return enrich.json_field(events, "props", ["k", "absent"]).drop("props")


# --- detection ---------------------------------------------------------------


@query
def bandwidth_per_window(spark, sf_dir):
    return detect.bandwidth_per_window(_v4(spark, sf_dir), WINDOW)


@query
def logs_per_window(spark, sf_dir):
    return detect.logs_per_window(_v4(spark, sf_dir), WINDOW)


@query
def hot_sources_bandwidth(spark, sf_dir):
    return detect.hot_sources_bandwidth(_v4(spark, sf_dir), WINDOW, MIN_BYTES)


@query
def hot_sources_frequency(spark, sf_dir):
    return detect.hot_sources_frequency(_v4(spark, sf_dir), WINDOW, MIN_ROWS)


@query
def flag_bandwidth(spark, sf_dir):
    flagged = detect.flag_bandwidth(_v4(spark, sf_dir), WINDOW, MIN_BYTES)
    return flagged.select("id", "source_ip", "threat_type_bandwith")


@query
def flag_frequency(spark, sf_dir):
    flagged = detect.flag_frequency(_v4(spark, sf_dir), WINDOW, MIN_ROWS)
    return flagged.select("id", "source_ip", "threat_type_frequency")


@query
def flag_both(spark, sf_dir):
    flagged = detect.flag_both(_v4(spark, sf_dir), WINDOW, MIN_BYTES, MIN_ROWS)
    return flagged.select(
        "id", "source_ip", "threat_type_bandwith", "threat_type_frequency"
    )


@query
def source_profile(spark, sf_dir):
    return detect.source_profile(_v4(spark, sf_dir), WINDOW, MIN_BYTES, MIN_ROWS)


@query
def calibrate_thresholds(spark, sf_dir):
    return detect.calibrate_thresholds(_v4(spark, sf_dir), "1 minute")


# --- enrichment --------------------------------------------------------------


@query
def frequent_sources(spark, sf_dir):
    return enrich.frequent_sources(_v4(spark, sf_dir), GEO_MIN_ROWS)


@query
def geo_lookup(spark, sf_dir):
    sources = _v4(spark, sf_dir).select("source_ip").distinct()
    return enrich.geo_lookup(sources, adapter.geo(spark, sf_dir))


@query
def geo_lookup_failure_codes(spark, sf_dir):
    sources = _v4(spark, sf_dir).select("source_ip").distinct()
    return enrich.geo_lookup(sources, adapter.geo(spark, sf_dir), failure_codes=True)


@query
def enrich_country(spark, sf_dir):
    enriched = enrich.enrich_country(
        _v4(spark, sf_dir), adapter.geo(spark, sf_dir), GEO_MIN_ROWS
    )
    return enriched.select("id", "source_ip", "source_country_code")


@query
def enriched_ip4(spark, sf_dir):
    return load.enrich_v4(_v4(spark, sf_dir), adapter.geo(spark, sf_dir), **DETECTION)


@query
def top_sources_metadata(spark, sf_dir):
    return enrich.top_sources_metadata(
        _v4(spark, sf_dir), adapter.metadata(spark, sf_dir)
    )


@query
def port_names_source(spark, sf_dir):
    ip4 = _v4(spark, sf_dir).select("id", "source_port", "destination_port")
    return enrich.add_source_port_names(ip4, adapter.port_names(spark, sf_dir))


@query
def port_names_both(spark, sf_dir):
    ip4 = _v4(spark, sf_dir).select("id", "source_port", "destination_port")
    return enrich.add_port_names(ip4, adapter.port_names(spark, sf_dir))


@query
def flag_blocklist(spark, sf_dir):
    flagged = enrich.flag_blocklist(
        _v4(spark, sf_dir), adapter.blocklist(spark, sf_dir), ["poor", "near"]
    )
    return flagged.select(
        "id", "source_ip", "dangerous", "dangerous_poor", "dangerous_near"
    )


@query
def blocklist_hits(spark, sf_dir):
    return enrich.blocklist_hits(_v4(spark, sf_dir), adapter.blocklist(spark, sf_dir))


# --- ports -------------------------------------------------------------------


def _clean(spark, sf_dir) -> DataFrame:
    return parse.clean_whitespace(_v4(spark, sf_dir))


@query
def numeric_ports(spark, sf_dir):
    return ports.numeric_ports(_clean(spark, sf_dir)).select(
        "id", "source_port", "destination_port"
    )


@query
def rejected_ports(spark, sf_dir):
    return ports.rejected_ports(_clean(spark, sf_dir))


@query
def port_class(spark, sf_dir):
    return ports.port_class(_clean(spark, sf_dir)).select(
        "id", "source_port", "source_port_class", "destination_port_class"
    )


@query
def port_counts_joined(spark, sf_dir):
    rows = _clean(spark, sf_dir).select("id", "source_port", "destination_port")
    return ports.with_port_counts(ports.numeric_ports(rows), counted_on=rows)


@query
def port_counts_all(spark, sf_dir):
    rows = _clean(spark, sf_dir).select("id", "source_port", "destination_port")
    return ports.with_port_counts(rows, k=None)


@query
def notable_ports(spark, sf_dir):
    return ports.all_notable_ports(_clean(spark, sf_dir))


# --- counts and top lists ----------------------------------------------------


def _counts(name: str, column: str, k: int | None = None) -> None:
    def run(spark, sf_dir):
        return describe.value_counts(_v4(spark, sf_dir), column, k=k)

    run.__name__ = name
    query(run)


_counts("counts_source_ip", "source_ip")
_counts("counts_destination_ip", "destination_ip")
_counts("counts_protocol", "protocoll_text")
_counts("counts_source_port", "source_port")
_counts("counts_destination_port", "destination_port")
_counts("top_source_ips", "source_ip", schema.DEFAULT_TOP)
_counts("top_destination_ips", "destination_ip", schema.DEFAULT_TOP)
_counts("top_source_ports", "source_port", schema.DEFAULT_TOP)
_counts("top_destination_ports", "destination_port", schema.DEFAULT_TOP)


@query
def counts_minute(spark, sf_dir):
    return describe.logs_per_minute(_v4(spark, sf_dir))


@query
def top_minutes_logs(spark, sf_dir):
    return describe.logs_per_minute(_v4(spark, sf_dir), schema.DEFAULT_TOP)


def _class_counts(spark, sf_dir, side: str) -> DataFrame:
    classed = ports.port_class(ports.numeric_ports(_clean(spark, sf_dir)))
    return describe.value_counts(classed, f"{side}_class")


@query
def counts_source_port_class(spark, sf_dir):
    return _class_counts(spark, sf_dir, "source_port")


@query
def counts_destination_port_class(spark, sf_dir):
    return _class_counts(spark, sf_dir, "destination_port")


@query
def icmp_sources(spark, sf_dir):
    rows = _v4(spark, sf_dir)
    return describe.value_counts(rows, "source_ip", F.col("protocoll_text") == "icmp")


@query
def sctp_sources(spark, sf_dir):
    rows = _v4(spark, sf_dir)
    return describe.value_counts(rows, "source_ip", F.col("protocoll_text") == "sctp")


@query
def port_sources(spark, sf_dir):
    rows = _v4(spark, sf_dir)
    return describe.value_counts(rows, "source_ip", F.col("source_port") == "61337")


@query
def port_destinations(spark, sf_dir):
    rows = _v4(spark, sf_dir)
    return describe.value_counts(
        rows, "destination_ip", F.col("destination_port") == "3478"
    )


@query
def minute_sources(spark, sf_dir):
    return describe.peak_minute_sources(_v4(spark, sf_dir), PEAK_MINUTES)


@query
def bytes_per_minute(spark, sf_dir):
    return describe.bytes_per_minute(_v4(spark, sf_dir))


@query
def top_minutes_bytes(spark, sf_dir):
    return describe.bytes_per_minute(_v4(spark, sf_dir), schema.DEFAULT_TOP)


# --- descriptions ------------------------------------------------------------


@query
def describe_source_ip(spark, sf_dir):
    return describe.describe_text(_v4(spark, sf_dir), "source_ip")


@query
def describe_destination_ip(spark, sf_dir):
    return describe.describe_text(_v4(spark, sf_dir), "destination_ip")


def _rounded(df: DataFrame) -> DataFrame:
    """Engines differ in the last digits of a deviation."""
    return df.withColumn("value", F.round("value", 6))


@query
def describe_data_length(spark, sf_dir):
    return _rounded(describe.describe_number(_v4(spark, sf_dir), "data_length"))


@query
def describe_bytes_per_minute(spark, sf_dir):
    minutes = describe.bytes_per_minute(_v4(spark, sf_dir))
    return _rounded(describe.describe_number(minutes, "bytes"))


@query
def describe_logs_per_minute(spark, sf_dir):
    minutes = describe.logs_per_minute(_v4(spark, sf_dir))
    return _rounded(describe.describe_number(minutes, "n"))


@query
def describe_time(spark, sf_dir):
    return describe.describe_time(_v4(spark, sf_dir))


@query
def column_max(spark, sf_dir):
    return describe.column_max(_v4(spark, sf_dir))


@query
def frame_info(spark, sf_dir):
    return describe.frame_info(_v4(spark, sf_dir)).select("column", "non_null")


# --- tables ------------------------------------------------------------------


@query
def divide_log(spark, sf_dir):
    return tables.divide(loaded(spark, sf_dir)["enriched"], 4)[0]


@query
def divide_ip4(spark, sf_dir):
    return tables.divide(loaded(spark, sf_dir)["enriched"], 4)[1]


@query
def divide_ip6(spark, sf_dir):
    return tables.divide(loaded(spark, sf_dir)["v6"], 6)[1]


@query
def merged_log(spark, sf_dir):
    rows = loaded(spark, sf_dir)
    return tables.split_tables(rows["enriched"], rows["v6"])["pfsense_log"]


@query
def join_log_ip4(spark, sf_dir):
    rows = loaded(spark, sf_dir)
    return tables.join_log_ip4(rows["pfsense_log"], rows["ip4"]).drop("date")


@query
def load_log(spark, sf_dir):
    """The log as the load wrote it."""
    log = loaded(spark, sf_dir)["pfsense_log"]
    return log.select(*schema.LOG_COLUMNS, F.col("date").cast("string").alias("date"))


@query
def load_tables(spark, sf_dir):
    """The whole load from text files, done anew: rows and ids of each table and
    how many of its ids the log knows."""
    made = load.build_tables(
        read_log(spark, adapter.log_text(spark, sf_dir)),
        HOST,
        adapter.geo(spark, sf_dir),
        YEAR,
        **DETECTION,
    )
    written = {name: store(df, name) for name, df in made.items()}
    known = written["pfsense_log"].select("id", F.lit(1).alias("known"))
    sizes = [
        df.select("id")
        .join(known, "id", "left")
        .agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("id").alias("n_ids"),
            F.count("known").alias("n_in_log"),
        )
        for name, df in written.items()
    ]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


# --- dashboard ---------------------------------------------------------------


def _dashboard(panel, time_range=None):
    def run(spark, sf_dir):
        rows = loaded(spark, sf_dir)
        return panel(rows["pfsense_log"], rows["ip4"], time_range)

    run.__name__ = panel.__name__
    query(run)
    return run


_bandwidth = _dashboard(dashboard.dash_threat_bandwidth)
_frequency = _dashboard(dashboard.dash_threat_frequency)
_country = _dashboard(dashboard.dash_country, TIME_RANGE)
_dashboard(dashboard.dash_bandwidth_over_time)
_dashboard(dashboard.dash_frequency_over_time)
_dashboard(dashboard.dash_logs_over_time)


def _sql_panel(name: str) -> None:
    def run(spark, sf_dir):
        rows = loaded(spark, sf_dir)
        dashboard.register_views({n: rows[n] for n in ("pfsense_log", "ip4")})
        ranged = TIME_RANGE if name == "dash_country" else None
        return spark.sql(dashboard.panel_sql(ranged)[name])

    run.__name__ = f"sql_{name}"
    query(run)


for _name in dashboard.panel_sql():
    _sql_panel(_name)


@query
def panel_threat_means(spark, sf_dir):
    panels = {"bandwidth": _bandwidth, "frequency": _frequency}
    means = [
        dashboard.panel_mean(run(spark, sf_dir), "count").select(
            F.lit(name).alias("panel"), "mean"
        )
        for name, run in panels.items()
    ]
    return means[0].unionByName(means[1])


@query
def panel_country_totals(spark, sf_dir):
    return dashboard.panel_total(_country(spark, sf_dir))


# --- long lists, blocks of addresses, streams ------------------------------------


@query
def top_source_ips_by_buckets(spark, sf_dir):
    return heavy.top_values(_v4(spark, sf_dir), "source_ip", schema.DEFAULT_TOP, buckets=256)


@query
def top_destination_ports_by_buckets(spark, sf_dir):
    return heavy.top_values(_v4(spark, sf_dir), "destination_port", schema.DEFAULT_TOP)


@query
def flag_bandwidth_long_list(spark, sf_dir):
    v4 = _v4(spark, sf_dir)
    hot = detect.hot_sources_bandwidth(v4, WINDOW, MIN_BYTES)
    marked = detect.mark_sources(v4, hot, "threat_type_bandwith", long_list=True)
    return marked.select("id", "source_ip", "threat_type_bandwith")


@query
def flag_blocklist_long_list(spark, sf_dir):
    flagged = enrich.flag_blocklist(
        _v4(spark, sf_dir), adapter.blocklist(spark, sf_dir), ["poor", "near"], long_list=True
    )
    return flagged.select("id", "source_ip", "dangerous", "dangerous_poor", "dangerous_near")


@query
def country_by_block(spark, sf_dir):
    found = enrich.geo_by_block(_v4(spark, sf_dir), adapter.address_blocks(spark, sf_dir))
    return found.select("id", "source_country_code", "geo_block_length")


STREAM_DELAY_DAYS = 3


@query
def stream_windows(spark, sf_dir):
    """The log folder replayed as a stream: the windows that have closed."""
    target, checkpoint = new_path(spark, "windows"), new_path(spark, "windows_checkpoint")
    lines = read_log_stream(spark, adapter.log_text(spark, sf_dir))
    delay = f"{STREAM_DELAY_DAYS} days"
    running = window_stream(lines, HOST, target, checkpoint, YEAR, WINDOW, delay, once=True)
    running.awaitTermination()
    return closed_windows(spark, target)


# --- a store that has grown by several loads -----------------------------------

_STORES: dict[tuple[str, str], LogStore] = {}


def stored(spark: SparkSession, sf_dir: str) -> LogStore:
    """A store that took the files of the log in two loads, the second of which was given
    those of the first as well. Made once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        geo, text = adapter.geo(spark, sf_dir), adapter.log_text(spark, sf_dir)
        root, buckets = new_path(spark, "store"), spark.sparkContext.defaultParallelism
        held = LogStore(spark, root, HOST, YEAR, buckets=buckets, **DETECTION)
        files = sorted(r.path for r in held.new_files(text).select("path").collect())
        held.load(files[: max(1, len(files) // 2)], geo)
        held.load(text, geo)
        _STORES[key] = held
    return _STORES[key]


@query
def store_rows(spark, sf_dir):
    rows = stored(spark, sf_dir).tables()
    joined = tables.join_log_ip4(rows["pfsense_log"], rows["ip4"])
    return joined.drop("id", "segment", "first_day", "last_day")


@query
def store_ip6(spark, sf_dir):
    return stored(spark, sf_dir).tables()["ip6"].drop("id", "segment", "first_day", "last_day")


@query
def store_tables(spark, sf_dir):
    """Rows and ids of each table and how many of its ids the log knows."""
    rows = stored(spark, sf_dir).tables()
    known = rows["pfsense_log"].select("id", F.lit(1).alias("known"))
    sizes = [
        df.select("id").join(known, "id", "left").agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("id").alias("n_ids"),
            F.count("known").alias("n_in_log"),
        )
        for name, df in rows.items()
    ]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


@query
def store_rejects(spark, sf_dir):
    """Lines that were not understood, as counted while they were parsed."""
    loads = stored(spark, sf_dir).state()["loads"].values()
    kinds = ["lines", "short", "bad_version", "bad_header", "bad_time"]
    rows = [(kind, load[kind]) for load in loads for kind in kinds]
    return spark.createDataFrame(rows, "kind string, n long").groupBy("kind").agg(
        F.sum("n").alias("n")
    )


def _counted(panel: str, run) -> None:
    def counted(spark, sf_dir):
        return run(stored(spark, sf_dir).counts())

    counted.__name__ = f"counted_{panel}"
    query(counted)


_HOT_BYTES, _HOT_ROWS = schema.THREAT_COLUMNS
_counted("threat_bandwidth", lambda c: dashboard.counted_per_year(c, _HOT_BYTES))
_counted("threat_frequency", lambda c: dashboard.counted_per_year(c, _HOT_ROWS))
_counted("country", lambda c: dashboard.counted_country(c, TIME_RANGE))
_counted("bandwidth_over_time", lambda c: dashboard.counted_over_time(c, _HOT_BYTES))
_counted("frequency_over_time", lambda c: dashboard.counted_over_time(c, _HOT_ROWS))
_counted("logs_over_time", lambda c: dashboard.counted_over_time(c))


@query
def store_dash_country(spark, sf_dir):
    rows = stored(spark, sf_dir).tables()
    return dashboard.dash_country(rows["pfsense_log"], rows["ip4"], TIME_RANGE)
