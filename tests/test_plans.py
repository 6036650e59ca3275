"""What Spark makes of the queries: pruned scans, few shuffles, no Python."""

import re

import pytest
from support import HOST, plan_of
from pyspark.sql import functions as F

from checks import adapter
from checks.queries import DETECTION, loaded, queries
from emberwall.operators import describe, detect, enrich, parse, ports
from emberwall.plans import dashboard, load
from emberwall.sources import read_log

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return loaded(spark, SMALL)


@pytest.fixture
def shuffle_joins_only(spark):
    """Plan joins as for tables too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def explained(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffles(plan):
    return len(re.findall(r"\bExchange (?:hash|range|Single|Round)", plan))


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_text_is_scanned_and_split_once(spark):
    lines = read_log(spark, adapter.log_text(spark, SMALL))
    plan = plan_of(parse.parse_versions(parse.extract(lines, HOST), HOST, 2024))
    assert plan.count("FileScan text") == 1
    assert plan.count("split(") == 1
    assert shuffles(plan) == 0


def test_generated_code_is_small_enough_to_compile(spark):
    """The JVM leaves methods above 8000 bytes of code interpreted."""
    lines = read_log(spark, adapter.log_text(spark, SMALL))
    df = parse.parse_versions(parse.extract(lines, HOST), HOST, 2024)
    code = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_detectors_read_three_columns_and_shuffle_counts_only(spark, tables):
    plan = plan_of(detect.source_profile(tables["v4"]))
    assert "v4:struct<source_ip:string,data_length:int>" in plan
    assert "tracker_id" not in plan
    assert plan.count("FileScan") == 1
    assert shuffles(plan) == 2  # per window, per source
    for exchange in re.findall(r"Exchange.*\n.*", plan):
        assert "HashAggregate" in exchange  # combined before it moves


def test_hot_sources_are_broadcast_by_their_size(spark, tables):
    flagged = detect.flag_both(tables["v4"])
    plan = plan_of(flagged)
    assert "BroadcastHashJoin" in plan and shuffles(plan) == 0


def test_large_lists_are_joined_by_shuffle(spark, tables, shuffle_joins_only):
    plan = plan_of(detect.flag_both(tables["v4"]))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_enrichment_joins_the_log_once(spark, tables):
    enriched = load.enrich_v4(tables["v4"], adapter.geo(spark, SMALL), **DETECTION)
    plan = plan_of(enriched)
    assert plan.count("Join") == 1 and shuffles(plan) == 0


def test_lookup_tables_are_not_forced_on_every_task(spark, tables, shuffle_joins_only):
    flagged = enrich.flag_blocklist(tables["v4"], adapter.blocklist(spark, SMALL))
    assert "BroadcastExchange" not in plan_of(flagged)


@pytest.mark.parametrize("panel", [
    "dash_threat_bandwidth", "dash_threat_frequency", "dash_country",
    "dash_bandwidth_over_time", "dash_frequency_over_time", "dash_logs_over_time",
])
def test_bucketed_tables_join_without_shuffle(spark, tables, shuffle_joins_only, panel):
    result = getattr(dashboard, panel)(tables["pfsense_log"], tables["ip4"])
    plan = plan_of(result)
    join = plan[plan.index("SortMergeJoin"):]
    assert shuffles(join) == 0


def test_dashboard_filters_reach_the_scan(spark, tables):
    bounds = ("2024-01-05 00:00:00", "2024-01-20 12:00:00")
    plan = explained(dashboard.dash_country(tables["pfsense_log"], tables["ip4"], bounds))
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThanOrEqual(timestamp" in plan
    assert "IsNotNull(source_country_code)" in plan
    assert "struct<id:bigint,timestamp:timestamp>" in plan
    assert "struct<id:bigint,data_length:int,source_country_code:string>" in plan
    days = re.findall(r"PartitionFilters: \[(.*)\]", plan)
    assert len(days) == 2 and all("2024-01-05" in d and "2024-01-20" in d for d in days)
    flagged = explained(dashboard.dash_threat_bandwidth(tables["pfsense_log"], tables["ip4"]))
    assert "EqualTo(threat_type_bandwith,1)" in flagged


@pytest.mark.parametrize("panel", sorted(dashboard.panel_sql()))
def test_panels_as_sql_join_without_shuffle(spark, tables, shuffle_joins_only, panel):
    dashboard.register_views({n: tables[n] for n in ("pfsense_log", "ip4")})
    plan = plan_of(spark.sql(dashboard.panel_sql()[panel]))
    assert shuffles(plan[plan.index("SortMergeJoin"):]) == 0


def test_top_lists_need_no_full_sort(spark, tables):
    plan = plan_of(describe.value_counts(tables["v4"], "source_ip", k=50))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert "v4:struct<source_ip:string>" in plan


def test_counts_are_combined_before_the_shuffle(spark, tables):
    plan = plan_of(describe.value_counts(tables["v4"], "source_ip", F.col("length") > 0))
    assert "partial_count(1)" in plan


def test_number_statistics_scan_the_log_once(spark, tables, monkeypatch):
    """What reads the log is the count of values, which is stored."""
    stored = []
    real = describe.store
    monkeypatch.setattr(describe, "store", lambda df, n: stored.append(plan_of(df)) or real(df, n))
    result = describe.describe_number(tables["v4"], "data_length")
    (plan,) = stored
    assert plan.count("FileScan") == 1 and shuffles(plan) == 1
    assert "partial_count(1)" in plan
    assert "FileScan" not in plan_of(result)


def test_ports_are_counted_in_one_scan(spark, tables):
    counts = plan_of(ports.port_counts(tables["v4"]))
    assert counts.count("FileScan") == 1 and shuffles(counts) == 1
    listed = plan_of(ports.all_notable_ports(tables["v4"]))
    assert "v4" not in listed  # only stored counts are read
    joined = plan_of(ports.with_port_counts(tables["v4"]))
    assert len(re.findall(r"FileScan.*v4", joined)) == 1


def test_minutes_of_rows_are_no_text(spark, tables):
    plan = plan_of(describe.peak_minute_sources(tables["v4"], 5))
    assert "date_format" not in plan


def test_lists_within_the_given_size_are_broadcast(spark, tables, shuffle_joins_only):
    geo = adapter.geo(spark, SMALL)
    plans = [
        plan_of(load.enrich_v4(tables["v4"], geo, **DETECTION, broadcast_bytes=size))
        for size in (1, 1 << 20)
    ]
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" in plans[1]


def test_declared_types_before_the_comparison(spark, tables):
    """Queries whose whole numbers are compared as doubles give whole numbers."""
    v4 = tables["v4"]
    kinds = dict(v4.dtypes)
    assert {kinds[c] for c in ("data_length", "length", "offset", "ip_version")} == {"int"}
    assert dict(detect.bandwidth_per_window(v4).dtypes)["count"] == "bigint"
    assert dict(detect.logs_per_window(v4).dtypes)["count"] == "bigint"
    counted = dict(ports.with_port_counts(v4).dtypes)
    assert counted["source_port_counted"] == counted["destination_port_counted"] == "bigint"
    panel = dashboard.dash_threat_bandwidth(tables["pfsense_log"], tables["ip4"])
    assert dict(panel.dtypes) == {"time": "int", "count": "bigint"}


def test_a_query_makes_only_what_it_reads(spark, monkeypatch):
    """Typed rows are there without the tables of the dashboard, and the tables without the
    typed rows; nothing is made twice."""
    calls = []
    for name in ("parse_and_store", "enrich_v4", "load"):
        def counted(*args, _name=name, _run=getattr(load, name), **options):
            calls.append(_name)
            return _run(*args, **options)

        monkeypatch.setattr(f"checks.queries.load.{name}", counted)
    monkeypatch.setattr("checks.queries._LOADED", {})
    queries()["describe_logs_per_minute"](spark, SMALL)
    assert calls == ["parse_and_store"]
    monkeypatch.setattr("checks.queries._LOADED", {})
    calls.clear()
    for _ in range(2):
        queries()["sql_dash_frequency_over_time"](spark, SMALL)
    # the load parses and enriches once, and it writes all three tables
    assert calls == ["load", "parse_and_store", "enrich_v4"]
    assert set(loaded(spark, SMALL)) == {"pfsense_log", "ip4", "ip6"}
    with pytest.raises(KeyError):
        loaded(spark, SMALL)["ip5"]


def test_lines_are_printed_after_the_rows_are_dealt_out(spark):
    """Single files are read by few tasks: nothing but reading happens there, and the rows
    are not sorted to be dealt."""
    plan = plan_of(adapter._lines(spark, SMALL))
    assert "RoundRobinPartitioning" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2  # both tables
    for below in re.split(r"Exchange hashpartitioning", plan)[1:]:
        assert "get_json_object" not in below
