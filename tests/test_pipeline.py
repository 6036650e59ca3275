"""From lines to tables to dashboard answers, on a hand-written log."""

from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from support import HOST
from pyspark.sql import functions as F

from emberwall.operators import tables
from emberwall.plans import dashboard, load
from emberwall.session import shared_folder
from emberwall.sinks import write_bucketed

GEO = [("192.0.2.1", "DE", "ok"), ("192.0.2.2", None, "timeout")]


def v4(time, source, length, direction="in"):
    return (
        f"{time} {HOST} filterlog: 5,,,1,em0,match,block,{direction},4,0x0,,64,1,0,DF,6,tcp,60,"
        f"{source},198.51.100.5,1,443,{length},S,1,,1024,,mss"
    )


def v6(time):
    return f"{time} {HOST} filterlog: 7,,,2,em0,match,block,in,6,,0x1,1,UDP,17,48,fd00::1,ff02::2"


LINES = (
    # 192.0.2.1: two rows in a minute, 300 bytes; 192.0.2.2: one long row; .3: quiet
    [v4("Sep  7 11:45:50", "192.0.2.1", 100), v4("Sep  7 11:45:51", "192.0.2.1", 200)]
    + [v4("Sep  8 00:00:00", "192.0.2.1", "")]
    + [v4("Sep  7 11:45:50", "192.0.2.2", 5000), v4("Sep  7 11:47:00", "192.0.2.2", 1)]
    + [v4("Sep  9 00:00:00", "192.0.2.3", 10)]
    + [v6("Sep  7 11:45:50"), v6("Sep 10 00:00:00")]
    + [f"Sep  7 11:45:50 {HOST} sshd[1]: noise"]
)
OPTIONS = {"min_bytes": 5000, "min_rows": 2, "geo_min_rows": 2}


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Tables loaded from a text file and read back."""
    folder = tmp_path_factory.mktemp("load")
    (folder / "log.txt").write_text("\n".join(LINES) + "\n")
    geo = spark.createDataFrame(GEO, "ip string, country_code string, status string")
    names = ["pfsense_log", "ip4", "ip6"]
    targets = {name: str(folder / name) for name in names}
    lines = spark.read.text(str(folder / "log.txt"))
    load.load(lines, HOST, geo, targets, **OPTIONS)
    return {name: spark.read.parquet(path) for name, path in targets.items()}


def test_columns(made):
    assert made["pfsense_log"].columns == [
        "id", "timestamp", "rule_number", "tracker_id", "real_interface", "reason", "action",
        "traffic_direction", "ip_version",
    ]
    assert made["ip4"].columns == [
        "id", "ecn", "ttl", "ipv4_id", "offset", "flags", "protocoll_id", "protocoll_text",
        "length", "source_ip", "destination_ip", "source_port", "destination_port",
        "data_length", "tcp_flag", "sequence_num", "ack", "window", "options",
        "threat_type_bandwith", "threat_type_frequency", "source_country_code",
    ]
    assert made["ip6"].columns == [
        "id", "flow_label", "hop_limit", "protocol", "protocol_id", "length", "source_ip",
        "destination_ip",
    ]


def test_ids_agree(made):
    ids = {name: [r.id for r in df.select("id").collect()] for name, df in made.items()}
    assert len(set(ids["pfsense_log"])) == 8
    assert sorted(ids["ip4"] + ids["ip6"]) == sorted(ids["pfsense_log"])
    joined = tables.join_log_ip4(made["pfsense_log"], made["ip4"])
    assert joined.filter("ip_version <> 4").count() == 0 and joined.count() == 6


def test_flags_and_country(made):
    found = made["ip4"].select(
        "source_ip", "threat_type_bandwith", "threat_type_frequency", "source_country_code"
    )
    assert Counter(map(tuple, found.collect())) == {
        ("192.0.2.1", "0", "1", "DE"): 3,
        ("192.0.2.2", "1", "0", None): 2,
        ("192.0.2.3", "0", "0", None): 1,
    }


def test_log_is_ordered_by_time(spark, made):
    files = made["pfsense_log"].select("timestamp", F.input_file_name().alias("f")).collect()
    times = [r.timestamp for r in sorted(files, key=lambda r: r.f)]
    assert times == sorted(times)


def test_boundary_column_can_be_kept(spark):
    geo = spark.createDataFrame(GEO, "ip string, country_code string, status string")
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    kept = load.build_tables(lines, HOST, geo, keep_boundary=True, **OPTIONS)
    assert kept["ip4"].columns[:2] == ["id", "tos"]
    assert kept["ip6"].columns[:2] == ["id", "class"]


def day(text):
    return datetime.fromisoformat(f"2020-{text}")


PANELS = {
    "dash_threat_bandwidth": {(2020, 2)},
    "dash_threat_frequency": {(2020, 3)},
    # the row without a length is not counted, but its time is there
    "dash_country": {
        (day("09-07 11:45:50"), "DE", 1), (day("09-07 11:45:51"), "DE", 1),
        (day("09-08 00:00:00"), "DE", 0),
    },
    "dash_bandwidth_over_time": {(day("09-07 11:45:50"), 1), (day("09-07 11:47:00"), 1)},
    "dash_frequency_over_time": {
        (day("09-07 11:45:50"), 1), (day("09-07 11:45:51"), 1), (day("09-08 00:00:00"), 1),
    },
    "dash_logs_over_time": {
        (day("09-07 11:45:50"), 2), (day("09-07 11:45:51"), 1), (day("09-07 11:47:00"), 1),
        (day("09-08 00:00:00"), 1), (day("09-09 00:00:00"), 1),
    },
}


@pytest.mark.parametrize("panel", PANELS)
def test_dashboard(made, panel):
    result = getattr(dashboard, panel)(made["pfsense_log"], made["ip4"])
    assert {tuple(r) for r in result.collect()} == PANELS[panel]


def test_time_range_includes_its_bounds(made):
    bounds = (day("09-07 11:45:51"), day("09-08 00:00:00"))
    result = dashboard.dash_logs_over_time(made["pfsense_log"], made["ip4"], bounds)
    assert [r.time for r in result.orderBy("time").collect()] == [
        day("09-07 11:45:51"), day("09-07 11:47:00"), day("09-08 00:00:00"),
    ]


def test_panel_reducers(made):
    country = dashboard.dash_country(made["pfsense_log"], made["ip4"])
    assert dashboard.panel_total(country).collect() == [("DE", 2)]
    assert dashboard.panel_mean(country).first()[0] == pytest.approx(2 / 3)


def test_sql_over_views_gives_the_same(spark, made):
    dashboard.register_views(made)
    result = spark.sql(
        "SELECT l.timestamp AS time, count(i.source_ip) AS value FROM pfsense_log l "
        "JOIN ip4 i ON i.id = l.id GROUP BY l.timestamp"
    )
    assert {tuple(r) for r in result.collect()} == PANELS["dash_logs_over_time"]


def test_bucketed_tables_answer_the_same(spark, made, tmp_path):
    log, ip4 = (
        write_bucketed(made[name], f"bucketed_{name}", 4, str(tmp_path / name))
        for name in ("pfsense_log", "ip4")
    )
    for panel, expected in PANELS.items():
        result = getattr(dashboard, panel)(log, ip4)
        assert {tuple(r) for r in result.collect()} == expected


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    """Tables loaded in the layout of the panels, with a lookup that repeats rows."""
    folder = tmp_path_factory.mktemp("laid")
    geo = spark.createDataFrame(GEO * 3, "ip string, country_code string, status string")
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    targets = {name: str(folder / name) for name in ("pfsense_log", "ip4", "ip6")}
    names = {name: f"laid_out_{name}" for name in targets}
    before = set(Path(shared_folder(spark).removeprefix("file:")).glob("emberwall/*"))
    load.load(
        lines, HOST, geo, targets, "dashboard", buckets=3, table_names=names, **OPTIONS
    )
    after = set(Path(shared_folder(spark).removeprefix("file:")).glob("emberwall/*"))
    return {name: spark.table(table) for name, table in names.items()}, after - before


def test_load_lays_tables_out_for_the_panels(laid_out):
    made, _ = laid_out
    for panel, expected in PANELS.items():
        result = getattr(dashboard, panel)(made["pfsense_log"], made["ip4"])
        assert {tuple(r) for r in result.collect()} == expected
    bounds = (day("09-07 11:45:51"), day("09-08 00:00:00"))
    result = dashboard.dash_logs_over_time(made["pfsense_log"], made["ip4"], bounds)
    assert [r.time for r in result.orderBy("time").collect()] == [
        day("09-07 11:45:51"), day("09-07 11:47:00"), day("09-08 00:00:00"),
    ]


@pytest.mark.parametrize("panel", PANELS)
def test_panels_as_sql(spark, laid_out, panel):
    made, _ = laid_out
    dashboard.register_views(made)
    result = spark.sql(dashboard.panel_sql()[panel])
    assert {tuple(r) for r in result.collect()} == PANELS[panel]


def test_repeated_lookup_rows_repeat_no_id(laid_out):
    made, _ = laid_out
    ids = [r.id for r in made["ip4"].select("id").collect()]
    assert len(ids) == len(set(ids)) == 6


def test_load_removes_what_it_stored(laid_out):
    assert laid_out[1] == set()


def test_only_sources_with_a_flag_or_country_are_listed(spark, monkeypatch):
    geo = spark.createDataFrame(GEO, "ip string, country_code string, status string")
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    stored = {}
    real = load.store_sized
    monkeypatch.setattr(load, "store_sized", lambda df, n: stored.setdefault(n, real(df, n)))
    load.build_tables(lines, HOST, geo, **OPTIONS)
    rows = stored["sources"][0].collect()
    assert sorted(r._source for r in rows) == ["192.0.2.1", "192.0.2.2"]
    assert all(r.hot_bytes or r.hot_rows or r.source_country_code for r in rows)
