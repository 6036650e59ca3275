import pytest
from pyspark.sql import functions as F

from emberwall.operators import detect, enrich

AT = "2020-09-07 11:45:{:02d}"


def flags(df, column):
    rows = df.select("source_ip", column).distinct().collect()
    return {r.source_ip: r[column] for r in rows}


def rows_in_minute(source, number, length=1):
    return [(source, AT.format(i % 60), length) for i in range(number)]


def test_bytes_threshold(traffic):
    df = traffic(
        [("a", AT.format(1), 98970), ("b", AT.format(1), 98970), ("b", AT.format(59), 1),
         ("c", AT.format(1), 98972)]
    )
    flagged = detect.flag_bandwidth(df)
    assert flags(flagged, "threat_type_bandwith") == {"a": "0", "b": "1", "c": "1"}


def test_rows_threshold(traffic):
    df = traffic(
        rows_in_minute("a", 116) + rows_in_minute("b", 117) + rows_in_minute("c", 118)
    )
    flagged = detect.flag_frequency(df)
    assert flags(flagged, "threat_type_frequency") == {"a": "0", "b": "1", "c": "1"}


def test_windows_do_not_add_up(traffic):
    df = traffic([("a", "2020-09-07 11:45:59", 60000), ("a", "2020-09-07 11:46:00", 60000)])
    assert flags(detect.flag_bandwidth(df), "threat_type_bandwith") == {"a": "0"}


def test_flag_covers_every_row_of_the_source(traffic):
    df = traffic(
        [("a", AT.format(1), 99999), ("a", "2020-12-01 00:00:00", 1), ("a", None, None)]
    )
    flagged = detect.flag_bandwidth(df)
    assert [r.threat_type_bandwith for r in flagged.collect()] == ["1"] * 3


def test_null_source_is_a_source(traffic):
    quiet = traffic([(None, AT.format(1), 1), ("a", AT.format(1), 99999)])
    assert flags(detect.flag_bandwidth(quiet), "threat_type_bandwith") == {
        None: "0", "a": "1",
    }
    loud = traffic([(None, AT.format(1), 99999), ("a", AT.format(1), 1)])
    assert flags(detect.flag_bandwidth(loud), "threat_type_bandwith") == {
        None: "1", "a": "0",
    }


def test_rows_without_time_are_in_no_window(traffic):
    df = traffic([("a", None, 99999)] + [("b", None, 1)] * 200)
    assert detect.bandwidth_per_window(df).count() == 0
    assert flags(detect.flag_both(df), "threat_type_bandwith") == {"a": "0", "b": "0"}
    assert flags(detect.flag_both(df), "threat_type_frequency") == {"a": "0", "b": "0"}


def test_rows_without_length(traffic):
    df = traffic([("a", AT.format(1), None)] * 117 + [("b", AT.format(1), -2)])
    flagged = detect.flag_both(df)
    assert flags(flagged, "threat_type_bandwith") == {"a": "0", "b": "0"}
    assert flags(flagged, "threat_type_frequency") == {"a": "1", "b": "0"}
    sums = {r.source_ip: r["count"] for r in detect.bandwidth_per_window(df).collect()}
    assert sums == {"a": None, "b": -2}


def test_both_equals_one_after_the_other(traffic):
    df = traffic(
        rows_in_minute("a", 120) + [("b", AT.format(3), 10**6), ("c", AT.format(3), 1)]
        + rows_in_minute(None, 130, 1000) + [("d", None, 10**6)]
    )
    both = detect.flag_both(df)
    single = detect.flag_frequency(detect.flag_bandwidth(df))
    assert both.columns == single.columns
    assert sorted(both.collect(), key=str) == sorted(single.collect(), key=str)


def test_source_profile(traffic):
    df = traffic(rows_in_minute("a", 117) + [("a", None, 5), (None, AT.format(1), 98971)])
    profile = {r.source_ip: tuple(r)[1:] for r in detect.source_profile(df).collect()}
    assert profile == {"a": (118, False, True), None: (1, True, False)}


def test_window_bounds(traffic):
    [row] = detect.logs_per_window(traffic([("a", AT.format(50), 1)]), "1 minute").collect()
    assert (str(row.window_start), str(row.window_end), row["count"]) == (
        "2020-09-07 11:45:00", "2020-09-07 11:46:00", 1,
    )


def test_hot_sources_are_distinct(traffic):
    df = traffic([("a", AT.format(1), 99999), ("a", "2020-12-01 00:00:00", 99999)])
    assert [r.source_ip for r in detect.hot_sources_bandwidth(df).collect()] == ["a"]


def test_calibration(traffic):
    df = traffic(
        [("a", AT.format(1), 10), ("b", AT.format(2), None),
         ("c", "2020-09-07 11:46:00", None), ("d", None, 1000)]
    )
    assert detect.calibrate_thresholds(df).first() == (5.0, 1.5)


@pytest.fixture
def geo(spark):
    rows = [("a", "AA", "ok"), ("b", "BB", "ok"), ("c", None, "timeout"), ("d", None, "error"),
            ("e", None, "ok")]
    return spark.createDataFrame(rows, "ip string, country_code string, status string")


def test_country_only_for_frequent_sources(traffic, geo):
    df = traffic(
        rows_in_minute("a", 100) + rows_in_minute("b", 99) + rows_in_minute("z", 101)
        + rows_in_minute(None, 200)
    )
    enriched = enrich.enrich_country(df, geo)
    assert enriched.count() == 500
    assert flags(enriched, "source_country_code") == {
        "a": "AA", "b": None, "z": None, None: None,
    }
    frequent = enrich.frequent_sources(df).collect()
    assert [tuple(r) for r in frequent] == [(None, 200), ("z", 101), ("a", 100)]


def test_failed_lookups(traffic, geo):
    df = traffic([(s, AT.format(1), 1) for s in "acdez"]).select("source_ip")
    found = {r.source_ip: tuple(r)[1:] for r in enrich.geo_lookup(df, geo).collect()}
    assert found == {
        "a": ("AA", "ok"), "c": (None, "timeout"), "d": (None, "error"),
        "e": (None, "ok"), "z": (None, "missing"),
    }
    coded = enrich.geo_lookup(df, geo, failure_codes=True)
    assert flags(coded, "source_country_code") == {
        "a": "AA", "c": "Timeout", "d": "404", "e": None, "z": None,
    }


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_marks_agree_whether_or_not_the_list_is_broadcast(spark, traffic, threshold):
    """A third of the rows have one source, another third none."""
    df = traffic(
        rows_in_minute("hot", 300) + rows_in_minute(None, 300)
        + [(f"s{i}", AT.format(i % 60), 1) for i in range(300)]
    )
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        counts = detect.flag_frequency(df).groupBy("threat_type_frequency").agg(
            F.count(F.lit(1))
        )
        assert {tuple(r) for r in counts.collect()} == {("1", 600), ("0", 300)}
    finally:
        spark.conf.set(name, before)
