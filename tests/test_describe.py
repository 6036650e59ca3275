import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emberwall.functions import port_class
from emberwall.operators import describe, enrich, ports, quantiles
from emberwall.operators.quantiles import exact_quantiles


def values(df, name="value"):
    return {r[0]: r[name] for r in df.collect()}


def quantiles_found(spark, numbers, probabilities):
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    return values(exact_quantiles(df, "x", probabilities))


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 100, 1001])
def test_quantiles_match_numpy(spark, size):
    rng = random.Random(size)
    numbers = [rng.choice([rng.gauss(0, 1e3), rng.randint(-5, 5), 0.0, 1e-300, -1e12]) * 1.0
               for _ in range(size)]
    wanted = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = quantiles_found(spark, numbers, wanted)
    for p in wanted:
        assert got[p] == pytest.approx(np.quantile(numbers, p), rel=1e-12, abs=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-(2**31), 2**31 - 1), min_size=1, max_size=40))
def test_quantiles_of_integers(spark, numbers):
    got = quantiles_found(spark, [float(n) for n in numbers], [0.25, 0.5, 0.75])
    for p, value in got.items():
        assert value == np.quantile(np.array(numbers, dtype=float), p)


def test_one_value_in_most_rows(spark):
    got = quantiles_found(spark, [7.0] * 500 + [1.0, 2.0, 900.0], [0.25, 0.5, 0.75])
    assert got == {0.25: 7.0, 0.5: 7.0, 0.75: 7.0}


def test_values_close_together(spark):
    """All values in one range; their steps tell them apart."""
    rng = random.Random(1)
    numbers = [1.7e9 + rng.random() for _ in range(3000)]
    wanted = [0.1, 0.25, 0.5, 0.75, 0.999]
    got = quantiles_found(spark, numbers, wanted)
    for p in wanted:
        assert got[p] == pytest.approx(np.quantile(numbers, p), rel=1e-15)


def test_nan_and_infinity(spark):
    got = quantiles_found(spark, [float("inf"), float("nan"), 1.0, -5.0, 0.0], [0.0, 0.5, 1.0])
    assert got == {0.0: -5.0, 0.5: 0.5, 1.0: float("inf")}


def test_describe_number(spark):
    numbers = [1, 2, 3, 4, -2, None]
    df = spark.createDataFrame([(n,) for n in numbers], "x int")
    got = values(describe.describe_number(df, "x"))
    present = np.array([n for n in numbers if n is not None], dtype=float)
    assert got == pytest.approx(
        {"count": 5, "mean": present.mean(), "std": present.std(ddof=1), "min": -2,
         "25%": np.quantile(present, 0.25), "50%": 2, "75%": 3, "max": 4}
    )


def test_nan_is_skipped_by_every_statistic(spark):
    numbers = [1.0, 2.0, float("nan"), None]
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    assert values(describe.describe_number(df, "x")) == pytest.approx(
        {"count": 2, "mean": 1.5, "std": 0.5**0.5, "min": 1, "25%": 1.25, "50%": 1.5,
         "75%": 1.75, "max": 2}
    )


def test_deviation_of_large_close_values(spark):
    numbers = [1.7e9 + i / 1000 for i in range(100)]
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    got = values(describe.describe_number(df, "x"))
    assert got["std"] == pytest.approx(np.std(numbers, ddof=1), rel=1e-9)


def test_no_step_holds_many_values(spark, monkeypatch):
    """A million values a hair's breadth apart and one far off: whatever is put in
    order is the counts of ranges or of 4096 steps, and few levels are needed."""
    levels = []
    real = quantiles._cells

    def watched(rows, keys, ranks):
        levels.append(rows.groupBy(*keys).count().count())
        return real(rows, keys, ranks)

    monkeypatch.setattr(quantiles, "_cells", watched)
    ids = F.col("id").cast("double")
    near = spark.range(1_000_000).select((1 + ids * 2.0**-50).alias("x"))
    df = near.union(spark.createDataFrame([(1.0108,)], "x double"))
    got = values(exact_quantiles(df, "x", [0.25, 0.5]))
    assert got == {0.25: 1 + 250_000 * 2.0**-50, 0.5: 1 + 500_000 * 2.0**-50}
    assert len(levels) <= 1 + quantiles.LEVELS
    assert max(levels) <= 2 * 2 * (quantiles.STEPS + 1)


def test_describe_number_without_values(spark):
    df = spark.createDataFrame([(None,)], "x int")
    got = values(describe.describe_number(df, "x"))
    assert got.pop("count") == 0
    assert set(got) == {"mean", "std", "min", "25%", "50%", "75%", "max"}
    assert set(got.values()) == {None}


def test_describe_text(spark):
    df = spark.createDataFrame([(c,) for c in ["b", "a", "b", "a", "c", None]], "x string")
    assert describe.describe_text(df, "x").first() == (5, 3, "a", 2)
    assert describe.describe_text(df.filter("x IS NULL"), "x").first() == (0, 0, None, None)


def test_describe_time(traffic):
    df = traffic([("a", t, 1) for t in
                  ["2020-09-07 11:45:50", "2020-12-07 09:22:02", "2020-09-07 11:45:50", None]])
    row = describe.describe_time(df).first()
    assert (row["count"], row.unique, row.freq) == (3, 2, 2)
    assert [str(t) for t in (row.top, row.first, row.last)] == [
        "2020-09-07 11:45:50", "2020-09-07 11:45:50", "2020-12-07 09:22:02",
    ]


def test_value_counts(spark):
    df = spark.createDataFrame(
        [("b", 1), ("a", 1), ("b", 2), ("c", 2), (None, 1)], "x string, y int"
    )
    assert describe.value_counts(df, "x").collect() == [("b", 2), ("a", 1), ("c", 1)]
    assert describe.value_counts(df, "x", k=2).collect() == [("b", 2), ("a", 1)]
    assert describe.value_counts(df, "x", F.col("y") == 2).collect() == [("b", 1), ("c", 1)]


def test_minutes(traffic):
    df = traffic(
        [("a", "2020-10-11 22:26:01", 5), ("a", "2021-10-11 22:26:59", None),
         ("b", "2020-10-11 22:27:00", None), ("c", None, 100)]
    )
    assert describe.logs_per_minute(df).collect() == [("10-11 22:26", 2), ("10-11 22:27", 1)]
    assert values(describe.bytes_per_minute(df), "bytes") == {
        "10-11 22:26": 5, "10-11 22:27": 0,
    }
    assert describe.bytes_per_minute(df, 1).collect() == [("10-11 22:26", 5)]
    assert describe.minute_sources(df, ["10-11 22:26", "10-11 22:27"]).collect() == [
        ("a", 2), ("b", 1),
    ]
    assert describe.peak_minute_sources(df, 1).collect() == [("a", 2)]


def test_column_max_and_frame_info(spark):
    df = spark.createDataFrame([("a", 3, None), ("b", None, None)], "x string, y int, z int")
    assert describe.column_max(df).first() == ("b", 3, None)
    assert describe.frame_info(df).collect() == [
        ("x", "string", 2), ("y", "int", 1), ("z", "int", 0),
    ]


@pytest.mark.parametrize(
    "port, expected",
    [
        ("0", "0"), (None, "0"), ("", "0"), ("1", "standard-port"), ("1023", "standard-port"),
        ("1024", "registered-port"), ("49151", "registered-port"), ("49152", "private-port"),
        ("65535", "private-port"), ("request", "0"), ("nan", "0"), ("-1", "0"),
    ],
)
def test_port_class(spark, port, expected):
    df = spark.createDataFrame([(port,)], "p string")
    assert df.select(port_class(F.col("p"))).first()[0] == expected


@pytest.fixture
def port_rows(spark):
    rows = [(0, "22", "80"), (1, "request", "80"), (2, None, "abc"), (3, "12d", "x"),
            (4, "1e3", " 80 "), (5, "inf", ".5"), (6, None, None)]
    return spark.createDataFrame(
        rows, "id long, source_port string, destination_port string"
    )


def test_numeric_and_rejected_ports(port_rows):
    assert [r.id for r in ports.numeric_ports(port_rows).collect()] == [0, 4, 5, 6]
    assert ports.rejected_ports(port_rows).collect() == [
        (1, "source_port", "request"), (2, "destination_port", "abc"), (3, "source_port", "12d"),
    ]


def test_port_counts_outside_the_top_are_null(port_rows):
    top = ports.with_port_counts(port_rows, k=1).orderBy("id").collect()
    assert [r.destination_port_counted for r in top] == [2, 2, None, None, None, None, None]
    every = ports.with_port_counts(port_rows, k=None).orderBy("id").collect()
    assert [r.source_port_counted for r in every] == [1, 1, None, 1, 1, 1, None]


def test_notable_ports(spark):
    rows = [("22", "443")] * 11 + [("80", "23")] * 10 + [("61337", "8080")] * 101
    rows += [("50000", "60001")] * 100 + [("request", "60001")] * 5
    df = spark.createDataFrame(rows, "source_port string, destination_port string")
    expected = {
        ("source_port", "standard-port", "22", 11.0),
        ("destination_port", "standard-port", "443", 11.0),
        ("source_port", "private-port", "61337", 101.0),
        ("destination_port", "private-port", "60001", 105.0),
        ("destination_port", "registered-port", "8080", 101.0),
    }
    found = ports.all_notable_ports(df).collect()
    assert {tuple(r) for r in found} == expected
    single = [
        tuple(r)
        for side, kind, above in ports.NOTABLE
        for r in ports.notable_ports(df, side, kind, above).collect()
    ]
    assert set(single) == expected and len(single) == len(expected)


@pytest.fixture
def names(spark):
    return spark.createDataFrame(
        [(22, "ssh"), (443, "https"), (443, "quic")], "port int, name string"
    )


def test_port_names(spark, names):
    df = spark.createDataFrame(
        [("22", "443"), ("request", "1"), (None, None)],
        "source_port string, destination_port string",
    )
    both = enrich.add_port_names(df, names)
    assert both.columns == [
        "source_port", "destination_port", "port", "name", "port_destination_name",
        "name_destination_name",
    ]
    assert {tuple(r) for r in both.collect()} == {
        ("22", "443", "22", "ssh", "443", "https"), ("22", "443", "22", "ssh", "443", "quic"),
        ("request", "1", None, None, None, None), (None, None, None, None, None, None),
    }


def test_names_that_clash_with_the_log(spark, names):
    df = spark.createDataFrame([("22", "x")], "source_port string, name string")
    joined = enrich.add_source_port_names(df, names)
    assert joined.columns == ["source_port", "name", "port", "name_source_name"]
    assert joined.first() == ("22", "x", "22", "ssh")


def test_blocklist(spark, traffic):
    listed = spark.createDataFrame(
        [("a", "one"), ("a", "two"), ("b", "two"), ("b", "two")], "ip string, list_name string"
    )
    df = traffic([(s, None, 1) for s in ["a", "b", "c", None]])
    flagged = enrich.flag_blocklist(df, listed, ["one", "two"])
    assert {tuple(r)[1:2] + tuple(r)[4:] for r in flagged.collect()} == {
        ("a", True, True, True), ("b", True, False, True),
        ("c", False, False, False), (None, False, False, False),
    }
    assert sorted(r.source_ip for r in enrich.blocklist_hits(df, listed).collect()) == ["a", "b"]


def test_json_field(spark):
    df = spark.createDataFrame(
        [('{"country_code": "DE"}',), ("{}",), ("no json",), (None,)], "payload string"
    )
    found = enrich.json_field(df, "payload", "country_code")
    assert [r.country_code for r in found.collect()] == ["DE", "0", "0", "0"]
    odd = spark.createDataFrame([('{"a`b": "x", "c.d": "y"}',)], "payload string")
    assert enrich.json_field(odd, "payload", ["a`b", "c.d"]).first()[1:] == ("x", "y")
    found = enrich.json_field(df, "payload", "country_code", default=None)
    assert [r.country_code for r in found.collect()] == ["DE", None, None, None]


def test_metadata_of_the_top_sources(spark, traffic):
    columns = "ip string, " + ", ".join(f"{c} string" for c in enrich.METADATA_COLUMNS)
    known = spark.createDataFrame([("a", "org", None, "DE", *[None] * 5)], columns)
    df = traffic([("a", None, 1)] * 2 + [("b", None, 1)] * 3 + [("c", None, 1), (None, None, 1)])
    top = enrich.top_sources_metadata(df, known, k=2)
    assert {tuple(r) for r in top.collect()} == {
        ("a", 2, "org", "0", "DE", "0", "0", "0", "0", "0"),
        ("b", 3, "0", "0", "0", "0", "0", "0", "0", "0"),
    }


def test_repeated_lookup_rows_double_nothing(spark, traffic):
    geo = spark.createDataFrame(
        [("a", "FR", "ok"), ("a", "DE", "ok"), ("a", "AA", "error"), ("b", None, "timeout"),
         ("b", None, "timeout"), ("c", None, "ok"), ("c", "IT", "ok")],
        "ip string, country_code string, status string",
    )
    df = traffic([("a", None, 1)] * 3 + [("b", None, 1), ("c", None, 1), (None, None, 1)])
    got = enrich.enrich_country(df, geo, min_rows=1)
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in df.collect())
    assert {(r.source_ip, r.source_country_code) for r in got.collect()} == {
        ("a", "DE"), ("b", None), ("c", "IT"), (None, None),
    }
    columns = "ip string, " + ", ".join(f"{c} string" for c in enrich.METADATA_COLUMNS)
    known = [("a", org, *[None] * 7) for org in ("two", "one", "one")]
    top = enrich.top_sources_metadata(df, spark.createDataFrame(known, columns), k=2)
    assert [(r.ip, r.frequency, r.org) for r in top.orderBy("ip").collect()] == [
        ("a", 3, "one"), ("b", 1, "0"),
    ]


def test_minutes_that_are_no_key_match_nothing(traffic):
    df = traffic([("a", "2020-10-11 22:26:01", 5)])
    assert describe.minute_sources(df, []).count() == 0
    assert describe.minute_sources(df, ["nonsense"]).count() == 0
