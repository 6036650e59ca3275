from datetime import datetime

import pytest
from support import HOST
from pyspark.sql import functions as F

from emberwall import schema
from emberwall.operators import parse
from emberwall.sources import read_log

START = f"Sep  7 11:45:50 {HOST} filterlog: 5"
TCP = (
    f"{START},,,100001,em0,match,block,in,4,0x0,,64,4660,0,DF,6,tcp,60,192.0.2.10,"
    "198.51.100.5,61337,443,0,S,1,,1024,,mss;nop;wscale"
)
UDP = (
    f"Sep 17 11:45:50 {HOST} filterlog: 5,,,100001,em0,match,block,in,4,0x0,,64,1,0,none,17,"
    "udp,40,192.0.2.11,198.51.100.5,3478,3478,20"
)
V6 = (
    f"Sep  7 11:45:51 {HOST} filterlog: 7,,,100002,em0,match,block,in,6,0x00,0x12345,1,UDP,"
    "17,48,2001:db8::1,ff02::2"
)


def v4_rows(df, **options):
    return parse.parse_v4(parse.extract(df, HOST), HOST, **options).collect()


def v6_rows(df, **options):
    return parse.parse_v6(parse.extract(df, HOST), HOST, **options).collect()


def test_v4_line(lines):
    [row] = v4_rows(lines(TCP))
    assert row.asDict() == {
        "id": 0, "timestamp": datetime(2020, 9, 7, 11, 45, 50), "rule_number": "5",
        "tracker_id": "100001", "real_interface": "em0", "reason": "match",
        "action": "block", "traffic_direction": "in", "ip_version": 4, "tos": "0x0",
        "ecn": "", "ttl": "64", "ipv4_id": "4660", "offset": 0, "flags": "DF",
        "protocoll_id": "6", "protocoll_text": "tcp", "length": 60,
        "source_ip": "192.0.2.10", "destination_ip": "198.51.100.5",
        "source_port": "61337", "destination_port": "443", "data_length": 0,
        "tcp_flag": "S", "sequence_num": "1", "ack": "", "window": "1024",
        "options": "[mss, nop, wscale]",
    }


def test_column_lists():
    assert schema.V4_COLUMNS[:9] == schema.LOG_COLUMNS
    assert (len(schema.V4_COLUMNS), len(schema.V6_COLUMNS)) == (28, 17)
    assert len(schema.ENRICHED_COLUMNS) == 31


def test_short_v4_line_gives_nulls(lines):
    [row] = v4_rows(lines(UDP))
    assert (row.source_port, row.data_length, row.timestamp.day) == ("3478", 20, 17)
    assert (row.tcp_flag, row.window, row.options) == (None, None, None)


def test_v6_line(lines):
    [row] = v6_rows(lines(V6))
    assert row.timestamp == datetime(2020, 9, 7, 11, 45, 51)
    assert (row.ip_version, row["class"], row.flow_label) == (6, "0x00", "0x12345")
    assert (row.hop_limit, row.protocol, row.protocol_id, row.length) == (1, "UDP", "17", 48)
    assert (row.source_ip, row.destination_ip) == ("2001:db8::1", "ff02::2")


def test_blanks_stay_in_v4_and_go_in_v6(lines):
    blank_v6 = V6.replace("0x12345", "")
    assert v6_rows(lines(blank_v6))[0].flow_label is None
    assert v6_rows(lines(blank_v6), blank_as_null=False)[0].flow_label == ""
    assert v4_rows(lines(TCP))[0].ecn == ""
    assert v4_rows(lines(TCP), blank_as_null=True)[0].ecn is None


@pytest.mark.parametrize(
    "field, as_list, as_text",
    [
        ("mss;nop;wscale", ["mss", "nop", "wscale"], "[mss, nop, wscale]"),
        ("mss", ["mss"], "[mss]"),
        ("mss;", ["mss", ""], "[mss, ]"),
        ("", [""], "[]"),
    ],
)
def test_options(lines, field, as_list, as_text):
    df = lines(TCP.replace("mss;nop;wscale", field))
    assert v4_rows(df, options_as_text=False)[0].options == as_list
    assert v4_rows(df)[0].options == as_text
    cast = parse.split_options(parse.parse_fields(df, schema.V4_FIELDS))
    assert cast.select(F.col("options").cast("string")).first()[0] == as_text


def test_only_lines_of_the_filter_of_the_host(lines):
    df = lines(
        TCP,
        f"Sep  7 11:45:52 {HOST} sshd[99]: noise",
        TCP.replace(HOST, "gw-example"),
        TCP.replace(HOST, "other.example"),
        "",
    )
    assert [r.id for r in parse.filter_log_lines(df, HOST).collect()] == [0]


def test_process_number_in_header(lines):
    [row] = v4_rows(lines(TCP.replace("filterlog:", "filterlog[123]:")))
    assert (row.timestamp, row.rule_number) == (datetime(2020, 9, 7, 11, 45, 50), "5")


def test_other_header_has_no_time_and_no_rule(lines):
    [row] = v4_rows(lines(TCP.replace("filterlog: 5", "filterlog 5")))
    assert (row.timestamp, row.rule_number, row.source_ip) == (None, None, "192.0.2.10")


def test_versions(lines):
    short = ",".join(TCP.split(",")[:8])
    df = lines(TCP, V6, TCP.replace(",4,0x0", ",x,0x0"), short, TCP.replace(",4,0x0", ",,0x0"))
    extracted = parse.extract(df, HOST)
    assert [r.ip_version for r in extracted.orderBy("id").collect()] == [
        "4", "6", "x", None, "",
    ]
    assert [r.id for r in parse.by_ip_version(extracted, 4).collect()] == [0]
    assert [r.id for r in parse.by_ip_version(extracted, 6).collect()] == [1]


def test_both_versions_in_one_pass(lines):
    bad = TCP.replace(",4,0x0", ",x,0x0")
    blank = V6.replace("em0", "")
    extracted = parse.extract(lines(TCP, blank, UDP, bad, f"{START},short"), HOST)
    parsed = parse.parse_versions(extracted, HOST, 2020)
    v4 = parse.parse_v4(parse.by_ip_version(extracted, 4), HOST, 2020)
    v6 = parse.parse_v6(parse.by_ip_version(extracted, 6), HOST, 2020)
    assert parse.rows_of(parsed, 4).dtypes == v4.dtypes
    assert parse.rows_of(parsed, 4).collect() == v4.collect()
    assert parse.rows_of(parsed, 6).dtypes == v6.dtypes
    assert parse.rows_of(parsed, 6).collect() == v6.collect()
    assert parse.log_of(parsed).collect() == [
        row[:9] for row in v4.collect()[:1] + v6.collect() + v4.collect()[1:]
    ]


def test_surplus_fields_are_ignored(lines):
    df = lines(TCP + ",extra,more,fields")
    [row] = parse.parse_fields(df, schema.V4_FIELDS).collect()
    assert (row.options, row.extra) == ("mss;nop;wscale", "extra")


@pytest.mark.parametrize(
    "text, year, expected",
    [
        ("Sep 7 11:45:50", 2020, datetime(2020, 9, 7, 11, 45, 50)),
        ("Dec 31 23:59:59", 2021, datetime(2021, 12, 31, 23, 59, 59)),
        ("Feb 29 00:00:01", 2020, datetime(2020, 2, 29, 0, 0, 1)),
        ("Feb 29 00:00:01", 2021, None),
        ("Foo 99 00:00:00", 2020, None),
        ("", 2020, None),
        (None, 2020, None),
    ],
)
def test_timestamp(spark, text, year, expected):
    df = spark.createDataFrame([(text,)], "timestamp string")
    assert parse.parse_timestamp(df, year).first()[0] == expected


def test_bad_time_keeps_the_row(lines):
    [row] = v4_rows(lines(TCP.replace("Sep  7", "Foo 99")))
    assert (row.timestamp, row.rule_number) == (None, "5")


@pytest.mark.parametrize("text, value", [("abc", None), ("", None), ("-2", -2), ("7", 7)])
def test_length_that_is_no_number(lines, text, value):
    fields = TCP.split(",")
    fields[22] = text
    assert v4_rows(lines(",".join(fields)))[0].data_length == value


def test_cast_columns_leaves_the_others(spark):
    df = spark.createDataFrame([("1", "2.5", "x")], "a string, b string, c string")
    typed = parse.cast_columns(df, {"a": "int", "b": "double", "nowhere": "int"})
    assert typed.dtypes == [("a", "int"), ("b", "double"), ("c", "string")]
    assert typed.first() == (1, 2.5, "x")


def test_blank_and_whitespace(spark):
    df = spark.createDataFrame([("", " ", "\t ", "x ", None)], "a string, b string, c string, d string, e string")
    assert parse.blanks_to_null(df).first() == (None, " ", "\t ", "x ", None)
    assert parse.clean_whitespace(df).first() == (None, None, None, "x ", None)


def test_drop_null_columns(spark):
    df = spark.createDataFrame(
        [(1, None, "x", None), (2, None, None, 3.0)], "a int, b string, c string, d double"
    )
    assert parse.drop_null_columns(df).columns == ["a", "c", "d"]


def test_sample_comes_before_the_filter(spark, tmp_path):
    path = tmp_path / "log.txt"
    path.write_text("\n".join([f"noise {i}" for i in range(5)] + [TCP]) + "\n")
    assert read_log(spark, str(path)).count() == 6
    sample = read_log(spark, str(path), sample=5)
    assert sample.count() == 5
    assert parse.extract(sample, HOST).count() == 0
    assert parse.extract(read_log(spark, str(path)), HOST).count() == 1


def test_ids_are_unique_over_partitions(spark, lines):
    df = lines(*[TCP] * 100).drop("id").repartition(7)
    ids = [r.id for r in parse.extract(df, HOST).collect()]
    assert len(set(ids)) == 100
