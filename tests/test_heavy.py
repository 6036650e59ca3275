"""Lists that are exact without moving all values, and blocks of addresses."""

import ipaddress
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from support import plan_of

from emberwall.operators import detect, enrich, heavy
from emberwall.operators.describe import value_counts


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, source_ip string")


def skewed(seed=1):
    """A few sources own most rows, thousands come once, some counts tie."""
    rng = random.Random(seed)
    values = ["hot"] * 3000 + [f"big{i}" for i in range(8) for _ in range(200 + i // 2)]
    values += [f"spoofed{rng.random()}" for _ in range(4000)] + [None] * 500
    rng.shuffle(values)
    return values


@pytest.mark.parametrize("buckets", [1, 7, 64, 4096])
@pytest.mark.parametrize("k", [1, 5, 9, 50])
def test_top_values_are_exact(spark, k, buckets):
    df = frame(spark, skewed())
    expected = value_counts(df, "source_ip", k=k).collect()
    assert heavy.top_values(df, "source_ip", k, buckets=buckets).collect() == expected


def test_top_values_where_all_are_alike(spark):
    df = frame(spark, [f"v{i % 300}" for i in range(900)])
    assert heavy.top_values(df, "source_ip", 10, buckets=50).collect() == value_counts(
        df, "source_ip", k=10
    ).collect()
    few = frame(spark, ["a", "b", "a", None])
    assert [tuple(r) for r in heavy.top_values(few, "source_ip", 10).collect()] == [("a", 2), ("b", 1)]
    assert heavy.top_values(few, "source_ip", 3, where=F.lit(False)).collect() == []


def test_few_values_move_for_the_list(spark):
    """What the last count shuffles: values of buckets that can hold one of the list."""
    df = frame(spark, skewed())
    kept = []
    plain = heavy._counted

    def counted(bucketed, chosen, column):
        kept.append(bucketed.join(chosen, "_bucket", "left_semi").select(column).distinct().count())
        return plain(bucketed, chosen, column)

    heavy._counted = counted
    try:
        heavy.top_values(df, "source_ip", 9, buckets=1024).collect()
    finally:
        heavy._counted = plain
    assert kept[-1] < 9 * 20 < df.select("source_ip").distinct().count() / 20


def test_a_bitmap_never_misses(spark):
    df = frame(spark, skewed())
    listed = df.filter("source_ip LIKE 'big%' OR source_ip IS NULL")
    for bits in (64, 4096, heavy.BITS):
        bitmap = heavy.bitmap_of(listed, "source_ip", bits)
        assert bitmap.count() <= bits // 64
        marked = heavy.may_hold(df, "source_ip", bitmap, "may", bits)
        assert marked.count() == df.count()
        assert marked.filter("(source_ip LIKE 'big%' OR source_ip IS NULL) AND NOT may").count() == 0
    others = marked.filter("source_ip LIKE 'spoofed%' AND may").count()
    assert others <= 2  # with so many bits


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_join_with_a_long_list(spark, bits):
    df = frame(spark, [*skewed(), "", "big1 "])
    listed = spark.createDataFrame(
        [(f"big{i}", i, None) for i in range(0, 20, 2)] + [(None, 99, "null"), ("", 98, "empty")],
        "ip string, mark int, note string",
    )
    got = heavy.join_long_list(df, "source_ip", listed, "ip", bits)
    plain = df.join(listed, df["source_ip"].eqNullSafe(listed["ip"]), "left").drop("ip")
    assert got.columns == plain.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))
    with pytest.raises(ValueError):
        heavy.join_long_list(df, "source_ip", listed.withColumnRenamed("mark", "id"), "ip")


@pytest.fixture
def shuffle_joins_only(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_rows_that_cannot_match_are_not_shuffled(spark, shuffle_joins_only):
    df = frame(spark, skewed())
    hot = spark.createDataFrame([(f"big{i}",) for i in range(8)], "source_ip string")
    marked = detect.mark_sources(df, hot, "flag", long_list=True)
    plan = plan_of(marked)
    # the bitmap is broadcast, the list is not
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert "Python" not in plan and "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    shuffled = plan.split("SortMergeJoin")[1].split("Union")[0]
    assert "Filter" in shuffled and "Exchange" in shuffled
    expected = detect.mark_sources(df, hot, "flag")
    assert Counter(map(tuple, marked.collect())) == Counter(map(tuple, expected.collect()))


def test_block_list_with_a_bitmap(spark):
    df = frame(spark, skewed())
    lists = spark.createDataFrame(
        [("hot", "a"), ("big3", "a"), ("big3", "b"), (None, "a"), ("none", "b")], "ip string, list_name string"
    )
    for names in ((), ("a", "b")):
        one, other = (
            enrich.flag_blocklist(df, lists, names, long_list=long).collect() for long in (True, False)
        )
        assert Counter(map(tuple, one)) == Counter(map(tuple, other))


def test_metadata_of_top_sources_among_many(spark):
    df = frame(spark, skewed())
    columns = "ip string, " + ", ".join(f"{c} string" for c in enrich.METADATA_COLUMNS)
    known = spark.createDataFrame([("hot", *["x"] * 8), ("big2", *[None] * 8)], columns)
    one, other = (
        enrich.top_sources_metadata(df, known, 9, many_sources=many).collect() for many in (True, False)
    )
    assert Counter(map(tuple, one)) == Counter(map(tuple, other)) and len(one) == 9


# --- blocks of addresses ----------------------------------------------------------


def test_ip_numbers(spark):
    rng = random.Random(2)
    valid = [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(50)] + ["0.0.0.0", "255.255.255.255"]
    bad = ["", "1.2.3", "1.2.3.4.5", "256.1.1.1", "01.2.3.4", " 1.2.3.4", "a.b.c.d", "::1", "1.2.3.-4", None]
    df = spark.createDataFrame([(x,) for x in valid + bad], "ip string")
    got = {r.ip: r.n for r in df.select("ip", enrich.ip_number(F.col("ip")).alias("n")).collect()}
    assert got == {x: int(ipaddress.IPv4Address(x)) for x in valid} | dict.fromkeys(bad)


def test_longest_block_wins(spark):
    rng = random.Random(4)
    blocks = []
    for i in range(120):
        length = rng.choice([0, 1, 8, 15, 16, 24, 27, 31, 32] if i < 118 else [0])
        number = (10 << 24 | rng.getrandbits(11) << 4) if rng.random() < 0.8 else rng.getrandbits(32)
        blocks.append((f"{ipaddress.IPv4Address(number)}/{length}", f"C{i % 9}" if i % 7 else None))
    blocks += [blocks[3], (blocks[5][0], "A"), (None, "Z"), ("10.0.0.0", "Z"), ("10.0.0.0/33", "Z"), ("x/8", "Z"), ("::/0", "Z")]
    sources = [str(ipaddress.IPv4Address(10 << 24 | rng.getrandbits(15))) for _ in range(300)]
    sources += [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(50)] + [None, "::1", "x"] + sources[:5]
    df = frame(spark, sources).withColumn("length", F.lit("own"))
    got = enrich.geo_by_block(df, spark.createDataFrame(blocks, "cidr string, country_code string"))
    assert got.columns == [*df.columns, "source_country_code", "geo_block_length"]
    nets = {}
    for cidr, code in blocks[:-5]:
        net = ipaddress.IPv4Network(cidr, strict=False)
        nets.setdefault(net, set()).add(code)
    rows = got.collect()
    assert len(rows) == len(sources)
    for row in rows:
        try:
            address = ipaddress.IPv4Address(row.source_ip)
        except ValueError:
            address = None
        held = [n for n in nets if address is not None and address in n]
        best = max(held, key=lambda n: n.prefixlen, default=None)
        codes = [c for c in nets.get(best, ()) if c is not None]
        assert row.geo_block_length == (best.prefixlen if best else None)
        assert row.source_country_code == min(codes, default=None)


def test_no_blocks_and_no_range_join(spark):
    df = frame(spark, ["10.0.0.1", None])
    empty = spark.createDataFrame([], "cidr string, country_code string")
    assert [r.geo_block_length for r in enrich.geo_by_block(df, empty).collect()] == [None, None]
    some = spark.createDataFrame([("10.0.0.0/8", "A"), ("10.0.0.0/30", "B")], "cidr string, country_code string")
    plan = plan_of(enrich.geo_by_block(df, some))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert enrich.geo_by_block(df, some).filter("source_country_code = 'B'").count() == 1


def test_lookup_is_cut_before_it_moves(spark):
    df = frame(spark, ["10.0.0.1", "10.0.0.2"])
    geo = spark.range(5000).selectExpr("CONCAT('10.0.', id, '.1') AS ip", "'A' AS country_code", "'ok' AS status")
    plan = plan_of(enrich.geo_lookup(df, geo))
    assert "LeftSemi" in plan
    assert plan.index("Exchange hashpartitioning(ip") < plan.index("LeftSemi")  # below the exchange
