"""The store: loads that come whole or not at all, once, in any parts, with few files."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from support import HOST, plan_of

from emberwall import session
from emberwall.operators.parse import TASK_BITS, assign_id, parse_versions
from emberwall.plans import dashboard, load, log_store
from emberwall.plans.log_store import Conflict, LogStore, spans_of
from emberwall.sinks.manifest import Manifest

SETTINGS = {"window": "1 hour", "min_bytes": 900, "min_rows": 5, "geo_min_rows": 9}
FLAG_BYTES, FLAG_ROWS = "threat_type_bandwith", "threat_type_frequency"


@pytest.fixture(scope="module", autouse=True)
def small_jobs(spark):
    """The data are tiny: few tasks, and plans that are not compiled."""
    keys = {"spark.sql.shuffle.partitions": "2", "spark.sql.codegen.wholeStage": "false"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def line(rng, day, source, length):
    time = f"Sep {day:2d} {rng.randint(0, 5):02d}:{rng.randint(0, 1) * 30:02d}:{rng.randint(0, 3):02d}"
    if rng.random() < 0.02:
        time = "Foo 99 00:00:00"
    rest = "3,,,1,em0,match,block,in,4,0x0,,64,9,0,DF,6,tcp,60"
    kind = rng.random()
    if kind < 0.05:
        return f"{time} {HOST} filterlog: {rest}"  # no source
    if kind < 0.15:
        return f"{time} {HOST} filterlog: 3,,,1,em0,match,block,in,6,0,0x1,1,UDP,17,{length},fd00::1,ff02::2"
    if kind < 0.18:
        return f"{time} {HOST} filterlog: 3,,,1"
    if kind < 0.2:
        return f"{time} {HOST} filterlog: 3,,,1,em0,match,block,in,x,"
    if kind < 0.22:
        return f"{time} {HOST} sshd: noise"
    return f"{time} {HOST} filterlog: {rest},{source},192.0.2.9,99,443,{length},S,1,,1,,mss"


@pytest.fixture(scope="module")
def log_files(tmp_path_factory):
    """Six files whose sources come back from file to file, so that some pass a threshold
    only by several files together."""
    rng = random.Random(3)
    folder = tmp_path_factory.mktemp("log")
    for i in range(6):
        rows = []
        for _ in range(120):
            source = f"192.0.2.{min(rng.randint(1, 30), rng.randint(1, 30))}"
            rows.append(line(rng, rng.randint(1 + i // 2, 8), source, rng.randint(0, 400)))
        (folder / f"f{i}.log").write_text("\n".join(rows) + "\n")
    return folder


@pytest.fixture(scope="module")
def geo(spark):
    rows = [(f"192.0.2.{i}", f"C{i % 3}" if i % 4 else None, "ok" if i % 4 else "error") for i in range(30)]
    return spark.createDataFrame([*rows, *rows[:5]], "ip string, country_code string, status string")


@pytest.fixture(scope="module")
def whole(spark, log_files, geo):
    """The tables as one plain load of all files makes them."""
    lines = spark.read.text(str(log_files))
    made = load.build_tables(lines, HOST, geo, **SETTINGS)
    return {name: df.cache() for name, df in made.items()}


@pytest.fixture(scope="module")
def expected(whole):
    """What is in the tables and panels of ``whole``."""
    found = {"log": contents(whole["pfsense_log"]), "ip6": contents(whole["ip6"])}
    found["rows"] = contents(joined(whole))
    for name, (panel, _) in PANELS.items():
        for time_range in (None, RANGE):
            found[name, time_range] = contents(panel(whole["pfsense_log"], whole["ip4"], time_range))
    return found


def new_store(spark, root, **options):
    return LogStore(spark, str(root), HOST, buckets=3, **(SETTINGS | options))


def file_names(folder, *numbers):
    return [str(folder / f"f{i}.log") for i in numbers]


def contents(df):
    """Rows without ids and what they are partitioned by."""
    kept = sorted(set(df.columns) - {"id", "segment", "first_day", "last_day"})
    return Counter(map(tuple, df.select(*kept).collect()))


def joined(tables):
    from emberwall.operators.tables import join_log_ip4

    return join_log_ip4(tables["pfsense_log"], tables["ip4"])


RANGE = ("2020-09-02 01:00:00", "2020-09-04 03:30:02")
PANELS = {
    "bandwidth": (dashboard.dash_threat_bandwidth, lambda c, r: dashboard.counted_per_year(c, FLAG_BYTES, r)),
    "frequency": (dashboard.dash_threat_frequency, lambda c, r: dashboard.counted_per_year(c, FLAG_ROWS, r)),
    "country": (dashboard.dash_country, dashboard.counted_country),
    "bytes": (dashboard.dash_bandwidth_over_time, lambda c, r: dashboard.counted_over_time(c, FLAG_BYTES, r)),
    "rows": (dashboard.dash_frequency_over_time, lambda c, r: dashboard.counted_over_time(c, FLAG_ROWS, r)),
    "logs": (dashboard.dash_logs_over_time, lambda c, r: dashboard.counted_over_time(c, None, r)),
}


def assert_same(held, expected):
    tables, counts = held.tables(), held.counts().cache()
    assert contents(joined(tables)) == expected["rows"]
    assert contents(tables["pfsense_log"]) == expected["log"]
    assert contents(tables["ip6"]) == expected["ip6"]
    ids = [r.id for r in tables["pfsense_log"].select("id").collect()]
    assert len(set(ids)) == len(ids)
    for name, (_, counted) in PANELS.items():
        for time_range in (None, RANGE):
            assert contents(counted(counts, time_range)) == expected[name, time_range]
    counts.unpersist()


@pytest.fixture(scope="module")
def grown(spark, log_files, geo, tmp_path_factory):
    """A store that took the files in four loads."""
    held = new_store(spark, tmp_path_factory.mktemp("store") / "s")
    for files in ((0,), (1, 2, 3), (4, 5)):
        held.load(file_names(log_files, *files), geo)
    return held


def test_loads_together_give_what_one_load_gives(grown, whole, expected):
    flags = contents(whole["ip4"].select(FLAG_BYTES, FLAG_ROWS, "source_country_code"))
    assert len(flags) > 5
    assert_same(grown, expected)


@pytest.mark.parametrize("name", PANELS)
def test_panels_of_its_rows(grown, expected, name):
    tables = grown.tables()
    for time_range in (None, RANGE):
        found = PANELS[name][0](tables["pfsense_log"], tables["ip4"], time_range)
        assert contents(found) == expected[name, time_range]


def test_earlier_rows_are_flagged_later(spark, grown, log_files, geo):
    """The case the corrections are for occurs: flags of the first load's rows changed."""
    first, last = grown.tables(1), grown.tables()
    of_first = last["ip4"].filter("segment = 1")
    assert first["ip4"].count() == of_first.count()
    assert contents(first["ip4"]) != contents(of_first)
    assert grown.counts().filter("rows < 0").count() > 0


def test_a_repeated_load_changes_nothing(spark, grown, log_files, geo):
    before = grown.state()
    assert grown.load(str(log_files), geo) == before == grown.state()
    assert grown.files().count() == 6 and grown.new_files(str(log_files)).count() == 0
    assert sum(x["files"] for x in before["loads"].values()) == 6


def test_ids_of_loads_are_disjoint(grown):
    rows = grown.tables()["pfsense_log"].select("segment", F.shiftright("id", 48).alias("load")).distinct()
    assert {(r.segment, r.load) for r in rows.collect()} == {(i, i) for i in range(1, 4)}


def test_ids_that_do_not_fit(spark):
    with pytest.raises(ValueError):
        assign_id(spark.range(3).toDF("x"), 1 << (63 - 48))
    rows = assign_id(spark.range(0, 100, 1, 7).toDF("x"), 5)
    assert rows.select("id").distinct().count() == 100
    assert rows.filter(F.shiftright("id", 48) != 5).count() == 0 and TASK_BITS == 20


def test_opened_again_it_keeps_its_settings(spark, grown):
    again = LogStore(spark, grown.root, min_rows=1)
    assert again.settings == grown.settings
    assert contents(again.tables()["ip4"]) == contents(grown.tables()["ip4"])
    with pytest.raises(ValueError):
        LogStore(spark, grown.root + "_new")


def test_without_what_the_catalog_knows(spark, grown):
    """Another session finds the rows from the folder alone."""
    expected = contents(grown.tables()["ip4"])
    for name in log_store.TABLES:
        spark.sql(f"DROP TABLE `{grown._name(name)}`")
    again = LogStore(spark, grown.root)
    assert contents(again.tables()["ip4"]) == expected
    assert contents(grown.tables()["ip4"]) == expected


def test_a_failed_load_is_not_seen(spark, log_files, geo, tmp_path, monkeypatch, expected):
    held = new_store(spark, tmp_path / "s")
    held.load(file_names(log_files, 0, 1, 2), geo)
    before = {name: contents(df) for name, df in held.tables().items()}
    plain, written = LogStore._write_rows, []

    def second_fails(self, tables, number, size):
        written.append(number)
        plain(self, {"pfsense_log": tables["pfsense_log"]}, number, size)
        raise OSError("disk full")

    def left_behind(self, number):
        """As if the driver had died before it could tidy up."""

    monkeypatch.setattr(LogStore, "_write_rows", second_fails)
    for tidy in (LogStore._drop, left_behind):
        monkeypatch.setattr(LogStore, "_drop", tidy)
        with pytest.raises(OSError):
            held.load(str(log_files), geo)
        for again in (held, LogStore(spark, held.root)):
            assert {name: contents(df) for name, df in again.tables().items()} == before
            assert again.state()["version"] == 1
    monkeypatch.undo()
    left = [p for p in Path(held.root).rglob("segment=*") if p.name == f"segment={written[1]}"]
    assert left and not list(Path(held.root).rglob(f"segment={written[0]}"))
    held.load(str(log_files), geo)
    assert any(f"segment={written[1]}" in folder for folder in held.clean(min_age=0))
    assert not list(Path(held.root).rglob(f"segment={written[1]}"))
    assert_same(held, expected)


def test_two_loads_at_once(spark, log_files, geo, tmp_path, monkeypatch, expected):
    """The one that publishes later is refused, leaves nothing and can be repeated."""
    one, other = new_store(spark, tmp_path / "s"), new_store(spark, tmp_path / "s")
    plain = LogStore._merge_sources

    def meanwhile(self, *args):
        if self is one and not other.state()["loads"]:
            other.load(file_names(log_files, 0, 1), geo)
        return plain(self, *args)

    monkeypatch.setattr(LogStore, "_merge_sources", meanwhile)
    with pytest.raises(Conflict):
        one.load(str(log_files), geo)
    assert set(one.state()["segments"]) == {"2"} and not list(Path(one.root).rglob("segment=1"))
    one.load(str(log_files), geo)
    assert_same(one, expected)


def test_versions_are_published_once(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"))
    assert manifest.read() == (0, {})
    assert manifest.publish(0, {"a": "é"}) == 1 and manifest.read() == (1, {"a": "é"})
    with pytest.raises(Conflict):
        manifest.publish(0, {"a": 2})
    assert manifest.read() == (1, {"a": "é"}) and manifest.versions() == [1]
    claims = [manifest.claim() for _ in range(3)] + [manifest.claim(9), manifest.claim()]
    assert claims == [1, 2, 3, 9, 10] == manifest.claimed()


def test_a_changed_file_is_refused(spark, geo, tmp_path):
    file = tmp_path / "log" / "a.log"
    file.parent.mkdir()
    rng = random.Random(1)
    file.write_text(line(rng, 2, "192.0.2.1", 5) + "\n")
    held = new_store(spark, tmp_path / "s")
    held.load(str(file.parent), geo)
    file.write_text("".join(line(rng, 2, "192.0.2.1", 5) + "\n" for _ in range(2)))
    with pytest.raises(ValueError, match="a.log"):
        held.load(str(file.parent), geo)


def test_no_files_and_no_lines(spark, geo, tmp_path):
    held = new_store(spark, tmp_path / "s")
    assert all(df.count() == 0 for df in held.tables().values()) and held.counts().count() == 0
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "other.log").write_text("Sep  1 00:00:00 elsewhere filterlog: 1\n")
    state = held.load(str(tmp_path / "log"), geo)
    assert state["loads"]["1"]["lines"] == 0
    assert all(df.count() == 0 for df in held.tables().values())
    assert contents(dashboard.counted_over_time(held.counts())) == Counter()


# --- layout -------------------------------------------------------------------


def parquet_files(held, name):
    return list((Path(held.root) / name).rglob("*.parquet"))


def test_files_follow_bytes_not_days(spark, grown, log_files, geo, tmp_path):
    one = new_store(spark, tmp_path / "one")
    one.load(str(log_files), geo)
    days = one.tables()["pfsense_log"].select(F.to_date("timestamp")).distinct().count()
    assert days == 9  # eight, and rows without a time
    for name in log_store.TABLES:
        assert len(parquet_files(one, name)) <= 2 * 3  # with a day and without, in buckets
    small = one.state()["segments"]["1"]["bytes"] / 3 / 4
    split = new_store(spark, tmp_path / "split", file_bytes=int(small))
    split.load(str(log_files), geo)
    spans = split.tables()["pfsense_log"].select("first_day", "last_day").distinct().collect()
    spans = sorted((s.first_day, s.last_day) for s in spans if s.first_day is not None)
    assert 3 <= len(spans) <= 5
    # a span and bucket is one file, though many tasks write
    assert len(parquet_files(split, "pfsense_log")) <= 3 * (len(spans) + 1)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_spans():
    days = [(day, 10.0) for day in range(7)]
    assert [x[1:] for x in spans_of(days, 25)] == [(0, 2)] * 3 + [(3, 5)] * 3 + [(6, 6)]
    assert spans_of(days, 1e9) == [(day, 0, 6) for day in range(7)]
    assert spans_of([], 5) == [] and spans_of([(1, 99.0), (2, 1.0)], 5) == [(1, 1, 1), (2, 2, 2)]


@pytest.fixture
def shuffle_joins_only(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_log_and_ip4_join_without_shuffle(spark, grown, shuffle_joins_only):
    log, ip4 = (grown._rows(name, grown.state()) for name in ("pfsense_log", "ip4"))
    plan = plan_of(dashboard._rows(log, ip4, None))
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_time_range_prunes_both_scans(spark, grown):
    tables = grown.tables()
    plan = plan_of(dashboard.dash_logs_over_time(tables["pfsense_log"], tables["ip4"], RANGE))
    scans = [x for x in plan.split("FileScan")[1:] if "first_day" in x]
    assert len(scans) == 2
    for scan in scans:
        pruned = scan.split("PartitionFilters: [")[1].split("]")[0]
        assert "first_day" in pruned and "last_day" in pruned


def test_panels_from_counts_read_no_rows(grown):
    for _, counted in PANELS.values():
        plan = plan_of(counted(grown.counts(), RANGE))
        assert "/counts/" in plan and not any(f"{name}_" in plan for name in log_store.TABLES)
        assert "PushedFilters: [" in plan and "GreaterThanOrEqual(time" in plan


def test_compaction_and_cleaning(spark, log_files, geo, tmp_path, expected):
    held = new_store(spark, tmp_path / "s")
    for files in ((0, 1), (2, 3), (4, 5)):
        held.load(file_names(log_files, *files), geo)
    before = {r.id for r in held.tables()["pfsense_log"].select("id").collect()}
    many = len(parquet_files(held, "ip4"))
    state = held.compact()
    assert list(state["segments"]) == ["4"] and state["version"] == 4 and len(state["loads"]) == 3
    assert_same(held, expected)
    assert {r.id for r in held.tables()["pfsense_log"].select("id").collect()} == before
    assert held.compact() == held.state()  # nothing left to put together
    assert held.clean() == []  # too young
    assert contents(held.tables(3)["ip4"]) == contents(held.tables()["ip4"])
    held.clean(min_age=0)
    assert len(parquet_files(held, "ip4")) < many
    assert held.manifest.versions() == [4]
    assert_same(held, expected)
    assert held.load(str(log_files), geo)["version"] == 4


# --- rejects and what is stored on the way ---------------------------------------


def test_rejects_are_counted_in_the_pass(grown, log_files):
    found = Counter()
    for path in log_files.iterdir():
        for text in path.read_text().splitlines():
            if f"{HOST} filterlog" not in text:
                continue
            found["lines"] += 1
            fields = text.split(",")
            if len(fields) < 9:
                found["short"] += 1
            elif fields[8] not in ("4", "6"):
                found["bad_version"] += 1
            elif text.startswith("Foo"):
                found["bad_time"] += 1
    loads = grown.state()["loads"].values()
    kinds = ("lines", "short", "bad_version", "bad_header", "bad_time")
    assert {k: sum(x[k] for x in loads) for k in kinds} == {k: found[k] for k in kinds}
    assert all(found[k] for k in ("short", "bad_version", "bad_time"))


def test_headers_of_another_form(spark):
    from pyspark.sql import Observation

    texts = [f"Sep  7 11:45:50 {HOST} filterlogger 5,,,1,em0,m,b,in,4,0", f"Sep  7 11:45:50 {HOST} filterlog: 5,,,1,em0,m,b,in,4,0"]
    df = spark.createDataFrame([(0, texts[0]), (1, texts[1])], "id long, value string")
    rejects = Observation("headers")
    rows = parse_versions(df, HOST, rejects=rejects).collect()
    assert len(rows) == 2 and rejects.get["bad_header"] == rejects.get["bad_time"] == 1


def test_scratch_blocks_of_threads_are_apart(spark):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    together = Barrier(2, timeout=60)

    def work(last):
        with session.scratch(spark):
            df = session.store(spark.range(9).toDF("x"), "part")
            together.wait()
            if last:
                together.wait()  # until the other block has ended
            assert df.count() == 9
        if not last:
            together.wait()

    with ThreadPoolExecutor(2) as pool:
        for job in [pool.submit(work, last) for last in (True, False)]:
            job.result(timeout=120)


def test_what_is_stored_outside_blocks_can_be_cleared(spark):
    path = session.scratch_path(spark, "rows", table="left_over")
    spark.range(3).write.option("path", path).saveAsTable("left_over")
    kept = session._LEFT[spark.sparkContext.applicationId]
    others, kept[:] = kept[:-1], kept[-1:]  # other tests' frames are still in use
    session.clear(spark)
    session._LEFT[spark.sparkContext.applicationId] = others
    assert not spark.catalog.tableExists("left_over")
    assert not Path(path.removeprefix("file:")).exists()
