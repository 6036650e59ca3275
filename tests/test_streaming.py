"""The detectors on a folder that grows."""

import random
from collections import Counter

import pytest
from support import HOST

from emberwall.operators import detect, parse
from emberwall.streaming import closed_windows, hot_sources, read_log_stream, window_stream


def line(minute, second, source, length, version=4):
    rest = f"3,,,1,em0,match,block,in,{version},0x0,,64,9,0,DF,6,tcp,60,{source},192.0.2.9,99,443,{length},S,1,,1,,mss"
    return f"Sep  7 {10 + minute // 60:02d}:{minute % 60:02d}:{second:02d} {HOST} filterlog: {rest}"


def write(folder, name, lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def minute_lines(rng, minutes):
    rows = []
    for minute in minutes:
        for _ in range(rng.randint(5, 25)):
            source = rng.choice(["192.0.2.1", "192.0.2.2", "192.0.2.3", ""])
            rows.append(line(minute, rng.randint(0, 59), source, rng.choice([10, 500, "", "x", -3])))
    rows += [line(minutes[0], 5, "192.0.2.7", 9, version=6), "Sep  7 10:00:00 elsewhere sshd: x", "noise"]
    rows.append(f"Foo 99 00:00:00 {HOST} filterlog: 3,,,1,em0,match,block,in,4,0x0,,64,9,0,DF,6,tcp,60")
    rng.shuffle(rows)
    return rows


def run(spark, tmp_path, **options):
    stream = read_log_stream(spark, str(tmp_path / "log"), options.pop("files_at_once", None))
    running = window_stream(
        stream, HOST, str(tmp_path / "out"), str(tmp_path / "checkpoint"), once=True, **options
    )
    running.awaitTermination()
    assert running.exception() is None
    return closed_windows(spark, str(tmp_path / "out"))


def batch(spark, folder, until):
    rows = parse.parse_v4(parse.by_ip_version(parse.extract(spark.read.text(str(folder)), HOST), 4), HOST)
    sums = detect.window_sums(rows).filter("start IS NOT NULL")
    sums = sums.filter(f"start + INTERVAL 1 MINUTE <= TIMESTAMP '{until}'")
    return Counter(map(tuple, sums.select("source_ip", "start", "bytes", "rows").collect()))


def found(windows):
    return Counter(map(tuple, windows.select("source_ip", "window_start", "bytes", "rows").collect()))


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    return folder


def test_a_replayed_folder_gives_what_the_batch_gives(spark, tmp_path, log):
    rng = random.Random(1)
    for i in range(4):
        write(log, f"f{i}.log", minute_lines(rng, range(10 * i, 10 * i + 10)))
    write(log, "last.log", [line(44, 0, "192.0.2.1", 5)])
    windows = run(spark, tmp_path)
    assert found(windows) == batch(spark, log, "2020-09-07 10:39:00")  # the last time less five minutes


def test_a_stopped_stream_goes_on(spark, tmp_path, log):
    """Files that come later, a time that comes a little late, windows over two files."""
    rng = random.Random(2)
    write(log, "a.log", minute_lines(rng, range(0, 10)))
    first = found(run(spark, tmp_path))
    assert first and sum(first.values()) < 40
    write(log, "b.log", [line(7, 3, "192.0.2.1", 77), *minute_lines(rng, range(9, 20))])
    second = found(run(spark, tmp_path))
    assert not first - second  # what was written stays
    write(log, "c.log", [line(60, 0, "192.0.2.9", 1)])
    assert found(run(spark, tmp_path)) == batch(spark, log, "2020-09-07 10:55:00")


def test_too_late_lines_are_dropped(spark, tmp_path, log):
    write(log, "a.log", [line(0, 1, "192.0.2.1", 5), line(30, 0, "192.0.2.1", 5)])
    run(spark, tmp_path)
    write(log, "b.log", [line(0, 2, "192.0.2.1", 1000), line(50, 0, "192.0.2.1", 5)])
    got = run(spark, tmp_path).filter("window_start = TIMESTAMP '2020-09-07 10:00:00'").collect()
    assert [(r.bytes, r.rows) for r in got] == [(5, 1)]


def test_hot_sources_of_the_stream(spark, tmp_path, log):
    rng = random.Random(3)
    write(log, "a.log", minute_lines(rng, range(0, 20)))
    write(log, "b.log", [line(59, 0, "192.0.2.9", 1)])
    windows = run(spark, tmp_path)
    got = {r.source_ip: (r.hot_bytes, r.hot_rows) for r in hot_sources(windows, 900, 6).collect()}
    rows = parse.parse_v4(parse.by_ip_version(parse.extract(spark.read.text(str(log)), HOST), 4), HOST)
    profile = detect.source_profile(rows.filter("minute(timestamp) < 54"), "1 minute", 900, 6).collect()
    expected = {r.source_ip: (r.hot_bytes, r.hot_rows) for r in profile if r.hot_bytes or r.hot_rows}
    assert got == expected and any(b for b, _ in got.values()) and any(r for _, r in got.values())


def test_an_empty_folder(spark, tmp_path, log):
    write(log, "a.log", ["noise"])
    assert run(spark, tmp_path).count() == 0
