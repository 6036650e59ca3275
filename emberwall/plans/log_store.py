"""The three tables as a folder that grows load by load.

``LogStore(spark, root)`` keeps under ``root``:

* ``pfsense_log``, ``ip4``, ``ip6``: the rows, partitioned by segment and span of days and
  bucketed by id, so that log and ip4 join without a shuffle. A segment is what one load,
  or one compaction, has written. A span holds so many days that a bucket of it reaches
  ``file_bytes``: the number of files follows the bytes, not the days.
* ``windows``: bytes and rows per source and time window; ``counts``: the counts the
  dashboard's panels are made of (``panel_counts``); ``files``: the files read. One folder
  per segment.
* ``sources``, ``flagged``: all sources with their rows and flags, and those of them that
  rows get a flag or a country from. One folder per load.
* ``manifest``: which segments and sources belong together. A load writes first and then
  publishes a manifest that names what it wrote, so a reader has all tables of a load or
  none, and what a load that failed has left behind is never read.

**Flags are those of the whole log.** Window sums of a load are added to the stored ones
of the same windows, so a source that passes a threshold only by two loads together is
found, and its earlier rows are flagged as well: rows are stored without flags, which are
joined from the short list ``flagged`` when they are read. The counts of earlier loads are
corrected for the sources whose flag or country has changed, by rows that take the old
counts back. So after any number of loads, tables and panels are what one load of all
files would give, with the lookup of the last one.

Files are known by their path. One that was loaded is not read again; one that has changed
since is refused. Two loads at once can't publish both: the second one raises ``Conflict``
and can be repeated.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emberwall import schema
from emberwall.operators.detect import flag_text, profile_of, window_sums
from emberwall.operators.enrich import country_of, geo_of, one_country_per_ip
from emberwall.operators.parse import extract, log_of, parse_versions, rows_of
from emberwall.operators.tables import divide, with_date
from emberwall.plans.dashboard import COUNT_KEYS, COUNTS
from emberwall.session import make_folder, remove, scratch, store, store_sized
from emberwall.sinks.manifest import Conflict, Manifest

__all__ = ["Conflict", "LogStore"]

TABLES = ("pfsense_log", "ip4", "ip6")
#: A write has no more tasks than this; each may write several files then.
MOST_TASKS = 100_000
PARTITIONS = ["segment", "first_day", "last_day"]
FILES = "path string, length long, modified timestamp"
WINDOWS = "source_ip string, start timestamp, bytes long, rows long"
SOURCES = "source_ip string, rows long, hot_bytes boolean, hot_rows boolean"
FLAGS = "hot_bytes boolean, hot_rows boolean, source_country_code string"
KINDS = "time timestamp, " + ", ".join(f"{key} string" for key in COUNT_KEYS[1:])
PANEL_COUNTS = f"{KINDS}, " + ", ".join(f"{count} long" for count in COUNTS)


def columns_of(table: str) -> dict[str, str]:
    """Names and types of the stored columns of a table."""
    log, version = table == "pfsense_log", 6 if table == "ip6" else 4
    names = schema.V6_COLUMNS if version == 6 else schema.V4_COLUMNS
    types = schema.V6_TYPES if version == 6 else schema.V4_TYPES
    types = {**types, "id": "bigint", "timestamp": "timestamp"}
    left_out = {*schema.LOG_COLUMNS[1:], schema.BOUNDARY_COLUMNS[version]}
    kept = schema.LOG_COLUMNS if log else [c for c in names if c not in left_out]
    return {c: types.get(c, "string") for c in kept}


def flag_columns(before: str = "") -> list[Column]:
    """The columns of ``ip4`` that come from the list of flagged sources."""
    country = F.col(f"{before}source_country_code").alias(f"{before}source_country_code")
    return [
        flag_text(f"{before}hot_bytes").alias(f"{before}threat_type_bandwith"),
        flag_text(f"{before}hot_rows").alias(f"{before}threat_type_frequency"),
        country,
    ]


def spans_of(days: Sequence[tuple], least: float) -> list[tuple]:
    """(day, first day, last day) of (day, size) in order: days of one span after another,
    each closed once it has the ``least`` size."""
    spans, open_, size = [], [], 0.0
    for day, own in days:
        open_.append(day)
        size += own
        if size >= least:
            spans.append(open_)
            open_, size = [], 0.0
    if open_:
        spans.append(open_)
    return [(day, span[0], span[-1]) for span in spans for day in span]


class LogStore:
    """Opens the store at ``root`` or starts one. The settings belong to the store: they
    are written down by the first load, and later ones keep to them."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        host: str | None = None,
        year: int = schema.DEFAULT_YEAR,
        window: str = schema.DEFAULT_WINDOW,
        min_bytes: int = schema.DEFAULT_MIN_BYTES,
        min_rows: int = schema.DEFAULT_MIN_ROWS,
        geo_min_rows: int = schema.DEFAULT_GEO_MIN_ROWS,
        failure_codes: bool = False,
        buckets: int = 64,
        file_bytes: int = 128 << 20,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifest = Manifest(spark, f"{self.root}/manifest")
        given = {
            "host": host, "year": year, "window": window, "min_bytes": min_bytes,
            "min_rows": min_rows, "geo_min_rows": geo_min_rows,
            "failure_codes": failure_codes, "buckets": buckets, "file_bytes": file_bytes,
        }
        self.settings = self.manifest.read()[1].get("settings", given)
        if not self.settings["host"]:
            raise ValueError("a new store needs the host whose log it keeps")
        self._seen: set[str] = set()

    # --- reading -------------------------------------------------------------------

    def state(self, version: int | None = None) -> dict:
        """What the latest version, or an earlier one, holds: ``version``, ``segments`` (of
        each its number, rows and bytes), ``loads`` and the counts of what was not
        understood in each."""
        version, known = self.manifest.read(version)
        empty = {"segments": {}, "loads": {}, "sources": 0, "settings": self.settings}
        return {"version": version, **empty, **known}

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        """``pfsense_log``, ``ip4`` and ``ip6``, all of the same version, each with the
        columns it is partitioned by."""
        state = self.state(version)
        log, ip4, ip6 = (self._rows(name, state) for name in TABLES)
        return {"pfsense_log": log, "ip4": self._with_flags(ip4, state), "ip6": ip6}

    def counts(self, version: int | None = None) -> DataFrame:
        """The counts for the panels, see ``panel_counts``."""
        return self._folders("counts", self.state(version), PANEL_COUNTS)

    def files(self, version: int | None = None) -> DataFrame:
        """The files that were loaded: ``path``, ``length``, ``modified``."""
        state = self.state(version)
        return self._read([f"files/load={load}" for load in state["loads"]], FILES)

    def _read(self, folders: Sequence[str], kinds: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], kinds)
        return self.spark.read.schema(kinds).parquet(*[f"{self.root}/{f}" for f in folders])

    def _folders(self, name: str, state: dict, kinds: str) -> DataFrame:
        return self._read([f"{name}/segment={s}" for s in state["segments"]], kinds)

    def _rows(self, name: str, state: dict, segments: Sequence[int] | None = None) -> DataFrame:
        numbers = [int(s) for s in state["segments"]] if segments is None else list(segments)
        return self._table(name, state).filter(F.col("segment").isin(numbers))

    def _flagged(self, state: dict) -> DataFrame:
        folders = [f"flagged/load={state['sources']}"] if state["sources"] else []
        return self._read(folders, f"source_ip string, {FLAGS}")

    def _with_flags(self, ip4: DataFrame, state: dict) -> DataFrame:
        listed = self._flagged(state).withColumnRenamed("source_ip", "_source")
        joined = ip4.join(listed, ip4["source_ip"].eqNullSafe(listed["_source"]), "left")
        return joined.select(*[ip4[c] for c in ip4.columns], *flag_columns())

    # --- the catalog's view of the rows -----------------------------------------------

    def _name(self, name: str) -> str:
        return f"{name}_{zlib.crc32(self.root.encode()):08x}"

    def _table(self, name: str, state: dict) -> DataFrame:
        """The bucketed table, whose partitions are looked up again if another session
        may have added some."""
        missing = set(state["segments"]) - self._seen
        if missing or not self._seen:
            self._declare()
            self._seen |= missing | {""}
        return self.spark.table(self._name(name))

    def _declare(self) -> None:
        for name in TABLES:
            make_folder(self.spark, f"{self.root}/{name}")
            columns = ", ".join(f"`{c}` {kind}" for c, kind in columns_of(name).items())
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS `{self._name(name)}` "
                f"({columns}, segment int, first_day date, last_day date) "
                f"USING parquet PARTITIONED BY ({', '.join(PARTITIONS)}) "
                f"CLUSTERED BY (id) SORTED BY (id) INTO {self.settings['buckets']} BUCKETS "
                f"LOCATION '{self.root}/{name}'"
            )
            self.spark.sql(f"MSCK REPAIR TABLE `{self._name(name)}` SYNC PARTITIONS")

    # --- loading -------------------------------------------------------------------

    def new_files(self, paths: str | Sequence[str]) -> DataFrame:
        """The files at ``paths`` (files, folders or patterns) that are not loaded yet."""
        paths = [paths] if isinstance(paths, str) else list(paths)
        # a listing: contents are not read, since no column of theirs is asked for
        found = self.spark.read.format("binaryFile").load(paths).select(
            "path", "length", F.col("modificationTime").alias("modified")
        )
        known = self.files().select("path", F.col("length").alias("_l"), F.col("modified").alias("_m"))
        both = found.join(known, "path", "left")
        changed = both.filter((F.col("length") != F.col("_l")) | (F.col("modified") != F.col("_m")))
        names = [r.path for r in changed.select("path").limit(5).collect()]
        if names:
            raise ValueError(f"changed since they were loaded: {', '.join(names)}")
        return both.filter(F.col("_l").isNull()).select("path", "length", "modified")

    def load(self, paths: str | Sequence[str], geo: DataFrame) -> dict:
        """Load the files at ``paths`` that are new, and publish. Returns the state; if no
        file is new, nothing is changed."""
        state = self.state()
        with scratch(self.spark):
            files = store(self.new_files(paths), "files")
            # Spark's reader takes the names from the driver anyhow
            new = [r.path for r in files.select("path").collect()]
            if not new:
                return state
            number = self.manifest.claim()
            try:
                return self._load(number, files, new, geo, state)
            except BaseException:
                self._drop(number)
                raise

    def _load(self, number: int, files: DataFrame, new: list[str], geo: DataFrame, state: dict) -> dict:
        s = self.settings
        rejects = Observation(f"rejects_{number}")
        lines = extract(self.spark.read.text(new), s["host"], load=number)
        parsed, size = store_sized(parse_versions(lines, s["host"], s["year"], rejects), "parsed")
        log, v4, v6 = with_date(log_of(parsed)), with_date(rows_of(parsed, 4)), with_date(rows_of(parsed, 6))
        self._write_rows(
            {"pfsense_log": log, "ip4": divide(v4, 4)[1], "ip6": divide(v6, 6)[1]}, number, size
        )
        sums = self._write(window_sums(v4, s["window"]), f"windows/segment={number}", WINDOWS)
        flagged = self._merge_sources(number, sums, geo, state)
        counts = self._with_flags(v4, {"sources": number}).withColumnRenamed("timestamp", "time")
        counts = counts.groupBy(*COUNT_KEYS).agg(*_counts())
        if state["segments"]:
            counts = counts.unionByName(self._corrections(flagged, state))
        self._write(counts, f"counts/segment={number}", PANEL_COUNTS)
        self._write(files, f"files/load={number}", FILES)

        state = dict(state)
        version, found = state.pop("version"), rejects.get
        state["segments"] = {**state["segments"], str(number): {"bytes": size}}
        state["loads"] = {**state["loads"], str(number): {**found, "files": len(new)}}
        state["sources"] = number
        return {"version": self.manifest.publish(version, state), **state}

    def _write(self, df: DataFrame, folder: str, kinds: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{folder}")
        return self._read([folder], kinds)

    def _write_rows(self, tables: dict[str, DataFrame], number: int, size: int) -> None:
        """Write rows with their ``date`` as a segment, in spans of days that are large
        enough for its buckets. A log has a year of its settings, so it has few days."""
        days = tables["pfsense_log"].groupBy("date").count().orderBy("date").collect()
        per_row = size / max(1, sum(n for _, n in days))
        buckets = self.settings["buckets"]
        least = buckets * self.settings["file_bytes"]
        found = spans_of([(day, n * per_row) for day, n in days if day is not None], least)
        spans = self.spark.createDataFrame(found, "date date, first_day date, last_day date")
        # one task a file: rows of a span and bucket come together, by the bucket's own rule
        tasks = min(buckets * (1 + len({first for _, first, _ in found})), MOST_TASKS)
        bucket = F.pmod(F.hash("id"), F.lit(buckets))
        self._table("pfsense_log", {"segments": {}})
        for name, df in tables.items():
            placed = df.join(F.broadcast(spans), "date", "left").withColumn("segment", F.lit(number))
            placed = placed.select(*columns_of(name), *PARTITIONS)
            placed = placed.repartition(tasks, "first_day", bucket)
            placed.write.insertInto(self._name(name))
        self._seen.add(str(number))

    def _merge_sources(self, number: int, sums: DataFrame, geo: DataFrame, state: dict) -> DataFrame:
        """Store all sources and the flagged ones, with this load's window sums."""
        s = self.settings
        together = sums
        first, last = sums.agg(F.min("start"), F.max("start")).first()
        if state["segments"] and first is not None:
            earlier = self._folders("windows", state, WINDOWS)
            earlier = earlier.filter(F.col("start").between(F.lit(first), F.lit(last)))
            together = sums.unionByName(earlier).groupBy("source_ip", "start").agg(
                F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
            )
        hot = profile_of(together, s["min_bytes"], s["min_rows"]).withColumn("rows", F.lit(0))
        new = sums.groupBy("source_ip").agg(F.sum("rows").alias("rows"))
        new = new.select("*", F.lit(False).alias("hot_bytes"), F.lit(False).alias("hot_rows"))
        known = [f"sources/load={state['sources']}"] if state["sources"] else []
        merged = (
            self._read(known, SOURCES).unionByName(new).unionByName(hot)
            .groupBy("source_ip")
            .agg(
                F.sum("rows").alias("rows"),
                F.bool_or("hot_bytes").alias("hot_bytes"),
                F.bool_or("hot_rows").alias("hot_rows"),
            )
        )
        merged = self._write(merged, f"sources/load={number}", SOURCES)
        is_hot, frequent = F.col("hot_bytes") | F.col("hot_rows"), F.col("rows") >= s["geo_min_rows"]
        chosen = store(merged.filter(is_hot | frequent), "chosen")
        countries = one_country_per_ip(geo_of(chosen.filter(frequent), geo))
        found = chosen.join(countries, chosen["source_ip"] == countries["ip"], "left")
        country = country_of(F.col("country_code"), F.col("status"), s["failure_codes"])
        flagged = found.select(
            "source_ip", "hot_bytes", "hot_rows", F.when(frequent, country).alias("source_country_code")
        ).filter(is_hot | F.col("source_country_code").isNotNull())
        return self._write(flagged, f"flagged/load={number}", f"source_ip string, {FLAGS}")

    def _corrections(self, flagged: DataFrame, state: dict) -> DataFrame:
        """Counts that take back those of earlier rows whose source has other flags or
        another country now, and give them anew."""
        old = self._flagged(state)
        old = old.select(*[F.col(c).alias(f"old_{c}") for c in old.columns])
        both = flagged.join(old, flagged["source_ip"].eqNullSafe(old["old_source_ip"]), "full")
        both = both.select(
            F.coalesce("source_ip", "old_source_ip").alias("_source"),
            *flag_columns(), *flag_columns("old_"),
        )
        same = [F.col(key).eqNullSafe(F.col(f"old_{key}")) for key in COUNT_KEYS[1:]]
        changed = store(both.filter(~(same[0] & same[1] & same[2])), "changed")
        # the segments those sources have rows in, by the stored windows
        sums = self._read([], f"{WINDOWS}, segment int")
        for segment in state["segments"]:
            own = self._read([f"windows/segment={segment}"], WINDOWS)
            sums = sums.unionByName(own.withColumn("segment", F.lit(int(segment))))
        met = sums.join(changed, sums["source_ip"].eqNullSafe(changed["_source"]), "left_semi")
        segments = [r.segment for r in met.select("segment").distinct().collect()]
        ip4 = self._rows("ip4", state, segments)
        rows = ip4.join(changed, ip4["source_ip"].eqNullSafe(changed["_source"])).drop(*PARTITIONS)
        log = self._rows("pfsense_log", state, segments).select("id", F.col("timestamp").alias("time"))
        old_keys = [f"old_{key}" for key in COUNT_KEYS[1:]]
        counted = log.join(rows, "id").groupBy(*COUNT_KEYS, *old_keys).agg(*_counts())

        def as_rows(before: str, sign: int) -> Column:
            keys = [F.col("time"), *[F.col(f"{before}{k}").alias(k) for k in COUNT_KEYS[1:]]]
            return F.struct(*keys, *[(F.col(c) * sign).alias(c) for c in COUNTS])

        return counted.select(F.explode(F.array(as_rows("old_", -1), as_rows("", 1))).alias("c")).select("c.*")

    # --- keeping it in shape -----------------------------------------------------------

    def compact(self) -> dict:
        """Put the segments together that are too small to fill their buckets' files. The
        rows keep their ids, and flags and counts stay the same. Returns the state."""
        state = self.state()
        least = self.settings["buckets"] * self.settings["file_bytes"]
        small = [int(s) for s, about in state["segments"].items() if about["bytes"] < least]
        if len(small) < 2:
            return state
        number = self.manifest.claim()
        size = sum(state["segments"][str(s)]["bytes"] for s in small)
        try:
            log = with_date(self._rows("pfsense_log", state, small).drop(*PARTITIONS))
            days = log.select("id", "date")
            others = {n: self._rows(n, state, small).drop(*PARTITIONS).join(days, "id") for n in TABLES[1:]}
            self._write_rows({"pfsense_log": log, **others}, number, size)
            own = {"segments": dict.fromkeys(map(str, small))}
            sums = self._folders("windows", own, WINDOWS).groupBy("source_ip", "start").agg(
                F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
            )
            self._write(sums, f"windows/segment={number}", WINDOWS)
            counts = self._folders("counts", own, PANEL_COUNTS).groupBy(*COUNT_KEYS).agg(
                *[F.sum(c).alias(c) for c in COUNTS]
            )
            self._write(counts.filter(F.col("rows") != 0), f"counts/segment={number}", PANEL_COUNTS)
            version = state.pop("version")
            kept = {s: about for s, about in state["segments"].items() if int(s) not in small}
            state["segments"] = {**kept, str(number): {"bytes": size}}
            return {"version": self.manifest.publish(version, state), **state}
        except BaseException:
            self._drop(number)
            raise

    def clean(self, keep_versions: int = 1, min_age: float = 86_400) -> list[str]:
        """Forget versions but the last ``keep_versions`` and those younger than ``min_age``
        seconds; then remove all folders that no version names and whose load or compaction
        began at least so long ago, so that of one that still runs nothing is taken.
        Returns the folders."""
        versions = self.manifest.versions()
        latest = versions[-max(1, keep_versions) :]
        kept = [v for v in versions if v in latest or not self.manifest.published_before(v, min_age)]
        segments, loads, sources = set(), set(), set()
        for version in kept:
            state = self.state(version)
            segments |= set(map(int, state["segments"]))
            loads |= set(map(int, state["loads"]))
            sources.add(state["sources"])
        removed = []
        for number in self.manifest.claimed():
            if self.manifest.claimed_before(number, min_age):
                unused = [] if number in segments else [f"{n}/segment={number}" for n in BY_SEGMENT]
                unused += [] if number in loads else [f"files/load={number}"]
                unused += [] if number in sources else [f"{n}/load={number}" for n in BY_LOAD]
                removed += [folder for folder in unused if remove(self.spark, f"{self.root}/{folder}")]
        for version in versions:
            if version not in kept:
                self.manifest.forget(version)
        self._seen = set()
        return removed

    def _drop(self, number: int) -> None:
        """Remove what a load that failed has written; nobody reads it."""
        for name in BY_SEGMENT:
            remove(self.spark, f"{self.root}/{name}/segment={number}")
        for name in (*BY_LOAD, "files"):
            remove(self.spark, f"{self.root}/{name}/load={number}")
        self._seen = set()


BY_SEGMENT = (*TABLES, "windows", "counts")
BY_LOAD = ("sources", "flagged")


def _counts() -> list[Column]:
    return [F.count(what).alias(name) for name, what in COUNTS.items()]
