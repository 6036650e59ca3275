"""From log lines to typed IPv4 and IPv6 frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from emberwall import schema
from emberwall.functions import (
    blank_to_null,
    fields_of,
    options_list,
    options_text,
    syslog_timestamp,
    whitespace_to_null,
)

PROCESS_NUMBER = r"^\[\d+\]: "
IP_VERSION_AT = schema.V4_FIELDS.index("ip_version")


def filter_log_lines(lines: DataFrame, host: str) -> DataFrame:
    """Keep the lines the packet filter of ``host`` wrote."""
    return lines.filter(F.col("value").contains(f"{host} filterlog"))


#: Bits of an id that number the tasks of a load, and the rows of a task.
TASK_BITS, ROW_BITS = 20, 28


def assign_id(df: DataFrame, load: int | None = None) -> DataFrame:
    """Add a unique id. It depends on the partitions, so store the frame once
    and take every table from the stored copy. Each load counts anew; lines that
    come with an ``id`` of the caller's keep it.

    With the number of a ``load``, below 32,768, ids of different loads differ: the
    number stands in the upper bits, the task and the row of the task below it. A
    load of more tasks or rows in a task than their bits can tell apart fails.
    """
    serial = F.monotonically_increasing_id()
    if load is None:
        return df.withColumn("id", serial)
    if not 0 <= load < 1 << (63 - TASK_BITS - ROW_BITS):
        raise ValueError(f"no ids are left for load {load}")
    task, row = F.shiftright("_serial", 33), F.col("_serial").bitwiseAND(F.lit((1 << 33) - 1))
    number = (
        F.lit(load << (TASK_BITS + ROW_BITS)).cast("long")
        .bitwiseOR(F.shiftleft(task, ROW_BITS))
        .bitwiseOR(row)
    )
    fits = (task < 1 << TASK_BITS) & (row < 1 << ROW_BITS)
    failed = F.raise_error(F.lit("a load has too many tasks or rows in a task for its ids"))
    return (
        df.withColumn("_serial", serial)
        .withColumn("id", F.when(fits, number).otherwise(failed.cast("long")))
        .drop("_serial")
    )


def add_ip_version(df: DataFrame) -> DataFrame:
    fields = fields_of(F.col("value"), IP_VERSION_AT + 1)
    return df.withColumn("ip_version", F.get(fields, F.lit(IP_VERSION_AT)))


def extract(lines: DataFrame, host: str, load: int | None = None) -> DataFrame:
    """Filter the lines, give them ids unless they have some, find the IP version."""
    df = filter_log_lines(lines, host)
    if "id" not in df.columns:
        df = assign_id(df, load)
    return add_ip_version(df)


def _is_version(version: int) -> Column:
    return F.col("ip_version").try_cast("int") == version


def by_ip_version(df: DataFrame, version: int) -> DataFrame:
    """Lines of one IP version; lines with another or no version are in neither."""
    return df.filter(_is_version(version))


def parse_fields(df: DataFrame, names: list[str]) -> DataFrame:
    """Name the fields of a line by position: short lines give nulls, the surplus
    of long lines is ignored."""
    split = df.select("id", fields_of(F.col("value"), len(names)).alias("fields"))
    return split.select(
        "id", *[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )


def _with_time_and_rule(df: DataFrame, header: Column, host: str) -> DataFrame:
    """Add ``_time`` and ``_rule``, the time text and the rule number around the
    names of host and program. The program may carry its process number. A header
    of another form has no rule, and its text as a whole is no time."""
    program = f" {host} filterlog"
    at = F.instr("_header", program)
    after = F.col("_after")
    return (
        df.select("*", header.alias("_header"))
        .select(
            "*",
            F.substring("_header", F.lit(1), at - 1).alias("_before"),
            F.when(
                at > 0, F.substring("_header", at + len(program), F.length("_header"))
            ).alias("_after"),
        )
        .select(
            "*",
            F.when(after.startswith(": "), F.substring(after, F.lit(3), F.length(after)))
            .when(
                after.rlike(PROCESS_NUMBER), F.regexp_replace(after, PROCESS_NUMBER, "")
            )
            .alias("_rule"),
        )
        .select(
            "*",
            F.replace(
                F.when(F.col("_rule").isNotNull(), F.col("_before")).otherwise(
                    F.col("_header")
                ),
                F.lit("  "),
                F.lit(" "),
            ).alias("_time"),
        )
        .drop("_header", "_before", "_after")
    )


def parse_header(df: DataFrame, host: str) -> DataFrame:
    """Split the leading field into the time as text and the rule number."""
    split = _with_time_and_rule(df, F.col("timestamp_rule"), host)
    return split.withColumnsRenamed(
        {"_time": "timestamp", "_rule": "rule_number"}
    ).drop("timestamp_rule")


def parse_timestamp(df: DataFrame, year: int = schema.DEFAULT_YEAR) -> DataFrame:
    return df.withColumn("timestamp", syslog_timestamp(F.col("timestamp"), year))


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty text becomes null in every column but the id."""
    return _map_text(df, blank_to_null)


def clean_whitespace(df: DataFrame) -> DataFrame:
    """Text of white space only becomes null."""
    return _map_text(df, whitespace_to_null)


def _map_text(df: DataFrame, change) -> DataFrame:
    texts = {name for name, kind in df.dtypes if kind == "string" and name != "id"}
    return df.select(
        *[change(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit becomes null."""
    return df.select(
        *[
            F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
            for c in df.columns
        ]
    )


def split_options(df: DataFrame) -> DataFrame:
    return df.withColumn("options", options_list(F.col("options")))


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns without any value. The columns left depend on the data,
    so this runs one aggregation over all rows and brings back a single row."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def _split_lines(df: DataFrame, width: int, host: str) -> DataFrame:
    """Split every line and its header once, for all columns taken from them."""
    split = df.select("id", fields_of(F.col("value"), width).alias("_fields"))
    return _with_time_and_rule(split, F.get("_fields", F.lit(0)), host)


def _typed_columns(
    names: list[str], types: dict[str, str], year: int, blank: Callable | None
) -> dict[str, Column]:
    """Every kept column of a line, typed; ``blank`` treats blank text first."""
    raw = {name: F.get("_fields", F.lit(i)) for i, name in enumerate(names)}
    raw["rule_number"] = F.col("_rule")
    raw["timestamp"] = F.col("_time")
    if blank is not None:
        raw = {name: blank(text) for name, text in raw.items()}
    raw["timestamp"] = syslog_timestamp(raw["timestamp"], year)
    typed = {n: c.try_cast(types[n]) if n in types else c for n, c in raw.items()}
    return {n: c.alias(n) for n, c in typed.items() if n not in schema.UNUSED_FIELDS}


def _v4_columns(year: int, blank: Callable | None, options_as_text: bool = True):
    columns = _typed_columns(schema.V4_FIELDS, schema.V4_TYPES, year, blank)
    convert = options_text if options_as_text else options_list
    columns["options"] = convert(columns["options"]).alias("options")
    return columns


def _v6_columns(year: int, blank: Callable | None) -> dict[str, Column]:
    return _typed_columns(schema.V6_FIELDS, schema.V6_TYPES, year, blank)


def parse_v4(
    df: DataFrame,
    host: str,
    year: int = schema.DEFAULT_YEAR,
    blank_as_null: bool = False,
    options_as_text: bool = True,
) -> DataFrame:
    """Typed IPv4 rows. Blank text stays blank unless ``blank_as_null``;
    ``options`` is the list printed as text unless ``options_as_text`` is off."""
    split = _split_lines(df, len(schema.V4_FIELDS), host)
    blank = blank_to_null if blank_as_null else None
    columns = _v4_columns(year, blank, options_as_text)
    return split.select("id", *[columns[name] for name in schema.V4_COLUMNS[1:]])


def parse_v6(
    df: DataFrame,
    host: str,
    year: int = schema.DEFAULT_YEAR,
    blank_as_null: bool = True,
) -> DataFrame:
    """Typed IPv6 rows, blank text as null unless switched off."""
    split = _split_lines(df, len(schema.V6_FIELDS), host)
    columns = _v6_columns(year, blank_to_null if blank_as_null else None)
    return split.select("id", *[columns[name] for name in schema.V6_COLUMNS[1:]])


def parse_versions(
    df: DataFrame,
    host: str,
    year: int = schema.DEFAULT_YEAR,
    rejects: Observation | None = None,
) -> DataFrame:
    """Both versions in one pass over the text: the columns of the log, and the
    other columns in one struct per version, null where the line is not of it.
    ``rows_of`` and ``log_of`` take flat rows out again.

    Lines that are not understood are counted by ``rejects`` in the same pass, known
    once the result is written: ``lines`` in all, ``short`` ones without a version,
    those of a ``bad_version`` (both are in no table), and of the others those with a
    ``bad_header`` (no rule) and a ``bad_time`` (null).
    """
    split = _split_lines(df, len(schema.V4_FIELDS), host)
    version = F.get("_fields", F.lit(IP_VERSION_AT)).try_cast("int")
    is_v6 = F.coalesce(version == 6, F.lit(False))

    def blank_v6_to_null(text: Column) -> Column:
        return F.when(~(is_v6 & (text == "")), text)

    log = _v4_columns(year, blank_v6_to_null)
    v4 = _v4_columns(year, None)
    v6 = _v6_columns(year, blank_to_null)
    columns = [
        F.col("id"),
        *[log[name] for name in schema.LOG_COLUMNS[1:]],
        F.when(version == 4, F.struct(*_own(v4, schema.V4_COLUMNS))).alias("v4"),
        F.when(version == 6, F.struct(*_own(v6, schema.V6_COLUMNS))).alias("v6"),
    ]
    if rejects is None:
        return split.select(*columns)
    short = F.get("_fields", F.lit(IP_VERSION_AT)).isNull()
    parsed = split.select(*columns, short.alias("_short"), F.col("_rule").isNull().alias("_headless"))
    known = F.coalesce(F.col("ip_version").isin(4, 6), F.lit(False))
    return parsed.observe(
        rejects,
        F.count(F.lit(1)).alias("lines"),
        F.count_if("_short").alias("short"),
        F.count_if(~F.col("_short") & ~known).alias("bad_version"),
        F.count_if(known & F.col("_headless")).alias("bad_header"),
        F.count_if(known & F.col("timestamp").isNull()).alias("bad_time"),
    ).drop("_short", "_headless")


def _own(columns: dict[str, Column], names: list[str]) -> list[Column]:
    return [columns[name] for name in names if name not in schema.LOG_COLUMNS]


def rows_of(parsed: DataFrame, version: int) -> DataFrame:
    """Typed rows of one version, as ``parse_v4`` and ``parse_v6`` give them."""
    rows = parsed.filter(F.col("ip_version") == version)
    return rows.select(*schema.LOG_COLUMNS, f"v{version}.*")


def log_of(parsed: DataFrame) -> DataFrame:
    """Log rows of both versions, without a union of the two."""
    return parsed.filter(F.col("ip_version").isin(4, 6)).select(*schema.LOG_COLUMNS)
