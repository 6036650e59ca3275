"""Firewall log lines and lookup tables made from the given tables.

Every row of ``events`` prints one log line and every row of ``conversations``
one line of another program, so the work grows with the tables. ``oracle.py``
computes the typed columns from ``events`` directly, without the text, so a fault
in parsing shows as a difference. FIXTURES.md lists the formulas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwall.session import new_path, store
from emberwall.sinks import write_csv
from emberwall.sources import read_blocklist, read_geo, read_metadata, read_port_names

HOST = "gw.example"
YEAR = 2024

PORT_POOL = [
    "22", "23", "80", "443", "445", "993", "3478", "8080", "9999", "10005", "49152",
    "50802", "60001", "61337", "0",
]
PROTOCOLS = {
    "click": "tcp", "view": "udp", "error": "icmp", "signup": "sctp", "purchase": "igmp",
}
OPTIONS = {"click": "mss;nop;wscale", "view": "mss;nop;wscale", "signup": "mss"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: Column) -> Column:
    return column.cast("string")


def address(key: Column) -> Column:
    """IPv4 address of a user, customer or supplier number."""
    low = F.pmod(key, F.lit(256))
    middle = F.pmod(F.floor(key / 256), F.lit(256))
    high = F.floor(key / 65536)
    return F.concat_ws(".", F.lit("10"), text(high), text(middle), text(low))


def pick(mapping: dict[str, str], key: Column) -> Column:
    result = F.lit("")
    for name, value in mapping.items():
        result = F.when(key == name, value).otherwise(result)
    return result


def from_pool(number: Column) -> Column:
    pool = F.array(*[F.lit(p) for p in PORT_POOL])
    return F.get(pool, F.pmod(number, F.lit(len(PORT_POOL))).cast("int"))


def dealt(df: DataFrame) -> DataFrame:
    """The tables are single files, so rows are dealt out for the work to come, before any
    of it; by their values, which takes no sort of the rows."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *df.columns)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.get_json_object("props", "$.k").cast("int")
    return dealt(table(spark, sf_dir, "events")).withColumn("k", payload)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    k, user, kind = F.col("k"), F.col("user_id"), F.col("event_type")
    second = F.col("ts").cast("timestamp")
    amount = F.floor("value").cast("int")

    time = F.concat(
        F.date_format(second, "MMM "),
        F.lpad(text(F.dayofmonth(second)), 2, " "),
        F.date_format(second, " HH:mm:ss"),
    )
    time = F.when(k == 6, F.lit("Foo 99 00:00:00")).otherwise(time)
    program = F.when(k == 10, f" {HOST} filterlog[123]: ").otherwise(
        f" {HOST} filterlog: "
    )
    header = F.concat(time, program, text(k))

    def tagged(tag: str, number: Column, of: int) -> Column:
        """A value of a column, unlike those of its neighbours."""
        return F.concat(F.lit(tag), text(F.pmod(number, F.lit(of))))

    v4_line = k < 90
    start = [
        header, F.when(v4_line, tagged("s", k, 30)).otherwise(""),
        F.when(v4_line, tagged("a", user, 9)).otherwise(""),
        F.concat(F.lit("10000"), text(F.floor(k / 20))), tagged("em", user, 4),
    ]
    shared = [
        tagged("r", k, 3), tagged("b", k, 5), F.when(kind == "purchase", "out").otherwise("in"),
    ]
    v4_front = [
        F.when(k == 8, "x").otherwise("4"), tagged("0x", user, 16),
        F.when(k % 2 == 1, "CE").otherwise(""), text(50 + k % 7), text(user * 3 + k),
        text(k % 8), tagged("F", user, 3), text(k + 100), pick(PROTOCOLS, kind),
        text(amount + 20),
    ]
    source_port = (
        F.when(k == 4, "")
        .when(k == 5, " ")
        .when(kind.isin("error", "purchase"), "request")
        .otherwise(from_pool(user + k))
    )
    length = F.when(k == 0, "").when(k == 7, "abc").otherwise(text(amount - 2))
    v4_back = [
        address(user), F.concat(F.lit("192.0.2."), text(F.pmod(user, F.lit(7)))),
        source_port, from_pool(user * 7 + k), length, tagged("S", k, 4),
        text(user * 1000 + k), F.when(k % 3 == 0, "").otherwise(text(k + 7)),
        text(1024 + k), tagged("u", k, 50),
    ]
    v4_end = [pick(OPTIONS, kind), F.when(k == 11, ",more,fields").otherwise("")]
    v6 = [
        F.lit("6"), F.lit(""), text(user * 100 + k), text(1 + k % 9), tagged("U", k, 2),
        text(user % 100), text(amount + 20), F.concat(F.lit("fd00::"), text(user)),
        tagged("ff02::", user, 11),
    ]
    # Null parts are left out of the line, which makes the short ones.
    enough = k != 9
    whole = v4_line & enough & ~k.between(1, 3)
    groups = {
        "start": (F.lit(True), start),
        "shared": (enough, shared),
        "v6": (~v4_line, v6),
        "front": (v4_line & enough, v4_front),
        "back": (whole, v4_back),
        "end": (whole & (kind != "purchase"), v4_end),
    }
    printed = e.select(
        F.col("event_id").alias("id"),
        *[
            F.when(used, F.concat_ws(",", *fields)).alias(name)
            for name, (used, fields) in groups.items()
        ],
    )
    value = F.concat_ws(",", *groups)
    other = dealt(table(spark, sf_dir, "conversations")).select(
        F.lit(None).cast("bigint").alias("id"),
        F.concat(
            F.lit(f"Jan  1 00:00:00 {HOST} sshd[99]: "), F.translate("text", "\n\r", "  ")
        ).alias("value"),
    )
    return printed.select("id", value.alias("value")).unionByName(other)


_PRINTED: dict[tuple[str, str], DataFrame] = {}


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id`` and ``value``: the lines of the firewall and of another program,
    printed once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PRINTED:
        _PRINTED[key] = store(_lines(spark, sf_dir), "log_lines")
    return _PRINTED[key]


_TEXT: dict[tuple[str, str], str] = {}


def log_text(spark: SparkSession, sf_dir: str) -> str:
    """Path of the same lines as text files, without ids."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TEXT:
        path = new_path(spark, "log_text")
        log_lines(spark, sf_dir).select("value").write.text(path)
        _TEXT[key] = path
    return _TEXT[key]


#: Added to the number of an overdrawn customer, whose address then is in no log.
UNKNOWN = 16_000_000


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers with their nation and address; overdrawn ones are unknown to
    the log. Every fifth customer has a second nation, so its address comes twice."""
    customer = table(spark, sf_dir, "customer")
    shift = F.when(F.col("c_acctbal") < -500, UNKNOWN).otherwise(0)
    own = F.struct(F.lit(0).alias("again"), F.col("c_nationkey").alias("key"))
    other = F.struct(
        F.lit(1).alias("again"), F.pmod(F.col("c_nationkey") + 7, F.lit(25)).alias("key")
    )
    places = F.when(F.col("c_custkey") % 5 == 0, F.array(own, other)).otherwise(F.array(own))
    rows = customer.select(
        "*", address(F.col("c_custkey") + shift).alias("ip"), F.inline(places)
    )
    nation = table(spark, sf_dir, "nation")
    return rows.join(nation, F.col("key") == F.col("n_nationkey"))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    status = (
        F.when((segment == "AUTOMOBILE") & (F.col("again") == 0), "timeout")
        .when(segment == "BUILDING", "error")
        .otherwise("ok")
    )
    return _customers(spark, sf_dir).select(
        "ip",
        F.when(status == "ok", F.col("n_name")).alias("country_code"),
        status.alias("status"),
    )


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = F.lit(None).cast("string")
    branch = F.when(F.col("again") == 1, " branch").otherwise("")
    return _customers(spark, sf_dir).select(
        "ip",
        F.concat("c_name", branch).alias("org"),
        nothing.alias("city"),
        F.col("n_name").alias("country"),
        text(F.col("n_regionkey")).alias("region"),
        nothing.alias("postal"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.lower("c_mktsegment")).alias(
            "hostname"
        ),
        nothing.alias("location"),
        F.lit("UTC").alias("timezone"),
    )


def _port_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """port and name; numbers that are both a part and a supplier have two names."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("port"), F.col("p_name").alias("name")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("port"), F.col("s_name").alias("name")
    )
    return part.unionByName(supplier)


def _blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ip and list_name; an address may be on both lists."""
    supplier = table(spark, sf_dir, "supplier")
    ip = address(F.col("s_suppkey")).alias("ip")
    poor = supplier.filter("s_acctbal < 4000").select(ip, F.lit("poor").alias("list_name"))
    near = supplier.filter("s_nationkey < 8").select(ip, F.lit("near").alias("list_name"))
    return poor.unionByName(near)


_FILES: dict[tuple[str, str, str], str] = {}


def _file(spark: SparkSession, sf_dir: str, name: str, make, as_text: bool = False) -> str:
    """Path of a lookup written as CSV with header, or as text, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FILES:
        path = new_path(spark, name)
        df = make(spark, sf_dir)
        df.write.text(path) if as_text else write_csv(df, path)
        _FILES[key] = path
    return _FILES[key]


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_geo(spark, _file(spark, sf_dir, "geo", _geo))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_metadata(spark, _file(spark, sf_dir, "metadata", _metadata))


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of 256, 16 and 4 addresses inside each other, some given twice, by an
    address within them, and some that are none."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    named = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    cidr = {
        "/24": nation.select(address(F.col("n_nationkey") * 256 + 7).alias("ip"), "n_name"),
        "/28": named.select(address(F.col("s_suppkey") * 3).alias("ip"), "n_name"),
        "/30": named.select(address(F.col("s_suppkey") * 7).alias("ip"), "n_name"),
        "/33": named.select(address(F.col("s_suppkey")).alias("ip"), "n_name"),
        "": named.select(address(F.col("s_suppkey")).alias("ip"), "n_name"),
    }
    parts = [
        df.select(F.concat("ip", F.lit(length)).alias("cidr"), F.col("n_name").alias("country_code"))
        for length, df in cidr.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def address_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _file(spark, sf_dir, "blocks", _blocks)
    return spark.read.csv(path, header=True, schema="cidr string, country_code string")


def port_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_port_names(spark, _file(spark, sf_dir, "port_names", _port_names))


def blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lists, each from a file of its own with comment lines and surplus fields."""
    lists = []
    for name in ("poor", "near"):
        def lines(spark, sf_dir, name=name):
            own = _blocklist(spark, sf_dir).filter(F.col("list_name") == name)
            banner = spark.createDataFrame([("# addresses of a list",), ("",)], "value string")
            return banner.unionByName(own.select(F.concat("ip", F.lit(", seen")).alias("value")))

        path = _file(spark, sf_dir, f"blocklist_{name}", lines, as_text=True)
        lists.append(read_blocklist(spark, path, name))
    return lists[0].unionByName(lists[1])
