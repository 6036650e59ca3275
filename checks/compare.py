"""Run the registered queries and their SQL side by side.

``python -m checks.compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def local_session(cores: int = 8, name: str = "emberwall checks") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def difference(df: DataFrame, connection, sql: str) -> str | None:
    """What differs between the Spark result and the SQL result, or None."""
    answer = connection.execute(sql)
    kinds = {c[0]: str(c[1]) for c in answer.description}
    expected = _rows(list(kinds), answer.fetchall())
    ours = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    if ours != kinds:
        return f"columns differ: {sorted(set(ours.items()) ^ set(kinds.items()))}"
    actual = _rows(df.columns, df.collect())
    if actual != expected:
        more, less = actual - expected, expected - actual
        return (
            f"{sum(more.values())} rows too many, {sum(less.values())} missing of "
            f"{sum(expected.values())}; {list(more)[:2]} / {list(less)[:2]}"
        )
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection, bad = local_session(), connect(sf_dir), 0
    expected = oracle_sql()
    for name, run in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = difference(run(spark, sf_dir), connection, expected[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or 'same'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
