"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import re
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import NamedTuple
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

#: Settings the library counts on. Log times carry no zone, so the session zone
#: decides their meaning; adaptive execution splits skewed join partitions.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a session with its executors in this process may go without the setting:
    it gets a temporary folder. On a cluster a ``file:`` folder is shared only if it
    is mounted everywhere, which can't be seen from here, so it is warned of.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    alone = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None
    if not named:
        if not alone:
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="emberwall-"))
        named = spark.sparkContext.getCheckpointDir()
    elif not alone and urlsplit(named).scheme == "file":
        warnings.warn(f"{named} must be mounted on all machines of the cluster", stacklevel=2)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/emberwall/{uuid.uuid4().hex}/{name}"


class _Kept(NamedTuple):
    """Something stored on the way: its path, and its table if the catalog has one."""

    path: str
    table: str | None


#: What the innermost ``scratch`` block of this thread has stored.
_SCRATCH: ContextVar[list[_Kept] | None] = ContextVar("emberwall_scratch", default=None)
#: What was stored outside such blocks, by application.
_LEFT: dict[str, list[_Kept]] = {}


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the frame that reads it back.

    This cuts the lineage in a way that survives lost executors. It also gives
    Catalyst the true size of the data: a small result is then broadcast because
    its files are below ``spark.sql.autoBroadcastJoinThreshold``, a large one is
    joined by shuffle, and no hint has to guess which.
    """
    return store_sized(df, name)[0]


def scratch_path(spark: SparkSession, name: str, table: str | None = None) -> str:
    """As ``new_path``, for what a surrounding ``scratch`` block, or else ``clear``, shall
    remove; with ``table``, that table of the catalog too."""
    path = new_path(spark, name)
    block = _SCRATCH.get()
    if block is None:
        block = _LEFT.setdefault(spark.sparkContext.applicationId, [])
    block.append(_Kept(path, table))
    return path


def store_sized(
    df: DataFrame, name: str, compression: str = "snappy"
) -> tuple[DataFrame, int]:
    """As ``store``, and the bytes of the stored files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path), folder_bytes(spark, path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    place, files = _place(spark, path)
    return files.getContentSummary(place).getLength()


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.mkdirs(place)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file; whether there was one."""
    place, files = _place(spark, path)
    return files.delete(place, True)


def _remove_all(spark: SparkSession, stored: list[_Kept]) -> None:
    for path, table in stored:
        if table is not None:
            spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        remove(spark, path.rsplit("/", 1)[0])


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is stored inside when the block ends. Frames that read it are
    of no use after that, so write results elsewhere first. Blocks of different threads
    know nothing of each other."""
    stored: list[_Kept] = []
    outer = _SCRATCH.set(stored)
    try:
        yield
    finally:
        _SCRATCH.reset(outer)
        _remove_all(spark, stored)


def clear(spark: SparkSession) -> None:
    """Remove what this application has stored outside ``scratch`` blocks so far. Frames
    made before, whose operators stored something, are of no use after that."""
    _remove_all(spark, _LEFT.pop(spark.sparkContext.applicationId, []))
