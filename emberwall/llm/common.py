"""Helpers the operators share: text columns as bytes, result columns, blocks."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberwall.session import folder_bytes, scratch_path, store

Rows = Iterator[pa.RecordBatch]


def column_bytes(column: pa.Array) -> list[bytes]:
    """Whole texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def column_texts(column: pa.Array) -> list[str]:
    """Whole texts; null is empty, bytes that are no UTF-8 become U+FFFD."""
    return [x.decode("utf-8", "replace") for x in column_bytes(column)]


def worker_memory(name: str) -> dict:
    """A dictionary that lasts as long as the Python worker, for what tasks after one
    another can use again. Users of it must bound its size; asking for one name
    gives up what is remembered under others."""
    own = sys.modules.setdefault("emberwall_worker_memory", types.ModuleType("memory"))
    held = own.__dict__.setdefault("held", {})
    for other in [x for x in held if x != name]:
        del held[other]
    return held.setdefault(name, {})


def give_back() -> None:
    """Return memory that is free but held by the allocators of this worker, where
    the C library can. Workers last longer than tasks, and what one task needed at
    its peak would else count against the next one's executor."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, run: Callable[[Rows], Rows], schema) -> DataFrame:
    """``df.mapInArrow`` whose tasks give memory back when they end."""

    def tidy(batches: Rows) -> Rows:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(tidy, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores put before it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def struct_of(fields: Sequence[tuple[str, pa.Array]]) -> pa.StructArray:
    return pa.StructArray.from_arrays([a for _, a in fields], [n for n, _ in fields])


def with_result(
    docs: DataFrame,
    out: str,
    fields: str,
    prepare: Callable[[], Callable[[pa.RecordBatch], list[tuple[str, pa.Array]]]],
    keep: Sequence[str] | None = None,
    remembers: bool = False,
) -> DataFrame:
    """``docs`` with one more struct column ``out``, computed batch by batch. Of
    the columns of ``docs`` only those in ``keep`` are returned, by default all.

    ``prepare`` runs once per task and returns the function of a batch. A struct
    keeps the new fields apart from columns of the same name in ``docs``. Unless it
    ``remembers``, a worker's memory of other operators is given up.
    """
    kind = T.StructType.fromDDL(fields)
    kept = range(len(docs.columns)) if keep is None else [docs.columns.index(c) for c in keep]
    schema = T.StructType([*[docs.schema[i] for i in kept], T.StructField(out, kind)])

    def run(batches: Rows) -> Rows:
        if not remembers:
            worker_memory("")
        compute = prepare()
        for batch in batches:
            result = struct_of(compute(batch))
            columns = [batch.column(i) for i in kept]
            yield pa.RecordBatch.from_arrays([*columns, result], names)

    names = [*[docs.columns[i] for i in kept], out]
    return map_batches(docs, run, schema)


#: Stored bytes of blocks for which there is a shard.
SHARD_BYTES = 16 << 20


def pack_blocks(
    docs: DataFrame, text: str, block_bytes: int, shard_bytes: int = SHARD_BYTES
) -> tuple[DataFrame, int]:
    """Store ``docs`` in the shared folder as blocks: rows (``block``, ``docs``),
    where ``docs`` is an array of the rows of the input, in all about
    ``block_bytes`` of text (one longer text makes a block of its own). Also returns how
    many shards the blocks' messages should go to: one for every ``shard_bytes`` that the
    blocks take, so that what a shard holds doesn't grow with the data, but at least as
    many as a shuffle has parts.

    Blocks get their numbers once, as they are written, so later jobs agree on
    them even if tasks run again. The table is bucketed by ``block``: what other
    tasks find out about a block is joined to it without moving the text.
    """
    spark = docs.sparkSession
    at = docs.columns.index(text)
    kind = T.StructType([T.StructField("block", T.LongType())])
    kind = kind.add("docs", T.ArrayType(docs.schema))

    def run(batches: Rows) -> Rows:
        from pyspark import TaskContext

        worker_memory("")
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            rows = table.to_struct_array().combine_chunks()
            if isinstance(rows, pa.ChunkedArray):
                rows = rows.chunk(0)
            offsets = pa.array([0, len(rows)], pa.int32())
            packed = pa.ListArray.from_arrays(offsets, rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), packed], ["block", "docs"]
            )

        for batch in batches:
            lengths = [len(x) for x in column_bytes(batch.column(at))]
            start = 0
            for i, length in enumerate(lengths):
                if size and size + length > block_bytes:
                    held.append(batch.slice(start, i - start))
                    yield block()
                    number, held, size, start = number + 1, [], 0, i
                size += length + 1
            held.append(batch.slice(start))
        if size:
            yield block()

    parts = shuffle_parts(docs)
    blocks, size = store_bucketed(map_batches(docs, run, kind), "block", parts)
    return blocks, max(parts, -(-size // shard_bytes))


def write_bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """As ``store_bucketed``, without the size."""
    return store_bucketed(df, key, buckets)[0]


def store_bucketed(df: DataFrame, key: str, buckets: int) -> tuple[DataFrame, int]:
    """Write to the shared folder, bucketed by ``key``; what reads it, and its size in
    bytes. The table is in the
    catalog until a surrounding ``scratch`` block, or ``clear``, removes it."""
    spark = df.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, key)
    path = scratch_path(spark, name, table=name)
    writer.option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name), folder_bytes(spark, path)


def block_rows(packed: pa.Array) -> pa.RecordBatch:
    """The rows of one block, of the ``docs`` array column with a single row."""
    rows = packed.flatten()
    return pa.RecordBatch.from_arrays(rows.flatten(), [f.name for f in rows.type])


def shuffle_parts(df: DataFrame) -> int:
    """How many parts a shuffle has here; set it to suit the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ask_shards(
    messages: DataFrame, answer: Callable[[pa.Table], pa.Table], column: str
) -> DataFrame:
    """Let each shard answer the messages (``block``, ``shard``, ...) sent to it, and
    put the answers together by block: rows (``block``, ``column``), where ``column`` is
    an array of (``shard``, ``reply``). The answers are stored in the shared folder."""
    replies = messages.groupBy("shard").applyInArrow(
        answer, "block long, shard int, reply binary"
    )
    by_block = replies.groupBy("block").agg(
        F.collect_list(F.struct("shard", "reply")).alias(column)
    )
    return store(by_block, column)


def replies(table: pa.Table, parts: list[bytes]) -> pa.Table:
    """One reply to each message of ``table``."""
    return pa.Table.from_arrays(
        [table.column("block"), table.column("shard"), pa.array(parts, pa.binary())],
        ["block", "shard", "reply"],
    )


def replace_text(df: DataFrame, text: str, result: str, kept: str, changed: str) -> DataFrame:
    """``df`` with the bytes ``kept`` of the struct column ``result`` as text where its
    field ``changed`` is not 0; bytes that are no whole character are left out."""
    at, where = df.columns.index(text), df.columns.index(result)

    def run(batches: Rows) -> Rows:
        for batch in batches:
            found = batch.column(where)
            new = [
                value if not n else cut.decode("utf-8", "ignore")
                for value, n, cut in zip(
                    batch.column(at).to_pylist(),
                    found.field(changed).to_pylist(),
                    found.field(kept).to_pylist(),
                )
            ]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_batches(df, run, df.schema)
