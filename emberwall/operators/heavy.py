"""Lists that are exact without moving all values: top lists by bucket sums, and joins
with long lists behind a bitmap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwall.session import store

#: Buckets values are counted in, and bits of the bitmap of a long list.
BUCKETS, BITS = 1 << 16, 1 << 24
WORD = 64


def top_values(
    df: DataFrame, column: str, k: int, where: Column | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """As ``value_counts`` with ``k``, for columns of very many values, such as spoofed
    addresses, that must not all be shuffled with their counts.

    Values fall into ``buckets`` by their hash, and rows are counted per bucket: at most
    ``buckets`` sums move. No value has more rows than its bucket. The values of the
    fullest ``k`` buckets are counted exactly; their ``k``-th count is a bound that the
    whole list's ``k``-th reaches too, so values of buckets below it can't be in the list.
    Those of all other buckets are counted, and the list is exact, ties included. Where
    few values stand out, a small share of the values moves; where all are alike, the
    bound rules out little and all have to.

    The column is read three times; bucket sums and bound are had when this is called.
    """
    rows = df if where is None else df.filter(where)
    rows = rows.select(column).filter(F.col(column).isNotNull())
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(column), F.lit(buckets)))
    sums = store(bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows")), "buckets")
    first = sums.orderBy(F.desc("_rows"), "_bucket").limit(k)
    least = _counted(bucketed, first, column).orderBy(F.desc("n")).limit(k)
    bound = least.agg(F.min("n"), F.count(F.lit(1))).first()
    chosen = sums
    if bound[1] >= k:
        chosen = sums.filter(F.col("_rows") >= bound[0])
    return _counted(bucketed, chosen, column).orderBy(F.desc("n"), column).limit(k)


def _counted(bucketed: DataFrame, chosen: DataFrame, column: str) -> DataFrame:
    # at most ``buckets`` numbers, so they can go to every task
    kept = bucketed.join(F.broadcast(chosen.select("_bucket")), "_bucket", "left_semi")
    return kept.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def _place(value: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(bits))


def bitmap_of(values: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """(``word``, ``bits``): a bitmap with the bit of each value's hash set, in words of 64
    bits; words without any are left out. Null has a bit like any value."""
    place = _place(F.col(column), bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (place % WORD).cast("int"))
    words = values.select((place / WORD).cast("long").alias("word"), one.alias("bit"))
    return words.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def may_hold(df: DataFrame, column: str, bitmap: DataFrame, out: str, bits: int = BITS) -> DataFrame:
    """``df`` with ``out``: false where the value is surely not among the bitmap's, true
    where it is, or shares a bit with one that is."""
    place = _place(F.col(column), bits)
    listed = bitmap.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    # at most ``bits`` / 64 words
    joined = df.join(F.broadcast(listed), (place / WORD).cast("long") == F.col("_word"), "left")
    bit = F.call_function("shiftright", "_bits", (place % WORD).cast("int")).bitwiseAND(F.lit(1))
    return joined.withColumn(out, F.coalesce(bit == 1, F.lit(False))).drop("_word", "_bits")


def join_long_list(
    df: DataFrame, column: str, listed: DataFrame, key: str, bits: int = BITS
) -> DataFrame:
    """``df`` left-joined to ``listed``, which has one row per ``key`` (null matches null)
    and is too long to be broadcast, so that rows that can't match are not shuffled.

    A bitmap of the list, of ``bits`` bits whatever its length, is broadcast. Rows whose
    bit is not set get nulls where they are; the others are joined. Of rows that don't
    match, about the share of set bits is shuffled too. ``df`` is read twice, so store it
    if it is costly.
    """
    if key in df.columns or set(listed.columns) & set(df.columns):
        raise ValueError("the list's columns must have names of their own")
    marked = may_hold(df, column, store(bitmap_of(listed, key, bits), "bitmap"), "_may", bits)
    others = [c for c in listed.columns if c != key]
    maybe = marked.filter("_may").drop("_may")
    joined = maybe.join(listed, maybe[column].eqNullSafe(listed[key]), "left").drop(key)
    surely_not = marked.filter("NOT _may").drop("_may")
    nulls = [F.lit(None).cast(listed.schema[c].dataType).alias(c) for c in others]
    return joined.select(*df.columns, *others).unionByName(surely_not.select(*df.columns, *nulls))
