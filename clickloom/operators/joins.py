"""Joins: null keys that match, and a size check in front of a broadcast."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null, as it does in a grouping.

    The keys of ``left`` are kept.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def estimated_bytes(table: DataFrame) -> int:
    """Spark's estimate from the files behind a table; an unknown size is a large one."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(table: DataFrame) -> bool:
    """Whether Spark puts a table below its broadcast limit."""
    return estimated_bytes(table) <= table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def lookup(table: DataFrame) -> DataFrame:
    """``table`` as the side to broadcast, if it is small.

    A larger table is returned as it is: Spark then sorts both sides and splits the
    partitions of hot keys. Without the hint Spark may broadcast the other side of two
    small ones.
    """
    return F.broadcast(table) if is_small(table) else table


# Bits of the filter below: 4 MB, whatever the number of keys.
FILTER_BITS = 1 << 25


def filter_slot(key: Column, bits: int = FILTER_BITS) -> Column:
    """The bit that stands for a key; slots count from 1, as the bitmap functions do."""
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def key_bits(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of the keys' slots, as (slot, bits): of a fixed size, however many they are."""
    bit = filter_slot(F.col(key))
    return keys.groupBy(F.bitmap_bucket_number(bit).alias("slot")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )


def split_by_bits(rows: DataFrame, key: str, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be among those of ``bits``, and those whose key is not for
    certain. The bitmap is broadcast; no row is shuffled."""
    bit = filter_slot(F.col(key))
    place = F.bitmap_bit_position(bit)
    known = bits.select(F.col("slot").alias("_slot"), F.col("bits").alias("_bits"))
    met = rows.withColumn("_slot", F.bitmap_bucket_number(bit)).join(F.broadcast(known), "_slot", "left")
    byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = met.withColumn("_may", F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False)))
    extra = ["_slot", "_bits", "_may"]
    return marked.where("_may").drop(*extra), marked.where("not _may").drop(*extra)


def without(rows: DataFrame, keys: DataFrame, key: str, bits: DataFrame | None = None) -> DataFrame:
    """``rows`` less those whose ``key`` is among ``keys``; a null key stays.

    Keys below the broadcast limit are broadcast. Of more keys a bitmap picks the rows that
    need be compared, and only these are shuffled. ``bits`` is that of ``key_bits``, where it
    is at hand.
    """
    keys = keys.select(key)
    if is_small(keys):
        return rows.join(F.broadcast(keys), key, "left_anti")
    may, rest = split_by_bits(rows, key, key_bits(keys, key) if bits is None else bits)
    return may.join(keys, key, "left_anti").select(*rows.columns).unionAll(rest.select(*rows.columns))
