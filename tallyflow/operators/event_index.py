"""Bloom filters over event ids, one per group of rows (a day, a micro-batch), so that a lookup reads few groups.

A filter is cut into blocks of 4 KB. An id falls into one block of its group and sets ``PROBES`` bits there. A group
has as many blocks as its ids need, a power of two, so groups of one size share block numbers and an id meets all of
them in one join. The index holds some 4 bytes an id; a filter names a group that lacks an id about six times in a
million, and never misses one that has it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32768  # width of Spark's bitmap functions
IDS_PER_BLOCK = 1024
PROBES = 8
#: Small groups are dealt over this many blocks as well (empty ones are not stored), so that a lookup has no single hot block.
LEAST_BLOCKS = 64


def _bits(key: str) -> Column:
    """Eight places in a block: four times 15 bits of each of two hashes."""
    hashes = [F.xxhash64(F.col(key), F.lit(salt)) for salt in (1, 2)]
    return F.array(*[F.shiftrightunsigned(h, 15 * i).bitwiseAND(BLOCK_BITS - 1) for h in hashes for i in range(PROBES // 2)])


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(3)), blocks)


def build_index(rows: DataFrame, group: str, key: str = "event_id") -> DataFrame:
    """The index of ``rows``: ``group``, ``blocks`` (of the group), ``block``, ``bits``. Rows without an id are left out.

    ``rows`` is read twice, once to count. One row an id is shuffled, by block, so that a large group is spread and each
    bitmap is made where it is stored.
    """
    ids = rows.where(F.col(key).isNotNull()).select(group, key)
    needed = F.ceil(F.log2(F.count(F.lit(1)) / IDS_PER_BLOCK)).cast("int")
    blocks = F.greatest(F.lit(LEAST_BLOCKS), F.pow(F.lit(2), needed)).cast("bigint")
    sizes = ids.groupBy(F.col(group).alias("_group")).agg(blocks.alias("blocks"))
    dealt = ids.join(sizes, F.col(group).eqNullSafe(F.col("_group"))).select(
        group, "blocks", _block(key, F.col("blocks")).alias("block"), _bits(key).alias("places")
    )
    placed = dealt.repartition(group, "blocks", "block").select(group, "blocks", "block", F.explode("places").alias("place"))
    return placed.groupBy(group, "blocks", "block").agg(F.bitmap_construct_agg("place").alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1


def groups_holding(index: DataFrame, ids: DataFrame, group: str, key: str = "event_id") -> DataFrame:
    """Groups of the index that may hold one of ``ids``, distinct. An id meets each group once, in the block it would be in.

    The index grows with all that was ever stored and its bitmaps pack to far less on disk than in memory, so size
    estimates would send it through the driver: the join is a shuffle, by block.
    """
    widths = [r.blocks for r in index.select("blocks").distinct().collect()]  # powers of two: some forty at most
    if not widths:
        return index.select(group)
    wanted = ids.where(F.col(key).isNotNull()).select(
        key, _bits(key).alias("places"), F.explode(F.array(*[F.lit(w).cast("bigint") for w in sorted(widths)])).alias("blocks")
    )
    wanted = wanted.select("blocks", _block(key, F.col("blocks")).alias("block"), "places").alias("w")
    met = index.hint("merge").alias("i").join(wanted, (F.col("i.blocks") == F.col("w.blocks")) & (F.col("i.block") == F.col("w.block")))
    hit = F.lit(True)
    for i in range(PROBES):
        hit = hit & _is_set(F.col("i.bits"), F.col("w.places")[i])
    return met.where(hit).select(F.col(f"i.{group}")).distinct()
