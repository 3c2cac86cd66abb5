"""Dense numbers for natural keys: 1, 2, 3, ... over all loads, given out by many tasks without one that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

_ROW_BITS = 33  # monotonically_increasing_id: the task in the upper bits, the row in the lower ones


def numbered(rows: DataFrame, key: str, name: str, after: int = 0) -> DataFrame:
    """``rows``, one per ``key``, with ``name`` running from ``after + 1`` in the order of the key, without gaps.

    Rows are dealt by ranges of the key and written with their place in the task; what comes before a task is a running
    sum over one count per task, the only list that is gathered and broadcast. The written places stay as they are
    when an executor is lost.
    """
    placed = rows.repartitionByRange(key).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id())
    placed = stage(placed, "numbering").withColumn("_task", F.shiftright("_at", _ROW_BITS))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"))
    starts = tasks.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    number = (F.lit(after) + F.col("_before") + place + 1).cast("bigint").alias(name)
    return placed.join(F.broadcast(starts), "_task").select(*rows.columns, number)


def new_numbers(known: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """(key, number) of the ``keys`` that ``known`` lacks: they go on after its largest number.

    Known keys keep their number, so a load that is run again adds nothing. Repeated keys count once, null keys get none.
    ``key`` itself decides, not a hash of it: two keys never share a number.
    """
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")
    largest = known.agg(F.max(name)).first()[0] or 0
    return numbered(fresh, key, name, largest)


def gaps_and_repeats(numbers: DataFrame, key: str, name: str) -> DataFrame:
    """One row: numbers missing between 1 and the largest, numbers given twice, keys numbered twice. All zero when sound."""
    per_number = numbers.groupBy(name).agg(F.count(F.lit(1)).alias("_rows"))
    gaps = per_number.agg(
        (F.coalesce(F.max(name), F.lit(0)) - F.count(F.lit(1))).alias("missing"), F.count_if(F.col("_rows") > 1).alias("repeated_numbers"))
    twice = numbers.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).agg(F.count_if(F.col("_rows") > 1).alias("repeated_keys"))
    return gaps.withColumn("repeated_keys", twice.scalar())
