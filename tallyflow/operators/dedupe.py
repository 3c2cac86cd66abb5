"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``.

    Spark turns the rank-equals-one filter into a group limit that runs before the shuffle as
    well: each map task sends at most one row per key, so a key repeated without end costs one
    row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dedupe_events(events: DataFrame) -> DataFrame:
    """Newest delivery per event; equal timestamps are settled by the payload hash."""
    return latest_by(events, ["event_id"], [F.desc("event_ts"), F.desc("raw_hash")])


def latest_customers(snapshots: DataFrame) -> DataFrame:
    """Newest snapshot row per customer; equal load times are settled by the remaining columns."""
    order = [F.desc("ingest_ts"), *[F.desc(c) for c in ("status", "plan_id", "customer_name", "country")]]
    columns = ("customer_id", "customer_name", "status", "country", "plan_id")
    return latest_by(snapshots, ["customer_id"], order).select(*columns)


def latest_rates(rates: DataFrame) -> DataFrame:
    """Newest rate per product and plan."""
    order = [F.desc("ingest_ts"), F.desc("effective_from"), F.desc("unit"), F.desc("unit_price")]
    columns = ("product_id", "plan_id", "unit", "unit_price", "currency", "effective_from", "effective_to")
    return latest_by(rates, ["product_id", "plan_id"], order).select(*columns)
