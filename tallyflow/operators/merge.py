"""Upserts on Parquet tables: a full outer join by key, a choice per column, and a rewrite of touched days."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.keys import numeric_key
from ..functions.literals import ntz
from ..schemas import USAGE_CLEAN
from ..sources import lake as lk
from ..session import stage
from .audit import fingerprints, watched_merge
from .dedupe import dedupe_events
from .event_index import build_index, groups_holding

TOUCH = "touch"  # matched: load stamp, batch and hash move, the first payload stays
TOUCH_CHANGED = "touch_changed"  # as touch, but only where the payload hash differs
REPLACE = "replace"  # matched: the new payload wins
NEWEST = "newest"  # matched: the newer delivery wins, by event time and then payload hash, in whatever order they come

_STAMP = ("load_ts", "batch_id", "raw_hash")


def as_clean(parsed: DataFrame, *, batch_id: str | Column | None = None, load_ts: str | Column | None = None) -> DataFrame:
    """Parsed events in the clean-table shape, stamped with the run that loads them.

    Without ``load_ts`` the row keeps its own ingest time, so a rerun stamps the same value.
    """
    batch = F.col("batch_id") if batch_id is None else (F.lit(batch_id) if isinstance(batch_id, str) else batch_id)
    stamp = ntz(F.col("ingest_ts") if load_ts is None else load_ts)
    stamped = parsed.withColumn("batch_id", batch).withColumn("load_ts", stamp)
    return stamped.select(*USAGE_CLEAN.fieldNames())


def merge_events(
    target: DataFrame, incoming: DataFrame, on_match: str = TOUCH, incoming_is_unique: bool = False
) -> DataFrame:
    """The clean table after merging, one row per event id, with ``action`` insert, update or keep.

    ``incoming`` is reduced to its newest delivery per event first, unless it already is;
    ``target`` is unique by event id.
    """
    source = incoming if incoming_is_unique else dedupe_events(incoming)
    columns = target.columns
    t = target.select(F.struct(*columns).alias("t"), F.col("event_id").alias("t_id"))
    s = source.select(F.struct(*columns).alias("s"), F.col("event_id").alias("s_id"))
    joined = t.join(s, F.col("t_id") == F.col("s_id"), "full_outer")

    new, absent = F.col("t_id").isNull(), F.col("s_id").isNull()
    changed = ~F.col("s.raw_hash").eqNullSafe(F.col("t.raw_hash"))
    if on_match == TOUCH:
        updates, moved = F.lit(True), set(_STAMP)
    elif on_match == TOUCH_CHANGED:
        updates, moved = changed, set(_STAMP)
    elif on_match == REPLACE:
        updates, moved = changed, set(columns)
    elif on_match == NEWEST:
        updates, moved = F.struct("s.event_ts", "s.raw_hash") > F.struct("t.event_ts", "t.raw_hash"), set(columns)
    else:
        raise ValueError(f"unknown on_match: {on_match}")

    def pick(name: str) -> Column:
        kept = F.col(f"t.{name}")
        if name in moved:
            kept = F.when(~absent & updates, F.col(f"s.{name}")).otherwise(kept)
        return F.when(new, F.col(f"s.{name}")).otherwise(kept).alias(name)

    action = F.when(new, "insert").when(~absent & updates, "update").otherwise("keep")
    return joined.select(*[pick(name) for name in columns], action.alias("action"))


def days_that_may_hold(lake: lk.Lake, ids: DataFrame) -> list[dt_.date]:
    """Days of the clean table that may hold one of the event ids, by the stored filters; a day without one counts as such."""
    index = lake.read(lk.EVENT_INDEX)
    unindexed = set(lake.values(lk.USAGE_CLEAN)) - set(lake.values(lk.EVENT_INDEX))
    # One row per calendar day.
    held = [r.event_date for r in groups_holding(index, ids, "event_date").collect()]
    return sorted({*held, *(dt_.date.fromisoformat(d) for d in unindexed if d[:1].isdigit())})


def merge_into_clean(lake: lk.Lake, incoming: DataFrame, on_match: str = TOUCH_CHANGED) -> tuple[DataFrame, list[dt_.date]]:
    """``counted_merge`` without its counters."""
    return counted_merge(lake, incoming, on_match)[:2]


def counted_merge(
    lake: lk.Lake, incoming: DataFrame, on_match: str = TOUCH_CHANGED
) -> tuple[DataFrame, list[dt_.date], Observation]:
    """Merge into the stored clean table, rewriting only touched days.

    Returns the rows written (with ``action``), the days they cover, and the counters taken while they were written. Event ids are unique over all days. Filters
    stored per day name the days that may hold one of the incoming ids; only of those days ids are read, and only days
    that do hold a matched or a new event are read in full and rewritten.

    The filters of a day are written before its rows and cover what it held before as well, so a run that stops in
    between leaves filters that name too much, never too little.
    """
    target = lake.read(lk.USAGE_CLEAN)
    source = stage(dedupe_events(incoming), "incoming")
    maybe = target.where(F.col("event_date").isin(days_that_may_hold(lake, source)))
    matched_days = maybe.select("event_id", "event_date").join(source.select("event_id"), "event_id", "left_semi")
    days = matched_days.select("event_date").union(source.select("event_date")).distinct()
    # One row per calendar day touched.
    touched = sorted(r.event_date for r in days.collect())
    before = target.where(F.col("event_date").isin(touched))
    watched, counters = watched_merge(merge_events(before, source, on_match, incoming_is_unique=True))
    merged = stage(watched, "merged")
    held = merged.select("event_date", "event_id")
    if on_match in (REPLACE, NEWEST):
        held = held.union(before.select("event_date", "event_id")).distinct()
    lake.replace(lk.EVENT_INDEX, build_index(held, "event_date"))
    if on_match in (REPLACE, NEWEST):
        # A replaced event may move to another day, so a day it leaves can end up empty.
        lake.replace_days(lk.USAGE_CLEAN, merged.drop("action"), touched)
    else:
        lake.replace(lk.USAGE_CLEAN, merged.drop("action"))
    # After the rows: a run that stops before this is repaired when it is run again, as every day it touches gets its state.
    lake.replace_days(lk.DAY_STATE, fingerprints(merged, "event_date", USAGE_CLEAN.fieldNames()), touched)
    return merged, touched, counters


def upsert_customers(dim: DataFrame, incoming: DataFrame, as_of: str | dt_.datetime) -> DataFrame:
    """Overwrite name, status and plan of known customers, keep their country, add new ones.

    ``incoming`` holds one row per customer. The one-version form of the dimension; the history
    form is ``dimensions.apply_snapshot``.
    """
    key = numeric_key("s.customer_id")  # as in the history form
    s = incoming.alias("s")
    d = dim.alias("d")
    joined = d.join(s, F.col("d.customer_id") == F.col("s.customer_id"), "full_outer")
    seen, new = F.col("s.customer_id").isNotNull(), F.col("d.customer_id").isNull()

    def overwritten(name: str) -> Column:
        return F.when(seen, F.col(f"s.{name}")).otherwise(F.col(f"d.{name}")).alias(name)

    return joined.select(
        F.when(new, key).otherwise(F.col("d.customer_sk")).alias("customer_sk"),
        F.coalesce("d.customer_id", "s.customer_id").alias("customer_id"),
        overwritten("customer_name"), overwritten("status"),
        F.when(new, F.col("s.country")).otherwise(F.col("d.country")).alias("country"),
        overwritten("plan_id"),
        F.when(new, ntz(as_of)).otherwise(F.col("d.effective_start")).alias("effective_start"),
        F.when(seen, F.lit(True)).otherwise(F.col("d.is_current")).alias("is_current"),
    )
