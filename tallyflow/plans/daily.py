"""Daily billing over any number of days at once: raw, clean, daily usage, daily cost, checks, audit."""

from __future__ import annotations

import datetime as dt_
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.literals import ntz
from ..operators import audit, merge, parse, pricing, quality, usage
from ..schemas import PRODUCTS
from ..session import cleaned, stage
from ..sources import files
from ..sources import lake as lk

JOB = "daily_usage_billing"


def load_raw(
    lake: lk.Lake, landing: str | list[str], *, source: str, batch_id: str | Column, ingest_ts: dt_.datetime | str | Column,
    dt: dt_.date | None = None,
) -> list[str]:
    """Land JSON files in the raw table; loading a batch again replaces all of it. Returns the batches loaded."""
    raw = stage(files.ingest_usage(lake.spark, landing, source=source, batch_id=batch_id, ingest_ts=ingest_ts, dt=dt), "landed")
    batches = _batches(raw)
    named = [batch_id] if isinstance(batch_id, str) else []
    lake.clear(lk.USAGE_RAW, [*batches, *named])
    lake.replace(lk.USAGE_RAW, raw)  # staged above: not written a second time first
    return batches


def _batches(rows: DataFrame) -> list[str]:
    """Batch ids of a load: one per run, or one per file day of a backfill."""
    return sorted(r[0] for r in rows.select("batch_id").where("batch_id IS NOT NULL").distinct().collect())


def bill(
    lake: lk.Lake, raw: DataFrame, customers: DataFrame, rates: DataFrame, *, run_id: str, as_of: dt_.datetime,
    match_plan: bool = True, on_match: str = merge.TOUCH_CHANGED, products: Sequence[str] | None = PRODUCTS,
) -> list[dt_.date]:
    """From raw rows to priced days; returns the days rebuilt.

    Every day that gained or changed an event is rebuilt, also days before the file's own, so late
    events reach their day. Costs are published only after the checks pass. ``products=None``
    skips the check for unknown products.
    """
    began = time.monotonic()
    try:
        with cleaned(lake.spark):
            return _bill(lake, raw, customers, rates, run_id, as_of, match_plan, on_match, products, began)
    except Exception as error:
        failed = audit.run_row(
            lake.spark, run_id=run_id, job=JOB, execution_date=as_of.date(), created_ts=as_of, status="FAILED",
            duration_seconds=time.monotonic() - began, error_message=f"{type(error).__name__}: {error}",
        )
        # The audit is stored by run, so no other run's row is written again.
        known = lake.read(lk.RUN_AUDIT).where((F.col("run_id") == run_id) & ((F.col("job") != JOB) | (F.col("task") != "ALL")))
        lake.replace_values(lk.RUN_AUDIT, known.unionByName(failed), [run_id])
        raise


def _bill(
    lake: lk.Lake, raw: DataFrame, customers: DataFrame, rates: DataFrame, run_id: str, as_of: dt_.datetime,
    match_plan: bool, on_match: str, products: Sequence[str] | None, began: float,
) -> list[dt_.date]:
    checked = parse.classify_usage(raw, products or ())
    if products is None:
        reason = F.when(F.col("error_reason") != "unknown_product", F.col("error_reason"))
        checked = checked.withColumn("error_reason", reason)
    classified = stage(checked, "classified")
    lake.replace_values(lk.QUARANTINE, parse.quarantined(classified), _batches(classified))
    incoming = merge.as_clean(parse.accepted(classified))
    merged, days, observed = merge.counted_merge(lake, incoming, on_match)

    clean = lake.read(lk.USAGE_CLEAN)
    # Filters on the partition column, so only the rebuilt days are read.
    daily = usage.daily_usage(clean, days).select(
        "*", ntz(as_of).alias("load_ts"), F.lit(run_id).alias("batch_id")
    )
    lake.replace_days(lk.USAGE_DAILY, daily, days)

    rebuilt = lake.read(lk.USAGE_DAILY).where(F.col("event_date").isin(days))
    # Only ids that this run wrote can be new duplicates, and only on days whose filters name them.
    written = stage(merged.where(F.col("action") != "keep").select("event_id").distinct(), "written")
    holding = clean.where(F.col("event_date").isin(merge.days_that_may_hold(lake, written)))
    checks = quality.all_checks(
        quality.duplicate_events(holding.join(written, "event_id", "left_semi")), quality.negative_quantity(clean.where(F.col("event_date").isin(days)))
    )
    quality.enforce(checks)
    costs = pricing.daily_cost(rebuilt, customers, rates, match_plan=match_plan).select(
        "*", ntz(as_of).alias("load_ts"), F.lit(run_id).alias("batch_id")
    )
    lake.replace_days(lk.DAILY_COST, costs, days)

    counters = audit.observed_counters(lake.spark, observed).first()
    done = audit.run_row(
        lake.spark, run_id=run_id, job=JOB, execution_date=as_of.date(), created_ts=as_of,
        rows_inserted=counters.rows_inserted, rows_updated=counters.rows_updated, duration_seconds=time.monotonic() - began,
    )
    # A run that failed before and now succeeds replaces its own row.
    failures = (F.col("run_id") == run_id) & (F.col("job") == JOB) & (F.col("status") == "FAILED")
    if not lake.read(lk.RUN_AUDIT).where(failures).isEmpty():
        lake.replace_values(lk.RUN_AUDIT, lake.read(lk.RUN_AUDIT).where((F.col("run_id") == run_id) & ~failures), [run_id])
    lake.append_new(lk.RUN_AUDIT, done, audit.RUN_KEY)
    mark = audit.checkpoint_row(classified, job=JOB, updated_ts=as_of)
    lake.replace_values(lk.CHECKPOINTS, audit.advanced(mark, lake.read(lk.CHECKPOINTS)), [JOB])
    return days


def backfill(
    lake: lk.Lake, landing: str, customers: DataFrame, rates: DataFrame, *, as_of: dt_.datetime,
    ingest_ts: dt_.datetime | str | Column | None = None, match_plan: bool = True, products: Sequence[str] | None = None,
) -> list[dt_.date]:
    """All days of a landing folder in one job, then one audit row per file day.

    Earlier backfills are not read again. ``products`` as for ``bill``.
    The day is a column taken from the file name, not a loop.
    """
    batch = F.concat(F.lit("backfill_"), F.col("dt").cast("string"))
    batches = load_raw(lake, landing, source="BACKFILL", batch_id=batch, ingest_ts=ingest_ts or as_of)
    raw = lake.read(lk.USAGE_RAW).where(F.col("batch_id").isin(batches))  # a partition filter: only what was just loaded
    days = bill(lake, raw, customers, rates, run_id=f"backfill_{as_of:%Y%m%d%H%M%S}", as_of=as_of, match_plan=match_plan, products=products)
    file_days = raw.select("dt").where("dt IS NOT NULL").distinct()
    lake.append_new(lk.RUN_AUDIT, audit.backfill_rows(file_days, job=JOB, created_ts=as_of), audit.RUN_KEY)
    return days
