"""Late-arrival run: find late events, write their adjustment lines, raise the invoice totals."""

from __future__ import annotations

import datetime as dt_
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.literals import ntz
from ..operators import audit, reconcile
from ..session import stage
from ..sources import lake as lk


JOB = "late_arrivals"


def reconcile_late(
    lake: lk.Lake, customers: DataFrame, rates: DataFrame, *, run_id: str, as_of: dt_.datetime, match_plan: bool = True,
    events: DataFrame | None = None, since_last: bool = False,
) -> DataFrame:
    """Adjust issued invoices for late events; returns the adjustment lines added by this run.

    Adjustment ids are fixed by invoice, event and rate, so an event is adjusted once however often
    the job runs. ``events`` defaults to the whole clean table; a stream passes its own batch. ``since_last`` reads only
    the days that may hold a late event this job has not dealt with, see ``parts_now`` and ``events_of``.
    """
    parts = unread = None
    if events is None and since_last:
        parts = stage(parts_now(lake), "parts")
        unread = sorted(r.part for r in audit.unseen(parts, lake.read(lk.SEEN), JOB).select("part").collect())  # days and months
        events = events_of(lake, unread)
    source = lake.read(lk.USAGE_CLEAN) if events is None else events
    late = stage(reconcile.late_events(source, lake.read(lk.INVOICES), customers), "late")
    candidates = reconcile.price_late_events(late, customers, rates, lake.read(lk.LINE_ITEMS), match_plan=match_plan)
    new_lines = reconcile.adjustment_lines(candidates, calc_batch_id=run_id).withColumn(
        "load_ts", ntz(as_of)
    )
    added = lake.append_new(lk.LINE_ITEMS, new_lines, ["invoice_id", "line_item_id"])
    rebuild_totals(lake, late)
    if parts is not None:
        # A day with a late event that has no rate or no current customer yet stays open. One row per calendar day.
        none = lake.read(lk.LINE_ITEMS).where("false")
        priced = reconcile.price_late_events(late, customers, rates, none, match_plan=match_plan)
        left = late.join(priced.select("event_id", "invoice_id"), ["event_id", "invoice_id"], "left_anti")
        open_days = [f"{DAY} {r.event_date}" for r in left.select("event_date").distinct().collect()]
        done = parts.where(~F.col("part").isin(open_days)) if open_days else parts
        lake.replace_values(lk.SEEN, done.withColumn("job", F.lit(JOB)), [JOB])
    return added


DAY, MONTH = "day", "month"


def parts_now(lake: lk.Lake) -> DataFrame:
    """What the job depends on, as (part, fingerprint): days of the clean table, months of issued invoices.

    Clean days keep their fingerprint beside the table, so no event is read. One row per calendar day and month.
    """
    days = lake.read(lk.DAY_STATE).select(F.concat_ws(" ", F.lit(DAY), F.col("event_date").cast("string")).alias("part"), "fingerprint")
    issued = lake.read(lk.INVOICES).where("status = 'issued'")
    months = audit.fingerprints(issued, "billing_period_start", ["invoice_id", "customer_sk", "billing_period_end", "issued_ts"])
    return days.union(months.select(F.concat_ws(" ", F.lit(MONTH), F.col("billing_period_start").cast("string")), "fingerprint"))


def events_of(lake: lk.Lake, parts: Sequence[str]) -> DataFrame:
    """Clean events of the days in ``parts``, of the periods of the invoice months in it, and of days without a fingerprint.

    All conditions are on the partition column, so other days are not read.
    """
    clean = lake.read(lk.USAGE_CLEAN)
    unknown = {d for d in set(lake.values(lk.USAGE_CLEAN)) - set(lake.values(lk.DAY_STATE)) if d[:1].isdigit()}
    named = {part.split(" ")[1] for part in parts if part.startswith(DAY)} | unknown
    days = sorted(dt_.date.fromisoformat(d) for d in named)
    months = sorted(dt_.date.fromisoformat(part.split(" ")[1]) for part in parts if part.startswith(MONTH))
    periods = lake.read(lk.INVOICES).where(F.col("billing_period_start").isin(months)).groupBy("billing_period_start").agg(F.max("billing_period_end").alias("last"))
    wanted = F.col("event_date").isin(days)
    for period in (periods.collect() if months else []):  # one row per month
        wanted = wanted | F.col("event_date").between(F.lit(period.billing_period_start), F.lit(period.last))
    return clean.where(wanted)


def rebuild_totals(lake: lk.Lake, late: DataFrame) -> None:
    """Headers of the billing months with late events, from their lines. One row per month comes back."""
    months = [r[0] for r in late.select("billing_period_start").distinct().collect()]
    if not months:
        return
    touched = F.col("billing_period_start").isin(months)
    headers = reconcile.headers_from_lines(lake.read(lk.INVOICES).where(touched), lake.read(lk.LINE_ITEMS).where(touched))
    lake.replace(lk.INVOICES, stage(headers, "totals"))
