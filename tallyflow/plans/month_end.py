"""Month-end close: headers, lines, integrity gate, publication."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.literals import date, ntz
from ..operators import invoicing, pricing, quality
from ..session import cleaned, stage
from ..sources import lake as lk


def close_period(
    lake: lk.Lake, rates: DataFrame, start: dt_.date, end: dt_.date, *, run_id: str, issued_ts: dt_.datetime,
    tax_rate: str = "0", customers: DataFrame | None = None, plans: DataFrame | None = None, bill_all: bool = False,
) -> int:
    """Invoice every customer with usage from ``start`` to ``end``; returns the number of invoices.

    Keys are hashes of customer and period, and the period's partitions are replaced, so a rerun
    gives the same invoices again. A period that has adjustments is closed for good: closing it
    again would bill the late usage twice. With ``customers`` and ``plans`` each invoice has a
    base-fee line, which is part of its subtotal, tax and total; with ``customers`` the daily rows
    behind every line are stored as well. A customer billed in two currencies stops the close.
    With ``bill_all`` the fee is owed by customer and month instead: every customer that is not cancelled at
    the end of the month gets an invoice, without usage too, and a plan that is not in ``plans`` stops the close.
    The period is one calendar month then.
    """
    if bill_all and (customers is None or plans is None or start.day != 1 or (end + dt_.timedelta(days=1)) != _next_month(start)):
        raise ValueError("bill_all needs customers, plans and one calendar month")
    with cleaned(lake.spark):
        return _close(lake, rates, start, end, run_id, issued_ts, tax_rate, customers, plans, bill_all)


def _next_month(start: dt_.date) -> dt_.date:
    return (start + dt_.timedelta(days=31)).replace(day=1)


def _close(
    lake: lk.Lake, rates: DataFrame, start: dt_.date, end: dt_.date, run_id: str, issued_ts: dt_.datetime,
    tax_rate: str, customers: DataFrame | None, plans: DataFrame | None, bill_all: bool,
) -> int:
    period = F.col("billing_period_start") == date(start)
    adjusted = lake.read(lk.LINE_ITEMS).where(period & (F.col("line_type") == "adjustment"))
    if not adjusted.isEmpty():
        raise ValueError(f"period {start} has adjustments and cannot be closed again")

    stamp = ntz(issued_ts)
    costs = lake.read(lk.DAILY_COST).where(F.col("date_id").between(date(start), date(end)))
    headers = invoicing.close_headers(costs, start, end, issued_ts=issued_ts, tax_rate=tax_rate).select(
        "*", stamp.alias("load_ts"), F.lit(run_id).alias("batch_id")
    )
    headers = stage(headers, "headers")
    if bill_all:
        owed = stage(invoicing.billable_periods(customers, start, end), "owed")
        quality.enforce(quality.unknown_plans(owed, plans))
        bare = invoicing.headers_without_usage(owed, headers, plans, issued_ts=issued_ts)
        headers = stage(headers.unionByName(bare.select("*", stamp.alias("load_ts"), F.lit(run_id).alias("batch_id"))), "headers")
    lines = invoicing.usage_lines(costs, headers, rates, calc_batch_id=run_id).withColumn("load_ts", stamp)
    if customers is not None and plans is not None:
        fee = pricing.period_fee_lines if bill_all else pricing.base_fee_lines
        fees = stage(fee(headers, owed if bill_all else customers, plans, calc_batch_id=run_id).withColumn("load_ts", stamp), "fees")
        headers = stage(invoicing.with_fees(headers, fees, tax_rate), "headers")
        lines = lines.unionByName(fees)
    lines = stage(lines, "lines")
    quality.enforce(quality.all_checks(
        quality.invoice_integrity(headers, lines), quality.unique(headers, "invoice_id"), quality.unique(lines, "line_item_id"),
        quality.single_currency(costs, "customer_sk"),
    ))
    lake.replace_values(lk.INVOICES, headers, [start])
    lake.replace_values(lk.LINE_ITEMS, lines, [start])
    if customers is not None:
        usage_lines = lines.where(F.col("line_type") == "usage")
        trail = invoicing.audit_trail(usage_lines, headers, customers, lake.read(lk.USAGE_DAILY)).select(
            "*", stamp.alias("created_ts"), date(start).alias("billing_period_start")
        )
        lake.replace_values(lk.BILLING_AUDIT, trail, [start])
    return headers.count()
