"""Reporting queries. "Today" is always a parameter; filters are column predicates."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import with_details
from ..functions.literals import date
from ..functions.money import total_amount, total_quantity
from ..schemas import AMOUNT

Day = dt_.date | str
INVOICE_COLUMNS = (
    "invoice_id", "customer_sk", "customer_name", "billing_period_start", "billing_period_end", "issued_ts",
    "status", "subtotal", "tax", "total", "currency",
)


def _between(df: DataFrame, column: str, date_from: Day | None, date_to: Day | None) -> DataFrame:
    if date_from is not None:
        df = df.where(F.col(column) >= date(date_from))
    if date_to is not None:
        df = df.where(F.col(column) <= date(date_to))
    return df


def dashboard_summary(
    costs: DataFrame, customers: DataFrame, invoices: DataFrame, events: DataFrame, today: Day, *, as_run: bool = False
) -> DataFrame:
    """Five key figures in one row.

    Revenue and its daily average are both month to date. ``as_run`` gives the figures of the
    dashboard this replaces, which pairs every month-to-date cost row with every day on record:
    revenue is multiplied by the number of days and the average covers all days. Both follow from
    per-day totals, so no rows are paired.
    """
    per_day = costs.groupBy("date_id").agg(total_amount("cost_amount").alias("daily_total"))
    this_month = F.col("date_id") >= F.trunc(date(today), "MONTH")
    month_total = F.sum(F.when(this_month, F.col("daily_total")))
    if as_run:
        revenue = month_total.cast("decimal(28,10)") * F.count(F.lit(1)).cast("decimal(9,0)")
        average = F.when(month_total.isNotNull(), F.try_divide(F.sum("daily_total"), F.count("daily_total")))
    else:
        revenue = month_total
        average = F.try_divide(month_total, F.count(F.when(this_month, F.col("daily_total"))))
    zero = F.lit(0).cast(AMOUNT)
    customer_count = customers.where("is_current").agg(F.countDistinct("customer_id")).scalar()
    invoice_count = invoices.where(F.col("status") == "issued").agg(F.count(F.lit(1))).scalar()
    event_count = events.where(F.col("event_date") == date(today)).agg(F.count(F.lit(1))).scalar()
    figures = per_day.agg(
        F.coalesce(revenue.cast(AMOUNT), zero).alias("total_revenue_mtd"),
        F.coalesce(average.cast("decimal(38,6)"), F.lit(0)).cast("decimal(38,6)").alias("avg_daily_revenue"),
    )
    return figures.select(
        "total_revenue_mtd", customer_count.alias("total_customers"), invoice_count.alias("active_invoices"),
        event_count.alias("total_events_today"), "avg_daily_revenue",
    )


def list_customers(customers: DataFrame, status: str | None = None) -> DataFrame:
    rows = customers.where("is_current")
    if status:
        rows = rows.where(F.col("status") == status)
    return rows.select(
        "customer_sk", "customer_id", "customer_name", "status", "country", "plan_id", "is_current"
    ).orderBy("customer_name", "customer_id")


def customer_usage(
    costs: DataFrame, customers: DataFrame, customer_id: str, date_from: Day | None = None, date_to: Day | None = None
) -> DataFrame:
    """Daily usage of one customer, newest day first.

    All versions of the customer count, so usage billed under an earlier version stays visible.
    """
    keys = customers.where(F.col("customer_id") == customer_id).select("customer_sk")
    rows = _between(costs, "date_id", date_from, date_to).join(keys, "customer_sk", "left_semi")
    return rows.select("date_id", "product_id", "unit", "total_quantity", "cost_amount", "currency").orderBy(
        F.desc("date_id"), "product_id", "unit", "cost_amount"
    )


def _with_names(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    names = customers.where("is_current").select("customer_sk", "customer_id", "customer_name")
    return invoices.join(names, "customer_sk", "left")


def list_invoices(
    invoices: DataFrame, customers: DataFrame, customer_id: str | None = None, status: str | None = None
) -> DataFrame:
    rows = _with_names(invoices, customers)
    if customer_id:
        rows = rows.where(F.col("customer_id") == customer_id)
    if status:
        rows = rows.where(F.col("status") == status)
    return rows.select(*INVOICE_COLUMNS).orderBy(F.desc("issued_ts"), "invoice_id")


def invoice_detail(
    invoices: DataFrame, lines: DataFrame, customers: DataFrame, invoice_id: str | None = None
) -> DataFrame:
    """Header and lines, one row per line, in line order. An unknown id gives no rows.

    Lines stay rows rather than one nested list: an invoice may hold any number of adjustments.
    """
    if invoice_id is not None:
        invoices = invoices.where(F.col("invoice_id") == invoice_id)
        lines = lines.where(F.col("invoice_id") == invoice_id)
    body = lines.select("invoice_id", "line_item_id", "line_type", "product_id", "unit", "quantity", "unit_price", "amount", "load_ts")
    head = _with_names(invoices, customers).select(*INVOICE_COLUMNS)
    return with_details(head, body, "invoice_id", ["line_item_id"]).orderBy("invoice_id", "load_ts", "line_item_id")


def usage_report(
    costs: DataFrame, customers: DataFrame, today: Day, *, customer_id: str | None = None, date_from: Day | None = None,
    date_to: Day | None = None, product_id: str | None = None, days: int | None = None, limit: int | None = None,
) -> DataFrame:
    """Usage by day, product and unit, newest first.

    ``days`` looks back from ``today`` unless ``date_from`` is given, ``limit`` keeps the first rows of a total
    order; without them all rows are reported.
    """
    if days is not None and date_from is None:
        costs = costs.where(F.col("date_id") >= F.date_sub(date(today), days))
    rows = _between(costs, "date_id", date_from, date_to)
    if product_id:
        rows = rows.where(F.col("product_id") == product_id)
    known = customers.where("is_current")
    if customer_id:
        known = known.where(F.col("customer_id") == customer_id)
    grouped = (
        rows.join(known.select("customer_sk"), "customer_sk", "left_semi")
        .groupBy("date_id", "product_id", "unit")
        .agg(
            total_quantity("total_quantity").alias("total_quantity"), total_amount("cost_amount").alias("cost_amount"),
            F.max("currency").alias("currency"),
        )
    )
    if limit is None:
        return grouped
    return grouped.orderBy(F.desc("date_id"), "product_id", "unit").limit(limit)


def latest_runs(audit: DataFrame, limit: int = 10) -> DataFrame:
    return audit.orderBy(F.desc("created_ts"), F.desc("run_id"), "task").limit(limit).select("run_id", "job", "status", "created_ts")


def current_rates(rates: DataFrame) -> DataFrame:
    return rates.where("is_current").select(
        "product_id", "plan_id", "unit", "unit_price", "currency", "effective_from", "effective_to"
    ).orderBy("product_id", "plan_id", "unit", "effective_from")
