"""Invoices, line items, audit trail and document rows."""

from __future__ import annotations

import datetime as dt_
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.joins import keyed_join, with_details
from ..functions.keys import surrogate_key
from ..functions.literals import date, ntz
from ..functions.money import share_of, total_amount, total_quantity
from ..schemas import AMOUNT, PRICE
from .usage import in_months, monthly_customer_cost, monthly_product_cost, weighted_price


#: Customers that owe a base fee: all but cancelled ones.
BILLED_STATUSES = ("active", "delinquent")


def previous_month(run_date: dt_.date) -> tuple[dt_.date, dt_.date]:
    """First and last day of the calendar month before ``run_date``."""
    last = run_date.replace(day=1) - dt_.timedelta(days=1)
    return last.replace(day=1), last


def previous_month_columns(day: Column) -> tuple[Column, Column]:
    """The same bounds as columns."""
    before = F.add_months(day, -1)
    return F.trunc(before, "MONTH"), F.last_day(before)


def _header(rows: DataFrame, issued_ts: dt_.datetime | str, tax: Column, total: Column) -> DataFrame:
    """Header columns over rows that carry customer, period, subtotal and currency."""
    return rows.select(
        "*", surrogate_key("customer_sk", "billing_period_start").alias("invoice_id"), ntz(issued_ts).alias("issued_ts"),
        tax.cast(AMOUNT).alias("tax"), total.cast(AMOUNT).alias("total"),
    ).selectExpr(
        "invoice_id", "customer_sk", "billing_period_start", "billing_period_end", "issued_ts", "'issued' AS status", "subtotal",
        "tax", "total", "currency",
    )


def close_headers(
    costs: DataFrame, start: dt_.date | str, end: dt_.date | str, *, issued_ts: dt_.datetime | str, tax_rate: str = "0"
) -> DataFrame:
    """One invoice per customer with usage in the period; zero totals stay."""
    first, last = date(start), date(end)
    totals = (
        costs.where(F.col("date_id").between(first, last))
        .groupBy("customer_sk")
        .agg(total_amount("cost_amount").alias("subtotal"), F.max("currency").alias("currency"))
        .select("*", first.alias("billing_period_start"), last.alias("billing_period_end"))
    )
    tax = share_of(F.col("subtotal"), tax_rate)
    return _header(totals, issued_ts, tax, F.col("subtotal") + tax)


def with_fees(headers: DataFrame, fees: DataFrame, tax_rate: str = "0") -> DataFrame:
    """Headers with their fee lines in subtotal, tax and total."""
    sums = fees.groupBy("invoice_id").agg(total_amount("amount").alias("_fee"))
    joined = headers.join(sums, "invoice_id", "left")
    subtotal = (F.col("subtotal") + F.coalesce("_fee", F.lit(0).cast(AMOUNT))).cast(AMOUNT)
    added = joined.withColumn("subtotal", subtotal).withColumn("tax", share_of(F.col("subtotal"), tax_rate))
    return added.withColumn("total", (F.col("subtotal") + F.col("tax")).cast(AMOUNT)).select(*headers.columns)


def billable_periods(
    customers: DataFrame, first: dt_.date | str, last: dt_.date | str, statuses: Sequence[str] = BILLED_STATUSES
) -> DataFrame:
    """One row per customer and calendar month from ``first`` to ``last`` that owes a base fee, used or not.

    A month is billed by the version that holds when it ends: ``plan_id`` is that version's, a customer that is
    cancelled by then or comes later owes none. ``customers`` are versions with half-open intervals; without
    ``effective_end`` a version holds from its start on.
    """
    months = F.sequence(F.trunc(date(first), "MONTH"), date(last), F.make_ym_interval(months=F.lit(1)))
    ends = F.col("effective_end") if "effective_end" in customers.columns else F.lit(None).cast("timestamp_ntz")
    monthly = customers.select(
        "customer_sk", "customer_id", "plan_id", "status", "effective_start", ends.alias("effective_end"),
        F.explode(months).alias("billing_period_start"),
    ).withColumn("billing_period_end", F.last_day("billing_period_start"))
    over = F.date_add("billing_period_end", 1).cast("timestamp_ntz")
    holds = (F.col("effective_start") < over) & (F.col("effective_end").isNull() | (F.col("effective_end") >= over))
    return monthly.where(holds & F.col("status").isin(*statuses)).select(
        "customer_sk", "customer_id", "plan_id", "billing_period_start", "billing_period_end"
    )


def headers_without_usage(billable: DataFrame, headers: DataFrame, plans: DataFrame, *, issued_ts: dt_.datetime | str) -> DataFrame:
    """Invoices over nothing for customers and months that owe a fee and have no invoice; in the plan's currency."""
    bare = billable.join(headers.select("customer_sk", "billing_period_start"), ["customer_sk", "billing_period_start"], "left_anti")
    priced = bare.join(plans.select("plan_id", "currency"), "plan_id").select(
        "customer_sk", F.lit(0).cast(AMOUNT).alias("subtotal"), "currency", "billing_period_start", "billing_period_end"
    )
    return _header(priced, issued_ts, F.lit(0), F.lit(0))


def recent_month_headers(
    costs: DataFrame, today: dt_.date | str, *, issued_ts: dt_.datetime | str, months: int = 2, tax_rate: str = "0.08"
) -> DataFrame:
    """Invoices for this month and the ``months`` before it; tax and total rounded to cents, zero totals skipped."""
    since = F.add_months(F.trunc(date(today), "MONTH"), -months)
    totals = monthly_customer_cost(costs.where(F.col("date_id") >= since)).where("subtotal > 0")
    gross = str(1 + Decimal(tax_rate))
    return _header(totals, issued_ts, share_of(F.col("subtotal"), tax_rate), share_of(F.col("subtotal"), gross))


def model_headers(costs: DataFrame, *, issued_ts: dt_.datetime | str) -> DataFrame:
    """Invoices per customer and month over all dates, no tax, zero totals skipped."""
    totals = monthly_customer_cost(costs).where("subtotal > 0")
    return _header(totals, issued_ts, F.lit(0), F.col("subtotal"))


def usage_lines(
    costs: DataFrame, headers: DataFrame, rates: DataFrame, *, calc_batch_id: str, split_by_rate: bool = True
) -> DataFrame:
    """Usage lines of the given invoices, one per product, unit and, with ``split_by_rate``, rate.

    Costs meet the invoices of their customer, few rows each, with the period as residual. Prices
    are looked up after the aggregation, on one row per invoice, product, unit and rate.
    """
    periods = headers.select("invoice_id", "customer_sk", "billing_period_start", "billing_period_end")
    inside = F.col("l.date_id").between(F.col("r.billing_period_start"), F.col("r.billing_period_end"))
    billed = keyed_join(costs, periods, ["customer_sk"], inside)
    keys = ["invoice_id", "billing_period_start", "product_id", "unit"]
    per_rate = billed.groupBy(*keys, "rate_sk").agg(
        total_quantity("billable_quantity").alias("quantity"), total_amount("cost_amount").alias("amount"),
        F.min("date_id").alias("usage_window_start"), F.max("date_id").alias("usage_window_end"),
        F.count(F.lit(1)).alias("rows"),
    ).join(rates.select("rate_sk", "unit_price"), "rate_sk", "left")
    if split_by_rate:
        lines = per_rate.withColumn("unit_price", F.col("unit_price").cast(PRICE))
        line_key = surrogate_key("invoice_id", "'usage'", "product_id", "unit", "rate_sk")
    else:
        lines = per_rate.groupBy(*keys).agg(
            total_quantity("quantity").alias("quantity"), total_amount("amount").alias("amount"),
            F.min("usage_window_start").alias("usage_window_start"),
            F.max("usage_window_end").alias("usage_window_end"),
            weighted_price().alias("unit_price"), F.max("rate_sk").alias("rate_sk"),
        )
        line_key = surrogate_key("invoice_id", "'usage'", "product_id", "unit")
    return lines.select(
        "invoice_id", line_key.alias("line_item_id"), F.lit("usage").alias("line_type"), "product_id", "unit",
        "quantity", "unit_price", "amount", "rate_sk", "usage_window_start", "usage_window_end",
        F.lit(calc_batch_id).alias("calc_batch_id"), "billing_period_start",
    )


def model_lines(costs: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines per invoice, product and unit with a blended price; zero amounts are skipped.

    Costs are dealt by customer and month once, for the lines and for their invoices. A customer's month holds one row a
    day, product, unit and rate, and its lines meet their invoice in one task anyway.
    """
    monthly = monthly_product_cost(in_months(costs).repartition("customer_sk", "billing_period_start")).where("amount > 0")
    owners = headers.select("invoice_id", "customer_sk", "billing_period_start")
    # Decimal division keeps six decimals here and rounds half up, so no binary rounding enters.
    blended = F.when(F.col("quantity") > 0, F.try_divide("amount", "quantity")).otherwise(F.lit(0))
    return monthly.join(owners, ["customer_sk", "billing_period_start"]).select(
        surrogate_key("invoice_id", "product_id", "unit").alias("line_item_id"), "invoice_id",
        F.lit("usage").alias("line_type"), "product_id", "unit", "quantity",
        blended.cast("decimal(18,6)").alias("unit_price"), "amount", "currency",
    )


def daily_row_hash() -> Column:
    """Fingerprint of one daily aggregate row."""
    return surrogate_key("event_date", "customer_id", "product_id", "unit", "total_quantity", "event_count")


def audit_trail(lines: DataFrame, headers: DataFrame, customers: DataFrame, daily: DataFrame) -> DataFrame:
    """Every line item with the daily aggregate rows behind it."""
    owner = headers.select("invoice_id", "customer_sk").join(customers.select("customer_sk", "customer_id").distinct(), "customer_sk")
    owned = lines.select(
        "invoice_id", "line_item_id", "product_id", "unit", "rate_sk", "calc_batch_id",
        "usage_window_start", "usage_window_end",
    ).join(owner.drop("customer_sk"), "invoice_id")
    rows = daily.select(
        "customer_id", "product_id", "unit", "event_date", F.col("batch_id").alias("source_batch_id"),
        daily_row_hash().alias("agg_row_hash"),
    )
    inside = F.col("l.event_date").between(F.col("r.usage_window_start"), F.col("r.usage_window_end"))
    traced = keyed_join(rows, owned, ["customer_id", "product_id", "unit"], inside)
    return traced.select(
        "invoice_id", "line_item_id", "customer_id", "product_id", "event_date", "source_batch_id",
        "agg_row_hash", "rate_sk", "calc_batch_id",
    )


def invoice_document(headers: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Display rows of invoices: header strings repeated on each line, ready to lay out.

    One row per line, not one nested list per invoice, so an invoice with very many lines is
    never gathered in one task.
    """
    names = customers.where("is_current").select("customer_sk", "customer_id", "customer_name")
    head = headers.join(names, "customer_sk", "left").select(
        "invoice_id", F.concat(text.short_id(F.col("invoice_id"), 16), F.lit("...")).alias("invoice_label"),
        F.upper("status").alias("status_label"),
        F.concat_ws(" to ", F.col("billing_period_start").cast("string"), F.col("billing_period_end").cast("string")).alias("period"),
        F.col("issued_ts").cast("date").cast("string").alias("issued"),
        F.coalesce("customer_name", F.lit("N/A")).alias("bill_to"),
        F.coalesce("customer_id", F.col("customer_sk").cast("string")).alias("customer_label"),
        text.money_text(F.col("subtotal")).alias("subtotal_text"), text.money_text(F.col("tax")).alias("tax_text"),
        F.concat_ws("  ", text.money_text(F.col("total")), F.coalesce("currency", F.lit("USD"))).alias("total_text"),
    )
    body = lines.select(
        "invoice_id", "line_item_id", text.product_label(F.col("product_id")).alias("product"),
        F.coalesce("line_type", F.lit("usage")).alias("type"), text.fixed_text(F.col("quantity"), 2).alias("quantity_text"),
        "unit", text.money_text(F.col("unit_price"), 4).alias("unit_price_text"),
        text.money_text(F.col("amount")).alias("amount_text"),
    )
    return with_details(head, body, "invoice_id", ["line_item_id"])
