"""Late arrivals: events loaded after the invoice of their period was issued."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import keyed_join, skew_join
from ..functions.keys import surrogate_key
from ..functions.money import amount_of, total_amount, total_quantity
from ..schemas import AMOUNT, PRICE, TOTAL_QUANTITY
from ..session import stage
from .pricing import with_rate

EVENT_COLUMNS = ("event_id", "event_date", "customer_id", "product_id", "unit", "quantity", "load_ts")


def late_events(events: DataFrame, invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """Events inside an issued invoice's period whose load time is after the issue time.

    The invoice's customer id comes from a join on the customer key. Events meet the few invoices of their
    customer; they are not aggregated here, so a customer with most of the late events is split by the skew join.
    """
    issued = invoices.where(F.col("status") == "issued").select(
        "invoice_id", "customer_sk", "billing_period_start", "billing_period_end", "issued_ts"
    )
    periods = issued.join(customers.select("customer_sk", "customer_id").distinct(), "customer_sk")
    late = F.col("l.event_date").between(F.col("r.billing_period_start"), F.col("r.billing_period_end")) & (
        F.col("l.load_ts") > F.col("r.issued_ts")
    )
    # Nothing loaded before the first invoice was issued can be late: cut it before the shuffle.
    first_issue = issued.agg(F.min("issued_ts")).scalar()
    # Staged, as the skew join reads it twice: ``events`` may be a whole batch that is still to be deduplicated.
    stamped = stage(events.where(F.col("load_ts") > first_issue).select(*EVENT_COLUMNS), "stamped")
    joined = skew_join(stamped, periods, ["customer_id"], ["event_id"], late)
    return joined.select(
        "event_id", "event_date", "customer_id", "product_id", "quantity", "unit", "invoice_id", "customer_sk",
        "billing_period_start", "issued_ts",
    )


def adjustment_key() -> Column:
    """Line id of an adjustment: the same event and rate on the same invoice give the same id."""
    return surrogate_key("invoice_id", "'adjustment'", "event_id", "rate_sk")


def price_late_events(
    late: DataFrame, customers: DataFrame, rates: DataFrame, lines: DataFrame, *,
    match_plan: bool = True, skip_adjusted: bool = True,
) -> DataFrame:
    """Adjustment candidates: late events of current customers with their rate and amount.

    ``skip_adjusted`` leaves out events whose adjustment line exists already. Without it the guard
    looks for lines of type 'adjustment_ref' carrying the event id, a type nothing writes.
    """
    current = customers.where("is_current").select("customer_sk", "plan_id")
    planned = skew_join(late, current, ["customer_sk"], ["event_id"])
    priced = with_rate(planned, rates, match_plan=match_plan, spread_on=("event_id",)).select(
        "event_id", "event_date", "invoice_id", "billing_period_start", "product_id", "unit", "quantity",
        "unit_price", amount_of(F.col("quantity"), F.col("unit_price")).alias("adjustment_amount"), "rate_sk",
        adjustment_key().alias("line_item_id"),
    )
    if skip_adjusted:
        done = lines.where(F.col("line_type") == "adjustment").select("invoice_id", "line_item_id")
        return priced.join(done, ["invoice_id", "line_item_id"], "left_anti").select(*priced.columns)
    # left_anti, not NOT IN: a null line id must not empty the result.
    done = lines.where(F.col("line_type") == "adjustment_ref").select(F.col("line_item_id").alias("event_id")).distinct()
    return priced.join(done, "event_id", "left_anti").select(*priced.columns)


def adjustment_lines(candidates: DataFrame, *, calc_batch_id: str) -> DataFrame:
    """One adjustment line per late event and rate, its window being the event's day."""
    return candidates.select(
        "invoice_id", "line_item_id", F.lit("adjustment").alias("line_type"), "product_id", "unit",
        F.col("quantity").cast(TOTAL_QUANTITY).alias("quantity"), F.col("unit_price").cast(PRICE).alias("unit_price"),
        F.col("adjustment_amount").alias("amount"), "rate_sk", F.col("event_date").alias("usage_window_start"),
        F.col("event_date").alias("usage_window_end"), F.lit(calc_batch_id).alias("calc_batch_id"),
        "billing_period_start",
    )


def adjusted_headers(headers: DataFrame, new_lines: DataFrame) -> DataFrame:
    """Headers with the adjustments of one run added to subtotal and total."""
    sums = (
        new_lines.where(F.col("line_type") == "adjustment")
        .groupBy("invoice_id").agg(total_amount("amount").alias("_added"))
    )
    added = F.coalesce("_added", F.lit(0).cast(AMOUNT))
    return (
        headers.join(sums, "invoice_id", "left")
        .withColumn("subtotal", (F.col("subtotal") + added).cast(AMOUNT))
        .withColumn("total", (F.col("total") + added).cast(AMOUNT))
        .select(*headers.columns)
    )


def headers_from_lines(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Headers whose subtotal is the sum of their usage, fee and adjustment lines; total moves by the same amount.

    Gives the same headers however often it runs, so a run broken between writing lines and
    totals is repaired by the next one.
    """
    sums = (
        lines.where(F.col("line_type").isin("usage", "adjustment", "base_fee"))
        .groupBy("invoice_id").agg(total_amount("amount").alias("_sum"))
    )
    subtotal = F.coalesce("_sum", "subtotal")
    return (
        headers.join(sums, "invoice_id", "left")
        .withColumn("total", (F.col("total") + subtotal - F.col("subtotal")).cast(AMOUNT))
        .withColumn("subtotal", subtotal.cast(AMOUNT))
        .select(*headers.columns)
    )


def price_differences(costs: DataFrame, headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Recomputed minus billed amount per invoice, product and unit; equal groups are left out.

    ``costs`` is the daily cost fact recomputed with everything known now; ``lines`` are all
    usage and adjustment lines billed so far. Days join the period they lie in, whatever its bounds.
    """
    periods = headers.select("invoice_id", "customer_sk", "billing_period_start", "billing_period_end")
    inside = F.col("l.date_id").between(F.col("r.billing_period_start"), F.col("r.billing_period_end"))
    per_day = costs.groupBy("customer_sk", "date_id", "product_id", "unit").agg(
        total_quantity("billable_quantity").alias("quantity"), total_amount("cost_amount").alias("amount")
    )
    keys = ["invoice_id", "product_id", "unit"]
    now = keyed_join(per_day, periods, ["customer_sk"], inside).groupBy(*keys).agg(
        total_quantity("quantity").alias("_q_now"), total_amount("amount").alias("_now")
    )
    billed = (
        lines.where(F.col("line_type").isin("usage", "adjustment"))
        .groupBy(*keys)
        .agg(total_quantity("quantity").alias("_q_billed"), total_amount("amount").alias("_billed"))
    )
    zero, none = F.lit(0).cast(AMOUNT), F.lit(0).cast(TOTAL_QUANTITY)
    return (
        now.join(billed, keys, "full_outer")
        .select(
            *keys, F.coalesce("_now", zero).alias("recomputed_amount"), F.coalesce("_billed", zero).alias("billed_amount"),
            (F.coalesce("_q_now", none) - F.coalesce("_q_billed", none)).cast(TOTAL_QUANTITY).alias("quantity_difference"),
            (F.coalesce("_now", zero) - F.coalesce("_billed", zero)).cast(AMOUNT).alias("adjustment_amount"),
        )
        .where("adjustment_amount != 0 OR quantity_difference != 0")
    )


def unmerged_days(parsed: DataFrame, clean: DataFrame) -> DataFrame:
    """Days with raw events that came in another day's file and never reached the clean table.

    Deliveries are reduced to one row per event before the lookup.
    """
    strays = parsed.where(~F.col("event_date").eqNullSafe(F.col("dt"))).groupBy("event_id", "event_date").agg(
        F.count(F.lit(1)).alias("deliveries")
    )
    missing = strays.join(clean.select("event_id"), "event_id", "left_anti")
    return missing.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("missing_events"), F.sum("deliveries").alias("deliveries")
    )
