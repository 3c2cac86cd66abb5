"""Usage and cost aggregates. All use partial aggregation, so a hot customer shrinks before the shuffle."""

from __future__ import annotations

import datetime as dt_
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import total_amount, total_quantity
from ..schemas import PRICE

DAILY_KEYS = ("event_date", "customer_id", "product_id", "unit")


def daily_usage(events: DataFrame, days: Iterable[dt_.date] | None = None) -> DataFrame:
    """Quantity, event count and newest event per day, customer, product and unit."""
    if days is not None:
        events = events.where(F.col("event_date").isin(sorted(days)))
    return events.groupBy(*DAILY_KEYS).agg(
        total_quantity("quantity").alias("total_quantity"),
        F.count(F.lit(1)).alias("event_count"),
        F.max("event_ts").alias("last_event_ts"),
    )


def daily_usage_model(events: DataFrame) -> DataFrame:
    """Quantity and event count over all dates."""
    return events.groupBy(*DAILY_KEYS).agg(
        total_quantity("quantity").alias("total_quantity"), F.count(F.lit(1)).alias("event_count")
    )


def daily_revenue(costs: DataFrame) -> DataFrame:
    return costs.groupBy("date_id").agg(total_amount("cost_amount").alias("daily_total"))


def in_months(costs: DataFrame) -> DataFrame:
    """``costs`` with the first day of their month; left as they are where they have it."""
    return costs if "billing_period_start" in costs.columns else costs.withColumn("billing_period_start", F.trunc("date_id", "MONTH"))


def monthly_customer_cost(costs: DataFrame) -> DataFrame:
    """Cost per customer and calendar month."""
    # Grouped by the keys that lines meet invoices on, so that this join needs no further shuffle.
    totals = in_months(costs).groupBy("customer_sk", "billing_period_start").agg(
        total_amount("cost_amount").alias("subtotal"), F.max("currency").alias("currency")
    )
    return totals.select("customer_sk", "billing_period_start", F.last_day("billing_period_start").alias("billing_period_end"), "subtotal", "currency")


def monthly_product_cost(costs: DataFrame) -> DataFrame:
    """Quantity and cost per customer, calendar month, product and unit."""
    return in_months(costs).groupBy("customer_sk", "billing_period_start", "product_id", "unit").agg(
        total_quantity("total_quantity").alias("quantity"), total_amount("cost_amount").alias("amount"),
        F.max("currency").alias("currency"),
    )


def current_customers(customers: DataFrame) -> DataFrame:
    """Exact number of distinct current customers, one row."""
    return customers.where("is_current").agg(F.countDistinct("customer_id").alias("total_customers"))


def customer_bitmaps(rows: DataFrame, keys: Sequence[str], number: str = "customer_sk") -> DataFrame:
    """Exact sets of customers per ``keys`` as bitmaps of 32,768 dense numbers each: ``keys``, ``bucket``, ``bits``.

    Dense numbers fill their bitmaps, and sets of one bucket add up by ``rolled_up`` without the rows. Numbers start at
    1; rows without one do not count.
    """
    counted = rows.where(F.col(number).isNotNull())
    return counted.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )


def rolled_up(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser ``keys``, from those of finer ones."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct customers per ``keys``; the bitmaps are those of these keys."""
    return bitmaps.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("customers"))


def positive_groups(costs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups whose summed cost is above zero."""
    return costs.groupBy(*keys).agg(total_amount("cost_amount").alias("cost_amount")).where("cost_amount > 0")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def usage_window(costs: DataFrame, rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and last usage date, average price, newest rate key and currency per group.

    Costs are first reduced to one row per group and rate, so the rate lookup joins few rows and
    the average is weighted by the number of cost rows behind each rate.
    """
    per_rate = costs.groupBy(*keys, "rate_sk").agg(
        F.min("date_id").alias("first_date"), F.max("date_id").alias("last_date"),
        F.count(F.lit(1)).alias("rows"), F.max("currency").alias("currency"),
    )
    priced = per_rate.join(rates.select("rate_sk", "unit_price"), "rate_sk", "left")
    return priced.groupBy(*keys).agg(
        F.min("first_date").alias("usage_window_start"), F.max("last_date").alias("usage_window_end"),
        weighted_price().alias("avg_unit_price"), F.max("rate_sk").alias("max_rate_sk"),
        F.max("currency").alias("currency"),
    )


def weighted_price(price: str = "unit_price", rows: str = "rows") -> Column:
    """Average of ``price`` over ``rows`` underlying rows; rows without a price do not count."""
    total = F.sum(F.col(price).cast(PRICE) * F.col(rows).cast("decimal(18,0)"))
    weight = F.sum(F.when(F.col(price).isNotNull(), F.col(rows)))
    return F.try_divide(total, weight).cast(PRICE)
