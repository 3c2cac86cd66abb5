"""Applying customers and effective-dated rates to usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import as_of_join, keyed_join, salted_join
from ..functions.keys import surrogate_key
from ..functions.literals import date
from ..functions.money import amount_of
from ..schemas import AMOUNT, PRICE, TOTAL_QUANTITY

OPEN_END = "9999-12-31"
RATE_COLUMNS = ("product_id", "unit", "plan_id", "unit_price", "currency", "effective_from", "effective_to", "rate_sk")


def with_current_customer(usage: DataFrame, customers: DataFrame) -> DataFrame:
    """Usage of customers that have a current row, with key and plan of that row."""
    current = customers.where("is_current").select("customer_id", "customer_sk", "plan_id")
    return keyed_join(usage, current, ["customer_id"])


def in_force(day: str) -> Column:
    """Rate interval test, closed on both ends; no end means open."""
    open_end = date(OPEN_END)
    return F.col(f"l.{day}").between(F.col("r.effective_from"), F.coalesce(F.col("r.effective_to"), open_end))


def with_rate(
    usage: DataFrame, rates: DataFrame, *, match_plan: bool, day: str = "event_date",
    spread_on: tuple[str, ...] = ("customer_id", "event_date"), how: str = "inner",
) -> DataFrame:
    """Rates valid on the usage date, by product and unit and, with ``match_plan``, by plan.

    Product and unit have few values, so the join is salted: a product with most of the usage is
    spread over many tasks when the catalog is too large for Spark to broadcast.
    """
    keys = ["product_id", "unit", *(["plan_id"] if match_plan else [])]
    wanted = [c for c in RATE_COLUMNS if c in rates.columns and (c != "plan_id" or match_plan)]
    return salted_join(usage, rates.select(*wanted), keys, spread_on, in_force(day), how)


def daily_cost(daily: DataFrame, customers: DataFrame, rates: DataFrame, *, match_plan: bool = True) -> DataFrame:
    """Daily cost fact. Usage without a current customer or a rate drops out.

    Rates are per plan. ``match_plan=False`` leaves the plan out of the rate join, which bills a
    row once per plan that lists the product.
    """
    priced = with_rate(with_current_customer(daily, customers), rates, match_plan=match_plan)
    return priced.select(
        F.col("event_date").alias("date_id"), "customer_sk", "product_id", "unit", "total_quantity",
        F.col("total_quantity").alias("billable_quantity"),
        amount_of(F.col("total_quantity"), F.col("unit_price")).alias("cost_amount"), "currency", "rate_sk",
    )


def daily_cost_model(daily: DataFrame, customers: DataFrame, latest_rates: DataFrame, *, match_plan: bool = False) -> DataFrame:
    """Daily cost over all dates with the newest rate per product and plan, keeping the event count."""
    priced = with_rate(with_current_customer(daily, customers), latest_rates, match_plan=match_plan)
    return priced.select(
        F.col("event_date").alias("date_id"), "customer_sk", "product_id", "unit", "total_quantity",
        F.col("total_quantity").alias("billable_quantity"),
        amount_of(F.col("total_quantity"), F.col("unit_price")).alias("cost_amount"), "currency", "event_count",
    )


def customer_at(usage: DataFrame, history: DataFrame, *, at: str, spread_on: tuple[str, ...] = ("event_date", "product_id")) -> DataFrame:
    """Usage with the customer version valid at ``at`` (half-open intervals, open versions never end).

    The versions of a customer do not overlap, so the newest one that has started is the only one that can hold. A
    customer with a large share of the usage is spread by ``spread_on``.
    """
    versions = history.select("customer_id", "customer_sk", "plan_id", "status", "effective_start", "effective_end")
    found = as_of_join(usage, versions, ["customer_id"], at, "effective_start", spread_on)
    return found.where(F.col("effective_end").isNull() | (F.col(at) < F.col("effective_end")))


def base_fee_lines(
    headers: DataFrame, customers: DataFrame, plans: DataFrame, *, calc_batch_id: str
) -> DataFrame:
    """One base-fee line per invoice, from the current plan of the invoiced customer."""
    plan_of = customers.where("is_current").select("customer_sk", "plan_id")
    return _fee_lines(headers.join(plan_of, "customer_sk").join(plans.select("plan_id", "base_fee"), "plan_id"), calc_batch_id)


def period_fee_lines(headers: DataFrame, billable: DataFrame, plans: DataFrame, *, calc_batch_id: str) -> DataFrame:
    """One base-fee line per customer and month of ``billable`` (``invoicing.billable_periods``), by the plan of that month.

    Each of these has an invoice in ``headers``. An invoice of a customer that owes no fee gets no line.
    """
    plan_of = billable.select("customer_sk", "billing_period_start", "plan_id")
    owed = headers.join(plan_of, ["customer_sk", "billing_period_start"]).join(plans.select("plan_id", "base_fee"), "plan_id")
    return _fee_lines(owed, calc_batch_id)


def _fee_lines(priced: DataFrame, calc_batch_id: str) -> DataFrame:
    return priced.select(
        "invoice_id", surrogate_key("invoice_id", "'base_fee'").alias("line_item_id"),
        F.lit("base_fee").alias("line_type"), F.lit(None).cast("string").alias("product_id"),
        F.lit(None).cast("string").alias("unit"), F.lit(1).cast(TOTAL_QUANTITY).alias("quantity"),
        F.col("base_fee").cast(PRICE).alias("unit_price"), F.col("base_fee").cast(AMOUNT).alias("amount"),
        F.lit(None).cast("bigint").alias("rate_sk"), F.col("billing_period_start").alias("usage_window_start"),
        F.col("billing_period_end").alias("usage_window_end"), F.lit(calc_batch_id).alias("calc_batch_id"),
        "billing_period_start",
    )
