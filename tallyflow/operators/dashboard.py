"""Chart and table aggregations of the dashboard, over the uncut usage report or customer usage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import total_amount, total_quantity
from ..functions.text import plan_label, product_label
from ..schemas import PRODUCTS



def revenue_over_time(usage: DataFrame) -> DataFrame:
    return usage.groupBy("date_id").agg(total_amount("cost_amount").alias("cost")).orderBy("date_id")


def quantity_by_product(usage: DataFrame) -> DataFrame:
    return usage.groupBy("product_id").agg(total_quantity("total_quantity").alias("quantity"))


def quantity_trend(usage: DataFrame, product_id: str | None = None) -> DataFrame:
    if product_id:
        usage = usage.where(F.col("product_id") == product_id)
    return usage.groupBy("date_id").agg(total_quantity("total_quantity").alias("quantity")).orderBy("date_id")


def product_summary(usage: DataFrame) -> DataFrame:
    return usage.groupBy("product_id").agg(
        total_quantity("total_quantity").alias("quantity"), total_amount("cost_amount").alias("cost"), F.min("unit").alias("unit")
    ).withColumn("name", product_label(F.col("product_id")))


def products_present(usage: DataFrame) -> DataFrame:
    return usage.select("product_id").distinct()


def product_breakdown(usage: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Quantity and cost by product, for one customer's usage or per ``keys``."""
    return usage.groupBy(*keys, "product_id").agg(
        total_quantity("total_quantity").alias("quantity"), total_amount("cost_amount").alias("cost")
    )


def search_customers(customers: DataFrame, text: str) -> DataFrame:
    """Current customers whose name contains ``text``, ignoring case; empty text keeps all."""
    rows = customers.where("is_current")
    return rows.where(F.lower("customer_name").contains(text.lower())) if text else rows


def recent_invoices(invoices: DataFrame, count: int = 5) -> DataFrame:
    return invoices.orderBy(F.desc("issued_ts"), "invoice_id").limit(count)


def rates_by_plan(rates: DataFrame) -> DataFrame:
    """Current rates in plan order with the plan's label and size, one row per rate."""
    current = rates.where("is_current")
    sizes = current.groupBy("plan_id").agg(F.count(F.lit(1)).alias("rates_in_plan"))
    return current.join(sizes, "plan_id").select(
        "plan_id", plan_label(F.col("plan_id")).alias("plan"), "rates_in_plan", "product_id", "unit", "unit_price",
        "currency", "effective_from",
    ).orderBy("plan_id", "product_id", "unit", "effective_from")


def usage_matrix(usage: DataFrame, products: Sequence[str] = PRODUCTS) -> DataFrame:
    """One row per day, one quantity column per listed product and one for all others; empty cells show 0."""
    columns = [total_quantity(F.when(F.col("product_id") == p, F.col("total_quantity"))).alias(p) for p in products]
    known = F.coalesce(F.col("product_id").isin(list(products)), F.lit(False))
    other = total_quantity(F.when(~known, F.col("total_quantity"))).alias("other_products")
    return usage.groupBy("date_id").agg(*columns, other).fillna(0).orderBy("date_id")


def usage_by_day_and_product(usage: DataFrame) -> DataFrame:
    """The matrix in long form, for any number of products."""
    return usage.groupBy("date_id", "product_id").agg(total_quantity("total_quantity").alias("quantity"))
