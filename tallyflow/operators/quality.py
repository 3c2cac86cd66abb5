"""Data-quality checks. Each returns one row per check: ``check``, ``violations``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import total_amount
from ..schemas import AMOUNT
from .pricing import with_current_customer, with_rate
from .usage import repeated_keys

TOLERANCE = "0.01"


class QualityError(RuntimeError):
    """A gate found violations."""


def _named(name: str, df: DataFrame) -> DataFrame:
    """``df`` holds a ``violations`` column and one row."""
    return df.select(F.lit(name).alias("check"), F.coalesce(F.col("violations").cast("bigint"), F.lit(0)).alias("violations"))


def _count(name: str, df: DataFrame) -> DataFrame:
    return _named(name, df.agg(F.count(F.lit(1)).alias("violations")))


def duplicate_events(events: DataFrame) -> DataFrame:
    return _count("duplicate_event_id", repeated_keys(events, ["event_id"]))


def negative_quantity(events: DataFrame) -> DataFrame:
    return _count("negative_quantity", events.where("quantity < 0"))


def unpriced_usage(daily: DataFrame, rates: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Daily aggregates without a rate; with ``customers`` the rate must also fit the customer's plan."""
    if customers is None:
        return with_rate(daily, rates, match_plan=False, how="left_anti")
    current = customers.where("is_current").select("customer_id", "plan_id")
    return with_rate(daily.join(current, "customer_id", "left"), rates, match_plan=True, how="left_anti").drop("plan_id")


def pricing_coverage(daily: DataFrame, rates: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    return _count("unpriced_usage", unpriced_usage(daily, rates, customers))


def unknown_plans(billable: DataFrame, plans: DataFrame) -> DataFrame:
    """Customers and months that owe the fee of a plan nobody priced (or of none)."""
    return _count("unknown_plan", billable.join(plans.select("plan_id"), "plan_id", "left_anti"))


def header_mismatches(headers: DataFrame, lines: DataFrame, tolerance: str = TOLERANCE) -> DataFrame:
    """Invoices whose subtotal differs from the sum of their lines; lines are summed first."""
    sums = lines.groupBy("invoice_id").agg(total_amount("amount").alias("line_total"))
    off = F.abs(F.col("subtotal") - F.col("line_total")) > F.lit(tolerance).cast("decimal(18,10)")
    return headers.join(sums, "invoice_id").where(off).select("invoice_id", "subtotal", "line_total")


def invoice_integrity(headers: DataFrame, lines: DataFrame, tolerance: str = TOLERANCE) -> DataFrame:
    return _count("invoice_integrity", header_mismatches(headers, lines, tolerance))


def fan_out_difference(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """The faulty form of the integrity check: header totals summed once per line.

    Kept for comparison with runs that used it. Computed from line counts, so no header row is
    repeated; the gate uses ``invoice_integrity``.
    """
    per_invoice = lines.groupBy("invoice_id").agg(F.count(F.lit(1)).alias("n"), total_amount("amount").alias("amount"))
    joined = headers.join(per_invoice, "invoice_id", "left")
    times = F.coalesce("n", F.lit(1)).cast("decimal(9,0)")
    return joined.agg(
        F.coalesce(F.sum(F.col("total").cast("decimal(28,10)") * times), F.lit(0)).cast(AMOUNT).alias("header_total"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast(AMOUNT).alias("line_total"),
    ).select("header_total", "line_total", F.abs(F.col("header_total") - F.col("line_total")).cast(AMOUNT).alias("difference"))


def single_currency(lines_or_costs: DataFrame, key: str, currency: str = "currency") -> DataFrame:
    """Groups billed in more than one currency."""
    mixed = lines_or_costs.groupBy(key).agg(F.min(currency).alias("lo"), F.max(currency).alias("hi")).where("lo != hi")
    return _count("mixed_currency", mixed)


def column_checks(
    df: DataFrame, *, not_null: Sequence[str] = (), accepted: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """All not-null and accepted-values checks of a table in one scan and one aggregate row."""
    conditions: dict[str, Column] = {f"not_null_{c}": F.col(c).isNull() for c in not_null}
    for column, values in (accepted or {}).items():
        conditions[f"accepted_values_{column}"] = ~F.col(column).isin(*values)
    counts = df.agg(*[F.count_if(bad).alias(name) for name, bad in conditions.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in conditions])
    return counts.select(F.inline(pairs))


def unique(df: DataFrame, column: str) -> DataFrame:
    return _count(f"unique_{column}", repeated_keys(df.where(F.col(column).isNotNull()), [column]))


def relationship(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child rows whose key has no parent row."""
    orphans = child.where(F.col(column).isNotNull()).join(parent.select(column), column, "left_anti")
    return _count(f"relationships_{column}", orphans)


def all_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def gated(checks: DataFrame) -> DataFrame:
    """The checks with a ``passed`` column; running it raises where a check has violations."""
    failed = F.raise_error(F.concat(F.lit("quality gate failed: "), F.col("check")))
    return checks.select(
        "check", "violations", F.when(F.col("violations") > 0, failed.cast("boolean")).otherwise(F.lit(True)).alias("passed")
    )


def enforce(checks: DataFrame) -> None:
    """Raise ``QualityError`` naming every check with violations. One row per check comes back."""
    failed = [f"{r['check']}={r.violations}" for r in checks.where("violations > 0").collect()]
    if failed:
        raise QualityError(", ".join(sorted(failed)))
