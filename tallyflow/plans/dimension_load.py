"""Dimension load: customers by snapshot, rates by content, products, plans and dates, from parsed files into tables."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.literals import ntz
from ..operators import dimensions, numbering
from ..session import stage
from ..sources import lake as lk


def load_customers(lake: lk.Lake, snapshot: DataFrame, as_of: dt_.datetime | str) -> None:
    """One snapshot (one row per customer) onto the stored history; loading it again changes nothing."""
    lake.overwrite(lk.CUSTOMER_DIM, dimensions.apply_snapshot(lake.read(lk.CUSTOMER_DIM), snapshot, as_of))


def load_customer_history(lake: lk.Lake, snapshot: DataFrame, as_of: dt_.datetime | str) -> None:
    """One snapshot into the stored history, whatever snapshots were loaded before it; a snapshot loaded again is replaced.

    All snapshots are logged. Versions are made anew for the customers of this one and for those that an earlier load of
    the same snapshot named. Customers with versions but without a row in the log are logged by the starts of their
    versions first, so a history from before the log goes on.
    """
    name = str(as_of)
    columns = [f for f in lk.CUSTOMERS_SEEN.schema.fieldNames() if f not in ("ingest_ts", "snapshot")]
    rows = stage(snapshot.select(*columns).where("customer_id IS NOT NULL").select("*", ntz(as_of).alias("ingest_ts"), F.lit(name).alias("snapshot")), "snapshot")
    seen, dim = lake.read(lk.CUSTOMERS_SEEN), lake.read(lk.CUSTOMER_DIM)
    touched = stage(rows.select("customer_id").union(seen.where(F.col("snapshot") == name).select("customer_id")).distinct(), "touched")
    lost = dim.join(touched, "customer_id", "left_semi").join(seen.select("customer_id"), "customer_id", "left_anti")
    old = lost.select(*columns, F.col("effective_start").alias("ingest_ts"), F.lit("before the log").alias("snapshot"))
    old = stage(old, "unlogged")
    if not old.isEmpty():
        lake.replace(lk.CUSTOMERS_SEEN, stage(seen.where("snapshot = 'before the log'").unionByName(old), "old-log"))
    lake.clear(lk.CUSTOMERS_SEEN, [name])
    lake.replace(lk.CUSTOMERS_SEEN, rows)  # staged above: not written a second time first
    lake.overwrite(lk.CUSTOMER_DIM, dimensions.splice_snapshot(dim, lake.read(lk.CUSTOMERS_SEEN), touched, keep=stage))


def assign_customer_keys(lake: lk.Lake, customers: DataFrame, load: str) -> None:
    """Dense keys for the customers that have none yet, stored under the name of the load that brought them.

    Run again, the load adds nothing. One load at a time: two at once would give out the same numbers.
    """
    known = lake.read(lk.CUSTOMER_KEYS)
    fresh = numbering.new_numbers(known, customers, "customer_id", "customer_sk").withColumn("load", F.lit(load))
    lake.append_new(lk.CUSTOMER_KEYS, fresh, ["customer_id"])


def load_rates(lake: lk.Lake, rates: DataFrame) -> DataFrame:
    """Append the rates that are not stored yet, known by their content; returns what was added."""
    return lake.append_new(lk.RATE_DIM, dimensions.append_rates(rates).dropDuplicates(["rate_sk"]), ["rate_sk"])


def load_rate_history(lake: lk.Lake, rates: DataFrame) -> None:
    """Splice one catalog load, with its load times, into the stored rate versions; loading it again changes nothing.

    Only the currencies of touched keys are written again. A history that would bill a day twice is not stored.
    """
    stored = lake.read(lk.RATE_DIM)
    spliced = stage(dimensions.splice_rates(stored, rates), "spliced")
    if not dimensions.overlapping_rates(spliced).isEmpty():
        raise ValueError("rate versions overlap")
    keys = list(dimensions.RATE_KEYS)
    same = F.expr(" AND ".join(f"s.{k} <=> n.{k}" for k in keys))
    touched = spliced.select(*keys).distinct().alias("n")
    others = stored.alias("s").join(touched, same, "left_anti")
    # One row per currency.
    currencies = spliced.select("currency").union(stored.alias("s").join(touched, same, "left_semi").select("currency")).distinct()
    values = [r.currency for r in currencies.collect()]
    lake.replace_values(lk.RATE_DIM, others.where(F.col("currency").isin(values)).unionByName(spliced), values)


def load_all(
    lake: lk.Lake, *, snapshot: DataFrame, rates: DataFrame, products: DataFrame, plans: DataFrame, as_of: dt_.datetime,
    first_day: dt_.date, last_day: dt_.date,
) -> None:
    """All dimensions of one load. Products and plans are replaced, dates span the given days."""
    load_customer_history(lake, snapshot, as_of)
    load_rate_history(lake, rates if "ingest_ts" in rates.columns else rates.withColumn("ingest_ts", ntz(as_of)))
    lake.overwrite(lk.PRODUCT_DIM, products)
    lake.overwrite(lk.PLAN_DIM, plans)
    lake.overwrite(lk.DATE_DIM, dimensions.date_dimension(lake.spark, first_day, last_day))


def current_customers(lake: lk.Lake) -> DataFrame:
    return lake.read(lk.CUSTOMER_DIM).where(F.col("is_current"))
