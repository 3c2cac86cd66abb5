"""Versioned customer and rate dimensions, and the date dimension."""

from __future__ import annotations

import datetime as dt_
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.joins import with_neighbour
from ..functions.literals import date, ntz
from ..functions.keys import numeric_key, surrogate_key
from .dedupe import latest_by

CUSTOMER_ATTRIBUTES = ("customer_name", "status", "country", "plan_id")


def customer_history(
    snapshots: DataFrame, attributes: Sequence[str] = CUSTOMER_ATTRIBUTES, bucket: Column | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """All customer versions from all snapshots: a version starts where the attribute hash changes.

    Intervals are half open. All versions of a customer have the same key, so facts, invoices and names stay
    together when a version changes. ``bucket`` splits a customer's snapshots for the neighbour lookups
    (default: the day of the snapshot), so a customer with very many snapshots is not one task. Each lookup reads its
    rows more than once; jobs pass ``stage`` as ``keep``, so that they are computed once.
    """
    bucket = F.col("ingest_ts").cast("date") if bucket is None else bucket
    hashed = snapshots.select("customer_id", *attributes, "ingest_ts", surrogate_key(*attributes).alias("record_hash"))
    moments = keep(latest_by(hashed, ["customer_id", "ingest_ts"], [F.desc("record_hash")]), "moments")
    with_before = with_neighbour(moments, ["customer_id"], "ingest_ts", "record_hash", "_before", bucket)
    starts = keep(with_before.where(~F.col("_before").eqNullSafe(F.col("record_hash"))).drop("_before"), "starts")
    with_end = with_neighbour(starts, ["customer_id"], "ingest_ts", "ingest_ts", "effective_end", bucket, following=True)
    return with_end.select(
        numeric_key("customer_id").alias("customer_sk"), "customer_id", *attributes,
        F.col("ingest_ts").alias("effective_start"), "effective_end",
        F.col("effective_end").isNull().alias("is_current"), "record_hash",
    )


def apply_snapshot(
    dim: DataFrame, snapshot: DataFrame, as_of: str | dt_.datetime, attributes: Sequence[str] = CUSTOMER_ATTRIBUTES
) -> DataFrame:
    """One snapshot (one row per customer) onto the history: changed versions close, new ones open.

    Customers absent from the snapshot keep their current version; applying the same snapshot
    again changes nothing. A customer whose current version starts later than ``as_of`` is left as it is:
    ``splice_snapshot`` puts older snapshots in.
    """
    now = ntz(as_of)
    incoming = snapshot.select("customer_id", *attributes, surrogate_key(*attributes).alias("record_hash"))
    columns = dim.columns
    current = dim.where("is_current").select("customer_id", F.col("record_hash").alias("known_hash"), F.col("effective_start").alias("_since"))
    compared = incoming.join(current, "customer_id", "left").where(F.col("_since").isNull() | (F.col("_since") <= now)).drop("_since")
    opened = compared.where(~F.col("known_hash").eqNullSafe(F.col("record_hash")))
    closing = opened.where(F.col("known_hash").isNotNull()).select("customer_id", F.lit(True).alias("_closes"))
    closes = F.col("is_current") & F.coalesce("_closes", F.lit(False))
    kept = (
        dim.join(closing, "customer_id", "left")
        .withColumn("effective_end", F.when(closes, now).otherwise(F.col("effective_end")))
        .withColumn("is_current", F.col("is_current") & ~closes)
        .select(*columns)
    )
    added = opened.select(
        "customer_id", *attributes, "record_hash", now.alias("effective_start"),
        F.lit(None).cast("timestamp_ntz").alias("effective_end"), F.lit(True).alias("is_current"),
    ).withColumn("customer_sk", numeric_key("customer_id"))
    return kept.unionByName(added.select(*columns))


def splice_snapshot(
    dim: DataFrame, seen: DataFrame, touched: DataFrame, attributes: Sequence[str] = CUSTOMER_ATTRIBUTES,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """The history with the versions of ``touched`` customers (one row each) made anew from all that was ever seen of them.

    ``seen`` holds the rows of all snapshots with their ``ingest_ts``, in whatever order they were loaded, so the result
    is that of ``customer_history`` over all snapshots; only rows of touched customers are worked on. Rows without a
    customer id have no version.
    """
    ids = touched.select("customer_id").where("customer_id IS NOT NULL")
    logged = seen.join(ids, "customer_id", "left_semi").select("customer_id", *attributes, "ingest_ts")
    made = customer_history(logged, attributes, keep=keep)
    return dim.join(ids, "customer_id", "left_anti").select(*dim.columns).unionByName(made.select(*dim.columns))


def append_rates(rates: DataFrame) -> DataFrame:
    """Rate dimension rows straight from the catalog, all marked current, keyed by content.

    The key makes a second load of the same catalog recognisable instead of doubling prices.
    """
    natural = ("product_id", "plan_id", "unit", "effective_from", "unit_price", "currency", "effective_to")
    return rates.select(
        numeric_key(*natural).alias("rate_sk"), F.lit(None).cast("string").alias("rate_id"),
        "product_id", "plan_id", "unit", "unit_price", "currency", "effective_from", "effective_to",
        F.lit(True).alias("is_current"),
    )


def rate_versions(rates: DataFrame) -> DataFrame:
    """Rate history per product, plan and unit: each version ends the day before the next starts.

    Rates with the same start are settled first (newest load wins), so the window over one key
    holds at most one row per calendar day.
    """
    keys = ["product_id", "plan_id", "unit"]
    order = [F.desc("ingest_ts"), F.desc("unit_price"), F.desc("currency")]
    unique = latest_by(rates, [*keys, "effective_from"], order)
    following = F.lead("effective_from").over(Window.partitionBy(*keys).orderBy("effective_from"))
    return (
        unique.withColumn("_next", following)
        .withColumn("effective_to", F.when(F.col("_next").isNull(), F.col("effective_to")).otherwise(
            F.least(F.date_sub("_next", 1), F.coalesce("effective_to", F.date_sub("_next", 1)))
        ))
        .select(
            surrogate_key(*keys, "effective_from").alias("rate_id"), *keys, "unit_price", "currency",
            "effective_from", "effective_to", F.col("_next").isNull().alias("is_current"),
        )
    )


RATE_KEYS = ("product_id", "plan_id", "unit")


def splice_rates(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The history of the keys in ``incoming`` after one more load: (kept pieces and new versions) of those keys only.

    ``stored`` has intervals that do not overlap inside a key, both ends included, a null end is open. A load wins on
    the days it names: an older version is closed before it, resumes after it where the new one ends, and goes where it is
    covered. A version without an end reaches to the next start of its key, be that stored or new; among new versions
    with one start the newest load time wins. Loading the same rates again changes nothing. Rows of keys without a
    product, plan or unit match by null.
    """
    keys = list(RATE_KEYS)
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"s.{key}").eqNullSafe(F.col(f"n.{key}"))
    fresh = rate_versions(incoming).select(*keys, "unit_price", "currency", "effective_from", "effective_to")
    touched = stored.alias("s").join(fresh.select(*keys).distinct().alias("n"), same, "left_semi")
    # An open new version ends before the next stored start; closed ones keep their end.
    later = fresh.where("effective_to IS NULL").alias("n").join(
        touched.select(*keys, F.col("effective_from").alias("next")).alias("s"), same & (F.col("s.next") > F.col("n.effective_from")))
    ends = later.groupBy(*[F.col(f"n.{k}").alias(k) for k in keys]).agg(F.date_sub(F.min("next"), 1).alias("until"))
    added = fresh.alias("s").join(ends.alias("n"), same, "left").select(
        *[f"s.{c}" for c in (*keys, "unit_price", "currency", "effective_from")],
        F.coalesce("s.effective_to", F.col("n.until")).alias("effective_to"))
    # What is left of a stored version between the new ones that meet it; a key has at most one new version a day.
    meets = same & (F.col("n.effective_from") <= F.coalesce("s.effective_to", F.col("n.effective_from"))) & (
        F.coalesce("n.effective_to", F.col("s.effective_from")) >= F.col("s.effective_from"))
    own = [F.col(f"s.{c}").alias(c) for c in (*keys, "unit_price", "currency", "effective_from", "effective_to")]
    cut = F.struct(F.col("n.effective_from").alias("first"), F.coalesce("n.effective_to", F.lit("9999-12-31").cast("date")).alias("last"))
    met = touched.alias("s").join(added.alias("n"), meets, "left").select(*own, F.when(F.col("n.effective_from").isNotNull(), cut).alias("cut"))
    held = met.groupBy(*[c for c in met.columns if c != "cut"]).agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    starts = F.concat(F.array("effective_from"), F.transform("cuts", lambda c: F.when(c["last"] < F.lit("9999-12-31").cast("date"), F.date_add(c["last"], 1))))
    stops = F.concat(F.transform("cuts", lambda c: F.date_sub(c["first"], 1)), F.array("effective_to"))
    pieces = held.select(*keys, "unit_price", "currency", F.explode(F.arrays_zip(starts.alias("from"), stops.alias("to"))).alias("piece"))
    kept = pieces.select(*keys, "unit_price", "currency", F.col("piece.from").alias("effective_from"), F.col("piece.to").alias("effective_to"))
    kept = kept.where("effective_from IS NOT NULL AND (effective_to IS NULL OR effective_from <= effective_to)")
    whole = kept.unionByName(added).withColumn("_next", F.lead("effective_from").over(Window.partitionBy(*keys).orderBy("effective_from")))
    natural = ("product_id", "plan_id", "unit", "effective_from", "unit_price", "currency", "effective_to")
    return whole.select(
        numeric_key(*natural).alias("rate_sk"), surrogate_key(*keys, "effective_from").alias("rate_id"), *keys, "unit_price", "currency",
        "effective_from", "effective_to", F.col("_next").isNull().alias("is_current"),
    )


def overlapping_rates(rates: DataFrame) -> DataFrame:
    """Versions that still hold on the day the next version of their key starts: usage of that day would be billed twice."""
    following = F.lead("effective_from").over(Window.partitionBy(*RATE_KEYS).orderBy("effective_from", "effective_to"))
    return rates.withColumn("_next", following).where("_next <= coalesce(effective_to, _next)").drop("_next")


def date_dimension(spark: SparkSession, first: dt_.date | str, last: dt_.date | str) -> DataFrame:
    """One row per day, both ends included."""
    days = spark.range(1).select(
        F.explode(F.sequence(date(first), date(last))).alias("date_id")
    )
    return calendar_columns(days)


def date_dimension_of(df: DataFrame, column: str) -> DataFrame:
    """Date dimension spanning a date column; the span is one aggregate row."""
    span = df.agg(F.min(column).cast("date").alias("lo"), F.max(column).cast("date").alias("hi"))
    days = span.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("date_id"))
    return calendar_columns(days)


def calendar_columns(days: DataFrame) -> DataFrame:
    weekday = F.weekday("date_id") + 1  # ISO: Monday 1 .. Sunday 7
    return days.select(
        "date_id", F.year("date_id").alias("year"), F.month("date_id").alias("month"), F.day("date_id").alias("day"),
        F.quarter("date_id").alias("quarter"), weekday.alias("day_of_week"), (weekday >= 6).alias("is_weekend"),
    )
