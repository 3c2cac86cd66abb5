"""Billing inputs derived from the general test tables (events, customer, nation, part, orders, lineitem).

Every input is computed from whole tables, so work grows with them. Repeated and late deliveries
are added on top of the full event set, nothing is left out.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.literals import ntz
from ..operators import invoicing, pricing, usage
from ..schemas import AMOUNT, PLANS, PRICE, QUANTITY, REGIONS
from ..session import stage

TODAY = "2024-01-30"
PERIOD = ("2024-01-01", "2024-01-31")
ISSUED = "2024-02-01 04:00:00"
SNAPSHOT_TIMES = ("2024-01-01 00:00:00", "2024-01-11 12:00:00", "2024-01-21 00:00:00")

# Price catalog (rate, product, plan, unit, price in USD).
CATALOG = """
(1, 'prod_api_requests', 'plan_free', 'requests', 0.00),
(2, 'prod_api_requests', 'plan_starter', 'requests', 0.0001),
(3, 'prod_storage_gb', 'plan_starter', 'gb_month', 0.10),
(4, 'prod_api_requests', 'plan_pro', 'requests', 0.00008),
(5, 'prod_storage_gb', 'plan_pro', 'gb_month', 0.08),
(6, 'prod_compute_minutes', 'plan_pro', 'minutes', 0.05),
(7, 'prod_api_requests', 'plan_enterprise', 'requests', 0.00005),
(8, 'prod_storage_gb', 'plan_enterprise', 'gb_month', 0.05),
(9, 'prod_compute_minutes', 'plan_enterprise', 'minutes', 0.03),
(10, 'prod_ai_tokens', 'plan_enterprise', 'tokens', 0.000002)
"""

# Plan dimension (plan, name, monthly base fee, currency).
PLAN_ROWS = """
('plan_free', 'Free Tier', 0.00, 'USD'),
('plan_starter', 'Starter', 29.00, 'USD'),
('plan_pro', 'Professional', 99.00, 'USD'),
('plan_enterprise', 'Enterprise', 499.00, 'USD')
"""


# Columns of the test tables, so that reading one needs no schema-inference job.
TABLE_COLUMNS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
    "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage events in the clean-table shape, one delivery each.

    Event type 'error' maps to a product no rate covers. Every fiftieth event was loaded 40 days
    after it happened, the rest one hour after.
    """
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id AS STRING) AS event_id", "ts AS event_ts", "cast(ts AS DATE) AS event_date",
        "concat('cust_', user_id) AS customer_id",
        "CASE event_type WHEN 'click' THEN 'prod_api_requests' WHEN 'view' THEN 'prod_storage_gb'"
        " WHEN 'purchase' THEN 'prod_compute_minutes' WHEN 'signup' THEN 'prod_ai_tokens' ELSE 'prod_unknown' END AS product_id",
        f"element_at(array{PLANS[1:]}, cast(event_id % 3 + 1 AS INT)) AS plan_id",
        f"element_at(array{REGIONS}, cast(user_id % 3 + 1 AS INT)) AS region",
        "CASE event_type WHEN 'click' THEN 'requests' WHEN 'view' THEN 'gb_month' WHEN 'purchase' THEN 'minutes'"
        " WHEN 'signup' THEN 'tokens' ELSE 'count' END AS unit",
        f"cast(value AS {QUANTITY.simpleString()}) AS quantity", "'API' AS source",
        "ts + CASE WHEN event_id % 50 = 0 THEN INTERVAL 40 DAYS ELSE INTERVAL 1 HOUR END AS load_ts",
        "concat('run_', cast(ts AS DATE)) AS batch_id",
        "md5(concat_ws('-', cast(event_id AS STRING), cast(value AS STRING))) AS raw_hash",
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, and every hundredth delivered a second time stamped one second later."""
    once = events(spark, sf_dir)
    again = once.where(F.col("event_id").cast("bigint") % 100 == 0)
    return once.unionByName(again.withColumn("event_ts", F.col("event_ts") + F.expr("INTERVAL 1 SECOND")))


def usage_json(deliveries_: DataFrame, with_day: bool = False) -> DataFrame:
    """Deliveries as landed JSON lines: ``dt`` (day of the load), ``ingest_ts`` and ``value``.

    ``with_day`` keeps their ``event_date``: that of a second delivery is the first one's, also when its second is past midnight.
    """
    stamp = F.concat(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    payload = F.to_json(F.struct(
        "customer_id", *(["event_date"] if with_day else []), "event_id", stamp.alias("event_timestamp"), "plan_id", "product_id",
        F.col("quantity").cast("double").alias("quantity"), "region", F.lit("1.0").alias("schema_version"), "unit",
    ))
    return deliveries_.select(F.col("load_ts").cast("date").alias("dt"), F.col("load_ts").alias("ingest_ts"), payload.alias("value"))


def raw_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries as raw rows with a VARIANT payload."""
    payload = F.try_parse_json("value")
    return usage_json(deliveries(spark, sf_dir)).select(
        "ingest_ts", F.lit("API").alias("source"), "dt", F.concat(F.lit("run_"), F.col("dt").cast("string")).alias("batch_id"),
        F.concat(F.lit("usage_events_"), F.col("dt").cast("string"), F.lit(".jsonl")).alias("file_name"),
        payload.alias("payload"), F.when(payload.isNull(), F.col("value")).alias("bad_text"),
    )


def defective_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as JSON text, one kind of defect for each residue of the id modulo 20, most rows sound."""
    rows = events(spark, sf_dir)
    number = F.col("event_id").cast("bigint") % 20
    stamp = F.when(number == 4, F.lit("yesterday")).otherwise(
        F.concat(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    )
    quantity = (
        F.when(number == 5, F.lit('"many"')).when(number == 6, F.lit("-1.5"))
        .otherwise(F.col("quantity").cast("double").cast("string"))
    )

    def member(name: str, value: Column, missing: int | None = None) -> Column:
        text = F.concat(F.lit(f'"{name}":"'), value, F.lit('",'))
        return text if missing is None else F.when(number == missing, F.lit("")).otherwise(text)

    text = F.concat(
        F.lit("{"), member("event_id", F.col("event_id"), 1), member("customer_id", F.col("customer_id"), 2),
        member("product_id", F.col("product_id"), 3), member("event_timestamp", stamp), member("unit", F.col("unit")),
        F.lit('"quantity":'), quantity, F.when(number == 7, F.lit("")).otherwise(F.lit("}")),
    )
    payload = F.try_parse_json("value")
    return rows.select("event_id", F.col("load_ts").alias("ingest_ts"), "event_date", "batch_id", "source", text.alias("value")).select(
        "ingest_ts", "source", F.col("event_date").alias("dt"), "batch_id", payload.alias("payload"),
        F.when(payload.isNull(), F.col("value")).alias("bad_text"),
    )


def _plan_index() -> Column:
    segment = F.col("c_mktsegment")
    return F.when(segment == "HOUSEHOLD", 0).when(segment == "AUTOMOBILE", 1).when(segment == "MACHINERY", 3).otherwise(2)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer at three snapshot times; some change plan at the second, some at the third."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customer = table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    at = F.posexplode(F.array(*[ntz(t) for t in SNAPSHOT_TIMES])).alias("round", "ingest_ts")
    rows = customer.select("*", at)
    moves = F.when((F.col("round") >= 1) & (F.col("c_custkey") % 7 == 0), 1).otherwise(0) + F.when(
        (F.col("round") >= 2) & (F.col("c_custkey") % 11 == 0), 1
    ).otherwise(0)
    status = F.when(F.col("c_custkey") % 5 < 3, "active").when(F.col("c_custkey") % 5 == 3, "delinquent").otherwise("cancelled")
    return rows.select(
        F.col("c_custkey").alias("customer_sk"), F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.col("c_name").alias("customer_name"), status.alias("status"), F.col("n_name").alias("country"),
        _pick(PLANS, _plan_index() + moves).alias("plan_id"), "ingest_ts",
    )


def snapshot_at(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    moment = ntz(SNAPSHOT_TIMES[number])
    return snapshots(spark, sf_dir).where(F.col("ingest_ts") == moment)


def customer_json(rows: DataFrame) -> DataFrame:
    """Snapshot rows as JSON lines."""
    return rows.select(F.to_json(F.struct(
        "customer_id", "customer_name", "plan_id", "status", "country", F.col("ingest_ts").cast("string").alias("updated_at")
    )).alias("value"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One current version per customer, from the first snapshot."""
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    return table(spark, sf_dir, "customer").join(nation, "c_nationkey").selectExpr(
        "c_custkey AS customer_sk", "concat('cust_', c_custkey) AS customer_id", "c_name AS customer_name",
        "CASE WHEN c_custkey % 5 < 3 THEN 'active' WHEN c_custkey % 5 = 3 THEN 'delinquent' ELSE 'cancelled' END AS status",
        "n_name AS country",
        "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'plan_free' WHEN 'AUTOMOBILE' THEN 'plan_starter'"
        " WHEN 'MACHINERY' THEN 'plan_enterprise' ELSE 'plan_pro' END AS plan_id",
        f"TIMESTAMP_NTZ'{SNAPSHOT_TIMES[0]}' AS effective_start", "true AS is_current",
    )


def rates(spark: SparkSession) -> DataFrame:
    """The ten catalog rates, valid from 2024-01-01 with an open end."""
    rows = spark.sql(f"SELECT * FROM VALUES {CATALOG} AS t(rate_sk, product_id, plan_id, unit, unit_price)")
    return rows.selectExpr(
        "cast(rate_sk AS BIGINT) AS rate_sk", "product_id", "plan_id", "unit", f"cast(unit_price AS {PRICE.simpleString()}) AS unit_price",
        "'USD' AS currency", "DATE'2024-01-01' AS effective_from", "cast(NULL AS DATE) AS effective_to", "true AS is_current",
    )


def two_version_rates(spark: SparkSession) -> DataFrame:
    """Each rate in two versions: until 2024-01-15, then at double the price."""
    version = F.explode(F.array(F.lit(0), F.lit(1))).alias("version")
    rows = rates(spark).select("*", version)
    later = F.col("version") == 1
    return rows.select(
        (F.col("rate_sk") + F.when(later, 100).otherwise(0)).alias("rate_sk"), "product_id", "plan_id", "unit",
        (F.col("unit_price") * F.when(later, 2).otherwise(1)).cast(PRICE).alias("unit_price"), "currency",
        F.when(later, F.lit("2024-01-16")).otherwise(F.lit("2024-01-01")).cast("date").alias("effective_from"),
        F.when(~later, F.lit("2024-01-15")).cast("date").alias("effective_to"), later.alias("is_current"),
    )


def plans(spark: SparkSession) -> DataFrame:
    rows = spark.sql(f"SELECT * FROM VALUES {PLAN_ROWS} AS t(plan_id, plan_name, base_fee, currency)")
    return rows.withColumn("base_fee", F.col("base_fee").cast("decimal(18,2)"))


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large price catalog in file form: one rate per part, many per product and plan."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("rate_"), key.cast("string")).alias("rate_id"),
        F.concat(F.lit("prod_"), F.lower("p_type")).alias("product_id"),
        F.concat(F.lit("plan_"), F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")))).alias("plan_id"),
        F.when(F.col("p_size") % 2 == 0, "each").otherwise("box").alias("unit"),
        (F.col("p_retailprice").cast("decimal(18,2)") / F.lit(1000).cast("decimal(18,0)")).cast("decimal(18,5)").cast("string").alias("unit_price"),
        F.lit("USD").alias("currency"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 365).cast("int")).cast("string").alias("effective_from"),
        F.when(key % 3 == 0, F.lit("2025-12-31")).alias("effective_to"),
    )


def catalog_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large catalog typed, with a load time per rate."""
    loaded = ntz("2024-01-01 00:00:00") + F.make_dt_interval(
        secs=F.substr("rate_id", F.lit(6)).cast("decimal(18,6)")
    )
    return part_catalog(spark, sf_dir).select(
        "product_id", "plan_id", "unit", F.col("unit_price").cast(PRICE).alias("unit_price"), "currency",
        F.col("effective_from").cast("date").alias("effective_from"), F.col("effective_to").cast("date").alias("effective_to"),
        loaded.alias("ingest_ts"), F.lit("catalog").alias("batch_id"),
    )


def order_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily costs over many months: order lines by ship date, customer and part type."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    joined = lines.join(orders, "l_orderkey").join(part, "l_partkey")
    return joined.groupBy(
        F.col("l_shipdate").cast("date").alias("date_id"), F.col("o_custkey").alias("customer_sk"),
        F.concat(F.lit("prod_"), F.lower("p_type")).alias("product_id"), F.lit("each").alias("unit"),
    ).agg(
        F.sum(F.col("l_quantity").cast(QUANTITY)).cast("decimal(28,6)").alias("total_quantity"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast(AMOUNT).alias("cost_amount"),
    ).withColumn("currency", F.lit("USD"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their repeated natural key and an order that has no ties."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp_ntz").alias("l_shipdate"), "l_partkey",
        F.col("l_quantity").cast(QUANTITY).alias("quantity"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.daily_usage(events(spark, sf_dir))


def on_time_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events loaded before the invoices were issued."""
    return events(spark, sf_dir).where(F.col("load_ts") <= ntz(ISSUED))


def costs(spark: SparkSession, sf_dir: str, *, match_plan: bool = True, source: DataFrame | None = None) -> DataFrame:
    days = usage.daily_usage(events(spark, sf_dir) if source is None else source)
    return pricing.daily_cost(days, customers(spark, sf_dir), rates(spark), match_plan=match_plan)


class Billing(NamedTuple):
    """A daily cost table written once, and the invoices and lines closed from it."""

    costs: DataFrame
    headers: DataFrame
    lines: DataFrame


def billing(spark: SparkSession, sf_dir: str, *, match_plan: bool = True, source: DataFrame | None = None) -> Billing:
    facts = stage(costs(spark, sf_dir, match_plan=match_plan, source=source), "costs")
    headers = invoicing.close_headers(facts, *PERIOD, issued_ts=ISSUED)
    return Billing(facts, headers, stage(invoicing.usage_lines(facts, headers, rates(spark), calc_batch_id="close"), "lines"))


def invoices(spark: SparkSession, sf_dir: str, *, match_plan: bool = True) -> DataFrame:
    return invoicing.close_headers(costs(spark, sf_dir, match_plan=match_plan), *PERIOD, issued_ts=ISSUED)
