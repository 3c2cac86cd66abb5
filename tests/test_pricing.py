from decimal import Decimal

from pyspark.sql import functions as F

from making import customers, event, events, rates, rows, table
from tallyflow.functions.joins import keyed_join, salted_join, skew_join
from tallyflow.functions.money import amount_of, share_of
from tallyflow.operators import dimensions, pricing, quality, usage

RATES = [
    (1, "prod_api_requests", "plan_pro", "requests", "0.00008", "2024-01-01", "2024-01-15"),
    (2, "prod_api_requests", "plan_pro", "requests", "0.00016", "2024-01-16", None),
    (3, "prod_api_requests", "plan_starter", "requests", "0.0001", "2024-01-01", None),
]


def test_amounts_keep_every_digit(spark):
    df = table(spark, [(Decimal("999999999999.999999"), Decimal("0.000002")), (Decimal("0.000001"), Decimal("0.0001"))], "q decimal(28,6), p decimal(18,10)")
    assert [r[0] for r in df.select(amount_of(F.col("q"), F.col("p"))).collect()] == [Decimal("2000000"), Decimal("0.0000000001")]


def test_share_is_rounded_to_cents(spark):
    df = table(spark, [(Decimal("12.3456789"),), (Decimal("0.0625"),)], "a decimal(38,10)")
    assert [r[0] for r in df.select(share_of(F.col("a"), "0.08").cast("string")).collect()] == ["0.9900000000", "0.0100000000"]


def daily(spark, *items):
    return usage.daily_usage(events(spark, *items))


def test_rate_interval_is_closed_on_both_ends(spark):
    days = daily(spark, *[event(d, d) for d in ("2023-12-31", "2024-01-01", "2024-01-15", "2024-01-16", "2025-01-01")])
    got = pricing.daily_cost(days, customers(spark, (1, "cust_1", "plan_pro", True)), rates(spark, *RATES))
    assert rows(got.select(F.col("date_id").cast("string"), "rate_sk")) == [("2024-01-01", 1), ("2024-01-15", 1), ("2024-01-16", 2), ("2025-01-01", 2)]


def test_without_plan_every_plan_bills(spark):
    days = daily(spark, event("a", "2024-01-20"))
    people = customers(spark, (1, "cust_1", "plan_pro", True), (9, "cust_1", "plan_starter", False))
    assert rows(pricing.daily_cost(days, people, rates(spark, *RATES), match_plan=False).select("customer_sk", "rate_sk")) == [(1, 2), (1, 3)]
    assert rows(pricing.daily_cost(days, people, rates(spark, *RATES)).select("customer_sk", "rate_sk")) == [(1, 2)]


def test_unpriced_usage_is_counted_not_lost(spark):
    days = daily(spark, event("a", "2024-01-20"), event("b", "2024-01-20", unit="other"), event("c", "2024-01-20", customer="nobody"))
    assert quality.pricing_coverage(days, rates(spark, *RATES)).first().violations == 1
    assert quality.pricing_coverage(days, rates(spark, *RATES), customers(spark, (1, "cust_1", "plan_pro", True))).first().violations == 2


def hot_sides(spark):
    left = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(60).select(
        F.when(F.col("id") < 20, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 30).cast("string"))).alias("k"), F.col("id").alias("w")
    )
    return left, right


def test_salted_and_skew_joins_equal_the_plain_join(spark):
    left, right = hot_sides(spark)
    within = F.col("l.v") % 7 == F.col("r.w") % 7
    for how in ("inner", "left", "left_anti", "left_semi"):
        plain = keyed_join(left, right, ["k"], within, how)
        columns = plain.columns
        expected = sorted(map(tuple, plain.collect()), key=str)
        for other in (
            salted_join(left, right, ["k"], ["v"], within, how), skew_join(left, right, ["k"], ["v"], within, how, salts=5, share=10),
        ):
            assert sorted(map(tuple, other.select(*columns).collect()), key=str) == expected


def test_skew_join_spreads_the_hot_key(spark):
    left, right = hot_sides(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = skew_join(left, right, ["k"], ["v"]).where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 3


def test_version_in_force_at_the_moment(spark):
    snaps = table(
        spark, [("cust_1", "n", "active", "US", plan, at) for plan, at in (("A", "2024-01-01 00:00:00"), ("B", "2024-01-31 12:00:00"), ("C", "2024-03-01 00:00:00"))],
        "customer_id string, customer_name string, status string, country string, plan_id string, at string",
    ).withColumn("ingest_ts", F.col("at").cast("timestamp_ntz"))
    history = dimensions.customer_history(snaps)
    usage_rows = events(
        spark, event("before", "2023-12-31T23:00:00"), event("a", "2024-01-31T11:59:59"), event("b", "2024-01-31T12:00:00"),
        event("b2", "2024-02-15"), event("c", "2024-03-01"), event("late", "2024-05-31T23:59:59"),
    ).drop("plan_id")
    got = pricing.customer_at(usage_rows, history, at="event_ts")
    assert rows(got.select("event_id", "plan_id")) == [("a", "A"), ("b", "B"), ("b2", "B"), ("c", "C"), ("late", "C")]


def test_weighted_average_price(spark):
    costs = table(
        spark, [("2024-01-01", 1, 1), ("2024-01-02", 1, 1), ("2024-01-03", 1, 2), ("2024-01-03", 1, 99)], "d string, customer_sk long, rate_sk long"
    ).select(F.col("d").cast("date").alias("date_id"), "customer_sk", "rate_sk", F.lit("USD").alias("currency"))
    got = usage.usage_window(costs, rates(spark, *RATES), ["customer_sk"]).first()
    assert str(got.avg_unit_price) == "0.0001066667"
    assert (str(got.usage_window_start), str(got.usage_window_end), got.max_rate_sk) == ("2024-01-01", "2024-01-03", 99)
