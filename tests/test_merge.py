import pytest
from pyspark.sql import functions as F

from making import customers, day, event, events, rows, table, ts
from tallyflow.operators import dedupe, merge
from tallyflow.sources import lake as lk


def test_newest_delivery_wins_and_ties_are_settled(spark):
    df = events(
        spark, event("a", "2024-01-01", quantity="1"), event("a", "2024-01-02", quantity="2"),
        event("b", "2024-01-01", quantity="3", raw_hash="x"), event("b", "2024-01-01", quantity="4", raw_hash="y"),
    )
    for copies in (1, 3):
        got = dedupe.dedupe_events(df.repartition(copies)).select("event_id", F.col("quantity").cast("int"))
        assert rows(got) == [("a", 2), ("b", 4)]


def test_repeats_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    plan = dedupe.latest_by(df, ["k"], [F.desc("id")])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_one_event_id_with_most_of_the_rows(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    got = dedupe.latest_by(df, ["k"], [F.desc("id")])
    assert got.count() == 6668
    assert got.where("k = 'hot'").first().id == 19999


TARGET = [event("a", "2024-01-01", quantity="1", raw_hash="h1"), event("b", "2024-01-02", quantity="2", raw_hash="h2")]
INCOMING = [
    event("a", "2024-01-01", quantity="9", raw_hash="h1", load="2024-02-01", batch="b2"),
    event("b", "2024-01-02", quantity="8", raw_hash="h9", load="2024-02-01", batch="b2"),
    event("c", "2024-01-03", quantity="7", raw_hash="h3", load="2024-02-01", batch="b2"),
]


@pytest.mark.parametrize("mode, expected", [
    (merge.TOUCH, [("a", 1, "b2", "h1", "update"), ("b", 2, "b2", "h9", "update"), ("c", 7, "b2", "h3", "insert")]),
    (merge.TOUCH_CHANGED, [("a", 1, "b1", "h1", "keep"), ("b", 2, "b2", "h9", "update"), ("c", 7, "b2", "h3", "insert")]),
    (merge.REPLACE, [("a", 1, "b1", "h1", "keep"), ("b", 8, "b2", "h9", "update"), ("c", 7, "b2", "h3", "insert")]),
])
def test_merge_modes(spark, mode, expected):
    got = merge.merge_events(events(spark, *TARGET), events(spark, *INCOMING), mode)
    assert rows(got.select("event_id", F.col("quantity").cast("int"), "batch_id", "raw_hash", "action")) == expected


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        merge.merge_events(events(spark, *TARGET), events(spark, *INCOMING), "other")


def test_stored_merge_touches_only_needed_days_and_can_be_repeated(spark, lake):
    merge.merge_into_clean(lake, events(spark, *TARGET, event("z", "2024-01-09")))
    before = rows(lake.read(lk.USAGE_CLEAN))
    _, days = merge.merge_into_clean(lake, events(spark, *INCOMING))
    assert days == [day("2024-01-01"), day("2024-01-02"), day("2024-01-03")]
    once = rows(lake.read(lk.USAGE_CLEAN))
    merge.merge_into_clean(lake, events(spark, *INCOMING))
    assert rows(lake.read(lk.USAGE_CLEAN)) == once
    assert len(once) == len(before) + 1


def test_match_on_another_day_is_found(spark, lake):
    """The id is looked up over all days, whatever day the new delivery claims."""
    merge.merge_into_clean(lake, events(spark, event("a", "2024-01-01", quantity="1", raw_hash="old")))
    merge.merge_into_clean(lake, events(spark, event("a", "2024-01-05", quantity="2", raw_hash="new")), merge.REPLACE)
    assert rows(lake.read(lk.USAGE_CLEAN).select("event_id", F.col("event_date").cast("string"), F.col("quantity").cast("int"))) == [
        ("a", "2024-01-05", 2)
    ]


def test_customer_upsert_keeps_country(spark):
    dim = customers(spark, (1, "c1", "plan_free", True), (2, "c2", "plan_pro", True))
    incoming = table(
        spark, [("c1", "New", "cancelled", "DE", "plan_pro"), ("c3", "Third", "active", "FR", "plan_free")],
        "customer_id string, customer_name string, status string, country string, plan_id string",
    )
    got = merge.upsert_customers(dim, incoming, ts("2024-02-01"))
    assert rows(got.select("customer_id", "customer_name", "status", "country", "plan_id", "is_current")) == [
        ("c1", "New", "cancelled", "US", "plan_pro", True), ("c2", "Name c2", "active", "US", "plan_pro", True),
        ("c3", "Third", "active", "FR", "plan_free", True),
    ]
    assert got.select("customer_sk").distinct().count() == 3
