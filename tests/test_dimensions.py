import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from making import day, rows, table, ts
from tallyflow.functions.keys import surrogate_key
from tallyflow.operators import dimensions
from tallyflow.sources import lake as lk

SNAPSHOT = "customer_id string, customer_name string, status string, country string, plan_id string, ingest_ts timestamp_ntz"


def snapshots(spark, *items):
    return table(spark, [(c, "n", "active", "US", plan, ts(at)) for c, plan, at in items], SNAPSHOT)


def test_versions_follow_changes_only(spark):
    df = snapshots(
        spark, ("c", "A", "2024-01-01"), ("c", "A", "2024-01-20"), ("c", "B", "2024-02-03"), ("c", "B", "2024-02-03"),
        ("c", "A", "2024-04-01"), ("d", "A", "2024-01-01"),
    )
    got = dimensions.customer_history(df).select(
        "customer_id", "plan_id", F.col("effective_start").cast("date").cast("string"), F.col("effective_end").cast("date").cast("string"), "is_current"
    )
    assert rows(got) == [
        ("c", "A", "2024-01-01", "2024-02-03", False), ("c", "A", "2024-04-01", None, True),
        ("c", "B", "2024-02-03", "2024-04-01", False), ("d", "A", "2024-01-01", None, True),
    ]


def test_history_does_not_depend_on_the_bucket(spark):
    rng = random.Random(7)
    items = [("hot" if i % 3 else f"c{i % 5}", rng.choice("ABC"), f"2024-0{rng.randint(1, 6)}-{rng.randint(10, 28)}T0{rng.randint(0, 9)}:00:00") for i in range(400)]
    df = snapshots(spark, *items)
    whole = rows(dimensions.customer_history(df, bucket=F.lit("one")))
    assert rows(dimensions.customer_history(df)) == whole
    assert rows(dimensions.customer_history(df, bucket=F.col("ingest_ts").cast("date"))) == whole
    # Brute force over the same rows.
    best = {}
    for customer, plan, at, h in df.select("customer_id", "plan_id", "ingest_ts", surrogate_key(*dimensions.CUSTOMER_ATTRIBUTES)).collect():
        best[customer, at] = max(best.get((customer, at), ("", "")), (h, plan))
    expected, last = 0, {}
    for (customer, at), (h, _) in sorted(best.items()):
        expected += last.get(customer) != h
        last[customer] = h
    assert len(whole) == expected


def test_applying_a_snapshot_closes_and_opens(spark):
    history = dimensions.customer_history(snapshots(spark, ("c", "A", "2024-01-01"), ("d", "A", "2024-01-01"), ("e", "A", "2024-01-01")))
    snap = snapshots(spark, ("c", "B", "2024-02-01"), ("d", "A", "2024-02-01"), ("f", "A", "2024-02-01"))
    once = dimensions.apply_snapshot(history, snap, "2024-02-01 00:00:00")
    got = once.select("customer_id", "plan_id", F.col("effective_end").cast("date").cast("string"), "is_current")
    assert rows(got) == [
        ("c", "A", "2024-02-01", False), ("c", "B", None, True), ("d", "A", None, True), ("e", "A", None, True), ("f", "A", None, True),
    ]
    assert rows(dimensions.apply_snapshot(once, snap, "2024-03-01 00:00:00")) == rows(once)


def test_rate_versions_touch_without_overlap(spark):
    from decimal import Decimal

    df = table(
        spark, [("p", "plan", "u", Decimal(price), "USD", day(start), day(end) if end else None, ts(load)) for price, start, end, load in (
            ("1", "2024-01-01", None, "2024-01-01"), ("2", "2024-02-01", None, "2024-01-02"), ("3", "2024-02-01", None, "2024-01-03"),
            ("4", "2024-03-01", "2024-03-10", "2024-01-03"), ("5", "2024-05-01", None, "2024-01-03"),
        )],
        "product_id string, plan_id string, unit string, unit_price decimal(18,10), currency string, effective_from date, effective_to date, ingest_ts timestamp_ntz",
    )
    got = dimensions.rate_versions(df).select(F.col("unit_price").cast("int"), F.col("effective_from").cast("string"), F.col("effective_to").cast("string"), "is_current")
    assert rows(got) == [
        (1, "2024-01-01", "2024-01-31", False), (3, "2024-02-01", "2024-02-29", False), (4, "2024-03-01", "2024-03-10", False), (5, "2024-05-01", None, True),
    ]


def test_keys_tell_null_from_empty(spark):
    df = table(spark, [("a", None), ("a", ""), ("a", "_null_x")], "x string, y string")
    assert df.select(surrogate_key("x", "y")).distinct().count() == 3


def test_date_dimension_is_iso(spark):
    got = {str(r.date_id): r for r in dimensions.date_dimension(spark, "2024-02-28", "2024-03-03").collect()}
    assert len(got) == 5
    assert got["2024-03-03"].day_of_week == 7 and got["2024-03-03"].is_weekend
    assert got["2024-02-29"].day_of_week == 4 and not got["2024-02-29"].is_weekend and got["2024-02-29"].quarter == 1


def spliced(spark, *loads):
    """Versions (price, from, to, is_current) of one key after loads of (price, from, to)."""
    from tallyflow import schemas

    stored = table(spark, [], schemas.RATE_DIM)
    for number, load in enumerate(loads):
        items = [("p", "pro", "u", Decimal(price), "USD", day(start), day(end) if end else None, ts("2024-01-01") + dt.timedelta(days=number)) for price, start, end in load]
        incoming = table(spark, items, "product_id string, plan_id string, unit string, unit_price decimal(18,10), currency string, effective_from date, effective_to date, ingest_ts timestamp_ntz")
        out = dimensions.splice_rates(stored, incoming)
        stored = table(spark, [tuple(r) for r in out.collect()], schemas.RATE_DIM)
        assert dimensions.overlapping_rates(stored).isEmpty()
    got = stored.orderBy("effective_from").collect()
    return [(str(int(r.unit_price)), str(r.effective_from), r.effective_to and str(r.effective_to), r.is_current) for r in got]


def test_a_new_price_closes_the_old_one_and_a_reload_changes_nothing(spark):
    old, new = [("1", "2024-01-01", None)], [("2", "2024-02-01", None)]
    want = [("1", "2024-01-01", "2024-01-31", False), ("2", "2024-02-01", None, True)]
    assert spliced(spark, old, new) == want
    assert spliced(spark, old, new, new) == want
    assert spliced(spark, new, old) == want  # the older price comes late


def test_a_closed_price_splits_an_open_one_and_swallows_what_it_covers(spark):
    base = [("1", "2024-01-01", None)]
    assert spliced(spark, base, [("5", "2024-02-01", "2024-02-14")]) == [
        ("1", "2024-01-01", "2024-01-31", False), ("5", "2024-02-01", "2024-02-14", False), ("1", "2024-02-15", None, True)]
    many = [("1", "2024-01-01", "2024-01-10"), ("2", "2024-01-20", "2024-01-25"), ("3", "2024-02-01", None)]
    assert spliced(spark, many, [("9", "2024-01-05", "2024-02-03")]) == [
        ("1", "2024-01-01", "2024-01-04", False), ("9", "2024-01-05", "2024-02-03", False), ("3", "2024-02-04", None, True)]
    assert spliced(spark, base, [("7", "2024-01-10", "2024-01-12"), ("8", "2024-01-20", "2024-01-20")]) == [
        ("1", "2024-01-01", "2024-01-09", False), ("7", "2024-01-10", "2024-01-12", False), ("1", "2024-01-13", "2024-01-19", False),
        ("8", "2024-01-20", "2024-01-20", False), ("1", "2024-01-21", None, True)]


def test_stored_history_prices_a_day_once(spark, lake):
    from tallyflow.plans import dimension_load

    load = "product_id string, plan_id string, unit string, unit_price decimal(18,10), currency string, effective_from date, effective_to date, ingest_ts timestamp_ntz"
    first = [(p, "pro", "u", Decimal(1), c, day("2024-01-01"), None, ts("2024-01-01")) for p, c in (("p", "USD"), ("q", "EUR"), ("r", "USD"))]
    second = [("p", "pro", "u", Decimal(2), "EUR", day("2024-02-01"), None, ts("2024-02-01"))]
    for items in (first, second, second):
        dimension_load.load_rate_history(lake, table(spark, items, load))
    got = lake.read(lk.RATE_DIM).where("DATE'2024-03-10' BETWEEN effective_from AND coalesce(effective_to, DATE'9999-12-31')")
    assert sorted((r.product_id, int(r.unit_price), r.currency) for r in got.collect()) == [("p", 2, "EUR"), ("q", 1, "EUR"), ("r", 1, "USD")]
    assert lake.read(lk.RATE_DIM).count() == 4
