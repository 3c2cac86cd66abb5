"""Filters over event ids: never a miss, few false names, and untouched days that are not read."""

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from making import day, event, events, rows, table
from tallyflow.operators import event_index, merge, parse
from tallyflow.sources import lake as lk
from tallyflow.streaming import usage as streams


def ids(spark, first, last, group=None):
    df = spark.range(first, last).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"))
    return df if group is None else df.withColumn("g", group)


def test_a_filter_never_misses_and_rarely_errs(spark):
    """Groups of very different size; 40,000 ids of one group, one id each of the others."""
    held = ids(spark, 0, 40000, F.lit(-1)).union(ids(spark, 0, 200, F.expr("cast(substring(event_id, 2) AS INT)")))
    index = event_index.build_index(held, "g").cache()
    assert rows(event_index.groups_holding(index, ids(spark, 0, 200), "g")) == sorted([(g,) for g in range(-1, 200)], key=str)
    assert rows(event_index.groups_holding(index, ids(spark, 39000, 40000), "g")) == [(-1,)]
    # 5,000 strange ids against the large group: each is named with a chance of six in a million.
    assert rows(event_index.groups_holding(index, ids(spark, 50000, 55000), "g")) == []
    index.unpersist()


def test_empty_null_and_repeated_ids(spark):
    none = table(spark, [(None, 1), (None, 2)], "event_id string, g int")
    index = event_index.build_index(none, "g")
    assert index.count() == 0
    assert event_index.groups_holding(index, ids(spark, 0, 3), "g").count() == 0
    twice = table(spark, [("a", 1), ("a", 1), ("", 2), ("a", None)], "event_id string, g int")
    index = event_index.build_index(twice, "g")
    asked = table(spark, [("a",), (None,), ("a",)], "event_id string")
    assert rows(event_index.groups_holding(index, asked, "g")) == [(1,), (None,)]
    assert rows(event_index.groups_holding(index, table(spark, [("",)], "event_id string"), "g")) == [(2,)]


def test_no_nested_loop_join(spark, tmp_path):
    held = ids(spark, 0, 10, F.lit(1))
    held.write.parquet(str(tmp_path / "held"))
    index = event_index.build_index(spark.read.parquet(str(tmp_path / "held")), "g")
    index.write.parquet(str(tmp_path / "index"))
    found = event_index.groups_holding(spark.read.parquet(str(tmp_path / "index")), ids(spark, 0, 10), "g")
    for df in (index, found):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert rows(found) == [(1,)]


SIXTY = [str(day("2024-01-01") + dt.timedelta(days=n)) for n in range(60)]


def test_untouched_days_are_not_read(spark, lake):
    """Sixty days; the files of all but one are made unreadable, and a merge into that day still works."""
    merge.merge_into_clean(lake, events(spark, *[event(f"e{d}", d, raw_hash="h1") for d in SIXTY]))
    touched = SIXTY[7]
    for path in glob.glob(f"{lake.path(lk.USAGE_CLEAN)}/event_date=*/*.parquet"):
        if f"event_date={touched}" not in path:
            with open(path, "wb") as file:
                file.write(b"not a parquet file")
            os.path.exists(crc := os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")) and os.remove(crc)
    again = event(f"e{touched}", touched, quantity="5", raw_hash="h2", batch="b2")
    merged, written = merge.merge_into_clean(lake, events(spark, again, event("new", touched, batch="b2")), merge.REPLACE)
    assert written == [day(touched)]
    assert rows(merged.select("event_id", "action")) == [(f"e{touched}", "update"), ("new", "insert")]
    assert lake.read(lk.USAGE_CLEAN).where(F.col("event_date") == day(touched)).count() == 2


def test_a_day_without_filter_is_looked_through(spark, lake):
    """A clean table from before there were filters."""
    lake.replace(lk.USAGE_CLEAN, events(spark, event("a", "2024-01-01", raw_hash="old"), event("b", "2024-01-02")))
    assert merge.days_that_may_hold(lake, table(spark, [("x",)], "event_id string")) == [day("2024-01-01"), day("2024-01-02")]
    _, written = merge.merge_into_clean(lake, events(spark, event("a", "2024-01-05", raw_hash="new")), merge.REPLACE)
    assert written == [day("2024-01-01"), day("2024-01-05")]
    assert rows(lake.read(lk.USAGE_CLEAN).select("event_id", F.col("event_date").cast("string"))) == [("a", "2024-01-05"), ("b", "2024-01-02")]
    assert merge.days_that_may_hold(lake, table(spark, [("x",)], "event_id string")) == [day("2024-01-02")]


def line(event_id, at, quantity, customer="cust_1"):
    return json.dumps({
        "event_id": event_id, "event_timestamp": at + "Z", "customer_id": customer, "product_id": "p", "plan_id": "plan_pro",
        "quantity": quantity, "unit": "u", "region": "r", "schema_version": "1.0",
    })


def land(folder, number, *lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"usage_events_2024-01-{number:02d}.jsonl")
    with open(path, "w") as file:
        file.write("\n".join(lines))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def parsed(spark, folder):
    return parse.parse_usage(streams.raw_stream(spark, folder, source="API", batch_id="s", files_per_batch=1))


def state(spark, target):
    got = streams.current_daily(spark, target)
    return rows(got.select(F.col("event_date").cast("string"), "customer_id", F.col("total_quantity").cast("int"), "event_count", F.col("last_event_ts").cast("string")))


EXPECTED = [
    ("2024-01-01", "cust_1", 7, 2, "2024-01-01 09:00:00"),
    ("2024-01-02", "cust_1", 4, 1, "2024-01-02 00:00:00"),
    ("2024-01-03", "cust_2", 2, 1, "2024-01-03 00:00:00"),
]


def test_repeated_corrected_moved_and_old_deliveries_count_once(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / n) for n in ("in", "days", "ck"))
    land(folder, 1, line("a", "2024-01-01T08:00:00", 5), line("b", "2024-01-01T09:00:00", 2), line("c", "2024-01-01T23:59:59", 3))
    land(folder, 2, line("a", "2024-01-01T08:00:00", 5), line("d", "2024-01-02T10:00:00", 2, "cust_2"))  # a again, as it was
    land(folder, 3, line("c", "2024-01-02T00:00:00", 4))  # corrected, and on the next day
    land(folder, 4, line("b", "2024-01-01T01:00:00", 100))  # older than what is known
    land(folder, 5, line("d", "2024-01-03T00:00:00", 2, "cust_2"), json.dumps({"quantity": 9}))  # its old day ends up empty; no id
    streams.drain_daily(parsed(spark, folder), target, checkpoint).awaitTermination()
    assert state(spark, target) == EXPECTED
    # A new checkpoint over the same files replays every epoch onto the same folders.
    streams.drain_daily(parsed(spark, folder), target, str(tmp_path / "ck2")).awaitTermination()
    assert state(spark, target) == EXPECTED
    short = str(tmp_path / "short")
    streams.compact_daily(spark, target, short)
    assert state(spark, short) == EXPECTED
    # The stream goes on at the new place and still knows the events of before.
    land(folder, 6, line("a", "2024-01-01T08:00:00", 5), line("b", "2024-01-01T09:00:01", 3))
    streams.drain_daily(parsed(spark, folder), short, checkpoint).awaitTermination()
    assert state(spark, short) == [("2024-01-01", "cust_1", 8, 2, "2024-01-01 09:00:01"), *EXPECTED[1:]]


def test_lookups_broadcast_no_table_that_grows_with_the_log(spark, tmp_path):
    """Small tables, which size estimates would send through the driver."""
    ids(spark, 0, 10, F.lit(1)).write.parquet(str(tmp_path / "held"))
    event_index.build_index(spark.read.parquet(str(tmp_path / "held")), "g").write.parquet(str(tmp_path / "index"))
    found = event_index.groups_holding(spark.read.parquet(str(tmp_path / "index")), ids(spark, 0, 10), "g")
    target = str(tmp_path / "log")
    for epoch, quantity in enumerate("12"):
        streams.add_unique(events(spark, event("a", f"2024-01-0{quantity}", quantity=quantity, raw_hash=quantity)), epoch, target)
    unique = streams.current_unique(spark, target)
    assert rows(found) == [(1,)] and unique.count() == 1
    for df in (found, unique):
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()
