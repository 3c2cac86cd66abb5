"""Late arrivals that read only what changed since their last run, against runs over the whole clean table."""

import re

from making import customers, day, event, events, rates, rows, ts
from pyspark.sql import functions as F

from tallyflow.operators import audit, merge, pricing, usage
from tallyflow.plans import late_arrivals, month_end
from tallyflow.sources import lake as lk
from tallyflow.sources.lake import Lake

PRICES = [(1, "prod_api_requests", "plan_pro", "requests", "0.5", "2024-01-01", None)]
IN_TIME = [event(f"e{d}", f"2024-01-{d:02d}T05:00:00", quantity="10") for d in range(1, 21)]
LATE = event("late", "2024-01-07T06:00:00", quantity="4", load="2024-02-03T00:00:00")


def closed(spark, lake, *items, prices=PRICES, issued="2024-02-01T04:00:00"):
    merge.merge_into_clean(lake, events(spark, *items))
    days = usage.daily_usage(lake.read(lk.USAGE_CLEAN))
    costs = pricing.daily_cost(days, people(spark), rates(spark, *PRICES)).select("*", F.lit(ts(issued)).cast("timestamp_ntz").alias("load_ts"), F.lit("r").alias("batch_id"))
    lake.replace(lk.DAILY_COST, costs)
    month_end.close_period(lake, rates(spark, *prices), day("2024-01-01"), day("2024-01-31"), run_id="close", issued_ts=ts(issued))


def people(spark):
    return customers(spark, (1, "cust_1", "plan_pro", True))


def run(spark, lake, prices=PRICES, **kw):
    kw = {"since_last": True, **kw}
    late_arrivals.reconcile_late(lake, people(spark), rates(spark, *prices), run_id="late", as_of=ts("2024-02-04T06:00:00"), **kw)


def unread(lake):
    return sorted(r.part for r in audit.unseen(late_arrivals.parts_now(lake), lake.read(lk.SEEN), late_arrivals.JOB).collect())


def total(lake):
    return rows(lake.read(lk.INVOICES).select(F.col("total").cast("double")))


def read_days(lake, parts):
    return {str(r.event_date) for r in late_arrivals.events_of(lake, parts).select("event_date").distinct().collect()}


def plan(lake, parts):
    return late_arrivals.events_of(lake, parts)._jdf.queryExecution().executedPlan().toString()


def test_only_changed_days_are_read(spark, lake):
    closed(spark, lake, *IN_TIME)
    assert len(unread(lake)) == 21  # twenty days and a month
    run(spark, lake)
    assert unread(lake) == [] and read_days(lake, []) == set()
    merge.merge_into_clean(lake, events(spark, LATE))
    assert unread(lake) == ["day 2024-01-07"] and read_days(lake, unread(lake)) == {"2024-01-07"}
    assert re.search(r"PartitionFilters: \[[^\]]*event_date#\d+ = 2024-01-07", plan(lake, unread(lake)))
    run(spark, lake)
    assert total(lake) == [(102.0,)] and unread(lake) == []
    run(spark, lake)
    assert total(lake) == [(102.0,)]


def test_equal_to_a_run_over_everything(spark, lake, tmp_path):
    other = Lake(spark, str(tmp_path / "other"))
    loads = [[LATE], [event("old stamp", "2024-01-09T01:00:00", quantity="6", load="2024-02-02T00:00:00")], [LATE, event("soon", "2024-01-09T02:00:00", load="2024-01-31T00:00:00")]]
    for one, since_last in ((lake, True), (other, False)):
        closed(spark, one, *IN_TIME)
        for load in loads:
            merge.merge_into_clean(one, events(spark, *load))
            run(spark, one, since_last=since_last)
    picked = ["invoice_id", "line_item_id", "quantity", "amount"]
    assert rows(lake.read(lk.LINE_ITEMS), *picked) == rows(other.read(lk.LINE_ITEMS), *picked)
    assert total(lake) == total(other) == [(105.0,)]


def test_a_day_with_an_event_without_rate_stays_open(spark, lake):
    closed(spark, lake, *IN_TIME)
    merge.merge_into_clean(lake, events(spark, LATE))
    run(spark, lake, prices=[(1, "prod_other", "plan_pro", "requests", "0.5", "2024-01-01", None)])
    assert unread(lake) == ["day 2024-01-07"] and total(lake) == [(100.0,)]
    run(spark, lake)
    assert unread(lake) == [] and total(lake) == [(102.0,)]


def test_a_later_close_opens_its_month_again(spark, lake):
    merge.merge_into_clean(lake, events(spark, *IN_TIME, LATE))
    run(spark, lake)
    assert unread(lake) == []
    closed(spark, lake, *IN_TIME)
    assert unread(lake) == ["month 2024-01-01"]
    assert len(read_days(lake, unread(lake))) == 20


def test_days_from_before_the_fingerprints_are_read(spark, lake):
    lake.replace(lk.USAGE_CLEAN, events(spark, *IN_TIME[:3]))
    assert len(read_days(lake, [])) == 3
