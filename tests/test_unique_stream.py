"""The log of unique events: every event once, by its newest delivery, at any lateness and after replays."""

import random

import pytest
from making import event, events, rows

from tallyflow.operators import merge
from tallyflow.operators.event_index import groups_holding
from tallyflow.streaming import usage as streams

FIRST = [event("a", "2024-01-01T01:00:00", quantity="1"), event("b", "2024-01-01T02:00:00", quantity="2")]
SECOND = [event("a", "2024-01-01T01:00:00", quantity="1"), event("c", "2024-01-02T01:00:00", quantity="3")]
THIRD = [
    event("a", "2024-03-01T01:00:00", quantity="7", raw_hash="newer"),  # sixty days late, and newer
    event("b", "2023-12-01T02:00:00", quantity="9", raw_hash="older"), event("d", "2024-03-01T01:00:00"),
]


def found(df):
    return rows(df.selectExpr("event_id", "cast(quantity AS INT)", "cast(event_ts AS STRING)"))


WANTED = [
    ("a", 7, "2024-03-01 01:00:00"), ("b", 2, "2024-01-01 02:00:00"), ("c", 3, "2024-01-02 01:00:00"), ("d", 1, "2024-03-01 01:00:00"),
]


@pytest.fixture
def log(spark, tmp_path):
    target = str(tmp_path / "log")
    for epoch, batch in enumerate((FIRST, SECOND, THIRD)):
        streams.add_unique(events(spark, *batch), epoch, target)
    return target


def test_each_event_once_by_its_newest_delivery(spark, log):
    assert found(streams.current_unique(spark, log)) == WANTED


def test_repeated_deliveries_store_nothing(spark, log):
    stored = spark.read.parquet(f"{log}/events")
    assert stored.groupBy("epoch").count().orderBy("epoch").collect() == [(0, 2), (1, 1), (2, 2)]
    assert rows(spark.read.parquet(f"{log}/replaced").select("event_id", "epoch")) == [("a", 2)]


@pytest.mark.parametrize("epoch, batch", [(0, FIRST), (1, SECOND), (2, THIRD)])
def test_a_replayed_epoch_changes_nothing(spark, log, epoch, batch):
    streams.add_unique(events(spark, *batch), epoch, log)
    assert found(streams.current_unique(spark, log)) == WANTED


def test_replacements_without_their_deliveries_do_not_count(spark, log, tmp_path):
    """A write that stopped before its deliveries were stored."""
    gone = spark.createDataFrame([("c", "h")], "event_id string, raw_hash string")
    gone.selectExpr("event_id", "TIMESTAMP_NTZ'2024-01-02 01:00:00' AS event_ts", "raw_hash").write.parquet(f"{log}/replaced/epoch=3")
    assert found(streams.current_unique(spark, log)) == WANTED


def test_compacted_log_goes_on(spark, log, tmp_path):
    short = str(tmp_path / "short")
    assert found(streams.compact_unique(spark, log, short)) == WANTED
    again = [event("a", "2024-03-01T01:00:00", quantity="7", raw_hash="newer"), event("e", "2024-03-02T01:00:00")]
    streams.add_unique(events(spark, *again), 3, short)
    assert found(streams.current_unique(spark, short)) == [*WANTED, ("e", 1, "2024-03-02 01:00:00")]


def test_no_rows_and_no_ids(spark, tmp_path):
    target = str(tmp_path / "log")
    streams.add_unique(events(spark), 0, target)
    assert found(streams.current_unique(spark, target)) == []
    streams.add_unique(events(spark, event(None, "2024-01-01T01:00:00"), *FIRST), 1, target)
    assert found(streams.current_unique(spark, target)) == found(events(spark, *FIRST))


def test_random_batches_equal_the_batch_form(spark, tmp_path):
    pick = random.Random(4)
    target = str(tmp_path / "log")
    every = []
    for epoch in range(4):
        batch = [
            event(f"e{pick.randrange(40)}", f"2024-01-{pick.randrange(1, 4):02d}T00:00:00", quantity=str(pick.randrange(9)), raw_hash=f"h{pick.randrange(3)}")
            for _ in range(60)
        ]
        # one payload per (event, time, hash)
        batch = [(*r[:8], hash((r[0], r[1], r[12])) % 7, *r[9:]) for r in batch]
        every += batch
        streams.add_unique(events(spark, *batch), epoch, target)
    assert found(streams.current_unique(spark, target)) == found(merge.dedupe_events(events(spark, *every)))


def test_only_epochs_that_hold_an_event_are_read(spark, log):
    index = spark.read.option("basePath", f"{log}/index").parquet(f"{log}/index/epoch=*")
    asked = events(spark, event("c", "2024-01-02T01:00:00"), event("unknown", "2024-01-02T01:00:00"))
    assert rows(groups_holding(index, asked, "epoch")) == [(1,)]


def test_reading_groups_no_events(spark, log):
    plan = streams.current_unique(spark, log)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") == 1  # the replaced deliveries alone
