"""Streams against their SQL where a second delivery lies past midnight, and where deliveries come in the wrong order."""

import os
import shutil

import duckdb
import pytest
from comparing import connect, difference
from making import rows
from pyspark.sql import functions as F
from test_event_index import land, line

from __spark_entry__ import oracle_sql, queries
from tallyflow.operators import merge
from tallyflow.sources import lake as lk
from tallyflow.streaming import usage as streams

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def midnight(tmp_path_factory):
    """sf0.001 with every delivered-twice event in the last second of its day."""
    folder = str(tmp_path_factory.mktemp("midnight"))
    for name in os.listdir(SF):
        if name.endswith(".parquet") and name != "events.parquet":
            shutil.copy(f"{SF}/{name}", folder)
    late = "CASE WHEN event_id % 100 = 0 THEN date_trunc('day', ts) + INTERVAL 86399500 MILLISECOND ELSE ts END"
    duckdb.sql(f"COPY (SELECT * REPLACE ({late} AS ts) FROM '{SF}/events.parquet') TO '{folder}/events.parquet'")
    return folder


@pytest.mark.parametrize("name", ["m3_stream_daily_usage", "m3_compacted", "m4_stream_upsert", "a8_backfill"])
def test_a_second_delivery_past_midnight_equals_sql(spark, midnight, name):
    assert difference(queries()[name](spark, midnight), connect(midnight), oracle_sql()[name]) is None


def test_an_older_delivery_in_a_later_micro_batch_replaces_nothing(spark, lake, tmp_path):
    folder = str(tmp_path / "in")
    land(folder, 1, line("a", "2024-01-01T08:00:01", 2), line("b", "2024-01-01T08:00:00", 3))
    land(folder, 2, line("a", "2024-01-01T08:00:00", 1), line("b", "2024-01-02T08:00:00", 4))
    raw = streams.raw_stream(spark, folder, source="API", batch_id="s", files_per_batch=1)
    streams.drain_clean(raw, lake, str(tmp_path / "ck"), merge.REPLACE, None).awaitTermination()
    got = lake.read(lk.USAGE_CLEAN).select("event_id", F.col("event_ts").cast("string"), F.col("quantity").cast("int"))
    assert rows(got) == [("a", "2024-01-01 08:00:01", 2), ("b", "2024-01-02 08:00:00", 4)]
