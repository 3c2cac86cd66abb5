"""The as-of join against brute force, and merge counters taken while writing."""

import random

import pytest
from making import event, events, rows, table

from tallyflow.functions.joins import as_of_join
from tallyflow.operators import audit, merge
from tallyflow.sources import lake as lk


@pytest.mark.parametrize("salts", [1, 16])
def test_newest_version_not_after_the_row(spark, salts):
    pick = random.Random(salts)
    left = [(n, pick.choice(["a", "a", "a", "b", "c", None]), pick.choice([None, *range(20)])) for n in range(200)]
    right = [(k, t, f"{k}{t}") for k in ("a", "b", "d") for t in sorted(pick.sample(range(3, 20), 5))] + [("a", None, "never"), (None, 0, "none")]
    got = as_of_join(
        table(spark, left, "id int, k string, at int"), table(spark, right, "k string, since int, v string"), ["k"], "at", "since", ["id"], salts
    )
    wanted = []
    for n, k, at in left:
        before = [(t, v) for key, t, v in right if key is not None and key == k and t is not None and at is not None and t <= at]
        if before:
            wanted.append((n, k, at, *max(before)))
    assert got.columns == ["id", "k", "at", "since", "v"] and rows(got) == sorted(wanted, key=str)


def test_equal_starts_and_no_rows(spark):
    left = table(spark, [(1, "a", 5)], "id int, k string, at int")
    right = table(spark, [("a", 5, "x"), ("a", 5, "y")], "k string, since int, v string")
    assert rows(as_of_join(left, right, ["k"], "at", "since", ["id"])) == [(1, "a", 5, 5, "y")]
    assert rows(as_of_join(left.where("false"), right, ["k"], "at", "since", ["id"])) == []
    assert rows(as_of_join(left, right.where("false"), ["k"], "at", "since", ["id"])) == []


def test_one_shuffle(spark):
    left = spark.range(100).selectExpr("id", "cast(id % 3 AS STRING) AS k", "id AS at")
    right = spark.range(9).selectExpr("cast(id % 3 AS STRING) AS k", "id AS since", "id AS v")
    plan = as_of_join(left, right, ["k"], "at", "since", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_counters_of_a_merge(spark, lake):
    first = [event(f"e{n}", "2024-01-01T01:00:00") for n in range(5)]
    counted = lambda *items: tuple(audit.observed_counters(spark, merge.counted_merge(lake, events(spark, *items))[2]).first())
    assert counted(*first) == (5, 0)
    assert counted(*first, event("e0", "2024-01-02T01:00:00", raw_hash="z"), event("new", "2024-01-02T01:00:00")) == (1, 1)
    assert counted() == (0, 0)
    assert lake.read(lk.USAGE_CLEAN).count() == 6
