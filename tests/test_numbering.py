"""Dense keys and the bitmaps over them."""

import random

from making import rows, table
from pyspark.sql import functions as F

from tallyflow.operators import numbering, usage
from tallyflow.plans import dimension_load
from tallyflow.sources import lake as lk


def ids(spark, *names):
    return table(spark, [(n,) for n in names], "customer_id string")


def test_numbers_run_on_without_gaps_and_stay(spark, lake):
    first = [f"c{n}" for n in range(500)]
    random.Random(1).shuffle(first)
    dimension_load.assign_customer_keys(lake, ids(spark, *first, *first[:50], None), "one")
    one = dict(rows(lake.read(lk.CUSTOMER_KEYS), "customer_id", "customer_sk"))
    assert one == {name: n for n, name in enumerate(sorted(first), 1)}
    dimension_load.assign_customer_keys(lake, ids(spark, "a", "zz", None, *first[:10]), "two")
    two = dict(rows(lake.read(lk.CUSTOMER_KEYS), "customer_id", "customer_sk"))
    assert two == {**one, "a": 501, "zz": 502}
    for name in ("two", "one", "three"):  # reruns add nothing
        dimension_load.assign_customer_keys(lake, ids(spark, "a", "zz", *first), name)
    assert dict(rows(lake.read(lk.CUSTOMER_KEYS), "customer_id", "customer_sk")) == two
    sound = numbering.gaps_and_repeats(lake.read(lk.CUSTOMER_KEYS), "customer_id", "customer_sk").first()
    assert tuple(sound) == (0, 0, 0)


def test_no_customers(spark, lake):
    dimension_load.assign_customer_keys(lake, ids(spark), "none")
    assert lake.read(lk.CUSTOMER_KEYS).count() == 0
    dimension_load.assign_customer_keys(lake, ids(spark, "x"), "some")
    assert rows(lake.read(lk.CUSTOMER_KEYS)) == [("x", 1, "some")]


def test_many_tasks_share_one_run_of_numbers(spark):
    keys = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("k")).repartition(16)
    got = numbering.numbered(keys, "k", "n", after=7)
    wanted = keys.select("k").collect()
    assert [tuple(r) for r in got.orderBy("n").collect()] == [(r.k, i) for i, r in enumerate(sorted(wanted), 8)]


def test_faults_are_counted(spark):
    bad = table(spark, [("a", 1), ("b", 1), ("c", 4), ("c", 5)], "k string, n long")
    assert tuple(numbering.gaps_and_repeats(bad, "k", "n").first()) == (2, 1, 1)


def test_bitmaps_equal_distinct_counts_over_bucket_edges(spark):
    pick = random.Random(2)
    numbers = [1, 32767, 32768, 32769, 65536, 65537, 200_000]
    items = [(pick.randrange(5), pick.choice(numbers)) for _ in range(60)] + [(9, None)]
    rows_ = table(spark, items, "day int, customer_sk long")
    days = usage.customer_bitmaps(rows_, ["day"])
    assert dict(rows(usage.bitmap_counts(days, ["day"]))) == {d: len({n for e, n in items if e == d}) for d in range(5)}
    whole = usage.rolled_up(days, [])
    assert rows(usage.bitmap_counts(whole, [])) == [(len({n for _, n in items if n}),)]
    assert rows(usage.bitmap_counts(usage.rolled_up(days.where("false"), []), [])) == [(0,)]
