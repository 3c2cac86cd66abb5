"""Snapshots in any order, and fees for customers without usage."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from making import day, rates, rows, table, ts
from tallyflow import schemas
from tallyflow.operators import dimensions, invoicing, quality
from tallyflow.plans import dimension_load, month_end
from tallyflow.sources import lake as lk

SNAPSHOT = "customer_id string, customer_name string, status string, country string, plan_id string, ingest_ts timestamp_ntz"
TAKEN = {
    "2024-01-01": [("c", "A"), ("d", "A"), (None, "A")],
    "2024-02-01": [("c", "B"), ("e", None)],
    "2024-03-01": [("c", "A"), ("d", "A")],
}


def snapshot(spark, at, items=None):
    return table(spark, [(c, "n", "active", None, plan, ts(at)) for c, plan in (TAKEN[at] if items is None else items)], SNAPSHOT)


def stored(lake):
    return rows(lake.read(lk.CUSTOMER_DIM))


@pytest.mark.parametrize("order", [("2024-03-01", "2024-01-01", "2024-02-01", "2024-01-01"), ("2024-02-01", "2024-03-01", "2024-01-01")])
def test_snapshots_in_any_order_give_one_history(spark, lake, order):
    everything = snapshot(spark, "2024-01-01").union(snapshot(spark, "2024-02-01")).union(snapshot(spark, "2024-03-01"))
    expected = rows(dimensions.customer_history(everything.where("customer_id IS NOT NULL")).select(*schemas.CUSTOMER_DIM.fieldNames()))
    for at in order:
        dimension_load.load_customer_history(lake, snapshot(spark, at), f"{at} 00:00:00")
    assert stored(lake) == expected
    assert [r[1] for r in stored(lake)] == ["c", "c", "c", "d", "e"]


def test_a_corrected_snapshot_replaces_its_first_load(spark, lake):
    for items in ([("c", "A"), ("d", "A")], [("c", "B")]):
        dimension_load.load_customer_history(lake, snapshot(spark, "2024-01-01", items), "2024-01-01 00:00:00")
    assert [(r[1], r[5]) for r in stored(lake)] == [("c", "B")]
    dimension_load.load_customer_history(lake, snapshot(spark, "2024-02-01", []), "2024-02-01 00:00:00")
    assert [(r[1], r[5]) for r in stored(lake)] == [("c", "B")]


def test_a_history_from_before_the_log_goes_on(spark, lake):
    for at in ("2024-01-01", "2024-02-01"):
        dimension_load.load_customers(lake, snapshot(spark, at).where("customer_id IS NOT NULL"), f"{at} 00:00:00")
    dimension_load.load_customer_history(lake, snapshot(spark, "2024-03-01"), "2024-03-01 00:00:00")
    got = sorted((r[1], str(r[6])[:10], r[5]) for r in stored(lake))
    assert got == [
        ("c", "2024-01-01", "A"), ("c", "2024-02-01", "B"), ("c", "2024-03-01", "A"), ("d", "2024-01-01", "A"), ("e", "2024-02-01", None),
    ]


def test_an_older_snapshot_does_not_close_a_newer_version(spark):
    newer = dimensions.customer_history(snapshot(spark, "2024-03-01"))
    assert rows(dimensions.apply_snapshot(newer, snapshot(spark, "2024-02-01").where("customer_id = 'c'"), "2024-02-01 00:00:00")) == rows(newer)


def versions(spark, *items):
    """items: (sk, plan, status, from, to)"""
    full = [(sk, f"c{sk}", "n", status, "US", plan, ts(a), ts(b) if b else None, b is None, None) for sk, plan, status, a, b in items]
    return table(spark, full, schemas.CUSTOMER_DIM)


PEOPLE = [
    (1, "pro", "active", "2024-01-01", None), (2, "pro", "active", "2024-01-31", None), (3, "pro", "active", "2024-02-01", None),
    (4, "pro", "cancelled", "2024-01-01", None), (5, "free", "active", "2024-01-01", "2024-01-20"), (5, "pro", "delinquent", "2024-01-20", None),
    (6, "pro", "active", "2024-01-01", "2024-01-31T23:59:59"), (6, "pro", "cancelled", "2024-01-31T23:59:59", None),
]
PLANS = "plan_id string, base_fee decimal(18,2), currency string"


def test_months_are_owed_by_the_version_that_ends_them(spark):
    owed = invoicing.billable_periods(versions(spark, *PEOPLE), "2024-01-01", "2024-02-29")
    got = rows(owed.select("customer_sk", "plan_id", F.month("billing_period_start"), F.col("billing_period_end").cast("string")))
    assert got == [(1, "pro", 1, "2024-01-31"), (1, "pro", 2, "2024-02-29"), (2, "pro", 1, "2024-01-31"), (2, "pro", 2, "2024-02-29"),
                   (3, "pro", 2, "2024-02-29"), (5, "pro", 1, "2024-01-31"), (5, "pro", 2, "2024-02-29")]
    assert invoicing.billable_periods(versions(spark), "2024-01-01", "2024-02-29").count() == 0


def test_close_bills_customers_without_usage(spark, lake):
    cost = table(spark, [(day("2024-01-05"), 1, "p", "u", Decimal(2), Decimal(2), Decimal(4), "USD", 1, ts("2024-02-01"), "r"),
                         (day("2024-01-05"), 4, "p", "u", Decimal(1), Decimal(1), Decimal(2), "USD", 1, ts("2024-02-01"), "r")], schemas.DAILY_COST)
    lake.replace(lk.DAILY_COST, cost)
    plans = table(spark, [("pro", Decimal(10), "USD"), ("free", Decimal(0), "USD")], PLANS)
    prices = rates(spark, (1, "p", "pro", "u", "2", "2024-01-01", None))
    for _ in range(2):
        assert month_end.close_period(
            lake, prices, day("2024-01-01"), day("2024-01-31"), run_id="close", issued_ts=ts("2024-02-01"), tax_rate="0.1",
            customers=versions(spark, *PEOPLE), plans=plans, bill_all=True) == 4
        got = rows(lake.read(lk.INVOICES).select("customer_sk", *[F.col(c).cast("double") for c in ("subtotal", "tax", "total")]))
        # Customer 4 is cancelled: what it used is billed, a fee is not.
        assert got == [(1, 14.0, 1.4, 15.4), (2, 10.0, 1.0, 11.0), (4, 2.0, 0.2, 2.2), (5, 10.0, 1.0, 11.0)]
        assert rows(lake.read(lk.LINE_ITEMS).groupBy("line_type").count()) == [("base_fee", 3), ("usage", 2)]


def test_close_of_all_customers_refuses_what_it_cannot_bill(spark, lake):
    prices = rates(spark, (1, "p", "pro", "u", "2", "2024-01-01", None))
    plans = table(spark, [("free", Decimal(0), "USD")], PLANS)
    with pytest.raises(quality.QualityError, match="unknown_plan=3"):
        month_end.close_period(lake, prices, day("2024-01-01"), day("2024-01-31"), run_id="c", issued_ts=ts("2024-02-01"),
                               customers=versions(spark, *PEOPLE), plans=plans, bill_all=True)
    with pytest.raises(ValueError):
        month_end.close_period(lake, prices, day("2024-01-01"), day("2024-01-15"), run_id="c", issued_ts=ts("2024-02-01"),
                               customers=versions(spark, *PEOPLE), plans=plans, bill_all=True)


def test_a_whole_dimension_load_can_be_repeated(spark, lake):
    price = table(spark, [("p", "pro", "u", Decimal(1), "USD", day("2024-01-01"), None)],
                  "product_id string, plan_id string, unit string, unit_price decimal(18,10), currency string, effective_from date, effective_to date")
    products = table(spark, [(None,) * len(schemas.PRODUCT_DIM)], schemas.PRODUCT_DIM)
    plans = table(spark, [(None,) * len(schemas.PLAN_DIM)], schemas.PLAN_DIM)
    for _ in range(2):
        dimension_load.load_all(
            lake, snapshot=snapshot(spark, "2024-01-01"), rates=price, products=products, plans=plans, as_of=ts("2024-01-01"),
            first_day=day("2024-01-01"), last_day=day("2024-01-03"))
        counted = [lake.read(t).count() for t in (lk.CUSTOMER_DIM, lk.RATE_DIM, lk.PRODUCT_DIM, lk.PLAN_DIM, lk.DATE_DIM)]
        assert counted == [2, 1, 1, 1, 3]


def test_a_snapshot_load_computes_its_rows_once(spark, lake, monkeypatch):
    """Snapshots are laid down before the lookups that read them several times, and the staged load is not staged again."""
    names = []
    for module in (dimension_load, lk):
        kept = module.stage
        monkeypatch.setattr(module, "stage", lambda df, name, kept=kept: names.append(name) or kept(df, name))
    dimension_load.load_customer_history(lake, snapshot(spark, "2024-01-01"), "2024-01-01 00:00:00")
    assert {"moments", "starts"} <= set(names) and "replacing" not in names
