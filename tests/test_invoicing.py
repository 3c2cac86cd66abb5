import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from making import customers, day, event, events, rates, rows, table
from tallyflow.functions import text
from tallyflow.operators import invoicing, pricing, quality, reconcile, serving, usage

ISSUED = "2024-02-01 04:00:00"
RATES = [
    (1, "prod_api_requests", "plan_pro", "requests", "0.5", "2024-01-01", None),
    (2, "prod_storage_gb", "plan_pro", "gb_month", "0", "2024-01-01", None),
]


def setting(spark):
    people = customers(spark, (1, "cust_1", "plan_pro", True), (2, "cust_2", "plan_pro", True))
    catalog = rates(spark, *RATES)
    happened = events(
        spark, event("a", "2024-01-01", quantity="3"), event("b", "2024-01-31T23:59:59", quantity="4"), event("c", "2024-02-01", quantity="50"),
        event("d", "2024-01-05", customer="cust_2", product="prod_storage_gb", unit="gb_month", quantity="7"),
    )
    return people, catalog, happened, pricing.daily_cost(usage.daily_usage(happened), people, catalog)


@pytest.mark.parametrize("run, first, last", [
    ("2024-03-01", "2024-02-01", "2024-02-29"), ("2024-01-01", "2023-12-01", "2023-12-31"), ("2024-03-31", "2024-02-01", "2024-02-29"),
])
def test_previous_month(run, first, last):
    assert invoicing.previous_month(day(run)) == (day(first), day(last))


def test_close_covers_the_period_and_keeps_zero_totals(spark):
    _, catalog, _, costs = setting(spark)
    headers = invoicing.close_headers(costs, "2024-01-01", "2024-01-31", issued_ts=ISSUED, tax_rate="0.08")
    assert rows(headers.select("customer_sk", F.col("subtotal").cast("double"), F.col("tax").cast("double"), F.col("total").cast("double"))) == [
        (1, 3.5, 0.28, 3.78), (2, 0.0, 0.0, 0.0)
    ]
    again = invoicing.close_headers(costs, "2024-01-01", "2024-01-31", issued_ts=ISSUED)
    assert rows(again.select("invoice_id")) == rows(headers.select("invoice_id"))
    lines = invoicing.usage_lines(costs, headers, catalog, calc_batch_id="x")
    assert quality.invoice_integrity(headers, lines).first().violations == 0
    assert rows(lines.select("product_id", F.col("quantity").cast("int"), F.col("usage_window_end").cast("string"))) == [
        ("prod_api_requests", 7, "2024-01-31"), ("prod_storage_gb", 7, "2024-01-05")
    ]


def test_month_headers_skip_zero_totals(spark):
    _, _, _, costs = setting(spark)
    assert rows(invoicing.model_headers(costs, issued_ts=ISSUED).select("customer_sk", F.col("billing_period_start").cast("string"))) == [
        (1, "2024-01-01"), (1, "2024-02-01")
    ]
    recent = invoicing.recent_month_headers(costs, "2024-04-10", issued_ts=ISSUED)
    assert rows(recent.select(F.col("billing_period_start").cast("string"), F.col("tax").cast("string"), F.col("total").cast("string"))) == [
        ("2024-02-01", "2.0000000000", "27.0000000000")
    ]


def test_lines_of_a_quarter_period(spark):
    """A period of several months still takes every day once."""
    _, catalog, _, costs = setting(spark)
    headers = invoicing.close_headers(costs, "2024-01-01", "2024-03-31", issued_ts=ISSUED)
    lines = invoicing.usage_lines(costs, headers, catalog, calc_batch_id="x", split_by_rate=False)
    assert rows(lines.where("product_id = 'prod_api_requests'").select(F.col("quantity").cast("int"), F.col("amount").cast("double"))) == [(57, 28.5)]


def test_model_price_is_guarded_and_rounded_half_up(spark):
    costs = table(
        spark, [(day("2024-01-01"), 1, "p", "u", Decimal("2"), Decimal("0.000115"), "USD")],
        "date_id date, customer_sk long, product_id string, unit string, total_quantity decimal(28,6), cost_amount decimal(38,10), currency string",
    )
    line = invoicing.model_lines(costs, invoicing.model_headers(costs, issued_ts=ISSUED)).first()
    assert str(line.unit_price) == "0.000058"


def test_audit_trail_names_every_daily_row(spark):
    people, catalog, happened, costs = setting(spark)
    headers = invoicing.close_headers(costs, "2024-01-01", "2024-01-31", issued_ts=ISSUED)
    lines = invoicing.usage_lines(costs, headers, catalog, calc_batch_id="x")
    days = usage.daily_usage(happened).withColumn("batch_id", F.lit("b"))
    trail = invoicing.audit_trail(lines, headers, people, days)
    assert rows(trail.select("customer_id", F.col("event_date").cast("string"))) == [("cust_1", "2024-01-01"), ("cust_1", "2024-01-31"), ("cust_2", "2024-01-05")]
    assert trail.select("agg_row_hash").distinct().count() == 3


def late_setting(spark):
    people, catalog, happened, costs = setting(spark)
    headers = invoicing.close_headers(costs, "2024-01-01", "2024-01-31", issued_ts=ISSUED)
    lines = invoicing.usage_lines(costs, headers, catalog, calc_batch_id="close")
    after = events(
        spark, event("l1", "2024-01-10", quantity="2", load="2024-02-05"), event("l2", "2024-01-10", quantity="6", load="2024-02-05"),
        event("ok", "2024-01-10", load="2024-02-01T04:00:00"), event("out", "2024-02-02", load="2024-02-05"),
        event("who", "2024-01-10", customer="nobody", load="2024-02-05"),
    )
    return people, catalog, headers, lines, happened.unionByName(after)


def test_late_events_read_their_events_once(spark):
    people, _, headers, _, everything = late_setting(spark)
    read = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: read.add(1) or x).asNondeterministic()
    late = reconcile.late_events(everything.withColumn("customer_id", seen("customer_id")), headers, people)
    assert rows(late.select("event_id")) == [("l1",), ("l2",)]
    assert read.value <= everything.count()


def test_late_events_are_found_once(spark):
    people, catalog, headers, lines, everything = late_setting(spark)
    late = reconcile.late_events(everything, headers, people)
    assert rows(late.select("event_id")) == [("l1",), ("l2",)]
    none = reconcile.late_events(everything, headers.withColumn("status", F.lit("void")), people)
    assert none.count() == 0
    candidates = reconcile.price_late_events(late, people, catalog, lines)
    new = reconcile.adjustment_lines(candidates, calc_batch_id="late")
    assert sorted(r.amount for r in new.collect()) == [Decimal("1"), Decimal("3")]
    assert reconcile.price_late_events(late, people, catalog, lines.unionByName(new)).count() == 0
    # The guard on a line type nothing writes never holds anything back, also with a null line id around.
    nulls = lines.unionByName(new.withColumn("line_type", F.lit("adjustment_ref")).withColumn("line_item_id", F.lit(None).cast("string")))
    assert reconcile.price_late_events(late, people, catalog, nulls, skip_adjusted=False).count() == 2
    raised = reconcile.adjusted_headers(headers, new)
    assert rows(raised.select("customer_sk", F.col("total").cast("double"))) == [(1, 7.5), (2, 0.0)]
    assert rows(reconcile.headers_from_lines(headers, lines.unionByName(new)).select("invoice_id", "total")) == rows(raised.select("invoice_id", "total"))


def test_price_difference_sees_new_groups(spark):
    people, catalog, headers, lines, everything = late_setting(spark)
    costs = pricing.daily_cost(usage.daily_usage(everything), people, catalog)
    got = reconcile.price_differences(costs, headers, lines)
    assert rows(got.select("product_id", F.col("quantity_difference").cast("int"), F.col("adjustment_amount").cast("double"))) == [("prod_api_requests", 9, 4.5)]


def test_fan_out_form_equals_the_joined_sum(spark):
    _, catalog, _, costs = setting(spark)
    headers = invoicing.close_headers(costs, "2024-01-01", "2024-03-31", issued_ts=ISSUED)
    lines = invoicing.usage_lines(costs, headers, catalog, calc_batch_id="x")
    doubled = lines.unionByName(lines.withColumn("line_item_id", F.lit("again")))
    joined = headers.join(doubled, "invoice_id", "left").agg(F.sum("total"), F.sum("amount")).first()
    got = quality.fan_out_difference(headers, doubled).first()
    assert (got.header_total, got.line_total) == tuple(joined)


def test_gates(spark):
    df = events(spark, event("a", "2024-01-01"), event("a", "2024-01-02", quantity="-1"))
    checks = quality.all_checks(quality.duplicate_events(df), quality.negative_quantity(df))
    with pytest.raises(quality.QualityError, match="duplicate_event_id=1, negative_quantity=1"):
        quality.enforce(checks)
    with pytest.raises(Exception, match="quality gate failed"):
        quality.gated(checks).collect()
    quality.enforce(quality.unique(df.limit(1), "event_id"))


def test_unknown_invoice_gives_no_rows(spark):
    people, catalog, _, costs = setting(spark)
    headers = invoicing.close_headers(costs, "2024-01-01", "2024-01-31", issued_ts=ISSUED)
    lines = invoicing.usage_lines(costs, headers, catalog, calc_batch_id="x").withColumn("load_ts", F.lit(ISSUED).cast("timestamp_ntz"))
    assert serving.invoice_detail(headers, lines, people, "none").count() == 0
    known = headers.where("customer_sk = 1").first().invoice_id
    assert serving.invoice_detail(headers, lines, people, known).count() == 1
    assert serving.customer_usage(costs, people, "cust_1", dt.date(2024, 1, 31), "2024-01-31").count() == 1


def test_dashboard_without_usage_this_month(spark):
    people, _, happened, costs = setting(spark)
    headers = invoicing.close_headers(costs, "2024-01-01", "2024-01-31", issued_ts=ISSUED)
    for as_run in (False, True):
        got = serving.dashboard_summary(costs, people, headers, happened, "2024-06-01", as_run=as_run).first()
        assert (got.total_revenue_mtd, got.avg_daily_revenue, got.total_events_today) == (0, 0, 0)
        assert (got.total_customers, got.active_invoices) == (2, 2)


def test_labels(spark):
    df = table(spark, [("prod_ai_tokens", "plan_pro", Decimal("1234567.5"), Decimal("-0.125"))], "p string, l string, a decimal(18,4), b decimal(18,4)")
    got = df.select(
        text.product_label(F.col("p")), text.plan_label(F.col("l")), text.grouped_money(F.col("a")), text.grouped_money(F.col("b")),
        text.money_text(F.col("a"), 4), text.grouped_number(F.col("a")), text.grouped_number(F.lit(1000)), text.short_id(F.col("p")),
    ).first()
    assert tuple(got) == ("Ai Tokens", "Pro", "$1,234,567.50", "-$0.13", "$1234567.5000", "1,234,567.5", "1,000", "prod_ai_")


def test_model_lines_meet_their_invoices_without_another_shuffle(spark, tmp_path):
    """One exchange for the totals of the invoices, one for the lines; the join adds none."""
    costs = "DATE'2024-01-05' AS date_id, id AS customer_sk, 'p' AS product_id, 'u' AS unit, cast(id AS DECIMAL(28,6)) AS total_quantity, cast(1 AS DECIMAL(38,10)) AS cost_amount, 'USD' AS currency"
    spark.range(1, 9).selectExpr(*costs.split(", ")).write.parquet(str(tmp_path / "costs"))
    facts = spark.read.parquet(str(tmp_path / "costs"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = invoicing.model_lines(facts, invoicing.model_headers(facts, issued_ts="2024-02-01 00:00:00"))
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and lines.count() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
