"""Whole jobs over stored tables: daily billing, close, late arrivals, and their streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from making import customers, day, event, events, rates, rows, table, ts
from tallyflow.operators import invoicing, merge, parse, quality
from tallyflow.plans import daily, late_arrivals, month_end
from tallyflow.sources import files
from tallyflow.sources import lake as lk
from tallyflow.streaming import usage as streams

RATES = [(1, "prod_api_requests", "plan_pro", "requests", "0.5", "2024-01-01", None)]


def line(event_id, at, quantity=2, customer="cust_1", product="prod_api_requests"):
    return json.dumps({
        "event_id": event_id, "event_timestamp": at + "Z", "customer_id": customer, "product_id": product, "plan_id": "plan_pro",
        "quantity": quantity, "unit": "requests", "region": "us-east-1", "schema_version": "1.0",
    })


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    os.makedirs(folder)
    (folder / "usage_events_2024-01-10.jsonl").write_text("\n".join([
        line("a", "2024-01-10T01:00:00"), line("a", "2024-01-10T01:00:00"), line("b", "2024-01-10T02:00:00", 3), "broken", line("n", "2024-01-10T03:00:00", -1),
    ]))
    # The second file brings a late event of the first day and another delivery of "b".
    (folder / "usage_events_2024-01-11.jsonl").write_text("\n".join([
        line("c", "2024-01-11T01:00:00", 5), line("late", "2024-01-10T00:00:00", 7), line("b", "2024-01-10T02:00:00", 3),
    ]))
    return str(folder)


def people(spark):
    return customers(spark, (1, "cust_1", "plan_pro", True))


def test_backfill_bills_late_events_on_their_own_day(spark, lake, landing):
    days = daily.backfill(lake, landing, people(spark), rates(spark, *RATES), as_of=ts("2024-01-12T06:00:00"))
    assert days == [day("2024-01-10"), day("2024-01-11")]
    expected = [("2024-01-10", 6.0), ("2024-01-11", 2.5)]

    def costs():
        return rows(lake.read(lk.DAILY_COST).select(F.col("date_id").cast("string"), F.col("cost_amount").cast("double")))

    assert costs() == expected
    assert rows(lake.read(lk.QUARANTINE).select("error_reason")) == [("bad_json",), ("negative_quantity",)]
    assert lake.read(lk.USAGE_CLEAN).count() == 4
    assert lake.read(lk.USAGE_DAILY).agg(F.sum("event_count")).first()[0] == 4
    assert rows(lake.read(lk.RUN_AUDIT).select("run_id", "rows_inserted")) == [
        ("backfill_2024-01-10", None), ("backfill_2024-01-11", None), ("backfill_20240112060000", 4)
    ]
    assert lake.read(lk.CHECKPOINTS).first().last_dt == day("2024-01-11")
    clean = rows(lake.read(lk.USAGE_CLEAN))
    daily.backfill(lake, landing, people(spark), rates(spark, *RATES), as_of=ts("2024-01-12T06:00:00"))
    assert costs() == expected and rows(lake.read(lk.USAGE_CLEAN)) == clean
    assert lake.read(lk.RUN_AUDIT).count() == 3


def test_close_then_late_then_rerun(spark, lake, landing):
    prices = rates(spark, *RATES)
    daily.backfill(lake, landing, people(spark), prices, as_of=ts("2024-01-12T06:00:00"))
    plans = table(spark, [("plan_pro", 99)], "plan_id string, fee int").select("plan_id", F.col("fee").cast("decimal(18,2)").alias("base_fee"))

    def close():
        return month_end.close_period(
            lake, prices, *invoicing.previous_month(day("2024-02-01")), run_id="close", issued_ts=ts("2024-02-01T04:00:00"),
            customers=people(spark), plans=plans,
        )

    assert close() == 1
    first = rows(lake.read(lk.INVOICES)), rows(lake.read(lk.LINE_ITEMS))
    assert close() == 1
    assert (rows(lake.read(lk.INVOICES)), rows(lake.read(lk.LINE_ITEMS))) == first
    assert rows(lake.read(lk.LINE_ITEMS).select("line_type", F.col("amount").cast("double"))) == [("base_fee", 99.0), ("usage", 8.5)]
    assert quality.invoice_integrity(lake.read(lk.INVOICES), lake.read(lk.LINE_ITEMS)).first().violations == 0
    assert rows(lake.read(lk.BILLING_AUDIT).select(F.col("event_date").cast("string"))) == [("2024-01-10",), ("2024-01-11",)]

    merge.merge_into_clean(lake, events(spark, event("after", "2024-01-20", quantity="10", load="2024-02-03")))
    for run in ("late_1", "late_2"):
        late_arrivals.reconcile_late(lake, people(spark), prices, run_id=run, as_of=ts("2024-02-04T06:00:00"))
    assert rows(lake.read(lk.INVOICES).select(F.col("total").cast("double"))) == [(112.5,)]
    assert lake.read(lk.LINE_ITEMS).where("line_type = 'adjustment'").count() == 1
    assert quality.invoice_integrity(lake.read(lk.INVOICES), lake.read(lk.LINE_ITEMS)).first().violations == 0
    with pytest.raises(ValueError):
        close()


def test_a_run_broken_between_lines_and_totals_is_repaired(spark, lake, landing):
    prices = rates(spark, *RATES)
    daily.backfill(lake, landing, people(spark), prices, as_of=ts("2024-01-12T06:00:00"))
    month_end.close_period(lake, prices, day("2024-01-01"), day("2024-01-31"), run_id="close", issued_ts=ts("2024-02-01T04:00:00"))
    stale = [tuple(r) for r in lake.read(lk.INVOICES).collect()]
    merge.merge_into_clean(lake, events(spark, event("after", "2024-01-20", quantity="10", load="2024-02-03")))
    late_arrivals.reconcile_late(lake, people(spark), prices, run_id="late", as_of=ts("2024-02-04T06:00:00"))
    lake.replace(lk.INVOICES, table(spark, stale, lk.INVOICES.schema))
    late_arrivals.reconcile_late(lake, people(spark), prices, run_id="late", as_of=ts("2024-02-04T06:00:00"))
    assert rows(lake.read(lk.INVOICES).select(F.col("total").cast("double"))) == [(13.5,)]


def test_close_without_plans_clears_fee_lines_and_mixed_currencies_stop_it(spark, lake, landing):
    prices = rates(spark, *RATES)
    daily.backfill(lake, landing, people(spark), prices, as_of=ts("2024-01-12T06:00:00"))
    plans = table(spark, [("plan_pro", 99)], "plan_id string, fee int").select("plan_id", F.col("fee").cast("decimal(18,2)").alias("base_fee"))
    close = lambda **kw: month_end.close_period(
        lake, prices, day("2024-01-01"), day("2024-01-31"), run_id="close", issued_ts=ts("2024-02-01T04:00:00"), tax_rate="0.08875", **kw
    )
    close(customers=people(spark), plans=plans)
    assert rows(lake.read(lk.INVOICES).select(F.col("subtotal").cast("double"), F.col("tax").cast("double"))) == [(107.5, 9.54)]
    close()
    assert rows(lake.read(lk.LINE_ITEMS).select("line_type")) == [("usage",)]
    assert rows(lake.read(lk.INVOICES).select(F.col("tax").cast("double"))) == [(0.75,)]
    lake.append_new(lk.DAILY_COST, lake.read(lk.DAILY_COST).withColumn("currency", F.lit("EUR")), ["date_id", "currency"])
    with pytest.raises(quality.QualityError, match="mixed_currency"):
        close()


def test_a_smaller_reload_leaves_no_old_rows(spark, lake, tmp_path):
    for name, days in (("first", ("2024-01-10", "2024-01-11")), ("second", ("2024-01-10",))):
        folder = tmp_path / name
        os.makedirs(folder)
        for d in days:
            (folder / f"usage_events_{d}.jsonl").write_text(line(d, f"{d}T00:00:00", -1 if name == "first" else 1))
        daily.load_raw(lake, str(folder), source="API", batch_id="one", ingest_ts=ts("2024-01-12T06:00:00"))
        daily.bill(lake, lake.read(lk.USAGE_RAW), people(spark), rates(spark, *RATES), run_id=name, as_of=ts("2024-01-12T06:00:00"))
    assert lake.read(lk.USAGE_RAW).count() == 1
    assert lake.read(lk.QUARANTINE).count() == 0


def test_checkpoint_never_goes_back_and_failures_are_recorded(spark, lake, landing, monkeypatch):
    run = lambda **kw: daily.bill(lake, lake.read(lk.USAGE_RAW), people(spark), rates(spark, *RATES), as_of=ts("2024-01-12T06:00:00"), **kw)
    daily.load_raw(lake, landing, source="API", batch_id="one", ingest_ts=ts("2024-01-12T06:00:00"))
    run(run_id="full")
    daily.bill(lake, lake.read(lk.USAGE_RAW).where("dt = DATE'2024-01-10'"), people(spark), rates(spark, *RATES), run_id="old", as_of=ts("2024-01-11T06:00:00"))
    assert lake.read(lk.CHECKPOINTS).first().last_dt == day("2024-01-11")
    with monkeypatch.context() as patch:
        patch.setattr(quality, "negative_quantity", lambda df: quality.column_checks(df.withColumn("z", F.lit(None)), not_null=["z"]))
        with pytest.raises(quality.QualityError):
            run(run_id="broken")
    failed = lake.read(lk.RUN_AUDIT).where("run_id = 'broken'").first()
    assert failed.status == "FAILED" and "QualityError" in failed.error_message
    run(run_id="broken")
    assert rows(lake.read(lk.RUN_AUDIT).select("run_id", "status")) == [("broken", "SUCCESS"), ("full", "SUCCESS"), ("old", "SUCCESS")]


def test_plan_change_inside_the_month_gives_one_invoice(spark, lake):
    snaps = table(
        spark, [("cust_1", "n", "active", "US", plan, at) for plan, at in (("plan_pro", "2024-01-01"), ("plan_free", "2024-01-11"))],
        "customer_id string, customer_name string, status string, country string, plan_id string, at string",
    ).withColumn("ingest_ts", F.col("at").cast("timestamp_ntz"))
    from tallyflow.operators import dimensions, reconcile, serving, pricing, usage

    first, later = (dimensions.customer_history(snaps.where(f"at <= '{at}'")) for at in ("2024-01-01", "2024-01-11"))
    prices = rates(spark, *RATES, (2, "prod_api_requests", "plan_free", "requests", "2", "2024-01-01", None))
    early, late = (usage.daily_usage(events(spark, event(i, d, quantity="10", load=load))) for i, d, load in (("a", "2024-01-05", "2024-01-05"), ("b", "2024-01-20", "2024-01-20")))
    costs = pricing.daily_cost(early, first, prices).unionByName(pricing.daily_cost(late, later, prices))
    headers = invoicing.close_headers(costs, day("2024-01-01"), day("2024-01-31"), issued_ts=ts("2024-02-01T04:00:00"))
    assert [float(r.subtotal) for r in headers.collect()] == [25.0]
    after = events(spark, event("c", "2024-01-06", quantity="1", load="2024-02-03"))
    found = reconcile.late_events(after, headers, later)
    lines = invoicing.usage_lines(costs, headers, prices, calc_batch_id="x")
    assert found.count() == 1 and reconcile.price_late_events(found, later, prices, lines).count() == 1
    report = serving.usage_report(costs, later, "2024-01-31")
    assert float(report.agg(F.sum("cost_amount")).first()[0]) == 25.0


def test_failed_gate_publishes_no_cost(spark, lake, landing, monkeypatch):
    monkeypatch.setattr(quality, "negative_quantity", lambda df: quality.column_checks(df.withColumn("z", F.lit(None)), not_null=["z"]))
    with pytest.raises(quality.QualityError):
        daily.backfill(lake, landing, people(spark), rates(spark, *RATES), as_of=ts("2024-01-12T06:00:00"))
    assert lake.read(lk.DAILY_COST).count() == 0


def test_day_rebuild_clears_days_without_rows(spark, lake):
    merge.merge_into_clean(lake, events(spark, event("a", "2024-01-01"), event("b", "2024-01-02"), event("c", "2024-01-03")))
    kept = lake.read(lk.USAGE_CLEAN).where("event_id = 'a'")
    lake.replace_days(lk.USAGE_CLEAN, kept, [day("2024-01-01"), day("2024-01-02")])
    assert rows(lake.read(lk.USAGE_CLEAN).select("event_id")) == [("a",), ("c",)]


def test_reload_replaces_its_own_batch_only(spark, lake, landing):
    for batch in ("one", "two", "one"):
        daily.load_raw(lake, landing, source="API", batch_id=batch, ingest_ts="2024-01-12 00:00:00")
    assert rows(lake.read(lk.USAGE_RAW).groupBy("batch_id").count()) == [("one", 8), ("two", 8)]


def test_raw_payload_survives_storage(spark, lake, landing):
    daily.load_raw(lake, landing, source="API", batch_id="one", ingest_ts="2024-01-12 00:00:00")
    direct = parse.parse_usage(files.ingest_usage(spark, landing, source="API", batch_id="one", ingest_ts="2024-01-12 00:00:00"))
    assert rows(parse.parse_usage(lake.read(lk.USAGE_RAW))) == rows(direct)


# Streams, one file per micro-batch.


def test_stream_ingest_takes_each_file_once(spark, landing, tmp_path):
    target, checkpoint = str(tmp_path / "raw"), str(tmp_path / "ck")

    def drain():
        raw = streams.raw_stream(spark, landing, source="API", batch_id="s", files_per_batch=1)
        streams.drain_raw(raw, target, checkpoint).awaitTermination()
        return spark.read.parquet(target).count()

    assert drain() == 8
    assert drain() == 8
    with open(f"{landing}/usage_events_2024-01-12.jsonl", "w") as f:
        f.write(line("d", "2024-01-12T01:00:00"))
    assert drain() == 9


def test_stream_dedup_and_daily_equal_batch(spark, landing, tmp_path):
    def parsed():
        raw = streams.raw_stream(spark, landing, source="API", batch_id="s", files_per_batch=1)
        return parse.parse_usage(raw).where("quantity >= 0")

    streams.drain_unique(parsed(), str(tmp_path / "d"), str(tmp_path / "ck1")).awaitTermination()
    unique = streams.current_unique(spark, str(tmp_path / "d"))
    assert rows(unique.select("event_id")) == [("a",), ("b",), ("c",), ("late",)]
    target = str(tmp_path / "days")
    streams.drain_daily(parsed(), target, str(tmp_path / "ck2")).awaitTermination()
    days = lambda df: rows(df.select(F.col("event_date").cast("string"), F.col("total_quantity").cast("int"), "event_count"))
    assert days(streams.current_daily(spark, target)) == [("2024-01-10", 12, 3), ("2024-01-11", 5, 1)]
    assert days(streams.compact_daily(spark, target, str(tmp_path / "short"))) == [("2024-01-10", 12, 3), ("2024-01-11", 5, 1)]


def test_events_count_however_late_they_come(spark, tmp_path):
    folder = tmp_path / "in"
    os.makedirs(folder)
    for n, at in enumerate(("2024-05-01T00:00:00", "2024-01-01T00:00:00", "2023-01-01T00:00:00", "yesterday")):
        (folder / f"usage_events_2024-05-0{n + 1}.jsonl").write_text(line(f"e{n}", at, n + 1))
    parsed = parse.parse_usage(streams.raw_stream(spark, str(folder), source="API", batch_id="s", files_per_batch=1)).where("event_ts IS NOT NULL")
    streams.drain_daily(parsed, str(tmp_path / "d"), str(tmp_path / "ck")).awaitTermination()
    assert streams.current_daily(spark, str(tmp_path / "d")).agg(F.sum("event_count")).first()[0] == 3


def test_a_poison_row_goes_to_quarantine_and_the_stream_goes_on(spark, lake, tmp_path):
    folder = tmp_path / "in"
    os.makedirs(folder)
    (folder / "usage_events_2024-01-10.jsonl").write_text("\n".join([line("bad", "yesterday"), line("neg", "2024-01-10T00:00:00", -1), "broken"]))
    (folder / "usage_events_2024-01-11.jsonl").write_text(line("good", "2024-01-11T00:00:00"))
    raw = streams.raw_stream(spark, str(folder), source="API", batch_id="s", ingest_ts="2024-01-12 00:00:00", files_per_batch=1)
    streams.drain_clean(raw, lake, str(tmp_path / "ck")).awaitTermination()
    assert rows(lake.read(lk.USAGE_CLEAN).select("event_id")) == [("good",)]
    assert rows(lake.read(lk.QUARANTINE).select("error_reason")) == [("bad_json",), ("bad_timestamp",), ("negative_quantity",)]


def test_stream_merge_equals_batch_merge(spark, lake, landing, tmp_path):
    raw = streams.raw_stream(spark, landing, source="API", batch_id="s", ingest_ts="2024-01-12 00:00:00", files_per_batch=1)
    streams.drain_clean(raw, lake, str(tmp_path / "ck")).awaitTermination()
    batch = files.ingest_usage(spark, landing, source="API", batch_id="s", ingest_ts="2024-01-12 00:00:00")
    expected = merge.dedupe_events(merge.as_clean(parse.accepted(parse.classify_usage(batch))))
    assert rows(lake.read(lk.USAGE_CLEAN)) == rows(expected)


def test_stream_routes_late_events(spark, lake, landing, tmp_path):
    prices = rates(spark, *RATES)
    daily.backfill(lake, landing, people(spark), prices, as_of=ts("2024-01-12T06:00:00"))
    month_end.close_period(lake, prices, day("2024-01-01"), day("2024-01-31"), run_id="close", issued_ts=ts("2024-02-01T04:00:00"))
    folder = tmp_path / "late"
    os.makedirs(folder)
    for n in (1, 2):
        (folder / f"usage_events_2024-02-0{n}.jsonl").write_text(line(f"x{n}", "2024-01-15T00:00:00", 4))
    for attempt in (1, 2):
        raw = streams.raw_stream(spark, str(folder), source="API", batch_id="s", ingest_ts="2024-02-03 00:00:00", files_per_batch=1)
        streams.drain_late(raw, lake, people(spark), prices, str(tmp_path / f"ck{attempt}"), run_id="late", as_of=ts("2024-02-03T06:00:00")).awaitTermination()
    assert rows(lake.read(lk.INVOICES).select(F.col("total").cast("double"))) == [(12.5,)]


def test_a_day_without_a_file_changes_nothing(spark, lake, landing, tmp_path):
    prices = rates(spark, *RATES)
    assert daily.backfill(lake, str(tmp_path / "nothing"), people(spark), prices, as_of=ts("2024-01-12T06:00:00")) == []
    assert lake.read(lk.DAILY_COST).count() == 0
    assert lake.read(lk.USAGE_CLEAN).count() == 0
