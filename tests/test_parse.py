from decimal import Decimal

from pyspark.sql import functions as F

from making import rows, table, ts
from tallyflow.operators import parse
from tallyflow.sources import files


def raw(spark, *texts):
    df = table(spark, [(t,) for t in texts], "value string")
    payload = F.try_parse_json("value")
    return df.select(
        F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("ingest_ts"), F.lit("API").alias("source"),
        F.lit("2024-01-01").cast("date").alias("dt"), F.lit("b").alias("batch_id"), payload.alias("payload"),
        F.when(payload.isNull(), F.col("value")).alias("bad_text"),
    )


GOOD = '{"event_id":"e1","event_timestamp":"2024-01-01T23:59:59Z","customer_id":"c","product_id":"prod_ai_tokens","quantity":0.000002,"unit":"tokens"}'


def test_typed_columns_keep_wall_clock_and_small_quantities(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = parse.parse_usage(raw(spark, GOOD)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.event_ts == ts("2024-01-01T23:59:59")
    assert str(row.event_date) == "2024-01-01"
    assert row.quantity == Decimal("0.000002")
    assert row.plan_id is None


def test_rows_without_event_id_drop_out(spark):
    assert parse.parse_usage(raw(spark, GOOD, '{"customer_id":"c"}', "not json", "[1,2]")).count() == 1


def test_hash_ignores_key_order_but_not_values(spark):
    hashes = [r[0] for r in raw(spark, '{"a":1,"b":"x"}', '{"b":"x","a":1}', '{"a":2,"b":"x"}', "[1]").select(parse.payload_hash()).collect()]
    assert hashes[0] == hashes[1] != hashes[2]
    assert hashes[3] is not None


def test_each_reason_is_named_once(spark):
    def with_(**change):
        import json

        body = json.loads(GOOD)
        for key, value in change.items():
            if value is None:
                body.pop(key)
            else:
                body[key] = value
        return json.dumps(body)

    texts = [
        GOOD, "{broken", with_(event_id=None), with_(customer_id=None), with_(product_id=None), with_(event_timestamp="soon"),
        with_(quantity="many"), with_(quantity=-1), with_(product_id="prod_other"), with_(quantity=0),
    ]
    classified = parse.classify_usage(raw(spark, *texts))
    assert parse.accepted(classified).count() == 2
    assert sorted(r.error_reason for r in parse.quarantined(classified).collect()) == sorted([
        "bad_json", "missing_event_id", "missing_customer_id", "missing_product_id", "bad_timestamp", "bad_quantity",
        "negative_quantity", "unknown_product",
    ])
    kept = {r.error_reason: r.raw for r in parse.quarantined(classified).collect()}
    assert kept["bad_json"] == "{broken"


def test_open_rate_end_is_null(spark, tmp_path):
    path = tmp_path / "rates.csv"
    path.write_text(
        "rate_id,product_id,plan_id,unit,unit_price,currency,effective_from,effective_to\n"
        "r1,p,plan_pro,u,0.000002,USD,2024-01-01,\nr2,p,plan_pro,u,0.1,USD,2024-01-01,2024-02-01\n"
    )
    packed = files.pack_pricing(files.read_pricing(spark, str(path)), batch_id="s", ingest_ts="2024-01-01 00:00:00", dt="2024-01-01")
    assert rows(parse.parse_rates(packed).select(F.col("unit_price").cast("string"), F.col("effective_to").cast("string"))) == [
        ("0.0000020000", None), ("0.1000000000", "2024-02-01"),
    ]


def test_missing_file_gives_no_rows(spark, tmp_path):
    assert files.ingest_usage(spark, str(tmp_path / "none.jsonl"), source="API", batch_id="b", ingest_ts="2024-01-01").count() == 0
    assert files.newest_snapshot(spark, str(tmp_path / "nowhere")) is None


def test_newest_snapshot_is_by_write_time(spark, tmp_path):
    import os

    for name, when in (("customers_b.jsonl", 1000), ("customers_a.jsonl", 2000), ("other.jsonl", 3000)):
        (tmp_path / name).write_text('{"customer_id":"%s"}\n' % name)
        os.utime(tmp_path / name, (when, when))
    assert files.newest_snapshot(spark, str(tmp_path)).endswith("customers_a.jsonl")


def test_day_comes_from_the_file_name(spark, tmp_path):
    (tmp_path / "usage_events_2024-01-05.jsonl").write_text(GOOD + "\n\n" + "oops\n")
    got = files.ingest_usage(spark, str(tmp_path), source="API", batch_id="b", ingest_ts="2024-01-06")
    assert rows(got.select(F.col("dt").cast("string"), "file_name", "bad_text")) == [
        ("2024-01-05", "usage_events_2024-01-05.jsonl", "oops"), ("2024-01-05", "usage_events_2024-01-05.jsonl", None),
    ]
