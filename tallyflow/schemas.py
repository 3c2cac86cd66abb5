"""Column types, table schemas and enumerations shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# Decimal rule. Spark caps precision at 38 and gives up scale first, so money products are
# taken in two exact parts (functions.money) and rounded once to AMOUNT.  A value that does
# not fit raises under ANSI mode instead of losing cents.
QUANTITY = T.DecimalType(18, 6)
PRICE = T.DecimalType(18, 10)
AMOUNT = T.DecimalType(38, 10)
TOTAL_QUANTITY = T.DecimalType(28, 6)
FEE = T.DecimalType(18, 2)

# Enumerations the billing data uses.
PRODUCTS = ("prod_api_requests", "prod_storage_gb", "prod_compute_minutes", "prod_ai_tokens")
PLANS = ("plan_free", "plan_starter", "plan_pro", "plan_enterprise")
REGIONS = ("us-east-1", "us-west-2", "eu-central-1")
CUSTOMER_STATUSES = ("active", "delinquent", "cancelled")
INVOICE_STATUSES = ("draft", "issued", "paid", "failed", "void")
LINE_TYPES = ("base_fee", "usage", "overage", "adjustment", "tax")

S, L, D, TS, B = T.StringType(), T.LongType(), T.DateType(), T.TimestampNTZType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


USAGE_RAW = _schema(
    ("ingest_ts", TS), ("source", S), ("dt", D), ("batch_id", S), ("file_name", S),
    ("payload", T.VariantType()), ("bad_text", S),
)
SNAPSHOT_RAW = _schema(("ingest_ts", TS), ("dt", D), ("batch_id", S), ("payload", T.VariantType()))

USAGE_CLEAN = _schema(
    ("event_id", S), ("event_ts", TS), ("event_date", D), ("customer_id", S), ("product_id", S),
    ("plan_id", S), ("region", S), ("unit", S), ("quantity", QUANTITY), ("source", S),
    ("load_ts", TS), ("batch_id", S), ("raw_hash", S),
)
EVENT_INDEX = _schema(("event_date", D), ("blocks", L), ("block", L), ("bits", T.BinaryType()))
DAY_STATE = _schema(("event_date", D), ("fingerprint", S))
SEEN = _schema(("job", S), ("part", S), ("fingerprint", S))
QUARANTINE = _schema(
    ("ingest_ts", TS), ("dt", D), ("source", S), ("error_reason", S), ("raw", S), ("batch_id", S),
)
USAGE_DAILY = _schema(
    ("event_date", D), ("customer_id", S), ("product_id", S), ("unit", S),
    ("total_quantity", TOTAL_QUANTITY), ("event_count", L), ("last_event_ts", TS),
    ("load_ts", TS), ("batch_id", S),
)
CUSTOMERS_SEEN = _schema(
    ("customer_id", S), ("customer_name", S), ("status", S), ("country", S), ("plan_id", S), ("ingest_ts", TS), ("snapshot", S),
)
CUSTOMER_KEYS = _schema(("customer_id", S), ("customer_sk", L), ("load", S))
CUSTOMER_DIM = _schema(
    ("customer_sk", L), ("customer_id", S), ("customer_name", S), ("status", S), ("country", S),
    ("plan_id", S), ("effective_start", TS), ("effective_end", TS), ("is_current", B), ("record_hash", S),
)
RATE_DIM = _schema(
    ("rate_sk", L), ("rate_id", S), ("product_id", S), ("plan_id", S), ("unit", S), ("unit_price", PRICE),
    ("currency", S), ("effective_from", D), ("effective_to", D), ("is_current", B),
)
PRODUCT_DIM = _schema(("product_id", S), ("product_name", S), ("category", S), ("description", S))
PLAN_DIM = _schema(("plan_id", S), ("plan_name", S), ("base_fee", FEE), ("currency", S))
DATE_DIM = _schema(
    ("date_id", D), ("year", T.IntegerType()), ("month", T.IntegerType()), ("day", T.IntegerType()),
    ("quarter", T.IntegerType()), ("day_of_week", T.IntegerType()), ("is_weekend", B),
)
DAILY_COST = _schema(
    ("date_id", D), ("customer_sk", L), ("product_id", S), ("unit", S),
    ("total_quantity", TOTAL_QUANTITY), ("billable_quantity", TOTAL_QUANTITY), ("cost_amount", AMOUNT),
    ("currency", S), ("rate_sk", L), ("load_ts", TS), ("batch_id", S),
)
INVOICES = _schema(
    ("invoice_id", S), ("customer_sk", L), ("billing_period_start", D), ("billing_period_end", D),
    ("issued_ts", TS), ("status", S), ("subtotal", AMOUNT), ("tax", AMOUNT), ("total", AMOUNT),
    ("currency", S), ("load_ts", TS), ("batch_id", S),
)
LINE_ITEMS = _schema(
    ("invoice_id", S), ("line_item_id", S), ("line_type", S), ("product_id", S), ("unit", S),
    ("quantity", TOTAL_QUANTITY), ("unit_price", PRICE), ("amount", AMOUNT), ("rate_sk", L),
    ("usage_window_start", D), ("usage_window_end", D), ("calc_batch_id", S), ("load_ts", TS),
    ("billing_period_start", D),
)
BILLING_AUDIT = _schema(
    ("invoice_id", S), ("line_item_id", S), ("customer_id", S), ("product_id", S), ("event_date", D), ("source_batch_id", S),
    ("agg_row_hash", S), ("rate_sk", L), ("calc_batch_id", S), ("created_ts", TS), ("billing_period_start", D),
)
RUN_AUDIT = _schema(
    ("run_id", S), ("job", S), ("task", S), ("execution_date", D), ("status", S), ("rows_inserted", L),
    ("rows_updated", L), ("duration_seconds", T.DoubleType()), ("error_message", S), ("created_ts", TS),
)
CHECKPOINTS = _schema(
    ("job", S), ("last_event_ts", TS), ("last_ingest_ts", TS), ("last_dt", D), ("updated_ts", TS),
)
