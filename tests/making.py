"""Small inputs for unit tests."""

import datetime as dt
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow import schemas


def table(spark, items, schema):
    """Rows as a local relation: no Python worker is started to read them."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)
    columns = [pa.array([row[i] for row in items], field.type) for i, field in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def ts(text):
    return dt.datetime.fromisoformat(text)


def day(text):
    return dt.date.fromisoformat(text)


def event(event_id, at, customer="cust_1", product="prod_api_requests", unit="requests", quantity="1", load=None, raw_hash="h", batch="b1"):
    return (
        event_id, ts(at), ts(at).date(), customer, product, "plan_pro", "us-east-1", unit, Decimal(quantity), "API",
        ts(load or at), batch, raw_hash,
    )


def events(spark, *rows):
    return table(spark, list(rows), schemas.USAGE_CLEAN)


def customers(spark, *rows):
    """rows: (sk, id, plan, is_current)"""
    full = [(sk, cid, f"Name {cid}", "active", "US", plan, ts("2024-01-01"), None, current, None) for sk, cid, plan, current in rows]
    return table(spark, full, schemas.CUSTOMER_DIM)


def rates(spark, *rows):
    """rows: (sk, product, plan, unit, price, from, to)"""
    full = [
        (sk, f"rate_{sk}", product, plan, unit, Decimal(price), "USD", day(start), day(end) if end else None, end is None)
        for sk, product, plan, unit, price, start, end in rows
    ]
    return table(spark, full, schemas.RATE_DIM)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
