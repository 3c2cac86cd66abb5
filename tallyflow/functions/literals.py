"""Constants as columns and rows, built in the JVM and independent of any time zone."""

from __future__ import annotations

import datetime as dt_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ntz(value: dt_.datetime | str | Column) -> Column:
    """A zone-free timestamp. Text is cast, never a datetime literal, which would pass through a zone."""
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("timestamp_ntz")


def date(value: dt_.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table with these columns; its size is known to be nothing, so joins with it stay cheap."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def one_row(spark: SparkSession, schema: T.StructType, values: dict[str, Any]) -> DataFrame:
    """One row; columns without a value are NULL."""
    def cell(field: T.StructField) -> Column:
        value = values.get(field.name)
        text = str(value) if isinstance(value, (dt_.date, dt_.datetime)) else value
        return F.lit(text).cast(field.dataType).alias(field.name)

    return spark.range(1).select(*[cell(f) for f in schema.fields])
