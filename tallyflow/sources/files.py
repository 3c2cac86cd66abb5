"""Landing-zone readers: usage JSON lines, customer snapshots, price and dimension CSV files."""

from __future__ import annotations

import datetime as dt_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.literals import date, no_rows, ntz
from ..schemas import SNAPSHOT_RAW, USAGE_RAW

DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"

# Header of the price catalog file.
PRICING_COLUMNS = (
    "rate_id", "product_id", "plan_id", "unit", "unit_price", "currency", "effective_from", "effective_to",
)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame | None:
    reader = spark.read.option("recursiveFileLookup", "true")
    try:
        return reader.text(path).where(F.length(F.trim("value")) > 0)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def ingest_usage(
    spark: SparkSession, path: str | list[str], *, source: str, batch_id: str | Column,
    ingest_ts: dt_.datetime | str | Column, dt: dt_.date | None = None,
) -> DataFrame:
    """Raw usage rows from JSON-lines files; a missing file gives no rows and no error.

    ``dt`` defaults to the date in the file or folder name, so one call covers any number of
    days. The payload is kept as VARIANT; text that is not JSON is kept as it came.
    """
    lines = _lines(spark, path)
    if lines is None:
        return no_rows(spark, USAGE_RAW)
    named = F.regexp_extract(F.col("_metadata.file_path"), DATE_IN_NAME, 1).try_cast("date")
    payload = F.try_parse_json("value")
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return (
        lines.withColumn("dt", date(dt) if dt else named)
        .withColumn("file_name", F.col("_metadata.file_name"))
        .select(
            ntz(ingest_ts).alias("ingest_ts"), F.lit(source).alias("source"), "dt",
            batch.cast("string").alias("batch_id"), "file_name", payload.alias("payload"),
            F.when(payload.isNull(), F.col("value")).alias("bad_text"),
        )
    )


def newest_snapshot(spark: SparkSession, folder: str, pattern: str = r"(customers_[^/]*\.jsonl)") -> str | None:
    """Path of the newest snapshot under ``folder``; a snapshot is one file or a folder of parts.

    Only the listing is read (the content column is pruned away) and one row comes back.
    """
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    newest = (
        listing.select(F.regexp_extract("path", pattern, 1).alias("name"), "modificationTime")
        .where("name != ''")
        .groupBy("name").agg(F.max("modificationTime").alias("written"))
        .orderBy(F.desc("written"), F.desc("name"))
        .first()
    )
    return f"{folder.rstrip('/')}/{newest.name}" if newest else None


def ingest_customers(
    spark: SparkSession, folder: str, *, batch_id: str, ingest_ts: dt_.datetime | str, dt: dt_.date | str
) -> DataFrame:
    """Raw rows of the newest customer snapshot only."""
    path = newest_snapshot(spark, folder)
    lines = _lines(spark, path) if path else None
    if lines is None:
        return no_rows(spark, SNAPSHOT_RAW)
    return lines.select(
        ntz(ingest_ts).alias("ingest_ts"), date(dt).alias("dt"),
        F.lit(batch_id).alias("batch_id"), F.try_parse_json("value").alias("payload"),
    )


def read_pricing(spark: SparkSession, path: str) -> DataFrame:
    """The price catalog as text columns; typing happens in the parse step."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in PRICING_COLUMNS])
    return spark.read.csv(path, schema=schema, header=True)


def pack_pricing(catalog: DataFrame, *, batch_id: str, ingest_ts: Column | str, dt: dt_.date | str) -> DataFrame:
    """Catalog rows as raw rows: seven columns packed into one object, ``unit_price`` named ``price``."""
    packed = F.struct(
        "product_id", "plan_id", "unit", F.col("unit_price").alias("price"), "currency",
        "effective_from", "effective_to",
    )
    return catalog.select(
        ntz(ingest_ts).alias("ingest_ts"), date(dt).alias("dt"),
        F.lit(batch_id).alias("batch_id"), F.to_variant_object(packed).alias("payload"),
    )


def load_dimension(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines with what could be read of their key) of a CSV dimension with a header."""
    bad = "_bad_line"
    # Column pruning would let a short line pass wherever its missing columns are not read.
    rows = spark.read.option("columnPruning", "false").csv(
        path, schema=T.StructType([*schema.fields, T.StructField(bad, T.StringType())]), header=True,
        quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=bad,
    )
    good = rows.where(F.col(bad).isNull()).select(*schema.fieldNames())
    rejected = rows.where(F.col(bad).isNotNull()).select(schema.fieldNames()[0], F.col(bad).alias("line"))
    return good, rejected
