"""Layered Parquet tables with idempotent writes, using Spark's own partition overwrite."""

from __future__ import annotations

import datetime as dt_
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.literals import no_rows
from ..session import stage


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    partitions: tuple[str, ...]


USAGE_RAW = Table("bronze/usage_events_raw", schemas.USAGE_RAW, ("batch_id", "dt"))
CUSTOMERS_RAW = Table("bronze/customers_raw", schemas.SNAPSHOT_RAW, ("batch_id",))
PRICING_RAW = Table("bronze/pricing_catalog_raw", schemas.SNAPSHOT_RAW, ("batch_id",))
USAGE_CLEAN = Table("silver/usage_events_clean", schemas.USAGE_CLEAN, ("event_date",))
EVENT_INDEX = Table("silver/usage_event_index", schemas.EVENT_INDEX, ("event_date",))
DAY_STATE = Table("silver/usage_day_state", schemas.DAY_STATE, ("event_date",))
QUARANTINE = Table("silver/usage_events_quarantine", schemas.QUARANTINE, ("batch_id",))
USAGE_DAILY = Table("silver/usage_daily_agg", schemas.USAGE_DAILY, ("event_date",))
DAILY_COST = Table("gold/fact_customer_daily_usage", schemas.DAILY_COST, ("date_id",))
INVOICES = Table("gold/fact_invoices", schemas.INVOICES, ("billing_period_start",))
LINE_ITEMS = Table("gold/fact_invoice_line_items", schemas.LINE_ITEMS, ("billing_period_start", "line_type"))
CUSTOMERS_SEEN = Table("silver/customers_seen", schemas.CUSTOMERS_SEEN, ("snapshot",))
CUSTOMER_KEYS = Table("gold/customer_keys", schemas.CUSTOMER_KEYS, ("load",))
CUSTOMER_DIM = Table("gold/dim_customer", schemas.CUSTOMER_DIM, ())
RATE_DIM = Table("gold/dim_rate", schemas.RATE_DIM, ("currency",))
PRODUCT_DIM = Table("gold/dim_product", schemas.PRODUCT_DIM, ())
PLAN_DIM = Table("gold/dim_plan", schemas.PLAN_DIM, ())
DATE_DIM = Table("gold/dim_date", schemas.DATE_DIM, ())
BILLING_AUDIT = Table("gold/billing_audit", schemas.BILLING_AUDIT, ("billing_period_start",))
RUN_AUDIT = Table("ops/pipeline_run_audit", schemas.RUN_AUDIT, ("run_id",))
SEEN = Table("ops/parts_seen", schemas.SEEN, ("job",))
CHECKPOINTS = Table("ops/pipeline_checkpoints", schemas.CHECKPOINTS, ("job",))


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def path(self, table: Table) -> str:
        return f"{self.root.rstrip('/')}/{table.name}"

    def read(self, table: Table) -> DataFrame:
        """The table, or no rows where nothing has been written yet."""
        try:
            return self.spark.read.schema(table.schema).parquet(self.path(table)).select(*table.schema.fieldNames())
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return no_rows(self.spark, table.schema)
            raise

    def values(self, table: Table) -> list[str]:
        """Stored values of the first partition column as text, from the folder names alone."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(table))
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path) if status.isDirectory()]
        unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        start = f"{table.partitions[0]}="
        return sorted(unescape(name[len(start):]) for name in names if name.startswith(start))

    def replace(self, table: Table, rows: DataFrame) -> None:
        """Overwrite exactly the partitions ``rows`` touches; a rerun gives the same table.

        The rebalance hint lets AQE split a partition value that holds a large share of the
        rows over several writers and merge small ones, so files stay near the advisory size.
        """
        keys = [F.col(name) for name in table.partitions]
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]
        (
            rows.select(*columns).hint("rebalance", *keys)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*table.partitions).parquet(self.path(table))
        )

    def clear(self, table: Table, values: Iterable[object]) -> None:
        """Remove the partitions whose first partition column has one of ``values``, through Spark's file system."""
        jvm = self.spark._jvm
        escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        for value in sorted(set(map(str, values))):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/{table.partitions[0]}={escape(value)}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def replace_values(self, table: Table, rows: DataFrame, values: Iterable[object]) -> None:
        """Make ``rows`` all there is under ``values`` of the first partition column; what was there before goes.

        Unlike ``replace`` it also clears partitions that get no rows this time. Rows of other values are
        added as by ``replace``. Rows are staged first, as they may come from the table itself.
        """
        staged = stage(rows, "replacing")
        self.clear(table, values)
        self.replace(table, staged)

    def replace_days(self, table: Table, rows: DataFrame, days: Iterable[dt_.date]) -> None:
        """Rebuild whole days: days with no rows end up empty, other days stay as they are."""
        wanted = sorted(set(days))
        self.replace_values(table, rows.where(F.col(table.partitions[0]).isin(wanted)), wanted)

    def overwrite(self, table: Table, rows: DataFrame) -> None:
        """Replace a table without partitions by ``rows``, which may come from the table itself."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]
        stage(rows.select(*columns), "overwriting").write.mode("overwrite").parquet(self.path(table))

    def append_new(self, table: Table, rows: DataFrame, key: Sequence[str]) -> DataFrame:
        """Append the rows whose key is not in the table yet; returns what was added.

        A key already present within the touched partitions is left alone, so repeating the
        append changes nothing.
        """
        known = self.read(table).join(
            rows.select(*table.partitions).distinct(), list(table.partitions), "left_semi"
        )
        fresh = stage(rows.join(known.select(*key), list(key), "left_anti"), "append")
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]
        (
            fresh.select(*columns).hint("rebalance", *[F.col(p) for p in table.partitions])
            .write.mode("append").partitionBy(*table.partitions).parquet(self.path(table))
        )
        return fresh
