"""Run audit rows, their counters, and checkpoints."""

from __future__ import annotations

import datetime as dt_
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.literals import ntz, one_row
from ..schemas import RUN_AUDIT

RUN_KEY = ("run_id", "task")


def run_row(
    spark: SparkSession, *, run_id: str, job: str, execution_date: dt_.date, created_ts: dt_.datetime, task: str = "ALL",
    status: str = "SUCCESS", rows_inserted: int | None = None, rows_updated: int | None = None,
    duration_seconds: float | None = None, error_message: str | None = None,
) -> DataFrame:
    """One audit row."""
    values = {
        "run_id": run_id, "job": job, "task": task, "execution_date": execution_date, "status": status,
        "rows_inserted": rows_inserted, "rows_updated": rows_updated, "duration_seconds": duration_seconds,
        "error_message": error_message, "created_ts": created_ts,
    }
    return one_row(spark, RUN_AUDIT, values)


def backfill_rows(days: DataFrame, *, job: str, created_ts: dt_.datetime | str, prefix: str = "backfill_") -> DataFrame:
    """One success row per processed day; ``days`` has a date column ``dt``."""
    return days.select(
        F.concat(F.lit(prefix), F.col("dt").cast("string")).alias("run_id"), F.lit(job).alias("job"),
        F.lit("ALL").alias("task"), F.col("dt").alias("execution_date"), F.lit("SUCCESS").alias("status"),
        F.lit(None).cast("bigint").alias("rows_inserted"), F.lit(None).cast("bigint").alias("rows_updated"),
        F.lit(None).cast("double").alias("duration_seconds"), F.lit(None).cast("string").alias("error_message"),
        ntz(created_ts).alias("created_ts"),
    )


def merge_counters(merged: DataFrame) -> DataFrame:
    """Inserted and updated rows of a merge, one row."""
    return merged.agg(*_counters())


def _counters() -> list[Column]:
    return [
        F.count_if(F.col("action") == "insert").alias("rows_inserted"),
        F.count_if(F.col("action") == "update").alias("rows_updated"),
    ]


def watched_merge(merged: DataFrame, name: str = "merge") -> tuple[DataFrame, Observation]:
    """A merge with its counters, which are there once the rows have been written: no second pass over them.

    The counters sit above the join of the merge, in the stage that writes, where each task counts once.
    """
    observation = Observation(name)
    return merged.observe(observation, *_counters()), observation


def observed_counters(spark: SparkSession, observation: Observation) -> DataFrame:
    """The counters of a written merge, one row. A merge without rows has counted none."""
    seen = observation.get
    return spark.range(1).select(*[F.lit(seen.get(n) or 0).cast("bigint").alias(n) for n in ("rows_inserted", "rows_updated")])


def checkpoint_row(parsed: DataFrame, *, job: str, updated_ts: dt_.datetime | str) -> DataFrame:
    """Newest event time, ingest time and file day seen, one row."""
    return parsed.agg(
        F.max("event_ts").alias("last_event_ts"), F.max("ingest_ts").alias("last_ingest_ts"), F.max("dt").alias("last_dt")
    ).select(
        F.lit(job).alias("job"), "last_event_ts", "last_ingest_ts", "last_dt",
        ntz(updated_ts).alias("updated_ts"),
    )


def advanced(checkpoint: DataFrame, stored: DataFrame) -> DataFrame:
    """The checkpoint of a run joined with the stored one: each mark is the later of both, so it never goes back."""
    marks = ("last_event_ts", "last_ingest_ts", "last_dt", "updated_ts")
    both = checkpoint.unionByName(stored.select(*checkpoint.columns).join(checkpoint.select("job"), "job", "left_semi"))
    return both.groupBy("job").agg(*[F.max(m).alias(m) for m in marks])


def after_checkpoint(raw: DataFrame, checkpoints: DataFrame, job: str) -> DataFrame:
    """Raw rows ingested after the job's checkpoint; all rows where there is none."""
    last = checkpoints.where(F.col("job") == job).agg(F.max("last_ingest_ts")).scalar()
    return raw.where(last.isNull() | (F.col("ingest_ts") > last))


def fingerprints(rows: DataFrame, part: str, columns: Sequence[str]) -> DataFrame:
    """(part, fingerprint) per value of ``part``: the number of its rows and the exclusive-or of their hashes.

    It does not depend on order, so a part that is rebuilt with the same rows keeps its fingerprint.
    """
    text = F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.hex(F.bit_xor(F.xxhash64(*columns))))
    return rows.groupBy(part).agg(text.alias("fingerprint"))


def unseen(parts: DataFrame, seen: DataFrame, job: str) -> DataFrame:
    """Those of ``parts`` (part, fingerprint) that the job has not read as they are now."""
    return parts.join(seen.where(F.col("job") == job), ["part", "fingerprint"], "left_anti")
