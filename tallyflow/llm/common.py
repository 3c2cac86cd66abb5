"""Pieces that several operators share: word patterns, local bindings, staged tables, checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.session import stage

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
#: Rows of a key list that may be broadcast: with keys of up to 16 bytes some 50 MB on each executor.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Inside a lambda an expression is evaluated for each element; a lambda's own argument is not.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text as an array; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that it is computed once and survives its executors."""
    return stage(df, name)


def staged_in_batches(df: DataFrame, name: str, rows: int) -> DataFrame:
    """``staged`` for a plan that sends long rows to Python: at most ``rows`` of them are in a worker's memory at once."""
    conf, setting = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(setting)
    conf.set(setting, str(rows))
    try:
        return staged(df, name)
    finally:
        conf.set(setting, before)


def staged_list(df: DataFrame, name: str) -> DataFrame:
    """``staged`` for a list that is short beside the documents: an eighth as many files as shuffle partitions."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(df.coalesce(max(8, partitions // 8)), name)


def list_side(keys: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged list of keys, marked for broadcast only when counting shows at most ``rows`` of them.

    A longer list is returned as it is, and the join on it becomes a shuffle join. Counting a staged table reads
    file footers only.
    """
    return F.broadcast(keys) if keys.count() <= rows else keys


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_slices(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose ``column`` of text or bytes has about ``most`` bytes, so that what is made of them
    stays small; a longer text is a run of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1).tolist(), len(sizes)]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def list_array(rows: Sequence[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrays as one Arrow list column, without an object per value."""
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
