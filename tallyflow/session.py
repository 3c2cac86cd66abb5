"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_JOBS = threading.local()  # streams run their batches in threads of their own
CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "tallyflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs are written for; a cluster's own settings win via ``conf``.

    Shuffle width is left to AQE: it starts wide and coalesces to the advisory size, so the
    same job fits a laptop and a thousand executors.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",  # a value that does not fit raises instead of becoming NULL
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, or a new local one on a local master.

    Elsewhere a local folder would exist once per machine and reads would miss rows, so its absence raises.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        context = spark.sparkContext
        if context.getCheckpointDir() is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyflow-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder. Inside ``cleaned`` it is removed at the end of the job."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in getattr(_JOBS, "open", []):
        paths.append(path)
    return path


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """A job whose intermediate tables go when it ends, also when it fails.

    For jobs that return plain values only: a DataFrame over a staged table could not be read any more.
    """
    _JOBS.open = [*getattr(_JOBS, "open", []), []]
    try:
        yield
    finally:
        paths = _JOBS.open[-1]
        _JOBS.open = _JOBS.open[:-1]
        for text in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(text)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor. Used where a result is needed
    by several writes, or where a table is rebuilt from itself.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
