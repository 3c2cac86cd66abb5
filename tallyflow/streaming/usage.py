"""Streams over landed usage files. Each drains what is there (``availableNow``) and can be rerun.

Billing must not lose an event by its age, so results are kept as tables that add up over micro-batches, not as
state behind a watermark.
"""

from __future__ import annotations

import datetime as dt_
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.literals import ntz
from ..functions.money import total_quantity
from ..operators import merge, parse
from ..operators.event_index import build_index, groups_holding
from ..plans import late_arrivals
from ..schemas import PRODUCTS
from ..session import cleaned, stage
from ..sources import files
from ..sources import lake as lk

DAY_KEYS = ("event_date", "customer_id", "product_id", "unit")
DELIVERY = ("event_id", "event_ts", "raw_hash")  # tells the deliveries of an event apart
DAILY_COLUMNS = (*DAY_KEYS, *DELIVERY, "quantity")


def raw_stream(
    spark: SparkSession, landing: str, *, source: str, batch_id: str, ingest_ts: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """Unbounded raw rows from JSON-lines files as they land.

    Without ``ingest_ts`` the row takes the modification time of its file, which a replay repeats.
    """
    lines = (
        spark.readStream.format("text").option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch).load(landing)
    )
    payload = F.try_parse_json("value")
    stamp = ntz(ingest_ts) if ingest_ts else F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    return lines.select(
        stamp.alias("ingest_ts"), F.lit(source).alias("source"),
        F.regexp_extract(F.col("_metadata.file_path"), files.DATE_IN_NAME, 1).try_cast("date").alias("dt"),
        F.lit(batch_id).alias("batch_id"), F.col("_metadata.file_name").alias("file_name"),
        payload.alias("payload"), F.when(payload.isNull(), F.col("value")).alias("bad_text"),
    )


def drain_raw(raw: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append raw rows to Parquet partitioned by file day; each file is taken once."""
    return (
        raw.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .partitionBy("dt").trigger(availableNow=True).start(target)
    )


def drain_unique(parsed: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Keep the newest delivery of each event, however late the others come; see ``add_unique``."""
    def write(batch: DataFrame, epoch: int) -> None:
        add_unique(batch, epoch, target)

    return parsed.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def add_unique(batch: DataFrame, epoch: int, target: str) -> None:
    """One micro-batch into the log of unique events.

    Its events are looked up in earlier epochs, of which the filters name the few that may hold one. Deliveries that are
    new or newer are stored under the epoch, and so is the identity of each delivery that they replace. A repeated or older
    delivery stores nothing, so the log holds little more than one row per event; nothing is dropped by age and no state
    grows in memory. A replayed epoch sees the same earlier epochs and overwrites its own folders with the same rows. The
    deliveries are written last, and what they replace counts only with them. Rows without an event id are left out:
    nothing tells their deliveries apart. The log belongs to one checkpoint; ``compact_unique`` shortens it.
    """
    spark = batch.sparkSession
    with cleaned(spark):
        source = stage(merge.dedupe_events(batch.where("event_id IS NOT NULL")), "stream-events")
        changed = _changes(source, _known(spark, target, epoch, source), source.columns).withColumn("of", F.lit(epoch))
        changes = stage(changed, "stream-changes")
        _write_unique(target, epoch, changes.where("sign > 0").drop("sign", "moved"), changes.where("sign < 0"))


def _write_unique(target: str, epoch: int, events: DataFrame, replaced: DataFrame) -> None:
    index = build_index(events, "of").drop("of")
    for name, rows in (("index", index), ("replaced", replaced.select(*DELIVERY)), ("events", events.drop("of"))):
        rows.write.mode("overwrite").parquet(f"{target}/{name}/epoch={epoch}")


def current_unique(spark: SparkSession, target: str) -> DataFrame:
    """The newest delivery of each event: the log without the deliveries that a later epoch replaced.

    Only those, few beside the events, are matched; the events are not grouped again.
    """
    events = _log(spark, f"{target}/events")
    # One row per micro-batch: epochs whose deliveries are there.
    whole = [r.epoch for r in events.select("epoch").distinct().collect()]
    replaced = _log(spark, f"{target}/replaced").where(F.col("epoch").isin(whole)).select(*DELIVERY).distinct().hint("merge")  # grows with the log
    same = (F.col("a.event_id") == F.col("b.event_id")) & F.expr("a.event_ts <=> b.event_ts AND a.raw_hash <=> b.raw_hash")
    return events.drop("epoch").alias("a").join(replaced.alias("b"), same, "left_anti")


def compact_unique(spark: SparkSession, target: str, compacted: str) -> DataFrame:
    """The log of unique events as one epoch at a new place, by the rules of ``compact_daily``."""
    newest = _log(spark, f"{target}/events").agg(F.max("epoch")).first()[0]
    if newest is None:
        return current_unique(spark, target)
    with cleaned(spark):
        events = stage(current_unique(spark, target).withColumn("of", F.lit(newest)), "compacting")
        _write_unique(compacted, newest, events, events.where("false"))
    return current_unique(spark, compacted)


def _log(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.option("basePath", target).parquet(f"{target}/epoch=*")


def _changes(source: DataFrame, known: DataFrame | None, columns: Sequence[str] = DAILY_COLUMNS) -> DataFrame:
    """What new deliveries change: the newest delivery of an event comes with ``sign`` 1, the one it replaces with -1.

    ``moved`` marks a replaced delivery that counted for another day, customer, product or unit. A delivery that is
    no newer than the known one changes nothing.
    """
    s = source.select(F.col("event_id").alias("s_id"), F.struct(*columns).alias("s"))
    if known is None:
        pairs = s.withColumn("k", F.lit(None).cast(s.schema["s"].dataType))
    else:
        pairs = s.join(known.select(F.col("event_id").alias("k_id"), F.struct(*columns).alias("k")), F.col("s_id") == F.col("k_id"), "left")
    newer = F.col("k").isNull() | (F.struct("s.event_ts", "s.raw_hash") > F.struct("k.event_ts", "k.raw_hash"))
    stays = F.struct(*[f"s.{c}" for c in DAY_KEYS]).eqNullSafe(F.struct(*[f"k.{c}" for c in DAY_KEYS]))
    both = F.array(
        F.struct(F.col("s").alias("e"), F.lit(1).alias("sign"), F.lit(False).alias("moved")),
        F.struct(F.col("k").alias("e"), F.lit(-1).alias("sign"), (~stays).alias("moved")),
    )
    return pairs.where(newer).select(F.inline(both)).where("e IS NOT NULL").select("e.*", "sign", "moved")


def daily_parts(changes: DataFrame) -> DataFrame:
    """What changes add to daily usage, per day, customer, product and unit; parts of a day add up."""
    return changes.groupBy(*DAY_KEYS).agg(
        total_quantity(F.when(F.col("sign") > 0, F.col("quantity")).otherwise(-F.col("quantity"))).alias("total_quantity"), F.sum("sign").cast("bigint").alias("event_count"),
        F.max(F.when(F.col("sign") > 0, F.col("event_ts"))).alias("last_event_ts"), F.bool_or("moved").alias("moved"),
    )


def _known(spark: SparkSession, target: str, epoch: int, ids: DataFrame) -> DataFrame | None:
    """The newest stored delivery of each of ``ids`` from the epochs before this one; None in the first epoch.

    The filters of the epochs name the few that may hold an id, so the others are not read.
    """
    try:
        index = _log(spark, f"{target}/index").where(F.col("epoch") < epoch)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    holding = [r.epoch for r in groups_holding(index, ids, "epoch").collect()]  # one row per micro-batch
    stored = _log(spark, f"{target}/events").where(F.col("epoch").isin(holding))
    # By shuffle: the ids of a micro-batch are no list for the driver, and the rows are needed by event id next.
    return merge.dedupe_events(stored.join(ids.select("event_id").hint("merge"), "event_id", "left_semi"))


def drain_daily(parsed: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Daily usage where each event counts once, by its newest delivery, however late and often it is delivered.

    A micro-batch looks its events up among those of earlier epochs and writes, under its own epoch, the deliveries that
    are new, filters over their ids, and signed parts of daily usage: plus the new delivery, minus the one it replaces.
    Parts add up, no state is held in memory and nothing is dropped by age. An epoch that is replayed sees the same
    earlier epochs and overwrites its own folders with the same rows. Rows without an event id are left out: nothing
    tells their deliveries apart, and ``parse.accepted`` has none. The log belongs to one checkpoint; ``compact_daily``
    shortens it.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        with cleaned(spark):
            source = stage(merge.dedupe_events(batch.where("event_id IS NOT NULL")), "stream-events")
            changed = _changes(source, _known(spark, target, epoch, source)).withColumn("of", F.lit(epoch))
            changes = stage(changed, "stream-changes")
            new = changes.where("sign > 0").drop("sign", "moved")
            _write_epoch(target, epoch, new, daily_parts(changes))

    return parsed.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def _write_epoch(target: str, epoch: int, events: DataFrame, parts: DataFrame) -> None:
    """``events`` carry the epoch as a stored column ``of``: a constant would turn the join on it into a nested loop."""
    index = build_index(events, "of").drop("of")
    for name, rows in (("index", index), ("events", events.drop("of")), ("parts", parts)):
        rows.write.mode("overwrite").parquet(f"{target}/{name}/epoch={epoch}")


def current_daily(spark: SparkSession, target: str) -> DataFrame:
    """Daily usage over all micro-batches.

    The newest time of a day that lost an event to another one is taken from the stored events of that day again.
    """
    added = _log(spark, f"{target}/parts").groupBy(*DAY_KEYS).agg(
        total_quantity("total_quantity").alias("total_quantity"), F.sum("event_count").alias("event_count"),
        F.max("last_event_ts").alias("last_event_ts"), F.bool_or("moved").alias("moved"),
    ).where("event_count > 0")
    lost = added.where("moved").select(*DAY_KEYS)
    if lost.isEmpty():
        return added.drop("moved")
    same = F.expr(" AND ".join(f"a.{k} <=> b.{k}" for k in DAY_KEYS))
    events = merge.dedupe_events(_log(spark, f"{target}/events").drop("epoch")).alias("a").join(lost.alias("b"), same, "left_semi")
    times = events.groupBy(*DAY_KEYS).agg(F.max("event_ts").alias("newest"))
    return added.alias("a").join(times.alias("b"), same, "left").select(
        *[f"a.{k}" for k in DAY_KEYS], "total_quantity", "event_count",
        F.when(F.col("moved"), F.col("newest")).otherwise(F.col("last_event_ts")).alias("last_event_ts"),
    )


def compact_daily(spark: SparkSession, target: str, compacted: str) -> DataFrame:
    """The log as one epoch at a new place, while no stream writes to it; readers and the stream then take the new place.

    The newest epoch number is kept as the folder's name, so that a stream that goes on at the new place adds later
    epochs. The old log stays until it is removed by hand.
    """
    newest = _log(spark, f"{target}/parts").agg(F.max("epoch")).first()[0]
    with cleaned(spark):
        unique = merge.dedupe_events(_log(spark, f"{target}/events").drop("epoch"))
        events = stage(unique.withColumn("of", F.lit(newest)), "compacting")
        _write_epoch(compacted, newest, events, current_daily(spark, target).withColumn("moved", F.lit(False)))
    return current_daily(spark, compacted)


def _accepted(lake: lk.Lake, batch: DataFrame, epoch: int, products: Sequence[str] | None) -> DataFrame:
    """Rows of a micro-batch that can be billed; the rest goes to quarantine under the batch id and the epoch.

    ``products=None`` accepts every product. A replayed epoch replaces its own quarantine rows.
    """
    classified = parse.classify_usage(batch, products or ())
    if products is None:
        classified = classified.withColumn("error_reason", F.when(F.col("error_reason") != "unknown_product", F.col("error_reason")))
    # Only the quarantine takes payloads.
    classified = stage(classified.withColumn("payload", F.when(F.col("error_reason").isNotNull(), F.col("payload"))), "stream-batch")
    rejects = parse.quarantined(classified).withColumn("batch_id", F.concat_ws("-", "batch_id", F.lit(str(epoch))))
    lake.replace_values(lk.QUARANTINE, rejects, [r[0] for r in rejects.select("batch_id").distinct().collect()])
    return parse.accepted(classified)


def drain_clean(
    raw: DataFrame, lake: lk.Lake, checkpoint: str, on_match: str = merge.TOUCH_CHANGED, products: Sequence[str] | None = PRODUCTS
) -> StreamingQuery:
    """Merge the sound rows of each micro-batch into the clean table. Merging a batch twice changes nothing.

    Micro-batches come in no order of event time, so with ``merge.REPLACE`` the newest delivery of an event stays.
    """
    on_match = merge.NEWEST if on_match == merge.REPLACE else on_match

    def upsert(batch: DataFrame, epoch: int) -> None:
        with cleaned(lake.spark):
            merge.merge_into_clean(lake, merge.as_clean(_accepted(lake, batch, epoch, products)), on_match)

    return (
        raw.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(upsert).start()
    )


def drain_late(
    raw: DataFrame, lake: lk.Lake, customers: DataFrame, rates: DataFrame, checkpoint: str, *, run_id: str,
    as_of: dt_.datetime, match_plan: bool = True, products: Sequence[str] | None = PRODUCTS,
) -> StreamingQuery:
    """Adjust issued invoices for the late events among the sound rows of each micro-batch."""
    def route(batch: DataFrame, epoch: int) -> None:
        with cleaned(lake.spark):
            events = merge.dedupe_events(merge.as_clean(_accepted(lake, batch, epoch, products)))
            late_arrivals.reconcile_late(lake, customers, rates, run_id=run_id, as_of=as_of, match_plan=match_plan, events=events)

    return (
        raw.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(route).start()
    )
