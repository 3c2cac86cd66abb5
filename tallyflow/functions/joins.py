"""Join helpers that stay whole and even when one key holds a large share of the rows.

Conditions passed as ``within`` name the sides ``l`` and ``r``: ``F.col("l.event_date")``.
No helper forces a broadcast of a side that can grow: Spark broadcasts below
``spark.sql.autoBroadcastJoinThreshold`` (checked on plan statistics, and by AQE on real
sizes), and above it the same keys give an even shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

SALTS = 16
HOT_SHARE = 200  # a key is hot when it holds at least 1/200 of the rows: never more than 200 keys

_LEFT_ONLY = {"left_semi", "left_anti"}


def keyed_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], within: Column | None = None, how: str = "inner"
) -> DataFrame:
    """Equi join on ``on`` with an optional residual condition; keys come out once, from the left."""
    match = F.expr(" AND ".join(f"l.`{k}` = r.`{k}`" for k in on))
    joined = left.alias("l").join(right.alias("r"), match if within is None else match & within, how)
    columns = [f"l.`{c}`" for c in left.columns]
    if how not in _LEFT_ONLY:
        columns += [f"r.`{c}`" for c in right.columns if c not in on]
    return joined.selectExpr(*columns)


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_on: Sequence[str],
    within: Column | None = None, how: str = "inner", salts: int = SALTS,
) -> DataFrame:
    """Join on few distinct keys: rows of one key are spread over ``salts`` partitions.

    The right side (a catalog) is repeated per salt; every left row meets each right row of
    its key exactly once, so results equal the plain join.
    """
    salted_left = left.selectExpr("*", f"cast(pmod(xxhash64({', '.join(spread_on)}), {salts}) AS INT) AS _salt")
    salted_right = right.selectExpr("*", f"explode(sequence(0, {salts - 1})) AS _salt")
    return keyed_join(salted_left, salted_right, [*on, "_salt"], within, how).drop("_salt")


def hot_keys(df: DataFrame, on: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys holding at least 1/share of the rows, hence at most ``share`` of them."""
    counts = stage(df.groupBy(*on).agg(F.expr("count(1)").alias("_rows")), "key-counts")  # the rows are counted once
    total = counts.agg(F.sum("_rows").alias("_total")).scalar()
    return counts.where(F.col("_rows") * F.lit(share) >= total).selectExpr(*on, "true AS _hot")


def skew_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_on: Sequence[str],
    within: Column | None = None, how: str = "inner", salts: int = SALTS, share: int = HOT_SHARE,
) -> DataFrame:
    """Join of a large left side with a large right side where few keys may be very hot.

    Only the hot keys are salted, so the right side grows by at most ``share * (salts - 1)``
    keys' rows. The list of hot keys is broadcast: it has at most ``share`` rows by definition.
    """
    hot = F.broadcast(hot_keys(left, on, share))
    salted_left = left.join(hot, list(on), "left").selectExpr(
        *[f"`{c}`" for c in left.columns],
        f"CASE WHEN _hot THEN cast(pmod(xxhash64({', '.join(spread_on)}), {salts}) AS INT) ELSE 0 END AS _salt",
    )
    salted_right = right.join(hot, list(on), "left").selectExpr(
        *[f"`{c}`" for c in right.columns],
        f"explode(CASE WHEN _hot THEN sequence(0, {salts - 1}) ELSE array(0) END) AS _salt",
    )
    return keyed_join(salted_left, salted_right, [*on, "_salt"], within, how).drop("_salt")


def as_of_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], at: str, since: str, spread_on: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """Each left row with the newest right row of its keys whose ``since`` is not after the row's ``at``; none: it drops out.

    Both sides are ordered together by time, and the last right row is carried forward: one shuffle, no range residual,
    no count of keys, and the left side is computed once. Rows of a key are spread over ``salts`` windows, each
    with all right rows of the key (a dimension), so a key with a third of the left rows is no single task; a window
    holds one right row in memory. Of right rows with equal keys and ``since`` one wins by its values. Null keys and
    null times match nothing.
    """
    kept = [c for c in right.columns if c not in on]
    spread = f"cast(pmod(xxhash64({', '.join(spread_on)}), {salts}) AS INT) AS _salt"
    rows = left.selectExpr(*on, spread, f"`{at}` AS _time", "1 AS _kind", f"struct({', '.join(f'`{c}`' for c in left.columns)}) AS _row")
    versions = right.selectExpr(
        *on, f"explode(sequence(0, {salts - 1})) AS _salt", f"`{since}` AS _time", "0 AS _kind", f"struct({', '.join(f'`{c}`' for c in kept)}) AS _version"
    )
    known = F.lit(True)
    for key in on:
        known = known & F.col(key).isNotNull()
    both = rows.unionByName(versions, allowMissingColumns=True).where(known & F.col("_time").isNotNull())
    order = Window.partitionBy(*on, "_salt").orderBy("_time", "_kind", "_version")
    carried = both.withColumn("_version", F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return carried.where("_kind = 1 AND _version IS NOT NULL").select("_row.*", *[f"_version.`{c}`" for c in kept])


def with_details(heads: DataFrame, details: DataFrame, key: str, spread_on: Sequence[str]) -> DataFrame:
    """Each head with its detail rows, heads without details kept; one head may own most of the details.

    A left join from the heads could not split such a head, so matched and bare heads are two parts.
    """
    matched = skew_join(details, heads, [key], spread_on)
    bare = heads.join(details.select(key).distinct(), key, "left_anti")
    return matched.unionByName(bare, allowMissingColumns=True)


def with_neighbour(
    df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, bucket: Column, following: bool = False
) -> DataFrame:
    """Previous (or next) non-null ``value`` by ``order`` within ``keys``, without a window over a whole key.

    Windows run per (key, bucket); the value at the edge of each bucket, one row per bucket and
    combined on the map side, is carried into the neighbouring bucket. A key with a third of all
    rows is so spread over as many tasks as it has buckets.
    """
    bucketed = df.withColumn("_bucket", bucket)
    edge = F.min_by(value, order) if following else F.max_by(value, order)
    step = F.lead if following else F.lag
    carried = (
        bucketed.groupBy(*keys, "_bucket").agg(edge.alias("_edge"))
        .withColumn("_carry", step("_edge").over(Window.partitionBy(*keys).orderBy("_bucket")))
        .drop("_edge")
    )
    near = step(value).over(Window.partitionBy(*keys, "_bucket").orderBy(order))
    return (
        bucketed.withColumn("_near", near)
        .join(carried, [*keys, "_bucket"])
        .withColumn(name, F.coalesce("_near", "_carry"))
        .drop("_bucket", "_near", "_carry")
    )
