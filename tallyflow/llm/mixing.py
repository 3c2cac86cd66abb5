"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key divided by its quality weight; within a source documents are taken in
key order until the source's budget of words is met. Budgets above the size of a source are met by complete
epochs first, then by a fractional selection.

No source is sorted as a whole: keys fall into ``BUCKETS`` buckets, bucket sums are prefix-summed, and only the
one bucket in which a source's budget ends is ordered row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import SPACE, WORD, staged

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_EPOCHS = 2.0
BUCKETS = 1024


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def exponential_key(ident: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight with u in (0, 1) drawn from the id alone, so that reruns agree."""
    u = (F.pmod(F.xxhash64(F.lit(seed), ident), F.lit(2**52)) + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / F.coalesce(weight, F.lit(1.0))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS
) -> DataFrame:
    """(source, source_size, target): ``weights`` repeat along the sources by code point, null last.

    Weighted shares of ``share`` times all words; a target stops at ``most`` times its source's size and the
    excess is shared again by weight. With sources ordered by cap / weight, the capped ones are a prefix: the
    first source whose share is below its cap fixes the level of all later ones, and it is the greatest such level. Takes a table with one row
    per source (a sum with partial aggregation) and orders it in one task.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    listed = totals.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))
    listed = listed.withColumn("_cap", F.col("source_size") * F.lit(most))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    )
    levels = listed.withColumn("_level", level)
    open_level = F.max(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level"))).over(everything)
    shared = F.coalesce(open_level * F.col("_weight"), F.col("_cap"))
    return levels.select("source", "source_size", F.least(F.col("_cap"), shared).alias("target"))


def _with_key(rows: DataFrame, seed: int, buckets: int) -> DataFrame:
    """Key and bucket of each row from ``_id`` and ``_weight``; buckets follow the order of keys."""
    keyed = rows.withColumn("_key", exponential_key(F.col("_id"), F.col("_weight"), seed))
    place = F.floor((1 - F.exp(-F.col("_key"))) * buckets)
    return keyed.withColumn("_bucket", F.least(F.lit(buckets - 1), place).cast("int")).drop("_weight")


def _narrow(docs: DataFrame, id_col: str, text_col: str, source_col: str, weight: Column | None) -> DataFrame:
    return docs.select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"),
        (F.lit(1.0) if weight is None else weight).cast("double").alias("_weight"),
    )


def _plan(drawn: DataFrame, weights: Sequence[float], share: float, most: float) -> tuple[DataFrame, DataFrame]:
    """Per source: target, complete epochs and the bucket in which the rest ends; and the ids of that bucket that are taken."""
    targets = source_targets(drawn, weights, share, most)
    sums = drawn.groupBy("source", "_bucket").agg(F.sum("size").alias("_words"))
    running = Window.partitionBy("source").orderBy("_bucket")
    ends = sums.withColumn("_end", F.sum("_words").over(running))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = targets.withColumn("_epochs", epochs.cast("long")).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    over = F.col("_end") > F.col("_rest")
    plan = (
        ends.alias("e").join(budget.alias("b"), F.col("e.source").eqNullSafe(F.col("b.source")))
        .groupBy(F.col("b.source").alias("source"))
        .agg(
            F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.max("_epochs").alias("_epochs"), F.max("_rest").alias("_rest"),
            F.min(F.when(over, F.col("_bucket"))).alias("_last"), F.coalesce(F.max(F.when(~over, F.col("_end"))), F.lit(0)).alias("_before"),
        )
    )
    plan = staged(plan, "mix-plan")
    at_end = drawn.alias("d").join(
        plan.where("_last IS NOT NULL").alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d._bucket") == F.col("p._last"))
    )
    # rows that repeat an id are taken or left together
    merged = at_end.groupBy("p.source", "_id", "_key").agg(F.sum("size").alias("size"), F.max("_rest").alias("_rest"), F.max("_before").alias("_before"))
    inside = Window.partitionBy("source").orderBy("_key", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("_before") + F.sum("size").over(inside) - F.col("size") / 2
    taken = merged.withColumn("_middle", middle).where("_middle <= _rest").select("source", "_id")
    return plan, staged(taken, "mix-end").withColumn("_in", F.lit(1))


def _with_copies(drawn: DataFrame, plan: DataFrame, taken: DataFrame) -> DataFrame:
    joined = drawn.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    joined = joined.select("d.*", "source_size", "target", "_epochs", "_last").alias("j").join(
        taken.alias("t"), F.col("j.source").eqNullSafe(F.col("t.source")) & F.col("j._id").eqNullSafe(F.col("t._id")) & (F.col("_bucket") == F.col("_last")), "left"
    )
    inside = F.when(F.col("_last").isNull() | (F.col("_bucket") < F.col("_last")), 1).when(F.col("_bucket") > F.col("_last"), 0).otherwise(F.coalesce("_in", F.lit(0)))
    rest = F.when(F.col("target") > F.col("_epochs") * F.col("source_size"), inside).otherwise(0)
    return joined.select("j.*", (F.col("_epochs") + rest).alias("copies"))


def mix(
    docs: DataFrame, ratings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS, seed: int = 17, buckets: int = BUCKETS,
) -> DataFrame:
    """(id, size, source_size, target, copies, taken) for every row: how often the mix takes the document.

    ``ratings`` has (id, weight), one row per id: the quality weights; a document without one has weight 1.
    Null text has size 0; a null source is a source of its own, ordered last. Documents are taken whole, and the
    one at which the budget ends is taken when that brings the sum nearer. Rows that repeat an id share one draw
    and one verdict. Sources without words have target 0. Other columns are not looked at. An empty table gives
    no rows.
    """
    rows = _narrow(docs, id_col, text_col, source_col, None)
    if ratings is not None:
        rated = ratings.select(F.col(f"`{id_col}`").alias("_id"), F.col("weight").cast("double").alias("_weight"))
        rows = rows.drop("_weight").join(rated, "_id", "left")
    drawn = staged(_with_key(rows, seed, buckets), "mix-drawn")
    plan, taken = _plan(drawn, weights, share, most)
    return _with_copies(drawn, plan, taken).select(
        F.col("_id").alias(id_col), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def letter_share(text: Column) -> Column:
    """A quality weight from the text alone: letters among all characters that are not white space, at least 1/20."""
    solid = F.char_length(F.regexp_replace(text, rf"[{SPACE}]+", ""))
    letters = F.char_length(F.regexp_replace(text, r"\P{L}+", ""))
    return F.when(solid > 0, F.greatest(F.lit(0.05), letters / solid)).otherwise(F.lit(0.05))


def mixed_documents(
    docs: DataFrame, weight: Column | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS, seed: int = 17, buckets: int = BUCKETS,
) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, each as often as ``mix`` takes it.

    ``weight`` is an expression over the columns of ``docs``. Documents stay where they are: the plan (a row per
    source) and the ids of the end buckets (about 1 / ``buckets`` of the rows) are staged tables, which Spark
    broadcasts only below its threshold.
    """
    drawn = staged(_with_key(_narrow(docs, id_col, text_col, source_col, weight), seed, buckets), "mix-drawn")
    plan, taken = _plan(drawn, weights, share, most)
    columns = [F.col(f"`{c}`").alias(c) for c in docs.columns]
    whole = docs.select(
        F.struct(*columns).alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.col(f"`{source_col}`").alias("source"),
        (F.lit(1.0) if weight is None else weight).cast("double").alias("_weight"),
    )
    copies = _with_copies(_with_key(whole, seed, buckets), plan, taken).where("copies > 0")
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")
