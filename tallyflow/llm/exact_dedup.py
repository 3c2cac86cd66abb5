"""Exact dedup: group by a 128-bit content hash, confirm by bytes inside groups, keep one row of each.

Three steps, each with partial aggregation, so that a group with a third of all rows costs one row per task:

1. a narrow table (id, length, hash, digest) is staged; groups are counted on it;
2. only rows whose hash occurs more than once are read again with their text, and grouped by hash and text:
   a hash with two different texts is a collision;
3. the narrow table is joined with its groups. Rows of collided hashes, normally none, are grouped by text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import SPACE, list_side, staged


def normalised(text: Column) -> Column:
    """The text without its white space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", "")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _rank(length: str, ident: str) -> Column:
    """Smallest first: longest original text, then smallest id, rows without an id last."""
    return F.struct((-F.col(length)).alias("l"), F.col(ident).isNull().alias("n"), F.col(ident).alias("id"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, hash_fn: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        docs.select(F.col(id_col).alias("_id"), F.char_length(text).alias("_len"), normalised(F.col(text_col)).alias("_norm"))
        .select("_id", "_len", "_norm", hash_fn(F.col("_norm")).alias("_hash"))
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn: Callable[[Column], Column] = hash128
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row of ``docs``, dropped ones too.

    Texts are equal when identical without white space; null counts as empty, and all empty texts are one
    group. Of a group the longest original text stays, then the smallest id; a null id loses against any
    other. Rows that repeat an id within a group share its verdict. Other columns are not looked at, whatever
    their names. An empty table gives no rows. ``hash_fn`` is exchangeable, so that tests can force collisions.
    """
    rows = _keyed(docs, id_col, text_col, hash_fn)
    narrow = staged(rows.select("_id", "_len", "_hash", F.sha2("_norm", 256).alias("text_sha256")), "exact-narrow")
    groups = narrow.groupBy("_hash").agg(F.min(_rank("_len", "_id")).alias("_keep"), F.count(F.lit(1)).alias("group_size"))
    groups = staged(groups, "exact-groups")  # used twice; and a join of two tables lets Spark split a hot hash
    collided = collisions(rows, groups)
    plain = narrow
    parts = []
    if not collided.isEmpty():
        odd = list_side(collided)
        plain = narrow.join(odd, "_hash", "left_anti")
        texts = rows.join(odd, "_hash", "left_semi")
        classes = texts.groupBy("_hash", "_norm").agg(F.min(_rank("_len", "_id")).alias("_keep"), F.count(F.lit(1)).alias("group_size"))
        parts.append(texts.withColumn("text_sha256", F.sha2("_norm", 256)).join(classes, ["_hash", "_norm"]))
    parts.append(plain.join(groups, "_hash"))
    columns = (
        F.col("_id").alias(id_col), F.col("_keep.id").alias("keep_id"), F.col("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep.id")).alias("kept"), F.col("text_sha256"),
    )
    out = parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def collisions(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Hashes under which different texts were found, by comparing the bytes of all rows that share a hash."""
    shared = list_side(staged(groups.where("group_size > 1").select("_hash"), "exact-shared"))
    texts = rows.join(shared, "_hash", "left_semi").select("_hash", "_norm").distinct()
    return staged(texts.groupBy("_hash").agg(F.count(F.lit(1)).alias("_texts")).where("_texts > 1").select("_hash"), "exact-collided")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; same rule as ``exact_groups``.

    Rows that share a hash travel whole to their group by hash and bytes; all others stay where they are. Rows
    that repeat id and text in full leave one row.
    """
    spark_cols = [F.col(f"`{c}`").alias(c) for c in docs.columns]
    rows = docs.select(
        F.struct(*spark_cols).alias("_row"), F.col(f"`{id_col}`").alias("_id"),
        F.char_length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_len"), normalised(F.col(f"`{text_col}`")).alias("_norm"),
    ).withColumn("_hash", hash128(F.col("_norm")))
    counts = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    shared = list_side(staged(counts.where("_rows > 1").select("_hash"), "exact-shared"))
    alone = rows.join(shared, "_hash", "left_anti").select("_row.*")
    together = rows.join(shared, "_hash", "left_semi")
    # the salt splits a hot group before its rows meet; ranks are then compared once more among the winners
    salted = Window.partitionBy("_hash", "_norm", "_salt").orderBy(_rank("_len", "_id"))
    whole = Window.partitionBy("_hash", "_norm").orderBy(_rank("_len", "_id"))
    first = together.withColumn("_salt", F.spark_partition_id()).withColumn("_n", F.row_number().over(salted)).where("_n = 1")
    best = first.withColumn("_n", F.row_number().over(whole)).where("_n = 1")
    return alone.unionByName(best.select("_row.*"))
