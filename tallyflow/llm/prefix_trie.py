"""The trie of conversations that begin alike, with sums over subtrees by depth bands.

1. Turns are ranked by one sort over the whole cluster, so a conversation of any length is spread over tasks.
2. A node is known by a sum of 126 bits over (depth, turn) of its path. Sums add up over parts of a conversation, and
   less its last term a sum is the parent's. Nodes whose parent or turn differ under one sum raise.
3. BAND depths form a band. Each node carries its ancestors inside its band, at most BAND of them, and gives its
   weights to those alone.
4. What a band's first nodes (its roots) have collected is closed the same way one level up, where a band root is one
   step deep: rounds are the logarithm of the depth to the base BAND. Completed totals of band roots then go to their
   ancestors in the band above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.functions.joins import skew_join
from tallyflow.llm.common import WORD, staged
from tallyflow.llm.streams import joined_sha256

BAND = 16
#: Bits of a band's number inside a group of bands.
GROUP_BITS = 12
LANES = ("l1", "l2", "l3", "l4")
NODE = ["a", "b"]


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, turn_no, digest, words): turns numbered from 1 in the order of turn (null first), role, digest of
    the text; ``part`` is the sorted partition a row lies in. A staged table. Null role and text are empty."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.sha2(text, 256).alias("of_text"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "of_text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.monotonically_increasing_id().alias("row"), F.sha2(F.concat(F.sha2("role", 256), "of_text"), 256).alias("digest"), "words",
    )
    ordered = staged(ordered, "trie-turns").withColumn("part", F.shiftright("row", 33))
    # one row per conversation and partition, and a conversation has no more of them than there are partitions
    runs = ordered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("row"))
    numbered = ordered.withColumn("inside", inside).join(runs, ["conv_id", "part"])
    return staged(numbered.select("conv_id", "part", (F.col("inside") + F.col("earlier")).alias("turn_no"), "digest", "words"), "trie-ranked")


def rebuilt(turns: DataFrame, heads: int = 4, family: int = 20) -> DataFrame:
    """Conversations that take their first turns from the first of their family: (conv_id, depth, digest, words).

    Conversation c takes h = crc32(c) % ``heads`` turns (all if there are fewer, none if it is absent) of conversation
    c - c % ``family``, then its own turns after its first h. Depth 0, the textless root, is a row of each conversation.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    base = F.col("conv_id") - F.col("conv_id") % family
    lent = turns.filter((base == F.col("conv_id")) & (F.col("turn_no") < heads)).select(F.col("conv_id").alias("base"), "turn_no", "digest", "words")
    members = turns.filter("turn_no = 1").select("conv_id", base.alias("base"), h.alias("h"))
    inherited = members.join(lent, "base").filter("turn_no <= h").select("conv_id", F.col("turn_no").alias("depth"), "digest", "words")
    # a conversation's rows in one sorted partition are shifted together, so a long one stays spread
    lengths = lent.groupBy("base").agg(F.max("turn_no").alias("has"))
    runs = turns.select("conv_id", "part").distinct().select("*", base.alias("base"), h.alias("h")).join(lengths, "base", "left")
    shifts = runs.select("conv_id", "part", "h", (F.least("h", F.coalesce("has", F.lit(0))) - F.col("h")).alias("shift"))
    own = turns.join(shifts, ["conv_id", "part"]).filter("turn_no > h").select("conv_id", (F.col("turn_no") + F.col("shift")).alias("depth"), "digest", "words")
    roots = members.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("words"))
    return roots.unionByName(inherited).unionByName(own)


def _lanes() -> list[Column]:
    """Four terms of 32 bits for a turn at a depth; the root has none."""
    digest = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), "digest"), 256)
    part = lambda i: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
    return [F.when(F.col("depth") == 0, F.lit(0)).otherwise(part(i)).cast("long").alias(n) for i, n in enumerate(LANES)]


def _key(sums: list[Column]) -> list[Column]:
    word = 1 << 32
    pair = lambda x, y: F.shiftleft(x % (word >> 1), 32) + y % word
    return [pair(sums[0], sums[1]), pair(sums[2], sums[3])]


def _offsets(totals: DataFrame) -> DataFrame:
    """(conv_id, at, o1..o4): the sums of all lanes at smaller ``at``; totals has (conv_id, at, l1..l4).

    Sums run inside groups of 2**GROUP_BITS; groups are summed one level up, until each conversation has one.
    """
    totals = staged(totals, "trie-bands")
    w = Window.partitionBy("conv_id", F.shiftright("at", GROUP_BITS)).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inside = totals.select("conv_id", "at", *(F.coalesce(F.sum(n).over(w), F.lit(0)).alias(f"o{i + 1}") for i, n in enumerate(LANES)))
    if (totals.agg(F.max("at")).first()[0] or 0) >> GROUP_BITS == 0:
        return inside
    up = totals.groupBy("conv_id", F.shiftright("at", GROUP_BITS).alias("up")).agg(*(F.sum(n).alias(n) for n in LANES))
    above = _offsets(up.withColumnRenamed("up", "at")).select("conv_id", F.col("at").alias("up"), *(F.col(f"o{i}").alias(f"u{i}") for i in range(1, 5)))
    joined = inside.withColumn("up", F.shiftright("at", GROUP_BITS)).join(above, ["conv_id", "up"])
    return joined.select("conv_id", "at", *((F.col(f"o{i}") + F.col(f"u{i}")).alias(f"o{i}") for i in range(1, 5)))


def paths(rows: DataFrame, band: int = BAND) -> DataFrame:
    """Rows of ``rebuilt`` with their node (a, b), its parent (pa, pb) and the nodes of their band down to it; staged."""
    laned = rows.select("conv_id", "depth", F.floor(F.col("depth") / band).cast("long").alias("at"), "digest", "words", *_lanes())
    offsets = _offsets(laned.groupBy("conv_id", "at").agg(*(F.sum(n).alias(n) for n in LANES)))
    w = Window.partitionBy("conv_id", "at").orderBy("depth")
    summed = laned.join(offsets, ["conv_id", "at"]).select(
        "*", *((F.sum(n).over(w) + F.col(f"o{i + 1}")).alias(f"s{i + 1}") for i, n in enumerate(LANES)))
    own = [F.col(f"s{i}") for i in range(1, 5)]
    above = [F.col(f"s{i + 1}") - F.col(n) for i, n in enumerate(LANES)]
    keyed = summed.select("conv_id", "depth", "at", "digest", "words", *(k.alias(n) for k, n in zip([*_key(own), *_key(above)], ["a", "b", "pa", "pb"])))
    chain = F.collect_list(F.struct(*NODE)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return staged(keyed.withColumn("chain", chain), "trie-paths")


def _to_ancestors(weights: DataFrame) -> DataFrame:
    """Weights (chain, leaves, saved) summed by the members of their chains."""
    given = weights.select(F.explode("chain").alias("node"), "leaves", "saved")
    return given.groupBy(F.col("node.a").alias("a"), F.col("node.b").alias("b")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def subtree_sums(steps: DataFrame, nodes: DataFrame, band: int = BAND) -> DataFrame:
    """(a, b, leaves, saved) summed over the subtree of every node, its top included.

    ``steps``: (conv_id, depth, a, b), the paths of conversations; ``nodes``: (a, b, pa, pb, depth, chain, leaves, saved),
    one row per node, staged.
    """
    inner = staged(_to_ancestors(nodes), "trie-sums")
    if (nodes.agg(F.max("depth")).first()[0] or 0) < band:
        return inner
    # band roots and the chain of their parents, whose first member is the band root above
    roots = nodes.filter((F.col("depth") % band == 0) & (F.col("depth") > 0)).select("a", "b", "depth", F.col("pa"), F.col("pb"))
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), "chain")
    hung = staged(skew_join(roots, parents, ["pa", "pb"], NODE), "trie-hung")
    higher = steps.filter(F.col("depth") % band == 0).select("conv_id", F.floor(F.col("depth") / band).cast("long").alias("depth"), *NODE)
    w = Window.partitionBy("conv_id", F.floor(F.col("depth") / band)).orderBy("depth")
    chained = higher.withColumn("chain", F.collect_list(F.struct(*NODE)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    chains = chained.groupBy(*NODE).agg(F.first("depth").alias("depth"), F.first("chain").alias("chain"))
    above = hung.select(*NODE, F.col("chain")[0]["a"].alias("pa"), F.col("chain")[0]["b"].alias("pb"))
    level = staged(chains.join(above, NODE, "left").join(inner, NODE), "trie-level")
    closed = subtree_sums(higher, level, band)
    handed = _to_ancestors(hung.join(closed, NODE))
    return staged(inner.unionByName(handed).groupBy(*NODE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "trie-closed")


def trie(rows: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie of (conv_id, depth, digest, words), as ``rebuilt`` gives them.

    Columns: conv_id (smallest member), depth, parent_conv_id (its parent's; null for the root), n_convs, n_children,
    n_leaves (childless nodes of its subtree), saved_tokens (over its subtree, members less one times the words of the
    last text), ends_sha256 (of the ids of conversations that end here, ascending, comma-joined). No rows give no nodes;
    a null conv_id is no conversation and null role or text is empty (``ranked_turns``). Repeated turns are turns. Ties
    in turn go by role, then digest of the text. Other columns are not looked at.
    """
    along = paths(rows, band)
    differ = lambda *names: F.greatest(*(F.when(F.min(n) == F.max(n), 0).otherwise(1) for n in names))
    found = along.groupBy("depth", *NODE).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.max("pa").alias("pa"),
        F.max("pb").alias("pb"), differ("pa", "pb", "digest").alias("differ"), F.first("chain").alias("chain"),
    )
    clash = F.raise_error(F.lit("two paths share one sum")).cast("long")
    found = found.select("*", F.when(F.col("differ") == 0, F.col("n")).otherwise(clash).alias("n_convs"))
    nodes = staged(found.drop("differ", "n"), "trie-nodes")
    below = nodes.filter("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = staged(nodes.join(below, NODE, "left").select(
        "*", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    ), "trie-counted")
    sums = subtree_sums(along.select("conv_id", "depth", *NODE), counted.select(*NODE, "pa", "pb", "depth", "chain", "leaves", "saved"), band)
    last = along.groupBy("conv_id").agg(F.max(F.struct("depth", *NODE)).alias("last")).select("conv_id", "last.a", "last.b", F.col("conv_id").cast("string").alias("id"))
    ends = joined_sha256(last, NODE, ["conv_id"], "id", ",", "ends_sha256")
    whole = counted.drop("leaves", "saved", "chain", "words").join(sums, NODE).join(ends, NODE, "left")
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    out = skew_join(whole, parents, ["pa", "pb"], NODE, how="left")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
