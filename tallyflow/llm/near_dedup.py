"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

1. Each text becomes the set of its word shingles; equal sets are one class (by a 128-bit digest), so thousands of
   copies cost one representative.
2. A representative's set is split into bins by the top bits of its hashes, the least hash of each bin is its
   signature; empty bins borrow from bins that the same hash sequence picks for every document.
3. Representatives with an equal band meet in a bucket. A bucket gives one star, around its most central member: the
   one that meets most others over all its buckets, as a text does that others derive from.
4. Edges are confirmed on full sets; confirmed edges are closed into components on tables.
5. Buckets that still hold several components are split by further bytes of the signatures, more of them the larger
   the bucket, SPLITS times over, until parts have some CROWD members. Each part gives stars around CENTRES drawn
   members to members of other components. Sketches are compared inside the tasks, so that only open pairs become rows.
6. All links together are closed into components once more.

The number of edges grows with the number of members, never with the square of a bucket.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import list_side, staged, staged_in_batches, staged_list
from tallyflow.llm.shingles import mix, shingle_sets, slices
from tallyflow.session import cleaned, scratch_path

SIZE = 5
PERCENT = 80
#: A pair is dropped before its full sets are compared only when its sketches agree so rarely that a pair at the threshold
#: does with at most this probability, by the exact binomial tail.
TAIL = 1e-9
#: Members that a part of a bucket should have, and the similarity of those that a split tells apart.
CROWD, APART = 16, 0.75
#: Splits of a crowded bucket, most signature bytes a split looks at, and drawn centres of a part: a member takes part in
#: at most BANDS * SPLITS * CENTRES comparisons of sketches after its BANDS star edges.
SPLITS, SPLIT_BYTES, CENTRES = 4, 24, 4
#: Long rows that a Python worker holds at once: texts, and pairs of full sets.
TEXTS_AT_ONCE, PAIRS_AT_ONCE = 1_000, 100
#: At similarity 0.8 a pair shares no band once in 2e7; at 0.5 it shares one in 87 of 100 cases.
BANDS, ROWS = 32, 4
#: Row ids that may be broadcast: structs with a nullable id, some 100 bytes each.
ROW_IDS = 500_000
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


@cache
def _probes(bins: int, tries: int) -> np.ndarray:
    """probes[t, j]: the bin that empty bin j looks at in its t-th try; the same for all documents."""
    seeds = np.arange(tries * bins, dtype=np.uint64) + np.uint64(0x51ED27)
    return (mix(seeds) % np.uint64(bins)).astype(np.int64).reshape(tries, bins)


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """Least hash per bin of a non-empty sorted set; ``bins`` is a power of two."""
    shift = np.uint64(64 - bins.bit_length() + 1)
    edges = np.searchsorted(shingles, np.arange(bins, dtype=np.uint64) << shift)
    full = edges < np.append(edges[1:], len(shingles))
    own = np.where(full, shingles[np.minimum(edges, len(shingles) - 1)], _NONE)
    out, tries, at = own.copy(), 64, 0
    empty = np.flatnonzero(~full)
    while len(empty):
        if at == tries:
            tries *= 2
        picks = _probes(bins, tries)[at, empty]
        hit = full[picks]
        out[empty[hit]] = own[picks[hit]]
        empty, at = empty[~hit], at + 1
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band from ``rows`` signature values and the band's number."""
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in sig[:bands * rows].reshape(bands, rows).T:
        keys = mix(keys + column)
    return keys


def _signed(size: int, bands: int, rows: int):
    """Task side: number of shingles, 128-bit digest of the set, band keys and sketch of each text; no digest for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = 1 << (bands * rows - 1).bit_length()
        for batch in batches:
            counts, digests, keys, sketches = [], [], [], []
            for shingles in shingle_sets(batch.column(1), size):
                counts.append(len(shingles))
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                sig = signature(shingles, bins) if len(shingles) else None
                keys.append(None if sig is None else band_keys(sig, bands, rows).view(np.int64))
                sketches.append(None if sig is None else sketch(sig))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["_id", "n_shingles", "_node", "_bands", "_sketch"],
            )

    return run


def sketch(sig: np.ndarray) -> bytes:
    """One byte of each signature value: enough to see that two sets are far from similar."""
    return (sig >> np.uint64(8)).astype(np.uint8).tobytes()


def _sets(size: int):
    """Task side: digest and full shingle set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                digests, sizes, found = [], [], []
                for shingles in shingle_sets(part, size):
                    found.append(shingles.tobytes())
                    digests.append(hashlib.blake2b(found[-1], digest_size=16).digest())
                    sizes.append(len(shingles))
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], names=["_node", "_size", "_set"])

    return run


def _possible(percent: int):
    """Task side: the pairs whose sketches agree as often as similar sets do, all but TAIL of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (_stacked(batch.column(i)) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array(_open(one, two, np.asarray(batch.column(4)), percent), pa.bool_()))

    return run


def _stacked(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), dtype=np.uint8).reshape(len(sketches), -1)


def _open(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether two rows of sketches agree as often as those of sets at the threshold may."""
    bins = one.shape[1]
    full = np.maximum(1.0, bins * (1 - (1 - 1 / bins) ** sizes))
    # a bin that a small set leaves empty repeats another: so many independent draws have the same variance
    drawn = np.clip(1 / (1 / full + (bins - full) / bins**2), 1, bins).round(6).astype(int)
    return (one == two).mean(axis=1) >= least_agreement(bins, percent)[drawn]


@cache
def least_agreement(bins: int, percent: int) -> np.ndarray:
    """By number of draws up to ``bins``: the largest share of agreements below which the binomial tail is at most TAIL."""
    like, out = percent / 100, [0.0]
    for n in range(1, bins + 1):
        below, k = 0.0, 0
        while k < n and (below := below + math.comb(n, k) * like**k * (1 - like) ** (n - k)) <= TAIL:
            k += 1
        out.append(k / n)
    return np.array(out)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task side: members of buckets (key, n, node, size, root, sketch) with a part for each split of the bucket.

    A split of a bucket looks at signature bytes that its key draws, as many as part members that are APART alike into
    CROWD; beyond SPLIT_BYTES members are also dealt by their own digest.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, n = (batch.column(i).to_numpy() for i in (0, 1))
        keys = keys.view(np.uint64)
        sketches = _stacked(batch.column(5))
        own = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64)[::2]
        looks = np.ceil(np.log(np.maximum(n / CROWD, 1)) / -math.log(APART)).astype(np.int64)
        deals = np.where(looks > SPLIT_BYTES, np.ceil(n * APART**SPLIT_BYTES / CROWD), 1).astype(np.uint64)
        looks = np.minimum(looks, SPLIT_BYTES)
        rows, parts = [], []
        for split in range(SPLITS):
            used = np.flatnonzero((looks > 0) | (split == 0))
            part = mix(keys[used] + np.uint64(split + 1))
            at = part.copy()
            for look in range(int(looks[used].max(initial=0))):
                at = mix(at + np.uint64(look + 1))
                value = sketches[used, (at % np.uint64(sketches.shape[1])).astype(np.int64)].astype(np.uint64) + np.uint64(1)
                part = np.where(look < looks[used], mix(part + value), part)
            rows.append(used)
            parts.append(mix(part + own[used] % deals[used]))
        taken = batch.select([2, 3, 4, 5]).take(pa.array(np.concatenate(rows)))
        part = np.concatenate(parts)
        draw = mix(part ^ np.concatenate([own[r] for r in rows]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.view(np.int64)), pa.array(draw.view(np.int64)), *taken.columns], names=["_part", "_draw", "_node", "_size", "_root", "_sketch"])


def _stars(percent: int):
    """Task side: open pairs (a, b) of members of each part with its first CENTRES members; rows come part by part.

    Pairs have different roots, and sizes and sketches that allow a link. Only the centres are kept between batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, centres = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, sizes = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            nodes, roots = batch.column(2).to_pylist(), np.array(batch.column(4).to_pylist(), object)
            sketches = _stacked(batch.column(5))
            ones, twos = [], []
            edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for low, high in zip(edges, edges[1:]):
                if parts[low] != current:
                    current, centres = parts[low], []
                for at in range(low, min(high, low + CENTRES - len(centres))):
                    centres.append((nodes[at], sizes[at], roots[at], sketches[at]))
                for node, size, root, sketch_ in centres:
                    span = slice(low, high)
                    may = (roots[span] != root) & (100 * np.minimum(sizes[span], size) >= percent * np.maximum(sizes[span], size))
                    which = low + np.flatnonzero(may)
                    if len(which):
                        fits = _open(sketches[which], np.broadcast_to(sketch_, (len(which), len(sketch_))), np.minimum(sizes[which], size), percent)
                        for i in which[fits]:
                            ones.append(min(node, nodes[i]))
                            twos.append(max(node, nodes[i]))
            yield pa.RecordBatch.from_arrays([pa.array(ones, pa.binary()), pa.array(twos, pa.binary())], names=["a", "b"])

    return run


def _confirmed(percent: int):
    """Task side: the pairs whose full sets are similar enough, in whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                one, two = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (left, right))
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _pairs(members: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b), a < b, of members and their bucket's centre whose set sizes allow the similarity."""
    sizes = (100 * F.least("_size", "_beside") >= percent * F.greatest("_size", "_beside")) & (F.col("_node") != F.col("_other"))
    return members.where(sizes).select(F.least("_node", "_other").alias("a"), F.greatest("_node", "_other").alias("b")).distinct()


def _beside(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """(a, b, left, right, size): pairs with a column of both sides. A centre in many pairs is a hot key that Spark splits."""
    left = sets.select(F.col("_node").alias("a"), F.col(column).alias("_left"), "_size")
    right = sets.select(F.col("_node").alias("b"), F.col(column).alias("_right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "_left", "_right", "_size")


def confirm(pairs: DataFrame, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """The pairs (a, b) that the full sets confirm; full sets are made, and travel, only for pairs whose sketches leave it open."""
    open_pairs = staged(_beside(pairs, sketches, "_sketch").mapInArrow(_possible(percent), "a binary, b binary"), "near-open")
    wanted = staged_list(open_pairs.select(F.explode(F.array("a", "b")).alias("_node")).distinct(), "near-wanted")
    sets = staged_in_batches(sets_of(wanted), "near-sets", TEXTS_AT_ONCE)
    wide = _beside(open_pairs, sets, "_set").drop("_size")
    return staged_in_batches(wide.mapInArrow(_confirmed(percent), "a binary, b binary"), "near-links", PAIRS_AT_ONCE)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b): the least node that can be reached.

    Each round a node takes the least root among its neighbours' roots, and then that root's own root; paths halve,
    so the number of rounds grows with the logarithm of the longest path. Every round is staged.
    """
    both = staged_list(edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "near"), "near-edges")
    labels = staged_list(both.groupBy("node").agg(F.min("near").alias("_near")).select("node", F.least("node", "_near").alias("root")), "near-labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("near"), F.col("root").alias("_root")), "near")
        least = staged_list(seen.groupBy("node").agg(F.min("_root").alias("_least")), "near-least")
        step = labels.join(least, "node").select("node", "root", F.least("root", "_least").alias("_next"))
        above = labels.select(F.col("node").alias("_next"), F.col("root").alias("_above"))
        step = staged_list(step.join(above, "_next", "left").select("node", F.least("_next", F.coalesce("_above", "_next")).alias("_new"), "root"), "near-labels")
        changed = not step.where("_new <> root").isEmpty()
        labels = step.select("node", F.col("_new").alias("root"))
        if not changed:
            return labels


def _unsettled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold several components, with their bucket's size and their root."""
    if labels is None:
        current = members.withColumn("_root", F.col("_node"))
    else:
        current = members.join(labels.select(F.col("node").alias("_node"), F.col("root").alias("_root")), "_node", "left")
        current = current.withColumn("_root", F.coalesce("_root", "_node"))
    current = staged(current.select("_key", "_node", "_size", "_root"), "near-current")
    mixed = current.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_root").alias("_low"), F.max("_root").alias("_high"))
    return current.join(mixed.where("_n > 2 AND _low <> _high").select("_key", "_n"), "_key")  # a bucket of two was one star


def _in_parts(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Distinct open pairs (a, b) across components from the stars of the parts of crowded buckets."""
    held = members.join(sketches.select("_node", "_sketch"), "_node").select("_key", "_n", "_node", "_size", "_root", "_sketch")
    parts = held.mapInArrow(_split, "_part long, _draw long, _node binary, _size long, _root binary, _sketch binary")
    ordered = parts.repartition("_part").sortWithinPartitions("_part", "_draw")
    return ordered.mapInArrow(_stars(percent), "a binary, b binary").distinct()


def _linked(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame | None:
    """(node, root) of all nodes with a link; None where there is no link.

    ``nodes`` has (_node, _size, _bands, _sketch); ``sets_of(list of nodes)`` gives their full sets.
    """
    banded = nodes.select("_node", "_size", F.explode("_bands").alias("_key"))
    counts = staged_list(banded.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "near-shared")
    members = staged(banded.join(list_side(counts), "_key"), "near-members")  # few bands are shared, the others need not travel
    if members.isEmpty():
        return None
    met = staged_list(members.groupBy("_node").agg(F.sum("_n").alias("_met")), "near-met")
    ranked = members.join(met, "_node")
    centre = F.max(F.struct(F.col("_met"), F.xxhash64("_node", "_key"), F.col("_node"), F.col("_size"))).alias("_centre")
    buckets = staged_list(ranked.groupBy("_key").agg(centre).select("_key", "_centre._node", "_centre._size"), "near-buckets")
    starred = members.join(buckets.toDF("_key", "_other", "_beside"), "_key")
    pairs = staged_list(_pairs(starred, percent), "near-pairs")
    sketches = staged_list(nodes.select("_node", "_size", "_sketch").join(list_side(met.select("_node")), "_node", "left_semi"), "near-sketches")
    links = confirm(pairs, sketches, sets_of, percent)
    labels = None if links.isEmpty() else components(links)
    rest = _in_parts(_unsettled(members, labels), sketches, percent).join(pairs, ["a", "b"], "left_anti")
    more = confirm(staged(rest, "near-rest"), sketches, sets_of, percent)
    if more.isEmpty():
        return labels
    return components(links.unionByName(more))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row.

    Words are runs without white space, A-Z lower-cased; a set holds the distinct shingles of ``size`` words of the
    whole text, or the whole sequence where it is shorter. Null texts and texts without words have an empty set and
    link with nothing. ``component_id`` is the smallest id reachable over confirmed links, the id itself included;
    null ids lose against any other. Rows that repeat id and set share the verdict. Other columns are not looked
    at. An empty table gives no rows.
    """
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    kind = texts.schema[0].dataType.simpleString()
    signed = texts.mapInArrow(_signed(size, bands, rows), f"_id {kind}, n_shingles long, _node binary, _bands array<bigint>, _sketch binary")
    signed = staged_in_batches(signed, "near-signed", TEXTS_AT_ONCE)
    nodes = signed.where("_node IS NOT NULL").groupBy("_node").agg(
        F.min("_id").alias("_id"), F.first("n_shingles").alias("_size"), F.first("_bands").alias("_bands"), F.first("_sketch").alias("_sketch")
    )
    nodes = staged(nodes, "near-nodes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        # Whole texts stay where they are while the list of their ids is short.
        ids = staged_list(nodes.join(wanted, "_node", "left_semi").select("_id").distinct(), "near-ids")
        rows_of = texts.alias("t").join(list_side(ids, ROW_IDS).alias("i"), F.col("t._id").eqNullSafe(F.col("i._id")), "left_semi").select("_text")
        found = rows_of.mapInArrow(_sets(size), "_node binary, _size long, _set binary")
        return found.join(wanted, "_node", "left_semi").dropDuplicates(["_node"])

    labels = _linked(nodes.select("_node", "_size", "_bands", "_sketch"), sets_of, percent)
    if labels is None:
        smallest = nodes.select("_node", F.col("_id").alias("component_id"))
    else:
        rooted = nodes.select("_node", "_id").join(labels.withColumnRenamed("node", "_node"), "_node", "left")
        rooted = staged(rooted.select("_node", "_id", F.coalesce("root", "_node").alias("_root")), "near-rooted")
        least = rooted.groupBy("_root").agg(F.min("_id").alias("component_id"))
        smallest = rooted.join(least, "_root").select("_node", "component_id")
    smallest = staged(smallest, "near-smallest")  # joined as a table, so that Spark can split a hot group of copies
    full = signed.select("_id", "n_shingles", "_node")
    linked = full.where("_node IS NOT NULL").join(smallest, "_node").select("_id", "n_shingles", "component_id")
    bare = full.where("_node IS NULL").select("_id", "n_shingles", F.col("_id").alias("component_id"))
    kept = F.col("_id").eqNullSafe(F.col("component_id"))
    return linked.unionByName(bare).select(F.col("_id").alias(id_col), "n_shingles", "component_id", kept.alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row of each group, by ``near_groups``.

    The row with the smallest id stays, a null id loses against any other; of rows that repeat an id, or have none,
    one stays. Rows without words all stay. Groups are kept and dropped by row, never by id alone, so ids may be
    repeated or null in any number. Columns of any name pass as they are.
    """
    named = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = staged(docs.select(F.monotonically_increasing_id().alias("_row"), named.alias("_doc")), "near-rows")
    ident = F.struct(F.col(f"_doc.`{id_col}`").isNull().alias("no"), F.col(f"_doc.`{id_col}`").alias("id"), F.col("_row").alias("row"))
    path = scratch_path(docs.sparkSession, "near-dropped")
    with cleaned(docs.sparkSession):  # rows and the list of dropped ones stay, all other tables go
        groups = near_groups(rows.select(ident.alias("_ident"), F.col(f"_doc.`{text_col}`").alias("_text")), "_ident", "_text", **settings)
        groups.where("NOT kept").select(F.col("_ident.row").alias("_row")).write.parquet(path)
    dropped = list_side(docs.sparkSession.read.schema("_row long").parquet(path))
    return rows.join(dropped, "_row", "left_anti").select("_doc.*")
