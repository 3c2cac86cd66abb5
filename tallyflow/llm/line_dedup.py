"""Line dedup: Bloom filters for once-seen and twice-seen line hashes, exact confirmation of suspected repeats only.

1. Tasks reduce their lines to distinct hashes with a local count. Hashes are dealt by filter segment; the task of a
   segment streams them through two Bloom filters of fixed size: a hash that the once-filter knows already, or that a
   task has seen in several documents, is set in the twice-filter.
2. The segments of the twice-filter, ``SEGMENTS * SEGMENT_BYTES`` bytes however long the corpus, go to all tasks. Only
   lines it knows are shuffled, as 128-bit digests: documents per line are counted exactly, and the first occurrence
   is found.
3. Lines confirmed as frequent are removed. Their list goes to all tasks where counting shows it is short; a longer
   one is joined by digest with the suspected lines, and the line numbers found go back to their documents.

A filter that fills up on a very large corpus suspects more lines, which then shuffle; the result stays exact.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import BROADCAST_ROWS, staged

#: 64 segments of 256 KB: with four bits a line, about one false suspect in a hundred at 13 million distinct lines.
SEGMENTS, SEGMENT_BYTES, PROBES = 64, 1 << 18, 4
LEAST_CHARS, LEAST_DOCUMENTS = 1, 10


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z lower-cased; bytes methods know ASCII alone."""
    return line.strip(b" \t\n\v\f\r").lower()


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode("utf-8", "surrogatepass")) >= least)


def _lines(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def _document_digests(text: bytes | None, least: int) -> set[bytes]:
    return {digest(k) for k in set(map(line_key, _lines(text))) if _long_enough(k, least)}


def _segment(digests: np.ndarray) -> np.ndarray:
    return (digests[:, 0] & np.uint64(SEGMENTS - 1)).astype(np.int64)


class Bloom:
    """One segment of one filter."""

    def __init__(self, stored: bytes | int):
        self.bits = np.zeros(stored, dtype=np.uint8) if isinstance(stored, int) else np.frombuffer(stored, dtype=np.uint8)

    def positions(self, digests: np.ndarray) -> np.ndarray:
        """Bit numbers, PROBES per digest; digests as rows of two 64-bit words."""
        steps = np.arange(PROBES, dtype=np.uint64)
        return ((digests[:, :1] >> np.uint64(6)) + steps * (digests[:, 1:] | np.uint64(1))) % np.uint64(8 * len(self.bits))

    def has(self, at: np.ndarray) -> np.ndarray:
        return ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)

    def add(self, at: np.ndarray) -> None:
        flat = at.ravel()
        np.bitwise_or.at(self.bits, flat >> np.uint64(3), np.uint8(1) << (flat & np.uint64(7)).astype(np.uint8))


def _as_words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)


def _local(least: int):
    """Task side: distinct digests of each batch with their number of documents, as one block per segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[bytes] = Counter()
            for text in batch.column(0).cast(pa.large_binary()).to_pylist():
                seen.update(_document_digests(text, least))
            if not seen:
                continue
            words, many = _as_words(list(seen)), np.fromiter((n > 1 for n in seen.values()), dtype=np.uint8, count=len(seen))
            home = _segment(words)
            order = np.argsort(home, kind="stable")
            words, many, home = words[order], many[order], home[order]
            cuts = np.flatnonzero(np.diff(home, prepend=-1))
            ends = np.append(cuts[1:], len(home))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(home[cuts], pa.int32()), pa.array([words[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                    pa.array([many[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                ],
                names=["segment", "digests", "many"],
            )

    return run


def _filtered(size: int):
    """Task side: the twice-filter of each segment that the task was dealt. Holds two filters per segment, no lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[Bloom, Bloom]] = {}
        for batch in batches:
            for segment, block, flags in zip(*(c.to_pylist() for c in batch.columns)):
                once, twice = filters.setdefault(segment, (Bloom(size), Bloom(size)))
                at = once.positions(np.frombuffer(block, dtype=np.uint64).reshape(-1, 2))
                again = once.has(at) | np.frombuffer(flags, dtype=bool)
                twice.add(at[again])
                once.add(at)  # digests of one block are distinct
        if filters:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(filters), pa.int32()), pa.array([t.bits.tobytes() for _, t in filters.values()], pa.binary())], names=["segment", "twice"]
            )

    return run


def twice_filter(docs: DataFrame, text_col: str = "text", least_chars: int = LEAST_CHARS, segment_bytes: int = SEGMENT_BYTES) -> dict[int, bytes]:
    """The segments of the filter of lines that may occur in two documents or more; of fixed total size."""
    spark = docs.sparkSession
    blocks = docs.select(F.col(f"`{text_col}`").alias("_text")).mapInArrow(_local(least_chars), "segment int, digests binary, many binary")
    dealt = blocks.repartition(min(SEGMENTS, int(spark.conf.get("spark.sql.shuffle.partitions"))), "segment")
    segments = dealt.mapInArrow(_filtered(segment_bytes), "segment int, twice binary")
    return {r["segment"]: bytes(r["twice"]) for r in staged(segments, "lines-twice").collect()}


def _suspects(shipped, least: int):
    """Task side: digest, id and first line number of each suspected line, once per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {k: Bloom(v) for k, v in shipped.value.items()}
        for batch in batches:
            rows, numbers, found = [], [], []
            for row, text in enumerate(batch.column(1).cast(pa.large_binary()).to_pylist()):
                for number, line in enumerate(_lines(text)):
                    key = line_key(line)
                    if _long_enough(key, least):
                        rows.append(row)
                        numbers.append(number)
                        found.append(digest(key))
            if not found:
                continue
            words = _as_words(found)
            home = _segment(words)
            hit = np.zeros(len(found), dtype=bool)
            for segment in np.unique(home).tolist():
                if segment in filters:
                    mine = home == segment
                    hit[mine] = filters[segment].has(filters[segment].positions(words[mine]))
            picked = np.flatnonzero(hit)
            first: dict[tuple[int, bytes], int] = {}
            for i in picked.tolist():
                first.setdefault((rows[i], found[i]), numbers[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([r for r, _ in first], pa.int64())), pa.array(list(first.values()), pa.int32()), pa.array([d for _, d in first], pa.binary())],
                names=["_id", "line", "digest"],
            )

    return run


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS,
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """(digest, documents, first_id, first_line) of each key found in at least ``least_documents`` documents, exactly.

    A hot line is one row per task after partial aggregation.
    """
    narrow = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    kind = narrow.schema[0].dataType.simpleString()
    shipped = docs.sparkSession.sparkContext.broadcast(twice_filter(docs, text_col, least_chars, segment_bytes))
    suspected = narrow.mapInArrow(_suspects(shipped, least_chars), f"_id {kind}, line int, digest binary")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("line")))
    counted = suspected.groupBy("digest").agg(F.count(F.lit(1)).alias("documents"), first.alias("_first"))
    return counted.where(F.col("documents") >= least_documents).select("digest", "documents", F.col("_first.id").alias("first_id"), F.col("_first.line").alias("first_line"))


def _cut(shipped, least: int, keep_first: bool):
    """Task side: line counts and the text that stays, lines in the shipped list dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent: dict[bytes, tuple] = shipped.value
        for batch in batches:
            counts, dropped, kept = [], [], []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                lines = _lines(text)
                stay = []
                for number, line in enumerate(lines):
                    key = line_key(line)
                    home = frequent.get(digest(key)) if _long_enough(key, least) else None
                    if home is None or keep_first and home == (ident, number):
                        stay.append(line)
                counts.append(len(lines))
                dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["_id", "n_lines", "n_dropped", "kept_text"],
            )

    return run


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS,
    keep_first: bool = False, most_shipped: int = BROADCAST_ROWS, segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) for every row.

    Texts split at \\n; null and empty texts are one empty line. Keys of at least ``least_chars`` code points that
    occur in at least ``least_documents`` rows lose all their lines everywhere, or all but the first occurrence
    (smallest id, then line) with ``keep_first``. The empty key is never dropped. Repeated rows count as documents
    of their own. Other columns are not looked at. An empty table gives no rows.
    """
    found = staged(repeated_lines(docs, id_col, text_col, least_chars, least_documents, segment_bytes), "lines-frequent")
    if found.limit(most_shipped + 1).count() > most_shipped:
        return _joined(docs, found, id_col, text_col, least_chars, keep_first)
    frequent = {bytes(r["digest"]): (r["first_id"], r["first_line"]) for r in found.collect()}  # at most most_shipped rows
    shipped = docs.sparkSession.sparkContext.broadcast(frequent)
    narrow = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    kind = narrow.schema[0].dataType.simpleString()
    out = narrow.mapInArrow(_cut(shipped, least_chars, keep_first), f"_id {kind}, n_lines long, n_dropped long, kept_text string")
    return out.withColumnRenamed("_id", id_col)


def _joined(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, least: int, keep_first: bool) -> DataFrame:
    """The same where the list of frequent lines is too long to ship: lines meet it in a shuffle join by digest."""
    rows = staged(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.expr("uuid()").alias("_row")), "lines-rows")
    kind = rows.schema[0].dataType.simpleString()

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, digests = [], [], []
            for row, text in enumerate(batch.column(2).cast(pa.large_binary()).to_pylist()):
                for number, line in enumerate(_lines(text)):
                    key = line_key(line)
                    if _long_enough(key, least):
                        at.append(row)
                        numbers.append(number)
                        digests.append(digest(key))
            took = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(took), batch.column(1).take(took), pa.array(numbers, pa.int32()), pa.array(digests, pa.binary())], names=["_row", "_id", "line", "digest"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, dropped, kept = [], [], []
            for text, gone in zip(batch.column(1).cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist()):
                lines, out = _lines(text), set(gone or ())
                counts.append(len(lines))
                dropped.append(len(out))
                kept.append(b"\n".join([x for n, x in enumerate(lines) if n not in out]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["_id", "n_lines", "n_dropped", "kept_text"],
            )

    lines = rows.select("_row", "_id", "_text").mapInArrow(explode, f"_row string, _id {kind}, line int, digest binary")
    hit = lines.join(found, "digest")
    if keep_first:
        hit = hit.where(~(F.col("_id").eqNullSafe(F.col("first_id")) & (F.col("line") == F.col("first_line"))))
    gone = hit.groupBy("_row").agg(F.collect_list("line").alias("_gone"))  # bounded by the lines of one document
    whole = rows.join(gone, "_row", "left").select("_id", "_text", "_gone")
    return whole.mapInArrow(cut, f"_id {kind}, n_lines long, n_dropped long, kept_text string").withColumnRenamed("_id", id_col)
