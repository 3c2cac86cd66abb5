import hashlib
import re

from pyspark.sql import functions as F

from tallyflow.llm.exact_dedup import exact_dedup, exact_groups, normalised

ROWS = [
    (5, "a b c"), (3, "abc"), (4, "a  b  c"), (9, "a\tb\nc "), (7, None), (6, ""), (8, " \n"), (2, "ABC"), (11, "a b"), (12, "ab"),
    (20, "tie x"), (19, "tie y"), (21, "tie x"), (22, "x" * 50_000), (23, "x" * 50_000 + " "), (None, "tie y"), (30, "same"), (30, "same"),
]


def expected(rows):
    groups = {}
    for ident, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", text or ""), []).append((ident, text or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=str)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS _hash", "1 AS group_size", "2 AS keep_id")


def test_groups(spark):
    out = exact_groups(documents(spark, ROWS)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted((tuple(r) for r in out), key=str) == expected(ROWS)


def test_colliding_hashes_are_told_apart_by_bytes(spark):
    weak = lambda text: F.pmod(F.char_length(text), F.lit(2)).cast("string").cast("binary")
    out = exact_groups(documents(spark, ROWS), hash_fn=weak).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted((tuple(r) for r in out), key=str) == expected(ROWS)


def test_kept_rows_keep_all_columns(spark):
    out = exact_dedup(documents(spark, ROWS))
    assert out.columns == ["doc_id", "text", "_hash", "group_size", "keep_id"]
    want = sorted({(keep, norm) for _, keep, _, _, norm in expected(ROWS)}, key=str)
    got = out.select("doc_id", F.sha2(normalised(F.col("text")), 256)).collect()
    assert sorted(map(tuple, got), key=str) == want


def test_no_rows(spark):
    empty = documents(spark, [])
    assert exact_groups(empty).count() == 0 and exact_dedup(empty).count() == 0
