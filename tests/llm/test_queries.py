"""Registered queries: columns and row counts on the small tables, and SQL where there is some."""

import os

import pytest

from comparing import connect, difference
from tallyflow.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# The columns each query returns first, with their types
COLUMNS = {
    "op1_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op2_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op3_quality_rules": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op4_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op5_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op6_near_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7_pii": {"doc_id": "bigint", "text": "string", "n_email": "bigint", "n_ip": "bigint", "n_phone": "bigint", "n_card": "bigint", "n_person": "bigint"},
    "op8_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op9_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op10_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op11_turn_repair": {
        "conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint",
        "cost": "bigint", "audit": "string", "repaired_sha256": "string",
    },
    "op12_prefix_trie": {
        "conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint",
        "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string",
    },
    "op13_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


#: Queries with a row for each id of another table than documents; the trie has nodes, compared with its SQL below.
KEYS = {"op2_url_filter": ("pages", "page_id"), "op11_turn_repair": ("conversations", "conv_id")}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    out = QUERIES[name](spark, SF_DIR)
    assert COLUMNS[name].items() <= dict(out.dtypes).items()
    if name == "op12_prefix_trie":
        return
    table, key = KEYS.get(name, ("documents", "doc_id"))
    given = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key)
    ids = sorted(r[0] for r in (given.distinct() if table == "conversations" else given).collect())
    assert sorted(r[0] for r in out.select(key).collect()) == ids


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None
