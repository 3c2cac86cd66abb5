"""The pipeline stage by stage against plain Python, each on the rows its predecessor kept."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
import tiktoken

import corpus_pipeline
from tallyflow.llm import common
from tallyflow.llm.bpe import TEXTS_AT_ONCE, read_ranks
from tallyflow.llm.common import staged
from tallyflow.llm.queries import split_pattern, vocabulary_path
from test_mixing import targets
from test_near_dedup import brute_groups

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(5000, None, None, None, None), (5001, "", "en", "src0", 0), (5002, "12 34 %", "en", "src0", 7), (5003, "12 34 %", None, None, 7)], docs.schema
    )
    seen = [staged(docs.unionByName(odd), "input")]
    for _, function in corpus_pipeline.STAGES:
        seen.append(staged(function(spark, seen[-1], SF_DIR), "stage"))
    return [s.collect() for s in seen], [s.columns for s in seen]


def test_columns(stages):
    assert all(c == stages[1][0] for c in stages[1][:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "bpe"]


def test_language_keeps_clean_documents(stages):
    before, after = stages[0][:2]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone == {r.doc_id for r in before if not any(c.isalpha() for c in r.text or "")} >= {5000, 5001, 5002, 5003}


def test_exact(stages):
    before, after = stages[0][1:3]
    groups = defaultdict(list)
    for r in before:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", r.text)].append((-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in after) == sorted(min(g)[1] for g in groups.values())


def test_near(stages):
    before, after = stages[0][2:4]
    kept = {g[0] for g in brute_groups([(r.doc_id, r.text) for r in before], 5) if g[3]}
    assert {r.doc_id for r in after} == kept


def test_mix(stages):
    before, after = stages[0][3:5]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in before}
    sources, longest, taken = Counter(), Counter(), Counter()
    for r in before:
        sources[r.source] += size[r.doc_id]
        longest[r.source] = max(longest[r.source], size[r.doc_id])
    for r in after:
        taken[r.source] += size[r.doc_id]
    for source, target in targets(sources).items():
        assert abs(taken[source] - target) <= longest[source]
    assert max(Counter(r.doc_id for r in after).values()) <= 2


def test_tokens(stages):
    before, after = stages[0][4:6]
    reference = tiktoken.Encoding("own", pat_str=split_pattern(), mergeable_ranks=read_ranks(vocabulary_path()), special_tokens={})
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    text = {r.doc_id: r.text for r in before}
    for r in after:
        assert r.ids == reference.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run(spark, stages):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert sorted((r.doc_id, r.n_tokens) for r in out.collect()) == sorted((r.doc_id, r.n_tokens) for r in stages[0][-1])


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 0")
    for _, function in corpus_pipeline.STAGES:
        docs = staged(function(spark, docs, SF_DIR), "stage")
    assert docs.count() == 0


def test_tokens_are_made_in_small_batches(spark, monkeypatch):
    setting, rows, real = "spark.sql.execution.arrow.maxRecordsPerBatch", [], common.staged
    monkeypatch.setattr(common, "staged", lambda df, name: rows.append(int(spark.conf.get(setting))) or real(df, name))
    docs, before = spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.conf.get(setting)
    assert corpus_pipeline.tokens(spark, docs, SF_DIR).count() == docs.count()
    assert rows == [TEXTS_AT_ONCE] and spark.conf.get(setting) == before
