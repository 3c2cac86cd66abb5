import re
from collections import defaultdict

import pytest

from tallyflow.llm.mixing import mix, mixed_documents, source_targets


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Shares by weight; what goes over a cap is shared again, until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, level, done = share * sum(sizes.values()), {}, set()
    while True:
        free = [s for s in names if s not in done]
        if not free:
            return level
        level.update({s: left * weight[s] / sum(weight[f] for f in free) for s in free})
        over = [s for s in free if level[s] > most * sizes[s]]
        if not over:
            return level
        for s in over:
            level[s] = most * sizes[s]
            left -= level[s]
            done.add(s)


def rows():
    out = [(i, "w " * (1 + i * 7 % 40), ["b", "a", "c", None, "é", "z"][min(5, i % 17)]) for i in range(1200)]
    return out + [(2000, None, "a"), (2001, "", "empty"), (2002, "x " * 3000, "b"), (None, "no id", "c"), (5, out[5][1], out[5][2])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS _bucket", "3 AS weight")


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_taken_words(spark, docs):
    sizes = defaultdict(int)
    for _, text, source in rows():
        sizes[source] += words(text)
    want = targets(sizes)
    got = mix(docs).withColumnRenamed("doc_id", "id").collect()
    assert len(got) == len(rows())
    by_id = {i: (t, s) for i, t, s in rows()}
    taken, longest = defaultdict(int), defaultdict(int)
    for r in got:
        text, source = by_id[r.id]
        assert r.size == words(text) and r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies
        taken[source] += r.taken
        longest[source] = max(longest[source], r.size)
    for source, target in want.items():
        assert abs(taken[source] - target) <= longest[source] + 1e-6
    again = {(r.doc_id, r.taken) for r in mix(docs.repartition(7)).collect()}
    assert again == {(r.id, r.taken) for r in got}


def test_whole_epochs_come_first(docs):
    for r in mix(docs).collect():
        if r.source_size:
            assert int(r.target / r.source_size + 1e-9) <= r.copies <= int(r.target / r.source_size) + 1


def test_heavier_documents_are_taken_more_often(spark, docs):
    many = spark.range(6000).selectExpr("id AS doc_id", "'one two' AS text", "concat('s', id % 3) AS source")
    ratings = many.selectExpr("doc_id", "if(doc_id % 2 = 0, 4.0, 0.5) AS weight")
    taken = {True: 0, False: 0}
    for r in mix(many, ratings, share=0.4).collect():
        taken[r.doc_id % 2 == 0] += r.copies
    assert taken[True] > 1.5 * taken[False]


def test_mixed_rows_match_copies(docs):
    copies = {r.doc_id: r.copies for r in mix(docs).collect()}
    counts = defaultdict(int)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        counts[r.doc_id] += 1
    for ident, n in copies.items():
        assert counts[ident] == n * (2 if ident == 5 else 1)


def test_no_rows_and_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix(empty).count() == 0 and mixed_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


def test_targets_of_one_source(spark):
    sizes = spark.createDataFrame([("only", 10)], "source string, size long")
    assert source_targets(sizes).collect()[0].target == pytest.approx(15.0)
