import re
from collections import Counter

import pytest

from tallyflow.llm import quality

GOOD = "the river runs past the old mill and the children play there every summer evening with their friends near the tall green trees while boats go by"
TEXTS = [
    None, "", " \n\t ", "one", "a b c a b c", "And " * 60, "x y z\nx y z\n\n \nX y z\nx y z", "a b a b a b a b", "## $$ %% <a> | b & c*",
    " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i % 31}" for i in range(400)), "ü é\x0b ñ\x1c x\u00a0y", "p q r s " * 20 + "t u v",
    " ".join(f"v{i}" for i in range(30_000)),
]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def test_base_counts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4]), (4, TEXTS[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words", "2 AS _text", "3 AS bin")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.judge(docs, labels)
    got = sorted((tuple(r) for r in out.select("doc_id", *quality.COUNTS, "base_failed").collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert all(r.kept == (not r.base_failed) for r in out.collect())


@pytest.fixture(scope="module")
def corpus(spark):
    words = GOOD.split()
    turn = lambda i: " ".join(words[(i * 7 + k * (1 + i % 5)) % len(words)] for k in range(60 + i % 20))
    good = [(i, turn(i)) for i in range(240)]
    bad = [(1000 + i, " ".join(w + "@#%"[k % 3] * 3 for k, w in enumerate(turn(i).split()))) for i in range(40)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(200)] + [(1000 + i, 0) for i in range(20)] + [(3, 1)], "doc_id long, quality int")
    return docs, labels


def test_unlike_trusted_text_goes_and_clean_text_stays(corpus):
    kept = {r.doc_id: r.kept for r in quality.judge(*corpus).collect()}
    failed = {r.doc_id for r in quality.judge(*corpus).where("base_failed").collect()}
    assert all(kept[i] for i in range(240) if i not in failed)
    assert not any(kept[i] for i in range(1000, 1040))


def test_runs_agree(corpus):
    docs, labels = corpus
    one = {tuple(r) for r in quality.judge(docs, labels).collect()}
    assert one == {tuple(r) for r in quality.judge(docs.repartition(7), labels).collect()}


def test_ratio_by_hand(spark, corpus):
    import math

    docs, labels = corpus
    good = quality.trusted(labels)
    fitted = {r._id for r in good.where("NOT _held").collect()}
    model = {r.bin: r.ratio for r in quality.fit(docs, good, bins=64, prior=10.0).collect()}
    raw, target = Counter(), Counter()
    bins = docs.select("doc_id", quality.let(quality.words(docs.text), lambda w: quality.grams(w, 64)).alias("g")).collect()
    for r in bins:
        raw.update(r.g)
        if r.doc_id in fitted:
            target.update(r.g)
    n, m = sum(raw.values()), sum(target.values())
    for b, c in raw.items():
        assert model[b] == pytest.approx(quality.UNIT * math.log((target[b] + 10 * c / n) / (m + 10) / (c / n)), abs=1)


def test_all_labels_are_learned_from(spark):
    """More labels than the 50,000 that were taken before."""
    labels = spark.range(60_000).selectExpr("id AS doc_id", "1 AS quality")
    good = quality.trusted(labels)
    assert good.count() == 60_000
    assert 14_000 < good.where("_held").count() < 16_000


def test_a_long_list_of_labels_gives_the_same(corpus, monkeypatch):
    """Joined by shuffle instead of broadcast."""
    short = {tuple(r) for r in quality.judge(*corpus).collect()}
    monkeypatch.setattr(quality, "list_side", lambda keys: keys)
    assert {tuple(r) for r in quality.judge(*corpus).collect()} == short


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.judge(empty, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
