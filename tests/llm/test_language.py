import base64
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyflow.llm import language
from tallyflow.llm.language import Network, document_probabilities, identify, known_language


def test_backpropagation_through_time_against_differences():
    draw = np.random.default_rng(1)
    net = Network(3, hidden=3)
    net.weights = {k: draw.normal(0, 0.5, w.shape) for k, w in net.weights.items()}
    text = draw.integers(0, 256, (7, 5)).astype(np.uint8)
    mask = (np.arange(7)[:, None] < np.array([7, 7, 4, 1, 6])[None, :]).astype(float)
    labels = np.array([0, 1, 2, 1, 0])
    _, grads = net.gradients(text, mask, labels)
    for name, weight in net.weights.items():
        spots = [i for i in np.ndindex(weight.shape) if not name.startswith("x") or i[1] in text]
        for spot in random.Random(name).sample(spots, min(6, len(spots))):
            old = weight[spot]
            values = []
            for step in (1e-5, -1e-5):
                weight[spot] = old + step
                values.append(net.gradients(text, mask, labels)[0])
            weight[spot] = old
            assert grads[name][spot] == pytest.approx((values[0] - values[1]) / 2e-5, abs=1e-7, rel=1e-4)


def test_states_by_the_plain_formula():
    net, text = Network(2, hidden=2), np.array([[5], [200], [5]], dtype=np.uint8)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    w = {k: v.astype(float) for k, v in net.weights.items()}
    h = np.zeros((2, 1))
    for byte in (5, 200, 5):
        g, u = w["xf"][:, byte:byte + 1], w["hf"] @ h
        z, r = sigmoid(2 * (g[:2] + u[:2])), sigmoid(2 * (g[2:4] + u[2:4]))
        n = np.tanh(g[4:] + r * (u[4:] + w["cf"]))
        h = (1 - z) * n + z * h
    assert net.states(text, None, "f")[-1] == pytest.approx(h, abs=1e-5)
    assert net.states(text, None, "b")[0] == pytest.approx(net.states(text[::-1], None, "b")[0], abs=1e-5)


def test_gates_by_exponentials_also_where_they_close(monkeypatch):
    net, draw = Network(2, hidden=4), np.random.default_rng(5)
    net.weights = {k: draw.normal(0, 60 if k.startswith("x") else 1, w.shape).astype(np.float32) for k, w in net.weights.items()}
    text = draw.integers(0, 256, (9, 6)).astype(np.uint8)
    w, sigmoid, h = {k: v.astype(float) for k, v in net.weights.items()}, lambda x: 0.5 + 0.5 * np.tanh(x), np.zeros((4, 6))
    for some in text:
        g, u = w["xf"][:, some], w["hf"] @ h
        z, r = sigmoid(g[:4] + u[:4]), sigmoid(g[4:8] + u[4:8])
        h = (1 - z) * np.tanh(g[8:] + r * (u[8:] + w["cf"])) + z * h
    monkeypatch.setattr(np, "tanh", None)  # takes about twice the time of an exponential
    with np.errstate(invalid="raise", divide="raise"):
        assert net.states(text, None, "f")[-1] == pytest.approx(h, abs=1e-4)


def test_pooling_covers_whole_texts(monkeypatch):
    net = Network(3)
    texts = ["", "a", "é" * 500, "12 34", "word " * 1000, None, "x" * 64, "y" * 65]
    whole = document_probabilities(net, pa.array(texts))
    monkeypatch.setattr(language, "AT_ONCE", 3)
    assert document_probabilities(net, pa.array(texts)) == pytest.approx(whole, abs=1e-5)
    assert document_probabilities(net, pa.array(texts).slice(2)) == pytest.approx(whole[2:], abs=1e-5)
    assert whole.sum(axis=1) == pytest.approx([0, 1, 1, 0, 1, 0, 1, 1], abs=1e-5)
    tail = document_probabilities(net, pa.array(["a" * 6400 + "q" * 6400, "a" * 6400]))
    assert abs(tail[0] - tail[1]).max() > 1e-3


LETTERS = {"aa": "abcdefg", "bb": "uvwxyz", "cc": "éèàùç"}


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(2)
    out = []
    for i in range(360):
        lang = ["aa", "bb", "cc"][i % 3]
        text = " ".join("".join(pick.choices(LETTERS[lang], k=pick.randrange(2, 9))) for _ in range(pick.randrange(3, 60)))
        out.append((i, text, None if i % 17 == 0 else lang, f"src{i % 5}"))
    return out + [(900, None, "aa", None), (901, "", "aa", None), (902, "12 + 3 %%", "bb", None), (None, out[1][1], "bb", None), (1, out[1][1], "bb", None), (903, "é" * 30_000, None, None)]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "'x' AS lang_pred", "1 AS score")


def test_held_out_accuracy_and_edge_cases(spark, rows):
    got = identify(documents(spark, rows), steps=60).collect()
    assert len(got) == len(rows)
    truth = {i: ["aa", "bb", "cc"][i % 3] for i in range(360)}
    out = [r for r in got if r.held_out and r.doc_id < 360]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out]) > 0.97
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (r.doc_id in (900, 901, 902))
    assert {r.score for r in got if r.lang_pred == "und"} == {0.0}
    assert {r.lang_pred for r in got if r.doc_id in (None, 1)} == {"bb"} and [r.lang_pred for r in got if r.doc_id == 903] == ["cc"]


def test_held_out_rows_are_not_learned_from(spark, rows):
    wrong = [(i, t, "aa" if i is not None and zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in rows]
    pick = lambda df: sorted(((str(r.doc_id), r.held_out, r.lang_pred, round(r.score, 4)) for r in identify(df, steps=20).collect()))
    one, two = pick(documents(spark, wrong)), pick(documents(spark, rows).repartition(5))
    assert [r[:3] for r in one] == [r[:3] for r in two] and [r[3] for r in one] == pytest.approx([r[3] for r in two], abs=2e-4)


def test_rows_of_known_language_keep_their_columns(spark, rows):
    docs = documents(spark, rows)
    out = known_language(docs, steps=60)
    assert out.columns == docs.columns and set(docs.columns) == set(out.columns)
    assert {r.doc_id for r in out.collect()} >= set(range(360)) and not {900, 901, 902} & {r.doc_id for r in out.collect()}


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "abc", None, None)])
    assert [(r.lang_pred, r.score) for r in identify(docs).collect()] == [("und", 0.0)]
    assert identify(documents(spark, [])).count() == 0


def test_texts_of_no_language_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pick = random.Random(4)
    junk = [
        pick.randbytes(1500).hex(), base64.b64encode(pick.randbytes(1500)).decode(), "x " + " ".join(str(pick.randrange(10**6)) for _ in range(500)),
        "a,b\n" + "\n".join(f"{pick.random():.4f},{pick.random():.4f}" for _ in range(100)), " ".join(pick.randbytes(4).hex() for _ in range(200)),
    ]
    odd = spark.createDataFrame([(9000 + i, t, None, "src0", len(t)) for i, t in enumerate(junk)], docs.schema)
    stay = {r.doc_id for r in known_language(docs.unionByName(odd)).collect()}
    assert stay == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}


def test_letters_stay_where_nothing_can_be_learned(spark):
    docs = documents(spark, [(1, "abc", None, None), (2, "12", None, None), (3, None, None, None)])
    assert [r.doc_id for r in known_language(docs).collect()] == [1]


def test_all_labelled_texts_are_learned_from_whole(spark, rows, monkeypatch):
    docs = documents(spark, rows)
    monkeypatch.setattr(language, "SHARD_ROWS", 50)
    seen, stage = [], language.staged_in_batches
    monkeypatch.setattr(language, "staged_in_batches", lambda df, *rest: seen.append(stage(df, *rest)) or seen[-1])
    learn = lambda df: language.fit(df, documents=5, steps=20)[0].flat()
    one = learn(docs)
    taught = [t for i, t, lang, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 4 != 2 and lang and any(c.isalpha() for c in t or "")]
    assert sum(r.windows for r in seen[0].collect()) == sum(-(-len(t.encode()) // language.WINDOW) for t in taught)
    assert seen[0].count() > 1  # shards
    assert learn(docs.repartition(5)) == pytest.approx(one, abs=1e-5)
    # texts outside the sample of the start get other ends
    labelled = language.labelled(docs, "doc_id", "text", "lang")
    sample = language.learning_sample(labelled, language.language_counts(labelled), 5, language.SAMPLE_WINDOWS)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(2**30)).isin([draw for some in sample.values() for draw, _ in some])
    other = docs.withColumn("text", F.when(drawn | (F.octet_length("text") % language.WINDOW > 40), F.col("text")).otherwise(F.concat("text", F.lit(" qqqqqq"))))
    assert abs(learn(other) - one).max() > 1e-4


def test_passes_use_their_arrays_again():
    draw = np.random.default_rng(3)
    net, letters = Network(4), draw.integers(32, 128, (language.WINDOW, 512)).astype(np.uint8)
    mask = (np.arange(language.WINDOW)[:, None] < draw.integers(1, language.WINDOW + 1, 512)).astype(np.float32)
    labels, weight = np.arange(512) % 4, draw.uniform(0.5, 2, 512).astype(np.float32)
    passes = language.Passes(net)
    passes.gradients(letters, mask, labels, weight)
    tracemalloc.start()
    loss, grads = passes.gradients(letters, mask, labels, weight)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6e6  # a trace alone has 10 MB
    # fewer windows in between, and a changed network: as with new arrays
    part, _ = passes.gradients(letters[:, :100], mask[:, :100], labels[:100])
    assert part == net.gradients(letters[:, :100], mask[:, :100], labels[:100])[0]
    again, same = passes.gradients(letters, mask, labels, weight)
    assert again == loss and all((grads[name] == same[name]).all() for name in grads)
    net.weights["hf"] *= 0.5
    assert passes.gradients(letters, mask, labels, weight)[0] == net.gradients(letters, mask, labels, weight)[0] != loss


def test_windows_of_a_slice_hold_its_bytes_alone():
    texts = ["a" * 70, None, "", "b" * 64, "é" * 40, "c"]
    got = [(int(o), bytes(text[inside[:, i], i])) for owner, text, inside in language._windows(pa.array(["x" * 1000, *texts]).slice(1, 5)) for i, o in enumerate(owner)]
    assert got == [(0, b"a" * 64), (0, b"a" * 6), (3, b"b" * 64), (4, "é".encode() * 32), (4, "é".encode() * 8)]
