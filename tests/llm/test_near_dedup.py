import math
import random
import re
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tallyflow.llm import near_dedup, shingles
from tallyflow.llm.near_dedup import band_keys, near_groups, signature
from tallyflow.session import shared_folder


def brute_set(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute_groups(rows, size, percent=80):
    sets = [brute_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (ident, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), ident), ident)
    return sorted((ident, len(sets[i]), least[find(i)], ident == least[find(i)]) for i, (ident, _) in enumerate(rows))


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [pick.choices(vocabulary, k=pick.choice([3, 4, 8, 60, 150])) for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for words in base[:25]:
        for _ in range(pick.randrange(1, 7)):
            copy = list(words)
            for _ in range(pick.randrange(0, max(1, len(words) // 30) + 1)):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            texts.append(" ".join(copy))
    hub = pick.choices(vocabulary, k=120)  # many copies of one text, each changed elsewhere
    for _ in range(60):
        copy = list(hub)
        for _ in range(pick.randrange(1, 5)):
            copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
        texts.append(" ".join(copy))
    passage = " ".join(pick.choices(vocabulary, k=60))  # many texts share it and little else
    texts += [passage + " " + " ".join(pick.choices(vocabulary, k=45)) for _ in range(40)]
    texts += [None, "", " \n\t", "Hello", "hello", "A b C d", "a B c D ", "one two three", texts[3].upper(), texts[3], "x " * 40_000, "long " + "x " * 40_000]
    ids = list(range(1000, 1000 + len(texts)))
    pick.shuffle(ids)
    return list(zip(ids, texts))


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _node", "'x' AS component_id")


@pytest.mark.parametrize("size", [4, 5])
def test_groups_against_all_pairs(spark, rows, size):
    got = sorted(tuple(r) for r in near_groups(documents(spark, rows), size=size).collect())
    assert got == brute_groups(rows, size)


def test_repeated_rows_and_null_ids(spark):
    got = near_groups(documents(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None)])).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)], key=str
    )


def test_kept_rows(spark, rows):
    out = near_dedup.near_dedup(documents(spark, rows), size=4)
    assert out.columns == ["doc_id", "text", "_node", "component_id"]
    assert sorted(r.doc_id for r in out.collect()) == [g[0] for g in brute_groups(rows, 4) if g[3]]


def test_no_rows(spark):
    assert near_groups(documents(spark, [])).count() == 0


def test_sets_do_not_depend_on_chunks(monkeypatch, rows):
    texts = pa.array([t for _, t in rows])
    whole = [s.tobytes() for s in shingles.shingle_sets(texts, 4)]
    assert [len(s) // 8 for s in whole] == [len(brute_set(t, 4)) for _, t in rows]
    monkeypatch.setattr(shingles, "CHUNK", 64)
    assert [s.tobytes() for s in shingles.shingle_sets(texts, 4)] == whole
    sliced = [s.tobytes() for s in shingles.shingle_sets(texts.slice(17), 4)]
    assert sliced == whole[17:]


def test_signature_agreement_estimates_similarity():
    pick = np.random.default_rng(3)
    for size, overlap in ((12, 9), (400, 320), (5000, 2500)):
        agree = []
        for _ in range(30):
            pool = np.unique(pick.integers(0, 2**64, 2 * size, dtype=np.uint64))[:2 * size - overlap]
            pick.shuffle(pool)
            one, two = np.sort(pool[:size]), np.sort(pool[size - overlap:])
            agree.append(np.mean(signature(one, 128) == signature(two, 128)))
        assert np.mean(agree) == pytest.approx(overlap / (2 * size - overlap), abs=0.08)
    assert len(set(band_keys(signature(one, 128), 32, 4).tolist())) == 32


def template_families(seed):
    """Members of a family are 0.73 alike, its two special ones 0.81, give or take: few link, and all share the template's bands."""
    pick, rows = random.Random(seed), []
    for family in range(3):
        template = [f"t{family}x{i}" for i in range(1000)]
        for member in range(150):
            words = list(template)
            for at in pick.sample(range(1000), 10 if member < 2 else 16):
                words[at] = f"own{family}x{member}x{at}"
            rows.append((1000 * family + member, " ".join(words)))
    return rows


def test_pairs_in_crowded_buckets_without_a_link(spark):
    rows = template_families(2)
    want = brute_groups(rows, 5)
    assert {1, 1001, 2001} <= {g[0] for g in want if not g[3]}
    assert sorted(tuple(r) for r in near_groups(documents(spark, rows)).collect()) == want


def crowded_pairs(seed):
    """400 texts of one template, 0.74 alike; 60 of them have a partner at 0.81, no more central than the others."""
    pick, rows = random.Random(seed), []
    template = [f"t{i}" for i in range(1000)]
    for member in range(340):
        words = list(template)
        changed = pick.sample(range(1000), 16)
        for at in changed:
            words[at] = f"own{member}x{at}"
        rows.append((member, " ".join(words)))
        if member < 60:
            for at in pick.sample(changed, 10):  # shares six changes with its partner
                words[at] = f"mate{member}x{at}"
            for at in pick.sample(sorted(set(range(1000)) - set(changed)), 11):
                words[at] = f"mate{member}x{at}"
            rows.append((1000 + member, " ".join(words)))
    return rows


def test_recall_in_a_crowd(spark):
    rows = crowded_pairs(3)
    want = {g[0]: g[2] for g in brute_groups(rows, 5)}
    got = {r.doc_id: r.component_id for r in near_groups(documents(spark, rows)).collect()}
    linked = [i for i, c in want.items() if i != c]
    assert len(linked) > 20
    assert all(want[i] == want[got[i]] for i in want)  # no link that is none
    assert sum(got[i] == want[i] for i in linked) >= 0.9 * len(linked)


def test_a_crowd_gives_rows_in_proportion(spark, monkeypatch):
    seen = []
    confirm = near_dedup.confirm
    monkeypatch.setattr(near_dedup, "confirm", lambda pairs, *rest: seen.append(pairs.count()) or confirm(pairs, *rest))
    rows = crowded_pairs(4)
    for some in (rows[:100], rows):
        near_groups(documents(spark, some)).count()
    # 400 texts have 79,800 pairs
    assert seen[0] + seen[1] <= 100 * 100 and seen[2] + seen[3] <= 400 * 100


def test_dropping_goes_by_row(spark):
    a, b = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen"
    c, d = " ".join(f"c{i}" for i in range(60)), " ".join(f"d{i}" for i in range(9))
    near_c = c + " more"
    rows = [(1, a), (None, a), (None, b), (2, c), (7, near_c), (7, d), (7, d), (None, None), (None, " ")]
    out = near_dedup.near_dedup(documents(spark, rows).selectExpr("*", "3 AS _gone", "4 AS _doc", "5 AS _row", "6 AS _ident"))
    assert out.columns == ["doc_id", "text", "_node", "component_id", "_gone", "_doc", "_row", "_ident"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([tuple(r)[:2] for r in out.collect()], key=key) == sorted([(1, a), (None, b), (2, c), (7, d), (None, None), (None, " ")], key=key)


def test_all_ids_null(spark):
    rows = [(None, t) for t in ("a b c d e f", "A b c d e f", "g h i j k l", None)]
    out = near_dedup.near_dedup(documents(spark, rows)).collect()
    assert sorted((r.text or "").lower() for r in out) == ["", "a b c d e f", "g h i j k l"]


def test_sketch_cut_is_the_exact_tail():
    cut = near_dedup.least_agreement(128, 80)
    for n in (20, 40, 64, 128):
        tail = lambda k, n=n: sum(Fraction(math.comb(n, i) * 4**i, 5**n) for i in range(k))
        assert tail(round(cut[n] * n)) <= Fraction(1, 10**9) < tail(round(cut[n] * n) + 1)
    sketches = np.zeros((2, 128), dtype=np.uint8)
    other = sketches.copy()
    other[0, int(128 * (0.8 - 5.5 * (0.16 / 128) ** 0.5)):], other[1] = 1, 1
    assert near_dedup._open(sketches, other, np.array([10**6, 10**6]), 80).tolist() == [True, False]


def test_full_sets_of_open_pairs_only_and_no_tables_left(spark, rows, monkeypatch):
    made = {}
    for name in ("staged", "staged_in_batches"):
        def seen(df, table, *rest, stage=getattr(near_dedup, name)):
            out = stage(df, table, *rest)
            made.setdefault(table, []).append([tuple(r) for r in out.select(*{"near-open": "ab", "near-sets": ["_node"]}[table]).collect()] if table in ("near-open", "near-sets") else out)
            return out
        monkeypatch.setattr(near_dedup, name, seen)
    shared = Path(shared_folder(spark))
    before = set(shared.iterdir())
    near_dedup.near_dedup(documents(spark, rows)).collect()
    assert [{n for (n,) in sets} for sets in made["near-sets"]] == [{n for pair in pairs for n in pair} for pairs in made["near-open"]]
    assert {p.name.rsplit("-", 1)[0] for p in set(shared.iterdir()) - before} == {"near-rows", "near-dropped"}
