"""The prefix trie against one built in plain Python, with bands of any height."""

import hashlib
import random
import zlib

import pytest

from tallyflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    own = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.sha256((r[3] or "").encode()).hexdigest())
    for conv, _, role, text in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(conv, []).append((role or "", text or ""))
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        built[conv] = tuple(own.get(conv - int(abs(conv) % 20 * (1 if conv > 0 else -1)), [])[:h] + turns[h:])
    members = {}
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, convs in members.items():
        weight = (len(convs) - 1) * (len([w for w in node[-1][1].split() if w]) if node else 0)
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += weight
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if built[c] == node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, ())), leaves[node],
            saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: r[:2])


def conversations(n, depth, seed):
    """Families with a common start, copies of whole conversations, gaps in ids and turns."""
    pick = random.Random(seed)
    rows, earlier = [], []
    for conv in pick.sample(range(-45, 200), n):
        if earlier and pick.random() < 0.6:
            turns = list(pick.choice(earlier))
            turns = turns[:pick.randrange(1, len(turns) + 1)] + [("user", f"w {pick.randrange(9)}")] * pick.randrange(3)
        else:
            turns = [(pick.choice(["user", "assistant", None]), pick.choice(["a b", "c", "", None, "d  e f"])) for _ in range(pick.randrange(1, depth))]
        earlier.append(turns)
        rows += [(conv, None if i == 0 and pick.random() < 0.2 else 2 * i + 1, role, text) for i, (role, text) in enumerate(turns)]
    return rows


@pytest.mark.parametrize(("band", "bits", "depth"), [(16, 12, 6), (2, 1, 40), (3, 12, 30)])
def test_nodes_agree_with_a_plain_trie(spark, monkeypatch, band, bits, depth):
    monkeypatch.setattr(prefix_trie, "GROUP_BITS", bits)
    rows = conversations(40, depth, seed=band) + [(None, 1, "user", "no conversation")] + [(500, 4, "user", "same")] * 3
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "2 AS a", "3 AS part", "'x' AS digest").repartition(5)
    out = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.ranked_turns(df)), band)
    assert sorted(map(tuple, out.collect()), key=lambda r: r[:2]) == expected(rows)


def test_a_family_without_its_first_leaves_a_turnless_conversation(spark):
    short = [c for c in range(1, 60) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 2][:2]
    rows = [(c, 0, "user", "Hello there.") for c in short]
    out = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.ranked_turns(spark.createDataFrame(rows, SCHEMA)))).collect()
    digest = hashlib.sha256(",".join(map(str, sorted(short))).encode()).hexdigest()
    assert [tuple(r) for r in out] == [(min(short), 0, None, 2, 0, 1, 0, digest)]


def test_no_rows(spark):
    rows = prefix_trie.ranked_turns(spark.createDataFrame([], SCHEMA))
    assert prefix_trie.trie(prefix_trie.rebuilt(rows)).count() == 0


def test_sums_that_meet_by_accident_raise(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(prefix_trie, "_lanes", lambda: [F.col("depth").alias(n) for n in prefix_trie.LANES])
    rows = [(1, 0, "user", "a"), (2, 0, "user", "b")]
    built = prefix_trie.ranked_turns(spark.createDataFrame(rows, SCHEMA)).selectExpr("conv_id", "turn_no AS depth", "digest", "words")
    with pytest.raises(Exception, match="two paths share one sum"):
        prefix_trie.trie(built).collect()
