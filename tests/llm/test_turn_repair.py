"""Turn repair against a plain search over all edits, in pieces of any size."""

import hashlib
import heapq
import random

import pytest

from tallyflow.llm import turn_repair
from tallyflow.llm.queries import damaged_conversations
from tallyflow.llm.streams import joined_sha256

FOLLOWS = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}
WHITE = " \t\n\x0b\f\r"


def cheapest(rows):
    """(cost, audit, repaired rows) by Dijkstra over (rows done, last initial), least audit among equals."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, out
        new = "a" if last == "u" else "u"
        name = {"a": "assistant", "u": "user"}[new]
        heapq.heappush(heap, (cost + 2, audit + "I", at, new, (*out, (name, ""))))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, out))
            if fault in (None, "truncated"):
                cut = 1 if fault else 0
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", at + 1, new, (*out, (name, text))))
                if last in FOLLOWS.get((role or "")[:1], {}):
                    heapq.heappush(heap, (cost + cut, audit + "K", at + 1, role[0], (*out, (role, text))))


def expected(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired rows)}."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, hashlib.sha256((r[3] or "").encode()).hexdigest()))
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = (text or "").rstrip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append((role, text, fault))
        turns = {r[1] for r in mine} - {None}
        pairs = zip(faults, faults[1:])
        illegal = sum(((a[0] or "")[:1] + (b[0] or "")[:1]) not in ("su", "ua", "au") for a, b in pairs)
        counts = [sum(f == kind for _, _, f in faults) for kind in ("blank", "duplicate", "truncated")]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, *cheapest(faults))
    return out


def conversations(n, length, seed):
    pick = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut", "cut off ", " \n", "", None, "So. \t", "end.\x0b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User"]
    rows = []
    for conv in range(n):
        for turn in range(pick.randrange(1, length)):
            text = pick.choice(texts) if pick.random() < 0.5 else f"Text {turn}{pick.choice('.!x')}"
            rows.append((conv, None if pick.random() < 0.05 else turn + pick.randrange(3), pick.choice(roles[:5] if pick.random() < 0.8 else roles), text))
    return rows


@pytest.mark.parametrize(("bits", "length"), [(12, 12), (1, 40), (2, 90)])
def test_repair_agrees_with_a_plain_search(spark, monkeypatch, bits, length):
    monkeypatch.setattr(turn_repair, "BITS", bits)
    rows = conversations(12, length, seed=bits) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (99, None, None, None), (98, 5, "assistant", "Last.")]
    rows += [(97, 3, "user", "Twice.")] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS row", "2 AS at", "'x' AS symbols", "3 AS _conv")
    audits, repaired = turn_repair.repair(df)
    want = expected(rows)
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in audits.collect()}
    assert got == {k: v[:7] for k, v in want.items()}
    lines = {}
    for r in sorted(repaired.collect(), key=lambda r: (r.row, r.part)):
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    assert lines == {k: list(v[7]) for k, v in want.items() if v[7]}


def test_tables_are_small_and_exact_in_any_cut():
    tables = turn_repair.tables()
    assert len(tables.vectors) < 40
    pick = random.Random(7)
    for _ in range(300):
        symbols = "".join(pick.choices(turn_repair.SYMBOLS, k=pick.randrange(1, 30)))
        cut = pick.randrange(len(symbols) + 1)
        whole = tables.function(symbols)
        joined = tables.identity()
        for part in (symbols[cut:], symbols[:cut]):
            joined = tables.before(joined, tables.unpack(tables.pack(tables.function(part))))
        assert all((a == b).all() for a, b in zip(whole, joined))


def test_no_rows(spark):
    audits, repaired = turn_repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert audits.count() == 0 and repaired.count() == 0


def test_damage_by_checksum(spark):
    import zlib

    rows = [(c, t, None if t == 3 else "assistant", None if t == 2 else "A. b! c") for c in (*range(8), None) for t in (0, 1, 2, 3, None)]
    out = damaged_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, role, text in rows:
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if draw:
            text = "" if draw == 1 else "".join(x for x in text if x not in ".!?") if draw == 2 else text
            want += [(c, t, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([tuple(r)[:4] for r in out], key=key) == sorted(want, key=key)


def test_digest_of_ordered_groups(spark):
    rows = [(g, i, f"v{i}" if i % 3 else None) for g in (1, 2, None) for i in range(50 if g else 3)]
    df = spark.createDataFrame(rows, "g long, i long, v string").repartition(7)
    got = {r.g: r.d for r in joined_sha256(df, ["g"], ["i"], "v", "|", "d").collect()}
    assert got == {g: hashlib.sha256("|".join(v or "" for h, _, v in rows if h == g).encode()).hexdigest() for g in (1, 2, None)}
