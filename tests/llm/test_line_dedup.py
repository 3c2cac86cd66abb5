import re
from collections import defaultdict

import numpy as np
import pytest

from tallyflow.llm import line_dedup as ld


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line))


def brute(rows, least_documents, least_chars=1, keep_first=False):
    homes = defaultdict(list)
    for i, (ident, text) in enumerate(rows):
        for n, line in enumerate((text or "").split("\n")):
            if len(key(line)) >= least_chars:
                homes[key(line)].append((ident is None, ident or 0, n, i))
    frequent = {k: min(v) for k, v in homes.items() if len({x[3] for x in v}) >= least_documents}
    out = []
    for i, (ident, text) in enumerate(rows):
        lines = (text or "").split("\n")
        stay = [x for n, x in enumerate(lines) if key(x) not in frequent or keep_first and frequent[key(x)][1:3] == (ident, n)]
        out.append((ident, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


ROWS = [
    (1, "Copyright notice\nown line one\n\nown two"), (2, "  COPYRIGHT notice\t\nother"), (3, "copyright notice"), (4, None), (5, ""), (6, "\n\n\n"),
    (7, "rare\nrare\nrare"), (8, "É line\nx"), (9, "é line\nx"), (10, "É line  \nx"), (11, "\x85copyright notice\r\nx\r"), (12, "\x1cx\n" + "y" * 200_000),
    (13, "own line\x00"), (14, "ends\n"), (15, "ends\n\n"), (16, "ends"),
]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS line", "'x' AS digest", "2 AS n_lines")


@pytest.mark.parametrize("settings", [{}, {"keep_first": True}, {"most_shipped": 0}, {"most_shipped": 0, "keep_first": True}, {"least_chars": 4}])
def test_against_brute_force(spark, settings):
    got = ld.line_dedup(documents(spark, ROWS), least_documents=3, **settings).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    want = brute(ROWS, 3, settings.get("least_chars", 1), settings.get("keep_first", False))
    assert sorted(map(tuple, got), key=str) == want


def test_repeated_rows_and_null_ids_count_as_documents(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (None, "a\nc")]
    got = ld.line_dedup(documents(spark, rows), least_documents=3).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 2, 1, "b"), (1, 2, 1, "b"), (None, 2, 1, "c")], key=str)


def test_a_full_filter_keeps_results_exact(spark):
    rows = [(i, f"line {i % 40}\nown {i}") for i in range(200)]
    got = ld.line_dedup(documents(spark, rows), least_documents=5, segment_bytes=1).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 5)


def test_twice_filter_knows_every_repeat_and_few_others(spark):
    rows = [(i, f"both {i % 500}\nown {i}") for i in range(1000)]
    stored = ld.twice_filter(documents(spark, rows))

    def known(line):
        words = ld._as_words([ld.digest(line.encode())])
        segment = int(ld._segment(words)[0])
        return segment in stored and bool(ld.Bloom(stored[segment]).has(ld.Bloom(stored[segment]).positions(words))[0])

    assert all(known(f"both {i}") for i in range(500))
    assert np.mean([known(f"own {i}") for i in range(1000)]) < 0.01


def test_no_rows(spark):
    assert ld.line_dedup(documents(spark, [])).count() == 0
