"""Secret scan: fixed patterns, and strings that pass for random under a battery of tests.

A candidate is a run of at least ``LEAST`` characters of an encoding. Its encoding gives the alphabet; chi-squared
uniformity over the alphabet, a runs test about the alphabet's middle and the lag-1 serial correlation must all be
as expected from random characters. The odds of the string being random rather than text (an e-value, which grows
with length) then enter an e-value Benjamini-Hochberg step over all candidates of the corpus, which holds the
share of false discoveries at ``FALSE_SHARE``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import let, staged

# Kinds in order, their patterns (each letter of ASSIGN in either case), and the shortest match kept
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

LEAST = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
FALSE_SHARE = 0.01
#: Two-sided normal bound of each test: with three tests a random string fails about once in two hundred.
BOUND = 3.1
#: Share of each class among the characters of ordinary text, and the number of characters in it.
TEXT_CLASSES = (("[a-z]", 0.94, 26), ("[A-Z]", 0.03, 26), ("[0-9]", 0.02, 10), ("[+/_=-]", 0.01, 5))
#: Letters and digits alone are an encoding of their own from this length: 95 of 100 base64 strings then hold a sign.
#: Shorter ones fit the alphabet of all, whose chi-squared is then off by less than 0.7 standard deviations.
SURE = 96
#: Inferred encodings, the first that fits: pattern and alphabet in index order.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    (r"\A[0-9a-f]+\z", DIGITS + "abcdef"), (r"\A[0-9A-F]+\z", DIGITS + "ABCDEF"), (r"\A[A-Z2-7]+\z", UPPER + "234567"),
    (r"\A[0-9a-z]+\z", DIGITS + LOWER), (r"\A[0-9A-Z]+\z", DIGITS + UPPER), (rf"\A[0-9A-Za-z]{{{SURE},}}\z", UPPER + LOWER + DIGITS),
    (r"\A(?=.*[+/])[A-Za-z0-9+/]+\z", UPPER + LOWER + DIGITS + "+/"), (r"\A(?=.*[_-])[A-Za-z0-9_-]+\z", UPPER + LOWER + DIGITS + "-_"),
    (r"\A.+\z", UPPER + LOWER + DIGITS + "+/-_="),
)
#: Not part of the encoding: a name and "=" before at least LEAST characters, and padding.
AROUND = rf"\A[^=]*=+(?=[^=]{{{LEAST},}}=*\z)|=+\z"
E_BINS = 512


def running_sum(values: Column) -> Column:
    """Inclusive running sums of an array of integers by adding at doubling distances: n values take n log n steps."""
    rounds = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)).cast("double"))).cast("int")

    def step(held: Column, k: Column) -> Column:
        bound = F.struct(held.alias("held"), F.pow(F.lit(2.0), k).cast("int").alias("back"))
        return let(bound, lambda t: F.transform(t["held"], lambda x, i: x + F.coalesce(F.get(t["held"], i - t["back"]), F.lit(0))))

    return F.aggregate(F.sequence(F.lit(0), rounds), values, step)


def found(text: Column, pattern: str) -> Column:
    """(start, end, match) of all leftmost non-overlapping matches of at least one character, in code points.

    The pieces between matches and the matches themselves alternate; running sums of their lengths give the positions.
    """
    empty = F.expr("cast(array() as array<struct<start:int,end:int,match:string>>)")

    def placed(p: Column) -> Column:
        ends = running_sum(F.transform(p, lambda x: F.char_length(x["piece"]) + F.char_length(x["match"])))
        return F.zip_with(p, ends, lambda x, end: F.struct((end - F.char_length(x["match"])).alias("start"), end.alias("end"), x["match"].alias("match")))

    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.filter(F.zip_with(pieces, matches, lambda p, m: F.struct(p.alias("piece"), m.alias("match"))), lambda x: x["match"].isNotNull())
    return F.when(text.rlike(pattern), let(pairs, placed)).otherwise(empty)


def overlaps(spans: Column, base: Column) -> Column:
    """For each of ``spans``, which are in order and apart, whether a ``base`` span shares a character with it.

    That is so when more base spans start before its end than end by its start. Both counts are running sums over
    the sorted positions of either side.
    """

    def before(of_base: str, of_span: str, ties: bool) -> Column:
        place = lambda side, name, mark, rank: F.transform(side, lambda x: F.struct(x[name].alias("at"), F.lit(rank).alias("rank"), F.lit(mark).alias("base")))
        both = F.sort_array(F.concat(place(base, of_base, 1, 0 if ties else 2), place(spans, of_span, 0, 1)))

        def counted(events: Column) -> Column:
            sums = running_sum(F.transform(events, lambda x: x["base"]))
            return F.filter(F.zip_with(events, sums, lambda x, n: F.when(x["base"] == 0, n)), lambda n: n.isNotNull())

        return let(both, counted)

    return F.zip_with(before("start", "end", False), before("end", "start", True), lambda opened, closed: opened > closed)


def base_spans(text: Column) -> Column:
    """Spans (start, kind number, end) of the three fixed patterns, in order of start and kind.

    For hex and access keys a run of the class that is too short has no longer match inside it, so the length can
    stand in the pattern. For assignments the whole match is taken first and judged afterwards.
    """
    assign = F.filter(found(text, ASSIGN), lambda x: F.char_length(F.regexp_extract(x["match"], ASSIGN, 2)) >= ASSIGN_LEAST)
    access = found(text, ACCESS[:-1] + f"{{{ACCESS_LEAST - 4},}}")
    hexes = found(text, HEX[:-1] + f"{{{HEX_LEAST},}}")
    kind = lambda spans, n: F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(n).alias("kind"), x["end"].alias("end")))
    return F.sort_array(F.concat(kind(assign, 0), kind(access, 1), kind(hexes, 2)))


def _kept_chars(token: Column, what: str) -> Column:
    return F.char_length(F.regexp_replace(token, what.replace("[", "[^", 1) + "+", ""))


def body(token: Column) -> Column:
    """What is tested of a candidate: without a name before it and without padding."""
    return F.regexp_replace(token, AROUND, "")


def _pick(token: Column, of) -> Column:
    out = of(ENCODINGS[-1][1])
    for pattern, alphabet in reversed(ENCODINGS[:-1]):
        out = F.when(token.rlike(pattern), of(alphabet)).otherwise(out)
    return out


def log2_odds(token: Column) -> Column:
    """log2 of the odds that characters are uniform over the inferred alphabet rather than drawn from text classes."""
    bits = sum(((_kept_chars(token, p) * F.lit(math.log2(size / share))) for p, share, size in TEXT_CLASSES), F.lit(0.0))
    return bits - F.char_length(token) * _pick(token, lambda a: F.lit(math.log2(len(a))))


def passes_battery(token: Column, bound: float = BOUND) -> Column:
    """Whether uniformity, runs and serial correlation all lie within ``bound`` standard deviations of random."""

    def of(alphabet: str) -> Column:
        k = len(alphabet)
        index = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double"))
        return let(F.filter(index, lambda x: x > 0), lambda v: _tests(v, k, bound))

    return _pick(token, of)


def _tests(v: Column, k: int, bound: float) -> Column:
    n = F.size(v).cast("double")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    squares = total(F.transform(F.array_distinct(v), lambda x: F.pow(F.size(F.filter(v, lambda y: y == x)).cast("double"), 2.0)))
    chi = (squares * k / n - n - (k - 1)) / F.sqrt(2.0 * (k - 1) * (n - 1) / n)
    mean = (k + 1) / 2
    # the number of changes of side about the middle is binomial for random characters; for odd k the middle counts as upper side
    side = lambda x: (x >= mean).cast("int")
    p = 2.0 * (k // 2) * (k - k // 2) / k**2
    changes = total(F.transform(v, lambda x, i: F.when((i > 0) & (side(x) != side(F.get(v, i - 1))), 1.0).otherwise(0.0)))
    runs = (changes - (n - 1) * p) / F.sqrt((n - 1) * p * (1 - p))
    variance = (k * k - 1) / 12
    products = total(F.transform(v, lambda x, i: F.when(i > 0, (x - mean) * (F.get(v, i - 1) - mean)).otherwise(0.0)))
    serial = products / variance / F.sqrt(n - 1)
    return (F.abs(chi) <= bound) & (F.abs(runs) <= bound) & (F.abs(serial) <= bound)


def candidates(text: Column, base: Column) -> Column:
    """How many strings lie apart from ``base`` spans, and (start, end, odds) of those likelier random than text that pass the tests."""

    def rated(x: Column) -> Column:
        return let(body(x["match"]), lambda t: F.struct(x["start"].alias("start"), x["end"].alias("end"), log2_odds(t).alias("odds"), t.alias("match")))

    def judged(spans: Column) -> Column:
        free = F.filter(F.zip_with(spans, overlaps(spans, base), lambda x, met: F.when(~met, x)), lambda x: x.isNotNull())
        return let(free, chosen)

    def chosen(free: Column) -> Column:
        likely = F.filter(F.transform(free, rated), lambda x: (x["odds"] > 0) & passes_battery(x["match"]))
        kept = F.transform(likely, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["odds"].alias("odds")))
        return F.struct(F.size(free).alias("tested"), kept.alias("likely"))

    return let(found(text, CANDIDATE), judged)


def discovery_bound(scanned: DataFrame, false_share: float) -> float:
    """Smallest log2 e-value t such that m / (false_share * number with at least t) <= 2**t: the e-BH step in whole bits.

    ``m`` counts every candidate tested. The histogram has at most ``E_BINS`` rows, whatever the corpus.
    """
    tested = scanned.agg(F.sum("_found.tested")).first()[0] or 0
    bins = scanned.select(F.explode("_found.likely").alias("x")).groupBy(F.least(F.lit(E_BINS), F.floor("x.odds")).alias("bits")).count()
    counts = {int(r["bits"]): r["count"] for r in bins.collect()}
    number = 0
    best = math.inf
    for bits in sorted(counts, reverse=True):
        number += counts[bits]
        if tested <= false_share * number * 2.0**bits:
            best = float(bits)
    return best


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_spans, spans) per row; spans are arrays of (start, kind number, end).

    Positions are code points, ends exclusive, whole matches. Null text is empty and has no spans. Repeated rows
    are scanned one by one, and each counts as a test of its own. Other columns are not looked at. An empty table
    gives no rows. Texts are read once and nothing is shuffled but the histogram.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    body = lambda base: F.struct(base.alias("base"), candidates(F.col("_text"), base).alias("found"))
    rows = rows.select("_id", let(base_spans(F.col("_text")), body).alias("_all")).select("_id", F.col("_all.base").alias("_base"), F.col("_all.found").alias("_found"))
    scanned = staged(rows, "secrets")
    least = discovery_bound(scanned, false_share)
    extra = F.transform(F.filter("_found.likely", lambda x: F.floor(x["odds"]) >= F.lit(least)), lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")))
    count = lambda n: F.size(F.filter("_base", lambda x: x["kind"] == n)).cast("long")
    return scanned.select(
        F.col("_id").alias(id_col), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.col("_base").alias("base_spans"), F.sort_array(F.concat("_base", extra)).alias("spans"),
    )


def written(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
