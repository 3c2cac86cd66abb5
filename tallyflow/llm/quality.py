"""Quality rules: base counts of a text, and a hashed n-gram log-likelihood ratio of trusted against raw text.

Word 1-grams and 2-grams are hashed into ``BINS`` bins. The raw multinomial counts every document; the trusted one
counts documents labelled good. A document's score is the mean log ratio of its n-grams. A quarter of the trusted
documents is held out of the fit; the threshold lies ``DEVIATIONS`` standard deviations below their mean score, so
it follows the language mix and the size of the corpus. Ratios are whole numbers of 2**-20, so that sums do not
depend on their order and every document falls on the same side in each run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import SPACE, let, list_side, staged, words

BINS = 2**14
#: Pseudo-counts by which the trusted model is drawn towards the raw one.
PRIOR = 500.0
UNIT = 2**20
DEVIATIONS = 6.0
LEAST_WORDS, MOST_REPEATED = 50, 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(w: Column) -> Column:
    """Words of array ``w`` that lie in a 3-word window found at least twice.

    Window hashes are sorted with their positions; equal neighbours mark repeated windows, and each marked window
    adds the words since the one before it, three at most. Time grows as n log n, whatever the text repeats.
    """
    hashes = F.when(F.size(w) < 3, F.expr("cast(array() as array<bigint>)")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    )

    def marked(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"))
        count = let(ordered, lambda s: F.aggregate(marked(s), start, step, lambda a: a["n"]))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(count)

    return let(hashes, covered)


def grams(w: Column, bins: int) -> Column:
    """Bins of the 1-grams and 2-grams of word array ``w``, repeats included."""
    single = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(bins)).cast("int"))
    pairs = F.transform(w, lambda x, i: F.pmod(F.xxhash64(x, F.coalesce(F.get(w, i + 1), F.lit(" "))), F.lit(bins)).cast("int"))
    return F.concat(single, pairs)


def _base(text: Column, w: Column) -> list[Column]:
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    return [
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"),
    ]


def measured(docs: DataFrame, text_col: str = "text", with_grams: int | None = None) -> DataFrame:
    """``_base`` struct of counts, and ``_grams`` where asked for, beside the columns of ``docs``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    body = lambda w: F.struct(*_base(text, w), *([grams(w, with_grams).alias("grams")] if with_grams else []))
    return docs.withColumn("_base", let(words(F.col(f"`{text_col}`")), body))


def trusted(labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality") -> DataFrame:
    """(_id, _held): all ids labelled good; a quarter, by hash, is held out of the model for the threshold."""
    good = labels.where(F.col(good_col) >= 1).select(F.col(f"`{id_col}`").alias("_id")).where("_id IS NOT NULL").distinct()
    return staged(good.withColumn("_held", F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(4)) == 0), "quality-trusted")


def fit(
    docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, prior: float = PRIOR
) -> DataFrame:
    """(bin, ratio): log of trusted over raw probability per bin, in units of 2**-20; at most ``bins`` rows.

    Raw counts cover all documents, trusted ones all that ``good``, the list ``trusted`` gives, does not hold out. A list
    too long to be broadcast meets the texts, not their n-grams, in a shuffle.
    """
    fitted = list_side(good.where("NOT _held").select("_id", F.lit(1).cast("long").alias("_good")))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(fitted, "_id", "left")
    rows = rows.select(F.coalesce("_good", F.lit(0).cast("long")).alias("_good"), F.explode(let(words(F.col("_text")), lambda w: grams(w, bins))).alias("bin"))
    counts = staged(rows.groupBy("bin").agg(F.count(F.lit(1)).alias("raw"), F.sum("_good").alias("good")), "quality-counts")
    raw, target = counts.agg(F.sum("raw"), F.sum("good")).first()
    share = F.col("raw") / F.lit(float(raw or 1))
    ratio = F.log((F.col("good") + F.lit(prior) * share) / F.lit(float(target or 0) + prior) / share)
    return counts.select("bin", F.round(ratio * UNIT).cast("long").alias("ratio"))


def score(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS) -> DataFrame:
    """(_id, base counts, _score) per row, the score in units of 2**-20 and 0 where there are no words.

    N-grams of one row meet on the map side before anything is shuffled.
    """
    rows = measured(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")), "_text", bins)
    rows = rows.select("_id", F.monotonically_increasing_id().alias("_row"), "_base")
    rows = rows.select("_id", "_row", *[F.col(f"_base.{c}").alias(c) for c in COUNTS], F.explode_outer("_base.grams").alias("bin"))
    sums = rows.join(F.broadcast(model), "bin", "left").groupBy("_row", "_id", *COUNTS).agg(
        F.sum(F.coalesce("ratio", F.lit(0).cast("long"))).alias("_sum"), F.count("bin").alias("_n")
    )
    mean = F.when(F.col("_n") > 0, F.floor(F.col("_sum") / F.col("_n"))).otherwise(0)
    return sums.select("_id", *COUNTS, mean.cast("long").alias("_score"))


def threshold(scored: DataFrame, good: DataFrame, deviations: float = DEVIATIONS, least_words: int = LEAST_WORDS) -> int:
    """Mean less ``deviations`` standard deviations of the held-out trusted scores; minus one unit where there are none."""
    held = scored.where(F.col("n_words") >= least_words).join(list_side(good.where("_held").select("_id")), "_id", "left_semi")
    n, total, squares = held.agg(F.count(F.lit(1)), F.sum("_score"), F.sum(F.col("_score").cast("decimal(38,0)") * F.col("_score"))).first()
    if not n:
        return -UNIT
    mean = total / n
    return round(mean - deviations * math.sqrt(max(0.0, float(squares) / n - mean * mean)))


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good_col: str = "quality", bins: int = BINS,
    prior: float = PRIOR, deviations: float = DEVIATIONS, least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED,
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept), a row per row of ``docs``.

    Null text counts as empty: no words, so ``base_failed`` and not kept; its score is 0. Without labels the target
    model is the raw one, all scores are 0 and only the base rules decide. Repeated rows and rows with a null id
    are judged one by one. Other columns are not looked at. An empty table gives no rows.
    """
    good = trusted(labels, id_col, good_col)
    scored = staged(score(docs, fit(docs, good, id_col, text_col, bins, prior), id_col, text_col, bins), "quality-scored")
    least = threshold(scored, good, deviations, least_words)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return scored.select(
        F.col("_id").alias(id_col), *COUNTS, failed.alias("base_failed"), (F.col("_score") / UNIT).alias("score"), (~failed & (F.col("_score") >= least)).alias("kept")
    )
