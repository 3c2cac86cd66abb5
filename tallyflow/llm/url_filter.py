"""URL filter: fixed rules, and for all other urls a path-template tree with labelled purity.

Per host, path segments are read level by level. Where the children of a node vary (many, most of them rare), rare
ones become a wildcard that keeps only a file ending. Sibling templates of one shape whose bad shares differ by
less than a small effect size are pooled; a pool is rejected when its smoothed bad share is high enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import lower_ascii, staged

#: (host with subdomains, path prefix, verdict).
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
#: Levels of the tree; what lies below is one last segment.
LEVELS = 6
#: A node varies with at least this many children, when a child holds this share of its urls or less on average.
LEAST_CHILDREN, CHILD_SHARE = 8, 0.1
#: A child with more than this share, and more than this many urls, stays as it is, also below a node that varies.
COMMON_SHARE, COMMON_URLS = 0.05, 2
#: Width of a pool on the scale 2 * asin(sqrt(share)): a small effect size.
EFFECT = 0.2
#: Pseudo-counts of the smoothing, and the smoothed bad share from which a pool is rejected.
STRENGTH, REJECT = 4.0, 0.8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null and without ``://``."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    part = lambda n: F.coalesce(F.regexp_extract(url, pattern, n), F.lit(""))
    return lower_ascii(part(1)), part(2)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for domain, prefix, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(prefix)
        name, verdict = F.when(fits, F.lit(domain + prefix)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _with_level(rows: DataFrame, level: int) -> DataFrame:
    """One more segment of every template; rows that end above keep theirs."""
    segment = F.get(F.col("_segments"), F.lit(level))
    rows = rows.withColumn("_segment", segment)
    children = rows.where("_segment IS NOT NULL").groupBy("host", "template", "_segment").agg(F.sum("_urls").alias("_n"))
    nodes = children.groupBy("host", "template").agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_kinds"))
    varies = (F.col("_kinds") >= LEAST_CHILDREN) & (F.col("_all") <= F.col("_kinds") / CHILD_SHARE)
    wild = children.join(nodes, ["host", "template"]).where(varies & (F.col("_n") <= F.greatest(F.lit(COMMON_URLS), COMMON_SHARE * F.col("_all"))))
    wild = wild.select("host", "template", "_segment", F.lit(True).alias("_wild"))
    ending = F.regexp_extract(F.col("_segment"), r"(\.[A-Za-z]{1,5})\z", 1)
    shown = F.when(F.col("_wild"), F.concat(F.lit("*"), ending)).otherwise(F.col("_segment"))
    grown = rows.join(wild, ["host", "template", "_segment"], "left")
    return grown.withColumn("template", F.when(F.col("_segment").isNull(), F.col("template")).otherwise(F.concat_ws("/", "template", shown))).drop("_segment", "_wild")


def templates(paths: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(host, path, template) for distinct (host, path, _urls) rows: the tree's leaf each path falls on."""
    parts = F.split(F.regexp_replace(F.col("path"), r"\A/", ""), "/", levels)
    rows = paths.withColumn("_segments", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(parts)).withColumn("template", F.lit(""))
    deepest = rows.agg(F.max(F.size("_segments"))).first()[0] or 0
    for level in range(deepest):
        rows = staged(_with_level(rows, level), "url-level")
    return rows.drop("_segments")


def pools(leaves: DataFrame, strength: float = STRENGTH, reject: float = REJECT) -> DataFrame:
    """(host, template, purity, rejected) from (host, template, labelled, bad).

    The prior is the bad share of all labelled urls. Branches are similar when they have the same parent, the same
    shape of the last segment and fall into one effect-size bin; branches without labels form a pool of their own,
    at the prior.
    """
    labelled, bad = leaves.agg(F.sum("labelled"), F.sum("bad")).first()
    prior = (bad or 0) / labelled if labelled else 0.0
    smooth = lambda n, b: (b + F.lit(strength * prior)) / (n + F.lit(strength))
    last = F.element_at(F.split("template", "/"), -1)
    shape = F.regexp_replace(F.regexp_replace(last, r"[0-9]+", "0"), r"[A-Za-z]+", "a")
    parent = F.regexp_replace("template", r"/[^/]*\z", "")
    # siblings: same place in the tree once the segment above a wildcard is left open
    above = F.when(last.startswith("*"), F.regexp_replace(parent, r"/[^/]*\z", "")).otherwise(parent)
    angle = F.floor(2 * F.asin(F.sqrt(smooth(F.col("labelled"), F.col("bad")))) / EFFECT)
    keyed = leaves.select("*", above.alias("_above"), F.when(last.startswith("*"), last).otherwise(shape).alias("_shape"), F.when(F.col("labelled") > 0, angle).alias("_bin"))
    keys = ["host", "_above", "_shape", F.coalesce("_bin", F.lit(-1)).alias("_pool")]
    pooled = keyed.groupBy(*keys).agg(F.sum("labelled").alias("_n"), F.sum("bad").alias("_bad"))
    pooled = pooled.select("host", "_above", "_shape", "_pool", smooth(F.col("_n"), F.col("_bad")).alias("purity"), (F.col("_n") > 0).alias("_known"))
    joined = keyed.withColumn("_pool", F.coalesce("_bin", F.lit(-1))).join(pooled, ["host", "_above", "_shape", "_pool"])
    return joined.select("host", "template", "purity", (F.col("_known") & (F.col("purity") >= reject)).alias("rejected"))


def filter_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, labels: DataFrame | None = None
) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) for every row.

    A rule decides where one fits; else the url's pool does: block when rejected, allow when not. ``labels`` has
    (host, path, labelled, bad) counts; without it the urls that rules decide are the labelled ones. Null urls and
    urls without ``://`` have empty host and path and fall on the empty template. A null id is kept as it is;
    repeated rows count once each. Other columns are not looked at. An empty table gives no rows.

    All steps after the first work on distinct (host, path) with counts, so a hot url is one row; joins carry the
    segment or the path in their keys, so a hot host is spread.
    """
    url = F.col(f"`{url_col}`")
    host, path = split_url(url)
    rows = pages.select(F.col(f"`{id_col}`").alias("_id"), host.alias("host"), path.alias("path"))
    name, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", name.alias("rule"), verdict.alias("_verdict"))
    counted = rows.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("_urls"), F.count("_verdict").alias("labelled"), F.sum(F.when(F.col("_verdict") == "block", 1).otherwise(0)).alias("bad")
    )
    if labels is not None:
        counted = counted.drop("labelled", "bad").join(labels.select("host", "path", "labelled", "bad"), ["host", "path"], "left").fillna(0, ["labelled", "bad"])
    tree = templates(staged(counted, "url-paths"))
    leaves = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    verdicts = staged(pools(staged(leaves, "url-leaves")), "url-pools")  # joined as a table, so that Spark can split a hot template
    decided = tree.select("host", "path", "template").join(verdicts, ["host", "template"])
    says = F.coalesce("_verdict", F.when(F.col("rejected"), "block").otherwise("allow"))
    return rows.join(decided, ["host", "path"]).select(F.col("_id").alias(id_col), "host", "path", "rule", says.alias("verdict"), "template", "purity")
