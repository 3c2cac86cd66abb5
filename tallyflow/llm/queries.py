"""The registered query of each operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm import bpe, exact_dedup, language, line_dedup, mixing, near_dedup, pieces, pii, prefix_trie, quality, secrets, turn_repair, url_filter
from tallyflow.llm.common import WORD, table
from tallyflow.llm.streams import joined_sha256

#: The key of the registered query; a deployment passes its own.
SURROGATE_KEY = "tallyflow"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenise(table(spark, sf_dir, "documents"), vocabulary_path(), split_pattern(), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality weights from the labels: 2 for good, 1/2 for bad, 1 for documents without a label."""
    quality = F.max("quality")
    ratings = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.when(quality >= 1, 2.0).when(quality < 1, 0.5).alias("weight"))
    mixed = mixing.mix(table(spark, sf_dir, "documents"), ratings)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), size=4)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base, spans = secrets.written(F.col("base_spans")), secrets.written(F.col("spans"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def damaged_conversations(conversations: DataFrame) -> DataFrame:
    """Conversations with one fault in some of four rows; by the checksum of conversation and turn. Nulls are one space."""
    written = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat(written[0], F.lit(":"), written[1])) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn", F.when(draw == 4, "user").otherwise(role).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(draw == 0, F.array().cast("array<int>")).when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    audits, rows = turn_repair.repair(damaged_conversations(conversations))
    lines = rows.select("conv_id", "row", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = joined_sha256(lines, ["conv_id"], ["row", "part"], "line", "\n", "sha256").withColumnRenamed("conv_id", "_kept")
    found = audits.withColumnRenamed("conv_id", "_conv")
    every = conversations.select("conv_id").distinct()
    out = every.join(found, every.conv_id.eqNullSafe(found._conv), "left").join(digests, every.conv_id.eqNullSafe(digests._kept), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    sha256 = F.coalesce("sha256", F.sha2(F.lit(""), 256))
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), sha256.alias("repaired_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.ranked_turns(table(spark, sf_dir, "conversations"))))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    wanted = ("n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256")
    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL), wanted)


QUERIES = {
    "op1_bpe": op1_bpe, "op2_url_filter": op2_url_filter, "op3_quality_rules": op3_quality_rules,
    "op4_line_dedup": op4_line_dedup, "op5_mixing": op5_mixing, "op6_near_dedup": op6_near_dedup,
    "op7_pii": op7_pii, "op8_language_id": op8_language_id, "op9_secret_scan": op9_secret_scan, "op10_exact_dedup": op10_exact_dedup,
    "op11_turn_repair": op11_turn_repair, "op12_prefix_trie": op12_prefix_trie, "op13_sentencepiece": op13_sentencepiece,
}

#: CRC-32 (fixed polynomial) of the ASCII string ``s``, one byte and then one bit at a time.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::BIGINT)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


def _cheapest(*options: tuple[str, str, int, str, str]) -> str:
    """The least (cost, audit, text) of state x with cost n, edits e and line l added, where condition c holds."""
    tried = [f"CASE WHEN {c} THEN {{'c': {x}.c + {n}, 'a': {x}.a || '{e}', 't': {x}.t || {l}}} ELSE dead END" for x, c, n, e, l in options]
    return f"least({', '.join(tried)})"


def _moved(row: dict[str, str]) -> str:
    """States o, s, u, a after one more row, before anything is inserted."""
    keep = lambda x, letter: (x, f"NOT m AND i = '{letter}'", "cut", "K", row["keep"])
    new = lambda x, to: (x, "NOT m", "2 + cut", "R", row[to])
    gone = lambda x: (x, "true", "3", "D", "[]::VARCHAR[]")
    return ",\n".join([
        f"{_cheapest(gone('o'))} AS o", f"{_cheapest(gone('s'), keep('o', 's'))} AS s",
        f"{_cheapest(gone('u'), *[f(x, y) for x in 'osa' for f, y in ((keep, 'u'), (new, 'u'))])} AS u",
        f"{_cheapest(gone('a'), keep('u', 'a'), new('u', 'a'))} AS a",
    ])


_INSERTED = """o, s, {u} AS u, {a} AS a""".format(
    u=_cheapest(*[(x, "true", "0" if x == "u" else "2", "" if x == "u" else "I", "[]::VARCHAR[]" if x == "u" else "['user:']") for x in "uosa"]),
    a=_cheapest(("a", "true", "0", "", "[]::VARCHAR[]"), ("u", "true", "2", "I", "['assistant:']"),
                *[(x, "true", "4", "II", "['user:', 'assistant:']") for x in "os"]),
)

ORACLES = {
    "op11_turn_repair": rf"""
        WITH RECURSIVE
        drawn AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS draw
            FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations)),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
                   CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(CASE draw WHEN 0 THEN []::INTEGER[] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM drawn),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
                   right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final
            FROM damaged),
        faults AS (
            SELECT *, left(role, 1) AS i, final = '' AS blank,
                   final <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before
            FROM ranked),
        rows_in AS (
            SELECT *, blank OR again AS m, final NOT IN ('.', '!', '?') AND NOT blank AND NOT again AS truncated,
                   CASE WHEN final NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut, {{'c': 1000000000, 'a': '', 't': []::VARCHAR[]}} AS dead
            FROM faults),
        states AS (
            SELECT conv_id, 0::BIGINT AS n, {_INSERTED}
            FROM (SELECT DISTINCT conv_id, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS o, dead AS s, dead AS u, dead AS a, dead FROM rows_in)
            UNION ALL
            SELECT conv_id, n, {_INSERTED}
            FROM (SELECT r.conv_id, r.n, r.dead, {_moved({"keep": "[r.role || ':' || r.text]", "u": "['user:' || r.text]", "a": "['assistant:' || r.text]"})}
                  FROM states JOIN rows_in r ON r.conv_id IS NOT DISTINCT FROM states.conv_id AND r.n = states.n + 1)),
        best AS (SELECT conv_id, arg_max(least(o, a), n) AS b FROM states GROUP BY conv_id),
        counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
                   count(*) FILTER (WHERE again) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
                   count(*) FILTER (WHERE n > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
            FROM rows_in GROUP BY conv_id)
        SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
               coalesce(b.a, '') AS audit, sha256(coalesce(array_to_string(b.t, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) e
        LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM e.conv_id
        LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
    "op4_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
            FROM documents),
        k AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l),
        f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
        FROM k LEFT JOIN f ON k.key = f.key
        GROUP BY doc_id
    """,
    "op10_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS len,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
            FROM documents),
        g AS (
            SELECT norm, count(*) AS group_size, arg_min(doc_id, (-len, doc_id)) AS keep_id
            FROM n GROUP BY norm)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
        FROM n JOIN g ON n.norm = g.norm
    """,
    "op12_prefix_trie": rf"""
        WITH turns AS (
            SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS x,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS n
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id, list(x ORDER BY n) AS xs FROM turns GROUP BY conv_id),
        drawn AS (SELECT conv_id, {_CRC} % 4 AS h FROM (SELECT conv_id, conv_id::VARCHAR AS s FROM own)),
        rebuilt AS (
            SELECT o.conv_id, coalesce(list_slice(b.xs, 1, h), []) || list_slice(o.xs, h + 1, len(o.xs)) AS xs
            FROM own o JOIN drawn USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
        steps AS (
            SELECT conv_id, d AS depth, len(xs) AS size, sha256(list_slice(xs, 1, d)::VARCHAR) AS node, sha256(list_slice(xs, 1, d - 1)::VARCHAR) AS up,
                   CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(xs[d].t, '{WORD}')) END AS words
            FROM rebuilt, unnest(range(0, len(xs) + 1)) AS s(d)),
        nodes AS (
            SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, any_value(up) AS up,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
            FROM steps GROUP BY depth, node),
        families AS (
            SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.up = n.node AND c.depth = n.depth + 1) AS n_children
            FROM nodes n LEFT JOIN nodes p ON n.up = p.node AND n.depth = p.depth + 1),
        above AS (SELECT DISTINCT t.node AS top, s.node AS node FROM steps s JOIN steps t ON s.conv_id = t.conv_id AND t.depth <= s.depth),
        summed AS (
            SELECT top, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
            FROM above JOIN families USING (node) GROUP BY top)
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        FROM families JOIN summed ON summed.top = families.node
    """,
}
