"""PII surrogates: detected entities get keyed replacements of the same type, format, script and gender.

An entity's canonical form and a key give its surrogate, so an entity has one surrogate in all documents and in every
way it is written. A table of all distinct entities is built; where two would share a surrogate, or a surrogate is
itself an entity of the corpus, all but the smallest draw again until every surrogate is its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import let, lower_ascii, staged

# Kinds in order of preference, with their patterns; titles by gender
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,24})"
IP = r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\p{L}\p{N}]|\.\d)"
PHONE = (
    r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\p{L}\p{N}])"
)
CARD = r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![\p{L}\p{N}])"
MALE, FEMALE = "Mr|Herr|Señor|Sr|Monsieur|Signor|Sir|Lord", "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Signora|Fräulein|Señorita|Srta|Mademoiselle|Mlle|Lady|Dame|Dra"
TITLES = rf"(?:(?:{MALE}|{FEMALE}|Dr|Doctor|Doktor|Prof|Professor|Rev|Reverend)\.? )++"
INITIALS = r"\p{Lu}\.(?:-?\p{Lu}\.)*+"
NAME = rf"(?:{INITIALS}|\p{{Lu}}\p{{L}}*+(?:['’-](?!s(?!\p{{L}}))\p{{L}}++)*+)"
PERSON = rf"(?<![\p{{L}}\p{{N}}]){TITLES}(?:(?:von|van|de|der|den|del|della|di|da|du|la|le|zu) )*+{NAME}(?: (?:(?:von|van|de|der|den|del|della|di|da|du|la|le|zu) )*+{NAME})*+"
KINDS = ("email", "ip", "phone", "card", "person")
ANY = "|".join((EMAIL, IP, PHONE, CARD, PERSON))

#: Draws with a format of fixed length; entities that still collide then get longer surrogates.
SAME_LENGTH_DRAWS = 8
_PART = "struct<lit:string,kind:string,canon:string,person:int>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D+", "")


def _part(lit: Column, kind: Column | None = None, canon: Column | None = None, person: Column | None = None) -> Column:
    """``person`` is 1 in the part where the mention of a person is counted."""
    none = F.lit(None).cast("string")
    return F.struct(lit.alias("lit"), (none if kind is None else kind).alias("kind"), (none if canon is None else canon).alias("canon"), (F.lit(0) if person is None else person).alias("person"))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit counted once."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(c == "", 0).when(i % 2 == 0, c.cast("int")).otherwise(F.pmod(c.cast("int") * 2, F.lit(10)) + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def kind_of(match: Column) -> Column:
    """Kind of a match of the pattern; null for digit strings that are no card number."""
    whole = lambda p: match.rlike(rf"\A(?:{p})\z")
    card = F.when(_luhn(_digits(match)) % 10 == 0, F.lit("card"))
    return F.when(match.contains("@"), "email").when(whole(IP), "ip").when(match.rlike(r"\A\d+(?:[ -]\d+)*\z") & (F.char_length(_digits(match)) >= 13), card).when(
        match.rlike(r"\A[+(\d]"), "phone"
    ).otherwise("person")


def _tokens(match: Column) -> Column:
    """A match as parts: entities with kind and canonical form, and the characters between them."""
    lit = F.lit
    local, domain = F.regexp_extract(match, r"\A([^@]*)@", 1), F.regexp_extract(match, r"@(.*)\z", 1)
    email = F.array(_part(local, lit("email"), F.lower(match)), _part(lit("@")), _part(domain, lit("domain"), lower_ascii(domain)))
    country = F.regexp_extract(match, r"\A\+(\d{1,3})[ .(-]", 1)
    number = F.when(country != "", F.concat(lit("+"), country, lit(":"), F.substring(_digits(match), F.char_length(country) + 1, F.char_length(match)))).otherwise(_digits(match))
    title = F.regexp_extract(match, rf"\A({TITLES})", 1)
    gender = F.when(title.rlike(rf"(?<!\S)(?:{FEMALE})\.? "), "f").when(title.rlike(rf"(?<!\S)(?:{MALE})\.? "), "m").otherwise("n")
    names = F.split(F.regexp_replace(match, rf"\A{TITLES}", ""), " ")

    def name(x: Column, i: Column, last: Column) -> Column:
        kind = F.when(i == last, "surname").otherwise(F.concat(lit("given_"), gender))
        one = F.when(x.rlike(rf"\A{INITIALS}\z"), _part(F.regexp_replace(x, r"\p{Lu}", "X"))).when(x.rlike(r"\A\p{Lu}"), _part(x, kind, F.lower(x))).otherwise(_part(x))
        return F.when(i == 0, F.array(one)).otherwise(F.array(_part(lit(" ")), one))

    person = let(names, lambda n: F.concat(F.array(_part(title, person=lit(1))), F.flatten(F.transform(n, lambda x, i: name(x, i, F.size(n) - 1)))))
    one = lambda kind, canon: F.array(_part(match, lit(kind), canon))
    by = {"email": email, "ip": one("ip", match), "phone": one("phone", number), "card": one("card", _digits(match)), "person": person}
    kind = kind_of(match)
    return let(kind, lambda k: reduce(lambda rest, name: F.when(k == name, by[name]).otherwise(rest), KINDS, F.array(_part(match))))


def parts(text: Column) -> Column:
    """The whole text as parts, in order: what lies between matches, and each match's own parts."""
    pieces, matches = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    both = F.zip_with(pieces, matches, lambda p, m: F.concat(F.array(_part(p)), F.when(m.isNull(), F.array().cast(f"array<{_PART}>")).otherwise(_tokens(m))))
    return let(F.filter(F.flatten(both), lambda x: x["kind"].isNotNull() | (x["lit"] != "")), _again)


def _again(found: Column) -> Column:
    """The parts of a text with the names found after titles looked up in the rest of it, each with one kind in the text."""
    is_name = lambda x: F.coalesce(x["kind"].isin("given_f", "given_m", "given_n", "surname"), F.lit(False))
    names = F.filter(found, lambda x: is_name(x) & (F.char_length(x["lit"]) > 1))
    known = F.sort_array(F.array_distinct(F.transform(names, lambda x: F.struct(x["canon"].alias("canon"), x["kind"].alias("kind")))))

    def looked_up(k: Column) -> Column:
        kind_in = lambda x, canon: F.coalesce(F.filter(k, lambda y: y["canon"] == canon)[0]["kind"], x["kind"])
        # longer names first: one can begin with another
        either = F.array_join(F.sort_array(F.transform(k, lambda y: y["canon"]), asc=False), "|")
        pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?=\p{Lu})(?iu:"), either, F.lit(r")(?![\p{L}\p{N}])"))

        def cut(x: Column) -> Column:
            kind = lambda m: F.filter(k, lambda y: y["canon"] == F.lower(m))[0]["kind"]
            both = F.zip_with(F.split(x["lit"], pattern, F.lit(-1)), F.regexp_extract_all(x["lit"], pattern, F.lit(0)), lambda p, m: F.when(m.isNull(), F.array(_part(p))).otherwise(
                F.array(_part(p), _part(m, kind(m), F.lower(m), F.when(kind(m) == "surname", 1).otherwise(0)))))
            return F.filter(F.flatten(both), lambda y: y["kind"].isNotNull() | (y["lit"] != ""))

        one = lambda x: F.when(is_name(x), F.array(_part(x["lit"], kind_in(x, x["canon"]), x["canon"], x["person"]))).when(
            x["kind"].isNull() & (x["person"] == 0) & x["lit"].rlike(r"\p{L}"), cut(x)).otherwise(F.array(x))
        return F.when(F.size(k) == 0, found).otherwise(F.flatten(F.transform(found, one)))

    return let(known, looked_up)


def _draw(seed: Column, i: Column | int) -> Column:
    return F.xxhash64(seed, F.lit(i) if isinstance(i, int) else i)


def _letter_like(c: Column, n: Column) -> Column:
    """A character of the same class and script; what is neither letter nor digit stays."""
    of = lambda letters: F.substring(F.lit(letters), F.pmod(n, F.lit(len(letters))).cast("int") + 1, F.lit(1))
    run = lambda first, last: "".join(map(chr, range(first, last + 1)))
    return (
        F.when(c.rlike(r"\d"), of("0123456789")).when(c.rlike(r"\p{IsCyrillic}"), of(run(0x430, 0x44F))).when(c.rlike(r"\p{IsGreek}"), of(run(0x3B1, 0x3C1) + run(0x3C3, 0x3C9)))
        .when(c.rlike(r"\p{IsHan}"), of(run(0x4E00, 0x4E63))).when(c.rlike(r"\p{IsHebrew}"), of(run(0x5D0, 0x5EA))).when(c.rlike(r"\p{IsArabic}"), of(run(0x627, 0x63A)))
        .when(c.rlike(r"\p{L}"), of("abcdefghijklmnopqrstuvwxyz")).otherwise(c)
    )


def _shaped(text: Column, seed: Column) -> Column:
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: _letter_like(c, _draw(seed, i))), "")


def _number(text: Column, seed: Column) -> Column:
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(c.rlike(r"\d"), F.pmod(_draw(seed, i), F.lit(10)).cast("string")).otherwise(c)), "")


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """Canonical form of the replacement, from the key and the entity alone.

    Emails keep the shape of their local part, domains become reserved example names under their own ending where
    that exists; phones keep the country code, cards their first digit and a valid check digit, private addresses
    their network; given names end by gender, in the script of the original.
    """
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string")), 256)

    def build(s: Column) -> Column:
        longer = F.when(attempt >= SAME_LENGTH_DRAWS, F.substring(F.translate(s, "0123456789", "ghijklmnop"), 1, 8)).otherwise("")
        local = F.concat(_shaped(F.regexp_extract(canon, r"\A([^@]*)@", 1), s), longer)
        ending = F.regexp_extract(canon, r"\.(com|net|org)\z", 1)
        domain = F.concat(F.substring(F.translate(s, "0123456789", "ghijklmnop"), 1, 10), F.lit(".example."), F.when(ending == "", "com").otherwise(ending))
        phone = F.concat(F.regexp_extract(canon, r"\A(\+\d+:)", 1), _number(F.regexp_extract(canon, r"(\d+)\z", 1), s))
        middle = _number(F.substring(canon, F.lit(2), F.char_length(canon) - 2), s)
        payload = F.concat(F.substring(canon, 1, 1), middle)
        card = let(payload, lambda p: F.concat(p, F.pmod(10 - _luhn(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")))
        octet = lambda i: (F.pmod(_draw(s, i), F.lit(254)) + 1).cast("string")
        network = F.regexp_extract(canon, r"\A(10\.|192\.168\.|127\.)", 1)
        free = F.concat_ws(".", octet(1), octet(2), octet(3), octet(4))
        ip = F.when(network == "192.168.", F.concat(network, F.concat_ws(".", octet(1), octet(2)))).when(network != "", F.concat(network, F.concat_ws(".", octet(1), octet(2), octet(3)))).otherwise(free)
        latin = ~canon.rlike(r"[^\p{IsLatin}'-]")
        woman = kind == "given_f"
        vowel = F.when(latin, F.when(woman, "a").otherwise("o")).when(canon.rlike(r"\p{IsCyrillic}"), F.when(woman, "а").otherwise("й")).when(canon.rlike(r"\p{IsGreek}"), F.when(woman, "α").otherwise("ς")).otherwise("")
        given = F.concat(_shaped(canon, s), longer, vowel)
        surname = F.concat(_shaped(canon, s), longer)
        return (
            F.when(kind == "email", local).when(kind == "domain", domain).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ip", ip)
            .when(kind == "surname", surname).otherwise(given)
        )

    return let(seed, build)


def mapping(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) with no surrogate shared within a kind, and none that is an entity of its kind.

    Only entities that clash draw again; the smallest of a clash keeps its surrogate. Draws after the first few get
    longer, so the rounds end. An email's surrogate is compared as its local part.
    """
    real = entities.select("kind", F.when(F.col("kind") == "email", F.regexp_extract("canon", r"\A([^@]*)@", 1)).otherwise(F.col("canon")).alias("surrogate")).distinct()
    real = staged(real, "pii-real")
    settled, open_ones, attempt = None, entities, 0
    while True:
        drawn = staged(open_ones.select("kind", "canon", surrogate(F.col("kind"), F.col("canon"), F.lit(attempt), key).alias("surrogate")), "pii-drawn")
        taken = real if settled is None else real.unionByName(settled.select("kind", "surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon"))
        good = staged(first.join(taken.distinct(), ["kind", "surrogate"], "left_anti").select("kind", "canon", "surrogate"), "pii-good")
        settled = good if settled is None else settled.unionByName(good)
        open_ones = staged(drawn.select("kind", "canon").join(good.select("kind", "canon"), ["kind", "canon"], "left_anti"), "pii-open")
        if open_ones.isEmpty():
            return staged(settled, "pii-mapping")
        attempt += 1


def _written(lit: Column, kind: Column, made: Column) -> Column:
    """A surrogate in the format of the text it replaces: digit groups, and upper or title case."""
    digits = F.regexp_replace(made, r"\A\+(\d+):", "$1").alias("d")
    filled = let(digits, lambda d: F.array_join(
        F.transform(F.split(lit, ""), lambda c, i: F.when(c.rlike(r"\d"), F.substring(d, F.char_length(_digits(F.substring(lit, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), ""))
    cased = F.when((F.upper(lit) == lit) & (F.char_length(lit) > 1), F.upper(made)).when(lit.rlike(r"\A\p{Lu}"), F.concat(F.upper(F.substring(made, 1, 1)), F.substring(made, F.lit(2), F.char_length(made)))).otherwise(made)
    return F.when(kind.isin("phone", "card"), filled).when(kind.isin("ip", "domain"), made).when(lit.rlike(r"\p{L}"), cased).otherwise(made)


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_email, n_ip, n_phone, n_card, n_person) for every row, entities replaced.

    Null text stays null with no entities; empty text stays empty. Digit strings count as cards only with a valid
    check digit. Names found after a title are replaced wherever the same text has them. Repeated rows are replaced alike. The same entity has the same surrogate in all rows, for the same
    key. Other columns are not looked at. An empty table gives no rows. Texts without entities stay where they are;
    the parts of the others meet again by row, and a hot entity is a hot join key that Spark splits.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    has = F.coalesce(F.col("_text").rlike(ANY), F.lit(False))
    cut = rows.where(has).select("_id", parts(F.col("_text")).alias("_parts"), F.monotonically_increasing_id().alias("_row"))
    cut = staged(cut, "pii-parts")
    pieces = cut.select("_row", "_id", F.posexplode("_parts").alias("_at", "_part")).select("_row", "_id", "_at", "_part.*")
    entities = staged(pieces.where("kind IS NOT NULL").select("kind", "canon").distinct(), "pii-entities")
    named = pieces.where("kind IS NOT NULL").join(mapping(entities, key), ["kind", "canon"])
    named = named.select("_row", "_id", "_at", _written(F.col("lit"), F.col("kind"), F.col("surrogate")).alias("_out"), "kind", "person")
    plain = pieces.where("kind IS NULL").select("_row", "_id", "_at", F.col("lit").alias("_out"), "kind", "person")
    count = lambda *kinds: F.count(F.when(F.col("kind").isin(*kinds), 1))
    counts = [
        count("email").alias("n_email"), count("ip").alias("n_ip"), count("phone").alias("n_phone"), count("card").alias("n_card"),
        F.sum("person").alias("n_person"),
    ]
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_out"))), lambda x: x["_out"]), "")
    whole = named.unionByName(plain).groupBy("_row", "_id").agg(joined.alias("text"), *counts).drop("_row")
    zero = F.lit(0).cast("long")
    bare = rows.where(~has).select("_id", F.col("_text").alias("text"), *[zero.alias(f"n_{k}") for k in KINDS])
    return bare.unionByName(whole).withColumnRenamed("_id", id_col)
