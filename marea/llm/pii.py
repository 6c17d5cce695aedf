"""Surrogates for personal data and secrets.

Entities are found by pattern (and checksum) and replaced in place by values of their
kind, made from a keyed hash of the normalised entity: the same entity gets the same
surrogate in every document and spelling, and nothing leads back without the key.

* Digits (phone, card, social-security number, IP address) pass a keyed Feistel
  permutation of their own length, which is one to one; the format stays, a card keeps
  its first digit and gets a valid check digit, a phone keeps its country code.
* Letters (e-mail, names) and secrets are drawn from the hash. Names follow the gender
  of their title and their script; given and family names are replaced on their own, so
  that a later mention by family name alone still refers to the same person.

Drawn surrogates are checked over the whole corpus: if two different entities of a
kind share one, or a surrogate is itself an entity of the corpus, that kind is drawn
again with longer values, until all are distinct.

Defined cases: a null text stays null and an empty one empty, with no entities; long
digit runs that fail the card check are left alone; texts without an entity are
returned as they are; repeated rows are replaced alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marea.functions.text import let
from marea.llm.common import column, documents, fresh
from marea.session import materialized

KEY = "marea demonstration key"     # a parameter: give a secret of your own
ROUNDS = 4
SYLLABLES = 4                       # of a name; a further attempt adds one
SECRET_STEP = 8                     # letters that a further attempt adds to the least length of a secret

# --- Fixed values -----------------------------------------------------------
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
NAME = r"\p{Lu}[\p{L}'’-]*+"
MALE_TITLES = ("Mr", "Mister", "Herr", "Herrn", "Monsieur", "Señor", "господин", "Господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "госпожа", "Госпожа")
TITLES = "|".join(MALE_TITLES + FEMALE_TITLES)
SECRET_LABELS = "token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key"
# Kinds in the order in which they are tried at a place.
PATTERNS = {
    "secret": rf"(?i:(?<![\p{{L}}\p{{N}}])(?:{SECRET_LABELS})"
              r"\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_.~-]{8,}+)",
    "cloud_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?![\d]|\.\d)",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
             r"|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.])\d(?:[ -]?\d){12,18}(?![\d]|\.\d)",
    "name": rf"(?<!\p{{L}})(?:{TITLES})\.? {NAME}(?: {NAME}){{0,2}}",
}
DRAWN = ("secret", "cloud_key", "email", "name")    # the kinds whose surrogates may collide
LATIN_CONSONANTS, LATIN_VOWELS = "bdfgklmnprstvzjc", "aeio"
CYRILLIC_CONSONANTS, CYRILLIC_VOWELS = "бвгджзклмнпрстфх", "аеио"
# Last letters by script and gender of given names, and of Cyrillic family names.
GIVEN_ENDS = {("latin", "f"): "na", ("latin", "m"): "ro", ("cyrillic", "f"): "на", ("cyrillic", "m"): "н"}
FAMILY_ENDS = {("latin", "f"): "l", ("latin", "m"): "l", ("cyrillic", "f"): "ова", ("cyrillic", "m"): "ов"}
# ----------------------------------------------------------------------------

ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Part of every match of each kind; the last six kinds hold '@', a digit or a title.
MAY_HOLD = rf"[@\d]|(?:{TITLES})\.? |(?:AKIA|ASIA)[A-Z]|(?i:{SECRET_LABELS})\s{{0,3}}[=:]"
OTHER_ALPHABET = ("0123456789abcdef", "k3m9pqr7tuvwxyza")
LATIN = [c + v for c in LATIN_CONSONANTS for v in LATIN_VOWELS]
CYRILLIC = [c + v for c in CYRILLIC_CONSONANTS for v in CYRILLIC_VOWELS]


def keyed(key: str, *parts: Column | str) -> Column:
    """64 hex digits that depend on the key and all parts."""
    texts = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.concat_ws("|", F.lit(key), *texts), 256)


def number(digest: Column, first: int = 1) -> Column:
    """60 bits of a hex digest."""
    return F.conv(F.substring(digest, first, 15), 16, 10).cast("long")


def kind_of(match: Column) -> Column:
    """The first kind whose pattern is the whole match."""
    tests = [F.when(match.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()]
    return F.coalesce(*tests)


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, r"\D", "")


def luhn_sum(digits: Column) -> Column:
    """Check sum of a card number, whose last digit is not doubled."""
    places = F.sequence(F.lit(1), F.length(digits))

    def value(place: Column) -> Column:
        digit = F.substr(digits, place, F.lit(1)).cast("int")
        double = (F.length(digits) - place) % 2 == 1
        return F.when(~double, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    return F.aggregate(F.transform(places, value), F.lit(0), lambda total, v: total + v)


def feistel(high: Column, low: Column, sizes: tuple[Column, Column], key: str, kind: str) -> Column:
    """Keyed one-to-one map of (high, low), numbers below the two sizes: in each round one
    side is shifted by a hash of the other, and they change places."""
    start = F.struct(high.alias("a"), low.alias("b"), sizes[0].alias("m"), sizes[1].alias("n"))

    def turn(state: Column, round_: Column) -> Column:
        shift = number(keyed(key, kind, round_, state["b"]))
        return F.struct(state["b"].alias("a"), F.pmod(state["a"] + shift, state["m"]).alias("b"),
                        state["n"].alias("m"), state["m"].alias("n"))

    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, turn)


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Another text of as many digits; different texts of one length stay different."""
    def run(d: Column) -> Column:
        half = (F.length(d) / 2).cast("int")
        rest = F.length(d) - half
        power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("long")
        mixed = feistel(F.substr(d, F.lit(1), half).cast("long"), F.substr(d, half + 1, rest).cast("long"),
                        (power(half), power(rest)), key, kind)
        return let(mixed, lambda s: F.concat(F.lpad(s["a"].cast("string"), half, "0"),
                                             F.lpad(s["b"].cast("string"), rest, "0")))

    return let(digits, run)


def filled(match: Column, digits: Column) -> Column:
    """The match with its digits replaced, one after another, by ``digits``."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("next"))

    def step(state: Column, letter: Column) -> Column:
        digit = letter.rlike(r"^\d$")
        return F.struct(F.concat(state["text"], F.when(digit, F.substr(digits, state["next"], F.lit(1)))
                                 .otherwise(letter)).alias("text"),
                        (state["next"] + digit.cast("int")).alias("next"))

    return F.aggregate(F.split(match, ""), start, step, lambda s: s["text"])


def phone(match: Column, key: str) -> Column:
    country = F.regexp_extract(match, r"^\+(\d{1,3})(?=[ .(-])", 1)
    digits = digits_of(match)
    rest = F.substr(digits, F.length(country) + 1, F.length(digits))
    return filled(match, F.concat(country, permuted_digits(rest, key, "phone")))


def card(match: Column, key: str) -> Column:
    """A number of the same first digit and length with a valid check digit; a match that
    is no card number is returned as it is."""
    def run(d: Column) -> Column:
        inner = F.substr(d, F.lit(2), F.length(d) - 2)
        open_ = F.concat(F.substr(d, F.lit(1), F.lit(1)), permuted_digits(inner, key, "card"))
        check = F.pmod(10 - luhn_sum(F.concat(open_, F.lit("0"))) % 10, F.lit(10)).cast("string")
        return F.when(luhn_sum(d) % 10 == 0, filled(match, F.concat(open_, check))).otherwise(match)

    return let(digits_of(match), run)


def address(match: Column, key: str) -> Column:
    def run(p: Column) -> Column:
        octet = lambda n: F.get(p, F.lit(n)).cast("long")
        half = F.lit(65536).cast("long")
        mixed = feistel(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), (half, half), key, "ip")
        parts = lambda s: [x for side in (s["a"], s["b"]) for x in (F.shiftright(side, 8), side % 256)]
        return let(mixed, lambda s: F.concat_ws(".", *[x.cast("string") for x in parts(s)]))

    return let(F.split(match, r"\."), run)


def spoken(seed: Column, syllables: Sequence[str], count: int) -> Column:
    """``count`` syllables by successive six-bit pieces of a 60-bit number."""
    table = F.array(*map(F.lit, syllables))
    picked = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda n: F.element_at(
        table, (F.pmod(F.call_function("shiftright", seed, (n * 6).cast("int")), F.lit(64)) + 1).cast("int")))
    return F.array_join(picked, "")


def email(match: Column, key: str, attempt: int) -> Column:
    norm = F.lower(match)
    local = spoken(number(keyed(key, "email", F.lit(attempt), norm)), LATIN, min(10, 6 + attempt))
    domain = spoken(number(keyed(key, "domain", F.lit(attempt), F.split_part(norm, F.lit("@"), F.lit(-1)))),
                    LATIN, min(10, 4 + attempt))
    return F.concat(local, F.lit("@"), domain, F.lit(".example"))


def secret(match: Column, key: str, attempt: int) -> Column:
    """The label and its marks stay; the value becomes another of its alphabet and length, and
    a further attempt lengthens short values, which are too few for a large corpus."""
    def run(value: Column) -> Column:
        digest = F.concat(*[keyed(key, "secret", F.lit(attempt), F.lit(n), F.lower(value)) for n in range(4)])
        length = F.greatest(F.length(value), F.lit((attempt + 1) * SECRET_STEP if attempt else 0))
        times = (length / 256 + 1).cast("int")
        hexes = F.substr(F.repeat(digest, times), F.lit(1), length)
        letters = F.translate(hexes, *OTHER_ALPHABET)
        made = F.when(value.rlike("^[0-9a-f]+$"), hexes).when(value.rlike("^[0-9A-F]+$"), F.upper(hexes)) \
            .when(value.rlike("^[^a-z]+$"), F.upper(letters)).otherwise(letters)
        return F.concat(F.substr(match, F.lit(1), F.length(match) - F.length(value)), made)

    return let(F.regexp_extract(match, r"([A-Za-z0-9+/_.~-]+)$", 1), run)


def cloud_key(match: Column, key: str, attempt: int) -> Column:
    digest = keyed(key, "cloud_key", F.lit(attempt), match)
    return F.concat(F.substr(match, F.lit(1), F.lit(4)), F.upper(F.translate(F.substring(digest, 1, 16), *OTHER_ALPHABET)))


def stem_of(word: Column) -> Column:
    """A name in lower case, a Cyrillic one without the ending of female family names."""
    return F.when(word.rlike(r"^\p{IsCyrillic}"), F.regexp_replace(F.lower(word), "(?<=ов|ев|ин|ын)а$", "")) \
        .otherwise(F.lower(word))


def name(match: Column, key: str, attempt: int) -> Column:
    """Title, given names and family name; one name after a title is the family name."""
    def run(words: Column) -> Column:
        title, last = F.regexp_replace(F.get(words, F.lit(0)), r"\.$", ""), F.size(words) - 1
        female = title.isin(*FEMALE_TITLES)

        def renamed(word: Column, place: Column) -> Column:
            cyrillic = word.rlike(r"^\p{IsCyrillic}")
            made = []
            for script, table in (("latin", LATIN), ("cyrillic", CYRILLIC)):
                stem = stem_of(word)
                for role, ends in (("family", FAMILY_ENDS), ("given", GIVEN_ENDS)):
                    stem_ = spoken(number(keyed(key, role, F.lit(attempt), stem)), table, min(10, SYLLABLES + attempt))
                    made.append(F.concat(stem_, F.when(female, F.lit(ends[script, "f"])).otherwise(F.lit(ends[script, "m"]))))
            chosen = F.when(cyrillic, F.when(place == last, made[2]).otherwise(made[3])) \
                .otherwise(F.when(place == last, made[0]).otherwise(made[1]))
            shaped = F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(chosen)).otherwise(F.initcap(chosen))
            return F.when(place == 0, word).otherwise(shaped)

        return F.array_join(F.transform(words, renamed), " ")

    return let(F.split(match, " "), run)


def surrogate(match: Column, key: str, attempts: dict[str, int]) -> Column:
    """The replacement of one match; the match itself where it is no entity after all."""
    made = {"secret": lambda: secret(match, key, attempts.get("secret", 0)),
            "cloud_key": lambda: cloud_key(match, key, attempts.get("cloud_key", 0)),
            "email": lambda: email(match, key, attempts.get("email", 0)),
            "name": lambda: name(match, key, attempts.get("name", 0)),
            "ip": lambda: address(match, key), "phone": lambda: phone(match, key),
            "ssn": lambda: filled(match, permuted_digits(digits_of(match), key, "ssn")),
            "card": lambda: card(match, key)}
    return let(kind_of(match), lambda kind: F.coalesce(
        reduce(lambda done, k: done.when(kind == k, made[k]()), list(made)[1:],
               F.when(kind == "secret", made["secret"]())), match))


def matches(text: Column) -> Column:
    """All matches of a text, in order; most texts are ruled out by a cheap test."""
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(text.rlike(MAY_HOLD), F.lit(False)), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))) \
        .otherwise(none)


def normalised(kind: Column, match: Column) -> Column:
    """What makes two matches of a drawn kind the same entity."""
    value = F.regexp_extract(match, r"([A-Za-z0-9+/_.~-]+)$", 1)
    stems = F.array_join(F.transform(F.split(match, " "), lambda word, place: F.when(
        place == 0, F.lower(word)).otherwise(stem_of(word))), " ")
    return F.when(kind == "secret", F.lower(value)).when(kind == "cloud_key", match) \
        .when(kind == "name", stems).otherwise(F.lower(match))


def distinct_attempts(docs: DataFrame, key: str, text_col: str) -> dict[str, int]:
    """For each drawn kind the first attempt at which different entities of the corpus have
    different surrogates, none of which is an entity of the corpus."""
    found = docs.select(F.explode(matches(column(docs, text_col))).alias("match")).distinct()
    kinds = found.select(kind_of(F.col("match")).alias("kind"), "match").where(F.col("kind").isin(*DRAWN))
    entities = materialized(kinds.withColumn("entity", normalised(F.col("kind"), F.col("match"))))
    attempts = dict.fromkeys(DRAWN, 0)
    open_ = set(DRAWN)
    while open_:
        made = entities.where(F.col("kind").isin(*open_)).select(
            "kind", "entity", surrogate(F.col("match"), key, attempts).alias("made"))
        made = made.select("kind", "entity", normalised(F.col("kind"), F.col("made")).alias("made")).distinct()
        shared = made.groupBy("kind", "made").agg(F.count("*").alias("n")).where("n > 1").select("kind")
        real = made.join(entities.select("kind", F.col("entity").alias("made")), ["kind", "made"], "left_semi").select("kind")
        open_ = {r["kind"] for r in shared.union(real).distinct().collect()}
        for kind in open_:
            attempts[kind] += 1
    return attempts


def replace_entities(docs: DataFrame, key: str = KEY, text_col: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with every entity in the text replaced, and with the number of replaced
    entities as the column ``count`` if a name is given. Row by row, without a shuffle."""
    attempts = distinct_attempts(docs, key, text_col)
    names = docs.columns
    found, made = fresh(names, "found"), fresh(names, "made")
    text = column(docs, text_col)
    marked = docs.select("*", matches(text).alias(found))
    marked = marked.select("*", F.transform(found, lambda m: surrogate(m, key, attempts)).alias(made))
    text = column(marked, text_col)
    between = F.split(text, ANY, -1)
    joined = F.array_join(F.zip_with(between, F.col(made), lambda before, new: F.concat(before, F.coalesce(new, F.lit("")))), "")
    replaced = F.when(F.size(found) > 0, joined).otherwise(text)
    number_ = F.size(F.filter(F.zip_with(found, made, lambda old, new: old != new), lambda changed: changed))
    return marked.select(*[replaced.alias(n) if n == text_col else column(marked, n) for n in names],
                         *([number_.cast("long").alias(count)] if count else []))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return replace_entities(docs, count="n_replaced").withColumn("changed", F.col("n_replaced") > 0)
