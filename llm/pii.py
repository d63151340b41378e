"""Operator 7: personal data replaced by keyed surrogates, with DataFrame functions only.

Mentions of e-mail addresses, IP addresses (4 and 6), phone and card numbers,
social security numbers, IBANs, secret keys and titled names are found by one
regular expression. Names without a title are not looked for. A mention holds
one or more entities: the canonical form (case, spacing and punctuation
removed) of an address and its domain, of a number's digits, of each part of a
given name and a surname (``Lee-Brown`` has two parts, ``O'Neil`` one). Each
entity gets one surrogate, so that all its mentions agree, however they are
written:

* digits stay digits, letters stay letters of their script and case, marks
  stay; country codes, top-level domains, the prefixes of secret keys and a
  card's check digit hold;
* IPv4 parts stay in range; hex keys stay hex; IPv6 addresses keep their shape
  in the first attempts and have eight groups in later ones;
* given names come from lists by script and by the title's gender, later
  attempts with syllables and an ending of that gender; surnames from
  syllables of the script.

Surrogates are SHA-256 digests of key, kind, entity and attempt. Entities that
share a surrogate, or whose surrogate is an entity of the corpus, get another
attempt, round by round, until all are distinct. An e-mail address is judged
whole: its local part has to differ from others of its domain, and from its
own. A given name is none of the corpus, whatever its gender. Later attempts
are longer by a character each (local parts, domains and other shaped
surrogates from ``GROW``, digits from ``GROW_DIGITS`` on), so that a shape with
more entities than values has one for each.

The key is the caller's and never a constant of this file: who has it can
recompute the mapping. The query reads it from the session's ``KEY_SETTING``;
where that is unset it draws a random one for the run.

A cheap test (``_may``) that every text with a mention passes goes over all
texts; only those that pass it meet the regular expression. Texts with
mentions are cut into pieces, each with the mention that follows it, and
joined with the mentions' replacements (distinct over the corpus). Mentions of
a thousandth of all occurrences or more are joined by broadcast: there are at
most a thousand of them, of ``HOT_LENGTH`` characters at most. Other texts
pass through.

Rows: null and empty texts are kept. All columns and rows are kept, repeated
rows too; equal rows get equal texts. Very long texts are one row, as they
are in the input; their pieces are spread by mention and meet again by row.
An empty table gives no rows. Columns of ``docs`` travel in one struct, so
that their names clash with nothing.
"""

from __future__ import annotations

import secrets
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import _tables as T

KEY_SETTING = "spark.panelsight.pii.key"
ATTEMPTS = 64
HOT_SHARE, HOT_LENGTH = 1000, 1000  # mentions of 1 / HOT_SHARE of all occurrences are broadcast, if they are no longer than HOT_LENGTH
ENTITIES = 2000  # entities of a task
GROW, GROW_DIGITS = 3, 8  # attempts that keep the length

# FIXED VALUES: titles by gender, given names and their endings by script and gender, letters and syllables by script
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Κυρία"],
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Κύριος"],
    "n": ["Dr", "Prof"],
}
GIVEN = {
    ("latin", "f"): ["Anna", "Clara", "Diana", "Elena", "Irene", "Julia", "Laura", "Maria", "Nora", "Paula", "Rosa", "Sara", "Teresa", "Vera"],
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Leon", "Martin", "Oscar", "Paul", "Robert", "Victor"],
    ("latin", "n"): ["Alex", "Andrea", "Charlie", "Dominique", "Kim", "Robin", "Sam", "Sascha"],
    ("cyrillic", "f"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Юлия"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Иван", "Максим", "Олег", "Павел", "Юрий"],
    ("cyrillic", "n"): ["Саша", "Женя", "Валя", "Слава"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Μαρία", "Σοφία", "Ζωή"],
    ("greek", "m"): ["Γιώργος", "Δημήτρης", "Ηλίας", "Νίκος", "Πέτρος", "Σπύρος"],
    ("greek", "n"): ["Φώτης", "Φανή"],
}
ENDINGS = {
    ("latin", "f"): ["na", "ra", "lia", "sa"], ("latin", "m"): ["no", "rt", "las", "mus"], ("latin", "n"): ["ny", "ri", "le", "kis"],
    ("cyrillic", "f"): ["на", "ра", "лия", "са"], ("cyrillic", "m"): ["нин", "рад", "лав", "сей"], ("cyrillic", "n"): ["ни", "ре", "ли", "се"],
    ("greek", "f"): ["να", "ρα", "λία", "νη"], ("greek", "m"): ["νος", "ρης", "λας", "κος"], ("greek", "n"): ["νι", "ρω", "λι", "σω"],
}
SYLLABLES = {
    "latin": ["ba", "co", "di", "fe", "gu", "la", "mo", "ni", "pe", "ru", "sa", "to", "vi", "we", "zu", "kar"],
    "cyrillic": ["ба", "во", "ди", "же", "зу", "ка", "ло", "ми", "не", "пу", "ра", "со", "ти", "фе", "ху", "чар"],
    "greek": ["βα", "γο", "δι", "ζε", "κα", "λο", "μι", "νε", "πα", "ρο", "σι", "τε", "φα", "χο", "ψι", "θαρ"],
}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
HEX = "0123456789abcdef"

_H = "[0-9a-fA-F]{1,4}"
_NAME = r"\p{Lu}[\p{L}\p{M}]*+(?:['’-](?!s(?![\p{L}\p{M}]))\p{L}[\p{L}\p{M}]*+)*"
_TWO = r"(?=\p{Lu}(?:\p{L}|['’]\p{L}{2}))"  # a name has a part of two letters
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,128}+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "key": r"(?<![\p{L}\p{N}_])(?:[0-9a-fA-F]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|sk-[0-9A-Za-z]{20,})(?![\p{L}\p{N}_])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9a-fA-F:]*[0-9])(?:(?:{_H}:){{7}}{_H}|{_H}(?::{_H}){{0,5}}::(?:{_H}(?::{_H}){{0,5}})?|::{_H}(?::{_H}){{0,6}})(?![\p{{L}}\p{{N}}:])",
    "phone": r"(?<![\p{L}\p{N}+])\+\d{1,3}[^\p{L}\p{N}\n(]{0,6}\(\d{2,4}\)[^\p{L}\p{N}\n(]{0,6}\d{3,4}[^\p{L}\p{N}\n(]{1,6}\d{3,4}(?!\d)"
             r"|(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
             r"|(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\p{L}\p{N}-])\d{3}[-.]\d{3}[-.]\d{4}(?![\d-])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\p{L}\p{N}])\d(?:[ -]?\d){12,18}(?!\d)",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? {_TWO}{_NAME}(?: {_TWO}{_NAME})?",
}
ANY = "|".join(PATTERNS.values())


def _one_of(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def _digest(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 256)


def _number(digest: Column, at: Column | int, width: int = 6) -> Column:
    """``width`` hex digits of the digest from 1-based ``at``, around its end."""
    start = at if isinstance(at, int) else (at - 1) % (64 - width) + 1
    return F.conv(F.substr(digest, F.lit(start) if isinstance(at, int) else start, F.lit(width)), 16, 10).cast("long")


def _chars(s: Column, each) -> Column:
    """``each(character, 1-based place)`` over a string."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: each(F.substr(s, i, F.lit(1)), i)), "")


def _shaped(s: Column, digest: Column) -> Column:
    """Lower-case ``s`` with other digits for digits and other letters of their script for letters."""
    def each(c, i):
        n = _number(digest, i)
        out = F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
        for script, letters in (("Cyrillic", "cyrillic"), ("Greek", "greek")):
            out = out.when(c.rlike(rf"\p{{Is{script}}}"), F.substr(F.lit(LETTERS[letters]), (n % len(LETTERS[letters]) + 1).cast("int"), F.lit(1)))
        return out.when(c.rlike(r"\p{L}"), F.substr(F.lit(LETTERS["latin"]), (n % 26 + 1).cast("int"), F.lit(1))).otherwise(c)
    return _chars(s, each)


def _grown(s: Column, attempt: Column, after: int) -> Column:
    """``s`` with its last letter or digit again for each attempt beyond ``after``."""
    last = F.regexp_extract(s, r"([\p{L}0-9])[^\p{L}0-9]*$", 1)
    return F.concat(s, F.repeat(F.when(last == "", "x").otherwise(last), F.greatest(attempt - after, F.lit(0))))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits; those of valid numbers divide by 10."""
    n = F.length(digits)

    def worth(i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)
    return F.aggregate(F.transform(F.sequence(F.lit(1), n), worth), F.lit(0), lambda a, x: a + x)


def _with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``entities(kind, canon, attempt, ...)`` with the surrogate of each.

    The digest is a column of a projection before, so that it is computed once
    and the expressions that take numbers from it stay small.
    """
    return entities.withColumn("digest", _digest(key, F.col("kind"), F.col("canon"), F.col("attempt"))).withColumn("surrogate", _surrogate()).drop("digest")


def _surrogate() -> Column:
    """Surrogate by (kind, canon, attempt, digest)."""
    kind, canon, attempt, d = F.col("kind"), F.col("canon"), F.col("attempt"), F.col("digest")
    digits = _chars(_grown(canon, attempt, GROW_DIGITS), lambda c, i: (_number(d, i) % 10).cast("string"))
    country = F.greatest(F.length(canon) - 10, F.lit(0))
    phone = F.concat(F.substr(canon, F.lit(1), country), F.substr(digits, country + 1))
    stem = F.substr(digits, F.lit(1), F.length(digits) - 1)
    check = ((10 - _luhn(F.concat(stem, F.lit("0"))) % 10) % 10).cast("string")
    card = F.when(_luhn(canon) % 10 == 0, F.concat(stem, check)).otherwise(digits)
    ip = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_number(d, i * 6) % 254 + 1).cast("string")), ".")
    hexed = _chars(canon, lambda c, i: F.substr(F.lit(HEX), (_number(d, i) % 16 + 1).cast("int"), F.lit(1)))
    out = F.when(kind == "phone", phone).when(kind == "ssn", digits).when(kind == "card", card).when(kind == "ip", ip).when(kind == "hex", hexed)
    full = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.substr(d, i * 5, F.lit(4))), ":")
    shape = _chars(canon, lambda c, i: F.when(c == ":", c).otherwise(F.substr(F.lit(HEX), (_number(d, i) % 16 + 1).cast("int"), F.lit(1))))
    out = out.when(kind == "ip6", F.when(attempt < GROW, shape).otherwise(full))
    out = out.when(kind == "email", _shaped(_grown(F.substring_index(canon, "@", 1), attempt, GROW), d))
    out = out.when(kind == "domain", F.concat(_shaped(_grown(F.regexp_replace(canon, r"\.[^.]+$", ""), attempt, GROW), d), F.lit("."), F.substring_index(canon, ".", -1)))
    prefix = F.regexp_extract(canon, "^(akia|gh[pousr]_|sk-)", 1)
    out = out.when(kind == "key", F.concat(prefix, _shaped(F.substr(canon, F.length(prefix) + 1), d)))
    out = out.when(kind == "iban", F.concat(F.substr(canon, F.lit(1), F.lit(2)), F.substr(_shaped(canon, d), F.lit(3))))
    for (script, gender), names in GIVEN.items():  # two more syllables with each attempt after the listed names
        more = F.transform(F.sequence(F.lit(1), F.greatest(F.least(attempt, F.lit(5)) * 2 - 1, F.lit(1))), lambda i: _one_of(SYLLABLES[script], _number(d, i * 6 + 1)))
        longer = F.concat(F.array_join(more, ""), _one_of(ENDINGS[script, gender], _number(d, 52)))
        out = out.when(kind == f"given-{script}-{gender}", F.concat(F.lower(_one_of(names, _number(d, 1))), F.when(attempt > 0, longer).otherwise("")))
    for script, syllables in SYLLABLES.items():  # one more syllable with each attempt
        out = out.when(kind == f"surname-{script}", F.array_join(F.transform(F.sequence(F.lit(1), F.least(attempt, F.lit(8)) + 3), lambda i: _one_of(syllables, _number(d, i * 6))), ""))
    return out.otherwise(_shaped(_grown(canon, attempt, GROW), d))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) of distinct ``entities(kind, canon)``; surrogates of a kind are distinct and no entity of it.

    Local parts are distinct in their domain: domains have distinct surrogates,
    none of them real, so that whole addresses are distinct and none is real.
    """
    entities = T.store(entities, "entities")
    tasks = T.partitions_for(entities.sparkSession, entities.count(), ENTITIES)
    current = T.store(_with_surrogates(entities.repartition(tasks, "kind", "canon").withColumn("attempt", F.lit(0)), key), "surrogates")
    among = F.regexp_replace("kind", "^(given-[a-z]+)-[a-z]$", "$1")  # given names of any gender
    real = entities.select(among.alias("k"), F.col("canon").alias("c")).distinct()
    whole = F.when(F.col("kind") == "email", F.concat("surrogate", F.lit("@"), F.substring_index("canon", "@", -1))).otherwise(F.col("surrogate"))
    for _ in range(ATTEMPTS):
        tried = current.withColumn("whole", whole)
        first = tried.groupBy("kind", "whole").agg(F.min(F.struct("attempt", "canon")).alias("winner")).select(F.col("kind").alias("k1"), F.col("whole").alias("s1"), "winner")
        judged = (tried.join(first, (F.col("kind") == F.col("k1")) & (F.col("whole") == F.col("s1")))
                  .join(real, (among == F.col("k")) & (F.col("whole") == F.col("c")), "left"))
        clash = (F.col("canon") != F.col("winner.canon")) | F.col("c").isNotNull()
        judged = judged.select("kind", "canon", F.when(clash, F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt"), clash.alias("clash"), "surrogate")
        judged = T.store(judged, "judged")
        # only those that clash get another one
        following = T.store(_with_surrogates(judged.filter("clash").drop("surrogate").repartition(tasks, "kind", "canon"), key)
                            .unionByName(judged.filter("not clash")), "surrogates")
        T.drop(judged)
        clashes = following.filter("clash").limit(1).count()
        T.drop(current)
        current = following.drop("clash")
        if not clashes:
            T.drop(entities)
            return current.select("kind", "canon", "surrogate")
    raise ValueError(f"no distinct surrogates after {ATTEMPTS} attempts: a kind has nearly as many entities as possible surrogates")


def _script(s: Column) -> Column:
    return F.when(s.rlike(r"\p{IsCyrillic}"), "cyrillic").when(s.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


PART = r"[\p{L}\p{M}]{2,}"  # of a name; single letters (O', d') stay


def _names(mention: Column) -> tuple[Column, Column]:
    """Given name ('' if there is none) and surname of a titled name."""
    words = F.split(F.regexp_replace(mention, r"^\S+ ", ""), " ")
    return F.when(F.size(words) > 1, F.element_at(words, 1)).otherwise(""), F.element_at(words, -1)


def _mentions(found: DataFrame) -> DataFrame:
    """(mention, type, n, entities: array of (kind, canon)) of distinct ``found(mention, n)``."""
    m = F.col("mention")
    kind = None
    for name, pattern in PATTERNS.items():
        test = m.rlike(rf"^(?:{pattern})$")
        kind = F.when(test, name) if kind is None else kind.when(test, name)
    rows = found.withColumn("type", F.coalesce(kind, F.lit("other")))
    low, digits = F.lower(m), F.regexp_replace(m, r"[^0-9]", "")
    gender = F.lit("n")
    for g in "fm":
        gender = F.when(F.regexp_replace(F.substring_index(m, " ", 1), r"\.$", "").isin(TITLES[g]), g).otherwise(gender)

    def entity(k, canon):
        return F.struct((k if isinstance(k, Column) else F.lit(k)).alias("kind"), canon.alias("canon"))

    names = _names(m)
    given = F.transform(F.regexp_extract_all(names[0], F.lit(PART), F.lit(0)), lambda w: entity(F.concat_ws("-", F.lit("given"), _script(w), gender), F.lower(w)))
    surname = F.transform(F.regexp_extract_all(names[1], F.lit(PART), F.lit(0)), lambda w: entity(F.concat(F.lit("surname-"), _script(w)), F.lower(w)))
    entities = (F.when(F.col("type") == "email", F.array(entity("email", low), entity("domain", F.substring_index(low, "@", -1))))
                .when(F.col("type").isin("phone", "ssn", "card"), F.array(entity(F.col("type"), digits)))
                .when(F.col("type") == "name", F.concat(given, surname))
                .when((F.col("type") == "key") & m.rlike("^[0-9a-fA-F]+$"), F.array(entity("hex", low)))
                .when(F.col("type") == "iban", F.array(entity("iban", F.lower(F.regexp_replace(m, " ", "")))))
                .otherwise(F.array(entity(F.col("type"), low))))
    return rows.select("mention", "n", "type", entities.alias("entities"))


def _refilled(mention: Column, chars: Column, kept: str) -> Column:
    """``mention`` with its characters of class ``kept`` taken, in order, from ``chars``; those left over come last."""
    place = lambda i: F.length(F.regexp_replace(F.substr(mention, F.lit(1), i), rf"[^{kept}]", ""))
    filled = _chars(mention, lambda c, i: F.when(c.rlike(f"[{kept}]"), F.substr(chars, place(i), F.lit(1))).otherwise(c))
    return F.concat(filled, F.substr(chars, place(F.length(mention)) + 1))


def _cased(like: Column, s: Column) -> Column:
    """Each character of ``s`` in the case of ``like`` at its place."""
    return _chars(s, lambda c, i: F.when(F.substr(like, i, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c))


def replacements(found: DataFrame, key: str) -> DataFrame:
    """(mention, n, type, replacement) of distinct ``found(mention, n)``."""
    mentions = T.store(_mentions(found), "mentions")
    given = surrogates(mentions.select(F.explode("entities").alias("e")).select("e.kind", "e.canon").distinct(), key)
    parts = mentions.select("mention", "n", "type", F.posexplode("entities").alias("place", "e")).select("mention", "n", "type", "place", F.col("e.kind").alias("kind"), F.col("e.canon").alias("canon"))
    known = parts.join(given, ["kind", "canon"]).groupBy("mention", "n", "type").agg(F.map_from_entries(F.collect_list(F.struct("place", "surrogate"))).alias("s"))
    m, first, second = F.col("mention"), F.col("s")[0], F.col("s")[1]
    upper = (m == F.upper(m)) & (m != F.lower(m))
    email = F.concat(_cased(F.substring_index(m, "@", 1), first), F.lit("@"), F.when(upper, F.upper(second)).otherwise(second))
    # a name is its title, and the pieces around its parts with the parts' surrogates
    gaps = F.split(F.regexp_replace(m, r"^\S+ ", ""), PART, -1)
    name = F.concat(F.substring_index(m, " ", 1), F.lit(" "), F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.initcap(F.col("s")[i]), F.lit("")))), ""))
    out = (F.when(F.col("type") == "email", email).when(F.col("type").isin("phone", "ssn", "card"), _refilled(m, first, "0-9"))
           .when(F.col("type") == "iban", _refilled(m, F.upper(first), "A-Z0-9")).when(F.col("type") == "name", name)
           .when(F.col("type").isin("ip6", "key") & upper, F.upper(first)).otherwise(_cased(m, first)))
    tasks = T.partitions_for(found.sparkSession, mentions.count(), ENTITIES)
    resolved = T.store(known.repartition(tasks, "mention").select("mention", "n", "type", out.alias("replacement")), "resolved")
    T.drop(mentions, given)
    return resolved


# a mention has a digit, an @, the start of a secret key, a hex key without digits, or a title
SIGNS = ["@", "AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", *sorted({t for ts in TITLES.values() for t in ts})]
SIGNS = [x for x in SIGNS if not any(y != x and y in x for y in SIGNS)]
SIGN = "[0-9]|[a-fA-F]{32}"


def _may(text: Column) -> Column:
    """Whether ``text`` can hold a mention: false only for texts without one."""
    return F.coalesce(reduce(lambda a, x: a | F.contains(text, F.lit(x)), SIGNS[1:], F.contains(text, F.lit(SIGNS[0]))) | text.rlike(SIGN), F.lit(False))


def surrogated(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` as (row: struct of all columns but text, text with surrogates, n_mentions), one row per row."""
    if not key:
        raise ValueError("surrogates need a key")
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    rows = docs.select(rest, F.col("text"))
    tried = rows.filter(_may(F.col("text"))).withColumn("found", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    gaps = F.when(F.size("found") > 0, F.split("text", ANY, -1))
    tried = T.store(tried.select(F.monotonically_increasing_id().alias("uid"), "row", "found", gaps.alias("gaps"), F.when(F.size("found") == 0, F.col("text")).alias("text")), "found")
    some = tried.filter(F.size("found") > 0)
    counts = T.store(some.select(F.explode("found").alias("mention")).groupBy("mention").agg(F.count(F.lit(1)).alias("n")), "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    resolved = replacements(counts, key)
    T.drop(counts)
    is_hot = (F.col("n") * HOT_SHARE >= total) & (F.length("mention") <= HOT_LENGTH)
    # at most HOT_SHARE mentions have such a share of all occurrences
    hot, cold = (resolved.filter(x).select(F.col("mention").alias("m"), "replacement") for x in (is_hot, ~is_hot))
    pieces = (some.select("uid", "row", "gaps", F.posexplode("found").alias("at", "mention"))
              .select("uid", F.when(F.col("at") == 0, F.col("row")).alias("row"), F.when(F.col("at") == 0, F.element_at("gaps", -1)).alias("tail"), "at",
                      F.element_at("gaps", F.col("at") + 1).alias("gap"), "mention"))
    often = pieces.join(F.broadcast(hot), F.col("mention") == F.col("m"))
    seldom = pieces.join(F.broadcast(hot), F.col("mention") == F.col("m"), "left_anti").join(cold, F.col("mention") == F.col("m"))
    joined = often.select("uid", "row", "tail", "at", "gap", "replacement").unionByName(seldom.select("uid", "row", "tail", "at", "gap", "replacement"))
    whole = joined.groupBy("uid").agg(F.first("row", True).alias("row"), F.max("tail").alias("tail"),
                                      F.array_sort(F.collect_list(F.struct("at", F.concat("gap", "replacement").alias("piece")))).alias("pieces"))
    done = whole.select("row", F.concat(F.array_join(F.transform("pieces", lambda p: p["piece"]), ""), F.col("tail")).alias("text"), F.size("pieces").alias("n_mentions"))
    untouched = rows.filter(~_may(F.col("text"))).unionByName(tried.filter(F.size("found") == 0).select("row", "text"))
    return done.unionByName(untouched.withColumn("n_mentions", F.lit(0)))


def op7_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    key = spark.conf.get(KEY_SETTING, None) or secrets.token_hex(32)
    return surrogated(T.documents(spark, sf_dir), key).select(F.col("row.doc_id").alias("doc_id"), "text", "n_mentions")
