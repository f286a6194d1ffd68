"""Personal data: detection and keyed surrogates, in built-in functions only.

Detected entities (e-mail, IP, payment card, SSN, IBAN, phone, person names
after a title or with a known given name) get replacements of the same type,
script, gender and format. A surrogate is drawn from a keyed hash of the
entity's normal form, so every mention of it, in any format and document, gets
the same one (coreference). Draws that fall on another entity's surrogate, or
on any real entity, are drawn again until none is left (distinctness), from a
space that grows in the entity's own alphabet once its format is used up. Cards
and IBANs with right check digits get surrogates with right ones, IP addresses
get addresses, and a phone number with and without its country code 1 is one.

Defined cases: null texts stay null and empty ones empty, with 0 entities;
equal rows get equal results and all stay; other columns pass through; empty
tables give empty results; of overlapping patterns the leftmost, then the
first listed wins. Hot keys: a mention of a common entity is one small row;
entities are made distinct (pre-aggregated) before the surrogates are drawn,
and the join back can be split by Spark, being an equi-join on a unique side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Known titles (also in capitals) and given names by gender; names of other people need a title.
TITLES_M = ("Mr", "Herr", "Monsieur", "Señor", "Sir")
TITLES_F = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Lady")
TITLES_U = ("Dr", "Prof", "Professor", "Doctor")
GIVEN_M = ("John", "James", "Robert", "Michael", "William", "David", "Thomas", "Hans", "Peter",
           "Klaus", "Pierre", "Jean", "Luc", "Carlos", "José", "Juan", "Miguel", "Иван", "Пётр")
GIVEN_F = ("Mary", "Linda", "Susan", "Sarah", "Anna", "Emma", "Julia", "Marie", "Claire",
           "Sophie", "Ursula", "Petra", "María", "Carmen", "Lucía", "Мария", "Анна")

_NAME = r"\p{Lu}[\p{L}'-]+"
_TITLES = "|".join(t for title in TITLES_M + TITLES_F + TITLES_U for t in (title, title.upper()))
_TITLE = f"(?:{_TITLES})" + r"\.?"
_GIVEN = "(?:" + "|".join(GIVEN_M + GIVEN_F) + ")"

#: (kind, pattern), the first that matches a mention names its kind.
KINDS = (
    # a local part has 64 characters at most; of a longer run the last 64 count
    ("email", r"[\p{L}0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])"),
    ("iban", r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}"
             r"(?:[A-Z0-9]{1,3}| [0-9]{1,3})?(?![A-Z0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}(?![0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("phone", r"(?<![0-9])(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])"
              r"[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"),
    ("name", rf"(?<![\p{{L}}])(?:{_TITLE} {_NAME}(?: {_NAME})?|{_GIVEN} {_NAME})"),
)
PATTERN = "|".join(f"(?:{p})" for _, p in KINDS)
#: Every mention has one of these; texts without are not searched further.
HINT = r"[0-9@]|(?<![\p{L}])(?:" + "|".join((_TITLES, *GIVEN_M, *GIVEN_F)) + r")\b"

#: Draws in an entity's own length; later ones are longer by one place more each.
ROUNDS = 8
#: What holds a number above 255.
NO_OCTET = r"(?:^|\.)0*(?:2(?:5[6-9]|[6-9][0-9])|[3-9][0-9]{2})(?:\.|$)"
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
_SYLLABLES = {
    "latin": ("ba", "cor", "del", "fen", "gal", "hol", "jin", "kel", "lor", "mar", "nev", "or",
              "pel", "quin", "ros", "sel"),
    "cyrillic": ("ба", "кор", "дел", "фен", "гал", "хол", "жин", "кел", "лор", "мар", "нев", "ор",
                 "пел", "тин", "рос", "сел"),
}
_ENDINGS = {("latin", "m"): "o", ("latin", "f"): "ia", ("latin", "s"): "er", ("latin", "u"): "en",
            ("cyrillic", "m"): "ор", ("cyrillic", "f"): "ия", ("cyrillic", "s"): "ов",
            ("cyrillic", "u"): "ен"}


def mentions_of(text: Column) -> Column:
    """The mentions of a text, in order."""
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))) \
        .otherwise(F.array().cast("array<string>"))


def kind_of(mention: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def _name_parts(mention: Column) -> tuple[Column, Column]:
    """Given name and surname without title, empty where there is none."""
    bare = F.regexp_replace(mention, rf"^{_TITLE} ", "")
    two = F.instr(bare, " ") > 0
    given = F.when(two, F.substring_index(bare, " ", 1)).otherwise(F.lit(""))
    return given, F.when(two, F.substring_index(bare, " ", -1)).otherwise(bare)


def _gender(mention: Column) -> Column:
    title = F.initcap(F.regexp_extract(mention, rf"^({_TITLES})\.? ", 1))
    given = F.substring_index(mention, " ", 1)
    return (F.when(title.isin(*TITLES_M), "m").when(title.isin(*TITLES_F), "f")
            .when(given.isin(*GIVEN_M), "m").when(given.isin(*GIVEN_F), "f").otherwise("u"))


def units_of(mention: Column, kind: Column) -> Column:
    """The entities a mention refers to: (part, type, normal form).

    Numbers are their digits whatever the punctuation, a phone's without the
    country code 1 of eleven, e-mails and names are lower case. A name is a given name and a surname, so "Mr Smith" and "John
    Smith" share a surname; an e-mail is its address and its domain.
    """
    def unit(part: str, type_: Column, normal: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), type_.alias("type"), normal.alias("normal"))

    lower = F.lower(mention)
    given, family = _name_parts(mention)
    digits = F.regexp_replace(mention, "[^0-9]", "")
    names = F.filter(F.array(unit("given", F.concat(F.lit("given_"), _gender(mention)),
                                  F.lower(given)),
                             unit("family", F.lit("family"), F.lower(family))),
                     lambda u: u["normal"] != "")
    return (F.when(kind == "email", F.array(
                unit("local", F.lit("email"), lower),
                unit("domain", F.lit("domain"), F.substring_index(lower, "@", -1))))
            .when(kind == "name", names)
            .when(kind == "iban", F.array(unit("all", kind, F.regexp_replace(mention, " ", ""))))
            .when(kind == "ip", F.array(unit("all", kind, mention)))
            .when((kind == "phone") & _has_country(mention),
                  F.array(unit("all", kind, F.substring(digits, 2, 10))))
            .otherwise(F.array(unit("all", kind, digits))))


def _has_country(mention: Column) -> Column:
    """Whether a phone number is eleven digits with the country code 1."""
    return F.regexp_replace(mention, "[^0-9]", "").rlike("^1[0-9]{10}$")


def _mod97(iban: Column) -> Column:
    """The remainder of an IBAN's number, its first four characters moved to the end and
    letters counted from 10: 1 if the check digits are right."""
    moved = F.concat(F.substring(iban, 5, 100), F.substring(iban, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - F.lit(55)
        return F.when(c.rlike("[0-9]"), (rest * 10 + F.ascii(c) - 48) % 97) \
            .otherwise((rest * 100 + letter) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step)


def _checked_card(normal: Column, drawn: Column) -> Column:
    """``drawn`` with a last digit that passes the Luhn check if ``normal`` passes it."""
    stem = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    fits = F.filter(F.transform(F.split(F.lit("0123456789"), ""), lambda d: F.concat(stem, d)),
                    lambda card: F.call_function("luhn_check", card))
    return F.when(F.call_function("luhn_check", normal), F.element_at(fits, 1)).otherwise(drawn)


def _checked_iban(normal: Column, drawn: Column) -> Column:
    """``drawn`` with check digits that are right if those of ``normal`` are."""
    country, rest = F.substring(drawn, 1, 2), F.substring(drawn, 5, 100)
    digits = F.lpad((98 - _mod97(F.concat(country, F.lit("00"), rest))).cast("string"), 2, "0")
    return F.when(_mod97(normal) == 1, F.concat(country, digits, rest)).otherwise(drawn)


def _hash(key: str, type_: Column, normal: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), type_, normal, attempt.cast("string"))
                  .cast("binary"), 256)


def _at(h: Column, i: Column) -> Column:
    """The i-th hexadecimal digit, going round."""
    return F.substring(h, F.pmod(i, F.lit(64)).cast("int") + 1, F.lit(1))


def _like(text: Column, h: Column) -> Column:
    """Characters of the same class: digits by digits, letters by letters, others kept."""
    def one(c: Column, i: Column) -> Column:
        x = _at(h, i)
        pair = F.conv(F.concat(_at(h, 2 * i), _at(h, 2 * i + 1)), 16, 10).cast("int")
        letter = F.substring(F.lit(ALPHABET), F.pmod(pair, F.lit(26)) + 1, F.lit(1))
        return (F.when(c.rlike("[0-9]"), F.translate(x, "abcdef", "135792"))
                .when(c.rlike("[a-z]"), letter).when(c.rlike("[A-Z]"), F.upper(letter))
                .when(c.rlike(r"\p{L}"), F.translate(x, "0123456789abcdef", "áéíóúàèìòùâêîôûü"))
                .otherwise(c))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _draw(key: str, type_: Column, normal: Column, attempt: Column, rounds: int) -> Column:
    """A surrogate normal form, from ``rounds`` on longer with each attempt."""
    h = _hash(key, type_, normal, attempt)
    extra = F.greatest(attempt - F.lit(rounds - 1), F.lit(0)).cast("int")

    def octet(i: int) -> Column:
        return F.conv(F.substring(h, 1 + 2 * i, 2), 16, 10)

    cyrillic = normal.rlike(r"\p{IsCyrillic}")

    def name(script: str, end: str) -> Column:
        parts = [F.element_at(F.array(*map(F.lit, _SYLLABLES[script])),
                              F.conv(F.substring(h, 1 + i, 1), 16, 10).cast("int") + 1)
                 for i in range(3)]
        # later draws take a longer name, each of its syllables drawn, so that names never run out
        longer = F.transform(
            F.sequence(F.lit(0), attempt),
            lambda i: F.when(i > 0, F.element_at(
                F.array(*map(F.lit, _SYLLABLES[script])),
                F.conv(_at(h, i + 3), 16, 10).cast("int") + 1)).otherwise(F.lit("")))
        return F.concat(*parts, F.array_join(longer, ""), F.lit(_ENDINGS[script, end]))

    def either(end: str) -> Column:
        return F.when(cyrillic, name("cyrillic", end)).otherwise(name("latin", end))

    local = _like(F.concat(F.substring_index(normal, "@", 1), F.repeat(F.lit("a"), extra)), h)
    tld = F.substring_index(normal, ".", -1)
    stem = F.expr("substr(normal, 1, length(normal) - length(substring_index(normal, '.', -1)) - 1)")
    return (F.when(type_ == "email", local)
            .when(type_ == "domain", F.concat(
                _like(F.concat(stem, F.repeat(F.lit("a"), extra)), h), F.lit("."), tld))
            # an address is one unless it was none, or nearly all are taken
            .when((type_ == "ip") & ((extra > 24) | normal.rlike(NO_OCTET)), _like(F.lit("000.000.000.000"), h))
            .when(type_ == "ip", F.concat_ws(".", *[octet(i) for i in range(4)]))
            .when(type_ == "given_m", either("m")).when(type_ == "given_f", either("f"))
            .when(type_ == "given_u", either("u")).when(type_ == "family", either("s"))
            .when(type_ == "iban", F.concat(F.substring(normal, 1, 2),
                                            _like(F.concat(F.expr("substr(normal, 3)"),
                                                           F.repeat(F.lit("0"), extra)), h)))
            .otherwise(_like(F.concat(normal, F.repeat(F.lit("0"), extra)), h)))


def _drawn(key: str, rounds: int) -> Column:
    """``_draw`` for the columns type, normal and attempt, with right check digits."""
    type_, normal = F.col("type"), F.col("normal")
    return F.element_at(F.transform(
        F.array(_draw(key, type_, normal, F.col("attempt"), rounds)),
        lambda d: F.when(type_ == "card", _checked_card(normal, d))
        .when(type_ == "iban", _checked_iban(normal, d)).otherwise(d)), 1)


def draw_surrogates(entities: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """(type, normal, surrogate) of distinct (type, normal), distinct and never a real entity.

    An e-mail's surrogate is its local part, distinct among those of its domain
    and other than its own; the domain's surrogate is no real one, so neither
    is the address. An entity that found no free surrogate of its own length in
    ``rounds`` draws gets longer ones of the same characters, until all have one.
    """
    local = F.substring_index("normal", "@", 1)
    scope = F.when(F.col("type") == "email", F.substring_index("normal", "@", -1)) \
        .otherwise(F.lit(""))
    held = ["type", "scope", "surrogate"]
    real = entities.where("type <> 'email'").select(
        "type", F.lit("").alias("scope"), F.col("normal").alias("surrogate"))
    settled, open_ = None, entities.withColumn("attempt", F.lit(0))
    while True:
        drawn = open_.withColumn("scope", scope).withColumn(
            "surrogate", _drawn(key, rounds))
        # a draw is kept by the least entity that has it, if no earlier round took it
        first = drawn.where((F.col("type") != "email") | (F.col("surrogate") != local)) \
            .groupBy(*held).agg(F.min("normal").alias("owner"))
        taken = real if settled is None else real.unionByName(
            settled.select("type", scope.alias("scope"), "surrogate"))
        free = first.join(taken, held, "left_anti")
        judged = stored(drawn.join(free, held, "left")
                        .select("type", "normal", "attempt", "surrogate",
                                F.coalesce(F.col("owner") == F.col("normal"), F.lit(False))
                                .alias("ok")), "surrogates")
        good = judged.where("ok").select("type", "normal", "surrogate")
        settled = good if settled is None else settled.unionByName(good)
        open_ = judged.where("not ok").select("type", "normal", (F.col("attempt") + 1)
                                              .alias("attempt"))
        if open_.isEmpty():
            break
    return settled


def _shaped(surrogate: Column, like: Column) -> Column:
    """Case of ``like``: upper, title or lower."""
    first = F.substring(like, 1, 1)
    return (F.when((F.length(like) > 1) & (F.upper(like) == like) & (F.lower(like) != like),
                   F.upper(surrogate))
            .when(F.upper(first) == first, F.initcap(surrogate)).otherwise(surrogate))


def _in_format(mention: Column, digits: Column, chars: str) -> Column:
    """``digits`` put in place of the mention's characters of class ``chars``, in order."""
    n = F.length(F.regexp_replace(mention, f"[^{chars}]", ""))

    def one(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), f"[^{chars}]", ""))
        return F.when(c.rlike(f"[{chars}]"), F.substring(digits, before + 1, F.lit(1))).otherwise(c)

    body = F.array_join(F.transform(F.split(mention, ""), one), "")
    return F.concat(body, F.substring(digits, n + 1, F.length(digits)))


def replacements(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text_key, reps): the replacement of each mention of a text, in order."""
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.xxhash64(F.col("doc_id").cast("long"), "text").alias("text_key"),
                         F.posexplode(mentions_of(F.col("text"))).alias("i", "mention"))
             .withColumn("kind", kind_of(F.col("mention"))).distinct())
    units = stored(found.select("*", F.explode(units_of(F.col("mention"), F.col("kind")))
                                .alias("u"))
                   .select("doc_id", "text_key", "i", "mention", "kind", "u.part", "u.type",
                           "u.normal"), "mentions")
    surrogates = draw_surrogates(units.select("type", "normal").distinct(), key)
    met = units.join(surrogates, ["type", "normal"])
    parts = met.groupBy("doc_id", "text_key", "i", "mention", "kind").agg(
        F.map_from_entries(F.collect_list(F.struct("part", "surrogate"))).alias("s"))
    given, family = _name_parts(F.col("mention"))
    title = F.regexp_extract("mention", rf"^({_TITLE} )", 1)
    s = F.col("s")
    name = F.concat(title, F.coalesce(F.concat(_shaped(s["given"], given), F.lit(" ")), F.lit("")),
                    _shaped(s["family"], family))
    rep = (F.when(F.col("kind") == "email", F.concat(s["local"], F.lit("@"), s["domain"]))
           .when(F.col("kind") == "name", name).when(F.col("kind") == "ip", s["all"])
           .when(F.col("kind") == "iban", _in_format(F.col("mention"), s["all"], "A-Z0-9"))
           .when((F.col("kind") == "phone") & _has_country(F.col("mention")),
                 _in_format(F.col("mention"), F.concat(F.lit("1"), s["all"]), "0-9"))
           .otherwise(_in_format(F.col("mention"), s["all"], "0-9")))
    return parts.withColumn("rep", rep).groupBy("doc_id", "text_key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "rep"))), lambda x: x["rep"])
        .alias("reps"))


def with_surrogates(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every mention in ``text`` replaced; ``n_entities`` is added.

    A column ``n_entities`` of the input is replaced. Only rows with a mention
    are shuffled.
    """
    cols = [c for c in docs.columns if c != "n_entities"]
    has = F.coalesce(F.col("text").rlike(HINT), F.lit(False)) \
        & F.coalesce(F.col("text").rlike(PATTERN), F.lit(False))
    clean = docs.where(~has).select(*cols, F.lit(0).cast("long").alias("n_entities"))
    reps = replacements(docs.where(has), key)
    dirty = docs.where(has).withColumn(
        "__key", F.xxhash64(F.col("doc_id").cast("long"), "text"))
    pieces = F.split("text", PATTERN, -1)
    text = F.array_join(F.flatten(F.transform(
        F.arrays_zip(pieces.alias("p"), F.col("reps").alias("r")),
        lambda x: F.array(x["p"], F.coalesce(x["r"], F.lit(""))))), "")
    joined = dirty.join(reps, (dirty["__key"] == reps["text_key"])
                        & dirty["doc_id"].cast("long").eqNullSafe(reps["doc_id"])) \
        .select(*[dirty[c] for c in cols], "reps")
    done = joined.select(*[text.alias("text") if c == "text" else F.col(c) for c in cols],
                         F.size("reps").cast("long").alias("n_entities"))
    return clean.unionByName(done)
