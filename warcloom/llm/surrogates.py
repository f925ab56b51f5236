"""Personal data replaced by surrogates: keyed, of the same kind and format, and distinct.

Detected are e-mail addresses, IP addresses, phone numbers, payment cards, social
security numbers and persons named with a title, by all names that follow it. Each name is
an entity of its own, and further mentions of it in the same text are replaced too. With a
title of no gender, or none, a name is that of a person of the text with a gender, where
there is one. Of other kinds, a mention's canonical form (digits
alone, lowered letters) is the entity, so differently written mentions of one entity
get the same surrogate, each in its own format: digits replace digits in place, letters
keep their case and script, a woman's name stays a woman's, a card stays a valid card.

A surrogate follows from a secret key, the kind and the canonical form. Candidates are
checked against one another and against all real entities of the table; an entity whose
candidate is taken draws again, and after some draws gets longer or wider forms, of which
there are always enough. So distinct entities stay distinct, and no surrogate is
somebody else's data. With one key, a table always gets the same surrogates.

A number behind a plus sign is a phone number from 7 digits on, the length of the
shortest international ones.

Null texts stay null. Rows equal in id and text get the same result, and rows without an
id are treated like others. All of it is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.llm.common import staged, without

#: Titles by gender and script, as they stand before a name. Fixed values.
TITLES = {
    ("f", "latin"): ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Lady"),
    ("m", "latin"): ("Mr", "Herr", "Monsieur", "Señor", "Signor", "Sir"),
    ("f", "cyrillic"): ("госпожа", "Госпожа"),
    ("m", "cyrillic"): ("господин", "Господин"),
    ("f", "greek"): ("κυρία", "Κυρία"),
    ("m", "greek"): ("κύριος", "Κύριος"),
    ("n", "latin"): ("Dr", "Prof", "Doctor", "Professor", "Mx"),
    ("n", "cyrillic"): ("доктор", "Доктор", "профессор", "Профессор"),
    ("n", "greek"): ("δρ", "Δρ"),
}
#: Syllables of invented names, and their endings by gender.
SYLLABLES = {
    "latin": ("bar", "den", "fal", "gor", "hel", "jun", "kar", "lom", "mar", "nel", "or", "per", "ros", "sal", "tor", "vel"),
    "cyrillic": ("бар", "ден", "фал", "гор", "хел", "юн", "кар", "лом", "мар", "нел", "ор", "пер", "рос", "сал", "тор", "вел"),
    "greek": ("βαρ", "δεν", "φαλ", "γορ", "χελ", "ιουν", "καρ", "λομ", "μαρ", "νελ", "ορ", "περ", "ροσ", "σαλ", "τορ", "βελ"),
}
ENDINGS = {
    ("f", "latin"): "ina", ("m", "latin"): "o", ("f", "cyrillic"): "ова", ("m", "cyrillic"): "ов",
    ("f", "greek"): "ου", ("m", "greek"): "ος", ("n", "latin"): "en", ("n", "cyrillic"): "ин", ("n", "greek"): "ης",
}

_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
#: Loops over groups are possessive or bounded: others call themselves once a turn.
_TITLES = rf"(?:(?:{_TITLE})[.]?\x20)++"
_LETTER = r"[\p{L}\p{M}]"
#: A name: no title, of two letters or more, and without the 's behind it.
_NAME = rf"(?!(?:{_TITLE})(?!{_LETTER}))(?:[dlDLO]['’])?\p{{Lu}}{_LETTER}++(?:['’-](?!s(?!{_LETTER})){_LETTER}++)*+"
#: What may stand before a name: initials and particles.
_BEFORE = r"(?:\p{Lu}(?:[.]-?\x20?|\x20)|(?:von|van|der|den|de|del|della|di|da|dos|du|zu|bin|ibn|al|el)\x20)*+"
PERSON = rf"(?<![\p{{L}}]){_TITLES}{_BEFORE}{_NAME}(?:\x20{_BEFORE}{_NAME})*+(?:\x20\p{{Lu}}(?=[.]))?"
#: The names and initials in what follows the titles; also the words that may be names.
PART = rf"(?<!{_LETTER})(?!{_LETTER}['’]{_LETTER})(?:\p{{Lu}}|(?<=['’-])\p{{L}}){_LETTER}*+"
#: Card numbers in groups of four, in the groups of 15 digits, or written together.
CARD = (
    r"[3-6][0-9]{3}(?:\x20[0-9]{4}){3}|[3-6][0-9]{3}(?:-[0-9]{4}){3}|"
    r"3[47][0-9]{2}[\x20-][0-9]{6}[\x20-][0-9]{5}|[3-6][0-9]{12,18}"
)
#: Seven digits, written as those of phone numbers are.
PLAUSIBLE = r"[(]?[0-9](?:[)]?[\x20.-]?[(]?[0-9]){6}"
#: In this order; a place belongs to the first that matches there. A host name has at most
#: 127 parts.
PATTERNS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+){0,125}[.][A-Za-z]{2,}"),
    ("ip", r"(?<![0-9.])(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:[.](?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}(?![0-9]|[.][0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("card", rf"(?<![0-9])(?:{CARD})(?![0-9])"),
    ("phone", rf"(?<![0-9+])[+](?={PLAUSIBLE})[0-9]{{1,3}}(?:[\x20.-]?[(]?[0-9]{{1,4}}[)]?){{2,5}}(?![0-9])"),
    ("phone", r"(?<![0-9(])[(]?[2-9][0-9]{2}[)]?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
    ("person", PERSON),
)
ANY = "|".join(f"(?:{p})" for _, p in PATTERNS)
#: What a text must have for any pattern to match: cheap to look for.
DIGITS = r"[0-9][0-9().\x20-]{5,}[0-9]"
#: Draws in the format of the entity itself; each further one adds to the forms.
OWN_FORMS = 8


def may_hold(text: Column) -> Column:
    found = F.contains(text, F.lit("@")) | F.regexp(text, F.lit(DIGITS))
    for titles in TITLES.values():
        for title in titles:
            found = found | F.contains(text, F.lit(title))
    return found


def kind_of(value: Column) -> Column:
    """The kind of a matched string."""
    choice = F.when(F.contains(value, F.lit("@")), "email").when(F.regexp(value, F.lit(r"^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$")), "ip")
    choice = choice.when(F.regexp(value, F.lit(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$")), "ssn")
    choice = choice.when(F.regexp(value, F.lit(rf"^(?:{CARD})$")), "card")
    return choice.when(F.regexp(value, F.lit(r"^\p{L}")), "person").otherwise("phone")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, F.lit("[^0-9]"), F.lit(""))


def canonical(kind: Column, value: Column) -> Column:
    """What identifies the entity of a mention; for persons see ``name_entities``."""
    plus = F.when(F.startswith(value, F.lit("+")), F.lit("+")).otherwise(F.lit(""))
    number = F.concat(plus, digits(value))
    return (
        F.when(kind == "email", F.lower(value)).when(kind == "ip", value)
        .when(kind == "phone", number).otherwise(digits(value))
    )


def gender(value: Column) -> Column:
    """That of the first title that has one: f, m, or n."""
    neutral = "|".join(t for (sex, _), titles in TITLES.items() if sex == "n" for t in titles)
    choice = F.when(F.lit(False), F.lit(""))
    for (sex, _), titles in TITLES.items():
        if sex != "n":
            choice = choice.when(F.regexp(value, F.lit(rf"^(?:(?:{neutral})[.]?\x20)*+(?:{'|'.join(titles)})[.]?\x20")), F.lit(sex))
    return choice.otherwise(F.lit("n"))


def script(name: Column) -> Column:
    choice = F.when(F.regexp(name, F.lit(r"^\p{IsCyrillic}")), F.lit("cyrillic"))
    return choice.when(F.regexp(name, F.lit(r"^\p{IsGreek}")), F.lit("greek")).otherwise(F.lit("latin"))


def titles_of(value: Column) -> Column:
    return F.regexp_extract(value, rf"^({_TITLES})", 1)


def names_of(value: Column) -> Column:
    """What follows the titles of a person."""
    return F.substring(value, F.length(titles_of(value)) + 1, F.length(value))


def name_entities(mention: DataFrame) -> DataFrame:
    """``__id``, ``__hash``, ``value``, ``entity``: the names in the persons of each text.

    ``value`` is what a name is looked up by, gender and lowered name, or the name alone
    for mentions without a title. Initials aren't looked up without one.
    """
    part = F.explode(F.array_distinct(F.transform(F.regexp_extract_all(names_of(F.col("value")), F.lit(PART), F.lit(0)), lambda w: F.lower(w))))
    each = mention.select("__id", "__hash", "at", gender(F.col("value")).alias("sex"), part.alias("name"))
    # The first mention with a gender decides for those without one.
    best = F.min(F.struct((F.col("sex") == "n").alias("neutral"), "at", "sex")).alias("best")
    of_name = each.groupBy("__id", "__hash", "name").agg(F.collect_set("sex").alias("sexes"), best)
    first = F.col("best.sex")
    asked = F.when(F.length("name") > 1, F.concat("sexes", F.array(F.lit("")))).otherwise(F.col("sexes"))
    looked_up = of_name.select("__id", "__hash", "name", first.alias("first"), F.explode(asked).alias("sex"))
    used = F.when(F.col("sex").isin("f", "m"), F.col("sex")).otherwise(F.col("first"))
    return looked_up.select(
        "__id", "__hash", F.concat_ws("|", "sex", "name").alias("value"), F.concat_ws("|", used, script(F.col("name")), "name").alias("entity")
    )


def draw(seed: Column, place: Column | int, n: int) -> Column:
    """A number below n from a seed and a place."""
    at = F.lit(place) if isinstance(place, int) else place
    return F.pmod(F.xxhash64(seed, at), F.lit(n)).cast("int")


def shaped(text: Column, seed: Column) -> Column:
    """Letters a to z and digits replaced by others of their class, the rest as it is."""

    def char(i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        letter = F.chr(F.lit(97) + draw(seed, i, 26))
        return F.when(F.regexp(c, F.lit("[a-z]")), letter).when(F.regexp(c, F.lit("[0-9]")), draw(seed, i, 10).cast("string")).otherwise(c)

    letters = F.transform(F.sequence(F.lit(1), F.length(text)), char)
    return F.when(F.length(text) > 0, F.array_join(letters, "")).otherwise(F.lit(""))


def luhn_rest(number: Column) -> Column:
    """The sum of Luhn's formula over digits, modulo 10; 0 for valid numbers."""

    def step(total: Column, i: Column) -> Column:
        digit = F.substring(F.reverse(number), i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), step) % 10


def surrogate(kind: Column, entity: Column, seed: Column, attempt: Column) -> Column:
    """A candidate for the canonical form of an entity's surrogate.

    From the attempt ``OWN_FORMS`` on, forms get wider: phone numbers get another country
    code, and with each attempt one more digit, as cards and social security numbers do;
    e-mails get one more letter, and IP addresses are of the IPv6 range for documentation.
    Persons get more syllables anyway.
    """
    further = attempt - F.lit(OWN_FORMS) + 1
    wide = further > 0

    def more(char: Callable[[Column], Column]) -> Column:
        return F.when(wide, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), further)), char), "")).otherwise(F.lit(""))

    more_digits = more(lambda i: draw(seed, F.lit(1000) + i, 10).cast("string"))
    more_letters = more(lambda i: F.chr(F.lit(97) + draw(seed, F.lit(1000) + i, 26)))
    host = F.regexp_extract(entity, "@(.*)[.][a-z]+$", 1)
    email = F.concat(
        shaped(F.substring_index(entity, "@", 1), F.concat(seed, F.lit("l"))), more_letters, F.lit("@"),
        shaped(host, F.sha2(F.concat(seed, F.lit("h")), 256)), F.lit("."), F.substring_index(entity, ".", -1),
    )
    ip = F.concat_ws(".", (F.lit(11) + draw(seed, 1, 89)).cast("string"), *[draw(seed, k, 256).cast("string") for k in (2, 3, 4)])
    groups = F.regexp_extract_all(F.substring(F.sha2(seed, 256), 1, 24), F.lit("[0-9a-f]{4}"), F.lit(0))
    ip = F.when(wide, F.concat(F.lit("2001:db8:"), F.array_join(groups, ":"))).otherwise(ip)
    # Phone numbers keep their country code; area and exchange don't begin with 0 or 1.
    code = F.regexp_extract(entity, "^([+](?:1|7|[2-689][0-9]))", 1)
    code = F.when(wide, F.regexp_extract(entity, "^([+]?)", 1)).otherwise(code)
    rest = F.substring(entity, F.length(code) + 1, F.lit(40))
    drawn = shaped(rest, seed)
    first = lambda c: F.translate(c, "01", "23")
    phone = F.concat(
        code, first(F.substring(drawn, 1, 1)), F.substring(drawn, 2, 2), first(F.substring(drawn, 4, 1)),
        F.substring(drawn, F.lit(5), F.lit(40)), more_digits,
    )
    body = F.concat(F.substring(entity, 1, 1), shaped(F.substring(entity, F.lit(2), F.length(entity) - 2), seed), more_digits)
    # The last digit makes the number valid if the real one is.
    check = F.pmod(F.lit(10) - luhn_rest(F.concat(body, F.lit("0"))), F.lit(10))
    card = F.concat(body, F.when(luhn_rest(entity) == 0, check).otherwise(draw(seed, 99, 10)).cast("string"))
    ssn = F.concat(shaped(entity, seed), more_digits)
    parts = F.split(entity, "[|]")
    person = F.when(F.lit(False), F.lit(""))
    for (sex, writing), ending in ENDINGS.items():
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[writing]])
        count = F.lit(2) + F.floor(attempt / 3).cast("int")
        stem = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.get(syllables, draw(seed, i, 16))), "")
        name = F.concat_ws("|", F.lit(sex), F.lit(writing), F.concat(stem, F.lit(ending)))
        person = person.when((F.get(parts, F.lit(0)) == sex) & (F.get(parts, F.lit(1)) == writing), name)
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", phone)
        .when(kind == "card", card).when(kind == "ssn", ssn).otherwise(person)
    )


def in_place(value: Column, number: Column) -> Column:
    """The digits of a mention replaced one by one, its signs as they are; the last by all that are left."""
    last = F.length(digits(value))

    def char(i: Column) -> Column:
        c = F.substring(value, i, F.lit(1))
        at = F.length(digits(F.substring(value, F.lit(1), i)))
        return F.when(F.regexp(c, F.lit("[0-9]")), F.substring(number, at, F.when(at == last, F.length(number)).otherwise(F.lit(1)))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), char), "")


def rendered(kind: Column, value: Column, replacement: Column) -> Column:
    """A surrogate in the format of a mention; for persons, the name as it is looked up."""
    local = F.when(F.upper(value) == value, F.upper(replacement)).otherwise(replacement)
    person = F.get(F.split(replacement, "[|]"), F.lit(2))
    numbers = in_place(value, digits(replacement))
    return F.when(kind == "email", local).when(kind == "ip", replacement).when(kind == "person", person).otherwise(numbers)


def renamed(text: Column, sex: Column, lookup: Column) -> Column:
    """Names of a text replaced as far as they are known, in the case in which they stand there."""

    def name(word: Column) -> Column:
        new = F.element_at(lookup, F.concat_ws("|", sex, F.lower(word)))
        short = F.length(word) == 1
        new = F.when(short, F.substring(new, 1, 1)).otherwise(new)
        cased = F.when(F.lower(word) == word, new).when((F.upper(word) == word) & ~short, F.upper(new)).otherwise(F.initcap(new))
        return F.coalesce(cased, word)

    words = F.transform(F.regexp_extract_all(text, F.lit(PART), F.lit(0)), name)
    return F.array_join(F.zip_with(F.split(text, F.lit(PART), -1), words, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def n_renamed(text: Column, lookup: Column) -> Column:
    """How many names without a title a text holds."""
    words = F.regexp_extract_all(text, F.lit(PART), F.lit(0))
    return F.size(F.filter(words, lambda w: F.element_at(lookup, F.concat(F.lit("|"), F.lower(w))).isNotNull()))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``entity``, ``surrogate`` for distinct entities; surrogates are distinct.

    Round by round: what collides with an earlier surrogate, with a real entity, or with
    a smaller entity's candidate draws again. More than a few rounds are only needed
    where a kind has almost as many entities as there are forms; from ``OWN_FORMS`` on,
    the forms multiply with each round, so all entities are settled soon.
    """
    # Some hundred draws a row: a small table is spread over the cluster as well.
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entities = staged(entities.repartition(tasks, "kind", "entity"), "entities")
    pending, done = entities.withColumn("attempt", F.lit(0)), None
    while True:
        seed = F.sha2(F.concat_ws("\x00", F.lit(key), "kind", "entity", F.col("attempt").cast("string")), 256)
        made = staged(
            pending.select("kind", "entity", "attempt", surrogate(F.col("kind"), F.col("entity"), seed, F.col("attempt")).alias("surrogate")),
            "candidates",
        )
        real = entities.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("taken"))
        before = real if done is None else real.union(done.select("kind", "surrogate", F.lit(True)))
        first = made.groupBy("kind", "surrogate").agg(F.min("entity").alias("first"))
        judged = made.join(first, ["kind", "surrogate"]).join(before.distinct(), ["kind", "surrogate"], "left")
        free = F.col("taken").isNull() & (F.col("entity") == F.col("first"))
        judged = staged(judged.select("kind", "entity", "attempt", "surrogate", free.alias("free")), "judged")
        settled = judged.filter("free").select("kind", "entity", "surrogate")
        done = settled if done is None else done.union(settled)
        pending = judged.filter("NOT free").select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return done


def pseudonymized(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with surrogates in ``text``; adds ``n_entities`` and ``kinds``.

    ``n_entities`` (long) counts mentions, those of persons without a title too, ``kinds`` (string) lists their kinds, sorted.
    """
    kept = without(docs, ["n_entities", "kinds"])
    body = F.col(f"`{text}`")
    holds = F.coalesce(may_hold(body), F.lit(False))
    values = F.when(holds, F.regexp_extract_all(body, F.lit(ANY), F.lit(0)))
    marked = kept.withColumn("__values", F.coalesce(values, F.array().cast("array<string>")))
    some = marked.filter(F.size("__values") > 0).withColumn("__hash", F.xxhash64(body))

    mention = some.select(F.col(f"`{doc_id}`").alias("__id"), "__hash", F.posexplode(F.array_distinct("__values")).alias("at", "value"))
    mention = mention.withColumn("kind", kind_of(F.col("value")))
    mention = staged(mention, "found")
    plain = mention.filter("kind <> 'person'").drop("at").withColumn("entity", canonical(F.col("kind"), F.col("value")))
    people = name_entities(mention.filter("kind = 'person'")).withColumn("kind", F.lit("person"))
    mention = staged(plain.unionByName(people).distinct(), "mentions")
    chosen = staged(assign(mention.select("kind", "entity").distinct(), key), "surrogates")
    shown = mention.join(chosen, ["kind", "entity"]).select(
        "__id", "__hash", "kind", "value", rendered(F.col("kind"), F.col("value"), F.col("surrogate")).alias("new")
    )
    of_text = staged(
        shown.groupBy("__id", "__hash").agg(F.collect_list(F.struct("value", "new")).alias("__new"), F.collect_set("kind").alias("__kinds")),
        "replacements",
    ).withColumnRenamed("__hash", "__own")
    met = some.join(of_text, (F.col(f"`{doc_id}`").eqNullSafe(F.col("__id"))) & (F.col("__hash") == F.col("__own")))
    between = F.split(body, F.lit(ANY), -1)
    lookup = F.map_from_entries("__new")

    def replaced(value: Column) -> Column:
        person = F.concat(titles_of(value), renamed(names_of(value), gender(value), lookup))
        return F.when(kind_of(value) == "person", person).otherwise(F.element_at(lookup, value))

    named = F.array_contains("__kinds", "person")
    rest = F.when(named, F.transform(between, lambda b: renamed(b, F.lit(""), lookup))).otherwise(between)
    further = F.when(named, F.aggregate(between, F.lit(0), lambda n, b: n + n_renamed(b, lookup))).otherwise(F.lit(0))
    pieces = F.zip_with(rest, F.transform("__values", replaced), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    columns = [F.col(f"`{c}`") for c in kept.columns if c.lower() != text.lower()]
    changed = met.select(
        *columns, F.array_join(pieces, "").alias(text), (F.size("__values") + further).cast("long").alias("n_entities"),
        F.array_join(F.array_sort("__kinds"), ",").alias("kinds"),
    )
    same = marked.filter(F.size("__values") == 0).select(
        *columns, body.alias(text), F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds")
    )
    return changed.unionByName(same)
