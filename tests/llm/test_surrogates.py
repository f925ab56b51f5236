"""Surrogates: what is found, formats, coreference and distinctness."""

import re
from string import ascii_lowercase as LETTERS

import regex
from pyspark.sql import functions as F

from warcloom.llm import surrogates
from warcloom.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
ROWS = [
    (1, "Call +1 (386) 555-3733 or +1-386-555-3733; A.b9@mail6.example.com, 25.86.162.211"),
    (2, "Mrs. Smith met Mr Smith, Frau Müller and госпожа Иванова; κύριος Παπας"),
    (3, "card 4242 4242 4242 4242 and 4242424242424242 123-45-6789"),
    (4, None),
    (5, ""),
    (6, "a.b9@mail6.example.com " + "filler é " * 20_000 + "Mrs Smith"),
    (6, "a.b9@mail6.example.com"),
    (7, "nobody here, 12 34"),
    (None, "x@y.de"),
    (None, "x@y.de"),
]


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(re.sub(r"\D", "", number))):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def test_replacements(text_rows):
    rows = surrogates.pseudonymized(text_rows(ROWS), "k").collect()
    assert len(rows) == len(ROWS) and rows[0].label == "x"
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    first = by_id[1][0]
    m = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1-(\d{3})-(\d{3})-(\d{4}); (\S+@\S+\.com), (\d+\.\d+\.\d+\.\d+)", first.text)
    assert m and m.groups()[:3] == m.groups()[3:6] != ("386", "555", "3733")
    assert re.fullmatch(r"[a-z]\.[a-z]\d@[a-z]{4}\d\.[a-z]{7}\.com", m[7]) and m[8] != "25.86.162.211"
    assert (first.n_entities, first.kinds) == (4, "email,ip,phone")
    people = re.fullmatch(r"Mrs\. (\w+) met Mr (\w+), Frau (\w+) and госпожа (\w+); κύριος (\w+)", by_id[2][0].text)
    assert people[1].endswith("ina") and people[2].endswith("o") and people[3].endswith("ina") and people[1] != people[3]
    assert people[4].endswith("ова") and people[5].endswith("ος")
    cards = re.fullmatch(r"card (4\d{3} \d{4} \d{4} \d{4}) and (4\d{15}) (\d{3}-\d{2}-\d{4})", by_id[3][0].text)
    assert cards[1].replace(" ", "") == cards[2] != "4242424242424242" and luhn(cards[2]) and cards[3] != "123-45-6789"
    long, short = sorted(by_id[6], key=lambda r: -len(r.text))
    assert long.text.startswith(short.text + " filler é") and short.text == m[7] and long.text.endswith(f"Mrs {people[1]}")
    assert [by_id[k][0].text for k in (4, 5, 7)] == [None, "", "nobody here, 12 34"]
    assert len({r.text for r in by_id[None]}) == 1 and by_id[None][0].n_entities == 1


def test_key_decides(text_rows):
    texts = lambda key: [r.text for r in surrogates.pseudonymized(text_rows(ROWS[:3]), key).orderBy("doc_id").collect()]
    assert texts("k") == texts("k") != texts("other")


def test_distinct_entities_stay_distinct(spark):
    """Single letters leave few forms, so candidates collide and are drawn again."""
    names = [f"{a}@{b}.de" for a in "abcdefghijklmno" for b in "abcdefghijklmno"]
    entities = spark.createDataFrame([("email", n) for n in names], "kind string, entity string")
    rows = surrogates.assign(entities, "k").collect()
    made = [r.surrogate for r in rows]
    assert sorted(r.entity for r in rows) == sorted(names)
    # 676 forms in all, of which 225 are real: no form may be used twice or be a real one.
    assert len(set(made)) == len(made)
    assert not set(made) & set(names)


def test_exhausted_forms_get_wider(spark):
    """Kinds of which every form, or almost every one, is a real entity."""
    entities = [("phone", f"+25{k}") for k in range(10)] + [("email", f"{a}@{b}.de") for a in LETTERS for b in LETTERS]
    entities += [("email", "_@-.de"), ("email", "%@-.de"), ("ssn", "123456789"), ("card", "4242424242424242"), ("ip", "25.86.162.211")]
    rows = surrogates.assign(spark.createDataFrame(entities, "kind string, entity string"), "k").collect()
    assert sorted((r.kind, r.entity) for r in rows) == sorted(entities)
    made = {(r.kind, r.surrogate) for r in rows}
    assert len(made) == len(entities) and not made & set(entities)


def test_wider_forms(spark):
    """What the draws beyond the usual ones give, and how it is written into a mention."""
    mentions = [("ip", "25.86.162.211"), ("phone", "+250 (12) 34-567"), ("phone", "(386) 555-3733"), ("ssn", "123-45-6789"), ("card", "4242 4242 4242 4242"), ("email", "A@B.DE")]
    frame = spark.createDataFrame(mentions, "kind string, value string")
    kind, entity = F.col("kind"), surrogates.canonical(F.col("kind"), F.col("value"))
    candidate = surrogates.surrogate(kind, entity, F.sha2(F.col("value"), 256), F.lit(surrogates.OWN_FORMS + 1))
    rows = frame.select("kind", "value", surrogates.rendered(kind, F.col("value"), candidate).alias("new")).collect()
    wanted = {
        "25.86.162.211": r"2001:db8(:[0-9a-f]{4}){6}", "+250 (12) 34-567": r"\+\d{3} \(\d\d\) \d\d-\d{5}",
        "(386) 555-3733": r"\(\d{3}\) \d{3}-\d{6}", "123-45-6789": r"\d{3}-\d\d-\d{6}",
        "4242 4242 4242 4242": r"4\d{3} \d{4} \d{4} \d{6}", "A@B.DE": r"[A-Z]{3}@[A-Z]\.DE",
    }
    assert len(rows) == len(wanted) and all(re.fullmatch(wanted[r.value], r.new) for r in rows), rows
    assert all(luhn(r.new) for r in rows if r.kind == "card")


def test_short_numbers_are_no_phones(text_rows):
    texts = [f"+25{k} points, a{k}@mail.example.com or +25{k} 12-34" for k in range(10)] + ["+1500 a@b.de, +683 4002, +6834002 and +250  1234567"]
    rows = surrogates.pseudonymized(text_rows(list(enumerate(texts))), "k").orderBy("doc_id").collect()
    for k, r in enumerate(rows[:10]):
        m = re.fullmatch(rf"\+25{k} points, [a-z]\d@[a-z]{{4}}\.[a-z]{{7}}\.com or \+25(\d) (\d\d)-(\d\d)", r.text)
        assert m and "".join(m.groups()) != f"{k}1234" and r.kinds == "email,phone"
    last = re.fullmatch(r"\+1500 [a-z]@[a-z]\.de, \+68(\d \d{4}), \+68(\d{5}) and \+250  1234567", rows[10].text)
    assert last and last[1].replace(" ", "") == last[2] != "34002"


def test_whole_names(text_rows):
    """All names behind a title, and those of the same text without one."""
    rows = [
        (1, "Mr. John Smith called. Mr Smith and John Smith's friend SMITH; a smith, Smithson, Mrs Smith."),
        (2, "Prof. Dr. Anna-Lena O'Neill met Dr Jane R. Doe and Frau Doe. Later Doe, O'Neill and A. left. Herr Dr. J. S. Bach"),
        (3, "Smith and John are not named here, x@y.de; Dr. no, Dear Sir I am, Mr"),
        (4, "Herr Ludwig van Beethoven, Mr John Smith Mrs Doe; van Beethoven; Dr Иванов"),
        (None, "Dr. Smith, dr. Smith. Smith-Jones"),
    ]
    texts = {r.doc_id: r for r in surrogates.pseudonymized(text_rows(rows), "k").collect()}
    word = r"([A-Z][a-z]+)"
    first = re.fullmatch(rf"Mr\. {word} {word} called\. Mr {word} and {word} {word}'s friend ([A-Z]+); a smith, Smithson, Mrs {word}\.", texts[1].text)
    john, smith, *others, woman = first.groups()
    assert others == [smith, john, smith, smith.upper()] and john != smith and john.endswith("o") and woman.endswith("ina")
    # Mentions: three with a title, and John, Smith and SMITH.
    assert not {john, smith} & {"John", "Smith"} and (texts[1].n_entities, texts[1].kinds) == (6, "person")
    two = re.fullmatch(
        rf"Prof\. Dr\. {word}-{word} O'{word} met Dr {word} ([A-Z])\. {word} and Frau {word}\. Later {word}, O'{word} and A\. left\. Herr Dr\. ([A-Z])\. ([A-Z])\. {word}",
        texts[2].text,
    )
    assert two[6] == two[7] == two[8] and two[6].endswith("ina") and two[3] == two[9] and two[1].endswith("en") and two[12].endswith("o")
    assert not set(two.groups()) & {"Anna", "Lena", "Neill", "Jane", "Doe", "Bach"}
    assert re.fullmatch(r"Smith and John are not named here, [a-z]@[a-z]\.de; Dr\. no, Dear Sir I am, Mr", texts[3].text)
    four = re.fullmatch(rf"Herr {word} van {word}, Mr {word} {word} Mrs {word}; van {word}; Dr (\w+)", texts[4].text)
    assert four[3] == john and four[4] == smith and four[5] == two[6] and four[2] == four[6] and four[7].endswith("ин")
    last = re.fullmatch(rf"Dr\. {word}, dr\. {word}\. {word}-Jones", texts[None].text)
    assert last[1] == last[2] == last[3] != "Smith"


def test_documents_table(spark):
    docs = table(spark, SF_DIR, "documents")
    simple = re.compile(r"[\w.%+-]+@[\w.-]+\.[a-z]{2,}|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])")
    before = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in surrogates.pseudonymized(docs, "k").collect():
        found = simple.findall(before[r.doc_id])
        assert not any(f in r.text for f in found) and (r.n_entities > 0 or r.text == before[r.doc_id])


def test_nothing(text_rows):
    made = surrogates.pseudonymized(text_rows([]), "k")
    assert made.count() == 0 and {"n_entities", "kinds"} <= set(made.columns)


def test_long_loops_end(spark, text_rows):
    turns = 100_000
    texts = ["x@" + "a." * turns + "com", "Mr " + "A. " * turns + "Smith", "Mr " * turns + "Smith", "Dr " * turns + "Mrs Jones", "x@" + "a." * 120 + "com"]
    found = {r.doc_id: r for r in surrogates.pseudonymized(text_rows(list(enumerate(texts))), key="k").collect()}
    # A host of that many parts is none.
    assert found[0].text == texts[0] and found[0].n_entities == 0
    for i in (1, 2, 3, 4):
        assert found[i].n_entities >= 1 and found[i].text != texts[i]
    assert "Smith" not in found[1].text and "Smith" not in found[2].text and "Jones" not in found[3].text
    assert found[2].text.startswith("Mr " * turns)


def java_like(pattern):
    return regex.compile(pattern.replace(r"\p{IsCyrillic}", r"\p{Cyrillic}").replace(r"\p{IsGreek}", r"\p{Greek}"))


def plain_replacer(texts, chosen):
    """Texts with the surrogates that the operator drew put in their place, one mention after the other."""
    titles = {t: sex for (sex, _), words in surrogates.TITLES.items() for t in words}
    every, part = java_like(surrogates.ANY), java_like(surrogates.PART)
    title = java_like("^" + surrogates._TITLES)
    script = lambda w: "cyrillic" if regex.match(r"\p{Cyrillic}", w) else "greek" if regex.match(r"\p{Greek}", w) else "latin"

    def kind(value):
        if "@" in value:
            return "email"
        for name, pattern in (("ip", r"[0-9]+([.][0-9]+){3}"), ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), ("card", surrogates.CARD)):
            if regex.fullmatch(pattern, value):
                return name
        return "person" if regex.match(r"\p{L}", value) else "phone"

    def sex_of(value):
        found = [titles[w.rstrip(".")] for w in title.match(value)[0].split(" ") if w]
        return next((s for s in found if s != "n"), "n")

    def cased(word, new):
        if len(word) == 1:
            new = new[0]
        return new if word.lower() == word else new.upper() if word.upper() == word and len(word) > 1 else new.capitalize()

    out = []
    for text in texts:
        people = [m[0] for m in every.finditer(text) if kind(m[0]) == "person"]
        first = {}
        for neutral in (False, True):
            for value in people:
                sex = sex_of(value)
                for name in part.findall(value[title.match(value).end() :]) if (sex == "n") == neutral else []:
                    first.setdefault(name.lower(), sex)

        def renamed(words, sex):
            def one(m):
                name = m[0].lower()
                if name not in first or (sex is None and len(name) == 1):
                    return m[0]
                entity = f"{sex if sex in ('f', 'm') else first[name]}|{script(name)}|{name}"
                new = chosen.get(("person", entity))
                return cased(m[0], new.split("|")[2]) if new else m[0]

            return part.sub(one, words)

        def replaced(value):
            what = kind(value)
            if what == "person":
                end = title.match(value).end()
                return value[:end] + renamed(value[end:], sex_of(value))
            number = regex.sub("[^0-9]", "", value)
            entity = {"email": value.lower(), "ip": value, "phone": ("+" if value[0] == "+" else "") + number}.get(what, number)
            new = chosen[what, entity]
            if what in ("email", "ip"):
                return new.upper() if what == "email" and value.upper() == value else new
            digits, places = regex.sub("[^0-9]", "", new), [i for i, c in enumerate(value) if c in "0123456789"]
            shown = dict(zip(places, [*digits[: len(places) - 1], digits[len(places) - 1 :]]))
            return "".join(shown.get(i, c) for i, c in enumerate(value))

        pieces, at = [], 0
        for m in every.finditer(text):
            pieces += [renamed(text[at : m.start()], None), replaced(m[0])]
            at = m.end()
        out.append("".join([*pieces, renamed(text[at:], None)]))
    return out


def test_a_plain_replacer_agrees(spark, text_rows, monkeypatch):
    drawn, real = {}, surrogates.assign

    def assign(entities, key):
        done = real(entities, key)
        drawn.update({(r.kind, r.entity): r.surrogate for r in done.collect()})
        return done

    monkeypatch.setattr(surrogates, "assign", assign)
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(9_000 + i, t) for i, (_, t) in enumerate(ROWS) if t] + [
        (9_100, "Dr. Ann Lee and Mrs Lee; later Lee, LEE and Ann. Mr J. Lee-Smith wrote to J."), (9_101, "госпожа Анна Иванова, Иванова; X@Y.DE x@y.de"),
    ]
    found = {r.doc_id: r.text for r in surrogates.pseudonymized(text_rows(rows), key="k").collect()}
    expected = plain_replacer([t for _, t in rows], drawn)
    wrong = [(i, e[:200], found[i][:200]) for (i, _), e in zip(rows, expected) if found[i] != e]
    assert not wrong, wrong[:2]
    assert len(drawn) > 20 and sum(found[i] != t for i, t in rows) > 10
