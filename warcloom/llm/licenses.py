"""License scan: ordered signature rules over the words of a text.

A rule is a regular expression over the text's words, joined by single spaces, with a
keyword (some words, as rare as the rule has) that every match contains. A text is first
searched for single words of them; then only rules whose keyword occurs are matched. Each match is an interval of words. Where
intervals overlap, one that lies within another gives way to it, unless it belongs to a
rule of higher priority; of equal intervals the one of higher priority stays, then the
earlier rule. All of it is DataFrame functions on a row: no shuffle, no Python.

Words are runs of digits, a to z (after lowering A to Z) and characters outside ASCII.
Null and empty texts have no words and no detections. Very long texts are matched whole;
time grows with their length, and with their matches but for copying references to these.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.llm.common import ASCII_UPPER, without

#: The ASCII characters that are in no word: all but digits and letters.
SEPARATORS = "".join(c for c in map(chr, range(128)) if not c.isalnum())

#: Phrases and the labels that they stand for by themselves. Fixed values.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches whole words in a text of words joined by single spaces."""

    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float
    #: A word, or a part of one, by which texts are told that no match can be in.
    gate: str = ""


#: Names of licences: label, the words of the name, the versions it comes in.
FAMILIES = (
    ("apache", "apache(?: software)?", ("1 0", "1 1", "2 0")),
    ("gpl", "(?:gnu )?(?:general public|gpl)", ("1", "2", "3")),
    ("lgpl", "(?:gnu )?(?:lesser general public|library general public|lgpl)", ("2", "2 1", "3")),
    ("agpl", "(?:gnu )?(?:affero general public|agpl)", ("1", "3")),
    ("mpl", "(?:mozilla public|mpl)", ("1 0", "1 1", "2 0")),
    ("epl", "(?:eclipse public|epl)", ("1 0", "2 0")),
    ("cddl", "(?:common development and distribution|cddl)", ("1 0", "1 1")),
    ("eupl", "(?:european union public|eupl)", ("1 0", "1 1", "1 2")),
    ("artistic", "artistic", ("1 0", "2 0")),
    ("osl", "(?:open software|osl)", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "(?:academic free|afl)", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("cecill", "(?:cecill)", ("1 0", "1 1", "2 0", "2 1")),
    ("gfdl", "(?:gnu )?(?:free documentation|gfdl)", ("1 1", "1 2", "1 3")),
    ("boost", "boost(?: software)?", ("1 0",)),
    ("python", "(?:python software foundation|psf)", ("2",)),
    ("php", "php", ("3 0", "3 01")),
    ("zope", "zope public", ("1 1", "2 0", "2 1")),
    ("odbl", "(?:open database|odbl)", ("1 0",)),
    ("ofl", "(?:sil )?(?:open font|ofl)", ("1 0", "1 1")),
    ("bsl", "(?:business source|bsl)", ("1 0", "1 1")),
    ("sspl", "(?:server side public|sspl)", ("1",)),
    ("ms-pl", "microsoft public", ("1",)),
    ("ms-rl", "microsoft reciprocal", ("1",)),
    ("cpl", "common public", ("0 5", "1 0")),
    ("ipl", "ibm public", ("1 0",)),
)

#: Creative Commons: the clauses in words and letters, and the versions.
CC_CLAUSES = (
    ("by", "attribution"),
    ("by sa", "attribution share ?alike"),
    ("by nc", "attribution non ?commercial"),
    ("by nd", "attribution no ?deriv(?:ative)?s"),
    ("by nc sa", "attribution non ?commercial share ?alike"),
    ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
)
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Rules that follow no scheme: label, keyword, pattern, priority, weight, gate.
SINGLE = (
    ("mit", "mit", "mit license", 40, 0.9),
    ("mit", "mit", "(?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the )?mit license", 60, 1.0),
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software", 80, 1.0),
    ("mit", "spdx", "spdx license identifier mit", 90, 1.0),
    ("mit-0", "mit", "mit no attribution(?: license)?", 60, 1.0),
    ("isc", "isc", "isc license", 50, 0.9),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee", 80, 1.0),
    ("bsd", "bsd", "bsd (?:style )?license", 40, 0.8),
    ("bsd-2", "bsd", "(?:2|two) clause bsd(?: license)?", 60, 1.0),
    ("bsd-3", "bsd", "(?:3|three) clause bsd(?: license)?", 60, 1.0),
    ("bsd-4", "bsd", "(?:4|four) clause bsd(?: license)?", 60, 1.0),
    ("bsd-2", "bsd", "(?:simplified|freebsd) bsd license|bsd 2 clause(?: license)?", 60, 1.0),
    ("bsd-3", "bsd", "(?:new|modified|revised) bsd license|bsd 3 clause(?: license)?", 60, 1.0),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 80, 1.0),
    ("unlicense", "unlicense", "(?:the )?unlicense", 50, 0.9),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", 80, 1.0),
    ("public-domain", "domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", 50, 0.8),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?", 50, 0.9),
    ("wtfpl", "wtfpl", "wtfpl", 50, 0.9),
    ("zlib", "zlib", "zlib license", 50, 0.9),
    ("proprietary", "rights", "all rights reserved", 30, 0.4),
    ("proprietary", "proprietary", "proprietary and confidential|confidential and proprietary", 50, 0.8),
    ("gpl", "public", "general public license", 40, 0.9),
    ("apache", "apache", "apache license", 40, 0.9),
    ("cc", "commons", "creative commons(?: license)?", 30, 0.7),
    ("x11", "x11", "x11 license", 50, 0.9),
    ("openssl", "openssl", "openssl license", 50, 0.9),
    ("beerware", "beer", "beer ?ware license", 50, 0.8),
    ("ntp", "ntp", "ntp license", 50, 0.8),
    ("any", "license", "licensed under", 10, 0.2),
    # Texts of notices and licences that don't name themselves in the words above.
    ("mit", "without restriction", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish", 80, 1.0, "restriction"),
    ("mit", "above copyright", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 80, 1.0, "copyright"),
    ("mit", "as is", "the software is provided as is without warranty of any kind express or implied", 70, 0.8, "warranty"),
    ("isc", "as is", "the software is provided as is and the author disclaims all warranties", 80, 1.0, "disclaims"),
    ("bsd", "retain the above", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", 80, 1.0, "redistributions"),
    ("bsd", "binary form must", "redistributions in binary form must reproduce the above copyright notice", 80, 1.0, "redistributions"),
    ("bsd-3", "endorse or promote", "may be used to endorse or promote products derived from this software without specific prior written permission", 85, 1.0, "endorse"),
    ("bsd-4", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 85, 1.0),
    ("bsd", "regents", "the regents of the university of california", 40, 0.6),
    ("gpl", "free software foundation", "under the terms of the gnu general public license as published by the free software foundation", 80, 1.0, "foundation"),
    ("gpl-2.0", "version 2", "either version 2 of the license or at your option any later version", 75, 0.9, "licen"),
    ("gpl-3.0", "version 3", "either version 3 of the license or at your option any later version", 75, 0.9, "licen"),
    ("gpl", "free software you can", "this program is free software you can redistribute it and or modify it", 75, 0.9, "redistribute"),
    ("gpl", "fitness for", "without even the implied warranty of merchantability or fitness for a particular purpose", 60, 0.7, "merchantability"),
    ("gpl", "verbatim copies", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", 60, 0.8),
    ("lgpl", "lesser general", "gnu lesser general public license(?: as published)?", 60, 1.0),
    ("lgpl", "library is free", "this library is free software you can redistribute it and or modify it", 80, 1.0, "redistribute"),
    ("agpl", "affero", "gnu affero general public license(?: as published)?", 70, 1.0),
    ("agpl", "remotely through", "all users interacting with it remotely through a computer network", 80, 0.9, "remotely"),
    ("apache-2.0", "apache org", "www apache org licenses license 2 0", 85, 1.0),
    ("apache-2.0", "in compliance with", "you may not use this file except in compliance with the license", 75, 0.9, "compliance"),
    ("apache-2.0", "on an as is", "distributed on an as is basis without warranties or conditions of any kind", 75, 0.9, "warranties"),
    ("apache", "contributor license", "licensed to the apache software foundation asf under one or more contributor license agreements", 80, 1.0),
    ("mpl-2.0", "mozilla org", "mozilla org mpl 2 0", 85, 1.0),
    ("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public license v 2 0", 90, 1.0, "mozilla"),
    ("mpl-1.1", "mozilla public", "the contents of this file are subject to the mozilla public license version 1 1", 90, 1.0, "mozilla"),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license", 85, 1.0),
    ("cddl", "development and distribution", "subject to the terms of the common development and distribution license", 85, 1.0),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", 85, 1.0),
    ("zlib", "held liable", "in no event will the authors be held liable for any damages arising from the use of this software", 75, 0.9, "damages"),
    ("boost-1.0", "boost software", "distributed under the boost software license version 1 0", 85, 1.0, "boost"),
    ("wtfpl", "what the", "do what the fuck you want to public license", 85, 1.0, "fuck"),
    ("beerware", "buy me a", "you can buy me a beer in return", 80, 0.9, "beer"),
    ("unlicense", "unlicense org", "(?:refer|information) to (?:http )?unlicense org", 80, 1.0),
    ("cc0", "dedicated the work", "has dedicated the work to the public domain by waiving all of his or her rights", 85, 1.0),
    ("cc", "creativecommons org", "creativecommons org licenses", 60, 0.9),
    ("ofl-1.1", "scripts sil org", "scripts sil org ofl", 85, 1.0),
    ("gfdl", "invariant sections", "with no invariant sections no front cover texts and no back cover texts", 80, 0.9),
    ("public-domain", "public domain", "this (?:work|file|software|code) is in the public domain", 60, 0.9, "domain"),
    ("proprietary", "written", "without the (?:express |prior )*written (?:consent|permission) of", 40, 0.5),
    ("proprietary", "strictly prohibited", "unauthori[sz]ed (?:copying|use|distribution)(?: of this (?:file|software))?(?: via any medium)? is strictly prohibited", 60, 0.9),
)


def spellings(name: str) -> list[tuple[str, str]]:
    """(keyword, pattern) of each of the alternatives that a family's name has."""
    parts = re.fullmatch(r"((?:\(\?:[^)|]*\)\?)?)\(\?:([^)]*)\)", name)
    if parts:
        return [(one, parts[1] + one) for one in parts[2].split("|")]
    return [(re.sub(r"\(\?:[^)]*\)\?", "", name), name)]


def rules() -> tuple[Rule, ...]:
    """All rules, in their order: single ones, then those made from names and versions."""
    made = [Rule(*r) for r in SINGLE]
    for label, names, versions in FAMILIES:
        for keyword, name in spellings(names):
            add = lambda named, pattern, *more: made.append(Rule(named, keyword, pattern, *more, "licen"))  # noqa: B023,E731
            add(label, f"{name} licen[cs]e", 45, 0.9)
            add(label, f"licen[cs]ed under (?:the )?(?:terms of )?(?:the )?{name}(?: licen[cs]e)?", 55, 1.0)
            for version in versions:
                named = f"{label}-{version.replace(' ', '.')}"
                number = version if " " in version or label == "php" else f"{version}(?: 0)?"
                add(named, f"{name} licen[cs]e(?: version| v)? (?:v)?{number}", 65, 1.0)
                add(named, f"licen[cs]ed under (?:the )?(?:terms of )?(?:the )?{name} licen[cs]e(?: version| v)? {number}", 75, 1.0)
        for version in versions:
            named = f"{label}-{version.replace(' ', '.')}"
            short = named.replace(".", " ").replace("-", " ")
            made.append(Rule(named, f"identifier {short}", f"spdx license identifier {short}(?: only| or later)?", 90, 1.0, "spdx"))
    for letters, words in CC_CLAUSES:
        for version in CC_VERSIONS:
            named = f"cc-{letters.replace(' ', '-')}-{version.replace(' ', '.')}"
            made.append(Rule(named, f"cc {letters}", f"cc {letters} {version}", 65, 1.0, "cc"))
            made.append(Rule(named, f"cc {letters}", f"licen[cs]ed under (?:a |the )?cc {letters} {version}", 75, 1.0, "cc"))
            made.append(Rule(named, "creative commons", f"creative commons {words}(?: {version})(?: international| unported)?(?: licen[cs]e)?", 70, 1.0))
    return tuple(made)


def flattened(text: str) -> Column:
    """A text with A to Z lowered and a space for every character that is in no word."""
    body = F.coalesce(F.col(text), F.lit(""))
    return F.translate(body, ASCII_UPPER + SEPARATORS, ASCII_UPPER.lower() + " " * len(SEPARATORS))


def words_of(flat: str) -> Column:
    """The words of a flattened text."""
    return F.array_remove(F.split(F.col(flat), " ", -1), "")


def word_matches(joined: Column, pattern: Column) -> Column:
    """Matches of whole words as an array of (start, end), counted in words, end excluded.

    Matches are leftmost and don't overlap one another.
    """
    bounded = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    # Paired first: what a step looks at is computed once, not once a step.
    both = F.zip_with(
        F.split(joined, bounded, -1), F.regexp_extract_all(joined, bounded, F.lit(0)), lambda a, b: F.struct(a.alias("before"), b.alias("match"))
    )
    spaces = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("found"))

    def step(state: Column, e: Column) -> Column:
        start = state["at"] + spaces(e["before"])
        size = spaces(e["match"])
        span = F.struct((start - 1).cast("bigint").alias("start"), (start + size).cast("bigint").alias("end"))
        more = F.struct((start + size).alias("at"), F.concat(state["found"], F.array(span)).alias("found"))
        # Behind the last match there is only text.
        return F.when(e["match"].isNull(), state).otherwise(more)

    return F.aggregate(both, empty, step, lambda s: s["found"])


def unsuppressed(found: Column) -> Column:
    """The detections that no other one makes give way, by rule and place.

    In the order of starts, longer ones first and then by rank, whatever one gives way to
    comes before it, and ends no sooner. Those that ended are left behind on the way, so
    each is compared with the few around it.
    """
    ordered = F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("less"), (-d["priority"]).alias("below"), d["rule"].alias("rule"),
        d["label"].alias("label"), d["end"].alias("end"), d["priority"].alias("priority"), d["weight"].alias("weight"),
    )))
    kind = "array<struct<start:bigint,less:bigint,below:int,rule:int,label:string,end:bigint,priority:int,weight:double>>"
    none = F.array().cast(kind)

    def step(state: Column, d: Column) -> Column:
        near = F.filter(state["near"], lambda b: b["end"] > d["start"])
        same = lambda b: (b["start"] == d["start"]) & (b["end"] == d["end"])
        gives_way = F.exists(state["near"], lambda b: (b["end"] >= d["end"]) & (same(b) | (b["priority"] >= d["priority"])))
        out = F.when(gives_way, state["out"]).otherwise(F.concat(state["out"], F.array(d)))
        return F.struct(F.concat(near, F.array(d)).alias("near"), out.alias("out"))

    kept = F.aggregate(ordered, F.struct(none.alias("near"), none.alias("out")), step, lambda s: s["out"])
    by_rule = F.array_sort(F.transform(kept, lambda d: F.struct(d["rule"], d["start"], d["label"], d["end"], d["priority"], d["weight"])))
    return F.transform(by_rule, lambda d: F.struct(*[d[c].alias(c) for c in ("label", "start", "end", "priority", "weight")]))


def scan(docs: DataFrame, text: str = "text", table: tuple[Rule, ...] | None = None) -> DataFrame:
    """Add ``n_words`` (long), ``base`` and ``detections``.

    ``base``: array of (label, start, end), the places of the base phrases. ``detections``:
    array of (label, start, end, priority, weight), what is left of the rules' matches.
    """
    table = rules() if table is None else table
    results = ["n_words", "base", "detections"]
    source = docs.withColumn("__text", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    carried = [c for c in without(docs, results).columns]
    gate_of = lambda r: r.gate or max(r.keyword.split(" "), key=len)
    gates = sorted({gate_of(r) for r in table} | {phrase.split(" ")[-1] for phrase, _ in BASE})
    held = F.filter(F.array(*[F.lit(g) for g in gates]), lambda g: F.contains(F.col("__flat"), g))
    rule_rows = F.array(
        *[
            F.struct(
                F.lit(r.label).alias("label"), F.lit(gate_of(r)).alias("gate"), F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern"),
                F.lit(r.priority).alias("priority"), F.lit(float(r.weight)).alias("weight"), F.lit(k).alias("rule"),
            )
            for k, r in enumerate(table)
        ]
    )
    counted = source.withColumn("__flat", flattened("__text"))
    counted = counted.withColumn("__list", words_of("__flat")).withColumn("n_words", F.size("__list").cast("long"))
    gated = counted.withColumn("__gates", held)
    joined_words = F.concat(F.lit(" "), F.array_join("__list", " "), F.lit(" "))
    # Null where no gate is open: nothing further is done with such a text.
    gated = gated.withColumn("__words", F.when(F.size("__gates") > 0, joined_words))
    joined = F.col("__words")

    def spans(rule: Column) -> Column:
        return F.transform(
            word_matches(joined, rule["pattern"]),
            lambda s: F.struct(
                rule["label"].alias("label"), s["start"].alias("start"), s["end"].alias("end"),
                rule["priority"].alias("priority"), rule["weight"].alias("weight"), rule["rule"].alias("rule"),
            ),
        )

    alive = F.filter(rule_rows, lambda r: F.array_contains("__gates", r["gate"]) & F.contains(joined, r["keyword"]))
    found = F.flatten(F.transform(alive, spans))

    def places(phrase: str, label: str) -> Column:
        def named(s: Column) -> Column:
            return F.struct(F.lit(label).alias("label"), s["start"].alias("start"), s["end"].alias("end"))

        held = F.contains(joined, F.lit(f" {phrase} "))
        return F.when(held, F.transform(word_matches(joined, F.lit(phrase)), named)).otherwise(F.array().cast(none))

    none = "array<struct<label:string,start:bigint,end:bigint>>"
    base = F.flatten(F.array(*[places(phrase, label) for phrase, label in BASE]))
    marked = gated.withColumn("base", F.coalesce(F.when(joined.isNotNull(), base), F.array().cast(none)))
    marked = marked.withColumn("__found", F.when(joined.isNotNull(), found))

    shown = unsuppressed(F.col("__found"))
    kinds = "array<struct<label:string,start:bigint,end:bigint,priority:int,weight:double>>"
    done = marked.withColumn("detections", F.coalesce(shown, F.array().cast(kinds)))
    return done.select(*[F.col(f"`{c}`") for c in carried], *results)
