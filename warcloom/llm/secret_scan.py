"""Secret scan: regular expressions behind an inverted index of trigrams.

From each rule's expression follows a Boolean query: trigrams that every match contains,
as an AND of ORs of ANDs. The index has, for each block of documents and each trigram
that some query names, the list of the documents in which it occurs (A to Z lowered).
Postings are intersected and united as the query says; documents that remain are the
rule's candidates and are verified by the expression itself. Rules without mandatory
trigrams are matched against every text. All of it is DataFrame functions.

Documents are known by ``doc_id``. Rows that share one are candidates together, and each
is verified by itself; rows without one are verified against all rules. Null and empty
texts hold nothing. Positions count code points from 0, the end excluded.

A block holds some thousand documents whatever the size of the table, so the lists of
one block fit a task. The hash of the id chooses the block; equal ids count once in it.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.llm.common import ascii_lower, staged, without

DOCUMENTS_PER_BLOCK = 4_096
#: Most strings that a part of an expression may stand for and still be spelled out.
SPELLED_OUT = 48


@dataclass(frozen=True)
class Rule:
    """An expression; ``value`` is the group that must have ``least`` characters."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 0


#: The kinds asked for by name, in their order. Fixed values.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    # Runs below the length hold no match at all, so the length may stand in the expression.
    Rule("hex", "[0-9a-f]{24,}", 0, 24),
)
#: Published formats of tokens and keys. Fixed values.
MORE = (
    Rule("aws_session", "(?:ASIA|ABIA|ACCA)[A-Z0-9]{16}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("github_fine", "github_pat_[A-Za-z0-9_]{22,}"),
    Rule("gitlab", "glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("slack_hook", "https://hooks[.]slack[.]com/services/[A-Za-z0-9/]{20,}"),
    Rule("stripe", "(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("google_api", "AIza[A-Za-z0-9_-]{35}"),
    Rule("google_oauth", "ya29[.][A-Za-z0-9_-]{20,}"),
    Rule("npm", "npm_[A-Za-z0-9]{36}"),
    Rule("pypi", "pypi-[A-Za-z0-9_-]{50,}"),
    Rule("sendgrid", "SG[.][A-Za-z0-9_-]{16,}[.][A-Za-z0-9_-]{16,}"),
    Rule("digitalocean", "do[opr]_v1_[a-f0-9]{64}"),
    Rule("shopify", "shp(?:at|ca|pa|ss)_[a-fA-F0-9]{32}"),
    Rule("telegram", "[0-9]{8,10}:AA[A-Za-z0-9_-]{33}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{10,}[.]eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}"),
    Rule("private_key", "-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("url_login", "[a-z]{3,10}://[A-Za-z0-9_.-]+:[A-Za-z0-9_.!$-]{3,}@[A-Za-z0-9.-]+"),
    Rule("bearer", "Bearer [A-Za-z0-9_.=-]{20,}"),
    Rule("azure_key", "AccountKey=[A-Za-z0-9+/]{60,}={0,2}"),
)
RULES = BASE + MORE

#: An AND of clauses; a clause is an OR of alternatives, each a set of trigrams.
Query = tuple[tuple[frozenset[str], ...], ...]


def _strings(node: tuple) -> set[str] | None:
    """The strings that a part of an expression stands for, lowered; None if too many."""
    from re import _constants as c

    kind, value = node
    if kind is c.LITERAL:
        return {chr(value).lower()}
    if kind is c.IN:
        found: set[str] = set()
        for item, v in value:
            if item is c.LITERAL:
                found.add(chr(v).lower())
            elif item is c.RANGE and v[1] - v[0] < SPELLED_OUT:
                found |= {chr(x).lower() for x in range(v[0], v[1] + 1)}
            else:
                return None
        return found if len(found) <= 6 else None
    if kind is c.SUBPATTERN:
        return _product(list(value[3]))
    if kind is c.BRANCH:
        parts = [_product(list(p)) for p in value[1]]
        return None if None in parts else set().union(*parts)
    if kind is c.MAX_REPEAT and value[1] <= 2:
        once = _product(list(value[2]))
        if once is not None:
            return set().union(*({"".join(p) for p in itertools.product(once, repeat=n)} for n in range(value[0], value[1] + 1)))
    return {""} if kind is c.AT else None


def _product(nodes: list[tuple]) -> set[str] | None:
    out = {""}
    for node in nodes:
        strings = _strings(node)
        if strings is None or len(out) * len(strings) > SPELLED_OUT:
            return None
        out = {a + b for a, b in itertools.product(out, strings)}
    return out


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> Query:
    """The trigrams that every match of an expression contains; empty if there are none."""
    import re._parser as parser
    from re import _constants as c

    clauses: list[tuple[frozenset[str], ...]] = []

    def close(strings: set[str]) -> set[str]:
        if min(map(len, strings)) >= 3:
            sets = {trigrams(s) for s in strings}
            # An alternative that asks for more than another adds nothing.
            least = [s for s in sets if not any(o < s for o in sets)]
            clauses.append(tuple(sorted(least, key=sorted)))
        return {""}

    def walk(nodes: list[tuple], run: set[str]) -> set[str]:
        for node in nodes:
            strings = _strings(node)
            if strings is not None and len(run) * len(strings) <= SPELLED_OUT:
                run = {a + b for a, b in itertools.product(run, strings)}
                continue
            run = close(run)
            if strings is not None:
                run = strings
            elif node[0] is c.SUBPATTERN:
                run = close(walk(list(node[1][3]), run))
            elif node[0] is c.MAX_REPEAT and node[1][0] >= 1:
                close(walk(list(node[1][2]), {""}))
        return run

    close(walk(list(parser.parse(pattern)), {""}))
    return tuple(clauses)


def queries(rules: tuple[Rule, ...]) -> dict[int, Query]:
    """The trigram queries of the rules that have one, by the rule's place."""
    found = {k: trigram_query(r.pattern) for k, r in enumerate(rules)}
    return {k: q for k, q in found.items() if q}


def trigram_index(docs: DataFrame, wanted: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings: ``block``, ``trigram``, ``ids`` (documents that hold it, sorted)."""
    rows = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), ascii_lower(text).alias("lower"))
    blocks = max(1, -(-docs.count() // DOCUMENTS_PER_BLOCK))
    vocabulary = F.array(*[F.lit(t) for t in wanted])
    held = rows.select(
        "id",
        F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
        F.explode(F.filter(vocabulary, lambda t: F.contains(F.col("lower"), t))).alias("trigram"),
    )
    return held.groupBy("block", "trigram").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def candidates(postings: DataFrame, asked: dict[int, Query]) -> DataFrame:
    """``id`` and ``rules``: the documents that satisfy the queries, and of which rules."""
    lists = F.map_from_entries(F.collect_list(F.struct("trigram", "ids")))
    by_block = postings.groupBy("block").agg(lists.alias("lists"))
    none = F.filter(F.flatten(F.map_values("lists")), lambda _: F.lit(False))

    def posting(trigram: str) -> Column:
        return F.coalesce(F.try_element_at("lists", F.lit(trigram)), none)

    def satisfied(query: Query) -> Column:
        clauses = []
        for clause in query:
            alternatives = [reduce(F.array_intersect, [posting(t) for t in sorted(a)]) for a in clause]
            clauses.append(reduce(F.array_union, alternatives))
        return reduce(F.array_intersect, clauses)

    pairs = F.array(*[F.struct(F.lit(k).alias("rule"), satisfied(q).alias("ids")) for k, q in asked.items()])
    each = by_block.select(F.explode(pairs).alias("p")).select("p.rule", F.explode("p.ids").alias("id"))
    return each.groupBy("id").agg(F.array_sort(F.collect_set("rule")).alias("rules"))


def matches(text: Column, pattern: Column, value: Column) -> Column:
    """Leftmost matches that don't overlap: array of (start, end, size of a group)."""
    # Paired first: what a step looks at is computed once, not once a step.
    match = F.zip_with(
        F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, value),
        lambda a, b: F.struct(F.length(a).alias("length"), F.length(b).alias("size")),
    )
    both = F.zip_with(F.split(text, pattern, -1), match, lambda a, b: F.struct(F.length(a).alias("before"), b.alias("match")))
    kinds = "array<struct<start:bigint,end:bigint,size:int>>"
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(kinds).alias("found"))

    def step(state: Column, e: Column) -> Column:
        start = state["at"] + e["before"]
        end = start + e["match"]["length"]
        span = F.struct(start.alias("start"), end.alias("end"), e["match"]["size"].alias("size"))
        more = F.struct(end.alias("at"), F.concat(state["found"], F.array(span)).alias("found"))
        # Behind the last match there is only text.
        return F.when(e["match"].isNull(), state).otherwise(more)

    return F.aggregate(both, empty, step, lambda s: s["found"])


def verified(text: Column, rules: tuple[Rule, ...], places: list[int], chosen: Column | None) -> Column:
    """Spans (rule, start, end) of the rules at ``places``, or of those ``chosen`` among them."""
    table = F.array(
        *[
            F.struct(F.lit(k).alias("rule"), F.lit(rules[k].pattern).alias("pattern"), F.lit(rules[k].value).alias("value"), F.lit(rules[k].least).alias("least"))
            for k in places
        ]
    )
    alive = table if chosen is None else F.filter(table, lambda r: F.array_contains(chosen, r["rule"]))

    def spans(r: Column) -> Column:
        found = F.filter(matches(text, r["pattern"], r["value"]), lambda m: m["size"] >= r["least"])
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), r["rule"].alias("rule"), m["end"].alias("end")))

    hit = F.filter(alive, lambda r: F.regexp(text, r["pattern"]))
    return F.flatten(F.transform(hit, spans))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``secrets``: array of (kind, start, end), by start and then in the rules' order."""
    kept = without(docs, ["secrets"]).withColumn("__text", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    carried = [c for c in kept.columns if c != "__text"]
    asked = queries(rules)
    scanned = [k for k in range(len(rules)) if k not in asked]
    wanted = sorted({t for q in asked.values() for clause in q for a in clause for t in a})
    body = F.col("__text")

    known = kept.filter(F.col(f"`{doc_id}`").isNotNull())
    if asked:
        source = known.select(F.col(f"`{doc_id}`").alias("id"), "__text")
        postings = staged(trigram_index(source, wanted, "id", "__text"), "trigrams")
        # Written first, so that texts meet it over an exchange of their own: Spark can split an id
        # that very many rows have.
        found = staged(candidates(postings, asked), "candidates")
        found = found.withColumnRenamed("id", "__id").withColumnRenamed("rules", "__rules")
        known = known.join(found, F.col(f"`{doc_id}`") == F.col("__id"), "left")
    else:
        known = known.withColumn("__rules", F.lit(None).cast("array<int>"))
    everywhere = verified(body, rules, scanned, None) if scanned else None
    behind = F.when(F.col("__rules").isNotNull(), verified(body, rules, sorted(asked), F.col("__rules"))) if asked else None
    nothing = F.array().cast("array<struct<start:bigint,rule:int,end:bigint>>")
    parts = [F.coalesce(p, nothing) for p in (everywhere, behind) if p is not None]
    with_id = known.withColumn("__spans", F.concat(nothing, *parts))
    no_id = kept.filter(F.col(f"`{doc_id}`").isNull()).withColumn("__spans", verified(body, rules, list(range(len(rules))), None))
    names = F.array(*[F.lit(r.kind) for r in rules])
    shown = F.transform(
        F.array_sort("__spans"),
        lambda s: F.struct(F.get(names, s["rule"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    columns = [F.col(f"`{c}`") for c in carried]
    return with_id.select(*columns, "__spans").unionByName(no_id.select(*columns, "__spans")).select(*columns, shown.alias("secrets"))


def redacted(scanned: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """Put a mark in place of the spans that ``scan`` found; overlapping ones get one mark.

    Null texts stay null. ``secrets`` is carried on.
    """
    body = F.col(f"`{text}`")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        before = F.substring(body, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        longer = F.greatest(state["at"], s["end"])
        apart = F.struct(longer.alias("at"), F.concat(state["out"], before, F.lit(mark)).alias("out"))
        return F.when(s["start"] >= state["at"], apart).otherwise(F.struct(longer.alias("at"), state["out"].alias("out")))

    rest = lambda s: F.concat(s["out"], F.substring(body, (s["at"] + 1).cast("int"), F.length(body)))
    changed = F.aggregate("secrets", start, step, rest)
    return scanned.withColumn(text, F.when(F.size("secrets") > 0, changed).otherwise(body))
