"""Filter interaction audit: what each filter removes, alone, in every order, and by Shapley.

Five filters look at whole texts. A document fails

- ``A`` with fewer than 200 words,
- ``B`` if 100 * distinct words < 50 * words,
- ``C`` if 100 * upper-case letters (A to Z) > 3 * code points,
- ``D`` if it holds any of ``#$%&*|``,
- ``E`` if a row with a smaller id has the same text, whatever becomes of that row.

1. Texts are read once; a row of five bits, language, labels and a digest is left of each.
2. Rows with equal bits, language and labels are counted: the *histogram*, at most 128 rows
   for each language. Nothing later depends on the number of documents.
3. For each language and each of the 32 *coalitions* of filters, the documents that any of
   its members would remove are counted.
4. The Shapley values are the solution of a least-squares problem: among all additive
   models v(S) = sum of phi over S, fit the 30 proper coalitions with the Shapley kernel as
   weights, under the constraint that all five together remove what they remove. The normal
   equations are solved in rational numbers, so 120 * phi are exact whole numbers.
5. What a filter removes at a step of an order is the difference of two coalitions.

Words are runs without ASCII white space, and differ by case. Null texts are empty: they
fail A alone (and E behind a smaller id with an empty text). A null language is the part
``""``. Rows without an id never fail E, make no other fail it and have no labels; rows
that repeat an id don't make each other fail E. A document is good (or toxic) if any row of
``labels`` with its id says so. Very long texts are counted whole, in memory of about
twice their size. Empty tables give no rows. Columns beyond those named are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.llm.common import chunks, row_type, staged

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
UPPER = bytes(range(65, 91))
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = re.compile(rb"[#$%&*|]")
COUNTS = ("removed", "good_lost", "toxic_lost")

AUDIT = row_type(
    part="string", filter_order="string", step="integer", kept="long", removed="long", redundant="long",
    unique_fails="long", good_lost="long", toxic_lost="long", shapley="long",
)


def failed_by_text(text: bytes) -> int:
    """The bits of the filters A to D that a text fails, A lowest."""
    words = text.split()
    upper = len(text) - len(text.translate(None, UPPER))
    points = len(text.translate(None, CONTINUATION))
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * upper > 3 * points) << 2
        | (SYMBOLS.search(text) is not None) << 3
    )


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``failed`` (bits of all five filters), ``good``, ``toxic`` for every document."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    schema = row_type(doc_id="long", part="string", digest="binary", failed="integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            texts = [t.as_py() for t in batch.column(2)]
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            failed = pa.array([failed_by_text(t) for t in texts], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), digests, failed], names=schema.names)

    rows = staged(source.mapInArrow(run, schema), "marked")
    # One row for each text that several rows have; copies are counted before they move.
    several = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    several = staged(several.select("digest", "first_id"), "repeated")
    says = lambda column: F.max(F.coalesce(F.col(column) == 1, F.lit(False)))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    known = staged(known.filter("doc_id IS NOT NULL AND (good OR toxic)"), "known")
    # Written tables on both sides of a join: Spark can split a text or an id that many rows share.
    repeat = staged(rows.join(several, "digest", "left").drop("digest"), "repeats")
    later = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    bits = F.col("failed").bitwiseOR(F.when(later, 1 << 4).otherwise(0))
    no = F.lit(False)
    return repeat.join(known, "doc_id", "left").select(
        "part", bits.alias("failed"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    )


def histogram(rows: DataFrame) -> DataFrame:
    """``part``, ``failed``, ``docs``, ``good``, ``toxic``: counts of marked documents."""
    return rows.groupBy("part", "failed").agg(
        F.count("*").alias("docs"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )


def coalitions(counted: DataFrame) -> DataFrame:
    """``part``, ``coalition`` (bits), ``docs`` and what the coalition would remove, all 32 of each part."""
    each = counted.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(ALL))))
    hit = F.col("failed").bitwiseAND(F.col("coalition")) != 0
    sums = [F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(n) for c, n in zip(("docs", "good", "toxic"), COUNTS)]
    return each.groupBy("part", "coalition").agg(F.sum("docs").alias("docs"), *sums)


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system of linear equations, by elimination in rationals."""
    rows = [[*row, value] for row, value in zip(matrix, right)]
    for i in range(len(rows)):
        pivot = next(k for k in range(i, len(rows)) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(len(rows)):
            if k != i and rows[k][i]:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i])]
    return [row[-1] for row in rows]


def shapley(removed: list[int], players: int = len(FILTERS)) -> list[Fraction]:
    """Shapley values of a game given by its value for each coalition (bits), by least squares.

    The unknowns are the values and the multiplier of the constraint.
    """
    everyone = (1 << players) - 1
    matrix = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
    right = [Fraction(0)] * (players + 1)
    for coalition in range(1, everyone):
        size = coalition.bit_count()
        weight = Fraction(players - 1, math.comb(players, size) * size * (players - size))
        members = [i for i in range(players) if coalition >> i & 1]
        for i in members:
            right[i] += weight * (removed[coalition] - removed[0])
            for k in members:
                matrix[i][k] += weight
    for i in range(players):
        matrix[i][players] = matrix[players][i] = Fraction(1)
    right[players] = Fraction(removed[everyone] - removed[0])
    return solved(matrix, right)[:players]


def steps(part: str, docs: int, removed: list[int], good: list[int], toxic: list[int]) -> list[tuple]:
    """The rows of ``AUDIT`` for one part, from its 32 coalitions."""
    orders = math.factorial(len(FILTERS))
    values = [v * orders for v in shapley(removed)]
    if any(v.denominator != 1 for v in values):
        raise ArithmeticError(f"Shapley values of {part!r} are no whole numbers: {values}")
    rows = []
    for order in itertools.permutations(range(len(FILTERS))):
        before, name = 0, "".join(FILTERS[i] for i in order)
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            here = removed[after] - removed[before]
            rows.append((
                part, name, step, docs - removed[after], here, removed[1 << i] - here,
                removed[ALL] - removed[ALL & ~(1 << i)], good[after] - good[before], toxic[after] - toxic[before], int(values[i]),
            ))
            before = after
    return rows


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row of ``AUDIT`` for each part, order of the filters and step."""
    table = coalitions(staged(histogram(marked(docs, labels)), "histogram"))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(AUDIT)
        rows = rows.sort_by("coalition")
        counts = [rows[c].to_pylist() for c in COUNTS]
        made = steps(key[0].as_py(), rows["docs"][0].as_py(), *counts)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)

    return table.groupBy("part").applyInArrow(run, AUDIT)
