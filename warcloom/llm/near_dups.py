"""Near-duplicates by MinHash: one-permutation signatures, banded buckets, star edges.

1. Every text becomes its set of word shingles. Equal sets are one *class* from here on,
   however many copies it has.
2. Each class has one key per band of its signature; classes that share a key meet in a
   bucket. Two sets at the threshold meet with a probability of 1 - (1 - s^rows)^bands.
3. A bucket gives only a star: pairs of its centre with its other members, so pairs grow
   with the members and not with their square. The centre is the member that shares most
   buckets with others, which in a family of copies is the original.
4. Star pairs are compared on their full sets. Members above the threshold are linked.
5. Two members of a star may be similar though one of them isn't similar to the centre c.
   Write a member as its difference from c: what it has more, and what it lacks. For such
   a pair u, w the common part of the two differences must be large (see ``prefixes``), so
   only pairs that share a feature in the first part of both differences, as set joins
   with prefix and positional filters do, are compared. Nothing is lost by that. Pairs
   that the star links have put in one component already are left out.
6. Links are contracted to components by spreading the smallest label, with shortcuts.

So every pair that meets in any bucket is decided exactly. No bucket is capped: a large
one is a long star, whose rows are split over tasks like any others.

Texts are lowered (A to Z) and cut at ASCII white space. With fewer words than a shingle
has, the whole sequence is one shingle; null and empty texts have none and link with
nothing. A component is known by its smallest id. Rows without an id take part, get the
id of their component, and are never kept; with no id in it, it is null. Rows that
repeat an id are rows of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from warcloom.llm.common import chunks, row_type, staged, texts_of, tidied
from warcloom.llm.shingles import Bands, Words, held, node_of, shingle_set

LONGS = T.ArrayType(T.LongType())


def _per_text(docs: DataFrame, schema: T.StructType, make: Callable) -> DataFrame:
    """One row per row of (``doc_id``, ``text_hash``, ``text``): both, then what ``make()`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, work, words = to_arrow_schema(schema), make(), Words()
        with np.errstate(over="ignore"):
            for batch in chunks(batches, "text"):
                rows = [work(w) for w in words.hashes(texts_of(batch, "text"))]
                columns = [pa.array(v, f.type) for v, f in zip(zip(*rows), list(arrow)[2:])]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema=arrow)

    return docs.mapInArrow(tidied(run), schema)


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node`` (the class) and ``keys`` (one per band)."""
    schema = row_type(doc_id="long", text_hash="long", n_shingles="long", node="binary", keys=LONGS)

    def make() -> Callable:
        banded = Bands(bands, rows)

        def work(words: np.ndarray) -> tuple:
            shingles = shingle_set(words, size)
            if not len(shingles):
                return 0, None, None
            return len(shingles), node_of(shingles), banded.keys(shingles)

        return work

    return _per_text(docs, schema, make)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``node`` and ``shingles``: the sorted hashes as bytes."""
    schema = row_type(doc_id="long", text_hash="long", node="binary", shingles="binary")

    def make() -> Callable:
        def work(words: np.ndarray) -> tuple:
            shingles = shingle_set(words, size)
            return (node_of(shingles), shingles.tobytes()) if len(shingles) else (None, None)

        return work

    return _per_text(docs, schema, make)


def star_pairs(classes: DataFrame) -> DataFrame:
    """``center``, ``member``: the distinct star pairs of all buckets.

    ``classes`` has ``node`` and ``keys``, a row per class.
    """
    rows = classes.select("node", F.explode("keys").alias("key"))
    # A written table on each side lets Spark split a bucket that is much larger than others.
    several = staged(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    shared = staged(rows.join(several, "key"), "shared")
    weight = staged(shared.groupBy("node").agg(F.sum("n").alias("weight")), "weights")
    weighted = staged(shared.select("key", "node").join(weight, "node"), "weighted")
    centers = weighted.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("best"))
    centers = staged(centers.select("key", F.col("best.node").alias("center")), "centers")
    pairs = weighted.join(centers, "key").filter(F.col("node") != F.col("center"))
    return pairs.select("center", F.col("node").alias("member")).distinct()


def difference(center: np.ndarray, member: np.ndarray, percent: int) -> tuple[int, int, bool, np.ndarray]:
    """How a member differs from its centre: (more, lacks, linked, features).

    ``more`` and ``lacks`` are how many shingles it has more and lacks, ``features`` are
    all of those. See ``prefixes`` for what follows from them.
    """
    more, lacks = member[~held(member, center)], center[~held(center, member)]
    m, d, c = len(lacks), len(more), len(center)
    linked = 100 * m + percent * d <= (100 - percent) * c
    return d, m, linked, np.concatenate([more, lacks]).view(np.int64)


def prefixes(need: int | Column, size: int | Column, f: int | Column, percent: int) -> tuple:
    """(short, long): of how many first features two similar members have one in common.

    With m, d the numbers of shingles that x lacks and has more, and s the features that
    two differences share, the similarity of two members u, w is
    (|c| - mu - mw + s) / (|c| + du + dw - s). With t the threshold, similarity asks for
    (1 + t) s >= mu + mw + t (du + dw) - (1 - t) |c|, and x is linked to c if and only if
    m + t d <= (1 - t) |c|. So if u isn't linked: (1 + t) s > mw + t dw, for any w; and
    with s <= mw + dw: s >= mu + t du - (1 - t) |c|. A member of which s features must be
    common has one of them among its first f - s + 1, in any order that all members of a
    star share: ``short`` for w, ``long`` for u, which w may be linked or not. ``need`` is
    100 m + percent d, ``size`` is |c|, ``f`` is m + d.
    """
    if isinstance(need, int):
        low = need // (100 + percent) + 1
        other = max(1, -((-(need - (100 - percent) * size)) // 100))
        return f - low + 1, f - min(low, other) + 1
    low = F.floor(need / (100 + percent)) + 1
    other = F.greatest(F.lit(1), F.ceil((need - (100 - percent) * size) / 100))
    return f - low + 1, f - F.least(low, other) + 1


def compare(pairs: DataFrame, sets: DataFrame, left: str, right: str, work: Callable, schema: T.StructType) -> DataFrame:
    """``work`` on the full sets of each pair, for columns of ``schema`` behind the pair's."""
    first = sets.select(F.col("node").alias(right), F.col("shingles").alias("__b"))
    second = sets.select(F.col("node").alias(left), F.col("shingles").alias("__a"))
    # The member's set first: a node is a member of few stars, but may be the centre of many.
    # The written table in between leaves a plain exchange, which Spark can split.
    half = staged(pairs.select(left, right).join(first, right), "half")
    both = half.join(second, left).select(left, right, "__a", "__b")
    result = row_type(**{left: "binary", right: "binary"})
    result = T.StructType([*result.fields, *schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(result)
        for batch in chunks(batches, "__a", "__b"):
            some, other = (batch.column(i).to_pylist() for i in (2, 3))
            made = [work(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(some, other)]
            columns = [pa.array(v, f.type) for v, f in zip(zip(*made), list(arrow)[2:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema=arrow)

    return both.mapInArrow(tidied(run), result)


def unlinked_pairs(stars: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``u``, ``w``: pairs of members of a star, one unlinked, that may be similar.

    Only members that the star links leave in different components (``labels``) are paired.
    """
    total = F.col("more") + F.col("lacks")
    of_member = labels.select(F.col("node").alias("member"), "label")
    measured = staged(
        stars.withColumn("f", total).join(of_member, "member", "left").withColumn("label", F.coalesce("label", "member")),
        "measured",
    )
    of_star = staged(
        measured.groupBy("center").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.max("f").alias("most"))
        .filter("a <> b").select("center", "most"),
        "stars",
    )
    need = F.lit(100) * F.col("lacks") + F.lit(percent) * F.col("more")
    short, long = prefixes(need, F.col("size"), F.col("f"), percent)
    open_stars = measured.join(of_star, "center").filter(
        F.col("linked") | (need - F.lit(100 - percent) * F.col("size") <= F.lit(100) * F.col("most"))
    )
    each = staged(
        open_stars.select(
            "center", "member", "label", "size", "linked", "f", need.alias("need"), short.alias("short"), long.alias("long"),
            F.explode("features").alias("feature"),
        ),
        "features",
    )
    # Rare features first. Those of one member alone, which come before all others, meet nothing.
    common = staged(each.groupBy("center", "feature").agg(F.count("*").alias("n")).filter("n > 1"), "common")
    of_row = Window.partitionBy("center", "member")
    place = F.col("f") - F.count("*").over(of_row) + F.row_number().over(of_row.orderBy("n", "feature")) - 1
    ranked = each.join(common, ["center", "feature"]).withColumn("at", place)
    ranked = staged(ranked.filter(F.col("at") < F.greatest("short", F.when(~F.col("linked"), F.col("long")).otherwise(0))), "ranked")
    left = ranked.filter(~F.col("linked") & (F.col("at") < F.col("long"))).select(
        "center", "feature", F.col("member").alias("u"), F.col("f").alias("uf"), F.col("at").alias("u_at"),
        F.col("need").alias("u_need"), "size", F.col("label").alias("u_label"),
    )
    right = ranked.filter(F.col("at") < F.col("short")).select(
        "center", "feature", F.col("member").alias("w"), F.col("f").alias("wf"), F.col("at").alias("w_at"),
        F.col("need").alias("w_need"), F.col("linked").alias("w_linked"), F.col("label").alias("w_label"),
    )
    # No more features can be common than are left behind the first common one.
    left_over = F.least(F.col("uf") - F.col("u_at"), F.col("wf") - F.col("w_at"))
    enough = F.lit(100 + percent) * left_over >= F.col("u_need") + F.col("w_need") - F.lit(100 - percent) * F.col("size")
    met = left.alias("l").join(
        right.alias("r"),
        (F.col("l.center") == F.col("r.center")) & (F.col("l.feature") == F.col("r.feature"))
        & (F.col("l.u_label") != F.col("r.w_label")) & (F.col("r.w_linked") | (F.col("l.u") < F.col("r.w"))) & enough,
    )
    return met.select("u", "w").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label``: the smallest node that can be reached, for all nodes of links.

    Each round takes the smallest label among the neighbours and then the label of the
    label; written tables cut the lineage. It ends when no label changes.
    """
    edges = links.union(links.select(links.columns[1], links.columns[0])).toDF("node", "other").distinct()
    edges = staged(edges, "edges")
    first = F.least(F.col("node"), F.min("other"))
    labels = staged(edges.groupBy("node").agg(first.alias("label")), "labels")
    while True:
        offers = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("offer"))
        near = staged(
            labels.join(offers, "node").select("node", F.col("label").alias("was"), F.least("label", "offer").alias("label")), "near"
        )
        shortcut = near.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = staged(
            near.join(shortcut, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")),
            "labels",
        )
        labels = after.select("node", "label")
        if after.filter(F.col("label") != F.col("was")).isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, bands: int = 40, rows: int = 5,
    doc_id: str = "doc_id", text: str = "text", labelled: bool = False,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``text_hash`` for every row.

    With ``labelled`` also ``label``, which tells apart components of the same id; it
    is null for texts without shingles.
    Documents are linked if 100 * intersection >= ``percent`` * union of their sets.
    """
    body = F.col(f"`{text}`").cast("string")
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    signed = staged(signatures(source, size, bands, rows), "signatures")
    some = signed.filter(F.col("node").isNotNull())
    classes = staged(some.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.first("keys").alias("keys")), "classes")
    pairs = staged(star_pairs(classes), "pairs")

    # The sets of the classes in any pair, made again from one text of each.
    asked = pairs.select(F.col("center").alias("node")).union(pairs.select("member")).distinct()
    asked = staged(classes.join(asked, "node", "left_semi").select("node", "least_id"), "asked")
    ids = asked.filter(F.col("least_id").isNotNull()).select(F.col("least_id").alias("doc_id")).distinct()
    texts = source.join(ids, "doc_id", "left_semi").unionByName(source.filter(F.col("doc_id").isNull()))
    sets = full_sets(texts, size).join(asked.select("node"), "node", "left_semi")
    sets = staged(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")

    star_row = row_type(size="long", more="long", lacks="long", linked="boolean", features=LONGS)

    def star_work(center: np.ndarray, member: np.ndarray) -> tuple:
        more, lacks, linked, features = difference(center, member, percent)
        return len(center), more, lacks, linked, features

    def pair_work(a: np.ndarray, b: np.ndarray) -> tuple:
        common = int(held(a, b).sum())
        return (100 * common >= percent * (len(a) + len(b) - common),)

    stars = staged(compare(pairs, sets, "center", "member", star_work, star_row), "stars")
    links = stars.filter("linked").select("center", "member")
    labels = components(links)
    further = staged(unlinked_pairs(stars, labels, percent), "further")
    decided = staged(compare(further, sets, "u", "w", pair_work, row_type(linked="boolean")).filter("linked"), "decided")
    if not decided.isEmpty():
        labels = components(links.union(decided.select("u", "w")))

    # From classes to documents: the smallest id of each component.
    placed = classes.select("node", "least_id").join(labels, "node", "left")
    placed = staged(placed.select("node", "least_id", F.coalesce("label", "node").alias("label")), "placed")
    least = staged(placed.groupBy("label").agg(F.min("least_id").alias("component_id")), "least")
    of_class = staged(placed.select("node", "label").join(least, "label").select("node", "component_id", "label"), "of_class")
    every = signed.select("doc_id", "text_hash", "n_shingles", "node").join(of_class if labelled else of_class.drop("label"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return every.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "text_hash",
        *(["label"] if labelled else []),
    )


def one_of_each(
    docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents less all but one row of each component.

    That is the row with the smallest id, and of rows that share this id, the one with the
    smallest hash of the text. Of documents without an id, which rank behind all others,
    one stays where the component has no id. Texts without shingles are in no component:
    of them, rows equal in id and text count once.
    """
    stand_in = F.lit(1 << 62) + F.xxhash64(F.col(f"`{text}`")).bitwiseAND(F.lit((1 << 61) - 1))
    known = docs.withColumn("__id", F.coalesce(F.col(f"`{doc_id}`").cast("long"), stand_in))
    known = known.withColumn("__hash", F.xxhash64(F.col(f"`{text}`").cast("string")))
    decided = near_duplicates(known, size, percent, doc_id="__id", text=text, labelled=True)
    rows = decided.filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "n_shingles", "label")
    rows = staged(rows.distinct(), "kept")
    # A component without links has a label of its own, so two of the same id aren't mixed up.
    first = rows.filter("n_shingles > 0").groupBy("label").agg(F.min(F.struct("__id", "__hash")).alias("first"))
    kept = first.select("first.__id", "first.__hash").union(rows.filter("n_shingles = 0").select("__id", "__hash"))
    left = known.join(staged(kept, "first"), ["__id", "__hash"], "left_semi").dropDuplicates(["__id", "__hash"])
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def chance_to_meet(similarity: float, bands: int = 40, rows: int = 5) -> float:
    """The probability that two sets share a bucket."""
    return 1 - math.pow(1 - similarity**rows, bands)
