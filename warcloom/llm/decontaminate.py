"""Benchmark decontamination: spaced seeds find places, aligned words decide.

A document overlaps a benchmark item if somewhere, word by word and without gaps, some
``w`` consecutive words of the item agree with it in at least ``percent`` of the places;
``w`` is 13, or the length of a shorter item. An item of 1 to 4 words, which clean texts
hold as well, overlaps the documents that consist of these words and no others.

A seed is a mask over consecutive words; the masked-out positions don't enter its hash,
so a seed still matches when a word there was replaced. The masks are chosen so that
each such overlap of 13 words with up to two replaced words, and each of the shorter
ones, holds at least one seed: the result doesn't depend on luck.

1. The seeds of all items are hashed; a bit table of fixed size remembers them, and one
   for each class of item lengths.
2. Documents are read once. Seeds that pass the bit table are written with the words
   around them, as many as items of the seed's class may need, joined into segments
   where they touch.
3. Seeds and item seeds are joined by hash, which gives (segment, item, offset).
4. Each such alignment is verified on the words.

Words are runs of letters and digits in lower case. Null and empty texts have none. A
document's id and an item are reported once, however often they overlap and however many
rows have the id; rows without an id count as one document. Items without an id are left
out; items that share one are searched each and reported together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warcloom.llm.common import chunks, row_type, staged, texts_of, tidied
from warcloom.llm.shingles import ODD, mixed

WORDS = re.compile(r"[^\W_]+")
WINDOW, SHORTEST = 13, 5
#: Items up to so many words are one class, those up to four times as many the next one.
FIRST_CLASS = 64
#: Between them, these find any 13 words of which two were replaced.
MASKS = ("111111", "101100111", "11010111")
#: And these any 5 to 12 words of which one (up to 9) or two were replaced.
SHORT_MASKS = ("111", "1101", "1011")
#: A factor for each place of a mask.
FACTORS = mixed(np.arange(1, WINDOW + 1, dtype=np.uint64) * ODD) | np.uint64(1)
BIT_TABLE = 24
CACHED_WORDS = 100_000
#: Masks run over so many words at a time, which stay in a core's cache.
GATHERED = 1 << 15


class Hashes(dict):
    """Words as 64-bit hashes."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str) -> np.ndarray:
        words = WORDS.findall(text.lower())
        if len(self) > CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of a mask at each place where it fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, xxhash.xxh3_64_intdigest(mask), dtype=np.uint64)
    for k, used in enumerate(mask):
        if used == "1":
            total += words[k : k + n] * FACTORS[k]
    return mixed(total)


def gathered(texts: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The texts in order, as many at a time as have some GATHERED words, or a single longer one."""
    some, held = [], 0
    for words in texts:
        if some and held + len(words) > GATHERED:
            yield some
            some, held = [], 0
        some.append(words)
        held += len(words)
    if some:
        yield some


def whole_seed(words: np.ndarray) -> np.ndarray:
    """The hash of a whole sequence, for those too short for a mask."""
    total = np.full(1, xxhash.xxh3_64_intdigest("whole"), dtype=np.uint64)
    for k in range(len(words)):
        total = mixed(total * ODD + words[k])
    return total


def bits_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each hash in the bit table."""
    cut = np.uint64((1 << BIT_TABLE) - 1)
    return (hashes & cut).astype(np.int64), ((hashes >> np.uint64(32)) & cut).astype(np.int64)


def item_words(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item_id``, ``n`` and ``words`` (hashes as bytes) of the items to be searched."""
    schema = row_type(item_id="long", n="long", words="binary")
    source = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in chunks(batches, "text"):
            words = [hashes.of(t) for t in texts_of(batch, "text")]
            columns = [pa.array([len(w) for w in words], pa.int64()), pa.array([w.tobytes() for w in words], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    made = source.filter(F.col("item_id").isNotNull()).mapInArrow(run, schema)
    return made.filter(F.col("n") > 0).dropDuplicates(["item_id", "words"])


def item_seeds(words: DataFrame) -> DataFrame:
    """``seed``, ``item_id``, ``item_at``, ``n`` of all seeds of the items; ``n`` is the item's length."""
    schema = row_type(seed="long", item_id="long", item_at="long", n="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in chunks(batches, "words"):
                found: list[tuple[np.ndarray, ...]] = []
                for item, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                    own = np.frombuffer(data, np.uint64)
                    masks = MASKS if len(own) >= WINDOW else SHORT_MASKS
                    for hashes in [whole_seed(own)] if len(own) < SHORTEST else [seeds(own, mask) for mask in masks]:
                        n = len(hashes)
                        found.append((hashes.view(np.int64), np.full(n, item), np.arange(n), np.full(n, len(own))))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=schema.names)

    return words.mapInArrow(run, schema).distinct()


def bit_table(seed_rows: DataFrame) -> np.ndarray:
    """A table of 2^24 bits with the seeds' places; the driver gets no more than its places."""
    schema = row_type(place="integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(np.concatenate(bits_of(batch.column(0).to_numpy().astype(np.int64).view(np.uint64))))
            yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32))], names=["place"])

    table = np.zeros(1 << BIT_TABLE, dtype=bool)
    table[seed_rows.select("seed").mapInArrow(run, schema).distinct().toArrow()["place"].to_numpy()] = True
    return np.packbits(table)


def segments(docs: DataFrame, tables: list[tuple[int, np.ndarray]], masks: tuple[str, ...]) -> DataFrame:
    """Places of documents that seeds may match, with words on both sides.

    ``tables`` has bit tables: first that of all seeds, then one for each class of items,
    each with the longest length in it, longer classes later. ``segment`` (a number),
    ``doc_id``, ``from_word``, ``words`` and ``hits``: the seeds and where they stand in
    the segment.
    """
    hit = T.StructType().add("seed", "long").add("at", "long")
    schema = row_type(segment="long", doc_id="long", from_word="long", words="binary", hits=T.ArrayType(hit))
    shared = docs.sparkSession.sparkContext.broadcast([(reach, table.tobytes()) for reach, table in tables])

    def passing(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
        # Most hashes meet an empty byte; bits are looked at for the others.
        cut = np.uint64((1 << BIT_TABLE) - 1)
        places = np.nonzero(bits[((hashes & cut) >> np.uint64(3)).astype(np.int64)])[0]
        for place in range(2):
            at = bits_of(hashes[places])[place]
            places = places[((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)]
        return places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        (_, every), *classes = [(reach, np.frombuffer(table, np.uint8)) for reach, table in shared.value]
        hashes = Hashes()
        number = TaskContext.get().partitionId() << 36

        def hits_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
            """(place, seed, reach) of the seeds of each text that pass, by place.

            Masks run over the words of all texts in a row; what reaches into the next
            text doesn't count.
            """
            found: list[list[tuple[int, int, int]]] = [[] for _ in texts]

            def add(some: np.ndarray, places: np.ndarray, of_text: np.ndarray) -> None:
                reach = np.zeros(len(some), np.int64)
                for longest, bits in classes:
                    reach[passing(some, bits)] = longest
                for text, *hit in zip(of_text.tolist(), places.tolist(), some.view(np.int64).tolist(), reach.tolist()):
                    if hit[2]:
                        found[text].append(tuple(hit))

            words = np.concatenate([np.zeros(0, np.uint64), *texts])
            lengths = np.array([len(t) for t in texts], np.int64)
            ends = np.cumsum(lengths)
            for mask in masks:
                own = seeds(words, mask)
                places = passing(own, every)
                of_text = np.searchsorted(ends, places, side="right")
                within = places + len(mask) <= ends[of_text]
                places, of_text = places[within], of_text[within]
                if len(places):
                    add(own[places], places - (ends - lengths)[of_text], of_text)
            for text in np.nonzero((lengths > 0) & (lengths < SHORTEST))[0].tolist():
                own = whole_seed(texts[text])
                if len(passing(own, every)):
                    add(own, np.zeros(1, np.int64), np.array([text]))
            return [sorted(f) for f in found]

        with np.errstate(over="ignore"):
            for batch in chunks(batches, "text"):
                rows = []
                texts = [hashes.of(t) for t in texts_of(batch, "text")]
                hits_by_text = (found for some in gathered(texts) for found in hits_of(some))
                for doc, words, hits_here in zip(batch.column(0).to_pylist(), texts, hits_by_text):
                    group: list[tuple[int, int, int]] = []
                    low = high = 0
                    # The last one closes the last group.
                    for place, seed, reach in [*hits_here, (len(words), 0, -1)]:
                        if group and (reach < 0 or place - reach > high):
                            hits = [{"seed": s, "at": p - low} for p, s, _ in group]
                            rows.append((number, doc, low, words[low:high].tobytes(), hits))
                            number += 1
                            group = []
                        if reach > 0:
                            # A longer reach may lead behind the start of the group.
                            low = max(0, min(low, place - reach) if group else place - reach)
                            high = max(high, place + reach) if group else place + reach
                            group.append((place, seed, reach))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return docs.mapInArrow(tidied(run), schema)


def overlap(item: np.ndarray, doc: np.ndarray, offset: int, percent: int) -> tuple[int, int, int] | None:
    """(first place in the document's words, length, agreeing words) of an alignment.

    ``offset`` is the item's start in ``doc``, which may lie before it. The length spans
    all windows that agree well enough; None if there is none.
    """
    low, high = max(0, -offset), min(len(item), len(doc) - offset)
    width = min(WINDOW, len(item))
    if high - low < width:
        return None
    agree = item[low:high] == doc[low + offset : high + offset]
    sums = np.concatenate([[0], np.cumsum(agree)])
    good = np.nonzero(100 * (sums[width:] - sums[:-width]) >= percent * width)[0]
    if not len(good):
        return None
    first, end = int(good[0]), int(good[-1]) + width
    return low + offset + first, end - first, int(sums[end] - sums[first])


def overlaps(
    docs: DataFrame, items: DataFrame, percent: int = 80, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``item_id``, ``first_word``, ``n_words``, ``n_agree``: the overlaps.

    One row for a document's id and an item: the place with the most agreeing words, the
    first of them if there are several.
    """
    own = staged(item_words(items, item_id, text), "items")
    seed_rows = staged(item_seeds(own), "seeds")
    # Classes by length, of a number that grows with the logarithm of the longest length.
    grade = F.when(F.col("n") <= FIRST_CLASS, 0).otherwise(F.ceil(F.log(F.col("n") / FIRST_CLASS) / F.log(F.lit(4.0)))).cast("int")
    grades = own.groupBy(grade.alias("grade")).agg(F.max("n"), F.min(F.when(F.col("n") >= SHORTEST, F.col("n")))).orderBy("grade").collect()
    of_class = [(int(n), bit_table(seed_rows.filter(grade == g))) for g, n, _ in grades]
    least = [n for *_, n in grades if n is not None]
    masks = (MASKS if of_class and of_class[-1][0] >= WINDOW else ()) + (SHORT_MASKS if least and min(least) < WINDOW else ())
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    every = np.bitwise_or.reduce([bits for _, bits in of_class] or [np.zeros(1 << (BIT_TABLE - 3), np.uint8)])
    found = staged(segments(source, [(0, every), *of_class], masks), "segments")
    hits = staged(found.select("segment", F.explode("hits").alias("hit")).select("segment", "hit.seed", "hit.at"), "hits")
    aligned = hits.join(seed_rows, "seed").select("segment", "item_id", (F.col("at") - F.col("item_at")).alias("offset")).distinct()
    with_item = staged(aligned.join(own.select("item_id", F.col("words").alias("item")), "item_id"), "aligned")
    both = with_item.join(found.select("segment", "doc_id", "from_word", "words"), "segment")
    both = both.select("segment", "doc_id", "item_id", "from_word", "offset", "item", "words")
    schema = row_type(segment="long", doc_id="long", item_id="long", first_word="long", n_words="long", n_agree="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in chunks(batches, "item", "words"):
            rows = []
            for segment, doc, item, low, offset, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                place = overlap(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), offset, percent)
                if place:
                    rows.append((segment, doc, item, low + place[0], place[1], place[2]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    verified = both.mapInArrow(tidied(run), schema)
    best = F.min(F.struct((-F.col("n_agree")).alias("less"), "first_word", "n_words")).alias("best")
    one = verified.groupBy("doc_id", "item_id").agg(best)
    return one.select(
        "doc_id", "item_id", F.col("best.first_word").alias("first_word"), F.col("best.n_words").alias("n_words"),
        (-F.col("best.less")).alias("n_agree"),
    )


def clean(
    docs: DataFrame, items: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text", together: bool = True
) -> DataFrame:
    """The documents whose own text overlaps no item.

    Rows that share an id go or stay together, unless ``together`` is false. Rows without
    an id are decided one by one either way. A text is known by its hash.
    """
    known = docs.withColumn("__hash", F.xxhash64(F.col(f"`{text}`").cast("string")))
    found = overlaps(known, items, percent, doc_id="__hash", text=text)
    bad = staged(found.select(F.col("doc_id").alias("__bad")).distinct(), "bad")
    left = known.join(bad, F.col("__hash") == F.col("__bad"), "left_anti")
    if together:
        own = F.col(f"`{doc_id}`").cast("long")
        ids = known.join(bad, F.col("__hash") == F.col("__bad"), "left_semi").select(own.alias("__id")).distinct()
        left = left.join(staged(ids, "bad_ids"), own == F.col("__id"), "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
