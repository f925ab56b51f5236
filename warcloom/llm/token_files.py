"""Token ids in Parquet files: written in document order, read selectively.

A file holds the documents of one range of ids, in ascending order, with the columns
``doc_id``, ``at`` (ids before the document in its file), ``n_tokens`` and ``tokens``
(list of int). Integers are written with dictionary encoding, or delta encoding where a
dictionary doesn't pay; row groups and pages are bounded, and pages are indexed, so a
reader of a few documents, or of the lengths alone, touches little of a file.

Rows without an id come first. Rows with equal ids stand in the order of a hash of
their texts; they count as documents of their own, equal rows included. Null and empty
texts have the end id alone.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from warcloom.llm.bpe import packed
from warcloom.llm.common import chunks, once_per_worker, row_type, texts_of

SCHEMA = row_type(doc_id="long", at="long", n_tokens="long", tokens=T.ArrayType(T.IntegerType()))
#: Bounds of the tables of recent words and pieces, in entries and characters.
CACHED_WORDS = 400_000
CACHED_PIECES = 50_000
CACHED_LENGTH = 48
MARKS = ".,;:!?"
#: Letters whose composed and lowered form is one letter of the same kind.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-\u012f\u0131-ſ"
SIMPLE = f"^[{LETTERS}]+[{MARKS}]?$"


class Recent(dict):
    """A table that forgets what wasn't asked for since it last was half full, and long keys."""

    def __init__(self, entries: int) -> None:
        self.entries, self.older = entries, {}

    def all(self, keys: list[str], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The values of ``keys``, which are distinct; ``make`` gives those that aren't known."""
        if len(self) >= self.entries // 2:
            self.older = {k: v for k, v in self.items() if len(k) <= CACHED_LENGTH}
            self.clear()
        values = list(map(self.get, keys))
        fresh = [i for i, v in enumerate(values) if v is None]
        older = self.older
        for i in fresh:
            values[i] = older.get(keys[i])
        missing = [i for i in fresh if values[i] is None]
        for i, value in zip(missing, make([keys[i] for i in missing])):
            values[i] = value
        self.update((keys[i], values[i]) for i in fresh)
        return values


class PieceEncoder:
    """Ids of texts from the ids of their distinct words, by the ``tokenizers`` library.

    Texts are cut at spaces and line feeds. That is only right where the tokenizer drops
    white space and no token or normalisation reaches across it, which
    ``drops_white_space`` checks; otherwise texts are encoded whole.

    Most pieces are a word and at most one mark, which never share a token. A word of
    ``LETTERS``, lowered, goes to the library's model as it is, since none of the steps
    before it would change or cut it; any other piece goes through the whole library.
    """

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_piece = self.drops_white_space(settings)
        self.model = self.library.model
        self.words, self.pieces = Recent(CACHED_WORDS), Recent(CACHED_PIECES)
        if self.by_piece:
            self.marks = [b"", *self.library_ids(list(MARKS))]
            # The model gets bytes beyond ASCII as the letters that the library has for them.
            from tokenizers.pre_tokenizers import ByteLevel

            shown = ByteLevel(add_prefix_space=False, use_regex=False)
            self.as_letters = {c: shown.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x180)}

    @staticmethod
    def drops_white_space(settings: dict) -> bool:
        steps = (settings["pre_tokenizer"] or {}).get("pretokenizers", [])
        normal = [n["type"] for n in (settings["normalizer"] or {}).get("normalizers", [])]
        return (
            settings["post_processor"] is None
            and normal == ["NFC", "Replace", "Lowercase"]
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True)
            and not steps[1]["use_regex"]
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in settings["added_tokens"])
            and not any(t["content"].isalpha() or any(map(str.isspace, t["content"])) for t in settings["added_tokens"])
        )

    def library_ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [packed(array("I", e.ids)) for e in found]

    def word_ids(self, words: list[str]) -> list[bytes]:
        cut, letters = self.model.tokenize, self.as_letters
        return [packed(array("I", [t.id for t in cut(w if w.isascii() else w.translate(letters))])) for w in words]

    def parts(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """For each of distinct pieces the places of its word and mark in a list of ids."""
        simple = pc.match_substring_regex(pieces, SIMPLE)
        plain = pieces.filter(simple)
        last = pc.utf8_slice_codeunits(plain, -1)
        mark = pc.index_in(last, pa.array(list(MARKS)))
        words = pc.if_else(mark.is_valid(), pc.utf8_slice_codeunits(plain, 0, -1), plain)
        words = pc.utf8_lower(words).dictionary_encode()
        named, others = words.dictionary.to_pylist(), pieces.filter(pc.invert(simple)).to_pylist()
        ids = [*self.marks, *self.words.all(named, self.word_ids), *self.pieces.all(others, self.library_ids)]
        is_simple = np.asarray(simple)
        word, behind = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        word[is_simple] = words.indices.to_numpy() + len(self.marks)
        word[~is_simple] = np.arange(len(others)) + len(self.marks) + len(named)
        # The first of the list is no mark.
        behind[is_simple] = mark.fill_null(-1).to_numpy() + 1
        return word, behind, ids

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind one another, and how many each has."""
        if not self.by_piece:
            ids = self.library_ids(texts)
            return np.frombuffer(b"".join(ids), dtype="<i4"), np.asarray([len(i) // 4 for i in ids], dtype=np.int64)
        cut = pc.split_pattern(pa.array([t.replace("\n", " ") for t in texts], pa.string()), " ")
        pieces = cut.flatten().dictionary_encode()
        word, mark, ids = self.parts(pieces.dictionary)
        # Where the ids of each part lie, and from there those of all pieces.
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        starts, order = np.cumsum(sizes) - sizes, pieces.indices.to_numpy()
        place = np.stack([word[order], mark[order]], axis=1).ravel()
        lengths = sizes[place]
        ends = np.cumsum(lengths)
        at = np.repeat(starts[place] - (ends - lengths), lengths) + np.arange(lengths.sum())
        before = np.concatenate([[0], ends[1::2]])[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        return np.frombuffer(b"".join(ids), dtype="<i4")[at], np.diff(before)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        ids, lengths = self.flat(texts)
        return [ids[end - n : end].tobytes() for n, end in zip(lengths, np.cumsum(lengths))]


def encoder(path: str) -> PieceEncoder:
    """The encoder of a file, once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return once_per_worker(("pieces", path), lambda: PieceEncoder(path))


def token_rows(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents as rows of ``SCHEMA``, sorted by id; a partition is to become a file."""
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # Rows equal in id and text may be very many: those of different input partitions can be parted.
    order = [F.col("doc_id"), F.xxhash64("text"), F.length("text"), F.spark_partition_id()]
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, at = encoder(path), 0
        for batch in chunks(batches, "text"):
            ids, lengths = work.flat(texts_of(batch, "text"))
            ids, lengths = np.insert(ids, np.cumsum(lengths), end_id), lengths + 1
            ends = np.cumsum(lengths)
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32)))
            columns = [batch.column(0), pa.array(at + ends - lengths), pa.array(lengths), tokens]
            yield pa.RecordBatch.from_arrays(columns, names=SCHEMA.names)
            at += int(ends[-1])

    return ordered.mapInArrow(run, SCHEMA)


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    out: str,
    doc_id: str = "doc_id",
    text: str = "text",
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2_000,
) -> None:
    """Encode documents and write them to ``out``, one file for each range of ids.

    The write is committed by Spark; a task that runs again replaces its own file.
    """
    (
        token_rows(docs, tokenizer_path, end_id, doc_id, text)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.dictionary.page.size", str(1 << 20))
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .parquet(out)
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(SCHEMA).parquet(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    return rows.withColumn("file_no", number)


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """``file_no`` and ``file_start``: ids before each file. Reads the lengths alone.

    One short row per file passes the single task of the running total.
    """
    ends = _files(spark, path).groupBy("file_no").agg(F.max(F.col("at") + F.col("n_tokens")).alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return ends.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))


def read_token_files(spark: SparkSession, path: str, tokens: bool = True, crc32: bool = False) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and more columns.

    With ``crc32``, ``ids_crc32`` stands in place of the ids, which then go no further
    than the task that reads them. Without ``tokens``, ids are not read at all. Filters on
    ``doc_id`` reach the files, whose statistics and page indexes skip what lies outside.
    """
    columns = ["tokens"] if tokens or crc32 else []
    rows = _files(spark, path).select("file_no", "doc_id", "at", "n_tokens", *columns)
    if crc32:
        rows, columns = with_crc32(rows), ["ids_crc32"]
    joined = rows.join(file_starts(spark, path), "file_no")
    return joined.select("doc_id", (F.col("file_start") + F.col("at")).alias("start"), "n_tokens", *columns)


def with_crc32(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``ids_crc32`` in place of the ids: of them all, as little-endian 32-bit integers."""
    import zlib

    kept = [f for f in rows.schema.fields if f.name != tokens]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(tokens))
            values = np.asarray(lists.flatten()).astype("<i4")
            ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip([0, *ends[:-1]], ends)]
            out = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*out, pa.array(sums, pa.int64())], names=[*names, "ids_crc32"])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("ids_crc32", T.LongType())]))
