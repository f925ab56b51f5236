"""Exact deduplication as a stream with state on disk.

Texts are equal when they are identical after lowering A to Z. Of equal texts the row with
the largest id stays.

1. Documents arrive as a stream of files. A task keeps the texts of some MB by their full
   bytes and passes on one short row for each: digest, number of rows, and the id and place
   of the row that stays. So a text that a third of all rows have moves a few times a task.
2. The stateful operator keeps, for each digest, without expiry: the stable id, the *content
   locator* of that row (file and row in it) and the number of rows. State lies in RocksDB
   on the executors' disks, its checkpoints in the checkpoint folder.
   When the files at hand are done, the state is read as a table. With a ``checkpoint`` of
   the caller's, a later run goes on from there and reads new files only.
3. Documents are read again. Rows of digests that several rows share are hits: their full
   bytes are compared with those at the locator of their digest. One of each set of equal
   bytes in a task stands for all. A bit table of fixed size tells which texts to look at.
4. Should bytes differ, all rows of that digest are grouped by their texts instead. (With
   SHA-256 that is not to be expected; ``digest_bytes`` cuts the digest, for tests.)

Null texts are empty and equal to empty ones. Null ids are smaller than all others. Rows that
repeat an id with an equal text are ranked by their place, so one row of each group stays.
Very long texts are hashed whole. A folder without rows gives none. The stream reads
``doc_id`` and ``text`` alone, so other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warcloom.llm.common import ascii_lower, chunks, row_type, settings, stage_path, staged
from warcloom.llm.decontaminate import bit_table, bits_of
from warcloom.llm.shingles import LOWER

#: Bytes of distinct texts that a task holds to find copies among its own rows.
HELD_BYTES = 16 << 20
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Each store would reserve some MB of disk for its log.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # All stores of an executor share this much memory; the rest is on disk.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}
PLACE = ("file", "row")
RESULT = row_type(doc_id="long", keep_id="long", group_size="long", kept="boolean", text_sha256="string")


def _source(docs: DataFrame) -> DataFrame:
    """Id, place and bytes of each row of a table or a stream of files."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").cast("long").alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def arrivals(docs: DataFrame, digest_bytes: int) -> DataFrame:
    """``digest``, ``n`` and ``doc_id``, ``file``, ``row`` of the last row, for texts met together."""
    schema = row_type(digest="binary", n="long", doc_id="long", file="string", row="long")

    def rows(held: dict) -> pa.RecordBatch:
        digests = [hashlib.sha256(t).digest()[:digest_bytes] for t in held]
        best, n = zip(*held.values())
        columns = [[None if known < 0 else doc for known, doc, *_ in best], *([b[i] for b in best] for i in (2, 3))]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(n, pa.int64()), *arrays], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple] = {}
        size = 0
        for batch in chunks(batches, "text"):
            for doc, file, row, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                text = text.translate(LOWER)
                # Rows without an id come before all others.
                own = (-1, 0, file, row) if doc is None else (0, doc, file, row)
                if text in held:
                    best, n = held[text]
                    held[text] = max(best, own), n + 1
                else:
                    held[text] = own, 1
                    size += len(text)
            if size > HELD_BYTES:
                yield rows(held)
                held, size = {}, 0
        if held:
            yield rows(held)

    return _source(docs).mapInArrow(run, schema)


def last(*columns: str) -> Column:
    return F.max(F.struct(*columns))


def absorb(spark: SparkSession, path: str, checkpoint: str, digest_bytes: int, files_per_batch: int) -> None:
    """Take the files at ``path`` that are new to ``checkpoint`` into its state."""
    # As a pattern, a single file serves as well as a folder.
    place, name = path.rstrip("/").rsplit("/", 1)
    stream = (
        spark.readStream.schema(spark.read.parquet(path).schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{place}/{name[:-1]}[{name[-1]}]")
    )
    state = arrivals(stream, digest_bytes).groupBy("digest").agg(
        last("doc_id", "file", "row").alias("keep"), F.sum("n").alias("n")
    )
    query = (
        state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def classes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``digest``, ``keep`` (``doc_id``, ``file``, ``row``) and ``n``: the state as a table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/state/0")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        keep = row_type(doc_id="long", file="string", row="long")
        return spark.createDataFrame([], T.StructType().add("digest", "binary").add("keep", keep).add("n", "long"))
    state = spark.read.format("statestore").load(checkpoint)
    parts = state.select("key.*", "value.*")
    digest, keep, n = parts.columns
    return parts.select(F.col(digest).alias("digest"), F.col(keep).alias("keep"), F.col(n).alias("n"))


def _place_hash(file: Column, row: Column) -> Column:
    return F.xxhash64(F.concat_ws("#", file, row.cast("string")).cast("binary"))


def rows_of(docs: DataFrame, table: np.ndarray, digest_bytes: int) -> DataFrame:
    """``doc_id``, ``file``, ``row``, ``digest``, ``sha256`` of every row, and ``text`` of some.

    That is the first of equal texts, as a task meets them, whose digest the bit table has,
    and rows whose place it has; others have null there.
    """
    schema = row_type(doc_id="long", file="string", row="long", digest="binary", sha256="binary", text="binary")
    shared = docs.sparkSession.sparkContext.broadcast(table.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)

        def passing(keys: list[bytes]) -> np.ndarray:
            first, second = bits_of(np.array([xxhash.xxh64_intdigest(k, 42) for k in keys], dtype=np.uint64))
            return bits[first] & bits[second]

        seen: set[bytes] = set()
        size = 0
        for batch in chunks(batches, "text"):
            texts = [t.translate(LOWER) for t in batch.column(3).to_pylist()]
            sums = [hashlib.sha256(t).digest() for t in texts]
            digests = [s[:digest_bytes] for s in sums]
            places = [f"{file}#{row}".encode() for file, row in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            shown: list[bytes | None] = []
            for text, hit, at in zip(texts, passing(digests), passing(places)):
                new = hit and text not in seen
                shown.append(text if new or at else None)
                if new:
                    seen.add(text)
                    size += len(text)
            if size > HELD_BYTES:
                seen, size = set(), 0
            columns = [pa.array(v, pa.binary()) for v in (digests, sums, shown)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *columns], names=schema.names)

    return _source(docs).mapInArrow(run, schema)


def deduplicated(
    spark: SparkSession, path: str, checkpoint: str | None = None, digest_bytes: int = 32, files_per_batch: int = 1_000
) -> DataFrame:
    """A row of ``RESULT`` for every row of the Parquet table at ``path``.

    ``group_size`` counts all rows that the state has seen. ``checkpoint`` is a folder for
    the state; it is to be used for one table (which may get new files) only.
    """
    with settings(spark, SETTINGS):
        checkpoint = checkpoint or stage_path(spark, "dedup-state")
        absorb(spark, path, checkpoint, digest_bytes, files_per_batch)
        state = staged(classes(spark, checkpoint), "classes")
    docs = spark.read.parquet(path)
    several = state.filter("n > 1")
    wanted = several.select(F.xxhash64("digest").alias("seed"))
    wanted = wanted.union(several.select(_place_hash(F.col("keep.file"), F.col("keep.row"))))
    rows = staged(rows_of(docs, bit_table(wanted), digest_bytes), "rows")

    # Full bytes on hits: each distinct text of a task against the one at the locator.
    shown = rows.filter(F.col("text").isNotNull())
    at = several.select("digest", F.col("keep.file").alias("file"), F.col("keep.row").alias("row"))
    held = staged(shown.select("file", "row", F.col("text").alias("held")).join(at, ["file", "row"]).select("digest", "held"), "held")
    compared = shown.select("digest", "text").join(held, "digest")
    differing = staged(compared.filter(F.col("text") != F.col("held")).select("digest").distinct(), "differing")

    place = F.struct(*PLACE)
    said = rows.select("doc_id", *PLACE, "digest", "sha256").join(state, "digest")
    same = said.join(differing, "digest", "left_anti") if not differing.isEmpty() else said
    result = same.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (place == F.struct("keep.file", "keep.row")).alias("kept"), F.hex("sha256").alias("text_sha256"),
    )
    if not differing.isEmpty():
        result = result.union(_by_text(docs, rows, differing))
    return result.withColumn("text_sha256", F.lower("text_sha256"))


def _by_text(docs: DataFrame, rows: DataFrame, digests: DataFrame) -> DataFrame:
    """The rows of some digests, told apart by their texts."""
    known = rows.select("doc_id", *PLACE, "digest", "sha256").join(digests, "digest", "left_semi")
    texts = _source(docs).select(*PLACE, ascii_lower(F.col("text").cast("string")).alias("text"))
    full = staged(known.join(texts, list(PLACE)), "by-text")
    groups = staged(full.groupBy("text").agg(last("doc_id", *PLACE).alias("keep"), F.count("*").alias("n")), "groups")
    return full.join(groups, "text").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.struct(*PLACE) == F.struct("keep.file", "keep.row")).alias("kept"), F.hex("sha256").alias("text_sha256"),
    )
