"""Archive files as a DataFrame of records."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.operators.records import HTTP_TYPES, URI_TYPE
from warcloom.profiles import Profile, get_profile
from warcloom.sources.files import codec_of, open_file
from warcloom.sources.framing import ByteReader, SeekingReader, frames

RECORD_SCHEMA = (
    "source_file string, record_seq bigint, warc_version string, "
    "header_block binary, content binary"
)
_RECORD_ARROW = pa.schema(
    [
        ("source_file", pa.string()),
        ("record_seq", pa.int64()),
        ("warc_version", pa.string()),
        ("header_block", pa.binary()),
        ("content", pa.binary()),
    ]
)

BUILD_SCHEMA = RECORD_SCHEMA + ", id_repeat boolean, uri_repeat boolean, counts string"
_BUILD_ARROW = pa.schema(
    [*_RECORD_ARROW, ("id_repeat", pa.bool_()), ("uri_repeat", pa.bool_()), ("counts", pa.string())]
)
# Names and URIs that a task remembers at a time: some 10 MB of each.
SEEN_KEYS = 100_000

# Records leave a task in batches of about this many bytes, so that large bodies
# do not pile up, and of at most this many records. A worker holds up to four times as
# much: the records, their batch, the one before it and what is being sent of it.
BATCH_BYTES = 4 << 20
BATCH_RECORDS = 4096

# Plain files above this size are read by several tasks.
SPLIT_BYTES = 256 << 20


def warc_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files under a path or glob with their lengths; contents are not read.

    Spark packs files into tasks by size, so many small files share a task and
    each large one has its own.
    """
    return spark.read.format("binaryFile").load(path).select("path", "length")


def _batches(records: Iterable[tuple], schema: pa.Schema = _RECORD_ARROW) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for row in records:
        weight = len(row[3]) + len(row[4] or b"")
        if rows and (size + weight > BATCH_BYTES or len(rows) >= BATCH_RECORDS):
            yield _batch(rows, schema)
            size = 0
        rows.append(row)
        size += weight
    if rows:
        yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """The batch of some rows, which are let go: a task holds them once."""
    columns = [pa.array([row[n] for row in rows], t.type) for n, t in enumerate(schema)]
    rows.clear()
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _keeps(types: Iterable[str] | None, content: bool) -> Callable[[str | None], bool]:
    if not content:
        return lambda kind: False
    if types is None:
        return lambda kind: True
    wanted = frozenset(types)
    return lambda kind: kind in wanted


def _scan(profile: Profile, keeps: Callable[[str | None], bool]):
    """Task body: rows of (path, length, start, stop, first_seq) to record batches."""
    version = profile.version.encode()

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for piece in batch.to_pylist():
                path, stop = piece["path"], piece["stop"]
                with open_file(path) as file:
                    codec = codec_of(path)
                    if codec is None:
                        reader = SeekingReader(file, piece["start"], piece["length"])
                    else:
                        reader = ByteReader(codec(file))
                    found = frames(reader, version, keeps, stop)
                    for seq, frame in enumerate(found, piece["first_seq"]):
                        yield path, seq, profile.version, frame.header_block, frame.content

    return lambda batches: _batches(records(batches))


def _passing(seen: set[bytes], value: bytes) -> bool:
    """Whether a value has been seen; it is remembered, but not for ever."""
    digest = hashlib.blake2b(value, digest_size=16).digest()
    if digest in seen:
        return True
    if len(seen) >= SEEN_KEYS:
        seen.clear()
    seen.add(digest)
    return False


def _scan_to_build(profile: Profile):
    """Task body as ``_scan``, with repeats marked and a row of counts behind each piece.

    A piece is read in order, so a name or URI that came before in it can't be the first
    one of its key. Only what is sure to be read alike from the headers is compared:
    fields that are there once, in headers of ASCII. A forgotten repeat is left for the
    tables to find.
    """
    version = profile.version.encode()
    fields = (profile.id_field.lower().encode(), b"warc-target-uri")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for piece in batch.to_pylist():
                path, stop = piece["path"], piece["stop"]
                records, documents = 0, 0
                ids: set[bytes] = set()
                uris: set[bytes] = set()
                with open_file(path) as file:
                    codec = codec_of(path)
                    if codec is None:
                        reader = SeekingReader(file, piece["start"], piece["length"])
                    else:
                        reader = ByteReader(codec(file))
                    found = frames(reader, version, lambda kind: kind in HTTP_TYPES, stop, fields)
                    for seq, frame in enumerate(found, piece["first_seq"]):
                        records += 1
                        id_repeat = uri_repeat = False
                        if frame.kind in HTTP_TYPES:
                            documents += 1
                            if frame.header_block.isascii():
                                name, uri = frame.marks
                                id_repeat = name is not None and _passing(ids, name)
                                if frame.kind == URI_TYPE and uri is not None:
                                    uri_repeat = _passing(uris, uri)
                        yield (path, seq, profile.version, frame.header_block, frame.content, id_repeat, uri_repeat, None)
                counts = json.dumps({"records": records, "documents": documents})
                yield (path, piece["start"], profile.version, b"", None, False, False, counts)

    return lambda batches: _batches(rows(batches), _BUILD_ARROW)


def read_to_build(
    spark: SparkSession, path: str | list[str], profile: str | Profile, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Records as ``read_warc`` gives them, and what a build needs, in one pass.

    ``id_repeat`` and ``uri_repeat`` mark records whose key came before in the same file
    (or range of one). Rows with ``counts`` are no records: they say how many
    ``records`` and ``documents`` a piece had; their ``record_seq`` is where it starts.
    Only requests and responses carry content.
    """
    from warcloom.sources.splitting import split_files

    profile = get_profile(profile)
    pieces = split_files(spark, warc_files(spark, path), profile, split_bytes)
    return pieces.mapInArrow(_scan_to_build(profile), BUILD_SCHEMA)


def read_warc(
    spark: SparkSession,
    path: str | list[str],
    profile: str | Profile = "commoncrawl",
    types: Iterable[str] | None = None,
    content: bool = True,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """One row per record of the archives under ``path``.

    ``record_seq`` numbers the records of a file from 0. Records of a type not in
    ``types`` stay as rows but carry no content, and with ``content=False`` none
    does; bodies are then jumped over and cost neither memory nor transfer.
    Compressed files are read by one task each, plain ones by one task per
    ``split_bytes``.
    """
    from warcloom.sources.splitting import split_files

    profile = get_profile(profile)
    pieces = split_files(spark, warc_files(spark, path), profile, split_bytes)
    return pieces.mapInArrow(_scan(profile, _keeps(types, content)), RECORD_SCHEMA)
