"""Deterministic sharded WARC files: range-sorted, rolled by compressed size, committed.

``write_warc`` sorts pages by (id, digest) into shards. Their bounds come from the data: keys
are sampled by a hash of their own, each with its bytes, and a bound is set where a shard
is full. So dense, outlying, missing or repeated ids give shards of like size, and the
same table gives the same files on any cluster. A shard is written as a run of ``.warc.gz`` files, one gzip member
a record; a new file begins where the next record would pass the size limit. All headers
and digests are made anew. Of records with equal payloads, that with the smallest id is
a ``response``, the others are ``revisit`` records that refer to it.

Tasks write under names that no other attempt uses, and report what they wrote as rows
that Spark commits. Only files so reported are renamed, and the manifest table is
written last: a folder without a manifest isn't finished, and a task may run any number
of times.

Null payloads count as empty. Pages without an id come first and are always responses.
Rows equal in id and payload: the first is the response. Rows equal in id alone stand in
the order of their digests, and may be in several shards; rows equal in both are in one.
Memory of a task is bounded by a batch of pages.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warcloom.llm.common import chunks, drop_stage, row_type, stage_path

HEX_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: Profile of revisits that are found by digest. Fixed value of the WARC format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Keys that bounds are set by, shards at most, and bytes of a record beside its payload.
SAMPLED, SHARDS, HEAD_BYTES = 200_000, 10_000, 700
WRITTEN = row_type(
    shard="long", file_no="long", tmp="string", name="string", records="long", bytes="long", sha256="string"
)
READ = row_type(
    page_id="long", url="string", record_id="string", record_type="string", payload_digest="string",
    payload_bytes="long", refers_to="long", payload="binary", file="string",
)
Opener = Callable[[str], tuple[arrow_fs.FileSystem, str]]


def open_filesystem(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """A filesystem and the path in it; pass another function for special credentials."""
    if "://" not in uri:
        return arrow_fs.LocalFileSystem(), uri.removeprefix("file:")
    return arrow_fs.FileSystem.from_uri(uri)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column, without padding."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), HEX_DIGITS, BASE32)


def with_digests(pages: DataFrame) -> DataFrame:
    """Pages with their payload as bytes, its ``digest`` and its ``size``."""
    made = pages.select("page_id", "url", F.coalesce("payload", F.lit("")).cast("binary").alias("payload"))
    size = F.octet_length("payload").cast("long")
    return made.select("*", base32_sha1(F.col("payload")).alias("digest"), size.alias("size"))


def originals(digested: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id``, ``digest``, ``original``: the smallest id with an equal payload.

    Only for payloads that several rows have, of at least ``least_bytes``. Payloads
    themselves aren't moved for this.
    """
    keys = digested.filter(F.col("page_id").isNotNull() & (F.col("size") >= least_bytes)).select("page_id", "digest")
    counted = keys.groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("n"))
    several = counted.filter("n > 1").drop("n")
    return keys.join(several, "digest").distinct().select("page_id", "digest", "original")


Key = tuple[bool, int, str]


def key_of(page_id: int | None, digest: str) -> Key:
    """The place of a page in the order of shards; those without an id come first."""
    return (False, 0, digest) if page_id is None else (True, page_id, digest)


def shard_bounds(digested: DataFrame, shard_bytes: int) -> list[Key]:
    """The first keys of all shards but the first.

    Keys are weighed by the bytes of their rows. The driver gets ``SAMPLED`` keys or so: all of a
    small table, else those with a hash divisible by a number, which stand for the others.
    A table of more than ``SHARDS`` times ``shard_bytes`` gets longer shards.
    """
    n, total = digested.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    total += n * HEAD_BYTES
    each = max(shard_bytes, -(-total // SHARDS))
    if total <= each:
        return []
    one_of = max(1, n // SAMPLED)
    chosen = digested.filter(F.pmod(F.xxhash64("page_id", "digest"), F.lit(one_of)) == 0)
    # Repeats of a row are written without its payload.
    weight = F.max("size") + F.count("*") * HEAD_BYTES
    keys = chosen.groupBy("page_id", "digest").agg(weight.alias("weight")).collect()
    bounds, held = [], 0
    for key, size in sorted((key_of(r["page_id"], r["digest"]), r["weight"] * one_of) for r in keys):
        if held and held + size > each:
            bounds.append(key)
            held = 0
        held += size
    return bounds


def with_shards(rows: DataFrame, bounds: list[Key]) -> DataFrame:
    """Rows with the ``shard`` (int) that their id and digest belong to."""
    if not bounds:
        return rows.withColumn("shard", F.lit(0))
    schema = T.StructType([*rows.schema.fields, T.StructField("shard", T.IntegerType())])
    ids, digests = rows.columns.index("page_id"), rows.columns.index("digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = map(key_of, batch.column(ids).to_pylist(), batch.column(digests).to_pylist())
            shard = pa.array([bisect.bisect_right(bounds, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=schema.names)

    return rows.mapInArrow(run, schema)


def headers(fields: list[tuple[str, str | int]]) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {' '.join(str(v).split())}" for k, v in fields]]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def member(head: bytes, block: bytes) -> bytes:
    """A record as a gzip member of its own, the same for the same bytes."""
    return gzip.compress(head + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, '/'.join(map(str, parts)))}>"


def sha1(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def page_record(page: dict, revisit: bool, copy: int, date: str) -> bytes:
    """The record of a page; ``copy`` counts rows that are equal in id and payload."""
    url = page["url"] if page["url"] is not None else f"urn:page:{page['page_id']}"
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {page['size']}\r\n\r\n"
    block = http.encode() + (b"" if revisit else page["payload"])
    fields: list[tuple[str, str | int]] = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", urn(page["page_id"], page["digest"], copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{page['digest']}"),
        ("WARC-Block-Digest", sha1(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Payload-Length", page["size"]),
    ]
    if page["url"] is not None:
        fields.append(("Has-URL", "1"))
        if " ".join(url.split()) != url:
            # White space that a header line can't hold.
            fields.append(("URL-Base64", base64.b64encode(url.encode()).decode()))
    if page["page_id"] is not None:
        fields.append(("Page-ID", page["page_id"]))
    if revisit:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", urn(page["original"], page["digest"], 0)),
            ("Refers-To-Page-ID", page["original"]),
        ]
    return member(headers([*fields, ("Content-Length", len(block))]), block)


class ShardFiles:
    """Writes the files of shards, one after the other, below a folder of its own."""

    def __init__(self, out: str, roll_bytes: int, date: str, opener: Opener) -> None:
        self.folder = f"{out}/_tmp/{uuid.uuid4().hex}"
        self.roll_bytes, self.date, self.opener = roll_bytes, date, opener
        self.done: list[tuple] = []
        self.stream = None
        self.shard, self.file_no = None, 0

    def _open(self) -> None:
        self.name = f"shard-{self.shard:08d}-{self.file_no:05d}.warc.gz"
        self.tmp = f"{self.folder}/{self.name}"
        system, path = self.opener(self.tmp)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(path, compression=None)
        self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        block = b"software: warcloom\r\nformat: WARC File Format 1.1\r\n"
        fields = [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", urn("file", self.name)),
            ("WARC-Date", self.date),
            ("WARC-Filename", self.name),
            ("Content-Type", "application/warc-fields"),
            ("Content-Length", len(block)),
        ]
        self._put(member(headers(fields), block))

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.sha.update(data)
        self.size += len(data)

    def add(self, shard: int, record: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.file_no = shard, 0
        elif self.stream and self.records and self.size + len(record) > self.roll_bytes:
            self.close()
            self.file_no += 1
        if self.stream is None:
            self._open()
        self._put(record)
        self.records += 1

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append((self.shard, self.file_no, self.tmp, self.name, self.records, self.size, self.sha.hexdigest()))
            self.stream = None


def write_warc(
    pages: DataFrame,
    out: str,
    least_bytes: int = 0,
    shard_bytes: int = 64 << 20,
    roll_bytes: int = 32 << 20,
    date: str = "2020-01-01T00:00:00Z",
    opener: Opener = open_filesystem,
) -> DataFrame:
    """Write pages (``page_id`` long, ``url``, ``payload`` string) and return the manifest.

    Payloads of at least ``least_bytes`` are written once; repeats refer to the first.
    ``out`` must be new and reachable from all executors.
    """
    spark = pages.sparkSession
    digested = with_digests(pages)
    bounds = shard_bounds(digested, shard_bytes)
    notes = originals(digested, least_bytes)
    # A page and the note on its original meet in the shard, the note first: payloads are
    # shuffled once.
    both = digested.withColumn("note", F.lit(1)).unionByName(notes.withColumn("note", F.lit(0)), allowMissingColumns=True)
    order = ["shard", "page_id", "digest", "note"]
    ordered = with_shards(both, bounds).repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, before, copy, noted = ShardFiles(out, roll_bytes, date, opener), None, 0, (None, None)
        for batch in chunks(batches, "payload"):
            for page in batch.to_pylist():
                key = (page["page_id"], page["digest"])
                if not page["note"]:
                    noted = (key, page["original"])
                    continue
                copy = copy + 1 if key == before else 0
                before = key
                original = page["original"] = noted[1] if noted[0] == key else None
                revisit = original is not None and (page["page_id"] != original or copy > 0)
                files.add(page["shard"], page_record(page, revisit, copy, date))
        files.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in files.done], t) for i, t in enumerate(
                [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()])],
            names=WRITTEN.names,
        )

    reported = stage_path(spark, "written")
    ordered.mapInArrow(write, WRITTEN).write.parquet(reported)
    written = spark.read.schema(WRITTEN).parquet(reported)

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, tmp = opener(row["tmp"])
                _, final = opener(f"{out}/data/{row['name']}")
                system.create_dir(final.rsplit("/", 1)[0], recursive=True)
                # A commit that runs again finds the work done.
                if system.get_file_info(tmp).type == arrow_fs.FileType.File:
                    system.move(tmp, final)
                if system.get_file_info(final).size != row["bytes"]:
                    raise OSError(f"not committed: {final}")
            yield batch

    committed = written.repartition(spark.sparkContext.defaultParallelism).mapInArrow(commit, WRITTEN)
    committed.drop("tmp").write.parquet(f"{out}/manifest")
    drop_stage(spark, reported)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/_tmp")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    return manifest(spark, out)


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """``shard``, ``file_no``, ``name``, ``records``, ``bytes``, ``sha256`` of each file."""
    return spark.read.schema(T.StructType([f for f in WRITTEN if f.name != "tmp"])).parquet(f"{out}/manifest")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The contents of a file's gzip members, one at a time."""
    inflate, parts, data = zlib.decompressobj(31), [], stream.read(chunk)
    while data:
        parts.append(inflate.decompress(data))
        if inflate.eof:
            yield b"".join(parts)
            data, inflate, parts = inflate.unused_data, zlib.decompressobj(31), []
            data = data or stream.read(chunk)
        else:
            data = stream.read(chunk)
    if any(parts):
        raise ValueError("the file ends within a record")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def page_row(fields: dict[str, str], block: bytes, file: str) -> tuple:
    """A row of ``READ``; digests are computed anew and must be those in the headers."""
    http, _, payload = block.partition(b"\r\n\r\n")
    if sha1(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"{file}: wrong block digest of {fields['WARC-Record-ID']}")
    kind, size = fields["WARC-Type"], int(fields["Payload-Length"])
    if kind == "response" and (sha1(payload), len(payload)) != (fields["WARC-Payload-Digest"], size):
        raise ValueError(f"{file}: wrong payload digest of {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    url = fields["WARC-Target-URI"] if "Has-URL" in fields else None
    if "URL-Base64" in fields:
        url = base64.b64decode(fields["URL-Base64"]).decode()
    return (
        number("Page-ID"),
        url,
        fields["WARC-Record-ID"],
        kind,
        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        size,
        number("Refers-To-Page-ID"),
        payload if kind == "response" else None,
        file,
    )


def read_warc(spark: SparkSession, out: str, payloads: bool = True, opener: Opener = open_filesystem) -> DataFrame:
    """The records of a finished folder as rows of ``READ``, one task a file at a time.

    Without ``payloads`` they are checked and then left out.
    """
    schema = READ if payloads else T.StructType([f for f in READ if f.name != "payload"])
    names = manifest(spark, out).select("name")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(READ)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            whole = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), arrow)], schema=arrow)
            return whole.select(schema.names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, path = opener(f"{out}/data/{name}")
                rows, held = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for record in members(stream):
                        fields, block = parse_record(record)
                        if fields["WARC-Type"] != "warcinfo":
                            rows.append(page_row(fields, block, name))
                            held += len(block)
                        if held > 8 << 20 or len(rows) >= 5_000:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    spread = names.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "name")
    return spread.mapInArrow(read, schema)
