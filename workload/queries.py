"""Registered queries: each runs package operators over captures of whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import warcloom as w
from warcloom.functions import charset as C
from warcloom.functions import headers as H
from warcloom.functions.identity import (
    java_hash,
    partition_id,
    segment_name,
    split_name,
    split_partition,
)
from warcloom.operators.tables import DATA, URI
from warcloom.scratch import scratch_path
from workload.captures import PARTS, PREFIX, SEGMENTS, base, captures, write_archives

PROFILE = "commoncrawl"
ID = ("source_file", "record_seq")


def _digest(text: str) -> Column:
    return F.md5(F.col(text).cast("binary"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.parse_records(captures(spark, sf_dir), PROFILE)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.build_docs(w.keep_http_records(_parsed(spark, sf_dir)), PREFIX)


def _archives(spark: SparkSession, sf_dir: str, *folders: str, **options) -> str:
    path = scratch_path(spark, "archives")
    return write_archives(captures(spark, sf_dir), path, *folders, **options)


def _tables(spark: SparkSession, sf_dir: str) -> w.Tables:
    path = scratch_path(spark, "tables")
    w.write_tables(_docs(spark, sf_dir), path, PARTS)
    return w.open_tables(spark, path)


def _segment_tables(spark: SparkSession, sf_dir: str) -> list[str]:
    """The tables of each segment, in segment order."""
    out = scratch_path(spark, "segments")
    segments = [f"segment-{n:05d}" for n in range(SEGMENTS)]
    w.write_tables(_docs(spark, sf_dir), out, PARTS, segments)
    return [w.segment_path(out, s) for s in segments]


# --- scans -----------------------------------------------------------------


def archive_listing(spark, sf_dir):
    """Files of a glob and their sizes, summed per segment."""
    root = _archives(spark, sf_dir, "segment", compression="none")
    files = w.warc_files(spark, f"{root}/segment=*/*")
    segment = F.regexp_extract("path", "/segment=([^/]+)/", 1)
    return files.groupBy(segment.alias("segment")).agg(F.sum("length").alias("total_bytes"))


def _scanned(records: DataFrame) -> DataFrame:
    parsed = w.parse_headers(records, PROFILE)
    return parsed.select(
        H.header(F.col("warc_headers"), "WARC-TREC-ID").alias("trec_id"),
        "record_type",
        "target_uri",
        F.octet_length("content").cast("bigint").alias("content_bytes"),
        F.md5("content").alias("content_md5"),
    )


def warc_scan(spark, sf_dir):
    """Gzip archives back to records."""
    return _scanned(w.read_warc(spark, _archives(spark, sf_dir), PROFILE))


def warc_scan_bzip2(spark, sf_dir):
    """bzip2 archives back to records."""
    return _scanned(w.read_warc(spark, _archives(spark, sf_dir, compression="bzip2"), PROFILE))


def warc_scan_split(spark, sf_dir):
    """Plain archives, each read by several tasks."""
    path = _archives(spark, sf_dir, compression="none")
    return _scanned(w.read_warc(spark, path, PROFILE, split_bytes=256 << 10))


def warc_scan_types(spark, sf_dir):
    """Content only for the record types asked for."""
    path = _archives(spark, sf_dir)
    return _scanned(w.read_warc(spark, path, PROFILE, types=["request", "response"]))


def corpus_profiles(spark, sf_dir):
    """The same records under each profile's version and id field."""
    records = captures(spark, sf_dir)
    found = []
    for name, profile in w.PROFILES.items():
        path = scratch_path(spark, name)
        write_archives(records, path, version=profile.version)
        parsed = w.parse_headers(w.read_warc(spark, path, name), name)
        found.append(
            parsed.filter(H.header(F.col("warc_headers"), profile.id_field).isNotNull()).select(
                F.lit(name).alias("profile"), "warc_version", "record_id"
            )
        )
    return found[0].unionByName(found[1]).unionByName(found[2])


def split_listing(spark, sf_dir):
    """The table splits under a path."""
    splits = w.distinct_splits(w.list_splits(spark, _tables(spark, sf_dir).path))
    return splits.select("name", F.col("part").cast("bigint").alias("part"))


def mapfile_roundtrip(spark, sf_dir):
    """The URI table out as map files and back."""
    rows = _tables(spark, sf_dir).rows.filter(F.col("table") == URI)
    path = scratch_path(spark, "mapfiles")
    w.write_map_files(rows, path, PARTS, name=URI)
    return w.read_map_files(spark, path)


def mapfile_data_roundtrip(spark, sf_dir):
    """The data table out as map files and back, documents and all."""
    rows = _tables(spark, sf_dir).rows.filter(F.col("table") == DATA)
    path = scratch_path(spark, "mapfiles")
    w.write_map_files(rows, path, PARTS, name=DATA)
    body = F.get_json_object("value", "$.payload.body").cast("binary")
    return w.read_map_files(spark, path).select("key", F.md5(body).alias("body_md5"))


# --- projections -----------------------------------------------------------


def warc_header_map(spark, sf_dir):
    """H1, H2: header maps, one row per entry."""
    parsed = w.parse_headers(captures(spark, sf_dir), PROFILE)
    return parsed.select(*ID, F.explode("warc_headers")).select(
        *ID, F.col("key").alias("name"), F.col("value").alias("content")
    )


def header_lookup(spark, sf_dir):
    """H5: look-ups that ignore the case of the name."""
    parsed = w.parse_headers(captures(spark, sf_dir), PROFILE)
    item = lambda name: H.header(F.col("warc_headers"), name)
    return parsed.select(
        *ID,
        item("X-NOTE").alias("note"),
        item("warc-trec-id").alias("trec_id"),
        item("absent").alias("absent"),
    )


def http_split(spark, sf_dir):
    """H3: HTTP header and body of every record."""
    return _parsed(spark, sf_dir).select(
        *ID,
        F.octet_length("http_header_bytes").cast("bigint").alias("header_bytes"),
        F.octet_length("body").cast("bigint").alias("body_bytes"),
        F.md5("body").alias("body_md5"),
        "http_split_ok",
    )


def http_header_map(spark, sf_dir):
    """H4: HTTP header maps with the status line, one row per entry."""
    return _parsed(spark, sf_dir).select(*ID, F.explode("http_headers")).select(
        *ID, F.col("key").alias("name"), F.col("value").alias("content")
    )


def record_identity(spark, sf_dir):
    """H6-H8: record id, type and URI, with stand-ins for missing ids."""
    parsed = w.parse_headers(captures(spark, sf_dir), PROFILE)
    return parsed.select(*ID, "record_id", "record_type", "target_uri")


def stored_length(spark, sf_dir):
    """H9: content length after the split, and the one the header states."""
    return _parsed(spark, sf_dir).select(
        *ID,
        F.col("content_length").cast("bigint").alias("content_length"),
        H.header(F.col("warc_headers"), "Content-Length").alias("stated"),
    )


def record_text(spark, sf_dir):
    """Records as text."""
    head = H.warc_header_text(F.col("warc_version"), F.col("warc_headers"))
    text = H.record_text(F.col("http_header_bytes"), F.col("body_text"))
    return _docs(spark, sf_dir).select(*ID, F.md5(F.concat(head, text).cast("binary")).alias("text_md5"))


# --- filters ---------------------------------------------------------------


def http_records(spark, sf_dir):
    """Records that become documents."""
    parsed = w.parse_headers(captures(spark, sf_dir), PROFILE)
    return w.keep_http_records(parsed).select(*ID, "record_type")


def uri_records(spark, sf_dir):
    """Records indexed by URI."""
    parsed = w.parse_headers(captures(spark, sf_dir), PROFILE)
    return w.uri_rows(parsed).select(*ID, "target_uri")


def segment_range(spark, sf_dir):
    """Segments of a range with their ordinal; each source and crawl segment is one."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = captures(spark, sf_dir).select("segment").unionByName(
        documents.select(F.col("source").alias("segment"))
    )
    return w.segment_range(names, "segment-00001", "src15").select(
        "segment",
        F.col("ordinal").cast("bigint").alias("ordinal"),
        segment_name(F.col("ordinal")).alias("folder"),
    )


# --- scalar functions ------------------------------------------------------


def encoding_choice(spark, sf_dir):
    """The encoding of every record."""
    return w.choose_encoding(_parsed(spark, sf_dir)).select(*ID, "encoding")


def binary_detect(spark, sf_dir):
    """C4: whether each body looks binary."""
    return _parsed(spark, sf_dir).select(*ID, C.looks_binary(F.col("body")).alias("is_binary"))


def body_decode(spark, sf_dir):
    """Bodies as text."""
    return _docs(spark, sf_dir).select(
        *ID, F.length("body_text").cast("bigint").alias("chars"), _digest("body_text").alias("text_md5")
    )


def body_base64(spark, sf_dir):
    """Every body as base64, in one line."""
    parsed = _parsed(spark, sf_dir)
    with C.body_text_settings(spark):
        text = parsed.select(*ID, C.base64_text(F.col("body")).alias("text"))
    return text.select(
        *ID, F.length("text").cast("bigint").alias("chars"), _digest("text").alias("text_md5")
    )


def payload_flags(spark, sf_dir):
    """The payload's encoding flag, and what the body really is."""
    return _docs(spark, sf_dir).select(*ID, "body_encoding", "body_is_base64")


def json_document(spark, sf_dir):
    """Fields read back from the JSON text."""
    item = lambda path: F.get_json_object("json", path)
    fields = _docs(spark, sf_dir).select(
        *ID,
        item("$.metadata.WARC-Type").alias("record_type"),
        item("$.metadata.X-Note").alias("note"),
        item("$.payload.headers.__HTTP_STATUS__").alias("status"),
        item("$.payload.headers.Set-Cookie").alias("cookie"),
        item("$.payload.encoding").alias("body_encoding"),
        item("$.payload.body").alias("body"),
    )
    return fields.withColumn("body_md5", _digest("body")).drop("body")


def doc_uuid(spark, sf_dir):
    """Document UUIDs."""
    return _docs(spark, sf_dir).select(*ID, "record_id", "uuid")


def java_hash_partition(spark, sf_dir):
    """Hash, partition and split of every address."""
    part = partition_id(F.col("url"), PARTS)
    name = split_name(F.lit(URI), part)
    return base(spark, sf_dir).select(
        "cap",
        java_hash(F.col("url")).cast("bigint").alias("hash"),
        part.cast("bigint").alias("part"),
        name.alias("split"),
        split_partition(name).cast("bigint").alias("split_part"),
    )


# --- aggregations ----------------------------------------------------------


def data_dedupe_first(spark, sf_dir):
    """A1: the first document of each UUID."""
    rows = w.map_rows(_docs(spark, sf_dir)).filter(F.col("table") == DATA)
    first = w.first_per_key(rows)
    return first.select(
        "key", *ID, F.md5(F.get_json_object("value", "$.payload.body").cast("binary")).alias("body_md5")
    )


def uri_index(spark, sf_dir):
    """A2: the first UUID of each URI; one URI belongs to a third of all records."""
    rows = w.map_rows(_docs(spark, sf_dir)).filter(F.col("table") == URI)
    return w.first_per_key(rows).select("key", "value", *ID)


def counters(spark, sf_dir):
    """A4: generator counters."""
    encoded = w.choose_encoding(_parsed(spark, sf_dir))
    return w.counters(encoded.withColumn("uuid", w.doc_uuid(PREFIX, F.col("record_id"))))


def split_counter(spark, sf_dir):
    """How many splits a merge of all segments takes up."""
    splits = [w.list_splits(spark, path) for path in _segment_tables(spark, sf_dir)]
    together = splits[0]
    for more in splits[1:]:
        together = together.unionByName(more)
    return w.split_counter(together)


# --- tables ----------------------------------------------------------------


def partition_sizes(spark, sf_dir):
    """Rows of each written part."""
    rows = _tables(spark, sf_dir).rows
    return rows.groupBy("table", F.col("part").cast("bigint").alias("part")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("key").alias("first_key"),
        F.max("key").alias("last_key"),
    )


def table_rows(spark, sf_dir):
    """Both written tables; documents by their body."""
    rows = _tables(spark, sf_dir).rows
    body = F.md5(F.get_json_object("value", "$.payload.body").cast("binary"))
    return rows.select(
        "table",
        "key",
        F.when(F.col("table") == DATA, body).otherwise(F.col("value")).alias("content"),
    )


def _merged(rows: DataFrame) -> DataFrame:
    body = F.md5(F.get_json_object("value", "$.payload.body").cast("binary"))
    return rows.select(
        "table",
        "key",
        F.col("part").cast("bigint").alias("part"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
        F.when(F.col("table") == DATA, body).otherwise(F.col("value")).alias("content"),
    )


def merge_segments(spark, sf_dir):
    """Segment tables merged, all rows kept."""
    out = scratch_path(spark, "merged")
    w.merge_batches(spark, _segment_tables(spark, sf_dir), out)
    return _merged(w.open_tables(spark, out).rows)


def merge_first_wins(spark, sf_dir):
    """Segment tables merged, the first segment of a key wins."""
    out = scratch_path(spark, "merged")
    w.merge_batches(spark, _segment_tables(spark, sf_dir), out, mode="first_wins")
    return _merged(w.open_tables(spark, out).rows)


def merge_counters(spark, sf_dir):
    """Merge counters."""
    return w.merge_batches(spark, _segment_tables(spark, sf_dir), scratch_path(spark, "merged"))


# --- look-ups --------------------------------------------------------------


def _body(rows: DataFrame, *columns: str) -> DataFrame:
    text = F.get_json_object("value", "$.payload.body").cast("binary")
    return rows.select(*columns, F.md5(text).alias("body_md5"), "found")


def lookup_uuid(spark, sf_dir):
    """Documents of all record ids, including records that made none."""
    parsed = w.parse_headers(captures(spark, sf_dir), PROFILE)
    keys = parsed.select(w.doc_uuid(PREFIX, F.col("record_id")).alias("key"))
    found = w.lookup(spark, _tables(spark, sf_dir), keys)
    return _body(found.withColumn("part", F.col("part").cast("bigint")), "key", "part")


def lookup_name(spark, sf_dir):
    """L2: documents by prefix and record id."""
    names = w.parse_headers(captures(spark, sf_dir), PROFILE).select(F.col("record_id").alias("name"))
    found = w.lookup(spark, _tables(spark, sf_dir), names, by="name", prefix=PREFIX)
    return _body(found, "key")


def lookup_uri(spark, sf_dir):
    """L3: UUIDs of all addresses, including those without a record."""
    keys = base(spark, sf_dir).select(F.col("url").alias("key"))
    found = w.lookup(spark, _tables(spark, sf_dir), keys, by="uri")
    return found.select("key", F.col("part").cast("bigint").alias("part"), "value", "found")


def uri_to_document(spark, sf_dir):
    """L4: documents of all addresses."""
    uris = base(spark, sf_dir).select(F.col("url").alias("uri"))
    return _body(w.documents_by_uri(spark, _tables(spark, sf_dir), uris), "uri", "uuid")


def lookup_missing(spark, sf_dir):
    """Addresses without a record."""
    keys = base(spark, sf_dir).select(F.col("url").alias("key"))
    missing = w.missing_keys(spark, _tables(spark, sf_dir), keys, by="uri")
    return missing.select("key", F.col("part").cast("bigint").alias("part"))


def lookup_render(spark, sf_dir):
    """Verbose display of all URI entries."""
    tables = _tables(spark, sf_dir)
    keys = tables.rows.filter(F.col("table") == URI).select("key")
    return w.render(w.lookup(spark, tables, keys, by="uri"), "verbose", URI, "out")


def lookup_in_slices(spark, sf_dir):
    """L1: documents of all record ids, the keys brought to the table in many slices."""
    parsed = w.parse_headers(captures(spark, sf_dir), PROFILE)
    keys = parsed.select(w.doc_uuid(PREFIX, F.col("record_id")).alias("key"))
    found = w.lookup(spark, _tables(spark, sf_dir), keys, slice_bytes=16 << 10)
    return _body(found.withColumn("part", F.col("part").cast("bigint")), "key", "part")


# --- jobs ------------------------------------------------------------------


def archive_roundtrip(spark, sf_dir):
    """K6: parsed records out as archives, read again and made into documents."""
    path = scratch_path(spark, "rewritten")
    w.write_warc(_parsed(spark, sf_dir), path)
    docs = w.build_docs(
        w.keep_http_records(w.parse_records(w.read_warc(spark, path, PROFILE), PROFILE)), PREFIX
    )
    named = H.header(F.col("warc_headers"), "WARC-Record-ID")
    return docs.select(
        H.header(F.col("warc_headers"), "WARC-TREC-ID").alias("trec_id"),
        F.when(named.isNotNull(), F.col("uuid")).alias("uuid"),
        "encoding",
        _digest("body_text").alias("text_md5"),
    )


def archive_file_counts(spark, sf_dir):
    """K6: records written, over all files."""
    written = w.write_warc(_parsed(spark, sf_dir), scratch_path(spark, "rewritten"))
    return written.agg(F.sum("records").alias("records"))


def build_tables(spark, sf_dir):
    """K7: archives to tables in one job; its counters."""
    out = scratch_path(spark, "built")
    return w.build_tables(spark, _archives(spark, sf_dir), PROFILE, PREFIX, out, PARTS)


def _built(rows: DataFrame, *columns: str) -> DataFrame:
    """Documents of built tables by the capture they are from; ids that the reader made up are left out."""
    item = lambda path: F.get_json_object("value", path)
    capture = F.regexp_extract(item("$.metadata.WARC-TREC-ID"), "trec-([0-9]+)-", 1).cast("bigint")
    return rows.filter(F.col("table") == DATA).select(
        *columns,
        capture.alias("cap"),
        F.when(item("$.metadata.WARC-Record-ID").isNotNull(), F.col("key")).alias("key"),
        F.md5(item("$.payload.body").cast("binary")).alias("body_md5"),
    )


def _of_either_order(rows: DataFrame) -> DataFrame:
    """Of captures with two versions, archives in folders don't say which one stands first."""
    return rows.withColumn("body_md5", F.when(F.col("cap") % 7 != 0, F.col("body_md5")))


def built_rows(spark, sf_dir):
    """K7: archives to tables in one job; its documents."""
    out = scratch_path(spark, "built")
    w.build_tables(spark, _archives(spark, sf_dir), PROFILE, PREFIX, out, PARTS)
    return _built(w.open_tables(spark, out).rows)


def _added(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Tables of two segments, to which all are added, and the counters after that."""
    root = _archives(spark, sf_dir, "segment")
    out = scratch_path(spark, "added")
    some = [f"{root}/segment=segment-{n:05d}/*" for n in (0, 1)]
    w.build_tables(spark, some, PROFILE, PREFIX, out, PARTS)
    return out, w.add_to_tables(spark, f"{root}/*/*", PROFILE, PREFIX, out)


def added_rows(spark, sf_dir):
    """A1, A2, K7: a build added to existing tables; documents and addresses of both."""
    rows = w.open_tables(spark, _added(spark, sf_dir)[0]).rows
    part = F.col("part").cast("bigint").alias("part")
    uris = rows.filter(F.col("table") == URI).select(F.lit(None).cast("bigint").alias("cap"), "key", part)
    docs = _of_either_order(_built(rows, part))
    named = F.when(F.col("key").isNotNull(), F.col("part"))
    docs = docs.withColumn("part", named).unionByName(uris, allowMissingColumns=True)
    return docs.select("cap", "key", "part", "body_md5")


def added_counters(spark, sf_dir):
    """A4, K7: counters of a build added to existing tables."""
    return _added(spark, sf_dir)[1]


def merge_in_order(spark, sf_dir):
    """Large parts merged into several files, which are one order of keys."""
    out = scratch_path(spark, "merged")
    w.merge_batches(spark, _segment_tables(spark, sf_dir), out, hot_rows=10)
    rows = spark.read.schema("key string, ordinal int, table string, part int").parquet(out)
    rows = rows.select("*", "_metadata.file_name", "_metadata.row_index")
    place = Window.partitionBy("table", "part").orderBy("file_name", "row_index")
    this, before = F.struct("key", "ordinal"), F.lag(F.struct("key", "ordinal")).over(place)
    return rows.withColumn("wrong", before > this).groupBy("table", F.col("part").cast("bigint").alias("part")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("wrong").alias("out_of_order"),
        (F.count_distinct("file_name") > 1).alias("cut"),
    )


def corpus_rows(spark, sf_dir):
    """K9: documents of every segment of a corpus."""
    root = _archives(spark, sf_dir, "segment")
    out = scratch_path(spark, "corpus")
    w.build_corpus(spark, root, PROFILE, PREFIX, out, PARTS, files="*")
    return _of_either_order(_built(w.open_tables(spark, out).rows, "segment"))


def build_corpus(spark, sf_dir):
    """K9: tables of every segment; rows of each part."""
    root = _archives(spark, sf_dir, "segment")
    out = scratch_path(spark, "corpus")
    w.build_corpus(spark, root, PROFILE, PREFIX, out, PARTS, files="*")
    rows = w.open_tables(spark, out).rows.filter(F.col("table") == URI)
    return rows.select("segment", F.col("part").cast("bigint").alias("part"), "key")


def corpus_in_two_runs(spark, sf_dir):
    """K9: the segments of a corpus built in two calls, one segment twice."""
    root = _archives(spark, sf_dir, "segment")
    out = scratch_path(spark, "corpus")
    w.build_corpus(spark, root, PROFILE, PREFIX, out, PARTS, hi="segment=segment-00001", files="*")
    w.build_corpus(spark, root, PROFILE, PREFIX, out, PARTS, lo="segment=segment-00001", files="*")
    rows = w.open_tables(spark, out).rows.filter(F.col("table") == URI)
    return rows.select("segment", F.col("part").cast("bigint").alias("part"), "key")


def corpus_counters(spark, sf_dir):
    """K9, A4: counters of a range of segments."""
    root = _archives(spark, sf_dir, "segment")
    out = scratch_path(spark, "corpus")
    return w.build_corpus(
        spark, root, PROFILE, PREFIX, out, PARTS,
        lo="segment=segment-00001", hi="segment=segment-00002", files="*",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        archive_listing, warc_scan, warc_scan_bzip2, warc_scan_split, warc_scan_types,
        corpus_profiles, split_listing, mapfile_roundtrip, mapfile_data_roundtrip, warc_header_map, header_lookup,
        http_split, http_header_map, record_identity, stored_length, record_text,
        http_records, uri_records, segment_range, encoding_choice, binary_detect,
        body_decode, body_base64, payload_flags, json_document, doc_uuid,
        java_hash_partition, data_dedupe_first, uri_index, counters, split_counter,
        partition_sizes, table_rows, merge_segments, merge_first_wins, merge_counters,
        lookup_uuid, lookup_name, lookup_uri, uri_to_document, lookup_missing,
        lookup_render, archive_roundtrip, archive_file_counts, build_tables,
        build_corpus, corpus_in_two_runs, corpus_counters, lookup_in_slices, built_rows,
        added_rows, added_counters, merge_in_order, corpus_rows,
    )
}
