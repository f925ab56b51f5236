"""From framed records to parsed ones: headers, identity and the HTTP split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.functions import headers as H
from warcloom.functions.expr import computed_once
from warcloom.functions.http import (
    CRLF_BREAK,
    LF_BREAK,
    SHORTEST_MESSAGE,
    is_http_response,
    lf_break_at,
    text_before_break,
)
from warcloom.functions.identity import name_uuid
from warcloom.profiles import Profile, get_profile

# The record types that become documents, and the one whose
# target URI is indexed.
HTTP_TYPES = ("response", "request")
URI_TYPE = "response"


def parse_headers(records: DataFrame, profile: str | Profile) -> DataFrame:
    """Add the header map and what is read from it; content is not touched."""
    parsed = computed_once(records, "warc_headers", H.warc_headers(F.col("header_block")))
    parsed = parsed.withColumns(
        {
            "record_type": H.record_type(F.col("warc_headers")),
            "target_uri": H.target_uri(F.col("warc_headers")),
        }
    )
    return with_record_id(parsed, profile)


def with_record_id(df: DataFrame, profile: str | Profile) -> DataFrame:
    """Add ``record_id``: the profile's header, else a URN of the record's place.

    The stand-in is the same on every run and retry.
    """
    place = F.concat(F.col("source_file"), F.lit("#"), F.col("record_seq").cast("string"))
    stand_in = F.concat(F.lit("<urn:uuid:"), name_uuid(place), F.lit(">"))
    named = H.header(F.col("warc_headers"), get_profile(profile).id_field)
    return df.withColumn("record_id", F.coalesce(named, stand_in))


def keep_http_records(df: DataFrame) -> DataFrame:
    """Keep the records that become documents; the type is case-sensitive."""
    return df.filter(F.col("record_type").isin(*HTTP_TYPES))


def uri_rows(df: DataFrame) -> DataFrame:
    """Keep the records that are indexed by their URI."""
    return df.filter((F.col("record_type") == URI_TYPE) & F.col("target_uri").isNotNull())


def split_http(df: DataFrame) -> DataFrame:
    """Split ``content`` of HTTP responses into ``http_header_bytes`` and ``body``.

    Other records have a null header and their whole content as body. A message
    without a break loses its content; ``http_split_ok`` is false for it.
    """
    content = F.col("content")
    size = F.octet_length(content)
    is_http = is_http_response(H.header(F.col("warc_headers"), "Content-Type"))
    looked = df.withColumn("_http", is_http)
    looked = looked.withColumn("_head", F.when(F.col("_http"), text_before_break(content)))
    looked = looked.withColumns({"_lf": lf_break_at(F.col("_head")), "_crlf": F.octet_length(F.col("_head"))})

    short = size < SHORTEST_MESSAGE
    lf, crlf = F.col("_lf"), F.col("_crlf")
    # One line end of the break stays with the header.
    header_size = (
        F.when(short, 0)
        .when(lf.isNotNull(), lf + len(LF_BREAK) // 2)
        .when(crlf < size, crlf + len(CRLF_BREAK) // 2)
        .otherwise(0)
    )
    body_from = (
        F.when(short, 0)
        .when(lf.isNotNull(), lf + len(LF_BREAK))
        .when(crlf < size, crlf + len(CRLF_BREAK))
        .otherwise(size)
    )
    body = F.substring(content, body_from + 1, size)
    return looked.withColumns(
        {
            "http_header_bytes": F.when(F.col("_http"), F.substring(content, F.lit(1), header_size)),
            "body": F.when(F.col("_http"), body).otherwise(content),
            "http_split_ok": ~F.col("_http") | short | lf.isNotNull() | (crlf < size),
        }
    ).drop("_http", "_head", "_lf", "_crlf")


def parse_records(records: DataFrame, profile: str | Profile) -> DataFrame:
    """Framed records with everything parsed: headers, identity, HTTP header and body."""
    split = split_http(parse_headers(records, profile))
    return split.withColumns(
        {
            "http_headers": H.http_headers(F.col("http_header_bytes")),
            "content_length": H.stored_length(F.col("http_header_bytes"), F.col("body")),
        }
    ).drop("header_block", "content")


def to_warc_text(df: DataFrame) -> DataFrame:
    """Add ``warc_text``: the bytes of each parsed record as an archive holds them.

    The content length is that of the content written, whatever the map says.
    """
    http = F.col("http_header_bytes")
    # The header keeps one line end; the second one of its break goes back here.
    blank = F.when(F.substring(http, -2, 2) == F.lit(b"\r\n"), F.lit(b"\r\n")).otherwise(F.lit(b"\n"))
    has_header = F.coalesce(F.octet_length(http) > 0, F.lit(False))
    content = F.when(has_header, F.concat(http, blank, F.col("body"))).otherwise(F.col("body"))
    others = F.map_filter(F.col("warc_headers"), lambda k, v: F.lower(k) != "content-length")
    head = F.concat(
        H.warc_header_text(F.col("warc_version"), others),
        F.lit("Content-Length: "),
        F.octet_length(F.col("_content")).cast("string"),
        F.lit(H.CRLF * 2),
    )
    text = F.concat(head.cast("binary"), F.col("_content"))
    return df.withColumn("_content", content).withColumn("warc_text", text).drop("_content")
