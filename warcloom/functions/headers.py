"""Header blocks as maps: parsing, case-insensitive maps, look-up and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from warcloom.functions.expr import let, raw_text, trim_blanks

# The key a status line is stored under and what it starts with.
STATUS_KEY = "__HTTP_STATUS__"
STATUS_START = "HTTP/1."
CRLF = "\r\n"


def header_pairs(text: Column, status_line: bool = False) -> Column:
    """Header text to an array of (key, value), in line order.

    A line without a colon has an empty value; a line with an empty key is left
    out. With ``status_line``, an ``HTTP/1.x`` line without a colon becomes the
    value of ``__HTTP_STATUS__``.
    """

    def pair(line: Column) -> Column:
        def named(parts: Column) -> Column:
            key = trim_blanks(F.get(parts, F.lit(0)))
            value = F.coalesce(trim_blanks(F.get(parts, F.lit(1))), F.lit(""))
            if status_line:
                is_status = (F.size(parts) == 1) & key.startswith(STATUS_START)
                return F.struct(
                    F.when(is_status, F.lit(STATUS_KEY)).otherwise(key).alias("key"),
                    F.when(is_status, key).otherwise(value).alias("value"),
                )
            return F.struct(key.alias("key"), value.alias("value"))

        return let(F.split(line, ":", 2), named)

    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(F.transform(lines, pair), lambda p: p["key"] != "")


def ci_map(pairs: Column) -> Column:
    """(key, value) array to a map that ignores key case.

    The first spelling of a key and its last value are kept; entries are in key
    order, ignoring case.
    """

    def numbered(pair: Column, at: Column) -> Column:
        return F.struct(
            F.lower(pair["key"]).alias("name"), at.alias("at"), pair["key"].alias("key"), pair["value"].alias("value")
        )

    def build(lines: Column) -> Column:
        # Lines of one name now stand together, in line order.
        other = lambda line, at: F.coalesce(F.get(lines, at)["name"] != line["name"], F.lit(True))
        first = F.filter(lines, lambda line, at: other(line, at - 1))
        last = F.filter(lines, lambda line, at: other(line, at + 1))
        return F.map_from_arrays(first["key"], last["value"])

    return let(F.sort_array(F.transform(pairs, numbered)), build)


def warc_headers(block: Column) -> Column:
    """WARC header bytes to a case-insensitive map; malformed UTF-8 is replaced."""
    return ci_map(header_pairs(F.make_valid_utf8(raw_text(block))))


def ascii_text(data: Column) -> Column:
    """Bytes as US-ASCII; each byte outside it becomes U+FFFD."""
    return F.regexp_replace(F.decode(data, "ISO-8859-1"), r"[\x80-\xff]", "�")


def http_headers(header_bytes: Column) -> Column:
    """HTTP header bytes to a case-insensitive map; null bytes give an empty map."""
    text = ascii_text(F.coalesce(header_bytes, F.lit(b"")))
    return ci_map(header_pairs(text, status_line=True))


def header(headers: Column, name: str) -> Column:
    """Value of a header, ignoring the case of its name; null if absent."""
    names = F.transform(F.map_keys(headers), F.lower)
    at = F.array_position(names, F.lit(name.lower())).cast("int") - 1
    return F.get(F.map_values(headers), at)


def record_type(headers: Column) -> Column:
    """``WARC-Type`` of a record."""
    return header(headers, "WARC-Type")


def target_uri(headers: Column) -> Column:
    """``WARC-Target-URI`` of a record."""
    return header(headers, "WARC-Target-URI")


def stored_length(http_header_bytes: Column, body: Column) -> Column:
    """Content length of a split record: header bytes, body bytes and the break between."""
    size = lambda c: F.coalesce(F.octet_length(c), F.lit(0))
    return size(http_header_bytes) + size(body) + F.lit(len(CRLF))


def header_text(headers: Column) -> Column:
    """A header map as ``key: value`` lines."""
    line = lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit(CRLF))
    return F.array_join(F.transform(F.map_entries(headers), line), "")


def warc_header_text(version: Column, headers: Column) -> Column:
    """A record's version line and header lines."""
    return F.concat(version, F.lit(CRLF), header_text(headers))


def record_text(http_header_bytes: Column, body_text: Column) -> Column:
    """A record's content as text: HTTP header, line break, decoded body."""
    head = ascii_text(F.coalesce(http_header_bytes, F.lit(b"")))
    return F.concat(head, F.lit(CRLF), body_text)
