"""Deterministic identities and the partition a key belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The RFC 4122 URL namespace, the digits a UUID variant nibble
# maps to, and the names of splits and segments.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
HEX_DIGITS = "0123456789abcdef"
VARIANT_DIGITS = "89ab89ab89ab89ab"
SPLIT_NAME_FORMAT = "%s-r-%05d"
SEGMENT_NAME_FORMAT = "segment-%05d"


def name_uuid(name: Column) -> Column:
    """Name-based UUID (version 5, URL namespace) of a string."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), name.cast("binary")))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(
            F.translate(F.substring(digest, 17, 1), HEX_DIGITS, VARIANT_DIGITS),
            F.substring(digest, 18, 3),
        ),
        F.substring(digest, 21, 12),
    )


def doc_uuid(prefix: str | Column, record_id: Column) -> Column:
    """Document UUID of a record id under a corpus prefix."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.when(record_id.isNotNull(), name_uuid(F.concat(prefix, F.lit(":"), record_id)))


def java_hash(key: Column) -> Column:
    """The 32-bit string hash used to place keys, over UTF-16 units.

    The JVM already has it, so it is called rather than folded character by
    character.
    """
    return F.java_method(
        F.lit("java.util.Objects"), F.lit("hashCode"), key
    ).cast("int")


def partition_id(key: Column, num_partitions: int | Column) -> Column:
    """Partition of a key: its hash modulo the partition count, never negative."""
    n = F.lit(num_partitions) if isinstance(num_partitions, int) else num_partitions
    return F.when(key.isNotNull(), F.pmod(java_hash(key), n.cast("int")))


def split_name(table: Column, part: Column) -> Column:
    """Name of one table's split, e.g. ``data-r-00012``."""
    return F.format_string(SPLIT_NAME_FORMAT, table, part)


def split_partition(name: Column) -> Column:
    """Partition id carried by a split name."""
    return F.regexp_replace(name, r"^\D+-", "").cast("int")


def segment_name(ordinal: Column) -> Column:
    """Name of the ``ordinal``-th segment, e.g. ``segment-00003``."""
    return F.format_string(SEGMENT_NAME_FORMAT, ordinal)
