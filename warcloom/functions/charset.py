"""Choosing a body's encoding and turning its bytes into text."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from warcloom.functions.expr import raw_text, trim_blanks

# The encoding of requests, the default of HTTP/1.1, and when a
# body counts as binary.
REQUEST_ENCODING = "US-ASCII"
DEFAULT_ENCODING = "ISO-8859-1"
CHARSET_PARAM = "charset="
BINARY_BYTES = r"[\x00-\x08\x0e-\x1f\x80-\x9f]"
BINARY_WINDOW = 512
BINARY_LIMIT = 5

# Byte order marks, longest first.
BYTE_ORDER_MARKS = {
    "0000FEFF": "UTF-32BE",
    "FFFE0000": "UTF-32LE",
    "EFBBBF": "UTF-8",
    "FEFF": "UTF-16BE",
    "FFFE": "UTF-16LE",
}

# Decode with any charset, replace what is malformed, no line breaks in base64.
_TEXT_SETTINGS = {
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
    "spark.sql.chunkBase64String.enabled": "false",
}


# Threads that build DataFrames in one session share its settings.
_TURN = threading.RLock()


@contextmanager
def body_text_settings(spark: SparkSession) -> Iterator[None]:
    """Settings under which :func:`decode_body` and :func:`base64_text` are built.

    They are read when a DataFrame is built, not when it runs, so the caller's
    values are put back right away. Threads take turns.
    """
    with _TURN:
        before = {name: spark.conf.get(name, None) for name in _TEXT_SETTINGS}
        try:
            for name, value in _TEXT_SETTINGS.items():
                spark.conf.set(name, value)
            yield
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)


def declared_charset(content_type: Column) -> Column:
    """Charset named by the first ``charset=`` parameter of a content type, upper-cased."""
    is_charset = lambda param, at: (at > 0) & param.contains(CHARSET_PARAM)
    named = F.get(F.filter(F.split(content_type, ";"), is_charset), F.lit(0))
    value = F.substring(named, F.instr(named, CHARSET_PARAM) + len(CHARSET_PARAM), F.length(named))
    return F.upper(trim_blanks(value))


def detected_charset(body: Column) -> Column:
    """Charset shown by the bytes themselves: a byte order mark, or real UTF-8."""
    start = F.hex(F.substring(body, 1, 4))
    choice = F.when(F.lit(False), F.lit(None).cast("string"))
    for mark, charset in BYTE_ORDER_MARKS.items():
        choice = choice.when(start.startswith(mark), F.lit(charset))
    text = raw_text(body)
    multibyte = F.is_valid_utf8(text) & (F.length(text) < F.octet_length(body))
    return choice.when(multibyte, F.lit("UTF-8"))


def looks_binary(body: Column) -> Column:
    """Whether the head of a body holds too many control bytes to be text."""
    head = F.decode(F.substring(body, 1, BINARY_WINDOW), DEFAULT_ENCODING)
    return F.regexp_count(head, F.lit(BINARY_BYTES)) > BINARY_LIMIT


@cache
def _jvm_charsets() -> tuple[str, ...]:
    """Upper-cased names and aliases of every charset the JVM has."""
    jvm = SparkSession.active()._jvm
    charsets = jvm.java.nio.charset.Charset.availableCharsets()
    names = set(charsets)
    for charset in charsets.values():
        names.update(charset.aliases().toString().strip("[]").split(", "))
    return tuple(sorted({n.upper() for n in names if n}))


def is_decodable(encoding: Column) -> Column:
    """Whether the JVM knows an encoding, in any letter case; false for null.

    The names are asked for once. Asking per row is slow for unknown names, as
    the JVM then searches all its providers again. They go into the plan as one
    string, which only uncommon encodings are looked up in.
    """
    common = encoding.isin("UTF-8", DEFAULT_ENCODING, REQUEST_ENCODING, "WINDOWS-1252")
    listed = F.find_in_set(F.upper(encoding), F.lit(",".join(_jvm_charsets()))) > 0
    return F.coalesce(F.when(common, True).otherwise(listed), F.lit(False))


def base64_text(body: Column) -> Column:
    """Base64 in one line. Use inside :func:`body_text_settings`."""
    return F.base64(body)


def decode_body(body: Column, encoding: Column) -> Column:
    """Body as text: decoded, or base64 when the encoding is unknown or null.

    Use inside :func:`body_text_settings`.
    """
    text = raw_text(body)
    return (
        F.when(F.octet_length(body) == 0, F.lit(""))
        .when((encoding == "UTF-8") & F.is_valid_utf8(text), text)
        .when(is_decodable(encoding), F.call_function("decode", body, encoding))
        .otherwise(base64_text(body))
    )
