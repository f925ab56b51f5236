"""JSON documents from parsed records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.functions import charset as C
from warcloom.functions import headers as H
from warcloom.functions.identity import doc_uuid

# The two payload encodings.
PLAIN = "plain"
BASE64 = "base64"


def choose_encoding(
    df: DataFrame, detector: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add ``encoding``: declared, shown by the bytes, or the default; null if binary.

    ``detector`` may replace the built-in look at the bytes, for instance by a
    pandas UDF; it maps a body column to a charset name or null.
    """
    body = F.col("body")
    declared = C.declared_charset(H.header(F.col("http_headers"), "Content-Type"))
    detected = (detector or C.detected_charset)(body)
    staged = df.withColumn("_declared", declared)
    encoding = (
        F.when(body.isNull(), F.lit(None).cast("string"))
        .when(F.col("record_type") == "request", F.lit(C.REQUEST_ENCODING))
        .when(F.col("_declared").isNotNull(), F.col("_declared"))
        .otherwise(
            F.coalesce(detected, F.when(~C.looks_binary(body), F.lit(C.DEFAULT_ENCODING)))
        )
    )
    return staged.withColumn("encoding", encoding).drop("_declared")


def build_docs(
    df: DataFrame, prefix: str, detector: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Documents of parsed records: ``uuid``, body as text, ``doc`` struct and ``json``.

    ``body_encoding`` follows the encoding alone, so a body of an unknown
    declared charset is base64 under the flag ``plain``; ``body_is_base64`` tells
    what the body really is.
    """
    chosen = choose_encoding(df, detector)
    encoding, body = F.col("encoding"), F.col("body")
    with C.body_text_settings(df.sparkSession):
        decoded = chosen.withColumns(
            {
                "uuid": doc_uuid(prefix, F.col("record_id")),
                "body_text": C.decode_body(body, encoding),
                "body_encoding": F.when(encoding.isNull(), BASE64).otherwise(PLAIN),
                "body_is_base64": (F.octet_length(body) > 0) & ~C.is_decodable(encoding),
            }
        )
    return with_json(decoded)


def with_json(df: DataFrame) -> DataFrame:
    """Add the document as a struct and as JSON text."""
    payload = F.struct(
        F.col("http_headers").alias("headers"),
        F.col("body_text").alias("body"),
        F.col("body_encoding").alias("encoding"),
    )
    doc = F.struct(F.col("warc_headers").alias("metadata"), payload.alias("payload"))
    return df.withColumn("doc", doc).withColumn("json", F.to_json(F.col("doc")))
