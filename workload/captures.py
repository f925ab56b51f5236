"""Captures: archive records derived from the ``pages`` and ``documents`` tables.

Every page and document becomes one or two records. Which kind of record it is,
how its charset is declared, how its header lines end and so on follow from its
number, so that all rules of the package are met in every table size. The same
derivation is written twice, for Spark and as SQL: Spark makes raw bytes of it,
SQL states what should be read back from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = "cc"
PARTS = 8
SEGMENTS = 4
DOCUMENT_BASE = 1_000_000_000
HOT_URI = "http://hot.example.com/"
SMALL_BYTES = 1 << 30


def _case(value: Column, *branches: tuple[Column, str | None]) -> Column:
    choice = F.when(F.lit(False), F.lit(None).cast("string"))
    for condition, result in branches:
        choice = choice.when(condition, F.lit(result))
    return choice.otherwise(value)


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts with a number and an address: (cap, url, html)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    address = F.concat_ws("/", F.lit("http:/"), F.concat("source", F.lit(".example.org")), "lang", "doc_id")
    texts = pages.select(F.col("page_id").alias("cap"), "url", "html").unionByName(
        documents.select(
            (F.col("doc_id") + DOCUMENT_BASE).alias("cap"),
            address.alias("url"),
            F.col("text").alias("html"),
        )
    )
    return spread_small(texts)


def spread_small(df: DataFrame) -> DataFrame:
    """Deal out a small table to all cores.

    A small file is a single row group, which one task would read and then do
    all further work on. Large tables have row groups enough and stay put.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > SMALL_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed records, as read from archives, plus ``cap`` and ``segment``."""
    cap = F.col("cap")
    every = lambda n, r: cap % n == r
    copies = F.when(every(7, 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    c = base(spark, sf_dir).select("cap", "url", "html", F.explode(copies).alias("dup"))

    kind = _case(
        F.lit("response"),
        (every(41, 40), None),
        (every(37, 36), "Response"),
        (every(10, 0), "warcinfo"),
        (every(10, 1), "request"),
        (every(10, 2), "metadata"),
    )
    record_id = F.when(~every(31, 30), F.format_string("<urn:uuid:cap-%d>", cap))
    uri = F.when(every(25, 24), F.lit(None)).when(every(3, 2), F.lit(HOT_URI)).otherwise(F.col("url"))
    c = c.select(
        "cap",
        "dup",
        kind.alias("kind"),
        record_id.alias("id"),
        uri.alias("uri"),
        F.when(F.col("dup") == 1, F.concat("html", F.lit("<!-- 2 -->"))).otherwise(F.col("html")).alias("html"),
    )

    ones = F.when(every(11, 3), 6).when(every(11, 4), 5)
    ascii_only = F.regexp_replace("html", r"[^\x00-\x7F]", "")
    junk = F.concat(
        F.lit(b"\xff"), F.repeat(F.lit("\x01"), ones).cast("binary"), ascii_only.cast("binary")
    )
    body = F.when(ones.isNotNull(), junk).otherwise(F.col("html").cast("binary"))

    status = _case(F.lit("HTTP/1.1 200 OK"), (every(13, 5), "HTTP/2 200"), (every(13, 6), "HTTP/1.1 200 OK: x"))
    mime = _case(
        F.lit("text/html"),
        (every(4, 0), "text/html; charset=utf-8"),
        (every(4, 2), "text/html; a=b; charset= UTF-8 "),
        (every(4, 3), "text/html; charset=no-such-charset"),
    )
    line_end = F.when(every(6, 5), F.lit("\n")).otherwise(F.lit("\r\n"))
    http = F.concat_ws(
        line_end_marker := "\x00",
        status,
        F.concat(F.lit("Content-Type: "), mime),
        F.format_string("Set-Cookie: a=%d", cap),
        F.format_string("set-cookie: b=%d", cap),
        F.lit(": no key"),
        F.lit("Bare"),
        F.lit("\tPadded : x:y "),
    )
    http = F.replace(http, F.lit(line_end_marker), line_end)
    lost = every(17, 16)
    asked = F.format_string("GET /%d HTTP/1.1\r\nHost: example.com\r\n\r\n", cap)
    is_response = F.lower("kind") == "response"
    content = (
        F.when(is_response & lost, http.cast("binary"))
        .when(is_response, F.concat(http.cast("binary"), line_end.cast("binary"), line_end.cast("binary"), body))
        .when(F.col("kind") == "request", F.concat(asked.cast("binary"), body))
        .otherwise(body)
    )
    content_type = _case(
        F.lit("application/warc-fields"),
        (is_response, "application/http; msgtype=response"),
        (F.col("kind") == "request", "application/http; msgtype=request"),
    )
    c = c.select("*", content.alias("content"), content_type.alias("content_type"))

    named = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    block = F.concat_ws(
        "\r\n",
        named("WARC-Type", F.col("kind")),
        named("WARC-Record-ID", F.col("id")),
        F.format_string("WARC-TREC-ID: trec-%d-%d", cap, F.col("dup")),
        named("WARC-Target-URI", F.col("uri")),
        named("Content-Type", F.col("content_type")),
        F.format_string("X-Note: first:%d", cap),
        F.format_string("x-note:\tsecond:%d ", cap),
        named("Content-Length", F.octet_length("content").cast("string")),
    )
    segment = F.format_string("segment-%05d", cap % SEGMENTS)
    return c.select(
        "cap",
        segment.alias("segment"),
        F.concat(segment, F.lit(".warc")).alias("source_file"),
        (cap * 2 + F.col("dup")).alias("record_seq"),
        F.lit("WARC/1.0").alias("warc_version"),
        block.cast("binary").alias("header_block"),
        "content",
    )


def archive_bytes(records: DataFrame, version: str = "WARC/1.0") -> Column:
    """A framed record's bytes in an archive, without the separator after it."""
    return F.concat(
        F.lit(f"{version}\r\n").cast("binary"),
        F.col("header_block"),
        F.lit(b"\r\n\r\n"),
        F.col("content"),
    )


def write_archives(
    records: DataFrame, path: str, *folders: str, version: str = "WARC/1.0", compression: str = "gzip"
) -> str:
    """Write framed records as archive files, in one folder per value of ``folders``."""
    text = records.select(*folders, archive_bytes(records, version).cast("string").alias("value"))
    writer = text.write.option("lineSep", "\r\n\r\n").option("compression", compression)
    (writer.partitionBy(*folders) if folders else writer).text(path)
    return path


# What should be read back, as SQL. Byte positions are never searched here: the
# parts of each record are known from how it was made.
CAPTURES_SQL = rf"""
base AS (
  SELECT page_id AS cap, url, html FROM pages
  UNION ALL
  SELECT doc_id + {DOCUMENT_BASE},
         'http://' || source || '.example.org/' || lang || '/' || doc_id, text
  FROM documents
),
copies AS (
  SELECT cap, url, html, 0 AS dup FROM base
  UNION ALL
  SELECT cap, url, html || '<!-- 2 -->', 1 FROM base WHERE cap % 7 = 0
),
made AS (
  SELECT cap, dup, html,
    CASE WHEN cap % 41 = 40 THEN NULL WHEN cap % 37 = 36 THEN 'Response'
         WHEN cap % 10 = 0 THEN 'warcinfo' WHEN cap % 10 = 1 THEN 'request'
         WHEN cap % 10 = 2 THEN 'metadata' ELSE 'response' END AS record_type,
    CASE WHEN cap % 31 <> 30 THEN '<urn:uuid:cap-' || cap || '>' END AS given_id,
    'trec-' || cap || '-' || dup AS trec_id,
    CASE WHEN cap % 25 = 24 THEN NULL WHEN cap % 3 = 2 THEN '{HOT_URI}' ELSE url END AS target_uri,
    printf('segment-%05d', cap % {SEGMENTS}) AS segment,
    printf('segment-%05d', cap % {SEGMENTS}) || '.warc' AS source_file,
    cap * 2 + dup AS record_seq,
    CASE WHEN cap % 11 = 3 THEN 6 WHEN cap % 11 = 4 THEN 5 END AS ones,
    CASE WHEN cap % 13 = 5 THEN 'HTTP/2 200' WHEN cap % 13 = 6 THEN 'HTTP/1.1 200 OK: x'
         ELSE 'HTTP/1.1 200 OK' END AS status,
    CASE WHEN cap % 6 = 5 THEN chr(10) ELSE chr(13) || chr(10) END AS line_end,
    CASE cap % 4 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 2 THEN 'text/html; a=b; charset= UTF-8 '
                 WHEN 3 THEN 'text/html; charset=no-such-charset' ELSE 'text/html' END AS mime,
    cap % 17 = 16 AS no_break
  FROM copies
),
bytes AS (
  SELECT *, coalesce(lower(record_type), '') = 'response' AS is_http,
    regexp_replace(html, '[^\x00-\x7F]', '', 'g') AS ascii_html,
    CASE WHEN ones IS NULL THEN encode(html)
         ELSE unhex('FF') || encode(repeat(chr(1), ones)) || encode(regexp_replace(html, '[^\x00-\x7F]', '', 'g'))
    END AS made_body,
    status || line_end || 'Content-Type: ' || mime || line_end || 'Set-Cookie: a=' || cap || line_end
      || 'set-cookie: b=' || cap || line_end || ': no key' || line_end || 'Bare' || line_end
      || chr(9) || 'Padded : x:y ' AS http_text,
    'GET /' || cap || ' HTTP/1.1' || chr(13) || chr(10) || 'Host: example.com'
      || chr(13) || chr(10) || chr(13) || chr(10) AS asked
  FROM made
),
split AS (
  SELECT *,
    CASE WHEN is_http AND no_break THEN encode(http_text)
         WHEN is_http THEN encode(http_text || line_end || line_end) || made_body
         WHEN record_type = 'request' THEN encode(asked) || made_body
         ELSE made_body END AS content,
    CASE WHEN NOT is_http THEN NULL WHEN no_break THEN '' ELSE http_text || line_end END AS http_header,
    NOT (is_http AND no_break) AS http_split_ok,
    CASE WHEN is_http AND no_break THEN ''::blob
         WHEN record_type = 'request' THEN encode(asked) || made_body
         ELSE made_body END AS body
  FROM bytes
),
heads AS (
  SELECT *,
    CASE WHEN is_http THEN 'application/http; msgtype=response'
         WHEN record_type = 'request' THEN 'application/http; msgtype=request'
         ELSE 'application/warc-fields' END AS content_type
  FROM split
),
detected AS (
  SELECT *,
    len(list_filter(regexp_extract_all(hex(body)[:1024], '..'),
        lambda x: x BETWEEN '00' AND '08' OR x BETWEEN '0E' AND '1F' OR x BETWEEN '80' AND '9F')) AS controls,
    CASE WHEN is_http AND NOT no_break AND cap % 4 <> 1
         THEN upper(trim(regexp_extract(mime, 'charset=(.*)$', 1))) END AS declared,
    coalesce(try(decode(body)) IS NOT NULL AND length(try(decode(body))) < octet_length(body), false) AS is_utf8
  FROM heads
),
encoded AS (
  SELECT *,
    CASE WHEN record_type = 'request' THEN 'US-ASCII'
         WHEN declared IS NOT NULL THEN declared
         WHEN is_utf8 THEN 'UTF-8'
         WHEN controls > 5 THEN NULL
         ELSE 'ISO-8859-1' END AS encoding
  FROM detected
),
texts AS (
  SELECT *,
    CASE WHEN octet_length(body) = 0 THEN ''
         WHEN encoding IS NULL OR encoding = 'NO-SUCH-CHARSET' THEN base64(body)
         WHEN encoding = 'UTF-8' THEN coalesce(try(decode(body)), chr(65533) || repeat(chr(1), ones) || ascii_html)
         WHEN encoding = 'ISO-8859-1' THEN coalesce(try(decode(body)), chr(255) || repeat(chr(1), ones) || ascii_html)
         ELSE asked || CASE WHEN ones IS NOT NULL THEN chr(65533) || repeat(chr(1), ones) || ascii_html
              ELSE regexp_replace(regexp_replace(regexp_replace(html,
                '[\x{{10000}}-\x{{10FFFF}}]', repeat(chr(65533), 4), 'g'),
                '[\x{{800}}-\x{{FFFC}}\x{{FFFE}}-\x{{FFFF}}]', repeat(chr(65533), 3), 'g'),
                '[\x{{80}}-\x{{7FF}}]', repeat(chr(65533), 2), 'g') END
    END AS body_text,
    CASE WHEN encoding IS NULL THEN 'base64' ELSE 'plain' END AS body_encoding,
    octet_length(body) > 0 AND (encoding IS NULL OR encoding = 'NO-SUCH-CHARSET') AS body_is_base64
  FROM encoded
)"""


def uuid_sql(name: str) -> str:
    """SQL of the name-based UUID of a string expression."""
    h = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name}))"
    return (
        f"({h}[1:8] || '-' || {h}[9:12] || '-5' || {h}[14:16] || '-' || "
        f"translate({h}[17:17], '0123456789abcdef', '89ab89ab89ab89ab') || {h}[18:20] || '-' || {h}[21:32])"
    )


def hash_sql(key: str) -> str:
    """SQL of the 32-bit string hash, folded over UTF-16 units."""
    units = (
        f"flatten(list_transform(string_split({key}, ''), lambda c: CASE WHEN unicode(c) >= 65536 "
        f"THEN [55296 + (unicode(c) - 65536) // 1024, 56320 + (unicode(c) - 65536) % 1024]::BIGINT[] "
        f"ELSE [unicode(c)]::BIGINT[] END))"
    )
    folded = f"list_reduce(list_prepend(0::BIGINT, {units}), lambda a, b: (a * 31 + b) & 4294967295)"
    return (
        f"(CASE WHEN {key} = '' THEN 0 ELSE "
        f"(({folded} + 2147483648) % 4294967296) - 2147483648 END)"
    )


def part_sql(key: str, parts: int = PARTS) -> str:
    """SQL of the partition of a key."""
    return f"((({hash_sql(key)} % {parts}) + {parts}) % {parts})"


RECORD_ID_SQL = (
    "coalesce(given_id, '<urn:uuid:' || "
    + uuid_sql("(source_file || '#' || record_seq)")
    + " || '>')"
)
UUID_SQL = uuid_sql(f"('{PREFIX}:' || record_id)")

# Documents of the captures, and the rows of the two tables in both readings.
DOCS_SQL = f"""{CAPTURES_SQL},
named AS (SELECT *, {RECORD_ID_SQL} AS record_id FROM texts),
docs AS (
  SELECT *, {UUID_SQL} AS uuid FROM named WHERE record_type IN ('request', 'response')
),
data_rows AS (
  SELECT uuid AS key, body_text, segment, source_file, record_seq FROM docs
  QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY source_file, record_seq) = 1
),
uri_rows AS (
  SELECT target_uri AS key, uuid AS value, segment, source_file, record_seq FROM docs
  WHERE record_type = 'response' AND target_uri IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY target_uri ORDER BY source_file, record_seq) = 1
)"""
