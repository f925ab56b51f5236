"""SQL counterparts of the registered queries."""

from __future__ import annotations

from warcloom.operators.counters import MERGE_COUNTERS, RECORD_COUNTERS
from warcloom.profiles import PROFILES
from workload.captures import (
    CAPTURES_SQL,
    DOCS_SQL,
    RECORD_ID_SQL,
    UUID_SQL,
    hash_sql,
    part_sql,
)

ID = "source_file, record_seq"
CRLF = "chr(13) || chr(10)"


def _captures(select: str) -> str:
    return f"WITH {CAPTURES_SQL}\n{select}"


def _named(select: str) -> str:
    return f"WITH {CAPTURES_SQL},\nnamed AS (SELECT *, {RECORD_ID_SQL} AS record_id FROM texts)\n{select}"


def _docs(select: str, *more: str) -> str:
    return "WITH " + ",\n".join((DOCS_SQL, *more)) + f"\n{select}"


_SCAN = _captures(
    "SELECT trec_id, record_type, target_uri, octet_length(content)::BIGINT AS content_bytes, "
    "md5(content) AS content_md5 FROM heads"
)

# Entries of each record's header map, in the spelling of its first line.
_WARC_ENTRIES = f"""entries AS (
  SELECT {ID}, unnest([
    {{'name': 'Content-Length', 'content': octet_length(content)::VARCHAR}},
    {{'name': 'Content-Type', 'content': content_type}},
    {{'name': 'WARC-Record-ID', 'content': given_id}},
    {{'name': 'WARC-Target-URI', 'content': target_uri}},
    {{'name': 'WARC-TREC-ID', 'content': trec_id}},
    {{'name': 'WARC-Type', 'content': record_type}},
    {{'name': 'X-Note', 'content': 'second:' || cap}}]) AS e
  FROM texts
)"""
_HTTP_ENTRIES = f"""entries AS (
  SELECT {ID}, unnest([
    {{'name': CASE WHEN status LIKE 'HTTP/1.%' AND NOT contains(status, ':') THEN '__HTTP_STATUS__'
              ELSE split_part(status, ':', 1) END,
      'content': CASE WHEN contains(status, ':') THEN trim(split_part(status, ':', 2))
                      WHEN status LIKE 'HTTP/1.%' THEN status ELSE '' END}},
    {{'name': 'Content-Type', 'content': trim(mime)}},
    {{'name': 'Set-Cookie', 'content': 'b=' || cap}},
    {{'name': 'Bare', 'content': ''}},
    {{'name': 'Padded', 'content': 'x:y'}}]) AS e
  FROM texts WHERE is_http AND NOT no_break
)"""

_SEGMENT_ROWS = f"""segment_rows AS (
  SELECT 'data' AS "table", uuid AS key, md5(body_text) AS content, segment, {ID} FROM docs
  UNION ALL
  SELECT 'uri', target_uri, uuid, segment, {ID} FROM docs
  WHERE record_type = 'response' AND target_uri IS NOT NULL
),
segment_first AS (
  SELECT *, substr(segment, 9)::BIGINT AS ordinal FROM segment_rows
  QUALIFY row_number() OVER (PARTITION BY segment, "table", key ORDER BY {ID}) = 1
)"""

_WRITTEN = """written AS (
  SELECT 'data' AS "table", key, md5(body_text) AS content FROM data_rows
  UNION ALL
  SELECT 'uri', key, value FROM uri_rows
)"""

_ADDRESSES = "addresses AS (SELECT DISTINCT url AS key FROM base)"

_ALL_NAMED = f"all_named AS (SELECT {UUID_SQL} AS uuid FROM named)"

_RECORD_COUNTS = """
  SELECT count(*) AS "RECORDS",
    count(*) FILTER (record_type IS NULL OR record_type NOT IN ('request', 'response')) AS "SKIPPED_RECORDS",
    0 AS "SKIPPED_RECORDS_TOO_LARGE", 0 AS "SKIPPED_RECORDS_TOO_SMALL",
    count(*) FILTER (record_type IN ('request', 'response') AND encoding IS NULL) AS "BINARY_RECORDS",
    count(*) FILTER (record_type IN ('request', 'response')) AS "GENERATED_DOCS",
    count(DISTINCT {uuid}) FILTER (record_type IN ('request', 'response')) AS "MAPFILE_DATA_ENTRIES",
    count(DISTINCT target_uri) FILTER (record_type = 'response') AS "MAPFILE_URI_ENTRIES"
"""


def _counter_rows(names, source: str, *keys: str) -> str:
    listed = ", ".join(f'"{n}"' for n in names)
    chosen = "".join(f"{k}, " for k in keys)
    return (
        f"SELECT {chosen}counter, value::BIGINT AS value FROM "
        f"(UNPIVOT ({source}) ON {listed} INTO NAME counter VALUE value)"
    )


def _bigints(names, source: str, *keys: str) -> str:
    listed = ", ".join(f'"{n}"::BIGINT AS "{n}"' for n in names)
    return f"SELECT {''.join(f'{k}, ' for k in keys)}{listed} FROM ({source})"


_COUNTERS = _named(
    _counter_rows(
        RECORD_COUNTERS,
        _bigints(RECORD_COUNTERS, _RECORD_COUNTS.format(uuid="record_id") + "FROM named"),
    )
)

# In archives on disk a record without an id gets one of its place in a file, so
# the ids of such records are all different.
_BUILT_ID = "coalesce(given_id, trec_id)"

_MERGE_COUNTS = """
  SELECT sum(inputs) AS "MAPFILES_TO_BE_MERGED", count(*) AS "MAPFILE_MERGES_FINISHED",
    0 AS "EMPTY_INPUT_MAPFILES", sum(inputs) AS "MAPFILE_INPUTS_EXHAUSTED",
    sum(rows) AS "MAPFILE_ENTRIES_WRITTEN"
  FROM (SELECT "table", part, count(DISTINCT ordinal) AS inputs, count(*) AS rows
        FROM placed GROUP BY ALL)
"""
_PLACED = f"placed AS (SELECT *, {part_sql('key')}::BIGINT AS part FROM segment_first)"

ORACLE: dict[str, str] = {
    "archive_listing": _captures(
        f"""SELECT segment, sum(octet_length(content) + strlen('WARC/1.0' || {CRLF}
            || coalesce('WARC-Type: ' || record_type || {CRLF}, '')
            || coalesce('WARC-Record-ID: ' || given_id || {CRLF}, '')
            || 'WARC-TREC-ID: ' || trec_id || {CRLF}
            || coalesce('WARC-Target-URI: ' || target_uri || {CRLF}, '')
            || 'Content-Type: ' || content_type || {CRLF}
            || 'X-Note: first:' || cap || {CRLF} || 'x-note:' || chr(9) || 'second:' || cap || ' ' || {CRLF}
            || 'Content-Length: ' || octet_length(content) || {CRLF}) + 6)::BIGINT AS total_bytes
            FROM heads GROUP BY segment"""
    ),
    "warc_scan": _SCAN,
    "warc_scan_bzip2": _SCAN,
    "warc_scan_split": _SCAN,
    "warc_scan_types": _captures(
        "SELECT trec_id, record_type, target_uri, "
        "CASE WHEN record_type IN ('request', 'response') THEN octet_length(content) END::BIGINT AS content_bytes, "
        "CASE WHEN record_type IN ('request', 'response') THEN md5(content) END AS content_md5 FROM heads"
    ),
    "corpus_profiles": _captures(
        " UNION ALL ".join(
            f"SELECT '{p.name}' AS profile, '{p.version}' AS warc_version, {field} AS record_id "
            f"FROM made WHERE {field} IS NOT NULL"
            for p in PROFILES.values()
            for field in ["given_id" if p.id_field == "WARC-Record-ID" else "trec_id"]
        )
    ),
    "split_listing": _docs(
        f"""SELECT DISTINCT printf('%s-r-%05d', "table", {part_sql('key')}) AS name,
            {part_sql('key')}::BIGINT AS part FROM written""",
        _WRITTEN,
    ),
    "mapfile_roundtrip": _docs("SELECT key, value FROM uri_rows"),
    "mapfile_data_roundtrip": _docs("SELECT key, md5(body_text) AS body_md5 FROM data_rows"),
    "warc_header_map": _captures("SELECT 1").replace(
        "\nSELECT 1", f",\n{_WARC_ENTRIES}\nSELECT {ID}, e.name AS name, e.content AS content FROM entries WHERE e.content IS NOT NULL"
    ),
    "header_lookup": _captures(
        f"SELECT {ID}, 'second:' || cap AS note, trec_id, NULL::VARCHAR AS absent FROM heads"
    ),
    "http_split": _captures(
        f"SELECT {ID}, octet_length(encode(http_header))::BIGINT AS header_bytes, "
        "octet_length(body)::BIGINT AS body_bytes, md5(body) AS body_md5, http_split_ok FROM heads"
    ),
    "http_header_map": _captures("SELECT 1").replace(
        "\nSELECT 1", f",\n{_HTTP_ENTRIES}\nSELECT {ID}, e.name AS name, e.content AS content FROM entries"
    ),
    "record_identity": _named(f"SELECT {ID}, record_id, record_type, target_uri FROM named"),
    "stored_length": _captures(
        f"SELECT {ID}, (coalesce(octet_length(encode(http_header)), 0) + octet_length(body) + 2)::BIGINT "
        "AS content_length, octet_length(content)::VARCHAR AS stated FROM heads"
    ),
    "record_text": _docs(
        f"""SELECT {ID}, md5('WARC/1.0' || {CRLF} || 'Content-Length: ' || octet_length(content) || {CRLF}
            || 'Content-Type: ' || content_type || {CRLF}
            || coalesce('WARC-Record-ID: ' || given_id || {CRLF}, '')
            || coalesce('WARC-Target-URI: ' || target_uri || {CRLF}, '')
            || 'WARC-TREC-ID: ' || trec_id || {CRLF}
            || 'WARC-Type: ' || record_type || {CRLF}
            || 'X-Note: second:' || cap || {CRLF}
            || coalesce(http_header, '') || {CRLF} || body_text) AS text_md5 FROM docs"""
    ),
    "http_records": _captures(
        f"SELECT {ID}, record_type FROM made WHERE record_type IN ('request', 'response')"
    ),
    "uri_records": _captures(
        f"SELECT {ID}, target_uri FROM made WHERE record_type = 'response' AND target_uri IS NOT NULL"
    ),
    "segment_range": _captures(
        """SELECT segment, ordinal, printf('segment-%05d', ordinal) AS folder FROM (
             SELECT segment, row_number() OVER (ORDER BY segment) - 1 AS ordinal
             FROM (SELECT segment FROM made UNION SELECT source FROM documents))
           WHERE segment BETWEEN 'segment-00001' AND 'src15'"""
    ),
    "encoding_choice": _captures(f"SELECT {ID}, encoding FROM encoded"),
    "binary_detect": _captures(f"SELECT {ID}, controls > 5 AS is_binary FROM detected"),
    "body_decode": _docs(
        f"SELECT {ID}, length(body_text)::BIGINT AS chars, md5(body_text) AS text_md5 FROM docs"
    ),
    "body_base64": _captures(
        f"SELECT {ID}, length(base64(body))::BIGINT AS chars, md5(base64(body)) AS text_md5 FROM heads"
    ),
    "payload_flags": _docs(f"SELECT {ID}, body_encoding, body_is_base64 FROM docs"),
    "json_document": _docs(
        f"""SELECT {ID}, record_type, 'second:' || cap AS note,
            CASE WHEN is_http AND NOT no_break AND status = 'HTTP/1.1 200 OK' THEN status END AS status,
            CASE WHEN is_http AND NOT no_break THEN 'b=' || cap END AS cookie,
            body_encoding, md5(body_text) AS body_md5 FROM docs"""
    ),
    "doc_uuid": _docs(f"SELECT {ID}, record_id, uuid FROM docs"),
    "java_hash_partition": _captures(
        f"""SELECT cap, hash, part, printf('uri-r-%05d', part) AS split, part AS split_part FROM (
              SELECT cap, {hash_sql('url')}::BIGINT AS hash, {part_sql('url')}::BIGINT AS part FROM base)"""
    ),
    "data_dedupe_first": _docs(f"SELECT key, {ID}, md5(body_text) AS body_md5 FROM data_rows"),
    "uri_index": _docs(f"SELECT key, value, {ID} FROM uri_rows"),
    "counters": _COUNTERS,
    "split_counter": _docs(
        """SELECT 'RECORDS' AS counter, count(*) AS value
           FROM (SELECT DISTINCT "table", part, ordinal FROM placed)""",
        _SEGMENT_ROWS,
        _PLACED,
    ),
    "partition_sizes": _docs(
        f"""SELECT "table", {part_sql('key')}::BIGINT AS part, count(*) AS rows,
            min(key) AS first_key, max(key) AS last_key FROM written GROUP BY ALL""",
        _WRITTEN,
    ),
    "table_rows": _docs('SELECT "table", key, content FROM written', _WRITTEN),
    "merge_segments": _docs(
        'SELECT "table", key, part, ordinal, content FROM placed', _SEGMENT_ROWS, _PLACED
    ),
    "merge_first_wins": _docs(
        """SELECT "table", key, part, ordinal, content FROM placed
           QUALIFY row_number() OVER (PARTITION BY "table", key ORDER BY ordinal) = 1""",
        _SEGMENT_ROWS,
        _PLACED,
    ),
    "merge_counters": _docs(
        _counter_rows(MERGE_COUNTERS, _bigints(MERGE_COUNTERS, _MERGE_COUNTS)),
        _SEGMENT_ROWS,
        _PLACED,
    ),
    "lookup_uuid": _docs(
        f"""SELECT k.key, {part_sql('k.key')}::BIGINT AS part, md5(body_text) AS body_md5,
            d.key IS NOT NULL AS found
            FROM (SELECT DISTINCT uuid AS key FROM all_named) k LEFT JOIN data_rows d ON k.key = d.key""",
        _ALL_NAMED,
    ),
    "lookup_name": _docs(
        """SELECT k.key, md5(body_text) AS body_md5, d.key IS NOT NULL AS found
            FROM (SELECT DISTINCT uuid AS key FROM all_named) k LEFT JOIN data_rows d ON k.key = d.key""",
        _ALL_NAMED,
    ),
    "lookup_uri": _docs(
        f"""SELECT a.key, {part_sql('a.key')}::BIGINT AS part, u.value, u.key IS NOT NULL AS found
            FROM addresses a LEFT JOIN uri_rows u ON a.key = u.key""",
        _ADDRESSES,
    ),
    "uri_to_document": _docs(
        """SELECT a.key AS uri, u.value AS uuid, md5(body_text) AS body_md5, d.key IS NOT NULL AS found
           FROM addresses a LEFT JOIN uri_rows u ON a.key = u.key LEFT JOIN data_rows d ON u.value = d.key""",
        _ADDRESSES,
    ),
    "lookup_missing": _docs(
        f"""SELECT key, {part_sql('key')}::BIGINT AS part FROM addresses
            WHERE key NOT IN (SELECT key FROM uri_rows)""",
        _ADDRESSES,
    ),
    "lookup_render": _docs(
        f"""SELECT key, printf('%05d', {part_sql('key')}) AS part,
            printf('out/uri-r-%05d', {part_sql('key')}) AS split_path, value FROM uri_rows"""
    ),
    "archive_roundtrip": _docs(
        """SELECT trec_id, CASE WHEN given_id IS NOT NULL THEN uuid END AS uuid,
           encoding, md5(body_text) AS text_md5 FROM docs"""
    ),
    "archive_file_counts": _captures("SELECT count(*) AS records FROM made"),
    "build_tables": _captures(
        _counter_rows(
            RECORD_COUNTERS,
            _bigints(RECORD_COUNTERS, _RECORD_COUNTS.format(uuid=_BUILT_ID) + "FROM texts"),
        )
    ),
    "build_corpus": _docs(
        """SELECT segment, part, key FROM placed WHERE "table" = 'uri'""", _SEGMENT_ROWS, _PLACED
    ),
    "corpus_counters": _captures(
        _counter_rows(
            RECORD_COUNTERS,
            _bigints(
                RECORD_COUNTERS,
                _RECORD_COUNTS.format(uuid=_BUILT_ID).replace("SELECT", "SELECT segment,", 1)
                + "FROM texts WHERE segment BETWEEN 'segment-00001' AND 'segment-00002' GROUP BY segment",
                "segment",
            ),
            "segment",
        )
    ),
}

# Of two versions with one id the first in an archive stays; those without an id are two documents.
_ONE_VERSION = "(given_id IS NULL OR dup = 0)"
_BUILT_KEY = "cap::BIGINT AS cap, CASE WHEN given_id IS NOT NULL THEN uuid END AS key"
_EITHER_BODY = "CASE WHEN cap % 7 <> 0 THEN md5(body_text) END AS body_md5"

ORACLE |= {
    "lookup_in_slices": ORACLE["lookup_uuid"],
    "built_rows": _docs(f"SELECT {_BUILT_KEY}, md5(body_text) AS body_md5 FROM docs WHERE {_ONE_VERSION}"),
    "corpus_rows": _docs(f"SELECT segment, {_BUILT_KEY}, {_EITHER_BODY} FROM docs WHERE {_ONE_VERSION}"),
    "added_rows": _docs(
        f"""SELECT cap, key, CASE WHEN key IS NOT NULL THEN {part_sql('key')}::BIGINT END AS part, body_md5 FROM (
              SELECT {_BUILT_KEY}, {_EITHER_BODY} FROM docs WHERE {_ONE_VERSION}
              UNION ALL SELECT NULL, key, NULL FROM uri_rows)"""
    ),
    "added_counters": ORACLE["build_tables"],
    "merge_in_order": _docs(
        """SELECT "table", part, count(*) AS rows, 0::BIGINT AS out_of_order, count(*) > 40 AS cut
           FROM placed GROUP BY "table", part""",
        _SEGMENT_ROWS,
        _PLACED,
    ),
}
ORACLE["corpus_in_two_runs"] = ORACLE["build_corpus"]
