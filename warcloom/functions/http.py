"""Where an HTTP message splits into header and body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from warcloom.functions.expr import raw_text, trim_blanks

# The content type of a split record, and the two header ends.
RESPONSE_TYPE = ("application/http", "msgtype=response")
CRLF_BREAK = "\r\n\r\n"
LF_BREAK = "\n\n"
# Messages shorter than this are never searched; a bare LF break is not seen
# before this offset.
SHORTEST_MESSAGE = 4
LF_BREAK_FROM = 2


def is_http_response(content_type: Column) -> Column:
    """Whether a WARC ``Content-Type`` announces an HTTP response message."""
    parts = F.split(content_type, ";")
    match = (trim_blanks(F.get(parts, F.lit(0))) == RESPONSE_TYPE[0]) & (
        trim_blanks(F.get(parts, F.lit(1))) == RESPONSE_TYPE[1]
    )
    return F.coalesce(match, F.lit(False))


def text_before_break(content: Column) -> Column:
    """The bytes before the first CRLF break, or all bytes when there is none."""
    return F.substring_index(raw_text(content), CRLF_BREAK, 1)


def lf_break_at(head: Column) -> Column:
    """Offset of the first visible bare LF break in ``head``, null when there is none.

    ``head`` ends at the CRLF break, so only the header is searched, not the body.
    """
    seen = raw_text(F.substring(head.cast("binary"), F.lit(LF_BREAK_FROM + 1), F.octet_length(head)))
    before = F.octet_length(F.substring_index(seen, LF_BREAK, 1))
    return F.when(before < F.octet_length(seen), before + LF_BREAK_FROM)
