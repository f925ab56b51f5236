"""Hand-made archive bytes, and a slow second reader of them."""

from __future__ import annotations

import re

BLANKS = "".join(map(chr, range(33)))
BLANK_BYTES = bytes(range(33))


def record(
    kind="response",
    rid="<urn:uuid:1>",
    uri="http://example.com/",
    content=b"",
    version="WARC/1.0",
    length=None,
    content_type="application/http; msgtype=response",
    extra=(),
):
    lines = [version]
    if kind is not None:
        lines.append(f"WARC-Type: {kind}")
    if rid is not None:
        lines.append(f"WARC-Record-ID: {rid}")
    if uri is not None:
        lines.append(f"WARC-Target-URI: {uri}")
    if content_type is not None:
        lines.append(f"Content-Type: {content_type}")
    lines += extra
    lines.append(f"Content-Length: {len(content) if length is None else length}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + content


def response(body=b"", headers=("HTTP/1.1 200 OK",), end="\r\n", **kw):
    head = end.join((*headers, "", "")).encode()
    return record(content=head + body, **kw)


GAP = b"\r\n\r\n"


def read_whole(data: bytes, version: bytes) -> list[tuple[bytes, bytes]]:
    """(joined header lines, content) of each record of a plain file.

    Works on the whole buffer, by positions; meant to be obvious, not fast.
    """
    found, at = [], 0

    def next_line():
        nonlocal at
        end = data.find(b"\n", at)
        if end < 0:
            return None
        line, at = data[at:end], end + 1
        return line

    while True:
        line = next_line()
        while line is not None and not line.startswith(version):
            line = next_line()
        if line is None:
            return found
        header, length = [], None
        while True:
            line = next_line()
            if line is None:
                break
            if line.strip(BLANK_BYTES) == b"":
                if length is None:
                    continue
                break
            header.append(line)
            match = re.match(rb"[\x00-\x20]*content-length[\x00-\x20]*(:|\Z)", line, re.I)
            if match:
                value = line.partition(b":")[2].strip(BLANK_BYTES)
                good = match[1] and re.fullmatch(rb"[+-]?[0-9]+", value)
                length = int(value) if good and 0 <= int(value) < 2**31 else None
        if length is None or at + length > len(data):
            return found
        found.append((b"\n".join(header), data[at : at + length]))
        at += length
