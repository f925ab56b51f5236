"""Cutting a byte stream into archive records.

This is the one place where records are handled byte by byte in Python; it only
finds where records start and end. Everything inside a record is parsed by
column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import BinaryIO, NamedTuple

from warcloom.sources.files import READ_BYTES, Truncated

# The header that gives a record's length, the one that gives its
# type, and the largest length there can be.
LENGTH_FIELD = b"content-length"
TYPE_FIELD = b"warc-type"
MAX_LENGTH = 2**31 - 1

_BLANKS = bytes(range(0x21))
_INTEGER = re.compile(r"[+-]?\d+")


class Frame(NamedTuple):
    """One record: where its version line starts, its header lines and content.

    ``kind`` is its type; ``marks`` has the raw values of the fields that were asked
    for, None where a field isn't there exactly once.
    """

    start: int
    header_block: bytes
    content: bytes | None
    kind: str | None = None
    marks: tuple[bytes | None, ...] = ()


class ByteReader:
    """Lines and byte runs from a stream, never holding more than one of them."""

    def __init__(self, read: Callable[[int], bytes], offset: int = 0):
        self._read = read
        self._chunk = b""
        self._at = 0
        self._base = offset
        # Set by frames(): the first record start seen, and whether nothing
        # more can be read from the file.
        self.first_start: int | None = None
        self.ended = False

    def tell(self) -> int:
        return self._base + self._at

    def _fill(self) -> bool:
        self._base += len(self._chunk)
        self._chunk, self._at = b"", 0
        self._chunk = self._read(READ_BYTES)
        return bool(self._chunk)

    def line(self, keep: int | None = None) -> bytes | None:
        """The next line without its newline; None if no newline is left.

        ``keep`` bounds how much of a line is held when only its start matters.
        """
        pieces, held = [], 0
        while True:
            end = self._chunk.find(b"\n", self._at)
            stop = end if end >= 0 else len(self._chunk)
            if keep is None or held < keep:
                piece = self._chunk[self._at : stop if keep is None else min(stop, self._at + keep)]
                pieces.append(piece)
                held += len(piece)
            if end >= 0:
                self._at = end + 1
                return pieces[0] if len(pieces) == 1 else b"".join(pieces)
            self._at = stop
            try:
                if not self._fill():
                    return None
            except Truncated:
                return None

    def take(self, length: int, keep: bool) -> bytes | None:
        """Read ``length`` bytes, or pass over them (empty result) when not kept.

        None when the stream ends early. A truncated compressed stream gives
        what it had, if anything.
        """
        pieces, missing = [], length
        while missing:
            if self._at == len(self._chunk):
                try:
                    if not self._fill():
                        return None
                except Truncated:
                    if missing == length:
                        return None
                    break
            piece_end = min(len(self._chunk), self._at + missing)
            if keep:
                pieces.append(self._chunk[self._at : piece_end])
            missing -= piece_end - self._at
            self._at = piece_end
        return pieces[0] if len(pieces) == 1 else b"".join(pieces)


class SeekingReader(ByteReader):
    """A reader of plain files: the size is known and bodies can be jumped over."""

    def __init__(self, file: BinaryIO, offset: int, size: int):
        file.seek(offset)
        super().__init__(file.read, offset)
        self._file = file
        self._size = size

    def take(self, length: int, keep: bool) -> bytes | None:
        if self.tell() + length > self._size:
            return None
        if keep or self._at + length <= len(self._chunk):
            return super().take(length, keep)
        self._base, self._chunk, self._at = self.tell() + length, b"", 0
        self._file.seek(self._base)
        return b""


def _length(value: bytes) -> int:
    """A content length, or -1 when it is no 32-bit integer."""
    text = value.decode("utf-8", "replace").strip(_BLANKS.decode())
    if not _INTEGER.fullmatch(text):
        return -1
    length = int(text)
    return length if length <= MAX_LENGTH else -1


def frames(
    reader: ByteReader,
    version: bytes,
    keeps: Callable[[str | None], bool],
    stop: int | None = None,
    fields: tuple[bytes, ...] = (),
) -> Iterator[Frame]:
    """Records of a stream whose version line starts before ``stop``.

    ``fields`` are names, in lower case, of header fields whose values are wanted.

    A record starts at a line beginning with ``version``. Its header ends at the
    first blank line after a valid content length; without one, lines go on
    being read as header, into the next record if need be. ``keeps`` tells by
    record type whether content is wanted.
    """
    while True:
        start = reader.tell()
        if stop is not None and start >= stop:
            return
        line = reader.line(keep=len(version))
        if line is None:
            break
        if not line.startswith(version):
            continue
        if reader.first_start is None:
            reader.first_start = start

        lines, length, kind = [], -1, None
        values: dict[bytes, bytes | None] = {}
        while (line := reader.line()) is not None:
            if not line.strip(_BLANKS):
                if length >= 0:
                    break
                continue
            lines.append(line)
            name, colon, value = line.partition(b":")
            name = name.strip(_BLANKS).lower()
            if name == LENGTH_FIELD:
                length = _length(value) if colon else -1
            elif name == TYPE_FIELD:
                kind = value.strip(_BLANKS).decode("utf-8", "replace")
            if name in fields:
                values[name] = None if name in values else value.strip(_BLANKS)
        if length < 0:
            break

        keep = keeps(kind)
        taken = reader.take(length, keep)
        if taken is None:
            break
        block = b"\n".join(lines)
        yield Frame(start, block, taken if keep else None, kind, tuple(values.get(f) for f in fields))
    reader.ended = True
