"""Opening archive files inside tasks, wherever Spark listed them."""

from __future__ import annotations

import bz2
import zlib
from collections.abc import Callable
from typing import BinaryIO
from urllib.parse import urlsplit

READ_BYTES = 1 << 20
# Compressed input is taken in smaller steps, as each may grow a thousandfold.
COMPRESSED_BYTES = 1 << 16

# URI schemes Hadoop and Arrow spell differently.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


class Truncated(EOFError):
    """A compressed file ended inside its data."""


def open_file(path: str) -> BinaryIO:
    """Open a file of any filesystem for raw, seekable reading."""
    uri = urlsplit(path, allow_fragments=False)
    if uri.scheme in ("", "file"):
        return open(path.removeprefix("file:").removeprefix("//"), "rb")
    from pyarrow.fs import FileSystem

    scheme = _ARROW_SCHEMES.get(uri.scheme, uri.scheme)
    filesystem, root = FileSystem.from_uri(f"{scheme}://{uri.netloc}/")
    inside = path.split("://", 1)[1][len(uri.netloc):]
    return filesystem.open_input_file(root.rstrip("/") + inside)


def _inflater(new_stream: Callable[[], object]):
    """A reader of back-to-back compressed streams, as gzip members or bzip2 streams."""

    def reader(file: BinaryIO) -> Callable[[int], bytes]:
        stream, data = new_stream(), b""
        fresh, ended = True, False

        def read(_: int = READ_BYTES) -> bytes:
            nonlocal stream, data, fresh, ended
            while not ended:
                if not data:
                    data = file.read(COMPRESSED_BYTES)
                    if not data:
                        ended = True
                        if not fresh:
                            raise Truncated
                        return b""
                out = stream.decompress(data)
                fresh = False
                data = b""
                if stream.eof:
                    data = stream.unused_data
                    stream, fresh = new_stream(), True
                if out:
                    return out
            return b""

        return read

    return reader


def _zstd_stream():
    try:
        import zstandard
    except ImportError as error:
        raise ImportError("reading .zst archives needs the package zstandard") from error
    return zstandard.ZstdDecompressor().decompressobj()


# Codec by file extension; anything else is read as it is.
_CODECS = {
    ".gz": _inflater(lambda: zlib.decompressobj(31)),
    ".bz2": _inflater(bz2.BZ2Decompressor),
    ".deflate": _inflater(zlib.decompressobj),
    ".zst": _inflater(_zstd_stream),
}
_UNREADABLE = (".lz4", ".snappy")


def codec_of(path: str) -> Callable[[BinaryIO], Callable[[int], bytes]] | None:
    """The decompressing reader for a path, or None for plain files."""
    name = path.rsplit("/", 1)[-1]
    extension = name[name.rfind("."):] if "." in name else ""
    if extension in _UNREADABLE:
        raise ValueError(f"no reader for {extension} archives: {path}")
    return _CODECS.get(extension)
