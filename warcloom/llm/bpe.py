"""Byte-level BPE: encode texts to token ids, decode ids to texts.

The merges of a word run over a doubly linked list of symbols. A priority queue holds
the adjacent pairs that have a merge, by rank and then by place; an entry whose pair is
no longer there when it comes up is stale and skipped. Decoding concatenates the byte
strings of the vocabulary.

Texts are cut at white space in a way that the tokenizer's own pattern would also cut,
and the ids of frequent pieces are kept in a table of bounded size, so that the queue
runs about once for each distinct word of a task and not for each word.

Null texts have no tokens. Any text can be encoded; decoding the ids gives it back.
The work is row by row: no shuffle, and memory is bounded by a chunk of texts.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from warcloom.llm.common import add_columns, once_per_worker

#: Unicode's white space, as the tokenizer's pattern has it. Fixed values.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
COARSE = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The pattern of byte-level BPE. Fixed value.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bounds of the tables of recent pieces and words, in entries and characters.
CACHED_PIECES = 500_000
CACHED_WORDS = 700_000
CACHED_LENGTH = 48


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, extra = [""] * 256, 0x100
    for b in range(256):
        symbols[b] = chr(b if b in shown else extra)
        extra += b not in shown
    return symbols


class Recent:
    """Results of a function for the strings seen lately: two generations, bounded.

    When the newer one is full it takes the older one's place, so that strings not
    seen since the last turn are forgotten.
    """

    def __init__(self, entries: int, make: Callable[[str], bytes]) -> None:
        self.half, self.make = entries // 2, make
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def all(self, keys: list[str]) -> list[bytes]:
        newer, older, out = self.newer, self.older, []
        for key in keys:
            value = newer.get(key)
            if value is None:
                value = older.get(key)
                if value is None:
                    value = self.make(key)
                if len(key) <= CACHED_LENGTH:
                    newer[key] = value
                    if len(newer) >= self.half:
                        self.older = older = newer
                        self.newer = newer = {}
            out.append(value)
        return out


class Bpe:
    """A byte-level BPE tokenizer read from a ``tokenizers`` JSON file."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            parsed = json.load(f)
        kinds = (parsed["model"]["type"], (parsed["pre_tokenizer"] or {}).get("type"), parsed["normalizer"])
        if kinds != ("BPE", "ByteLevel", None):
            raise ValueError(f"not a byte-level BPE file: {path}")
        vocabulary: dict[str, int] = parsed["model"]["vocab"]
        symbols = byte_symbols()
        back = {s: b for b, s in enumerate(symbols)}
        self.words = regex.compile(WORDS)
        self.byte_ids = [vocabulary[s] for s in symbols]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(parsed["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[vocabulary[a] << 32 | vocabulary[b]] = (rank, vocabulary[a + b])
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.strings = [b""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, i in vocabulary.items():
            self.strings[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.split_special = None
        if self.special:
            longest_first = sorted(self.special, key=len, reverse=True)
            self.split_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.pieces = Recent(CACHED_PIECES, self._piece)
        self.known_words = Recent(CACHED_WORDS, self._word)

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge a word's symbols, lowest rank first, leftmost first among equals."""
        n = len(symbols)
        merges = self.merges
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            found = merges.get(symbols[i] << 32 | symbols[i + 1])
            if found:
                queue.append(found[0] << 32 | i)
        heapify(queue)
        while queue:
            entry = heappop(queue)
            left = entry & 0xFFFFFFFF
            right = after[left]
            # Stale: the left symbol was swallowed, or one side has changed meanwhile.
            if symbols[left] < 0 or right >= n:
                continue
            found = merges.get(symbols[left] << 32 | symbols[right])
            if not found or found[0] != entry >> 32:
                continue
            merged = found[1]
            symbols[left], symbols[right] = merged, -1
            following = after[left] = after[right]
            if following < n:
                before[following] = left
                found = merges.get(merged << 32 | symbols[following])
                if found:
                    heappush(queue, found[0] << 32 | left)
            previous = before[left]
            if previous >= 0:
                found = merges.get(symbols[previous] << 32 | merged)
                if found:
                    heappush(queue, found[0] << 32 | previous)
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> bytes:
        return packed(array("I", self.merge([self.byte_ids[b] for b in word.encode()])))

    def _piece(self, piece: str) -> bytes:
        return b"".join(self.known_words.all(self.words.findall(piece)))

    def _pieces(self, text: str) -> list[bytes]:
        return self.pieces.all(COARSE.findall(text))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.split_special is None or not any(s in text for s in self.special):
            return b"".join(self._pieces(text))
        out = []
        for k, part in enumerate(self.split_special.split(text)):
            out += [packed(array("I", [self.special[part]]))] if k % 2 else self._pieces(part)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.strings.__getitem__, unpacked(ids))).decode("utf-8", "replace")


def packed(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def unpacked(ids: bytes) -> array:
    out = array("I")
    out.frombytes(ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out


def tokenizer(path: str) -> Bpe:
    """The tokenizer of a file, once per Python worker."""
    return once_per_worker(("bpe", path), lambda: Bpe(path))


def encode(
    docs: DataFrame, path: str, text: str = "text", drop_text: bool = False, decoded: bool = False
) -> DataFrame:
    """Add ``n_tokens`` (long) and ``token_ids`` (binary, four bytes an id, little-endian).

    ``path`` is the tokenizer file, at the same place on every machine. With ``decoded``,
    a column of that name holds what the ids decode to, from the same pass over the texts.
    """
    results = T.StructType().add("n_tokens", "long").add("token_ids", "binary")
    if decoded:
        results = results.add("decoded", "string")

    def make() -> Callable:
        bpe = tokenizer(path)

        def run(texts: list[str]) -> list[list]:
            ids = [bpe.encode(t) for t in texts]
            columns = [[len(i) // 4 for i in ids], ids]
            return [*columns, [bpe.decode(i) for i in ids]] if decoded else columns

        return run

    return add_columns(docs, text, results, make, drop=[text] if drop_text else ())


def decode(encoded: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """Add ``decoded`` (string): the text of packed ids; null ids give an empty text."""
    import pyarrow as pa

    carried = [c for c in encoded.columns if c.lower() != "decoded"]
    frame = encoded.select(*[f"`{c}`" for c in carried])
    place = carried.index(ids)

    def run(batches):
        decoder = tokenizer(path)
        for batch in batches:
            texts = [decoder.decode(i or b"") for i in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*carried, "decoded"]
            )

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, T.StructField("decoded", T.StringType())]))
