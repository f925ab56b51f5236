"""BPE and token files against the tokenizers library."""

import random
import zlib
from array import array

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from warcloom.llm import bpe, token_files
from warcloom.llm.queries import tokenizer_file

BYTE, WORD = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
ALPHABET = list(" \n\t ab'sdtl<|>endoftextA1９é ́ \x1c\x1f\x85　​😀ß中ΣİK.,!?") + ["<|endoftext|>", "'ll", " the", "hello, "]
TEXTS = [None, "", " ", "a", "The cat, the CAT.", "x" * 30_000, "word " * 20_000, "<|endoftext|> a  <|endoftext|>b", "The cat, the CAT."]


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.lists(st.sampled_from(ALPHABET), max_size=25).map("".join))
def test_encode_and_decode_equal_the_library(text):
    own, theirs = bpe.tokenizer(BYTE), Tokenizer.from_file(BYTE)
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert list(array("I", own.encode(text))) == ids
    assert own.decode(own.encode(text)) == theirs.decode(ids, skip_special_tokens=False) == text


def test_pieces_equal_whole_texts(library):
    rng = random.Random(5)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(5_000)]
    own = token_files.encoder(WORD)
    assert own.by_piece
    assert [list(array("I", i)) for i in own.encode(texts)] == [
        e.ids for e in library[WORD].encode_batch_fast(texts, add_special_tokens=False)
    ]


def test_bounded_tables_give_the_same(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 4)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 4)
    small, usual = bpe.Bpe(BYTE), bpe.tokenizer(BYTE)
    for text in TEXTS[1:] * 2:
        assert small.encode(text) == usual.encode(text)


def test_encode_rows(spark, text_rows, library):
    rows = text_rows(list(enumerate(TEXTS)) + [(None, "no id")])
    coded = bpe.encode(rows, BYTE, decoded=True).collect()
    assert len(coded) == len(TEXTS) + 1
    for row in coded:
        ids = library[BYTE].encode(row.text or "", add_special_tokens=False).ids
        assert (row.n_tokens, list(array("I", row.token_ids)), row.decoded) == (len(ids), ids, row.text or "")
    assert coded[0].score == "x"
    again = bpe.decode(bpe.encode(rows, BYTE, drop_text=True), BYTE).collect()
    assert [r.decoded for r in again] == [r.text or "" for r in coded]
    empty = bpe.encode(text_rows([]), BYTE)
    assert empty.count() == 0 and "token_ids" in empty.columns


def test_token_files(spark, text_rows, library, tmp_path):
    rows = [(7 * k % 11, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (3, "same id"), (3, "same id")]
    out = str(tmp_path / "tokens")
    token_files.write_token_files(text_rows(rows), WORD, 2, out)
    whole = token_files.read_token_files(spark, out).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in whole) == sorted((i is not None, i or 0) for i, _ in rows)
    in_order = sorted(whole, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == sorted((r.doc_id for r in whole), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in in_order:
        assert (r.start, r.n_tokens, r.tokens[-1]) == (at, len(r.tokens), 2)
        at += r.n_tokens
    wanted = sorted([*library[WORD].encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows)
    assert sorted(r.tokens for r in whole) == wanted
    sums = token_files.read_token_files(spark, out, crc32=True)
    assert "tokens" not in sums.columns
    by_start = {r.start: r.ids_crc32 for r in sums.collect()}
    assert by_start == {r.start: zlib.crc32(np.array(r.tokens, "<u4").tobytes()) for r in whole}
    lengths = token_files.read_token_files(spark, out, tokens=False)
    scans = [line for line in lengths._jdf.queryExecution().toString().split("\n") if "ReadSchema" in line]
    assert scans and all("tokens:array" not in line for line in scans)


def test_token_files_of_nothing(spark, text_rows, tmp_path):
    out = str(tmp_path / "none")
    token_files.write_token_files(text_rows([]), WORD, 2, out)
    assert token_files.read_token_files(spark, out).count() == 0
