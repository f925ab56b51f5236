"""Where records start and end, by hand-made bytes."""

import bz2
import gzip
import random
import tracemalloc
import zlib

import pytest
from archives import GAP, read_whole, record, response

import warcloom as w
from warcloom.sources import warc as source
from warcloom.sources.framing import ByteReader, frames
from warcloom.sources.splitting import split_files

ONE = response(b"hello") + GAP


def keys(row):
    lines = bytes(row.header_block).decode().split("\n")
    return [line.split(":")[0].strip() for line in lines]


def contents(rows):
    return [bytes(r.content) for r in rows]


def test_plain_one(scan):
    (row,) = scan(ONE)
    assert row.record_seq == 0
    assert row.warc_version == "WARC/1.0"
    assert row.source_file.endswith("/a.warc")
    assert bytes(row.content) == b"HTTP/1.1 200 OK\r\n\r\nhello"


@pytest.mark.parametrize(
    "name, pack",
    [
        ("gz_members.warc.gz", lambda rs: b"".join(map(gzip.compress, rs))),
        ("gz_single.warc.gz", lambda rs: gzip.compress(b"".join(rs))),
        ("bz2.warc.bz2", lambda rs: bz2.compress(b"".join(rs))),
        ("bz2_streams.warc.bz2", lambda rs: b"".join(map(bz2.compress, rs))),
        ("deflate.warc.deflate", lambda rs: zlib.compress(b"".join(rs))),
        ("no_extension", lambda rs: b"".join(rs)),
    ],
)
def test_codecs(scan, name, pack):
    rows = scan({name: pack([response(b"%d" % i) + GAP for i in range(3)])})
    assert [r.record_seq for r in rows] == [0, 1, 2]
    assert [c[-1:] for c in contents(rows)] == [b"0", b"1", b"2"]


def test_unreadable_codec_is_an_error(scan):
    with pytest.raises(Exception, match="no reader for .lz4"):
        scan({"a.warc.lz4": b"x"})


def test_empty_file(scan):
    assert scan({"a.warc": b"", "b.warc": ONE})[0].source_file.endswith("b.warc")


def test_junk_before(scan):
    assert len(scan(b"junk\n more\n\nWARC/1.1\n" + ONE)) == 1


def test_version_suffix(scan):
    assert len(scan(ONE.replace(b"WARC/1.0", b"WARC/1.0 x"))) == 1


def test_other_version_is_skipped(scan):
    rows = scan(ONE.replace(b"WARC/1.0", b"WARC/1.1") + response(b"second"))
    assert contents(rows) == [b"HTTP/1.1 200 OK\r\n\r\nsecond"]


def test_clueweb09_version(scan):
    data = ONE.replace(b"WARC/1.0", b"WARC/0.18")
    assert len(scan(data, "clueweb09")) == 1
    assert len(scan(data, "commoncrawl")) == 0


def test_lf_only_header(scan):
    (row,) = scan(record(content=b"x").replace(b"\r\n", b"\n"))
    assert keys(row)[0] == "WARC-Type"
    assert bytes(row.content) == b"x"


def test_truncated_header(scan):
    assert scan(b"WARC/1.0\r\nContent-Length: 3") == []


def test_blank_before_length(scan):
    (row,) = scan(b"WARC/1.0\r\nWARC-Type: x\r\n\r\nContent-Length: 2\r\n\r\nab")
    assert keys(row) == ["WARC-Type", "Content-Length"]
    assert bytes(row.content) == b"ab"


def test_two_lengths(scan):
    (row,) = scan(b"WARC/1.0\r\nContent-Length: 5\r\nContent-Length: 3\r\n\r\nabcde")
    assert bytes(row.content) == b"abc"


@pytest.mark.parametrize("name", ["CONTENT-LENGTH :", " content-length\t:", "Content-Length: +"])
def test_length_spelling(scan, name):
    (row,) = scan(f"WARC/1.0\r\n{name}4\r\n\r\nabcdef".encode())
    assert bytes(row.content) == b"abcd"


def test_bad_length_only(scan):
    assert scan(record(content=b"abc\r\n", length="abc")) == []


@pytest.mark.parametrize("bad", ["abc", "-5", "4294967296", "", "1.5"])
def test_bad_length_fuses_records(scan, bad):
    first = record(rid="<1>", content=b"payload line\r\n", length=bad)
    (row,) = scan(first + GAP + record(rid="<2>", content=b"second"))
    assert bytes(row.content) == b"second"
    assert "WARC/1.0" in keys(row) and "payload line" in keys(row)


def test_length_from_http_header(scan):
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabcdef"
    (row,) = scan(record(content=http, length="abc"))
    assert bytes(row.content) == b"abc"
    assert "HTTP/1.1 200 OK" in keys(row)


def test_short_plain(scan):
    assert len(scan(ONE + record(content=b"x" * 10)[:-1])) == 1


def test_short_gzip_keeps_partial_body(scan):
    body = random.Random(1).randbytes(5000)
    packed = gzip.compress(record(content=body))
    (row,) = scan({"a.warc.gz": packed[:-2000]})
    got = bytes(row.content)
    assert 0 < len(got) < 5000 and body.startswith(got)


def test_short_zstd_keeps_partial_body(scan):
    """A cut archive gives what it holds, whatever the codec."""
    zstandard = pytest.importorskip("zstandard")
    body = random.Random(1).randbytes(400_000)
    packed = zstandard.compress(record(content=body), level=1)
    (whole,) = scan({"a.warc.zst": packed})
    assert whole.content == body
    (row,) = scan({"a.warc.zst": packed[:-150_000]})
    assert 100_000 < len(row.content) < len(body) and body.startswith(row.content)
    two = zstandard.compress(record()) + zstandard.compress(record(content=body))
    assert len(scan({"a.warc.zst": two})) == 2


def test_gzip_ending_cleanly_inside_body(scan):
    assert scan({"a.warc.gz": gzip.compress(record(content=b"x" * 10)[:-1])}) == []


def test_zero_length(scan):
    (row,) = scan(record(content=b""))
    assert bytes(row.content) == b""


def test_marker_in_body(scan):
    body = b"a\r\nWARC/1.0\r\nContent-Length: 1\r\n\r\nz"
    assert contents(scan(record(content=body) + GAP + record(content=b"b"))) == [body, b"b"]


def test_no_gap(scan):
    assert contents(scan(record(content=b"a") + record(content=b"b"))) == [b"a", b"b"]


def test_types_and_content_options(spark, scan, tmp_path):
    data = b"".join(record(kind=k, content=k.encode()) + GAP for k in ("request", "warcinfo", "response"))
    assert [r.content and bytes(r.content) for r in scan(data, types=["request", "response"])] == [
        b"request",
        None,
        b"response",
    ]
    assert [r.content for r in scan(data, content=False)] == [None] * 3


def test_large_records_go_out_one_by_one(scan, monkeypatch):
    import warcloom.sources.warc as source

    monkeypatch.setattr(source, "BATCH_BYTES", 100)
    rows = scan(b"".join(record(content=b"%d" % i * 300) for i in range(5)))
    assert [len(r.content) for r in rows] == [300] * 5


def _mutations(rng, parts):
    """Archives with broken lengths, stray markers and missing pieces."""
    pieces = []
    for _ in range(rng.randint(1, 12)):
        piece = rng.choice(parts)
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(piece))
            change = rng.choice([b"", b"\n", b"\r\n\r\n", b":", b"WARC/1.0\r\n", b"Content-Length: 7\r\n", b"9"])
            piece = piece[:at] + change + piece[at + rng.randint(0, 3) :]
        pieces.append(piece + rng.choice([GAP, b"", b"\n", b"x"]))
    return b"".join(pieces)


PARTS = [
    response(b"hello\n\nworld"),
    record(kind="request", content=b"GET / HTTP/1.1\r\n\r\n"),
    record(content=b"a\nWARC/1.0\r\nContent-Length: 3\r\n\r\nabc\nWARC/1.0\nb"),
    record(content=b"", length="x"),
    b"junk\r\n",
    b"WARC/1.0\r\n",
]


def test_random_bytes_against_second_reader():
    rng = random.Random(42)
    for _ in range(3000):
        data = _mutations(rng, PARTS)
        step = rng.randint(1, 40)
        pos = 0

        def read(_):
            nonlocal pos
            pos += step
            return data[pos - step : pos]

        got = [(f.header_block, f.content) for f in frames(ByteReader(read), b"WARC/1.0", lambda k: True)]
        assert got == read_whole(data, b"WARC/1.0")


def test_split_files_read_the_same(spark, tmp_path):
    """Files cut into ranges of any width give the records of the whole file."""
    rng = random.Random(7)
    expected = {}
    for n in range(24):
        data = _mutations(rng, PARTS) + _mutations(rng, PARTS)
        path = tmp_path / f"{n:03}.warc"
        path.write_bytes(data)
        expected[f"file:{path}"] = [
            (i, h, c) for i, (h, c) in enumerate(read_whole(data, b"WARC/1.0"))
        ]
    for width in (97,):
        rows = w.read_warc(spark, str(tmp_path), split_bytes=width)
        got = {path: [] for path in expected}
        for r in rows.orderBy("source_file", "record_seq").collect():
            got[r.source_file].append((r.record_seq, bytes(r.header_block), bytes(r.content)))
        assert got == expected


def test_only_large_plain_files_are_split(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(ONE * 10)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(ONE * 10))
    files = w.warc_files(spark, str(tmp_path))
    pieces = split_files(spark, files, w.get_profile("commoncrawl"), 100).collect()
    assert sum(p.path.endswith(".gz") for p in pieces) == 1
    assert sum(p.path.endswith(".warc") for p in pieces) > 5
    assert files.columns == ["path", "length"]


def test_narrow_ranges_share_tasks(spark, tmp_path):
    """Tasks follow the bytes and cores, not how narrow the ranges are."""
    (tmp_path / "a.warc").write_bytes(ONE * 300)
    pieces = split_files(spark, w.warc_files(spark, str(tmp_path)), w.get_profile("commoncrawl"), 100)
    assert pieces.count() == 300
    assert pieces.rdd.getNumPartitions() < 5 * spark.sparkContext.defaultParallelism
    rows = w.read_warc(spark, str(tmp_path), split_bytes=100).select("record_seq")
    assert sorted(r.record_seq for r in rows.collect()) == list(range(300))


def test_a_task_holds_few_records_at_a_time():
    """Records gathered for a batch are few MB, and let go with it."""
    records = (("a.warc", n, "WARC/1.0", b"h", bytes(1 << 20)) for n in range(40))
    tracemalloc.start()
    try:
        assert sum(batch.num_rows for batch in source._batches(records)) == 40
        assert tracemalloc.get_traced_memory()[1] < 8 << 20
    finally:
        tracemalloc.stop()


def test_unknown_profile():
    with pytest.raises(ValueError, match="clueweb09, clueweb12, commoncrawl"):
        w.get_profile("nutch")
