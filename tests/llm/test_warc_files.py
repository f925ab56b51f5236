"""WARC files: round trip, determinism, rolling, and commits that run again."""

import base64
import gzip
import hashlib

import pytest
from pyarrow import fs

from warcloom.llm import warc_files

PAGES = [
    (3, "http://a/", "same"),
    (1, "http://b/ü", "same"),
    (2, None, "other é"),
    (5, "http://c/", None),
    (4, "http://d/", ""),
    (9, "http://e/", "x" * 3_000_000),
    (7, "http://f/", "same"),
    (7, "http://f/", "same"),
    (1, "http://b/ü", "same"),
    (8, "http://g/", "line\r\n\r\nWARC/1.1\r\n"),
    (None, "http://h/", "same"),
    (-5, "http://i/", "long " * 1_000),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, payload string, shard string")


def expected(rows):
    """Rows by payload: the first with the smallest id is the response."""
    out, seen = [], set()
    for page, url, payload in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (payload or "").encode()
        ids = [r[0] for r in rows if (r[2] or "") == (payload or "") and r[0] is not None]
        first = page is None or (page == min(ids) and (page, data) not in seen)
        seen.add((page, data))
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, url, digest, len(data), "response" if first else "revisit", None if first else min(ids), data if first else None))
    return out


def test_round_trip(spark, tmp_path):
    out = str(tmp_path / "warc")
    made = warc_files.write_warc(frame(spark, PAGES), out, shard_bytes=1_000, roll_bytes=2_000)
    rows = warc_files.read_warc(spark, out).collect()
    got = [(r.page_id, r.url, r.payload_digest, r.payload_bytes, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, expected(PAGES)))
    for r in made.collect():
        data = (tmp_path / "warc" / "data" / r.name).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r.bytes, r.sha256)
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert not (tmp_path / "warc" / "_tmp").exists()
    assert "payload" not in warc_files.read_warc(spark, out, payloads=False).columns
    in_files = {}
    for r in rows:
        in_files.setdefault(r.file, []).append(r.page_id)
    ids = [i for f in sorted(in_files) for i in in_files[f] if i is not None]
    assert ids == sorted(ids) and len(in_files) > 3


def test_files_depend_on_the_rows_alone(spark, tmp_path):
    made = []
    for k, rows in enumerate((PAGES, PAGES[::-1])):
        source = frame(spark, rows).repartition(1 + 4 * k)
        made.append(warc_files.write_warc(source, str(tmp_path / str(k)), shard_bytes=1_000, roll_bytes=2_000))
    first, second = ({(r.name, r.sha256) for r in m.collect()} for m in made)
    assert first == second


def test_least_bytes(spark, tmp_path):
    out = str(tmp_path / "warc")
    warc_files.write_warc(frame(spark, PAGES), out, least_bytes=5)
    assert {r.record_type for r in warc_files.read_warc(spark, out).collect()} == {"response"}


def test_attempts_that_failed_leave_nothing(spark, tmp_path):
    out = str(tmp_path / "warc")
    stray = tmp_path / "warc" / "_tmp" / "lost" / "shard-00000000-00000.warc.gz"
    stray.parent.mkdir(parents=True)
    stray.write_bytes(b"half a file")
    warc_files.write_warc(frame(spark, PAGES), out)
    assert warc_files.read_warc(spark, out).count() == len(PAGES) and not stray.exists()


def test_damage_is_noticed(spark, tmp_path):
    out = str(tmp_path / "warc")
    made = warc_files.write_warc(frame(spark, PAGES[:3]), out).collect()
    path = tmp_path / "warc" / "data" / made[0].name
    records = list(warc_files.members(fs.LocalFileSystem().open_input_stream(str(path), compression=None)))
    path.write_bytes(b"".join(gzip.compress(r.replace(b"same", b"sane")) for r in records))
    with pytest.raises(Exception, match="digest"):
        warc_files.read_warc(spark, out).collect()


def test_nothing(spark, tmp_path):
    out = str(tmp_path / "warc")
    warc_files.write_warc(frame(spark, []), out)
    assert warc_files.read_warc(spark, out).count() == 0


def test_shards_follow_the_data(spark, tmp_path):
    """Dense, outlying, missing and repeated ids: no shard is twice as long as asked."""
    dense = [(i, f"http://x/{i}", f"{i} " * 300) for i in range(200)]
    odd = [(1 << 62, "u", "far " * 300), (-(1 << 60), "u", "low " * 300)]
    missing = [(None, None, f"none {i} " * 120) for i in range(120)]
    hot = [(77, "u", f"hot {i} " * 150) for i in range(120)]
    spaced = [(300, " http://x/a  b\n", "x"), (301, "http://x/c d", "y")]
    rows = dense + odd + missing + hot + spaced
    out = str(tmp_path / "warc")
    shards = warc_files.write_warc(frame(spark, rows), out, shard_bytes=20_000, roll_bytes=1 << 20).collect()
    assert len({r.shard for r in shards}) > 15
    read = warc_files.read_warc(spark, out).collect()
    size = {}
    for r in read:
        size[r.file] = size.get(r.file, 0) + r.payload_bytes + warc_files.HEAD_BYTES
    assert max(size.values()) <= 40_000
    expected = sorted(((p, u, (t or "").encode()) for p, u, t in rows), key=str)
    assert sorted(((r.page_id, r.url, bytes(r.payload)) for r in read), key=str) == expected


def test_sampled_bounds_split_a_table(spark, monkeypatch):
    monkeypatch.setattr(warc_files, "SAMPLED", 500)
    rows = [(i * i * i, "u", f"{i} " * 20) for i in range(4_000)]
    digested = warc_files.with_digests(frame(spark, rows).select("page_id", "url", "payload"))
    bounds = warc_files.shard_bounds(digested, 200_000)
    counts = warc_files.with_shards(digested, bounds).groupBy("shard").agg({"size": "sum", "*": "count"}).collect()
    sizes = [r["sum(size)"] + r["count(1)"] * warc_files.HEAD_BYTES for r in counts]
    assert len(sizes) > 8 and max(sizes) < 400_000
    assert bounds == warc_files.shard_bounds(digested.repartition(5), 200_000)
