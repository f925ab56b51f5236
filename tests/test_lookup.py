"""Look-ups, rendering, splits, interchange formats and corpora."""

import gzip
import json
import os

import pyarrow.parquet as pq
import pytest
from archives import GAP, response
from pyspark.sql import functions as F

import warcloom as w
from warcloom.operators import lookup as L


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("built")
    (root / "in").mkdir()
    data = GAP.join(response(b"body %d" % i, rid=f"<{i}>", uri=f"http://x/{i}") for i in range(50))
    (root / "in" / "a.warc").write_bytes(data)
    out = str(root / "out")
    w.build_tables(spark, str(root / "in"), "commoncrawl", "cc", out, 8)
    return out


def uris(spark, *numbers):
    return spark.createDataFrame([(f"http://x/{n}",) for n in numbers], "key string")


@pytest.mark.parametrize("literal_keys", [256, 0])
def test_hit_and_miss(spark, built, monkeypatch, literal_keys):
    """Both ways of looking up: keys in the query, and joined keys."""
    monkeypatch.setattr(L, "LITERAL_KEYS", literal_keys)
    found = {r.key: r for r in w.lookup(spark, built, uris(spark, 3, 3, 99), by="uri").collect()}
    assert len(found) == 2
    assert found["http://x/3"].found and not found["http://x/99"].found
    assert found["http://x/99"].value is None and found["http://x/99"].part is not None
    missing = w.missing_keys(spark, built, uris(spark, 3, 99), by="uri").collect()
    assert [r.key for r in missing] == ["http://x/99"]


def test_uri_to_document_and_by_name(spark, built):
    docs = w.documents_by_uri(spark, built, uris(spark, 7, 99).withColumnRenamed("key", "uri"))
    rows = {r.uri: r for r in docs.collect()}
    assert json.loads(rows["http://x/7"].value)["payload"]["body"] == "body 7"
    assert not rows["http://x/99"].found and rows["http://x/99"].uuid is None
    names = spark.createDataFrame([("<7>",)], "name string")
    (named,) = w.lookup(spark, built, names, by="name", prefix="cc").collect()
    assert named.key == rows["http://x/7"].uuid and named.found


def test_few_keys_reach_the_scan(spark, built):
    plan = w.lookup(spark, built, uris(spark, 3), by="uri")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line and "table#" in line)
    assert "part#" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "table#" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "EqualTo(key,http://x/3)" in scan or "In(key, [http://x/3])" in scan


@pytest.fixture(scope="module")
def many_groups(spark, tmp_path_factory):
    """One part of many row groups, sorted by key."""
    out = str(tmp_path_factory.mktemp("groups") / "t")
    rows = spark.range(40_000).select(
        F.lit("data").alias("table"), F.lit(0).alias("part"), F.format_string("k%06d", "id").alias("key"),
        F.repeat(F.md5(F.col("id").cast("string")), 4).alias("value"), F.lit(0).alias("ordinal"),
    )
    w.write_merged(rows, out, 1)
    kept = pq.read_table(f"{out}/table=data/part=0", partitioning=None).sort_by("key")
    (file,) = (f for f in os.listdir(f"{out}/table=data/part=0") if f.endswith(".parquet"))
    os.remove(f"{out}/table=data/part=0/.{file}.crc")
    pq.write_table(kept, f"{out}/table=data/part=0/{file}", row_group_size=900)
    return out


def _scanned_rows(df):
    """Rows that the scans of tables with values have put out."""
    df.collect()
    nodes, total = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        elif name == "FileSourceScanExec" and "value" in node.schema().simpleString():
            total += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("n", [1, 10, 11, 44])
def test_only_matching_row_groups_are_read(spark, many_groups, n):
    keys = spark.createDataFrame([(f"k{i * 900:06d}",) for i in range(n)], "key string")
    found = w.lookup(spark, many_groups, keys)
    assert _scanned_rows(found) <= n * 900
    near = spark.createDataFrame([(f"k{i:06d}",) for i in range(200)], "key string")
    assert _scanned_rows(w.lookup(spark, many_groups, near)) <= 900


def test_many_keys_do_not_move_the_table(spark, many_groups):
    """Above the limit of literal keys, and with the table too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 200_000)
    try:
        keys = spark.createDataFrame([(f"k{i * 7:06d}",) for i in range(300)] + [("none",)], "key string")
        found = w.lookup(spark, many_groups, keys)
        plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
        scan = next(k for k, line in enumerate(plan) if "FileScan" in line and "value" in line)
        depth = lambda line: len(line) - len(line.lstrip(" :+-*("))
        above, level = [], depth(plan[scan])
        for line in plan[scan - 1 :: -1]:
            if depth(line) < level:
                above.append(line)
                level = depth(line)
        joined = next(k for k, line in enumerate(above) if "BroadcastHashJoin" in line)
        assert not any("Exchange" in line for line in above[:joined])
        rows = found.collect()
        assert len(rows) == 301 and sum(r.found for r in rows) == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_documents_by_uri_scans_each_table_once(spark, built):
    found = w.documents_by_uri(spark, built, uris(spark, *range(60)).withColumnRenamed("key", "uri"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    tables = [line for line in plan.split("\n") if "FileScan" in line and "table#" in line]
    assert len(tables) == 1 and sum(r.found for r in found.collect()) == 50 and found.count() == 60


def test_no_keys(spark, built):
    assert w.lookup(spark, built, uris(spark)).collect() == []


def test_arguments(spark, built):
    names = spark.createDataFrame([("<1>",)], "name string")
    with pytest.raises(ValueError, match="needs a prefix"):
        w.lookup(spark, built, names, by="name")
    with pytest.raises(ValueError, match="unknown lookup"):
        w.lookup(spark, built, names, by="title")


def test_render(spark):
    df = spark.createDataFrame([("k", 7, "v", True)], "key string, part int, value string, found boolean")
    assert w.render(df, "record").columns == ["value"]
    assert w.render(df).columns == ["key", "value"]
    assert tuple(w.render(df, "verbose", "uri", "/out").first()) == ("k", "00007", "/out/uri-r-00007", "v")
    with pytest.raises(ValueError, match="unknown render mode"):
        w.render(df, "pretty")


def test_splits(spark, built):
    splits = w.list_splits(spark, built).collect()
    assert {s.name for s in splits if s.part == 3} <= {"data-r-00003", "uri-r-00003"}
    assert len(splits) == len({s.path for s in splits}) > 8
    names = spark.createDataFrame([("data-r-00001",), ("uri-r-00002",), ("_SUCCESS",), ("logs",)], "name string")
    assert w.keep_table_splits(names).count() == 2


def test_map_files(spark, built, tmp_path):
    rows = w.open_tables(spark, built).rows.filter("table = 'uri'")
    path = str(tmp_path / "uri")
    w.write_map_files(rows, path, 4, name="uri")
    folders = sorted(f for f in os.listdir(path) if f.startswith("uri-r-"))
    assert folders == [f"uri-r-{i:05}" for i in range(4)]
    assert sorted(f for f in os.listdir(f"{path}/{folders[0]}") if not f.startswith(".")) == ["data", "index"]
    back = w.read_map_files(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.select("key", "value").collect()))
    one = [r.key for r in w.read_map_files(spark, f"{path}/uri-r-00001").collect()]
    assert one == sorted(one) and one
    listed = w.list_splits(spark, path).collect()
    assert sorted(s.part for s in listed) == [0, 1, 2, 3]


def test_archives_round_trip(spark, tmp_path):
    (tmp_path / "in.warc").write_bytes(
        response("crlf é".encode(), rid="<1>", headers=("HTTP/1.1 200 OK", "A: 1"))
        + GAP
        + response(b"lf\r\n\r\nx", rid="<2>", headers=("HTTP/1.1 200 OK", "A: 1"), end="\n")
        + GAP
        + response(b"\xff\x00WARC/1.0\r\n\r\n", rid="<3>")
    )
    first = w.parse_records(w.read_warc(spark, str(tmp_path / "in.warc")), "commoncrawl")
    written = w.write_warc(first, str(tmp_path / "out")).collect()
    assert sum(r.records for r in written) == 3
    again = w.parse_records(w.read_warc(spark, str(tmp_path / "out")), "commoncrawl")
    columns = ["record_id", "record_type", "target_uri", "http_header_bytes", "body", "http_split_ok"]
    rows = lambda df: [tuple(r) for r in df.select(*columns).orderBy("record_id").collect()]
    assert rows(first) == rows(again)


def test_corpus_by_segments(spark, tmp_path):
    for s in range(5):
        folder = tmp_path / "segments" / f"s{s}" / "warc"
        folder.mkdir(parents=True)
        for f in range(2):
            (folder / f"{f}.warc").write_bytes(
                response(b"%d %d" % (s, f), rid="<same>", uri="http://same/") + GAP
                + response(b"own", rid=f"<{s}>", uri=f"http://{s}/")
            )
    out = str(tmp_path / "out")
    counted = w.build_corpus(
        spark, str(tmp_path / "segments"), "commoncrawl", "cc", out, 4, lo="s1", hi="s3", files="warc/*"
    )
    counts = {(r.segment, r.counter): r.value for r in counted.collect()}
    assert {s for s, _ in counts} == {"segment-00001", "segment-00002", "segment-00003"}
    assert counts["segment-00002", "RECORDS"] == 4
    assert counts["segment-00002", "MAPFILE_DATA_ENTRIES"] == 2
    rows = w.open_tables(spark, out).rows
    assert rows.filter("table = 'data'").count() == 6
    for folder, _, files in os.walk(out):
        for name in (f for f in files if f.endswith(".parquet")):
            keys = pq.read_table(f"{folder}/{name}", partitioning=None)["key"].to_pylist()
            assert keys == sorted(keys)
    same = spark.createDataFrame([("<same>",)], "name string")
    (found,) = w.lookup(spark, out, same, by="name", prefix="cc").collect()
    assert json.loads(found.value)["payload"]["body"] == "1 0"
    # Top-level tables are numbered over all segments; each can be opened by itself too.
    own = w.open_tables(spark, f"{out}/segment=segment-00002").rows
    assert own.filter("table = 'data'").count() == 2
    with pytest.raises(ValueError, match="no segment"):
        w.build_corpus(spark, str(tmp_path / "segments"), "commoncrawl", "cc", out, 4, lo="x")


def test_corpus_in_several_runs(spark, tmp_path):
    """A broken archive costs its own segment; a second run builds that one alone."""
    for s in range(3):
        folder = tmp_path / "segments" / f"s{s}"
        folder.mkdir(parents=True)
        data = response(b"body %d" % s, rid=f"<{s}>", uri=f"http://{s}/") + GAP
        (folder / "a.warc.gz").write_bytes(gzip.compress(data) + (b"\0" * 16 if s == 1 else b""))
    root, out = str(tmp_path / "segments"), str(tmp_path / "out")
    build = lambda **kw: w.build_corpus(spark, root, "commoncrawl", "cc", out, 4, files="*", **kw)
    data_of = lambda: sorted(json.loads(r.value)["payload"]["body"] for r in w.open_tables(spark, out).rows.filter("table = 'data'").collect())
    with pytest.raises(w.SegmentError) as error:
        build()
    assert set(error.value.failed) == {"s1"} and data_of() == ["body 0", "body 2"]
    files = lambda s: {f: os.stat(f).st_mtime_ns for d, _, names in os.walk(f"{out}/segment=segment-0000{s}") for f in (f"{d}/{n}" for n in names)}
    before = files(0), files(2)
    repaired = response(b"body 1", rid="<1>", uri="http://1/") + GAP
    (tmp_path / "segments" / "s1" / "a.warc.gz").write_bytes(gzip.compress(repaired))
    counts = {(r.segment, r.counter): r.value for r in build(lo="s1", hi="s1").collect()}
    assert counts["segment-00001", "MAPFILE_DATA_ENTRIES"] == 1 and {s for s, _ in counts} == {"segment-00001"}
    assert data_of() == ["body 0", "body 1", "body 2"] and (files(0), files(2)) == before
    assert not os.path.exists(f"{out}/_building")


def test_segment_range_counts_all(spark):
    segments = spark.createDataFrame([(f"s{i}",) for i in range(5)], "segment string")
    rows = w.segment_range(segments, "s1", "s3").collect()
    assert [(r.segment, r.ordinal) for r in rows] == [("s1", 1), ("s2", 2), ("s3", 3)]
    assert w.segment_range(segments).count() == 5
