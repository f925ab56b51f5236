"""Parts addressed by path, keys in slices, corpora with states, added builds, parts cut by key."""

import gzip
import json
import os
import threading

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from archives import GAP, response
from pyspark.sql import functions as F

import warcloom as w
from warcloom.operators import lookup as L
from warcloom.operators import tables as T
from warcloom.plans import jobs
from warcloom.sinks import tables as sinks
from warcloom.sources.tables import latest_version, write_facts


def archive(folder, name, *records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(gzip.compress(GAP.join(records) + GAP))


def documents(*numbers, body="body"):
    return [response(b"%s %d" % (body.encode(), i), rid=f"<{i}>", uri=f"http://x/{i}") for i in numbers]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("places")
    archive(root / "in", "a.warc.gz", *documents(*range(200)))
    out = str(root / "out")
    w.build_tables(spark, str(root / "in"), "commoncrawl", "cc", out, 16)
    return out


def scans(df):
    """(root paths, columns) of the scans in a plan."""
    nodes, found = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        elif name == "FileSourceScanExec":
            roots = node.relation().location().rootPaths()
            found.append(([roots.apply(i).toString() for i in range(roots.size())], list(node.requiredSchema().fieldNames())))
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return found


def of_values(df):
    return [roots for roots, columns in scans(df) if "value" in columns]


def keys_of(spark, *numbers):
    return spark.createDataFrame([(f"http://x/{n}",) for n in numbers], "key string")


def test_one_key_lists_one_folder(spark, built):
    tables = w.open_tables(spark, built)
    found = w.lookup(spark, tables, keys_of(spark, 7), by="uri")
    ((folder,),) = of_values(found)
    (row,) = found.collect()
    assert row.found and folder.endswith(f"/table=uri/part={row.part}")
    # Opening and looking up have listed nothing else.
    assert "rows" not in vars(tables) and "types" not in vars(tables)


def test_a_part_that_was_never_written(spark, tmp_path):
    archive(tmp_path / "in", "a.warc.gz", *documents(1))
    out = str(tmp_path / "out")
    w.build_tables(spark, str(tmp_path / "in"), "commoncrawl", "cc", out, 1000)
    found = {r.key: r for r in w.lookup(spark, out, keys_of(spark, 1, 2), by="uri").collect()}
    assert found["http://x/1"].found and not found["http://x/2"].found and found["http://x/2"].part != found["http://x/1"].part


def test_very_many_folders_are_not_named_one_by_one(spark, built, monkeypatch):
    monkeypatch.setattr("warcloom.sources.tables.DIRECT_FOLDERS", 3)
    found = w.lookup(spark, built, keys_of(spark, *range(60), 999), by="uri")
    ((root,),) = of_values(found)
    assert root.endswith("/out") and sum(r.found for r in found.collect()) == 60


@pytest.mark.parametrize("slice_bytes", [3_000, 8 << 20])
def test_keys_in_slices(spark, built, monkeypatch, slice_bytes):
    """However many keys there are, values move only of rows that have one."""
    monkeypatch.setattr(L, "LITERAL_KEYS", 3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        tables = w.open_tables(spark, built)
        keys = keys_of(spark, *range(150), *range(500, 520))
        wanted = L.checkpointed(keys.withColumn("part", w.partition_id(F.col("key"), 16)))
        hits = L.matches(tables, "uri", wanted, "value", slice_bytes=slice_bytes)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        assert hits.count() == 150 and hits.columns == ["key", "part", "value"]
        found = w.lookup(spark, tables, keys, by="uri", slice_bytes=slice_bytes).collect()
        assert len(found) == 170 and sum(r.found for r in found) == 150
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_slices_hold_what_fits():
    limit = 10 * (L.ROW_BYTES + 36)
    slices = L._slices([(0, 4, 4 * 36), (1, 5, 5 * 36), (2, 4, 4 * 36), (3, 25, 25 * 36), (4, 1, 36)], limit)
    assert [s for s in slices if s[2] == 1] == [([0, 1], 0, 1), ([2, 4], 0, 1)]
    assert [s for s in slices if s[0] == [3]] == [([3], k, 5) for k in range(5)]


def test_a_slice_of_one_part_is_cut_by_hash(spark, built):
    """Keys of one part that don't fit are still all found."""
    tables = w.open_tables(spark, built)
    keys = tables.rows.filter("table = 'uri' AND part = 3").select("key")
    wanted = L.checkpointed(keys.withColumn("part", F.lit(3)))
    try:
        few, L.LITERAL_KEYS = L.LITERAL_KEYS, 0
        assert L.matches(tables, "uri", wanted, "value", slice_bytes=600).count() == keys.count() > 3
    finally:
        L.LITERAL_KEYS = few


def test_many_keys_read_a_part_few_times(spark, built, monkeypatch):
    """Keys that fill very many slices meet their parts in one reading; few ones stay in slices."""
    monkeypatch.setattr(L, "LITERAL_KEYS", 3)
    tables, read = w.open_tables(spark, built), []
    real = w.Tables.part_rows
    monkeypatch.setattr(w.Tables, "part_rows", lambda self, table, parts, *a: read.extend(parts) or real(self, table, parts, *a))
    part = lambda keys: keys.withColumn("part", w.partition_id(F.col("key"), 16))
    keys = part(keys_of(spark, *range(200), *range(500, 540)))
    wanted = L.checkpointed(keys.filter("part <> 3").unionByName(keys.filter("part = 3").limit(1)))
    hits = L.matches(tables, "uri", wanted, "value", slice_bytes=200)
    rows = tables.rows.filter("table = 'uri'").select("key", "part", "value")
    expected = rows.join(wanted, ["key", "part"], "left_semi").collect()
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, expected))
    assert max(read.count(n) for n in range(16)) <= L.MAX_PIECES


def test_counters_leave_documents_alone(spark, built):
    found = jobs._generator_counters(w.open_tables(spark, built))
    assert sorted(columns for _, columns in scans(found)) == [[], ["value"]]
    plan = found._jdf.queryExecution().executedPlan().toString()
    of_value = next(line for line in plan.split("\n") if "FileScan" in line and "value#" in line)
    assert "(table#" in of_value and "= counts)" in of_value.split("PartitionFilters")[1]
    assert {r.counter: r.value for r in found.collect()}["MAPFILE_DATA_ENTRIES"] == 200


def test_counters_read_records_once(spark, built):
    records = spark.read.parquet(f"{built}/table=uri").select(
        F.lit("response").alias("record_type"), F.lit("UTF-8").alias("encoding"), F.col("value").alias("uuid"), F.col("key").alias("target_uri")
    )
    counted = w.counters(records)
    assert len(scans(counted)) == 1
    assert {r.counter: r.value for r in counted.collect()}["MAPFILE_URI_ENTRIES"] == 200


def corpus(tmp_path, segments=3):
    for s in range(segments):
        archive(tmp_path / "segments" / f"s{s}", "a.warc.gz", *documents(s, 100 + s))
    return str(tmp_path / "segments"), str(tmp_path / "out")


def bodies(tables):
    rows = tables.rows.filter("table = 'data'").collect()
    return sorted(json.loads(r.value)["payload"]["body"] for r in rows)


def test_a_replaced_segment_leaves_open_readers_alone(spark, tmp_path):
    root, out = corpus(tmp_path)
    w.build_corpus(spark, root, "commoncrawl", "cc", out, 4, files="*")
    opened = w.open_tables(spark, out)
    before = bodies(opened)
    archive(tmp_path / "segments" / "s1", "a.warc.gz", *documents(1, 101, body="new"))
    w.build_corpus(spark, root, "commoncrawl", "cc", out, 4, files="*", lo="s1", hi="s1")
    assert bodies(w.open_tables(spark, out)) == sorted([b for b in before if b not in ("body 1", "body 101")] + ["new 1", "new 101"])
    assert bodies(opened) == before and latest_version(spark, out)[0] == 4
    # What no state needs is deleted when it is old enough, and nothing else.
    assert w.drop_superseded(spark, out) == []
    (dropped,) = w.drop_superseded(spark, out, hours=0)
    assert "segment=segment-00001/generation=" in dropped and len(bodies(w.open_tables(spark, out))) == 6


def test_a_run_leaves_what_another_writes(spark, tmp_path):
    root, out = corpus(tmp_path, 1)
    other = tmp_path / "out" / "segment=segment-00000" / "generation=other" / "table=data"
    other.mkdir(parents=True)
    (other / "half-written").write_text("x")
    w.build_corpus(spark, root, "commoncrawl", "cc", out, 4, files="*")
    assert (other / "half-written").exists() and len(bodies(w.open_tables(spark, out))) == 2


def test_another_partition_count_is_refused(spark, tmp_path):
    root, out = corpus(tmp_path, 2)
    w.build_corpus(spark, root, "commoncrawl", "cc", out, 4, files="*")
    with pytest.raises(ValueError, match="2 segments of 4 partitions"):
        w.build_corpus(spark, root, "commoncrawl", "cc", out, 8, files="*", lo="s1", hi="s1")
    found = w.lookup(spark, out, keys_of(spark, 0, 1, 100, 101), by="uri")
    assert all(r.found for r in found.collect())


def test_states_of_two_runs_both_count(spark, tmp_path, monkeypatch):
    """A run that read the state before another one stored its own takes that one up."""
    root, out = corpus(tmp_path, 2)
    w.build_corpus(spark, root, "commoncrawl", "cc", out, 4, files="*", hi="s0")
    real, stale = sinks.latest_version, [(0, None)]
    monkeypatch.setattr(sinks, "latest_version", lambda *a: stale.pop() if stale else real(*a))
    (generation,) = os.listdir(f"{out}/segment=segment-00000")
    sinks.commit_segment(spark, out, "segment-00001", generation[11:], 4)
    number, facts = real(spark, out)
    assert number == 2 and sorted(facts["segments"]) == ["segment-00000", "segment-00001"]
    assert not write_facts(spark, f"{out}/_versions/00000002.json", {}, replace=False)
    assert real(spark, out) == (number, facts) and not [n for n in os.listdir(f"{out}/_versions") if "00000003" in n]


def test_segments_are_built_side_by_side(spark, tmp_path, monkeypatch):
    root, out = corpus(tmp_path, 2)
    together, real = threading.Barrier(2, timeout=60), jobs.build_tables

    def build(*args):
        together.wait()
        return real(*args)

    monkeypatch.setattr(jobs, "build_tables", build)
    counted = w.build_corpus(spark, root, "commoncrawl", "cc", out, 4, files="*", at_once=2)
    counts = {(r.segment, r.counter): r.value for r in counted.collect()}
    assert counts["segment-00000", "RECORDS"] == counts["segment-00001", "RECORDS"] == 2


def test_threads_take_turns_with_settings(spark):
    """One thread's settings must not end while another builds a DataFrame under them."""
    from warcloom.functions.charset import body_text_settings

    wrong = []

    def build():
        for _ in range(20):
            with body_text_settings(spark):
                raw = F.base64(F.repeat(F.lit("x"), 100).cast("binary"))
                wrong.append("\n" in spark.range(1).select(raw).first()[0])

    threads = [threading.Thread(target=build) for _ in range(4)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(wrong) == 80 and not any(wrong)


def contents(spark, out):
    rows = w.open_tables(spark, out).rows.filter("table IN ('data', 'uri', 'binary')")
    return sorted(tuple(r) for r in rows.select("table", "key", "value", "part").collect())


def test_added_builds_equal_one_build(spark, tmp_path):
    archive(tmp_path / "in", "a.warc.gz", *documents(*range(30)))
    archive(tmp_path / "in", "b.warc.gz", *documents(*range(20, 50), body="later"), response(b"\xff" + b"\x00" * 9, rid="<bin>", uri="http://x/bin"))
    archive(tmp_path / "in", "c.warc.gz", *documents(*range(45, 60), body="last"))
    whole, steps = str(tmp_path / "whole"), str(tmp_path / "steps")
    at_once = w.build_tables(spark, str(tmp_path / "in"), "commoncrawl", "cc", whole, 4).collect()
    w.build_tables(spark, str(tmp_path / "in" / "a.warc.gz"), "commoncrawl", "cc", steps, 4)
    files = lambda: {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(steps) for n in names if n.endswith(".parquet")}
    before, reader = files(), w.open_tables(spark, steps)
    for name in ("b", "c", "b"):
        counted = w.add_to_tables(spark, str(tmp_path / "in" / f"{name}.warc.gz"), "commoncrawl", "cc", steps)
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, at_once))
    assert contents(spark, steps) == contents(spark, whole)
    assert before.items() <= files().items() and reader.rows.filter("table = 'uri'").count() == 30
    found = w.lookup(spark, steps, keys_of(spark, 3, 25, 47, 59, 99), by="uri")
    assert sum(r.found for r in found.collect()) == 4
    # Tables with added folders merge like others.
    merged = str(tmp_path / "merged")
    w.merge_batches(spark, [steps, whole], merged, mode="first_wins")
    assert [r[:3] for r in contents(spark, merged)] == [r[:3] for r in contents(spark, whole) if r[0] != "binary"]


def test_adding_takes_turns(spark, tmp_path, monkeypatch):
    archive(tmp_path / "in", "a.warc.gz", *documents(1))
    out = str(tmp_path / "out")
    w.build_tables(spark, str(tmp_path / "in"), "commoncrawl", "cc", out, 4)
    real, reads = jobs.read_facts, []
    monkeypatch.setattr(jobs, "read_facts", lambda *a: reads.append(1) or real(*a) | ({"added": {"_added-other": {}}} if len(reads) > 1 else {}))
    with pytest.raises(RuntimeError, match="changed"):
        w.add_to_tables(spark, str(tmp_path / "in"), "commoncrawl", "cc", out)
    assert not [n for n in os.listdir(out) if n.startswith("_added")]
    monkeypatch.undo()
    with pytest.raises(ValueError, match="no tables of a build"):
        w.add_to_tables(spark, str(tmp_path / "in"), "commoncrawl", "cc", str(tmp_path / "none"))


def hot_inputs(spark, out, inputs=60):
    """Tables with a key in each of many inputs, and others."""
    rows = spark.range(inputs * 20).select(
        F.lit("data").alias("table"), F.when(F.col("id") % 20 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        F.col("id").cast("string").alias("value"), F.lit(0).alias("part"), F.floor(F.col("id") / 20).cast("int").alias("ordinal"),
    )
    w.write_merged(rows, out, 1, inputs=inputs, hot_rows=50)


def test_a_large_part_is_one_order_over_its_files(spark, tmp_path):
    out = str(tmp_path / "t")
    hot_inputs(spark, out)
    folder = f"{out}/table=data/part=0"
    files = sorted(n for n in os.listdir(folder) if n.endswith(".parquet"))
    tables = [pq.read_table(f"{folder}/{n}", partitioning=None) for n in files]
    places = [p for t in tables for p in zip(t["key"].to_pylist(), t["ordinal"].to_pylist())]
    assert len(places) == 1200 and places == sorted(places) and len(files) > 12
    assert sum("hot" in t["key"].to_pylist() for t in tables) > 5
    cuts = json.load(open(f"{out}/_manifest.json"))["cuts"]["data"]["0"]
    assert cuts == [[n, t["key"][0].as_py()] for n, t in zip(files, tables)]

    opened = w.open_tables(spark, out)
    one = w.lookup(spark, opened, spark.createDataFrame([("k1110",)], "key string"))
    ((*paths,),) = of_values(one)
    assert len(paths) <= 2 and one.first().value == "1110"
    hot = w.lookup(spark, opened, spark.createDataFrame([("hot",), ("zzz",), ("",)], "key string"))
    assert {r.key: r.value for r in hot.collect()}["hot"] in {str(i) for i in range(8)}


def test_small_files_are_not_very_many(spark, tmp_path, monkeypatch):
    """However few rows a file is to have, files and tasks stay few, and are one order of keys."""
    monkeypatch.setattr(T, "SMALL_FILES", 24, raising=False)
    rows = spark.range(4000).select(
        F.lit("data").alias("table"), F.col("id").cast("string").alias("key"), F.lit("v").alias("value"),
        (F.col("id") % 2).cast("int").alias("part"), F.lit(0).alias("ordinal"),
    )
    out = str(tmp_path / "t")
    w.write_merged(rows, out, 2, inputs=2, hot_rows=2)
    for part in (0, 1):
        folder = f"{out}/table=data/part={part}"
        files = sorted(n for n in os.listdir(folder) if n.endswith(".parquet"))
        keys = [k for n in files for k in pq.read_table(f"{folder}/{n}", partitioning=None)["key"].to_pylist()]
        assert 4 <= len(files) <= 26 and keys == sorted(str(i) for i in range(part, 4000, 2))


def test_files_follow_the_rows():
    assert T.cut_files([("data", 0, 1200)], 50) == 36
    assert T.cut_files([("data", 0, 10**6)], 10) == T.SMALL_FILES
    assert T.cut_files([("data", 0, 10**9)], 10) == T.cut_files([("data", 0, 10**9)], 100_000) == 15_000
    assert T.cut_files([("data", n, 500) for n in range(1000)], 10) == 4000


def test_cuts_are_left_by_later_merges(spark, tmp_path):
    hot_inputs(spark, str(tmp_path / "a"))
    counts = w.merge_batches(spark, [str(tmp_path / "a"), str(tmp_path / "a")], str(tmp_path / "b"), hot_rows=100)
    assert {r.counter: r.value for r in counts.collect()}["MAPFILE_ENTRIES_WRITTEN"] == 2400
    first = w.merge_batches(spark, [str(tmp_path / "b")], str(tmp_path / "c"), mode="first_wins")
    assert {r.counter: r.value for r in first.collect()}["MAPFILE_ENTRIES_WRITTEN"] == 721
    assert T.large_parts(w.open_tables(spark, str(tmp_path / "b")).rows, 100) == [("data", 0, 2400)]


@pytest.mark.parametrize("column", ["key", "value"])
def test_one_odd_part_is_told_by_its_footer(spark, tmp_path, column):
    rows = spark.range(80).select(
        F.lit("data").alias("table"), F.col("id").cast("string").alias("key"), F.lit("v").alias("value"),
        (F.col("id") % 8).cast("int").alias("part"), F.lit(0).alias("ordinal"),
    )
    for name in ("good", "odd"):
        w.write_merged(rows, str(tmp_path / name), 8)
    part = tmp_path / "odd" / "table=data" / "part=5"
    for n in os.listdir(part):
        os.remove(part / n)
    made = {"key": ["1"], "value": ["v"], "ordinal": [0]} | {column: [7]}
    pq.write_table(pa.table(made), part / "part-0.parquet")
    with pytest.raises(ValueError, match="types differ"):
        w.merge_batches(spark, [str(tmp_path / "good"), str(tmp_path / "odd")], str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_keys_have_bloom_filters(spark, built):
    footers = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader
    path = w.open_tables(spark, built).rows.filter("table = 'uri'").inputFiles()[0]
    file = spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration())
    reader = footers.open(file)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    filtered = {columns.get(i).getPath().toDotString(): columns.get(i).getBloomFilterOffset() > 0 for i in range(columns.size())}
    reader.close()
    assert filtered == {"key": True, "value": False}


def test_map_files_without_python_rows(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}\u00e9", f"v{i}\u0000\u65e5\u672c \U0001f600" * (i % 5)) for i in range(40)], "key string, value string")
    path = str(tmp_path / "files")
    w.write_map_files(rows, path, 3, name="data")
    back = w.read_map_files(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "LogicalRDD" not in plan and "SerializeFromObject" in plan
