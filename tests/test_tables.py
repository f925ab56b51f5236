"""Keyed tables: building, skew, merging and counters."""

import gzip
import json
import os

import pyarrow.parquet as pq
import pytest
from archives import GAP, record, response
from pyspark.sql import functions as F

import warcloom as w
from warcloom.operators import tables as T
from warcloom.scratch import scratch_root
from warcloom.sinks.tables import arrange_rows
from warcloom.sources.tables import check_parts

ROWS = "table string, key string, value string, source_file string, record_seq bigint"


def build(spark, tmp_path, files, parts=4, **kw):
    (tmp_path / "in").mkdir()
    for name, records in files.items():
        (tmp_path / "in" / name).write_bytes(GAP.join(records) + GAP)
    out = str(tmp_path / "out")
    counted = w.build_tables(spark, str(tmp_path / "in"), "commoncrawl", "cc", out, parts, **kw)
    return out, {r.counter: r.value for r in counted.collect()}


def stored(spark, out, table):
    rows = w.open_tables(spark, out).rows.filter(F.col("table") == table)
    return {r.key: r.value for r in rows.collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_record_types(spark, tmp_path):
    kinds = ["warcinfo", "request", "response", "metadata", "revisit", "Response", None]
    out, counts = build(
        spark, tmp_path, {"a.warc": [record(kind=k, rid=f"<{k}>", content=b"abcd") for k in kinds]}
    )
    assert counts["RECORDS"] == 7 and counts["SKIPPED_RECORDS"] == 5
    assert counts["GENERATED_DOCS"] == 2
    assert len(stored(spark, out, "data")) == 2
    assert len(stored(spark, out, "uri")) == 1


def test_repeats_and_missing_uris(spark, tmp_path):
    files = {
        "b.warc": [response(b"late", rid="<1>", uri="http://b/")],
        "a.warc": [
            response(b"early", rid="<1>", uri="http://a/"),
            response(b"two", rid="<2>", uri="http://a/"),
            response(b"three", rid="<3>", uri=None),
            response(b"four", rid="<4>", uri=""),
            response(b"\xff" + b"\x00" * 9, rid="<3>", uri=None),
        ],
    }
    out, counts = build(spark, tmp_path, files)
    ids = spark.createDataFrame([("<1>",), ("<2>",)], "i string")
    one, two = (r[0] for r in ids.select(w.doc_uuid("cc", F.col("i"))).collect())
    data, uri = stored(spark, out, "data"), stored(spark, out, "uri")
    assert '"body":"early"' in data[one] and len(data) == 4
    assert uri["http://a/"] == one and uri["http://b/"] == one and set(uri) == {"http://a/", "http://b/", ""}
    assert two in data
    assert counts["BINARY_RECORDS"] == 1
    assert (counts["MAPFILE_DATA_ENTRIES"], counts["MAPFILE_URI_ENTRIES"]) == (4, 3)
    assert counts["SKIPPED_RECORDS_TOO_LARGE"] == counts["SKIPPED_RECORDS_TOO_SMALL"] == 0


def test_no_records_at_all(spark, tmp_path):
    out, counts = build(spark, tmp_path, {"a.warc": [b"nothing here"]})
    assert set(counts.values()) == {0}
    assert w.open_tables(spark, out).rows.filter("table <> 'counts'").count() == 0


def test_layout(spark, tmp_path):
    """Rows lie in the part of their key, each file ascends, keys are unique."""
    records = [response(b"x", rid=f"<{i}>", uri=f"http://x/{i % 40}") for i in range(100)]
    out, _ = build(spark, tmp_path, {"a.warc": records})
    tables = w.open_tables(spark, out)
    assert tables.num_partitions == 4
    wrong = tables.rows.filter(F.col("part") != w.partition_id(F.col("key"), 4))
    assert wrong.count() == 0
    for name, size in (("data", 100), ("uri", 40)):
        keys = []
        for part in range(4):
            folder = f"{out}/table={name}/part={part}"
            files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
            assert len(files) == 1
            column = pq.read_table(f"{folder}/{files[0]}", partitioning=None)["key"].to_pylist()
            assert column == sorted(column)
            keys += column
        assert len(keys) == len(set(keys)) == size


def _skewed(spark, rows=3000):
    """A third of all rows share one key, in no particular order."""
    i = F.col("id")
    return spark.range(rows).select(
        F.when(i >= 0, "uri").otherwise("data").alias("table"),
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (i % 700).cast("string"))).alias("key"),
        F.concat(F.lit("v"), i.cast("string")).alias("value"),
        F.format_string("f%02d", i % 7).alias("source_file"),
        ((i * 7919) % rows).alias("record_seq"),
    )


@pytest.mark.parametrize("hot_rows", [2, 100, 10**9])
def test_hot_keys_give_the_same_table(spark, hot_rows):
    rows = _skewed(spark)
    profile = T.key_profile(rows, hot_rows=hot_rows)
    got = {r.key: r.value for r in arrange_rows(rows, profile, 4).collect()}
    expected = {}
    for r in sorted(rows.collect(), key=lambda r: (r.source_file, r.record_seq)):
        expected.setdefault(r.key, r.value)
    assert got == expected


def test_hot_repeats_are_dropped_before_the_shuffle(spark):
    rows = _skewed(spark)
    profile = T.key_profile(rows, hot_rows=100)
    assert [r.rows for r in T.hot_keys(profile).collect()] == [1000]
    assert T.drop_hot_repeats(rows, profile).filter("key = 'hot'").count() == 1
    arranged = plan(arrange_rows(rows, profile, 4))
    assert arranged.index("BroadcastHashJoin") > arranged.index("shufflepartitionidpassthrough")


def test_first_per_key_cuts_groups_before_the_shuffle(spark):
    first = plan(T.first_per_key(_skewed(spark)))
    assert first.index("Partial") > first.index("hashpartitioning")


def test_one_exchange_and_one_sort(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(response(b"x"))
    parsed = w.parse_records(w.read_warc(spark, str(tmp_path)), "commoncrawl")
    rows = T.map_rows(w.build_docs(w.keep_http_records(parsed), "cc"))
    arranged = plan(arrange_rows(rows, T.key_profile(rows), 4))
    assert arranged.count("Exchange") == 1
    assert arranged.count("Sort [") == 1
    assert "WindowGroupLimit" in arranged


def _mergeable(spark, *keys, parts=1):
    rows = [("data", k, v, 0) for k, v in keys]
    return spark.createDataFrame(rows, "table string, key string, value string, part int")


def test_merge_fixture(spark):
    dfs = [_mergeable(spark, *ks) for ks in ([("a", "1"), ("c", "2")], [("a", "3"), ("b", "4")], [])]
    merged = w.merge_tables(dfs)
    order = [(r.key, r.value) for r in T.arrange_merged(merged, 1).collect()]
    assert order == [("a", "1"), ("a", "3"), ("b", "4"), ("c", "2")]
    splits = spark.createDataFrame([("data", 0, i) for i in range(3)], "table string, part int, ordinal int")
    counts = {r.counter: r.value for r in w.merge_counters(merged, splits).collect()}
    assert counts == {
        "MAPFILES_TO_BE_MERGED": 3,
        "MAPFILE_MERGES_FINISHED": 1,
        "EMPTY_INPUT_MAPFILES": 1,
        "MAPFILE_INPUTS_EXHAUSTED": 2,
        "MAPFILE_ENTRIES_WRITTEN": 4,
    }
    for hot_rows in (1, 100):
        first = T.arrange_merged(merged, 1, "first_wins", hot_rows).collect()
        assert [(r.key, r.value) for r in first] == [("a", "1"), ("b", "4"), ("c", "2")]
    assert w.merge_tables(dfs, "first_wins").count() == 3


def test_merge_mismatch(spark):
    df = _mergeable(spark, ("a", "1"))
    shape, other = [("key", "string"), ("value", "string")], [("key", "string"), ("value", "int")]
    with pytest.raises(ValueError, match="types differ"):
        w.check_mergeable([shape, other], [1, 1])
    with pytest.raises(ValueError, match="partition counts differ"):
        w.check_mergeable([shape, shape[::-1]], [1, 2])
    with pytest.raises(ValueError, match="unknown merge mode"):
        w.merge_tables([df], "last_wins")


@pytest.mark.parametrize("change, message", [
    (lambda df: df.drop("value"), "lacks"),
    (lambda df: df.withColumn("value", F.lit(1)), "types differ"),
])
def test_merge_job_checks_the_files_own_types(spark, tmp_path, change, message):
    rows = _mergeable(spark, ("a", "1"), ("b", "2")).withColumn("ordinal", F.lit(0))
    w.write_merged(rows, str(tmp_path / "good"), 8)
    w.write_merged(rows, str(tmp_path / "odd"), 8)
    change(rows).write.mode("overwrite").partitionBy("table", "part").parquet(str(tmp_path / "other"))
    os.replace(tmp_path / "odd" / "_manifest.json", tmp_path / "other" / "_manifest.json")
    with pytest.raises(ValueError, match=message):
        w.merge_batches(spark, [str(tmp_path / "good"), str(tmp_path / "other")], str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_a_usual_merge_has_one_exchange(spark):
    merged = w.merge_tables([_mergeable(spark, ("a", "1")), _mergeable(spark, ("a", "2"))])
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("merge", "merge")
    plan = T.arrange_merged(merged, 4, inputs=2)._jdf.queryExecution().executedPlan().toString()
    assert list(jobs.getJobIdsForGroup("merge")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count("Exchange ") == 1


def test_part_beyond_the_partition_count(spark, tmp_path):
    rows = _mergeable(spark, ("a", "1")).withColumn("part", F.lit(7)).withColumn("ordinal", F.lit(0))
    w.write_merged(rows, str(tmp_path / "t"), 8)
    tables = w.open_tables(spark, str(tmp_path / "t"))
    check_parts(tables)
    with pytest.raises(ValueError, match="part 7 does not fit 4"):
        check_parts(w.Tables(tables.path, 4, tables.order, tables.rows))


def test_merged_hot_key_is_spread_and_whole(spark, tmp_path):
    rows = _skewed(spark).select(
        "table", "key", "value", w.partition_id(F.col("key"), 4).alias("part"),
        (F.col("record_seq") % 5).cast("int").alias("ordinal"),
    )
    out = str(tmp_path / "merged")
    w.write_merged(rows, out, 4, inputs=3000, hot_rows=200)
    merged = w.open_tables(spark, out)
    assert merged.rows.count() == 3000
    assert merged.rows.select("key", "value").exceptAll(rows.select("key", "value")).isEmpty()
    hot = merged.rows.filter("key = 'hot'")
    assert hot.select(F.input_file_name()).distinct().count() >= hot.count() // 200 > 4
    for folder, _, files in os.walk(out):
        for name in files:
            if name.endswith(".parquet"):
                t = pq.read_table(f"{folder}/{name}", partitioning=None)
                places = list(zip(t["key"].to_pylist(), t["ordinal"].to_pylist()))
                assert places == sorted(places)


def test_batches_merge_and_look_up(spark, tmp_path):
    outs = []
    for n in range(3):
        (tmp_path / str(n)).mkdir()
        out, _ = build(
            spark,
            tmp_path / str(n),
            {"a.warc": [response(b"%d" % n, rid=r) for r in ("<same>", f"<{n}>")]},
        )
        outs.append(out)
    merged = str(tmp_path / "merged")
    counts = {r.counter: r.value for r in w.merge_batches(spark, outs, merged).collect()}
    assert counts["MAPFILE_ENTRIES_WRITTEN"] == 9
    assert counts["EMPTY_INPUT_MAPFILES"] == 0
    names = spark.createDataFrame([("<same>",), ("<2>",), ("<9>",)], "name string")
    found = w.lookup(spark, merged, names, by="name", prefix="cc").collect()
    assert len(found) == 3 and sum(r.found for r in found) == 2
    bodies = sorted(r.value.split('"body":"')[1][0] for r in found if r.found)
    assert bodies == ["0", "2"]
    assert os.path.exists(f"{outs[0]}/table=data")

    # Merged tables can be merged again; the order of the first merge stays.
    last = str(tmp_path / "last")
    counts = {r.counter: r.value for r in w.merge_batches(spark, [merged, outs[2]], last).collect()}
    assert counts["MAPFILE_ENTRIES_WRITTEN"] == 9 + 3
    again = w.lookup(spark, last, names.filter("name = '<same>'"), by="name", prefix="cc").first()
    assert '"body":"0"' in again.value
    ordinals = w.open_tables(spark, last).rows.select("ordinal").distinct().collect()
    assert {r.ordinal for r in ordinals} == {0, 1, 2, 3}
    first = str(tmp_path / "first")
    counts = {
        r.counter: r.value for r in w.merge_batches(spark, [merged, outs[2]], first, "first_wins").collect()
    }
    assert counts["MAPFILE_ENTRIES_WRITTEN"] == 4 + 1
    assert counts["EMPTY_INPUT_MAPFILES"] == 0


def test_observed_counters(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(response(b"x") + GAP + record(kind="warcinfo"))
    parsed = w.parse_records(w.read_warc(spark, str(tmp_path)), "commoncrawl")
    df, seen = w.observe_counters(w.choose_encoding(parsed))
    df.count()
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["RECORDS"] == 2 and seen.get["GENERATED_DOCS"] == 1


def test_scratch_is_the_folder_the_session_names(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


class _Cluster:
    """A session on a cluster, as far as the scratch folder asks."""

    class conf:
        get = staticmethod(lambda *_: None)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_must_name_its_scratch_folder(monkeypatch):
    with pytest.raises(ValueError, match="spark.checkpoint.dir is not set"):
        scratch_root(_Cluster())
    monkeypatch.setattr(_Cluster.sparkContext, "master", "local[4]")
    assert os.path.isdir(scratch_root(_Cluster()))


def test_a_build_opens_each_archive_once(spark, tmp_path, monkeypatch):
    """Compressed archives; ranges of plain ones are looked at for where they start."""
    from warcloom.sources import files, warc

    log = tmp_path / "opened"

    def logged(path):
        with open(log, "a") as out:
            out.write(path.rsplit("/", 1)[1] + "\n")
        return files.open_file(path)

    monkeypatch.setattr(warc, "open_file", logged)
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.warc.gz").write_bytes(gzip.compress(response(b"x", rid=f"<{k}>") + GAP))
    w.build_tables(spark, str(tmp_path / "in"), "commoncrawl", "cc", str(tmp_path / "out"), 4).collect()
    assert sorted(log.read_text().split()) == ["0.warc.gz", "1.warc.gz", "2.warc.gz"]


@pytest.mark.parametrize("remembered", [1, 2, 500_000])
def test_repeats_are_told_while_reading(spark, tmp_path, monkeypatch, remembered):
    """Forgetting repeats doesn't change the tables; doubtful headers are left alone."""
    from warcloom.sources import warc

    monkeypatch.setattr(warc, "SEEN_KEYS", remembered)
    (tmp_path / "in").mkdir()
    records = [
        response(b"1", rid="<a>", uri="http://x/"), response(b"2", rid="<b>", uri="http://y/"),
        response(b"3", rid="<a>", uri="http://z/"), response(b"4", rid="<c>", uri="http://x/"),
        record(kind="request", content=b"5", rid="<d>", uri="http://q/"), response(b"6", rid="<d>", uri="http://q/"),
        response(b"7", rid="<\u00e9>", uri="http://\u00e9/"), response(b"8", rid="<\u00e9>", uri="http://\u00e9/"),
        record(kind="warcinfo"),
    ]
    (tmp_path / "in" / "a.warc").write_bytes(GAP.join(records))
    marked = warc.read_to_build(spark, str(tmp_path / "in"), "commoncrawl").filter("counts IS NULL").orderBy("record_seq").collect()
    assert len(marked) == 9 and not any(r.id_repeat or r.uri_repeat for r in marked[6:])
    if remembered > 2:
        assert [r.record_seq for r in marked if r.id_repeat] == [2, 5]
        assert [r.record_seq for r in marked if r.uri_repeat] == [3]
    out = str(tmp_path / "out")
    counts = {r.counter: r.value for r in w.build_tables(spark, str(tmp_path / "in"), "commoncrawl", "cc", out, 4).collect()}
    assert (counts["RECORDS"], counts["SKIPPED_RECORDS"], counts["GENERATED_DOCS"]) == (9, 1, 8)
    assert (counts["MAPFILE_DATA_ENTRIES"], counts["MAPFILE_URI_ENTRIES"]) == (5, 5)
    bodies = [json.loads(r.value)["payload"]["body"] for r in w.open_tables(spark, out).rows.filter("table = 'data'").collect()]
    assert sorted(bodies) == ["1", "2", "4", "5", "7"]


def test_codec_of_the_files(spark, tmp_path):
    out, _ = build(spark, tmp_path, {"a.warc": [response(b"x" * 100)]})
    files = [f"{d}/{n}" for d, _, names in os.walk(out) for n in names if n.endswith(".parquet")]
    for file in files:
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
    assert files
