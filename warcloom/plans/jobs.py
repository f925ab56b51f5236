"""Whole jobs: building tables, merging them, building a corpus segment by segment."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.functions.identity import segment_name
from warcloom.operators import tables as T
from warcloom.operators.counters import RECORD_COUNTERS, as_rows, merge_counters
from warcloom.operators.docs import build_docs
from warcloom.operators.lookup import matches
from warcloom.operators.records import HTTP_TYPES, parse_records
from warcloom.operators.segments import segment_range
from warcloom.profiles import get_profile
from warcloom.scratch import checkpointed, drop_scratch
from warcloom.sinks.tables import (
    arrange_rows,
    check_corpus,
    commit_segment,
    save_rows,
    segment_path,
    write_merged,
    write_rows,
)
from warcloom.sources.tables import MANIFEST, Tables, check_parts, open_tables, read_facts, write_facts, written_parts
from warcloom.sources.warc import read_to_build

Detector = Callable[[Column], Column]


def _generator_counters(tables: Tables) -> DataFrame:
    """Counters from the rows written: (counter, value).

    How many rows a table has is in the footers of its files; values are read of the small
    table of counts alone.
    """
    number = lambda name: F.coalesce(F.sum(F.get_json_object("value", f"$.{name}").cast("bigint")), F.lit(0))
    records = tables.rows.filter(F.col("table") == T.COUNTS).agg(
        number("records").alias("RECORDS"),
        (number("records") - number("documents")).alias("SKIPPED_RECORDS"),
        number("documents").alias("GENERATED_DOCS"),
    )
    entries = lambda table: F.count_if(F.col("table") == table)
    written = tables.rows.select("table").agg(
        entries(T.BINARY).alias("BINARY_RECORDS"),
        entries(T.DATA).alias("MAPFILE_DATA_ENTRIES"),
        entries(T.URI).alias("MAPFILE_URI_ENTRIES"),
    )
    unused = [n for n in RECORD_COUNTERS if n not in (*records.columns, *written.columns)]
    return as_rows(records.withColumns({n: F.lit(0) for n in unused}), (*records.columns, *unused)).unionByName(
        as_rows(written, tuple(written.columns))
    )


def build_tables(
    spark: SparkSession,
    input: str | list[str],
    profile: str,
    prefix: str,
    output: str,
    num_partitions: int,
    detector: Detector | None = None,
) -> DataFrame:
    """Build the data and URI tables of an archive path; returns (counter, value).

    Archives are read once, with one shuffle behind. Repeats of a key within a file are
    told while it is read and never moved, so a key that many records share is moved
    about once per file.
    """
    get_profile(profile)
    parsed = parse_records(read_to_build(spark, input, profile), profile)
    kept = parsed.filter(F.col("record_type").isin(*HTTP_TYPES) | F.col("counts").isNotNull())
    rows = T.map_rows(build_docs(kept, prefix, detector), binary=True)
    write_rows(rows, None, output, num_partitions)
    return _generator_counters(open_tables(spark, output))


def add_to_tables(
    spark: SparkSession,
    input: str | list[str],
    profile: str,
    prefix: str,
    output: str,
    detector: Detector | None = None,
) -> DataFrame:
    """Add further archives to built tables; returns the counters of all of them.

    The tables are then those of one build of everything, the new archives after the old ones: keys
    that are there stay as they are, and archives that were built before add nothing. Work
    grows with what is new: its keys are looked for in their parts, of which only keys are
    read, and the rest becomes a further folder. Files that are there are not rewritten,
    and readers see the new ones all at once. Adding takes turns: if the tables have
    changed meanwhile, RuntimeError is raised and nothing is added.
    """
    get_profile(profile)
    before = read_facts(spark, f"{output}/{MANIFEST}")
    if before is None or before.get("order"):
        raise ValueError(f"{output} has no tables of a build; merged tables and corpora can't be added to")
    tables = open_tables(spark, output)
    parsed = parse_records(read_to_build(spark, input, profile), profile)
    kept = parsed.filter(F.col("record_type").isin(*HTTP_TYPES) | F.col("counts").isNotNull())
    placed = T.map_rows(build_docs(kept, prefix, detector), binary=True)
    # Of the new rows alone: the first of each key, with its part.
    new = checkpointed(arrange_rows(placed, None, tables.num_partitions))
    known = []
    for table in (T.DATA, T.URI, T.BINARY, T.COUNTS):
        keys = checkpointed(new.filter(F.col("table") == table).select("key", "part"))
        known.append(matches(tables, table, keys).select(F.lit(table).alias("table"), "key", "part"))
    seen = checkpointed(reduce(DataFrame.unionByName, known))
    rows = new.join(seen, ["table", "part", "key"], "left_anti").repartitionById(tables.num_partitions, F.col("part"))
    name = f"_added-{uuid.uuid4().hex}"
    save_rows(T.key_sorted(rows).select("table", "part", "key", "value"), f"{output}/{name}")
    facts = before | {"added": before.get("added", {}) | {name: written_parts(spark, f"{output}/{name}")}}
    if read_facts(spark, f"{output}/{MANIFEST}") != before:
        drop_scratch(spark, f"{output}/{name}")
        raise RuntimeError(f"{output} was changed while rows were added to it")
    write_facts(spark, f"{output}/{MANIFEST}", facts)
    return _generator_counters(open_tables(spark, output))


def merge_batches(
    spark: SparkSession, inputs: Sequence[str], output: str, mode: str = "keep_all", hot_rows: int = 100_000
) -> DataFrame:
    """Merge separately built tables, part by part; returns (counter, value).

    Ties keep the order of ``inputs``. Types are those in the footers of all files. Parts of
    many times ``hot_rows`` rows are written as several files, in key order.
    """
    T.check_mode(mode)
    opened = [open_tables(spark, path) for path in inputs]
    T.check_mergeable([t.types for t in opened], [t.num_partitions for t in opened])
    check_parts(*opened)
    ranked, by_input, ranks = [], [], 0
    for at, tables in enumerate(opened):
        rows = tables.rows.filter(F.col("table").isin(T.DATA, T.URI))
        ranked.append(rows.withColumn("ordinal", tables.rank + ranks))
        by_input.append(rows.withColumn("ordinal", F.lit(at)))
        ranks += tables.inputs
    read = T.merge_tables(by_input)
    large = T.large_parts(read, hot_rows) if mode == "keep_all" else []
    write_merged(T.merge_tables(ranked), output, opened[0].num_partitions, mode, ranks, hot_rows, large)

    # In this layout a split without rows is never written.
    splits = read.select("table", "part", "ordinal").distinct()
    return merge_counters(read, splits, open_tables(spark, output).rows)


def list_segments(spark: SparkSession, root: str) -> DataFrame:
    """Directories directly under a corpus root, as (segment); files are not listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    names = [n for n in names if not n.startswith(("_", "."))]
    return spark.createDataFrame([(n,) for n in names], "segment string")


class SegmentError(RuntimeError):
    """Some segments of a corpus could not be built; ``failed`` has the error of each."""

    def __init__(self, failed: dict[str, Exception]) -> None:
        self.failed = failed
        said = "; ".join(f"{name}: {str(error).splitlines()[0][:200]}" for name, error in failed.items())
        super().__init__(f"segments not built: {said}")


def build_corpus(
    spark: SparkSession,
    root: str,
    profile: str,
    prefix: str,
    output: str,
    num_partitions: int,
    lo: str | None = None,
    hi: str | None = None,
    files: str = "*/*",
    detector: Detector | None = None,
    at_once: int = 4,
) -> DataFrame:
    """Build the tables of each segment under ``root``; returns (segment, counter, value).

    Each chosen segment is a job of its own and takes ``num_partitions`` tasks; ``at_once``
    of them run side by side (fairly, where ``spark.scheduler.mode`` is FAIR), so that the
    last tasks of one don't leave the cluster idle. Segments are numbered over all under
    ``root``, chosen or not.

    A segment's tables go to a new folder, ``segment=segment-…/generation=…``, which counts
    from the moment when the next state of the corpus names it. Nothing that a reader may
    have open, or that another run writes, is touched; :func:`drop_superseded` deletes what
    no state needs. One segment that fails leaves what was there before and doesn't keep the
    others from being built; :class:`SegmentError` then tells which failed. ``files`` is the
    glob of archives inside a segment.
    """
    get_profile(profile)
    check_corpus(spark, output, num_partitions)
    chosen = [
        (r["segment"], r["name"])
        for r in segment_range(list_segments(spark, root), lo, hi)
        .select("segment", segment_name(F.col("ordinal")).alias("name"))
        .collect()
    ]
    if not chosen:
        raise ValueError(f"no segment of {root} lies between {lo!r} and {hi!r}")

    def build(segment: str, name: str) -> list[tuple[str, str, int]]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        generation = uuid.uuid4().hex
        folder = f"{segment_path(output, name)}/generation={generation}"
        try:
            glob = f"{root.rstrip('/')}/{segment}/{files}"
            counters = build_tables(spark, glob, profile, prefix, folder, num_partitions, detector)
            rows = [(name, r["counter"], r["value"]) for r in counters.collect()]
            commit_segment(spark, output, name, generation, num_partitions)
        except Exception:
            drop_scratch(spark, folder)
            raise
        return rows

    counted, failed = [], {}
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        running = {segment: pool.submit(inheritable_thread_target(spark)(build), segment, name) for segment, name in chosen}
        for segment, job in running.items():
            try:
                counted += job.result()
            except Exception as error:
                failed[segment] = error
    if failed:
        raise SegmentError(failed)
    # A few counters per segment.
    return spark.createDataFrame(counted, "segment string, counter string, value bigint")
