"""Writing keyed tables."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.functions.identity import partition_id
from warcloom.operators import tables as T
from warcloom.sources.tables import (
    VERSIONS,
    folder_names,
    hadoop_path,
    latest_version,
    write_facts,
    write_manifest,
    written_parts,
)

CODEC = "zstd"


def save_rows(rows: DataFrame, output: str, *folders: str) -> None:
    """Write arranged rows below a folder for each table and part, or other columns."""
    # Bloom filters of a size that follows the keys: where parts of many segments or merged
    # inputs are asked for a key, those without it aren't read.
    (
        rows.write.partitionBy(*(folders or ("table", "part")))
        .option("compression", CODEC)
        .option("parquet.bloom.filter.enabled#key", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(output)
    )


def arrange_rows(
    rows: DataFrame, profile: DataFrame | None, num_partitions: int, segments: Sequence[str] = ()
) -> DataFrame:
    """(table, key, value) rows as they are written: placed, first per key, key-sorted.

    One shuffle moves each row to the task that writes its part; the same order
    serves to find first rows and to write. Repeats of a profile's hot keys are
    dropped before it; rows read to build tables come without most repeats. With ``segments``, rows carry a ``segment`` and each segment gets
    tables, and tasks, of its own.
    """
    scope = ("segment",) if segments else ()
    slim = rows if profile is None else T.drop_hot_repeats(rows, profile, scope)
    placed = slim.withColumn("part", partition_id(F.col("key"), num_partitions))
    task, tasks = F.col("part"), num_partitions
    if segments:
        slots = F.create_map(*(F.lit(x) for pair in enumerate(segments) for x in pair[::-1]))
        task = F.element_at(slots, F.col("segment")) * num_partitions + task
        tasks *= len(segments)
    moved = placed.repartitionById(tasks, task)
    first = T.first_per_key(moved, by=(*scope, "table", "part", "key"))
    return T.key_sorted(first, scope=scope).select(*scope, "table", "part", "key", "value")


def segment_path(output: str, segment: str) -> str:
    """Where a segment's own tables lie; they can be opened by themselves."""
    return f"{output}/segment={segment}"


def check_corpus(spark: SparkSession, output: str, num_partitions: int) -> None:
    """Raise if a corpus has segments with another partition count, in which keys lie elsewhere."""
    _, facts = latest_version(spark, output)
    if facts and facts["num_partitions"] != num_partitions:
        raise ValueError(
            f"{output} has {len(facts['segments'])} segments of {facts['num_partitions']} partitions; "
            f"{num_partitions} would hide their keys"
        )


#: Commits of one process take turns; those of others are told by the number of the state.
_COMMIT = threading.Lock()


def commit_segment(spark: SparkSession, output: str, segment: str, generation: str, num_partitions: int) -> None:
    """Make written tables those of a segment: a new state of the corpus, which names them.

    States are numbered files that are never changed. When another run has stored the next
    one first, its state is taken up and the number after it is tried.
    """
    parts = written_parts(spark, f"{segment_path(output, segment)}/generation={generation}")
    with _COMMIT:
        while True:
            check_corpus(spark, output, num_partitions)
            number, facts = latest_version(spark, output)
            segments = (facts or {}).get("segments", {}) | {segment: {"generation": generation, "parts": parts}}
            state = {
                "num_partitions": num_partitions, "order": "segment", "segments": segments,
                "inputs": max(int(s.rsplit("-", 1)[1]) for s in segments) + 1,
            }
            folder, fs = hadoop_path(spark, f"{output}/{VERSIONS}")
            fs.mkdirs(folder)
            if write_facts(spark, f"{output}/{VERSIONS}/{number + 1:08d}.json", state, replace=False):
                return


def drop_superseded(spark: SparkSession, output: str, hours: float = 24.0) -> list[str]:
    """Delete tables of segments that the corpus's last state doesn't name; gives their folders.

    What is younger than ``hours`` stays: a run may be writing it, and readers that opened
    an earlier state may be reading it.
    """
    _, facts = latest_version(spark, output)
    latest = spark._jvm.System.currentTimeMillis() - int(hours * 3_600_000)
    dropped = []
    for name in (n for n in folder_names(spark, output) if n.startswith("segment=")):
        for generation in (g for g in folder_names(spark, f"{output}/{name}") if g.startswith("generation=")):
            folder = f"{output}/{name}/{generation}"
            at, fs = hadoop_path(spark, folder)
            live = ((facts or {}).get("segments", {}).get(name[8:]) or {}).get("generation")
            if generation[11:] != live and fs.getFileStatus(at).getModificationTime() <= latest:
                fs.delete(at, True)
                dropped.append(folder)
    return dropped


def write_rows(
    rows: DataFrame,
    profile: DataFrame | None,
    output: str,
    num_partitions: int,
    segments: Sequence[str] = (),
) -> None:
    """Write rows as ``table=…/part=…/`` files, under ``segment=…/`` if there are any.

    Parts without rows are not written. The partition count goes into a manifest,
    as a key's part can only be told by it.
    """
    spark = rows.sparkSession
    ordered = arrange_rows(rows, profile, num_partitions, segments)
    if not segments:
        save_rows(ordered, output, "table", "part")
        write_manifest(spark, output, num_partitions=num_partitions)
        return
    save_rows(ordered, output, "segment", "table", "part")
    last = max(int(s.rsplit("-", 1)[1]) for s in segments)
    facts = {"num_partitions": num_partitions, "order": "segment", "inputs": last + 1}
    write_manifest(spark, output, **facts)
    for segment in segments:
        write_manifest(spark, segment_path(output, segment), num_partitions=num_partitions)


def write_tables(
    docs: DataFrame, output: str, num_partitions: int, segments: Sequence[str] = ()
) -> None:
    """Write the data and URI tables of documents, once or for each of their segments."""
    rows = T.map_rows(docs, ("segment",) if segments else ())
    profile = T.key_profile(rows.drop("value"), ("segment",) if segments else ())
    write_rows(rows, profile, output, num_partitions, segments)


def _cuts(spark: SparkSession, output: str, large: Sequence[tuple[str, int, int]]) -> dict:
    """For each part that was cut, its files in order with their first keys."""
    if not large:
        return {}
    folders = [f"{output}/table={table}/part={part}" for table, part, _ in large]
    rows = spark.read.schema("key string, table string, part int").option("basePath", output).parquet(*folders)
    # One row a file; keys alone are read.
    first = rows.groupBy("table", "part", "_metadata.file_name").agg(F.min("key").alias("first")).collect()
    found: dict[str, dict[str, list[list[str]]]] = {}
    for r in sorted(first, key=lambda r: r["file_name"]):
        found.setdefault(r["table"], {}).setdefault(str(r["part"]), []).append([r["file_name"], r["first"]])
    return found


def write_merged(
    rows: DataFrame,
    output: str,
    num_partitions: int,
    mode: str = "keep_all",
    inputs: int = 1,
    hot_rows: int = 100_000,
    large: Sequence[tuple[str, int, int]] | None = None,
) -> None:
    """Write merged rows (with ``ordinal``) as new tables; inputs are left alone.

    Rows keep their part, so keys are not hashed again. ``inputs`` is how many ordinals
    there can be. Parts that are cut, ``large`` or found here, are named in the manifest
    with their files, so that a look-up opens those alone that a key can be in.
    """
    spark = rows.sparkSession
    if large is None and mode == "keep_all" and inputs >= hot_rows:
        large = T.large_parts(rows, hot_rows)
    save_rows(T.arrange_merged(rows, num_partitions, mode, hot_rows, inputs, list(large or [])), output, "table", "part")
    facts = {"num_partitions": num_partitions, "order": "ordinal", "inputs": inputs}
    cuts = _cuts(spark, output, large or []) if mode == "keep_all" else {}
    write_manifest(spark, output, **facts, **({"cuts": cuts} if cuts else {}))
