"""Sharing a large plain file out between tasks.

Where a record starts is only known from the record before it, so a task that
starts inside a file has to guess: it takes the first line that looks like a
record start. Each task reports where its guess led, the reports of a file are
lined up, and a range whose guess turned out to lie inside a body is looked at
again from the right place. Only headers are read for this.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.profiles import Profile
from warcloom.scratch import checkpointed
from warcloom.sources.files import _CODECS, _UNREADABLE, open_file
from warcloom.sources.framing import SeekingReader, frames

PIECE_COLUMNS = ("path", "length", "start", "stop", "first_seq")

# One row per range: where its first record starts (null: none), how many it
# has, and what follows its last record: a record start (at_record) or the
# border of a later range from which that range's own guess holds.
_REPORT_SCHEMA = (
    "path string, length bigint, begin bigint, end bigint, "
    "entry bigint, records bigint, follows bigint, at_record boolean"
)
_REPORT_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("length", pa.int64()),
        ("begin", pa.int64()),
        ("end", pa.int64()),
        ("entry", pa.int64()),
        ("records", pa.int64()),
        ("follows", pa.int64()),
        ("at_record", pa.bool_()),
    ]
)
_PLAN_SCHEMA = (
    "path string, length bigint, begin bigint, end bigint, "
    "start bigint, first_seq bigint, certain boolean"
)
# A task takes ranges of so many bytes, if there are enough for all cores.
TASK_BYTES = 64 << 20
CORE_TASKS = 4


def _follow(reader: SeekingReader, version: bytes, size: int, width: int) -> tuple[int, bool]:
    """What comes after the last record of a range."""
    border = (reader.tell() // width + 1) * width
    while (start := reader.tell()) < border:
        line = reader.line(keep=len(version))
        if line is None:
            return size, False
        if line.startswith(version):
            return start, True
    return border, False


def _report(profile: Profile, width: int):
    """Task body: ranges (with a known entry, or null to guess) to reports."""
    version = profile.version.encode()

    def report(piece: dict) -> dict:
        begin, end, size = piece["begin"], piece["end"], piece["length"]
        with open_file(piece["path"]) as file:
            known = piece["entry"]
            if known is None and begin > 0:
                reader = SeekingReader(file, begin - 1, size)
                reader.line(keep=0)
            else:
                reader = SeekingReader(file, known or 0, size)
            records = sum(1 for _ in frames(reader, version, lambda kind: False, end))
            follows, at_record = None, False
            if reader.ended:
                follows = size
            elif reader.first_start is not None:
                follows, at_record = _follow(reader, version, size, width)
        return piece | {
            "entry": reader.first_start,
            "records": records,
            "follows": follows,
            "at_record": at_record,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [report(piece) for piece in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=_REPORT_ARROW)

    return run


def _line_up(reports: pd.DataFrame) -> pd.DataFrame:
    """The ranges of one file that hold record starts, in order.

    A range whose guess was wrong is marked uncertain, with the place it should
    have started from. What follows it is then provisional: going by the wrong
    guess's end is mostly right, as guesses soon meet the true records, and lets
    several wrong ranges be looked at in one go. Works on one short row per
    range, never on records.
    """
    position, at_record, seq, rows = 0, False, 0, []
    for r in reports.sort_values("begin").itertuples():
        if position >= r.end:
            continue
        entry = None if pd.isna(r.entry) else int(r.entry)
        wrong = at_record and entry != position
        if entry is not None or wrong:
            start = position if wrong else entry
            rows.append((r.path, r.length, r.begin, r.end, start, seq, not wrong))
            seq += int(r.records)
            if pd.isna(r.follows):
                position, at_record = int(r.end), False
            else:
                position, at_record = int(r.follows), bool(r.at_record)
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _PLAN_SCHEMA.split(", ")])


def split_files(
    spark: SparkSession, files: DataFrame, profile: Profile, width: int
) -> DataFrame:
    """Pieces (path, length, start, stop, first_seq) that cover all files exactly once."""
    extensions = "|".join(e.removeprefix(".") for e in (*_CODECS, *_UNREADABLE))
    splittable = ~F.col("path").rlike(rf"\.({extensions})$") & (F.col("length") > width)
    whole = files.filter(~splittable).select(
        "path",
        "length",
        F.lit(0).cast("bigint").alias("start"),
        F.lit(None).cast("bigint").alias("stop"),
        F.lit(0).cast("bigint").alias("first_seq"),
    )
    large = files.filter(splittable)
    found = large.agg(F.sum(F.ceil(F.col("length") / width)), F.sum("length")).first()
    if not found[0]:
        return whole
    tasks = min(int(found[0]), max(CORE_TASKS * spark.sparkContext.defaultParallelism, -(-found[1] // TASK_BYTES)))

    begin = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(width).cast("bigint")))
    ranges = large.select("path", "length", begin.alias("begin")).select(
        "*",
        F.least(F.col("begin") + width, F.col("length")).alias("end"),
        F.lit(None).cast("bigint").alias("entry"),
    )
    look = _report(profile, width)
    reports = checkpointed(ranges.repartition(tasks).mapInArrow(look, _REPORT_SCHEMA))
    while True:
        plan = checkpointed(reports.groupBy("path").applyInPandas(_line_up, _PLAN_SCHEMA))
        wrong = plan.filter(~F.col("certain"))
        if wrong.isEmpty():
            break
        again = wrong.select("path", "length", "begin", "end", F.col("start").alias("entry"))
        # Few short rows, but each stands for a range to be read.
        renewed = again.repartition(tasks, "path", "begin").mapInArrow(look, _REPORT_SCHEMA)
        reports = checkpointed(
            reports.join(wrong, ["path", "begin"], "left_anti")
            .select(*reports.columns)
            .unionByName(renewed)
        )
    pieces = plan.select("path", "length", "start", F.col("end").alias("stop"), "first_seq")
    return whole.unionByName(pieces.repartition(tasks))
