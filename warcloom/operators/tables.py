"""Keyed tables: placing rows in partitions, first value per key, merging."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warcloom.functions.identity import partition_id
from warcloom.operators.records import URI_TYPE
from warcloom.scratch import checkpointed

# The names of the two tables.
DATA = "data"
URI = "uri"
# A side table of the records whose body had no text encoding. Its row count is
# exact even when tasks are run again, which a job counter is not.
BINARY = "binary"
# A side table of how many records and documents each piece of the input had.
COUNTS = "counts"

ORDER = ("source_file", "record_seq")

# A key held by at least HOT_ROWS rows is treated apart. The HOT_KEYS commonest
# of them fit in a broadcast; all others go the common way.
HOT_ROWS = 1_000
HOT_KEYS = 50_000

# Parts are cut where they have so many times the rows that a file of them is to have.
CUT_FROM = 4
# Files are as small as asked for up to this many; of more, each has FILE_ROWS rows or there
# are CUT_FROM for each part, so that tasks and the manifest don't grow with the rows asked for.
SMALL_FILES = 512
FILE_ROWS = 100_000
MERGED = ("table", "part", "key", "value", "ordinal")


def _row(table: str, key: Column, value: Column) -> Column:
    return F.struct(F.lit(table).alias("table"), key.alias("key"), value.alias("value"))


def map_rows(docs: DataFrame, scope: Sequence[str] = (), binary: bool = False) -> DataFrame:
    """Documents to rows (table, key, value): uuid to JSON, and URI to uuid.

    Both come out of one pass over the documents. The URI row of a document is
    made before repeats are dropped, so no URI is lost with a repeated uuid.
    With ``binary``, documents without a text encoding are listed as well. Documents
    that were read to build tables leave out rows marked as repeats, and their counts
    are rows too.
    """
    has_uri = F.col("record_type") == URI_TYPE
    is_document, new_id = F.lit(True), F.lit(True)
    if marked := "counts" in docs.columns:
        is_document, new_id = F.col("counts").isNull(), F.col("counts").isNull() & ~F.col("id_repeat")
        has_uri = has_uri & ~F.col("uri_repeat")
    rows = [
        _row(DATA, F.when(new_id, F.col("uuid")), F.col("json")),
        _row(URI, F.when(has_uri, F.col("target_uri")), F.col("uuid")),
    ]
    place = F.concat_ws("#", F.col("source_file"), F.col("record_seq"))
    if binary:
        rows.append(_row(BINARY, F.when(is_document & F.col("encoding").isNull(), place), F.col("uuid")))
    if marked:
        rows.append(_row(COUNTS, F.when(~is_document, place), F.col("counts")))
    kept = F.filter(F.array(*rows), lambda r: r["key"].isNotNull())
    return docs.select(*scope, *ORDER, F.explode(kept).alias("row")).select(
        *scope, "row.table", "row.key", "row.value", *ORDER
    )


def key_profile(rows: DataFrame, scope: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Row counts per table, with each hot key counted by itself.

    ``digest`` is null for the rows of all other keys together; ``first_at`` is
    the place of the first row. Grouping is by digest, so long keys do not
    travel, and counts are formed before the shuffle.
    """
    places = F.struct(*(F.col(c) for c in ORDER))
    by_key = rows.groupBy(*scope, "table", F.unhex(F.md5(F.col("key"))).alias("digest")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(places).alias("first_at")
    )
    hot = F.when(F.col("rows") >= hot_rows, F.col("digest"))
    profile = by_key.groupBy(*scope, "table", hot.alias("digest")).agg(
        F.sum("rows").alias("rows"), F.min("first_at").alias("first_at")
    )
    return checkpointed(profile)


def hot_keys(profile: DataFrame) -> DataFrame:
    """The hottest keys of a profile, few enough to broadcast."""
    return profile.filter("digest IS NOT NULL").orderBy(F.desc("rows")).limit(HOT_KEYS)


def drop_hot_repeats(rows: DataFrame, profile: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Drop the repeats of a profile's hot keys before any row is moved.

    The profile knows the place of each hot key's first row, so a repeat is told
    on its own. All other keys are left for :func:`first_per_key`.
    """
    if profile.filter("digest IS NOT NULL").isEmpty():
        return rows
    on = [F.col(f"r.{c}") == F.col(f"h.{c}") for c in (*scope, "table")]
    on.append(F.unhex(F.md5(F.col("r.key"))) == F.col("h.digest"))
    place = F.struct(*(F.col(f"r.{c}").alias(c) for c in ORDER))
    hot = F.broadcast(hot_keys(profile).alias("h"))
    first = F.col("h.digest").isNull() | (place == F.col("h.first_at"))
    return rows.alias("r").join(hot, on, "left").filter(first).select("r.*")


def first_per_key(
    df: DataFrame, by: Sequence[str] = ("table", "key"), order: Sequence[str] = ORDER
) -> DataFrame:
    """Keep each key's first row in ``order``.

    Unless the rows are already placed, Spark keeps one row per key and task
    before the shuffle, so a hot key arrives as a few rows.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def partition_table(df: DataFrame, num_partitions: int) -> DataFrame:
    """Add ``part`` and move each row to the Spark partition of that number."""
    placed = df.withColumn("part", partition_id(F.col("key"), num_partitions))
    return placed.repartitionById(num_partitions, F.col("part"))


def key_sorted(df: DataFrame, *ties: str, scope: Sequence[str] = ()) -> DataFrame:
    """Sort within partitions, ready for one key-ordered file per table and part.

    Folder names are made non-null first; for nullable ones the writer would
    sort again, by folder alone, and lose the order of keys.
    """
    named = {c: F.coalesce(F.col(c), F.lit("")) for c in (*scope, "table")}
    return df.withColumns(named).sortWithinPartitions(*scope, "table", "part", "key", *ties)


def check_mergeable(types: Sequence[Sequence[tuple[str, str]]], num_partitions: Sequence[int]) -> None:
    """Raise unless all inputs have key and value, of the same types, and as many partitions."""
    for shape in types:
        if missing := {"key", "value"} - {name for name, _ in shape}:
            raise ValueError(f"tables cannot be merged: an input lacks {sorted(missing)}")
    shapes = {tuple(sorted(shape)) for shape in types}
    if len(shapes) > 1:
        raise ValueError(f"tables cannot be merged: key or value types differ: {sorted(shapes)}")
    if len(set(num_partitions)) > 1:
        raise ValueError(f"tables cannot be merged: partition counts differ: {sorted(set(num_partitions))}")


def merge_tables(dfs: Sequence[DataFrame], mode: str = "keep_all") -> DataFrame:
    """Rows of several tables with ``ordinal``, the place of their input.

    ``keep_all`` keeps every row, ties in input order; ``first_wins`` keeps each
    key's row of the first input that has it. Rows keep their ``part``. Inputs
    that have an ``ordinal`` already keep it.
    """
    check_mode(mode)
    numbered = [
        df.select(
            "table", "part", "key", "value",
            (F.col("ordinal") if "ordinal" in df.columns else F.lit(i)).alias("ordinal"),
        )
        for i, df in enumerate(dfs)
    ]
    rows = reduce(DataFrame.unionByName, numbered)
    if mode == "first_wins":
        rows = first_per_key(rows, by=("table", "part", "key"), order=("ordinal",))
    return rows


def check_mode(mode: str) -> None:
    """Raise on an unknown way of merging."""
    if mode not in ("keep_all", "first_wins"):
        raise ValueError(f"unknown merge mode {mode!r}; use keep_all or first_wins")


def _merge_hot_keys(rows: DataFrame, hot_rows: int) -> DataFrame:
    """The hottest keys of merged rows and the first input each is in.

    Reads keys only; few enough rows come out to broadcast.
    """
    counts = rows.groupBy("table", F.unhex(F.md5(F.col("key"))).alias("digest")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("ordinal").alias("first_ordinal")
    )
    hot = counts.filter(F.col("rows") >= hot_rows).orderBy(F.desc("rows")).limit(HOT_KEYS)
    return checkpointed(hot)


def large_parts(rows: DataFrame, hot_rows: int) -> list[tuple[str, int, int]]:
    """(table, part, rows) of the parts to be cut; of written tables, footers alone are read."""
    counts = rows.groupBy("table", "part").agg(F.count(F.lit(1)).alias("rows"))
    return [tuple(r) for r in counts.filter(F.col("rows") > CUT_FROM * hot_rows).collect()]


def cut_files(large: list[tuple[str, int, int]], hot_rows: int) -> int:
    """How many ranges of some ``hot_rows`` rows the large parts are cut into, all together."""
    ranges = lambda n, size: -(-3 * n // (2 * size))
    asked = sum(ranges(n, hot_rows) for *_, n in large)
    few = sum(ranges(n, FILE_ROWS) for *_, n in large)
    return min(asked, max(SMALL_FILES, CUT_FROM * len(large), few))


def arrange_merged(
    rows: DataFrame,
    num_partitions: int,
    mode: str = "keep_all",
    hot_rows: int = 100_000,
    inputs: int | None = None,
    large: list[tuple[str, int, int]] | None = None,
) -> DataFrame:
    """Merged rows as they are written: sorted by key and input, usually a part to a task.

    Where the first input wins, and a key may be in ``hot_rows`` inputs or more, rows of hot
    keys that can't win are dropped before anything is moved. Where all rows are kept,
    ``large`` parts (:func:`large_parts`) are cut by ranges of key and input into some
    ``hot_rows`` rows each, or more where that would be very many files (:func:`cut_files`):
    their files, by name, are one order of keys, even where one key fills several. With
    fewer ``inputs`` than ``hot_rows`` parts aren't counted here.
    """
    check_mode(mode)
    counted = inputs is None or inputs >= hot_rows
    if mode == "first_wins":
        hot = _merge_hot_keys(rows, hot_rows) if counted else None
        if hot is not None and not hot.isEmpty():
            marked = F.broadcast(hot.select("table", "digest", "first_ordinal"))
            rows = rows.withColumn("digest", F.unhex(F.md5(F.col("key")))).join(marked, ["table", "digest"], "left")
            rows = rows.filter(F.col("first_ordinal").isNull() | (F.col("ordinal") == F.col("first_ordinal")))
        moved = rows.repartitionById(num_partitions, F.col("part")).select(*MERGED)
        return key_sorted(first_per_key(moved, by=("table", "part", "key"), order=("ordinal",)), "ordinal")
    if large is None:
        large = large_parts(rows, hot_rows) if counted else []
    if not large:
        return key_sorted(rows.repartitionById(num_partitions, F.col("part")).select(*MERGED), "ordinal")
    # A few bytes for each part that is cut.
    cut = F.broadcast(rows.sparkSession.createDataFrame([p[:2] for p in large], "table string, part int"))
    files = cut_files(large, hot_rows)
    tie = F.xxhash64("value")
    ranges = rows.join(cut, ["table", "part"], "left_semi").repartitionByRange(files, *MERGED[:3], "ordinal", tie)
    whole = rows.join(cut, ["table", "part"], "left_anti").repartitionById(num_partitions, F.col("part"))
    together = whole.select(*MERGED).unionByName(ranges.select(*MERGED)).withColumn("tie", F.xxhash64("value"))
    return key_sorted(together, "ordinal", "tie").drop("tie")
