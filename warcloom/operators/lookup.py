"""Finding documents by UUID, by name or by URI."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.functions.identity import SPLIT_NAME_FORMAT, doc_uuid, partition_id
from warcloom.operators.tables import DATA, URI
from warcloom.scratch import checkpointed, scratch_path
from warcloom.sources.tables import Tables, open_tables

# Up to this many keys are put into the query itself, so that only their row groups
# are read. More keys are joined; only their parts are read then as well.
LITERAL_KEYS = 256
# Parquet gets longer lists than this as one range, from the smallest key to the largest.
PUSHED_KEYS = 10
# Keys go to the tasks that read the table, in slices of so many bytes (and some for each
# row) at most; a slice is what is broadcast.
SLICE_BYTES = 8 << 20
ROW_BYTES = 64
# A part is read once for each slice of its keys. Where these are more than so many slices,
# most of its rows have a key, and rows and keys meet by a shuffle instead.
MAX_PIECES = 4


def _opened(spark: SparkSession, tables: Tables | str) -> Tables:
    return tables if isinstance(tables, Tables) else open_tables(spark, tables)


def _wanted(keys: DataFrame, by: str, prefix: str | None) -> DataFrame:
    if by == "uuid" or by == "uri":
        return keys.select("key")
    if by == "name":
        if prefix is None:
            raise ValueError("lookup by name needs a prefix")
        return keys.select(doc_uuid(prefix, F.col("name")).alias("key"))
    raise ValueError(f"unknown lookup {by!r}; use uuid, name or uri")


def _any_of(keys: list[str]) -> Column:
    """A filter on keys in groups of neighbours, each of which is pushed down as a list."""
    keys = sorted(keys)
    groups = [keys[i : i + PUSHED_KEYS] for i in range(0, len(keys), PUSHED_KEYS)]
    return reduce(Column.__or__, [F.col("key").isin(g) for g in groups], F.lit(False))


def _slices(sizes: list[tuple[int, int, int]], limit: int) -> list[tuple[list[int], int, int]]:
    """Parts gathered to slices, from (part, keys, bytes): (parts, which of how many).

    Neighbouring parts share a slice as long as their keys fit. Keys of one part that don't
    are cut by a hash.
    """
    slices, parts, held = [], [], 0
    for part, n, size in sorted(sizes):
        weight = size + n * ROW_BYTES
        if weight > limit:
            pieces = min(n, -(-2 * weight // limit))
            slices += [([part], k, pieces) for k in range(pieces)]
            continue
        if parts and held + weight > limit:
            slices.append((parts, 0, 1))
            parts, held = [], 0
        parts, held = [*parts, part], held + weight
    return [*slices, (parts, 0, 1)] if parts else slices


def matches(
    tables: Tables, table: str, wanted: DataFrame, *columns: str, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """The rows of a table with any of the keys in ``wanted``: key, part and ``columns``.

    ``wanted`` is a written table of distinct ``key``, ``part``. Keys are brought to the
    rows, never rows to the keys: of the table, only rows that have a key leave the task that
    reads them. That takes a broadcast of some MB; for more keys, one for each slice of
    them, whose rows go to the scratch folder, so that memory doesn't grow with the keys.
    Parts whose keys alone are more than ``MAX_PIECES`` slices are read once, and meet their
    keys in one sorted join.
    """
    few = wanted.limit(LITERAL_KEYS + 1).collect()
    columns = ("key", "part", *columns)
    if len(few) <= LITERAL_KEYS:
        keys = [r["key"] for r in few]
        rows = tables.part_rows(table, {r["part"] for r in few}, keys).filter(_any_of(keys))
        return rows.join(F.broadcast(wanted), ["key", "part"]).select(*columns)
    # As many rows as the table has parts, at most.
    sizes = wanted.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.octet_length("key")).alias("bytes")).collect()
    slices = _slices([(r["part"], r["n"], r["bytes"]) for r in sizes], slice_bytes)
    many = [parts[0] for parts, k, pieces in slices if pieces > MAX_PIECES and k == 0]
    slices = [s for s in slices if s[2] <= MAX_PIECES]
    hits = []
    for parts, k, pieces in slices:
        keys = wanted if len(slices) == 1 and not many else wanted.filter(F.col("part").isin(parts))
        if pieces > 1:
            keys = keys.filter(F.pmod(F.xxhash64("key"), F.lit(pieces)) == k)
        rows = tables.part_rows(table, parts)
        hits.append(rows.join(F.broadcast(keys), ["key", "part"]).select(*columns))
    if len(hits) > 1:
        path = scratch_path(wanted.sparkSession, "hits")
        for rows in hits:
            rows.write.mode("append").parquet(path)
        hits = [wanted.sparkSession.read.schema(hits[0].schema).parquet(path)]
    if many:
        keys = wanted.filter(F.col("part").isin(many)).hint("merge")
        hits.append(tables.part_rows(table, many).join(keys, ["key", "part"]).select(*columns))
    return reduce(DataFrame.unionByName, hits)


def lookup(
    spark: SparkSession,
    tables: Tables | str,
    keys: DataFrame,
    by: str = "uuid",
    prefix: str | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Look up each distinct key: (key, part, value, found).

    ``keys`` has a column ``key``, or ``name`` when looking up by name. A key's
    part is computed, not searched. Of repeated keys in a merged table the first
    counts. Missing keys stay, with ``found`` false.

    The keys are computed once, to the scratch folder. Their parts are read by path, as long
    as these aren't very many, and rows meet them where they are read (:func:`matches`), in slices of ``slice_bytes``.
    """
    tables = _opened(spark, tables)
    table = URI if by == "uri" else DATA
    wanted = _wanted(keys, by, prefix).filter(F.col("key").isNotNull()).distinct()
    wanted = checkpointed(wanted.withColumn("part", partition_id(F.col("key"), tables.num_partitions)))
    order = () if tables.order is None else (tables.order,)
    hits = matches(tables, table, wanted, "value", *order, slice_bytes=slice_bytes)
    if order:
        hits = hits.groupBy("key", "part").agg(F.min_by("value", tables.rank).alias("value"))
    hits = hits.withColumn("found", F.lit(True))
    return wanted.join(hits, ["key", "part"], "left").select(
        "key", "part", "value", F.coalesce("found", F.lit(False)).alias("found")
    )


def missing_keys(
    spark: SparkSession, tables: Tables | str, keys: DataFrame, by: str = "uuid",
    prefix: str | None = None,
) -> DataFrame:
    """The keys that are not in the table, with the part they would be in."""
    result = lookup(spark, tables, keys, by, prefix)
    return result.filter(~F.col("found")).select("key", "part")


def documents_by_uri(spark: SparkSession, tables: Tables | str, uris: DataFrame) -> DataFrame:
    """URI to document in two steps: (uri, uuid, value, found).

    The first step is computed once. URIs that are not found take no part in the second.
    """
    tables = _opened(spark, tables)
    named = checkpointed(
        lookup(spark, tables, uris.select(F.col("uri").alias("key")), by="uri").select(
            F.col("key").alias("uri"), F.col("value").alias("uuid")
        )
    )
    known = named.filter(F.col("uuid").isNotNull())
    docs = lookup(spark, tables, known.select(F.col("uuid").alias("key")))
    found = known.join(docs.select(F.col("key").alias("uuid"), "value", "found"), "uuid")
    nothing = [F.lit(None).cast("string").alias("value"), F.lit(False).alias("found")]
    unknown = named.filter(F.col("uuid").isNull()).select("uri", "uuid", *nothing)
    return found.select("uri", "uuid", "value", "found").unionByName(unknown)


def render(df: DataFrame, mode: str = "keyed", table: str = DATA, root: str = "") -> DataFrame:
    """Looked-up rows for display: ``record``, ``keyed`` or ``verbose``."""
    if mode == "record":
        return df.select("value")
    if mode == "keyed":
        return df.select("key", "value")
    if mode == "verbose":
        path = F.format_string(f"%s/{SPLIT_NAME_FORMAT}", F.lit(root), F.lit(table), F.col("part"))
        return df.select("key", F.format_string("%05d", "part").alias("part"), path.alias("split_path"), "value")
    raise ValueError(f"unknown render mode {mode!r}; use record, keyed or verbose")
