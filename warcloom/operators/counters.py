"""Job counters as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from warcloom.operators.records import HTTP_TYPES, URI_TYPE

# Counter names.
RECORD_COUNTERS = (
    "RECORDS",
    "SKIPPED_RECORDS",
    "SKIPPED_RECORDS_TOO_LARGE",
    "SKIPPED_RECORDS_TOO_SMALL",
    "BINARY_RECORDS",
    "GENERATED_DOCS",
    "MAPFILE_DATA_ENTRIES",
    "MAPFILE_URI_ENTRIES",
)
MERGE_COUNTERS = (
    "MAPFILES_TO_BE_MERGED",
    "MAPFILE_MERGES_FINISHED",
    "EMPTY_INPUT_MAPFILES",
    "MAPFILE_INPUTS_EXHAUSTED",
    "MAPFILE_ENTRIES_WRITTEN",
)


def _record_counts() -> dict[str, Column]:
    known = F.coalesce(F.col("record_type").isin(*HTTP_TYPES), F.lit(False))
    return {
        "RECORDS": F.count(F.lit(1)),
        "SKIPPED_RECORDS": F.count_if(~known),
        "SKIPPED_RECORDS_TOO_LARGE": F.lit(0).cast("bigint"),
        "SKIPPED_RECORDS_TOO_SMALL": F.lit(0).cast("bigint"),
        "BINARY_RECORDS": F.count_if(known & F.col("encoding").isNull()),
        "GENERATED_DOCS": F.count_if(known),
    }


def as_rows(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """One wide row of counts to (counter, value) rows."""
    pairs = F.array(
        *(F.struct(F.lit(n).alias("counter"), F.col(n).cast("bigint").alias("value")) for n in names)
    )
    return df.select(F.explode(pairs).alias("c")).select("c.counter", "c.value")


def counters(df: DataFrame) -> DataFrame:
    """All generator counters of records with ``encoding``, ``uuid`` and ``target_uri``.

    Records without a type count as skipped. Keys are counted once. Records are computed
    once as well: each gives a row for its kind, of which there are three, beside its keys.
    """
    known = F.coalesce(F.col("record_type").isin(*HTTP_TYPES), F.lit(False))
    row = lambda table, key: F.struct(F.lit(table).alias("table"), key.alias("key"))
    kind = F.when(~known, "skipped").when(F.col("encoding").isNull(), "binary").otherwise("text")
    keys = F.filter(
        F.array(
            row("kind", kind),
            F.when(known, row("data", F.col("uuid"))),
            F.when((F.col("record_type") == URI_TYPE) & F.col("target_uri").isNotNull(), row("uri", F.col("target_uri"))),
        ),
        lambda k: k.isNotNull(),
    )
    counted = df.select(F.explode(keys).alias("k")).groupBy("k.table", "k.key").agg(F.count(F.lit(1)).alias("n"))
    of = lambda *kinds: F.coalesce(F.sum(F.when((F.col("table") == "kind") & F.col("key").isin(*kinds), F.col("n"))), F.lit(0))
    totals = counted.agg(
        of("skipped", "binary", "text").alias("RECORDS"), of("skipped").alias("SKIPPED_RECORDS"),
        F.lit(0).alias("SKIPPED_RECORDS_TOO_LARGE"), F.lit(0).alias("SKIPPED_RECORDS_TOO_SMALL"),
        of("binary").alias("BINARY_RECORDS"), of("binary", "text").alias("GENERATED_DOCS"),
        F.count_if(F.col("table") == "data").alias("MAPFILE_DATA_ENTRIES"),
        F.count_if(F.col("table") == "uri").alias("MAPFILE_URI_ENTRIES"),
    )
    return as_rows(totals, RECORD_COUNTERS)


def observe_counters(df: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """Count records while they pass; read the result once an action has run.

    Spark adds up what its tasks report, so a stage that is run again may be
    counted twice. :func:`counters` is exact.
    """
    observation = Observation(name)
    counts = [c.alias(n) for n, c in _record_counts().items()]
    return df.observe(observation, *counts), observation


def merge_counters(
    rows: DataFrame, splits: DataFrame, written: DataFrame | None = None
) -> DataFrame:
    """Merge counters from input rows and input splits (table, part, ordinal).

    An input split without rows is an empty one; each (table, part) is one merge.
    ``written`` are the rows of the result where these are not all input rows.
    """
    per_split = rows.groupBy("table", "part", "ordinal").agg(F.count(F.lit(1)).alias("rows"))
    counted = splits.select("table", "part", "ordinal").distinct().join(
        per_split, ["table", "part", "ordinal"], "left"
    )
    per_merge = counted.groupBy("table", "part").agg(
        F.count(F.lit(1)).alias("inputs"),
        F.count_if(F.col("rows").isNull()).alias("empty"),
        F.count("rows").alias("exhausted"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    inputs = per_merge.agg(
        total("inputs").alias("MAPFILES_TO_BE_MERGED"),
        F.count(F.lit(1)).alias("MAPFILE_MERGES_FINISHED"),
        total("empty").alias("EMPTY_INPUT_MAPFILES"),
        total("exhausted").alias("MAPFILE_INPUTS_EXHAUSTED"),
    )
    output = (rows if written is None else written).agg(
        F.count(F.lit(1)).alias("MAPFILE_ENTRIES_WRITTEN")
    )
    return as_rows(inputs, MERGE_COUNTERS[:4]).unionByName(as_rows(output, MERGE_COUNTERS[4:]))


def split_counter(splits: DataFrame) -> DataFrame:
    """How many input splits a merge takes up, as the counter RECORDS."""
    return as_rows(splits.agg(F.count(F.lit(1)).alias("RECORDS")), ("RECORDS",))
