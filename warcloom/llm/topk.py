"""Exact top-k search by inner product, pruned by segment statistics.

A vector is cut into equal segments; each has a mean m and a deviation s. For segments
of length l the inner product of q and v is at most the sum of l (mq mv + sq sv), which
also bounds their distance from below: |q-v|^2 >= sum of l ((mq-mv)^2 + (sq-sv)^2).
The bound gets tighter with finer segments. Candidates pass the resolutions from coarse
to fine, at each of which those below a query's k-th best score so far are dropped;
what is left is computed exactly.

Queries and candidates meet in blocks: every block of candidates goes to every block of
queries once, and each such pair of blocks gives at most k rows a query. Memory of a
task is bounded by the two block sizes.

Vectors that are null or hold null or non-finite components take no part, nor do rows
without an id. Rows that repeat both id and vector are candidates each, though compared once;
as a query they are answered once. Rows that share an id with different vectors are
searched one by one, and never find rows of their own id.
Only vectors of the same length are compared. Equal scores go to the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from warcloom.llm.common import row_type

RESOLUTIONS = (1, 4, 16)
CHUNK = 2_048
FIRST_CHUNK = 128
RESULT = row_type(query_id="long", query_key="long", vec_id="long", copies="long", score="long")


def usable(vector: str | Column) -> Column:
    """Whether a vector exists and all its components are finite numbers."""
    column = F.col(vector) if isinstance(vector, str) else vector
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == math.inf))
    return column.isNotNull() & ~odd


def scaled(vector: str, scale: int) -> Column:
    """Components as whole numbers: the floor of ``scale`` times each, as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per segment its mean and deviation, times the root of its length.

    The inner product of two such rows bounds that of the vectors from above.
    """
    edges = np.linspace(0, vectors.shape[1], segments + 1).astype(int)
    columns = []
    for a, b in zip(edges[:-1], edges[1:]):
        part = vectors[:, a:b]
        columns += [part.mean(axis=1) * math.sqrt(b - a), part.std(axis=1) * math.sqrt(b - a)]
    return np.stack(columns, axis=1)


def block_top_k(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's place, candidate's place, score) of each query's k best in a block."""
    n, d = queries.shape
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, d)
    exact = np.float64 if largest < 2**53 else np.int64
    q, v = queries.astype(np.float64), vectors.astype(np.float64)
    q_exact, v_exact = queries.astype(exact), vectors.astype(exact)
    slack = 1e-9 * largest + 1e-6
    levels = [(statistics(q, s), statistics(v, s)) for s in RESOLUTIONS if s <= d]
    threshold = np.full(n, -np.inf)
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    start, size = 0, FIRST_CHUNK
    while start < len(ids):
        here = np.arange(start, min(start + size, len(ids)))
        start, size = start + size, CHUNK
        alive = query_ids[:, None] != ids[None, here]
        for q_stats, v_stats in levels:
            alive &= q_stats @ v_stats[here].T >= threshold[:, None] - slack
            left = alive.any(axis=0)
            if not left.all():
                here, alive = here[left], alive[:, left]
        scores = q_exact @ v_exact[here].T
        alive &= scores >= threshold[:, None]
        place, column = np.nonzero(alive)
        merged = (
            np.concatenate([best[0], place]),
            np.concatenate([best[1], here[column]]),
            np.concatenate([best[2], scores[place, column].astype(np.int64)]),
        )
        order = np.lexsort((ids[merged[1]], -merged[2], merged[0]))
        places = merged[0][order]
        first = np.searchsorted(places, np.arange(n))
        rank = np.arange(len(order)) - first[places]
        order = order[rank < k]
        best = tuple(m[order] for m in merged)
        last = order[rank[rank < k] == k - 1]
        threshold[merged[0][last]] = merged[2][last]
    return best


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table["vec_id"].to_numpy().astype(np.int64)
    values = table["ints"].combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, flat.reshape(len(ids), -1) if len(ids) else np.zeros((0, 0), np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, queries_per_block: int = 1_024, rows_per_block: int = 16_384) -> DataFrame:
    """The k rows of ``vectors`` with the largest inner product with each query.

    Both have ``vec_id`` (long) and ``ints`` (array of long, see ``scaled``). Returns
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.
    """

    def prepared(df: DataFrame) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("ints"))
        rows = rows.filter("vec_id IS NOT NULL AND ints IS NOT NULL")
        return rows.groupBy("vec_id", "ints").agg(F.count("*").alias("copies"))

    queries, vectors = prepared(queries), prepared(vectors)
    key = F.xxhash64("vec_id", "ints")
    query_blocks = max(1, math.ceil(queries.count() / queries_per_block))
    row_blocks = max(1, math.ceil(vectors.count() / rows_per_block))
    blocks = ["length", "query_block", "row_block"]
    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = queries.select(
        "*",
        key.alias("query_key"),
        F.size("ints").alias("length"),
        F.pmod(key, F.lit(query_blocks)).alias("query_block"),
        numbers(row_blocks).alias("row_block"),
    )
    right = vectors.select(
        "*",
        F.size("ints").alias("length"),
        F.pmod(key, F.lit(row_blocks)).alias("row_block"),
        numbers(query_blocks).alias("query_block"),
    )

    def meet(some_queries: pa.Table, some_rows: pa.Table) -> pa.Table:
        query_ids, q = _matrix(some_queries)
        ids, v = _matrix(some_rows)
        if len(query_ids) and len(ids):
            place, found, score = block_top_k(query_ids, q, ids, v, k)
        else:
            place = found = score = np.zeros(0, np.int64)
        keys = some_queries["query_key"].to_numpy().astype(np.int64)
        copies = some_rows["copies"].to_numpy().astype(np.int64)
        columns = (query_ids[place], keys[place], ids[found], copies[found], score)
        return pa.table(dict(zip(RESULT.names, columns)))

    met = left.groupBy(*blocks).cogroup(right.groupBy(*blocks)).applyInArrow(meet, RESULT)
    # Of a row that is repeated, as many as can have a rank.
    met = met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int"))))
    ranking = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
