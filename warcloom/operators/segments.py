"""Segments of a corpus: numbering and choosing a range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def segment_range(segments: DataFrame, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Segments from ``lo`` to ``hi``, both included, with their ordinal.

    Ordinals count all segments in name order, chosen or not. One row per
    segment name goes in, so the ranking is small.
    """
    ranked = segments.select("segment").distinct().withColumn(
        "ordinal", F.row_number().over(Window.orderBy("segment")) - 1
    )
    if lo:
        ranked = ranked.filter(F.col("segment") >= lo)
    if hi:
        ranked = ranked.filter(F.col("segment") <= hi)
    return ranked
