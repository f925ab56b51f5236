"""Writing records back as archives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.functions.expr import raw_text
from warcloom.functions.headers import CRLF
from warcloom.operators.records import to_warc_text
from warcloom.sources.warc import read_warc


def write_warc(
    df: DataFrame, path: str, profile: str = "commoncrawl", compression: str = "gzip"
) -> DataFrame:
    """Write parsed records as archive files and return (file, records).

    Spark's text sink writes the bytes as they are, each record followed by the
    archive's own separator, and commits files only once their task is done.
    """
    text = to_warc_text(df).select(raw_text(F.col("warc_text")).alias("value"))
    text.write.option("lineSep", CRLF * 2).option("compression", compression).text(path)
    written = read_warc(df.sparkSession, path, profile, content=False)
    return written.groupBy(F.col("source_file").alias("file")).agg(
        F.count(F.lit(1)).alias("records")
    )
