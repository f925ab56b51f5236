"""Reading tables kept as Hadoop map files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TEXT = "org.apache.hadoop.io.Text"


def read_map_files(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) rows of map files, read by Hadoop's own classes.

    ``path`` is a directory of splits, one split, or a glob of either. Only the
    data files are read; the index beside each holds offsets. Rows are made by the JVM:
    Hadoop's text is a bean of its bytes and their number.
    """
    jvm = spark._jvm
    text = jvm.java.lang.Class.forName(_TEXT)
    pairs = spark._jsc.sequenceFile(f"{path.rstrip('/')}/{{data,*/data}}", text, text)
    bean = jvm.org.apache.spark.sql.Encoders.bean(text)
    both = jvm.org.apache.spark.sql.Encoders.tuple(bean, bean)
    rows = DataFrame(spark._jsparkSession.createDataset(pairs.rdd(), both).toDF(), spark)
    # The bytes are those of a buffer that may be longer than the text.
    held = lambda c: F.substring(F.col(f"{c}.bytes"), F.lit(1), F.col(f"{c}.length")).cast("string")
    return rows.select(held("_1").alias("key"), held("_2").alias("value"))
