"""Writing tables as Hadoop map files, for readers of that format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.operators.tables import partition_table

# The Hadoop classes of the format and its settings.
_FORMAT = "org.apache.hadoop.mapreduce.lib.output.MapFileOutputFormat"
_TEXT = "org.apache.hadoop.io.Text"
_CONF = {
    "mapreduce.output.fileoutputformat.compress": "true",
    "mapreduce.output.fileoutputformat.compress.codec": "org.apache.hadoop.io.compress.BZip2Codec",
    "mapreduce.output.fileoutputformat.compress.type": "BLOCK",
}


def write_map_files(
    df: DataFrame, path: str, num_partitions: int, name: str = "part"
) -> None:
    """Write (key, value) rows as one sorted map file per partition.

    Splits are called ``<name>-r-00000`` and so on. Rows are placed and sorted by
    Spark; only the writing goes through Hadoop's output format, fed by the JVM.
    """
    placed = partition_table(df.select("key", "value"), num_partitions)
    ordered = placed.sortWithinPartitions("key").select(F.col("key").alias("_1"), F.col("value").alias("_2"))
    jvm = df.sparkSession._jvm
    string = jvm.org.apache.spark.sql.Encoders.STRING()
    pairs = getattr(ordered._jdf, "as")(jvm.org.apache.spark.sql.Encoders.tuple(string, string)).rdd()
    # What PySpark's own Hadoop writers make of strings.
    to_text = jvm.org.apache.spark.api.python.JavaToWritableConverter()
    texts = jvm.org.apache.spark.api.python.PythonHadoopUtil.convertRDD(pairs, to_text, to_text)
    any_kind = jvm.scala.reflect.ClassTag.AnyRef()
    class_of = jvm.java.lang.Class.forName
    conf = jvm.org.apache.hadoop.conf.Configuration(df.sparkSession._jsc.hadoopConfiguration())
    for setting, value in (_CONF | {"mapreduce.output.basename": name}).items():
        conf.set(setting, value)
    jvm.org.apache.spark.api.java.JavaPairRDD(texts, any_kind, any_kind).saveAsNewAPIHadoopFile(
        path, class_of(_TEXT), class_of(_TEXT), class_of(_FORMAT), conf
    )
