"""From raw documents to token ids, in five stages.

Each stage works on all rows that its predecessor kept, and its rows are written as
Parquet before the next one reads them, so a lost executor costs no more than a stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.llm import bpe, decontaminate, near_dups, secret_scan, toxicity
from warcloom.llm.common import drop_stage, scratch, stage_path, table
from warcloom.llm.queries import tokenizer_file


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of the toxicity score, learned from ``labels``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, result="__toxicity")
    return scored.filter(F.col("__toxicity") < toxicity.THRESHOLD).select(*[f"`{c}`" for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, 0.8 or more."""
    return near_dups.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose own text overlaps no item of ``benchmark``, whatever other rows have their id."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), together=False)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and ``n_chars`` counted anew."""
    found = secret_scan.redacted(secret_scan.scan(docs.withColumnRenamed("secrets", "__secrets")))
    changed = F.size("secrets") > 0
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(changed, count).otherwise(F.col("n_chars")))
    return found.drop("secrets").withColumnRenamed("__secrets", "secrets").select(*[f"`{c}`" for c in docs.columns])


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``token_ids`` (packed) and whether they decode to the text."""
    path = tokenizer_file("byte_bpe_50k.json")
    coded = bpe.encode(docs.select("doc_id", "text"), path, decoded=True)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "n_tokens", "token_ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", to_token_ids),
]

#: SQL can express neither the learned scores nor the merges; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = stage_path(spark, name)
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(out)
        docs = spark.read.schema(made.schema).parquet(out)
        if before:
            drop_stage(spark, before)
        before = out
    return docs
