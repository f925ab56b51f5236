"""The registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.llm import (
    bpe,
    decontaminate,
    divergence,
    filter_audit,
    licenses,
    near_dups,
    secret_scan,
    stream_dedup,
    surrogates,
    token_files,
    topk,
    toxicity,
    warc_files,
)
from warcloom.llm.oracle import ORACLE  # noqa: F401
from warcloom.llm.common import stage_path, table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, all_found = F.col("base"), F.col("detections")
    labels = lambda column: F.transform(column, lambda d: d["label"])
    names = lambda array: F.array_join(F.array_sort(F.array_distinct(array)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["start"])).alias("last_word"),
        names(labels(base)).alias("base_labels"),
        names(F.concat(labels(base), labels(all_found))).alias("labels"),
        F.greatest(
            F.coalesce(F.array_max(F.transform(all_found, lambda d: d["weight"])), F.lit(0.0)),
            F.when(F.size(base) > 0, F.lit(0.9)).otherwise(F.lit(0.0)),
        ).alias("score"),
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, tokenizer_file("byte_bpe_50k.json"), drop_text=True, decoded=True)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stage_path(spark, "warc")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").alias("payload"))
    warc_files.write_warc(pages, out)
    read = warc_files.read_warc(spark, out, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secret_scan.BASE]
    of_kind = lambda kind: F.filter("secrets", lambda s: s["kind"] == kind)
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, line), ",")
    return found.select(
        "doc_id",
        *[F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stage_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, tokenizer_file("word_bpe_49k.json"), 2, out)
    return token_files.read_token_files(spark, out, crc32=True)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, drop_text=True)
    predicted = F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymized(docs, key="production")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(topk.usable("embedding"))
    rows = rows.select("vec_id", topk.scaled("embedding", 64).alias("ints"))
    return topk.top_k(rows, rows.filter("vec_id % 20 = 0"), 20)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), min_docs=30, smooth=5, scale=1_000_000_000, top=50)


def op12_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.deduplicated(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_license_scan": op2_license_scan,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_warc_round_trip": op5_warc_round_trip,
    "op6_secret_scan": op6_secret_scan,
    "op7_token_files": op7_token_files,
    "op8_toxicity": op8_toxicity,
    "op9_surrogates": op9_surrogates,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_source_divergence": op11_source_divergence,
    "op12_stream_dedup": op12_stream_dedup,
    "op13_filter_audit": op13_filter_audit,
}

