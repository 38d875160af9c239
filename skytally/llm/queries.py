"""One query for each operator, over its whole table, with its check in SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from . import audit_checks, bpe, chat_format, checks, language_id, line_dedup, merkle_manifest, near_dedup, packing, quality_rules, secret_scan, source_audit, substring_dedup, topk_search, warc

QUERIES: dict = {}
CHECKS: dict[str, str] = {}
_TOKENIZER = "byte_bpe_50k.json"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_topk_search", checks.TOPK)
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), topk_search.quantized(F.col("embedding"), 64).alias("vector"))
    return topk_search.top_k(items, items.where("id % 20 = 0"), 20)


@query("op2_near_dedup", checks.NEAR)
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).drop("same")


@query("op3_chat_format", checks.CHAT)
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.array_join(F.transform("mask", lambda m: F.concat(m["start"], F.lit("-"), m["end"])), ",")
    return chat_format.rotate(_table(spark, sf_dir, "conversations")).withColumn("mask", shown)


@query("op4_bpe")
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(_TOKENIZER)
    back = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path)
    return back.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    )


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(_TOKENIZER), 1024, 2)


@query("op6_line_dedup", checks.LINES)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query("op7_substring_dedup", checks.SUBSTRINGS)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


@query("op9_warc", checks.WARC)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(_table(spark, sf_dir, "pages")))


@query("op10_quality_rules", checks.quality(quality_rules.Rules(), quality_rules))
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean_lines(_table(spark, sf_dir, "documents")).drop("lost", "text")


@query("op11_secret_scan", audit_checks.secrets())
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(_table(spark, sf_dir, "documents")))


@query("op12_source_audit", audit_checks.DIVERGENCE)
def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(_table(spark, sf_dir, "documents"))


@query("op13_merkle_manifest", audit_checks.MANIFEST)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(_table(spark, sf_dir, "documents"))
