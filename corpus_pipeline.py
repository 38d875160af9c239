"""The training-data pipeline: documents in, packed token sequences out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import language_id, line_dedup, near_dedup, packing, substring_dedup
from skytally.session import new_folder, tune

#: A text is rejected when no language has this share of the evidence of its words.
SURE = 0.5


def _still_worded(cut: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows that have words left or lost none, with their new length, in the columns of ``docs``."""
    left = cut.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled rows; those without a letter, or in no language for sure, go.

    A missing ``lang`` becomes the language found. The model learns from the rows that are not held out.
    """
    model = language_id.train(docs.where(F.col("doc_id").isNotNull() & ~language_id.held_out(F.col("doc_id"))))
    found = docs.withColumn("_found", language_id.language(F.col("text"), docs, model))
    sure = (F.col("_found.lang") != language_id.UNDETERMINED) & (F.col("_found.score") >= SURE)
    return found.where(sure).withColumn("lang", F.coalesce("lang", "_found.lang")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three-line windows that stand earlier are cut; a document with no word left goes."""
    return _still_worded(line_dedup.dedup_lines(docs), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8, the one with the smallest doc_id stays.

    Rows that share a doc_id are judged by their own text; those that share the text too stay or go together.
    """
    found = near_dedup.near_duplicates(docs, 80, bands=near_dedup.BANDS_80)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("same").alias("gone_text")).distinct()
    return docs.join(gone, (docs["doc_id"] == gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_text"]), "left_anti")


def cut_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document with a smaller doc_id has too are cut; a document with no word left goes."""
    return _still_worded(substring_dedup.remove_passages(docs), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 1024: one row for each piece."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_shared_passages),
    ("best_fit_packing", pack_sequences),
]
#: Language identification, encoding and packing are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what each keeps is written to the shared folder, so a lost executor costs one stage at most."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            path = new_folder(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
