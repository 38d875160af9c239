"""Incremental loads and quality splits as Structured Streaming jobs that run to the end of their input."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import split_quality
from ..session import new_folder


def finish(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def load_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema, fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None, skip_if_loaded: bool = False, **options,
) -> None:
    """Append the files not loaded before; running it again loads nothing twice.

    The checkpoint is the ledger of files. ``skip_if_loaded`` leaves a target that already has rows.
    """
    if skip_if_loaded and _has_rows(spark, target):
        return
    stream = spark.readStream.schema(schema).options(**options).format(fmt).load(source)
    out = transform(stream) if transform else stream
    finish(out.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target))


def _has_rows(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(path).isEmpty()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


def stream_table(spark: SparkSession, path: str, **options) -> DataFrame:
    """A Parquet folder or file as a stream, with the schema it has now."""
    return spark.readStream.schema(spark.read.parquet(path).schema).options(**options).parquet(path)


def run_to_table(result: DataFrame, target: str | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """Run a stream over the available input and return the stored result.

    Without ``keys`` new rows are appended. With them the stream runs in update mode, so its state goes when the
    watermark has passed, and the last row written for each key counts. The batch number is part of the path, so a
    batch that is run again replaces its own output.
    """
    spark = result.sparkSession
    target = target or new_folder(spark, "stream")
    spark.createDataFrame([], result.schema).write.parquet(f"{target}/lote=-1")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/lote={number}")

    mode = "update" if keys else "append"
    finish(result.writeStream.outputMode(mode).option("checkpointLocation", new_folder(spark, "ckpt")).foreachBatch(write))
    stored = spark.read.option("basePath", target).parquet(target)
    if not keys:
        return stored.drop("lote")
    rest = [c for c in result.columns if c not in keys]
    last = stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), "lote").alias("_last"))
    return last.select(*[c if c in keys else F.col(f"_last.{c}").alias(c) for c in result.columns])


def split_stream(marked: DataFrame, audited_path: str, quarantine_path: str, checkpoint: str) -> None:
    """Keep both sides of a quality split fresh: each batch goes to two sinks.

    The batch number is part of the path, so a batch that is run again replaces its own output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            audited, quarantine = split_quality(batch)
            audited.write.mode("overwrite").parquet(f"{audited_path}/lote={batch_id}")
            quarantine.write.mode("overwrite").parquet(f"{quarantine_path}/lote={batch_id}")
        finally:
            batch.unpersist()

    finish(marked.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write))


def as_event_time(df: DataFrame, column: str) -> DataFrame:
    """A time that watermarks accept."""
    return df.withColumn(column, F.col(column).cast("timestamp"))
