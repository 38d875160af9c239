"""Tables on their way to Python workers: bounded batches, and further columns under names that clash with nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import importable


#: Rows and bytes of a batch that goes to a Python worker: its memory must not follow the length of texts.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bounded(df: DataFrame) -> DataFrame:
    """The same table; its session now sends small batches to Python workers."""
    conf = importable(df.sparkSession).conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def _others(docs: DataFrame, made: tuple[str, ...]) -> dict[str, str]:
    return {c: f"_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", *made)}


def keyed(docs: DataFrame, made: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, same (hash of the text) and the other columns of ``docs``, renamed; without those in ``made``."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("same"), *(F.col(f"`{c}`").alias(x) for c, x in _others(docs, made).items()))


def restored(df: DataFrame, docs: DataFrame, text: Column, made: dict[str, Column]) -> DataFrame:
    """The columns of ``docs`` in their order, with a new text, then those of ``made``."""
    other = _others(docs, tuple(made))
    own = [F.col("doc_id") if c == "doc_id" else text.alias(c) if c == "text" else F.col(other[c]).alias(c) for c in docs.columns if c not in made]
    return df.select(*own, *(x.alias(c) for c, x in made.items()))
