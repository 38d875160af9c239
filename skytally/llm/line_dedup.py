"""Repeated lines, found by overlapping windows of three lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import bounded, keyed, restored


def later_windows(docs: DataFrame, window: int = 3) -> DataFrame:
    """doc_id, same, at: first lines of the windows that stand earlier too, by (doc_id, line).

    A window's key is two 64-bit hashes of its lines. Counts and firsts are combined before the shuffle; windows
    that stand once do not come to the join, and a frequent window is a join key that adaptive execution splits.
    """
    lines = docs.where("doc_id IS NOT NULL").select("doc_id", "same", F.split("text", "\n").alias("l")).where(F.size("l") >= window)
    starts = F.sequence(F.lit(0), F.size("l") - window)
    hashed = lambda i: F.struct(
        i.alias("at"),
        F.xxhash64(*(F.get("l", i + k) for k in range(window))).alias("a"),
        F.xxhash64(F.lit(window), *(F.get("l", i + k) for k in range(window))).alias("b"),
    )
    worded = lambda i: F.exists(F.slice("l", i + 1, window), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = lines.select("doc_id", "same", F.inline(F.transform(F.filter(starts, worded), hashed)))
    firsts = windows.groupBy("a", "b").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return windows.join(firsts, ["a", "b"]).where(F.struct("doc_id", "at") > F.col("first")).select("doc_id", "same", "at")


def _without(window: int):
    @F.pandas_udf("text string, n_lines int, n_removed int")
    def cut(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out = []
        for text, at in zip(texts, starts):
            if text is None:
                out.append((None, 0, 0))
                continue
            lines, kept, to = text.split("\n"), [], 0
            if at is not None:
                for s in sorted(at):  # windows that touch merge
                    kept += lines[to:s]
                    to = max(to, s + window)
            kept += lines[to:]
            out.append((text if at is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])

    # Not deterministic to the optimizer: else it runs once more in every filter that reads its result.
    return cut.asNondeterministic()


def dedup_lines(docs: DataFrame, window: int = 3) -> DataFrame:
    """``docs`` (doc_id, text and any others) with repeated lines cut from text, and n_lines and n_removed.

    Every ``window`` consecutive lines (cut at ``\\n``, compared as they are) make a window, if one of them has a
    word. All lines of a window that also stands earlier, in a smaller doc_id or further up in the same document,
    are removed; all windows are judged on the input. Null text stays null; texts of fewer lines stay as they are. A
    row without doc_id is compared with none. Rows that share doc_id and text are treated alike. Columns of ``docs``
    named n_lines and n_removed are replaced. An empty table gives an empty result.
    """
    table = keyed(bounded(docs), ("n_lines", "n_removed"))
    starts = later_windows(table, window).groupBy("doc_id", "same").agg(F.collect_set("at").alias("starts"))
    cut = table.join(starts, ["doc_id", "same"], "left").withColumn("cut", _without(window)("text", "starts"))
    return restored(cut, docs, F.col("cut.text"), {"n_lines": F.col("cut.n_lines"), "n_removed": F.col("cut.n_removed")})
