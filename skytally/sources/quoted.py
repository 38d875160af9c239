"""Records of delimited files whose quoted fields hold line breaks, cut in parallel in every split of every file.

A physical line maps the state before it (outside or inside quotes) to the state behind it; so does a split, by composing its lines. One pass
finds the map of each split, a running composition over a file's splits fixes the state in which each starts, and a second pass cuts
records. What a record leaves in further splits is put together by the split it starts in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import importable, stored

#: Maps of (outside, inside) to the state behind: both outside, both inside, unchanged, exchanged.
OUT, IN, SAME, FLIP = 0, 1, 2, 3
#: Rows of the table of split states up to which it may be broadcast (about 100 bytes each).
BROADCAST_SPLITS = 100_000
_SPLIT = ["_file", "_start"]
_PIECE = "_file string, _start long, kind int, text string"


def physical_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of all files as bytes, with file and split, in the order of the file inside a split."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(
        F.col("value").cast("binary").alias("raw"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_n"))


def decoded(raw: Column, encoding: str) -> Column:
    """Text of a line without the carriage return at its end. Quotes, separators and line breaks must be single bytes, as in UTF-8 and the ISO-8859 family."""
    text = raw.cast("string") if encoding.upper().replace("-", "") == "UTF8" else F.decode(raw, encoding)
    return F.regexp_replace(text, r"\r\z", "")


def line_map(text: Column, sep: str = ";", quote: str = '"', escape: str = "\\") -> Column:
    """The line's map as one of ``OUT``, ``IN``, ``SAME``, ``FLIP``.

    A field is quoted if it starts with the quote; a doubled quote, and what follows the escape character, do not end it. A quote inside an
    unquoted field says nothing.
    """
    s, q, e = re.escape(sep), re.escape(quote), re.escape(escape)
    body = rf"(?:[^{q}]|{q}{q})*+" if escape == quote else rf"(?:[^{q}{e}]|{e}.|{q}{q})*+"

    def opens(rest: Column) -> Column:
        """True if the last field that starts with a quote is not closed; ``rest`` starts at a field or with a separator."""
        closed = F.regexp_replace(rest, rf"(?s)(\A|{s}){q}{body}{q}", "$1")
        return closed.rlike(rf"(?:\A|{s}){q}")

    from_out = opens(text)
    leaves = text.rlike(rf"(?s)\A{body}{q}")
    # Behind the quote that closes the field, up to the separator, is text of that field.
    rest = F.regexp_replace(text, rf"(?s)\A{body}{q}[^{s}]*+", "")
    from_in = ~leaves | ((rest != "") & opens(rest))
    plain = ~F.contains(text, F.lit(quote))
    return F.when(plain, SAME).when(from_out & from_in, IN).when(from_out, FLIP).when(from_in, SAME).otherwise(OUT)


def _after(first, then):
    """The map of ``first`` followed by ``then`` (numbers or arrays)."""
    return np.where(then < SAME, then, np.where(then == SAME, first, np.where(first < SAME, 1 - first, 5 - first)))


def _split_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split of the partition: the map of all its lines. A batch's run is its last fixed map and the flips behind it."""
    file, start, so_far = None, None, SAME
    for b in batches:
        files, starts, maps = b["_file"].to_pylist(), b["_start"].to_numpy(), b["map"].to_numpy()
        cut = [0, *(i for i in range(1, len(files)) if starts[i] != starts[i - 1] or files[i] != files[i - 1]), len(files)] if len(files) else []
        for a, z in zip(cut, cut[1:]):
            if (files[a], starts[a]) != (file, start):
                if file is not None:
                    yield _map_row(file, start, so_far)
                file, start, so_far = files[a], starts[a], SAME
            run = maps[a:z]
            fixed = np.flatnonzero(run < SAME)
            last = fixed[-1] if len(fixed) else -1
            if last >= 0:
                so_far = int(run[last])
            if np.count_nonzero(run[last + 1 :] == FLIP) % 2:
                so_far = int(_after(so_far, FLIP))
    if file is not None:
        yield _map_row(file, start, so_far)


def _map_row(file: str, start: int, of: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"_file": [file], "_start": pa.array([start], pa.int64()), "map": pa.array([of], pa.int32())})


def split_states(lines: DataFrame) -> DataFrame:
    """_file, _start, inside: does the split start inside quotes? From the maps (``map``) of the lines, by a running composition.

    The state is that of the last fixed map before the split, turned by the flips since; a file starts outside.
    """
    maps = stored(importable_frame(lines).select("_file", "_start", "map").mapInArrow(_split_maps, "_file string, _start long, map int"), "splits")
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum((F.col("map") == FLIP).cast("int")).over(before), F.lit(0))
    seen = maps.withColumn("flips", flips)
    fixed = F.last(F.when(F.col("map") < SAME, F.struct("map", "flips")), ignorenulls=True).over(before)
    state = seen.withColumn("fixed", fixed)
    entry = F.coalesce(F.col("fixed.map"), F.lit(0)) + F.col("flips") - F.coalesce(F.col("fixed.flips"), F.lit(0))
    return stored(state.select(*_SPLIT, (entry % 2 == 1).alias("inside")), "split_states")


def importable_frame(df: DataFrame) -> DataFrame:
    importable(df.sparkSession)
    return df


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that start and end in their split (kind 0), its last record if it is open (2), and lines before its first record (1: these end it, 3: they do not)."""
    split, inside, head, held = None, False, False, []
    out: list[tuple] = []

    def close(kind: int) -> None:
        nonlocal held
        out.append((*split, kind, "\n".join(held)))
        held = []

    for b in batches:
        for file, start, enters, of, text in zip(b["_file"].to_pylist(), b["_start"].to_pylist(), b["inside"].to_pylist(), b["map"].to_pylist(), b["text"].to_pylist()):
            if (file, start) != split:
                if held:
                    close(3 if head else 2)
                split, inside, head = (file, start), enters, enters
            held.append(text)
            inside = bool(_NEXT[of][inside])
            if not inside:
                close(1 if head else 0)
                head = False
            if len(out) >= 1000:
                yield _pieces(out)
                out.clear()
    if held:
        close(3 if head else 2)
    if out:
        yield _pieces(out)


_NEXT = ((0, 0), (1, 1), (0, 1), (1, 0))


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    file, start, kind, text = zip(*rows)
    return pa.RecordBatch.from_pydict({"_file": list(file), "_start": pa.array(start, pa.int64()), "kind": pa.array(kind, pa.int32()), "text": pa.array(text, pa.string())})


def records(spark: SparkSession, paths: str | Sequence[str], sep: str = ";", quote: str = '"', encoding: str = "UTF-8", escape: str = "\\") -> DataFrame:
    """_file, text: the records of all files, quoted line breaks inside; records of white space alone are left out.

    Two narrow passes over the lines; only the pieces of records that cross a split's border are shuffled (two a split, at most). A quote that is
    never closed makes the rest of its file one record, as any reader of quoted files has it. Splits are those of the reading session: with
    other split settings between planning and running, the read fails rather than lose a line.
    """
    lines = physical_lines(spark, [paths] if isinstance(paths, str) else paths).withColumn("text", decoded(F.col("raw"), encoding)).withColumn("map", line_map(F.col("text"), sep, quote, escape))
    states = split_states(lines)
    if states.limit(BROADCAST_SPLITS + 1).count() <= BROADCAST_SPLITS:
        at = lines.join(F.broadcast(states), _SPLIT, "left")  # narrow: lines stay in the order of their file
    else:
        at = lines.join(states, _SPLIT, "left").repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "_n")
    known = F.coalesce("inside", F.raise_error(F.lit("the files' splits have changed while they were read")).cast("boolean"))
    pieces = importable_frame(at.select(*_SPLIT, known.alias("inside"), "map", "text")).mapInArrow(_cut, _PIECE)
    # Text is read again for the whole records and the pieces; what crosses borders is small and written once.
    across = stored(pieces.where("kind > 0"), "pieces")
    owner = F.max(F.when(F.col("kind") == 2, F.col("_start"))).over(Window.partitionBy("_file").orderBy("_start", "kind").rowsBetween(Window.unboundedPreceding, 0))
    joined = across.withColumn("owner", owner).groupBy("_file", "owner").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_start", "kind", "text"))), lambda x: x["text"]), "\n").alias("text"))
    whole = pieces.where("kind = 0").select("_file", "text").unionByName(joined.select("_file", "text"))
    return whole.where(F.trim("text") != "")
