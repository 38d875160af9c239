"""Passages that documents share, found by super-k-mer partitioning."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .frames import bounded, keyed, restored

#: Words of the k-gram whose hash is the minimiser.
GRAM = 8
#: A bucket with more packed strings than this is dealt out further, by the windows' own hashes.
HOT_BUCKET = 4096
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def super_kmers(chunk: words.Chunk, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first word, windows) of each maximal run of consecutive windows with one minimiser."""
    n = len(chunk.hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    least = _least(words.runs(chunk.hashes, gram), window - gram + 1)
    inside = np.flatnonzero(chunk.of[:n] == chunk.of[window - 1 :])
    if not len(inside):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    key, of = least[inside], chunk.of[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    return key[first], inside[first], np.diff(np.append(first, len(inside)))


def _segments(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, same = batch.column("doc_id"), batch.column("same")
            for chunk in words.chunks(batch.column("text")):
                key, first, n = super_kmers(chunk, window, gram)
                row = pa.array(chunk.of[first] + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), ids.take(row), same.take(row), pa.array((first - chunk.docs[chunk.of[first]]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["bucket", "doc_id", "same", "first", "n"],
                )

    return run


def _parts(packed: bytes, window: int, parts: int) -> np.ndarray:
    """Part of a hot bucket for each window of a packed string."""
    chunk = next(words.chunks(pa.array([packed.decode()])))
    return words.runs(chunk.hashes, window) % np.uint64(parts)


def _pack(window: int):
    """Packed strings of the wanted runs of each text; those of a hot bucket once for each part its windows fall into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("wanted").is_valid())
            out: list[tuple] = []
            for doc, same, wanted, text in zip(*(batch.column(c) for c in ("doc_id", "same", "wanted", "text"))):
                doc, same, got = doc.as_py(), same.as_py(), text.as_py().encode().split()
                for x in wanted.as_py():
                    packed = b" ".join(got[x["first"] : x["first"] + x["n"] + window - 1])
                    parts = [0] if x["parts"] == 1 else np.unique(_parts(packed, window, x["parts"])).tolist()
                    out += [(x["bucket"], p, x["parts"], doc, same, x["first"], packed) for p in parts]
                if len(out) >= 20_000:
                    yield _packed_rows(out)
                    out = []
            yield _packed_rows(out)

    return run


_PACKED = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("parts", pa.int64()), ("doc_id", pa.int64()), ("same", pa.int64()), ("first", pa.int32()), ("packed", pa.binary())])


def _packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [[]] * 7, _PACKED)], schema=_PACKED)


def _count(window: int):
    """Streams sorted buckets: a window met under a smaller doc_id before marks its words.

    Rows come by (bucket, part, doc_id), so the first document that shows a window is its smallest. What is held
    is the set of different windows of one part of one bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, {}
        for batch in batches:
            out = []
            cols = [c.to_pylist() for c in batch.columns]
            for bucket, part, parts, doc, same, first, packed in zip(*cols):
                if now != (bucket, part):
                    now, seen = (bucket, part), {}
                got = packed.split(b" ")
                n = len(got) - window + 1
                ends = np.cumsum([len(w) + 1 for w in got]).tolist()
                begins = [0, *ends]
                mine = None
                if parts > 1:
                    mine = _parts(packed, window, parts) == part
                since = None
                for i in range(n):
                    hit = (mine is None or mine[i]) and seen.setdefault(packed[begins[i] : ends[i + window - 1] - 1], doc) < doc
                    if hit and since is None:
                        since = i
                    elif not hit and since is not None:
                        out.append((doc, same, first + since, first + i - 1 + window))
                        since = None
                if since is not None:
                    out.append((doc, same, first + since, first + n - 1 + window))
            names, kinds = ["doc_id", "same", "a", "b"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)], names)

    return run


def covered_ranges(docs: DataFrame, window: int = 50, gram: int = GRAM, hot: int = HOT_BUCKET) -> tuple[DataFrame, DataFrame]:
    """(docs with ``same``, ranges (doc_id, same, ranges)): words that an earlier document's window covers.

    ``docs``: doc_id long, text string. ``same`` hashes the text, so that rows which share a doc_id but not the
    text are told apart. Each text is cut into super-k-mers. A bucket (minimiser) met in one doc_id alone holds
    no window shared by two, so its strings stay where they are; the others travel, packed.
    """
    docs = bounded(docs).select("doc_id", "text", F.xxhash64("text").alias("same"))
    runs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(_segments(window, gram), "bucket long, doc_id long, same long, first int, n int")
    shared = runs.groupBy("bucket").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("c")).where("lo < hi")
    shared = shared.select("bucket", F.expr(f"1 + cast(floor(c / {hot}) AS long)").alias("parts"))
    wanted = runs.join(shared, "bucket").groupBy("doc_id", "same").agg(F.collect_set(F.struct("bucket", "parts", "first", "n")).alias("wanted"))
    packed = docs.join(wanted, ["doc_id", "same"], "left").mapInArrow(_pack(window), "bucket long, part long, parts long, doc_id long, same long, first int, packed binary")
    order = ["bucket", "part", "doc_id"]
    hits = packed.repartition("bucket", "part").sortWithinPartitions(*order).mapInArrow(_count(window), "doc_id long, same long, a int, b int")
    return docs, hits.groupBy("doc_id", "same").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("ranges"))


def keep_mask(n: int, ranges: list[dict]) -> np.ndarray:
    """True for each of ``n`` words outside all ranges [a, b)."""
    edge = np.zeros(n + 1, np.int64)
    for x in ranges:
        edge[x["a"]] += 1
        edge[x["b"]] -= 1
    return np.cumsum(edge[:n]) == 0


def _cut(text: bytes, ranges: list[dict]) -> bytes:
    """The text without the words of the ranges and the white space after each."""
    spans = [m.start() for m in WORD.finditer(text)] + [len(text)]
    stay = keep_mask(len(spans) - 1, ranges).tolist()
    return text[: spans[0]] + b"".join(text[a:b] for a, b, s in zip(spans, spans[1:], stay) if s)


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, ranges in zip(batch.column("text"), batch.column("ranges")):
            got = (text.as_py() or "").encode().split()  # parts at exactly the white space that ends a word here
            n_words.append(len(got))
            if ranges.is_valid:
                got = list(compress(got, keep_mask(len(got), ranges.as_py()).tolist()))
            n_removed.append(n_words[-1] - len(got))
            kept.append(b" ".join(got) if text.is_valid else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("same"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "same", "n_words", "n_removed", "kept"],
        )


def dedup_substrings(docs: DataFrame, window: int = 50, gram: int = GRAM, hot: int = HOT_BUCKET) -> DataFrame:
    """doc_id, same (hash of the text), n_words, n_removed and kept of each row.

    A window is ``window`` consecutive words of one document. Every word covered by a window whose words also
    stand in a document with a smaller doc_id is removed; all windows are judged on the input. ``kept`` has the
    words that stay, joined by one space. Null text: no words, kept null. Texts shorter than a window lose nothing. A row without doc_id is before and after no other: it
    loses nothing and takes nothing. Equal rows stay equal, for windows of one doc_id never remove each other.
    An empty table gives an empty result. Other columns are not read.
    """
    docs, ranges = covered_ranges(docs, window, gram, hot)
    return docs.join(ranges, ["doc_id", "same"], "left").mapInArrow(_cleaned, "doc_id long, same long, n_words long, n_removed long, kept string")


def _cut_texts(texts: pd.Series, ranges: pd.Series) -> pd.DataFrame:
    out = []
    for text, own in zip(texts, ranges):
        if own is None or text is None:
            out.append((text, 0))
        else:
            raw = text.encode()
            out.append((_cut(raw, own).decode(), int((~keep_mask(len(raw.split()), own)).sum())))
    return pd.DataFrame(out, columns=["text", "n_removed"])


def remove_passages(docs: DataFrame, window: int = 50, gram: int = GRAM, hot: int = HOT_BUCKET) -> DataFrame:
    """``docs`` (doc_id, text and any others) with the words that ``dedup_substrings`` removes cut from text, and n_removed.

    The words that stay keep their white space. A column of ``docs`` named n_removed is replaced.
    """
    table = keyed(docs, ("n_removed",))
    _, ranges = covered_ranges(docs, window, gram, hot)
    # Not deterministic to the optimizer: else it runs once more in every filter that reads its result.
    cut_texts = F.pandas_udf(_cut_texts, "text string, n_removed long").asNondeterministic()
    cut = table.join(ranges, ["doc_id", "same"], "left").withColumn("cut", cut_texts("text", "ranges"))
    return restored(cut, docs, F.col("cut.text"), {"n_removed": F.col("cut.n_removed")})
