"""Packing of token pieces into sequences: best-fit decreasing over a segment tree of remaining capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .frames import bounded

#: Documents whose short pieces are packed together; each shard leaves one half-empty sequence or so.
SHARD = 50_000
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Capacities:
    """Open sequences by remaining capacity; a segment tree over the capacities finds the tightest that fits."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        i = capacity + self.leaves
        while i and not self.tree[i]:
            self.tree[i] = 1
            i >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(sequence, its capacity) of the least capacity that holds ``length``, now taken out."""
        i = length + self.leaves
        while not self.tree[i]:
            while i & 1:  # the right child: nothing further in this subtree
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if self.tree[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        sequence = self.open[capacity].pop()
        if not self.open[capacity]:
            self.tree[i] = 0
            i >>= 1
            while i and not (self.tree[2 * i] or self.tree[2 * i + 1]):
                self.tree[i] = 0
                i >>= 1
        return sequence, capacity


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; lengths are 1 to ``size``."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free, opened = Capacities(size), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = free.take(length)
        if found is None:
            found, opened = (opened, size), opened + 1
        sequence[i], offset[i] = found[0], size - found[1]
        if found[1] > length:
            free.add(found[1] - length, found[0])
    return sequence, offset


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole sequences, after a first one that may be shorter."""
    edges = [0, *range(n % size or size, n + 1, size)]
    return list(zip(edges, (b - a for a, b in zip(edges, edges[1:]))))


def token_pieces(docs: DataFrame, path: str, size: int = 1024, end: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of each row of ``docs`` (doc_id, text).

    A row's ids are those of ``bpe.encode``, then ``end``; null and empty text have ``end`` alone.
    """
    file = bpe.vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, last = bpe.opened(file), np.array([end], "<u4").tobytes()
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = coder.encode(text.as_py() or "") + last
                out += [(doc, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(ids) // 4, size))]
            yield _rows(out)

    return bounded(docs).select("doc_id", "text").mapInArrow(run, _PIECE)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])


def _packed(size: int):
    def place(rows: pa.RecordBatch, sequence: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
        part = TaskContext.get().partitionId() << 40
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(sequence + part), pa.array(offset)], [*rows.schema.names, "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, n = [], 0
        for batch in batches:
            length = batch.column("length").to_numpy()
            whole = batch.filter(pa.array(length == size))  # a whole sequence needs no place among others
            if len(whole):
                yield place(whole, np.arange(n, n + len(whole)), np.zeros(len(whole), np.int64))
                n += len(whole)
            short.append(batch.filter(pa.array(length < size)))
        if short:
            rows = pa.Table.from_batches(short).combine_chunks().to_batches()
            for batch in rows:
                sequence, offset = best_fit_decreasing(batch.column("length").to_numpy(), size)
                yield place(batch, sequence + n, offset)
                n += int(sequence.max(initial=-1)) + 1

    return run


def pack(pieces: DataFrame, size: int, shards: int) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32; lengths 1 to ``size``) with sequence_id and offset.

    Pieces are dealt evenly to ``shards`` tasks, whatever their documents. Each packs its pieces under ``size``
    best-fit decreasing: the longest first, each into the open sequence with the least room that holds it. Pieces
    of ``size`` fill a sequence each and pass through. Only (id, length) rows of one shard are held.
    """
    return pieces.repartition(shards).mapInArrow(_packed(size), f"{_PIECE}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, size: int = 1024, end: int = 2, shard: int = SHARD) -> DataFrame:
    """All ids of ``docs`` (doc_id, text) in sequences of ``size``: one row for each piece.

    Null and empty text: one piece with ``end`` alone. Rows are independent, so repeated rows and rows that share
    or lack a doc_id are all packed. Pieces of equal length may change places. An empty table gives an empty
    result. Other columns are not read.
    """
    shards = max(1, -(-docs.count() // shard))
    return pack(token_pieces(docs, path, size, end), size, shards)
