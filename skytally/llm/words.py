"""Words of text columns as numpy arrays: positions, 64-bit hashes and hashes of runs of words.

A word is ``[^\\x20\\x09-\\x0D]+``. The white space is ASCII, so words are found on UTF-8 bytes. Batches are
worked on in chunks of about a megabyte of whole texts, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Chunk(NamedTuple):
    """Texts ``first`` to ``first + len(docs) - 1`` of a batch; words in order of position.

    ``docs[i]:docs[i+1]`` are the words of text ``i``; ``of`` is the text of each word.
    """

    first: int
    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray
    docs: np.ndarray
    hashes: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalised 64-bit hashes (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive words; the caller drops those that cross a text's end."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    m = len(hashes) - n + 1
    out = hashes[:m].copy()
    for k in range(1, n):
        out *= _STEP
        out += hashes[k : k + m]
    return mixed(out)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = data[at + np.repeat(starts, lengths)].astype(np.uint64)
    values += np.uint64(1)
    values *= powers[at]
    return mixed(np.add.reduceat(values, first))


def chunks(texts: pa.Array, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Words of every text; null counts as empty. ``lower``: A-Z become a-z."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        at = offsets[i : j + 1] - offsets[i]
        data = raw[offsets[i] : offsets[j]]
        data = _LOWER[data] if lower else data
        word = ~_SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[at] = True
        begins, stops = word.copy(), word.copy()
        begins[1:] &= ~word[:-1] | cut[1:-1]
        stops[:-1] &= ~word[1:] | cut[1:-1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        docs = np.searchsorted(starts, at)
        of = np.repeat(np.arange(j - i), np.diff(docs))
        yield Chunk(i, starts, ends, of, docs, _word_hashes(data, starts, ends))
        i = j
