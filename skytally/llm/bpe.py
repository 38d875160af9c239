"""Byte-level BPE: exact ids of whole texts, long ones by tree concatenation, and their text back."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import bounded

#: Characters of a leaf: a longer text is encoded as two halves.
LEAF = 8192
#: Characters from which the parts of one text go to several tasks, and characters of such a part.
SPREAD, PART = 1 << 20, 1 << 18
#: Words whose ids a worker remembers.
REMEMBERED = 250_000

# How the vocabulary file writes bytes as characters, and how byte-level BPE cuts text.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: After a letter a cut always comes before what is no letter, and likewise with digits, whatever stands around.
_SURE = regex.compile(r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})")
#: A stretch that the pattern keeps whole, so that only the merges can say where its tokens end.
_WHOLE = regex.compile(r"\p{L}+|\p{N}+")


def _bytes_of_characters() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(_PRINTED)]
    return {**{chr(b): b for b in _PRINTED}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class _Wide(Exception):
    """A space beside other white space: only the pattern can say where the text is cut there."""


class _Words(dict):
    """Ids, as bytes, of words with a space before them."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Wide
        ids = array("I", self.encode(" " + word)).tobytes()
        if len(self) < REMEMBERED and len(word) < 64:
            self[word] = ids
        return ids


class Bpe:
    """Encoder and decoder for one vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, file: str, leaf: int = LEAF):
        spec, byte = json.loads(file), _bytes_of_characters()
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for i, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            if spec["model"]["vocab"][a + b] != 256 + i:
                raise ValueError("the ids of the merged tokens must be in the order of the merges")
        self.encoding = tiktoken.Encoding("bpe", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.leaf, self.words = leaf, _Words(self.encoding.encode_ordinary)
        self.tokens = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self.sizes = np.array([len(self.tokens.get(i, b"")) for i in range(max(self.tokens) + 1)])
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; the strings of special tokens become those."""
        if self.split is None or not any(s in text for s in self.special):
            return self.tree(text)
        return b"".join(array("I", [self.special[x]]).tobytes() if x in self.special else self.tree(x) for x in self.split.split(text) if x)

    def tree(self, text: str) -> bytes:
        if len(text) <= self.leaf:
            return self._leaf(text)
        mid = len(text) // 2
        left, right = text[:mid], text[mid:]
        return self.join(left, self.tree(left), right, self.tree(right))

    def _leaf(self, text: str) -> bytes:
        # Before a single space there is always a cut, so the words between are encoded one by one.
        first, *rest = text.split(" ")
        try:
            if rest and first[-1:].isspace():
                raise _Wide
            return array("I", self.encoding.encode_ordinary(first)).tobytes() + b"".join(map(self.words.__getitem__, rest))
        except _Wide:
            return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def join(self, left: str, a: bytes, right: str, b: bytes, width: int = 32) -> bytes:
        """Ids of ``left + right`` from the ids of both: a window around the join is encoded anew.

        The window's ends must be places where both sides agree: sure cuts of the pattern that are ends of tokens
        of the side too, or, inside a stretch that the pattern keeps whole, places where the window's outermost
        tokens are the side's own (adjacent tokens that are right in pairs are right together). Until then the
        window grows, at last over both texts.
        """
        ids, jds = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
        ends, jnds = np.cumsum(self.sizes[ids]), np.cumsum(self.sizes[jds])
        while True:
            tail, head = left[-4 * width :], right[: 4 * width]
            full_left, full_right = len(tail) == len(left), len(head) == len(right)
            cuts = [m.start() for m in _SURE.finditer(tail) if m.start() <= len(tail) - width]
            s = cuts[-1] if cuts else 0 if full_left else None
            cut = _SURE.search(head, width)
            e = cut.start() if cut else len(head) if full_right else None
            if s is not None and e is not None:
                i = self._at(ends, len(left.encode()) - len(tail[s:].encode()))
                j = self._at(jnds, len(head[:e].encode()))
                if i is not None and j is not None:
                    return ids[:i].tobytes() + self._leaf(tail[s:] + head[:e]) + jds[j:].tobytes()
            elif not (full_left and full_right) and _WHOLE.fullmatch(tail + head):
                found = self._whole(tail, ids, ends, head, jds, jnds)
                if found is not None:
                    return found
            if full_left and full_right:
                return self._leaf(left + right)
            width *= 2

    @staticmethod
    def _at(ends: np.ndarray, size: int) -> int | None:
        """Tokens in the first ``size`` bytes, if one ends there."""
        n = int(np.searchsorted(ends, size)) + 1 if size else 0
        return n if not size or n <= len(ends) and ends[n - 1] == size else None

    def _whole(self, tail: str, ids: np.ndarray, ends: np.ndarray, head: str, jds: np.ndarray, jnds: np.ndarray) -> bytes | None:
        before, after = tail.encode(), head.encode()
        since = int(ends[-1]) - len(before)
        starts = (ends - self.sizes[ids])[-len(before) :]
        base = len(ids) - len(starts)
        i = next((base + k for k, x in enumerate(starts.tolist()) if x >= since and (before[x - since] & 0xC0) != 0x80), None)
        j = next((k for k in range(int(np.searchsorted(jnds, len(after), "right")) - 1, -1, -1) if jnds[k] == len(after) or (after[jnds[k]] & 0xC0) != 0x80), None)
        if i is None or j is None:
            return None
        window = before[int(ends[i] - self.sizes[ids[i]]) - since :] + after[: int(jnds[j])]
        mid = self.encoding.encode_ordinary(window.decode())
        if mid[0] != ids[i] or mid[-1] != jds[j] or len(mid) < 2:
            return None
        return ids[:i].tobytes() + array("I", mid).tobytes() + jds[j + 1 :].tobytes()

    def decode(self, ids: bytes) -> str:
        """Text of the ids, special tokens written out; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.tokens.__getitem__, array("I", ids))).decode("utf-8", "replace")


_OPEN: dict[tuple[int, int], Bpe] = {}


def opened(file: Broadcast, leaf: int = LEAF) -> Bpe:
    """The encoder of a broadcast vocabulary file, made once in each worker."""
    key = (hash(file.value), leaf)
    if key not in _OPEN:
        _OPEN[key] = Bpe(file.value, leaf)
    return _OPEN[key]


def vocabulary(df: DataFrame, path: str) -> Broadcast:
    """The vocabulary file (a few MB, whatever the data) for all tasks."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _encoded(file: Broadcast, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened(file, leaf)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                ids = [bpe.encode(t.as_py() or "") for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pa.array(ids, pa.binary())], ["doc_id", "text", "ids"])

    return run


def _joined(file: Broadcast, leaf: int):
    def level(bpe: Bpe, parts: list[tuple[str, bytes]]) -> list[tuple[str, bytes]]:
        two = [(a[0] + b[0], bpe.join(*a, *b)) for a, b in zip(parts[::2], parts[1::2])]
        return two + parts[2 * len(two) :]

    def run(key, pdf):
        bpe = opened(file, leaf)
        pdf = pdf.sort_values("part")
        parts = list(zip(pdf["text"], pdf["ids"]))
        while len(parts) > 1:
            parts = level(bpe, parts)
        pdf = pdf.iloc[:1].copy()
        pdf["text"], pdf["ids"] = [parts[0][0]], [parts[0][1]]
        return pdf[["doc_id", "text", "ids"]]

    return run


def encode(docs: DataFrame, path: str, leaf: int = LEAF, spread: int = SPREAD, part: int = PART) -> DataFrame:
    """doc_id, text and ids (binary, little-endian unsigned 32-bit) of each row of ``docs`` (doc_id, text).

    ``path``: a tokenizer file of the tokenizers library with byte-level BPE; the ids are those it gives without
    added special tokens. Texts over ``leaf`` characters are encoded as halves, recursively, and joined; those
    over ``spread`` are dealt in parts to all tasks first, and only their parts' ids meet for the joins. Null and
    empty text: no ids. Rows are independent: ties and repeated rows give equal results; an empty table gives an
    empty result. Other columns are not read.
    """
    file = vocabulary(docs, path)
    special = [t["content"] for t in json.loads(file.value)["added_tokens"]]
    rows = bounded(docs).select("doc_id", "text")
    far = F.length("text") > spread
    for s in special:
        far &= ~F.contains("text", F.lit(s))
    far = F.coalesce(far, F.lit(False))
    near = rows.where(~far).mapInArrow(_encoded(file, leaf), "doc_id long, text string, ids binary")
    cut = rows.where(far).withColumn("row", F.monotonically_increasing_id())
    parts = cut.select("row", "doc_id", F.explode(F.expr(f"sequence(0, cast((length(text) - 1) div {part} AS int))")).alias("part"), "text")
    parts = parts.withColumn("text", F.expr(f"substring(text, part * {part} + 1, {part})")).repartition("row", "part")

    def coded(batches):
        bpe = opened(file, leaf)
        for batch in batches:
            ids = [bpe.tree(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], [*batch.schema.names, "ids"])

    parts = parts.mapInArrow(coded, "row long, doc_id long, part int, text string, ids binary")
    return near.unionAll(parts.groupBy("row").applyInPandas(_joined(file, leaf), "doc_id long, text string, ids binary"))


def decode(coded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and text of each row (doc_id, ids); null ids give null text."""
    file = vocabulary(coded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened(file)
        for batch in batches:
            text = [None if x is None else bpe.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], ["doc_id", "ids", "text"])

    return bounded(coded).select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
