"""Packing: every id placed once, without gaps, in few sequences."""

import random
import zlib
from bisect import insort

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skytally.llm.packing import best_fit_decreasing, cut, pack_documents
from skytally.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRUE = Tokenizer.from_file(PATH)


def plain_best_fit(lengths, size):
    free, n = [], 0
    for x in sorted(lengths, reverse=True):
        fit = next((i for i, c in enumerate(free) if c >= x), None)
        room = size if fit is None else free.pop(fit)
        n += fit is None
        if room > x:
            insort(free, room - x)
    return n


@pytest.mark.parametrize("size", [1, 5, 8, 64, 1000, 1024])
def test_best_fit_decreasing(size):
    r = random.Random(size)
    lengths = np.array([r.randint(1, r.choice([size, max(1, size // 3)])) for _ in range(700)])
    sequence, offset = best_fit_decreasing(lengths, size)
    assert sequence.max() + 1 == plain_best_fit(lengths.tolist(), size)
    for s in set(sequence.tolist()):
        at = np.flatnonzero(sequence == s)
        at = at[np.argsort(offset[at])]
        assert offset[at].tolist() == np.concatenate(([0], np.cumsum(lengths[at])[:-1])).tolist() and lengths[at].sum() <= size
    assert best_fit_decreasing(np.array([], int), 8)[0].tolist() == []


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(5, 4) == [(0, 1), (1, 4)] and cut(8, 4) == [(0, 4), (4, 4)]


def check(rows, got, size):
    ids = {d: [*TRUE.encode(t or "", add_special_tokens=False).ids, 2] for d, t in rows}
    assert {(g.doc_id, g.start, g.length) for g in got} == {(d, s, n) for d, x in ids.items() for s, n in cut(len(x), size)}
    for g in got:
        assert zlib.crc32(np.array(ids[g.doc_id][g.start : g.start + g.length], "<u4").tobytes()) == g.ids_crc32
    by = {}
    for g in got:
        by.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for places in by.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(n for _, n in places) <= size
    return len(by)


ROWS = [(1, None), (2, ""), (None, "no id"), (3, "word " * 700), (4, "x y z " * 100), *((i, "a b " * (i % 37)) for i in range(5, 120))]


@pytest.mark.parametrize("shard", [20, 50_000])
def test_documents(docs, shard):
    n = check(ROWS, pack_documents(docs(ROWS), PATH, 128, 2, shard).collect(), 128)
    total = sum(len(TRUE.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ROWS)
    assert n <= -(-total // 128) + (8 if shard == 20 else 1)


def test_repeated_rows_are_all_packed(docs):
    assert pack_documents(docs([(1, "a b"), (1, "a b"), (None, None), (None, None)]), PATH, 16).count() == 4


def test_empty_table(docs):
    assert pack_documents(docs([]), PATH).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op5_packing"](spark, sf).collect()
    n = check(rows, got, 1024)
    assert n <= -(-sum(g.length for g in got) // 1024) + 1
