"""Joins of term sets by counts in workers: against all pairs, in small blocks and pieces, and what they write."""

import itertools
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from skytally.operators import overlaps as ov
from skytally.operators import similarity as sm
from skytally.session import shared_dir


def _dice(a, b):
    return 2.0 * len(set(a) & set(b)) / (len(a) + len(b))


def _sets(rnd, n, words):
    """Sets of terms, some of which are in most of them; a term may come twice."""
    weights = [1 / (k + 1) for k in range(len(words))]
    return [rnd.choices(words, weights, k=rnd.randint(1, 9)) for _ in range(n)]


@pytest.mark.parametrize("limits", [(1 << 20, 1 << 22, 256), (40, 1 << 22, 3), (40, 50, 256), (1, 1, 0)])
def test_block_equals_all_pairs(monkeypatch, limits):
    for name, value in zip(("LOOKUPS", "CELLS", "FREQUENT"), limits, strict=True):
        monkeypatch.setattr(ov, name, value)
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(30)] + [""]
    known, rows = _sets(rnd, 50, words), _sets(rnd, 90, [*words, *(f"x{k}" for k in range(9))])
    scopes, own = [rnd.choice("ab") for _ in known], [rnd.choice("abc") for _ in rows]
    text = lambda sets: pa.array([" ".join(x) for x in sets])
    block = ov.Block.of(pa.array(range(len(known))), text(known), pa.array(scopes))
    for threshold in (0.2, 0.4, 0.75, 1.0):
        i, j, s = block.matches(text(rows), pa.array(own), threshold)
        pairs = ((a, b, _dice(rows[a], known[b])) for a, b in itertools.product(range(len(rows)), range(len(known))) if own[a] == scopes[b])
        want = {(a, b): d for a, b, d in pairs if d >= threshold}
        assert len(i) == len(want) and dict(zip(zip(i.tolist(), j.tolist(), strict=True), s.tolist(), strict=True)) == want
    assert [len(x) for x in block.matches(pa.array([], pa.string()), pa.array([], pa.string()), 0.5)] == [0, 0, 0]


def test_frequent_terms_behind_the_rare_ones_make_no_candidates(monkeypatch):
    block = ov.Block.of(pa.array(range(1000)), pa.array([f"r{k} a b c" for k in range(1000)]), pa.array([""] * 1000))
    looked_up, real = [], block._pieces
    monkeypatch.setattr(block, "_pieces", lambda row, number, *later: looked_up.append(int(np.diff(block.starts)[number].sum())) or real(row, number, *later))
    i, j, s = block.matches(pa.array(["r7 a b c", "r8 a b z"]), pa.array(["", ""]), 1.0)
    assert (i.tolist(), j.tolist(), s.tolist()) == ([0], [7], [1.0]) and looked_up == [1]


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_joins_in_blocks_keep_null_and_repeated_ids(spark, monkeypatch, block):
    monkeypatch.setattr(sm, "BLOCK", block)
    rnd = random.Random(6)
    make = lambda n: [(rnd.choice([None, *range(12)]), rnd.choice([None, "s", "t"]), rnd.choice([None, [], [None], [""]]) if rnd.random() < 0.2 else sorted({*rnd.choices("abcdefgh", k=4)})) for _ in range(n)]
    left, right = make(60), make(50)
    l, r = (spark.createDataFrame(x, "i int, e string, termos array<string>") for x in (left, right))
    full = lambda x: x and any(x)
    want = sorted(((i, j, _dice(a, b)) for (i, _, a), (j, _, b) in itertools.product(left, right) if full(a) and full(b) and _dice(a, b) >= 0.6), key=str)
    assert sorted((tuple(x) for x in sm.dice_join(l, "i", r.withColumnRenamed("i", "j"), "j", threshold=0.6).collect()), key=str) == want
    best = []
    for i, e, a in left:
        near = [(-_dice(a, b), min((k for k, f, c in right if (f or "") == (e or "") and c == b and k is not None), default=None)) for _, f, b in right if (f or "") == (e or "") and full(a) and full(b) and _dice(a, b) >= 0.6]
        if near:
            s, k = min(near, key=lambda x: (x[0], x[1] is not None, x[1] or 0))
            best.append((i, k, -s))
    got = [tuple(x) for x in sm.best_match(l, "i", r, "i", threshold=0.6, scope="e").collect()]
    assert sorted(got, key=str) == sorted(best, key=str) and best


def test_candidates_are_not_written(spark):
    """Sets that share three frequent terms of ten: 1.2 million pairs to look at, 40 of which match."""
    own = "concat(array('da', 'de', 'do'), transform(sequence(1, 7), k -> concat({}, '_', k))) AS termos"
    left = spark.range(4000).selectExpr("id", own.format("'e', id"))
    right = spark.range(300).selectExpr("id AS j", own.format("if(id < 40, 'e', 'c'), id * 3"))
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def written() -> int:
        files, kept = disk.getAllFiles(), shared_dir(spark).removeprefix("file:")
        return sum(files.apply(k).length() for k in range(files.size())) + sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(kept) for f in names)

    before = written()
    got = {(r.id, r.conhecida): r.semelhanca for r in sm.dice_join(left, "id", right, "j", threshold=0.4).collect()}
    assert got == {(3 * k, k): 1.0 for k in range(40)}
    assert written() - before < 1_000_000
