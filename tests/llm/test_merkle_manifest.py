"""Merkle manifest against a plain tree, with repeated, missing, sparse and negative ids."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from skytally.llm.merkle_manifest import directory, leaves, manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(s):
    return sha256(s.encode()).hexdigest()


def leaf(*fields):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    """Root, and for each leaf what stands left and right of its path, bottom up."""
    paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = range(0, len(nodes), 8)
        for at in runs:
            run = nodes[at : at + 8]
            for j in range(len(run)):
                for x in under[at + j]:
                    paths[x].append(("".join(run[:j]), "".join(run[j + 1 :])))
        nodes, under = [h("".join(nodes[i : i + 8])) for i in runs], [sum(under[i : i + 8], []) for i in runs]
    return nodes[0], paths


def brute(rows):
    trees = defaultdict(list)
    for doc, source, lang, n, text in rows:
        lower = text.translate({c: c + 32 for c in range(65, 91)}) if text is not None and doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 else text
        trees[lang].append((doc is not None, doc or 0, leaf(doc, source, lang, n, text), leaf(doc, source, lang, n, lower)))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    subs = {x: tree([r[2] for r in sorted(trees[x])]) for x in langs}
    root, tops = tree([subs[x][0] for x in langs])
    out = []
    for lang, top in zip(langs, tops):
        for (known, doc, own, forged), path in zip(sorted(trees[lang]), subs[lang][1]):
            folded = forged
            for left, right in path + top:
                folded = h(left + folded + right)
            out.append((doc if known else None, lang, own, subs[lang][0], root, h("".join(a + b for a, b in path + top)), folded, folded == root))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("tree", "at", "total", "hash", "leaf", "word", "row")})
    return sorted((tuple(r) for r in manifest(df).collect()), key=str)


@pytest.mark.parametrize("n", [1, 9, 64, 513, 5000])
def test_one_language_of_each_size(spark, n):
    rows = [(i * 7 - 100, "s", "en", i, f"Text {i}") for i in range(n)]
    random.Random(n).shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_odd_ids_and_many_languages(spark):
    r = random.Random(3)
    ids = [None, 5, 5, 7, -3, 2**62, -(2**63), 2**63 - 1]
    rows = [(r.choice([*ids, r.randint(-(10**12), 10**12), r.randint(0, 600), r.randint(0, 600)]), r.choice([None, "s", ""]), r.choice([None, "", "a", "b", "é", *(f"x{i}" for i in range(70))]), r.choice([None, 3]), r.choice([None, "", "Abc", "abc", "É x", "T" * 50_000]))
            for _ in range(2500)]
    assert run(spark, rows) == brute(rows)


def test_a_third_of_the_rows_share_id_and_text(spark):
    rows = [(1, "s", "en", 1, "Same")] * 400 + [(1, "s", "en", 1, f"Text {i}") for i in range(400)] + [(i, "s", "en", 1, "T") for i in range(400)]
    assert run(spark, rows) == brute(rows)


def test_directory_keeps_words_with_rows_only(spark):
    rows = [(i, "s", "en", 1, "t") for i in (0, 63, 64, 1 << 40, -1, 1 << 62)]
    got = {r.word: (bin(r.bits & (2**64 - 1)).count("1"), r.before, r.total) for r in directory(leaves(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == {-1: (1, 0, 6), 0: (2, 1, 6), 1: (1, 3, 6), 1 << 34: (1, 4, 6), 1 << 56: (1, 5, 6)}


def test_empty_table(spark):
    assert run(spark, []) == []
