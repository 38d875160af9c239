"""Substring removal against brute force."""

import hashlib
import random
import re

import pytest

from skytally.llm.queries import QUERIES
from skytally.llm.substring_dedup import dedup_substrings, remove_passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    first = {}
    for doc, text in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if doc is not None:
                first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, text in rows:
        w = WORD.findall(text or "")
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), None if text is None else " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def some(seed, n=40):
    r = random.Random(seed)
    shared = [" ".join(r.choice("abcdefgh") * r.randint(1, 2) for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [" ".join(r.choice(["ä", "bb", "c", "dd", "e", "中"]) + str(r.randint(0, 50)) for _ in range(r.randint(0, 70))) for _ in range(3)]
        parts.insert(r.randint(0, 3), r.choice(shared)[r.randint(0, 40) :])
        rows.append((i, r.choice([" ", "\n", "\t ", "  "]).join(parts)))
    return rows


ODD = [
    (100, None), (101, ""), (102, " \n\t"), (103, "one two"), (None, "a b c d e f g h i j k l"), (104, "a b c d e f g h i j k l"),
    (105, "a b c d e f g h i j k l"), (105, "a b c d e f g h i j k l"), (106, "a b c d e f g h i j k l m n"), (106, "z z a b c d e f g h i j k l"),
    (107, "x " * 3000), (108, "x " * 2000 + "y"), (109, "w" * 50_000), (110, "w" * 50_000),
]


@pytest.mark.parametrize("window,gram,hot", [(10, 3, 4096), (10, 8, 3), (50, 8, 2), (5, 5, 4096)])
def test_equals_brute_force(docs, window, gram, hot):
    rows = some(window) + ODD
    assert got(dedup_substrings(docs(rows), window, gram, hot)) == brute(rows, window)


def test_remove_passages_keeps_white_space_and_columns(docs):
    p = " ".join("abcdefghij")
    rows = [(1, p), (2, "\n x\ty\n" + p + "  z\n"), (3, " k\n"), (4, None), (None, p), (5, p)]
    df = docs(rows)
    got = remove_passages(df, 10, 3)
    assert got.columns == [*df.columns, "n_removed"]
    want = {(1, p, 0), (2, "\n x\ty\nz\n", 10), (3, " k\n", 0), (4, None, 0), (None, p, 0), (5, "", 10)}
    assert {(r.doc_id, r.text, r.n_removed) for r in got.collect()} == want
    assert {(r.lang, r.bucket, r.same, r.n, r.part, r.component_id) for r in got.collect()} == {("x", 1, "y", 2, 3, "z")}


def test_empty_table(docs):
    assert got(dedup_substrings(docs([]))) == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute(rows, 50)]
    df = QUERIES["op7_substring_dedup"](spark, sf)
    assert sorted(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()) == sorted(want)
