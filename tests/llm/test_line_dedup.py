"""Line removal against brute force."""

import random
import re

import pytest

from skytally.llm.line_dedup import dedup_lines


def brute(rows, window):
    first = {}
    worded = lambda k: re.search(r"[^\x20\x09-\x0D]", "".join(k))
    for doc, text in rows:
        lines = [] if doc is None or text is None else text.split("\n")
        for i in range(len(lines) - window + 1):
            k = tuple(lines[i : i + window])
            if worded(k):
                first[k] = min(first.get(k, (doc, i)), (doc, i))
    out = []
    for doc, text in rows:
        lines, gone = [] if text is None else text.split("\n"), set()
        for i in range(len(lines) - window + 1):
            k = tuple(lines[i : i + window])
            if doc is not None and worded(k) and first[k] < (doc, i):
                gone |= set(range(i, i + window))
        out.append((doc, None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return sorted(out, key=str)


def some(seed):
    r = random.Random(seed)
    return [(i, "\n".join(r.choice(["a", "b", "c", "", " ", "d" * 3, f"own {i} {j}", f"line {j}"]) for j in range(r.randint(0, 14)))) for i in range(60)]


ODD = [(100, None), (101, ""), (102, "\n\n\n\n"), (103, "x\ny\nz"), (103, "x\ny\nz"), (None, "x\ny\nz"), (104, "x\ny\nz"), (105, "q\nx\ny\nz\nr"), (106, "s\n" * 500), (107, "long " * 30_000), (108, "é\né\né\né")]


@pytest.mark.parametrize("window", [3, 2])
def test_equals_brute_force(spark, window):
    rows = some(window) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS same", "1 AS starts", "2 AS row", "3 AS n_lines", "4 AS cut", "5 AS at")
    got = dedup_lines(df, window)
    assert got.columns == ["doc_id", "text", "same", "starts", "row", "cut", "at", "n_lines", "n_removed"]
    assert {(r.same, r.starts, r.row, r.cut, r["at"]) for r in got.collect()} == {("k", 1, 2, 4, 5)}
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=str) == brute(rows, window)


def test_empty_table(docs):
    assert dedup_lines(docs([])).count() == 0
