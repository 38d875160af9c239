"""Near duplicates against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from skytally.llm.near_dedup import BANDS_80, BANDS_85, _minima, estimates, near_duplicates, pack_bits, shingle_sets
from skytally.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent):
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in rows if d is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = sorted((top(a), top(b)))
                up[v] = u
    return sorted([(d, len(s), None if d is None else top(d), d is None or top(d) == d) for d, s in sets], key=str)


def got(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()], key=str)


def some(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "Be", "ça", "d", "中e"]) + str(r.randint(0, 300))
    rows, n = [], 1000
    for size in (8, 12, 40, 120, 400):
        base = [word() for _ in range(size)]
        for _ in range(12):
            w = list(base)
            for _ in range(r.randint(0, max(1, size // 40))):
                w[r.randrange(len(w))] = word()
            if r.random() < 0.3:
                w = [x.upper() for x in w]
            rows.append((n - r.randint(0, 0) - len(rows), r.choice([" ", "\n"]).join(w)))
    return rows


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (6, "two one"), (None, "one two"), (None, None), (7, "a b c d e"), (7, "a b c d e"),
       (8, "A B C D E"), (9, "z " * 5000), (10, "z " * 9000), (11, "w" * 100_000), (12, "É é é é é é"), (13, "é é é é é é")]


@pytest.mark.parametrize("percent,bands,block", [(85, BANDS_85, 1 << 18), (80, BANDS_80, 300)])
def test_equals_brute_force(docs, percent, bands, block):
    rows = some(percent) + ODD
    assert got(near_duplicates(docs(rows), percent, bands=bands, block=block)) == brute(rows, percent)


def test_empty_table(docs):
    assert got(near_duplicates(docs([]))) == []


def test_one_doc_id_with_two_texts_never_fails(docs):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    assert len(got(near_duplicates(docs([(1, a), (1, b), (2, a + " x"), (3, b + " y")])))) == 4


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(1)
    low = rng.integers(0, 1 << 32, (400, 288), np.uint32)
    packed = pack_bits(low)
    assert abs(estimates(packed[0], packed[1:], 288).mean()) < 0.01
    assert estimates(packed[0], packed[:1], 288)[0] == 1


def test_link_with_a_low_estimate_is_found(docs):
    r = random.Random(949)
    w = [f"w{r.randrange(10**9)}" for _ in range(128)]
    rows = [(1, " ".join(w[:116])), (2, " ".join(w[:104] + w[116:]))]
    one, two = (pack_bits(_minima([s], BANDS_80.hashes)) for s in next(shingle_sets(pa.array([t for _, t in rows]), 5)))
    assert estimates(one[0], two, BANDS_80.hashes)[0] < 0.7
    assert [r[2] for r in got(near_duplicates(docs(rows), 80, bands=BANDS_80))] == [1, 1]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = QUERIES["op2_near_dedup"](spark, sf)
    assert got(df) == brute(rows, 85)


def test_rows_of_one_doc_id_are_judged_by_their_own_text(docs):
    a, b = ([f"{x}{i}" for i in range(100)] for x in "ab")
    other = lambda w: " ".join([*w[:-1], "x"])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (3, other(a)), (9, other(b)), (5, None), (4, "few words"), (5, "few words")]
    assert got(near_duplicates(docs(rows))) == sorted([(5, 96, 3, False), (5, 96, 5, True), (3, 96, 3, True), (9, 96, 5, False), (5, 0, 5, True), (4, 1, 4, True), (5, 1, 4, False)], key=str)
