"""Source audit against plain loops, with small blocks, many sources and every odd value."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skytally.llm import source_audit
from skytally.llm.source_audit import _corrections, divergence, frequencies, share

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")]


def brute(rows, min_docs, top):
    docs, n, out = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        docs[lang or ""].update(set(terms(text)))
        n[lang or "", source or ""].update(terms(text))

    def put(lang, source, part, values, limit=None):
        for i, (item, v) in enumerate(sorted(values, key=lambda x: (-x[1], x[0].encode()))[:limit], 1):
            out.add((lang, source, part, item, v, i))

    for lang in docs:
        kept, sources = [t for t, c in docs[lang].items() if c >= min_docs], [s for x, s in n if x == lang]
        size = {s: sum(n[lang, s][t] for t in kept) for s in sources}
        p = {s: [1 + 10**9 * (n[lang, s][t] + 5) // (size[s] + 5 * len(kept)) for t in kept] for s in sources}
        q = [1 + 10**9 * (sum(n[lang, s][t] for s in sources) + 5) // (sum(size.values()) + 5 * len(kept)) for t in kept]
        for s in sources:
            put(lang, s, "pair", [(o, sum(abs(a - b) for a, b in zip(p[s], p[o]))) for o in sources if o != s])
            put(lang, s, "term", [(t, a - b) for t, a, b in zip(kept, p[s], q) if n[lang, s][t] and a > b], top)
    return out


def some(sources=9, rows=400):
    r = random.Random(4)
    words = [f"{a}{b}" for a in ("Wort", "été", "语", "x", "ZZ", "a") for b in ("a", "É", "bc", "q", "z")]
    mine = lambda s: words[s % 7 : s % 7 + r.randint(1, 20)] or words
    out = []
    for _ in range(rows):
        s = r.randint(0, sources - 1)
        out.append((r.choice([None, "", "de", "en", "en", "en"]), None if s == 3 else f"s{s}", " ".join(r.choice(mine(s)) for _ in range(r.randint(0, 40)))))
    return out + [("fr", "alone", "one two"), ("it", "a", None), ("it", "b", ""), ("it", "c", "12 [] _^"), ("en", "s1", None), ("en", "", "a1b\x00c d"), ("en", None, "Straße" * 3000 + " " + "x " * 50_000)]


def table(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string").withColumns({c: F.lit("z") for c in ("term", "n", "b", "item", "rank", "doc_id")})


@pytest.mark.parametrize("min_docs,top", [(5, 4), (1, 50), (10_000, 50)])
def test_equals_loops(spark, min_docs, top):
    rows = some()
    got = divergence(table(spark, rows), min_docs, top).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == brute(rows, min_docs, top)


def test_small_blocks_and_matrices(spark, monkeypatch):
    """Blocks that spill at every document, and matrices that leave for want of room, give the same rows."""
    rows = some(40)
    one = {tuple(r) for r in frequencies(table(spark, rows), 3).collect()}
    assert one == {tuple(r) for r in frequencies(table(spark, rows)).collect()}
    monkeypatch.setattr(source_audit, "PIECE_BYTES", 7)
    block = source_audit._Block()
    block.add("en", "s", "Aa bb  AA ccccccccccccccc é")
    assert [tuple(x.values()) for b in block.run() for x in b.to_pylist()] == [("en", "", "s", 0, 0), ("en", "aa", "s", 2, 1), ("en", "bb", "s", 1, 1), ("en", "ccccccccccccccc", "s", 1, 1), ("en", "é", "s", 1, 1)]


@pytest.mark.parametrize("cells", [1, 9, 100, 1 << 20])
def test_corrections_in_tiles(monkeypatch, cells):
    monkeypatch.setattr(source_audit, "PAIR_CELLS", cells)
    r = random.Random(1)
    rows = [{"lang": r.choice("ab"), "postings": [{"source": f"s{s}", "p": r.randint(5, 99), "b": s} for s in r.sample(range(8), r.randint(2, 7))]} for _ in range(60)]
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("lang", pa.string()), ("postings", pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("b", pa.int64())])))]))
    want, got = Counter(), Counter()
    for row in rows:
        for x in row["postings"]:
            for y in row["postings"]:
                if x is not y:
                    want[row["lang"], x["source"], y["source"]] += abs(x["p"] - y["p"]) - abs(x["p"] - y["b"]) - abs(x["b"] - y["p"]) + abs(x["b"] - y["b"])
    for b in _corrections(iter([batch])):
        for x in b.to_pylist():
            got[x["lang"], x["source"], x["item"]] += x["value"]
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_share_is_exact_beyond_64_bits(spark):
    n, total, v = 9_876_543_210_123, 98_765_432_101_234_567, 1_234_567
    row = spark.sql(f"SELECT {n}L AS n, {total}L AS t, {v}L AS v").select(share(F.col("n"), F.col("t"), F.col("v"))).first()
    assert row[0] == 1 + 10**9 * (n + 5) // (total + 5 * v)


def test_empty_table(spark):
    assert divergence(table(spark, some()).limit(0)).count() == 0
