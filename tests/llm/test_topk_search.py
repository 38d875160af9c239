"""Top-k against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytally.llm.topk_search import maxscore, quantized, top_k

SCHEMA = "id long, vector array<long>"


def brute(items, queries, k):
    out = []
    for q, x in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in items.items() if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("low,high,width,rest", [(-40, 40, 16, 0.5), (0, 3, 8, 1.0), (-1, 1, 4, 0.9), (-9, 0, 6, 0.5), (0, 1, 64, 0.7)])
def test_maxscore_equals_brute_force(low, high, width, rest):
    rng = np.random.default_rng(width)
    items, ids = rng.integers(low, high + 1, (400, width)), np.arange(400) * 3
    items[50:120] = items[50]
    q, d, s = maxscore(ids[::20], items[::20], ids, items, 7, rest, step=64)
    want = brute(dict(zip(ids.tolist(), items.tolist())), dict(zip(ids[::20].tolist(), items[::20].tolist())), 7)
    got = sorted((int(ids[::20][a]), int(b), int(c)) for a, b, c in zip(q, d, s))
    assert got == sorted((a, c, e) for a, _, c, e in want)


def test_large_components_stay_exact():
    x = np.array([[2**30, 1], [2**30, 0], [-(2**30), 5]])
    _, d, s = maxscore(np.array([9]), x[:1], np.array([1, 2, 3]), x, 3)
    assert d.tolist() == [1, 2, 3] and s.tolist() == [2**60 + 1, 2**60, -(2**60) + 5]


@pytest.mark.parametrize("shard,block", [(4096, 1024), (7, 2)])
def test_shards_merge(spark, shard, block):
    r = random.Random(1)
    items = {i: [r.randint(-3, 3) for _ in range(5)] for i in range(60)} | {60 + i: [1, 1, 1, 1, 1] for i in range(40)}
    rows = [*items.items(), (0, items[0]), (200, None), (None, [1, 2, 3, 4, 5]), (None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"rank": F.lit(1), "score": F.lit("x"), "shard": F.lit(2), "is_query": F.lit(3)})
    got = top_k(df, df.where("id % 20 = 0"), 6, shard, block)
    assert sorted(tuple(x) for x in got.collect()) == brute(items, {i: v for i, v in items.items() if i % 20 == 0}, 6)


def test_vectors_of_any_size_and_few_items(spark):
    df = spark.createDataFrame([(20, [1, 2, 3]), (1, [5]), (2, []), (3, [0, 0, 0, 9])], SCHEMA)
    got = top_k(df, df.where("id = 20"), 20)
    assert sorted(tuple(x) for x in got.collect()) == [(20, 1, 1, 5), (20, 2, 2, 0), (20, 3, 3, 0)]


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(20, [1])], SCHEMA)
    assert top_k(df, df).count() == top_k(one, df).count() == top_k(df, one).count() == top_k(one, one).count() == 0


def test_quantized(spark):
    rows = [([0.5, -0.01],), (None,), ([1.0, None],), ([float("nan")],), ([float("inf")],), ([],)]
    df = spark.createDataFrame(rows, "v array<float>").select(quantized(F.col("v"), 64).alias("q"))
    assert [r.q for r in df.collect()] == [[32, -1], None, None, None, None, []]
