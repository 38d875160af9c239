"""Nearest-rank percentiles through sketches, against sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skytally.operators.windows import nearest_rank

P = {"p50": 0.5, "p95": 0.95, "max": 1.0, "min": 0.0}


def plain(values):
    v = sorted(values, key=lambda x: (isinstance(x, float) and math.isnan(x), x))
    return tuple(v[max(1, math.ceil(p * len(v) - 1e-12)) - 1] for p in P.values())


def check(spark, rows, kind, small):
    df = spark.createDataFrame(rows, f"g string, v {kind}").repartition(6)
    got = {r.g: tuple(r[p] for p in P) for r in nearest_rank(df, ["g"], "v", P, small).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert {g: str(x) for g, x in got.items()} == {g: str(plain(v)) for g, v in groups.items()}


@pytest.mark.parametrize("small", [50, 10_000])
def test_tails_hot_values_and_odd_groups(spark, small):
    r = random.Random(6)
    rows = [("bulk", r.choice([r.uniform(0, 20), 7.0, 7.0])) for _ in range(6000)] + [("bulk", 1e8 + i) for i in range(30)] + [("bulk", 1e15)]
    rows += [("one", 3.0)] * 2000 + [(None, float(i)) for i in range(900)] + [("none", None), ("single", -1.5), ("nan", 1.0), *[("nan", math.nan)] * 400, *[("nan", float(-i)) for i in range(500)]]
    r.shuffle(rows)
    check(spark, rows, "double", small)


def test_whole_numbers_beyond_doubles(spark):
    check(spark, [("a", 2**62 + i * 7919 % 3000) for i in range(3000)] + [("b", i % 3) for i in range(500)], "bigint", 40)


def test_brackets_hold_few_rows(spark):
    """Nothing that is left for the last step is large: 20,000 distinct values in 0-20, and tails that stretch any histogram."""
    r = random.Random(7)
    rows = [("g", r.uniform(0, 20)) for _ in range(20_000)] + [("g", 1e8)] * 3 + [("g", 1e15)]
    plan = nearest_rank(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"p50": 0.5}, small=100)
    left = plan._jdf.queryExecution().analyzed().collectLeaves()
    files = [spark.read.parquet(p).count() for p in sorted({f for f in plan.inputFiles() if "restantes" in f})]
    assert left and 0 < sum(files) <= 1200
    assert plan.first().p50 == plain([v for _, v in rows])[0]


def test_empty_and_no_keys(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1000)], "v double")
    assert tuple(nearest_rank(df, [], "v", P, 20).first()) == (499.0, 949.0, 999.0, 0.0)
    assert nearest_rank(df.limit(0), [], "v", P).count() == 0 and nearest_rank(df.withColumn("g", F.lit(1)).limit(0), ["g"], "v", P).count() == 0
