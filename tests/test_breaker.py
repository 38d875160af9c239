"""The breaker in stretches, and in batches by event time, against a plain loop."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytally.operators.breaker import NONE, blocking_breaker, stretch_map, through




def plain(calls, failures, pause, state=(0, NONE)):
    """calls: (time, bad); the states behind them and which are blocked."""
    count, until, out = *state, []
    for t, bad in calls:
        blocked = t < until
        if not blocked:
            count = count + 1 if bad else 0
            if count >= failures:
                until, count = t + pause, failures - 1
        out.append((blocked, count, until))
    return out


@pytest.mark.parametrize("failures", [1, 2, 3])
def test_maps_of_stretches(failures):
    r = random.Random(failures)
    for _ in range(400):
        calls = sorted((r.randint(100, 100 + r.choice([5, 60])), r.random() < r.choice([0.3, 0.9])) for _ in range(r.randint(1, 25)))
        m = stretch_map(np.array([t for t, _ in calls]), np.array([b for _, b in calls]), failures, 12)
        for state in [*((c, NONE) for c in range(failures)), *((failures - 1, u) for u in range(90, calls[0][0] + 13))]:
            assert through(state, m) == plain(calls, failures, 12, state)[-1][1:]


START = dt.datetime(2024, 1, 1)


def some(n=3000, users=6):
    r = random.Random(5)
    rows = [(i, r.choice([1, 1, 1, *range(users)]), START + dt.timedelta(seconds=r.randint(0, 20_000)), r.random() < 0.6) for i in range(n)]
    return rows + [(n + i, k, t, True) for i, (k, t) in enumerate([(None, START), (1, None), (None, None)])] + [(n + 9, 99, START, None)]


def expected(rows, pause=300):
    out = {i: (k, bool(bad), None, None, None) for i, k, t, bad in rows if k is None or t is None}
    for user in {r[1] for r in rows if r[1] is not None}:
        mine = sorted((t, i, bool(bad)) for i, k, t, bad in rows if k == user and t is not None)
        base = [(int((t - START).total_seconds()), bad) for t, _, bad in mine]
        for (t, i, bad), (blocked, count, until) in zip(mine, plain(base, 3, pause)):
            out[i] = (user, bad, blocked, count, None if until == NONE else START + dt.timedelta(seconds=until))
    return out


def flat(df):
    return {r.id: (r.who, r.falhou, r.bloqueada, r.falhas, r.pausa_ate) for r in df.collect()}


@pytest.mark.parametrize("stretch", [0, 1000, 100_000])
def test_equals_loop(spark, stretch):
    rows = some()
    df = spark.createDataFrame(rows, "id long, who long, at timestamp, bad boolean").repartition(5)
    assert flat(blocking_breaker(df, "who", "at", "id", F.col("bad"), 3, 300, stretch)) == expected(rows)


def test_state_from_before(spark):
    rows = [(1, 7, START, True), (2, 8, START, True), (3, 9, START, False)]
    df = spark.createDataFrame(rows, "id long, who long, at timestamp, bad boolean")
    before = spark.createDataFrame([(7, 2, None), (8, 2, START + dt.timedelta(seconds=9))], "who long, falhas int, pausa timestamp")
    got = flat(blocking_breaker(df, "who", "at", "id", F.col("bad"), before=before))
    assert got == {1: (7, True, False, 2, START + dt.timedelta(seconds=300)), 2: (8, True, True, 2, START + dt.timedelta(seconds=9)), 3: (9, False, False, 0, None)}


def test_empty_table(spark):
    assert blocking_breaker(spark.createDataFrame([], "id long, who long, at timestamp, bad boolean"), "who", "at", "id", F.col("bad")).count() == 0


def test_stream_of_shuffled_batches(spark, tmp_path):
    """Files hold calls up to 2,000 s out of order; within the delay nothing is late, with none some are, and are marked."""
    from skytally.streaming.limits import breaker_stream
    from skytally.streaming.loads import stream_table

    rows, r = some(600), random.Random(8)
    lot = lambda t: 0 if t is None else min(4, int(((t - START).total_seconds() + r.randint(0, 2000)) // 4500))
    lots = [lot(x[2]) for x in rows]
    for n in range(5):
        spark.createDataFrame([x for x, k in zip(rows, lots) if k == n], "id long, who long, at timestamp, bad boolean").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: stream_table(spark, str(tmp_path / "in"), maxFilesPerTrigger=1)
    got = breaker_stream(stream(), "who", "at", "id", F.col("bad"), delay=6600)
    assert flat(got) == expected(rows) and got.where("tardia").isEmpty()
    hasty = breaker_stream(stream(), "who", "at", "id", F.col("bad"), str(tmp_path / "out"), delay=0).collect()
    late = [x for x in hasty if x.tardia]
    assert len(hasty) == len(rows) and late and all(x.bloqueada is None for x in late)
    judged = {x.id for x in hasty if not x.tardia}
    assert {x.id: (x.who, x.falhou, x.bloqueada, x.falhas, x.pausa_ate) for x in hasty if not x.tardia} == expected([x for x in rows if x[0] in judged])
    assert len(list((tmp_path / "out" / "estado").iterdir())) == 2
