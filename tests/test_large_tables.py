"""Checksums of two tables, distinct states, the refreshed cube and files on a curve."""

import os
import random

import pytest
from pyspark.sql import functions as F

from skytally.functions.metrics import CUBE_KEYS, MEASURES
from skytally.operators.distinct import distinct_counts, distinct_state, merged_states, sketch_counts, sketch_state
from skytally.operators.reconcile import differing_rows, reconcile, reconcile_differences
from skytally.plans.refresh import refresh_cube, refreshed_cube
from skytally.sources.export import curve_position, files_touched, write_on_curve


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_differences_found_and_little_else_joined(spark):
    r = random.Random(3)
    left = [(i, f"k{i % 7}", r.randint(0, 99)) for i in range(20_000)] + [(None, "n", 5), (None, None, 6), (5, "twice", 1), (5, "twice", 2)]
    right = [(i, k, v + (1 if i is not None and i % 4000 == 17 else 0)) for i, k, v in left if i is None or i % 5000 != 3] + [(-1, "new", None)]
    a, b = (spark.createDataFrame(x, "id long, k string, v long") for x in (left, right))
    differs = lambda df: df.where("presenca != 'ambos' OR NOT v_esquerda <=> v_direita")
    assert rows_of(reconcile_differences(a, b, ["id", "k"], ["v"])) == rows_of(differs(reconcile(a, b, ["id", "k"], ["v"])))
    some = differing_rows(a, b, ["id", "k"], ["v"])
    assert all(df.count() < 40 for df in some)
    assert reconcile_differences(a, a.repartition(3), ["id", "k"], ["v"]).isEmpty() and reconcile_differences(a.limit(0), b.limit(0), ["id", "k"], ["v"]).isEmpty()
    assert reconcile_differences(a, a.withColumn("v", F.col("v").cast("int")), ["id", "k"], ["v"]).isEmpty()


def test_distinct_states_add_up(spark):
    r = random.Random(4)
    rows = [(r.choice("abc"), r.choice([1, 2, None]), r.choice([None, *range(300)]), r.choice("xyz")) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, h int, v int, w string")
    values = {"v": F.col("v"), "w": F.when(F.col("h") == 1, F.col("w"))}
    halves = [distinct_state(df.where(F.col("v").isNull() | (F.col("v") % 2 == k)), ["g", "h"], values) for k in (0, 1)]
    state = merged_states(halves)
    want = df.groupBy("g").agg(F.count_distinct("v").alias("v"), F.count_distinct(values["w"]).alias("w"))
    assert rows_of(distinct_counts(state, ["g"], ["v", "w"])) == rows_of(want)
    assert rows_of(distinct_counts(state, [], ["v"])) == [(len({x[2] for x in rows} - {None}),)]
    assert "Expand" not in distinct_counts(distinct_state(df, ["g"], values), ["g"], ["v", "w"])._jdf.queryExecution().executedPlan().toString()
    for x in sketch_counts(sketch_state(df, ["g", "h"], values), ["g"], ["v", "w"]).join(want.withColumnsRenamed({"v": "xv", "w": "xw"}), "g").collect():
        assert abs(x.v - x.xv) <= 0.025 * x.xv + 1 and x.w == x.xw


def cube(spark, rows):
    df = spark.createDataFrame(rows, "ano_mes string, voos long")
    return df.select(*[F.col("ano_mes") if k == "ano_mes" else F.lit(None).cast("string").alias(k) for k in CUBE_KEYS], *[F.col("voos") if m == "voos" else F.lit(1).cast("long").alias(m) for m in MEASURES])


def test_refresh_writes_touched_months_alone_and_repeats(spark, tmp_path):
    path = str(tmp_path)
    lots = [[("2024-01", 5), ("2024-02", 7), (None, 1)], [("2024-02", 2), ("2024-03", 4)], [("2024-01", 3)]]
    assert refresh_cube(cube(spark, lots[0]), path, 0) == [None, "2024-01", "2024-02"]
    month = lambda m: sorted(f for f in os.listdir(tmp_path / "fato" / f"ano_mes={m}") if f.endswith(".parquet"))
    first = month("2024-01")
    assert refresh_cube(cube(spark, lots[1]), path, 1) == ["2024-02", "2024-03"] and month("2024-01") == first
    for _ in range(2):  # a batch that runs again changes nothing
        assert refresh_cube(cube(spark, lots[2]), path, 2) == ["2024-01"] and month("2024-01") != first
    read = lambda: {r.ano_mes: (r.voos, r.realizados) for r in refreshed_cube(spark, path, cube(spark, lots[0])).collect()}
    assert read() == {None: (1, 1), "2024-01": (8, 2), "2024-02": (9, 2), "2024-03": (4, 1)}
    assert refresh_cube(cube(spark, [("2024-03", 9)]), path, 1) == ["2024-02", "2024-03"]  # a corrected batch
    assert read()["2024-02"] == (7, 1) and read()["2024-03"] == (9, 1)
    assert refresh_cube(cube(spark, lots[0]).limit(0), path, 9) == []


@pytest.mark.parametrize("kind", ["skewed", "text"])
def test_filters_on_either_column_skip_files(spark, tmp_path, kind):
    r = random.Random(5)
    rows = [(int(2 ** r.uniform(0, 40)), f"{r.choice('abcdefgh')}{r.randint(0, 999)}" if kind == "text" else f"{r.randint(0, 10**6):06d}") for _ in range(8000)]
    df = spark.createDataFrame(rows + [(None, None)] * 5, "n long, t string")
    write_on_curve(df, str(tmp_path / "z"), ["n", "t"], files=16)
    assert spark.read.parquet(str(tmp_path / "z")).exceptAll(df).isEmpty() and spark.read.parquet(str(tmp_path / "z")).count() == 8005
    for c in ("n", "t"):
        v = sorted(x[c == "t"] for x in rows)
        hit, n = files_touched(spark, str(tmp_path / "z"), c, v[3000], v[3400])
        assert n >= 12 and hit <= 8, (c, hit, n)


def test_place_on_curve(spark):
    df = spark.createDataFrame([(x, y) for x in range(16) for y in range(16)], "x long, y long")
    got = {(r.x, r.y): r.p for r in df.select("*", curve_position(df, ["x", "y"], 4).alias("p")).collect()}
    weave = lambda x, y: sum(((x >> k & 1) << 2 * k + 1) | ((y >> k & 1) << 2 * k) for k in range(4))
    order = sorted(got, key=got.get)
    assert len(set(got.values())) > 150 and sum(abs(order.index(p) - weave(*p)) for p in got) / 256 < 40
