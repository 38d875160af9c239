"""Steps that must not be repeated or widened as tables grow: each test builds its own rows."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from skytally.functions.metrics import CUBE_KEYS, MEASURES
from skytally.operators import similarity as sm
from skytally.plans import star
from skytally.plans.refresh import refresh_cube, refreshed_cube
from skytally.session import shared_dir
from skytally.workload import stream_queries as sq
from skytally.workload import tables as t


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Small tables with missing and unknown keys."""
    at, r, day = str(tmp_path_factory.mktemp("sf")), random.Random(8), dt.datetime(2024, 1, 30)
    tables = {
        "region": ([(i, f"REG{i}") for i in range(3)], "r_regionkey int, r_name string"),
        "nation": ([(i, f"N{i}", i % 3) for i in range(8)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(i, f"S{i}", r.randrange(8), float(i - 3)) for i in range(1, 12)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "customer": ([(i, f"C{i}", r.randrange(8)) for i in range(1, 30)], "c_custkey long, c_name string, c_nationkey int"),
        "orders": ([(i, r.randint(1, 33), day + dt.timedelta(days=r.randrange(60)), "1-URGENT") for i in range(1, 120)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(r.choice([None, *range(1, 124)]), r.randint(1, 50), r.choice([None, *range(1, 14)]), n % 7 + 1, r.choice("RAN"), r.choice("OF"), day + dt.timedelta(days=r.randrange(70))) for n in range(900)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def bag(df):
    return sorted((str(tuple(r)) for r in df.collect()))


@pytest.fixture
def passes(monkeypatch):
    """Calls of ``tables.flights``."""
    calls, real = [], t.flights
    monkeypatch.setattr(t, "flights", lambda *a, **kw: calls.append(kw) or real(*a, **kw))
    return calls


def test_routes_of_the_stored_cube_come_from_its_sums(spark, sf, passes):
    cube = t.stored_cube(spark, sf)
    assert len(passes) == 2  # the cube and its months
    assert bag(cube.rota) == bag(t.rota(spark, sf)) and cube.rota.dtypes == t.rota(spark, sf).dtypes


def test_refresh_writes_parcels_and_months_alone(spark, tmp_path):
    row = lambda m, e, n: tuple({"ano_mes": m, "icao_empresa": e}.get(k) for k in CUBE_KEYS) + (n,) * len(MEASURES)
    kinds = ", ".join([f"{k} {'boolean' if k == 'fim_de_semana' else 'string'}" for k in CUBE_KEYS] + [f"{m} long" for m in MEASURES])
    cube = lambda rows: spark.createDataFrame([row(*x) for x in rows], kinds)
    first, second = cube([("2024-01", f"E{i}", i) for i in range(300)] + [(None, None, 1)]), cube([("2024-01", f"E{i}", 1) for i in range(0, 300, 3)] + [(None, None, 5)])
    base = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    for n, lot in ((0, first), (1, second), (1, second)):
        refresh_cube(lot, str(tmp_path), n)
    assert set(os.listdir(base)) == before
    got = {(r.ano_mes, r.icao_empresa): (r.voos, r.soma_duracao) for r in refreshed_cube(spark, str(tmp_path), first).collect()}
    assert got == {(None, None): (6, 6), **{("2024-01", f"E{i}"): (i + (i % 3 == 0),) * 2 for i in range(300)}}


def test_sets_of_terms_are_written_once(spark, monkeypatch):
    names, real = [], sm.stored
    monkeypatch.setattr(sm, "stored", lambda df, name: names.append(name) or real(df, name))
    left = spark.createDataFrame([(i, ["a", "b", f"c{i % 4}"]) for i in range(20)] + [(90, []), (91, None)], "i long, termos array<string>")
    right = spark.createDataFrame([(1, ["a", "b", "c1"]), (2, ["b", "z"])], "j long, termos array<string>")
    assert {(r.id, r.conhecida): r.semelhanca for r in sm.dice_join(left, "i", right, "j", threshold=0.9).collect()} == {(i, 1): 1.0 for i in range(1, 20, 4)}
    assert names.count("conjuntos") == 2 and names.count("termos") == 2


def test_star_reads_flights_once_for_codes_and_calendar(spark, sf, passes):
    dims = t.dims(spark, sf)
    assert len(passes) == 1
    assert bag(dims["tempo"]) == bag(star.build_dim_tempo(t.flights(spark, sf, origin=False, destination=False)))


@pytest.mark.parametrize("build", ["fact", "obt"])
def test_flights_are_numbered_while_narrow(spark, sf, monkeypatch, build):
    seen, real = [], star.surrogate_key
    monkeypatch.setattr(star, "surrogate_key", lambda df, name, *a, **kw: seen.append((name, df.columns)) or real(df, name, *a, **kw))
    d = t.dims(spark, sf)
    out = t.fact(spark, sf, d, numbered=True) if build == "fact" else t.obt(spark, sf, numbered=True)
    columns = next(c for n, c in seen if n == "id_voo")
    assert not {"flag_realizado", "periodo_partida", "duracao_voo_min", "sk_empresa"} & set(columns)
    plain = t.fact(spark, sf, d) if build == "fact" else t.obt(spark, sf)
    assert bag(out.drop("id_voo")) == bag(plain) and out.columns[0] == "id_voo"
    rows = out.orderBy("id_voo").collect()
    assert [r.id_voo for r in rows] == list(range(1, len(rows) + 1))
    key = lambda r: ((r.data_partida_prevista is not None, r.data_partida_prevista), r.icao_empresa, r.numero_voo)
    assert [key(r) for r in rows] == sorted((key(r) for r in rows), key=lambda k: (k[0][0], k[0][1] or dt.date.min, k[1:]))


def test_each_lot_of_calls_has_as_many_files_as_cores(spark, tmp_path):
    calls = spark.range(6000).repartition(3)
    lot = F.col("id") % 6
    files = sq._files_per_lot(calls, lot)
    assert files == spark.sparkContext.defaultParallelism
    for n in range(6):
        calls.where(lot == n).repartition(files).write.parquet(f"{tmp_path}/{n}")
        assert sum(f.endswith(".parquet") for f in os.listdir(tmp_path / str(n))) == files
    assert sq._files_per_lot(spark.range(12), lot) == 1 and sq._files_per_lot(spark.range(5000), F.col("id") % 5) == 1
