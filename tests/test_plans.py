import pandas as pd
import pytest
from pyspark.sql import functions as F

from skytally.functions.metrics import MEASURES, METRICS
from skytally.operators import quality as ql
from skytally.plans import cube as cb
from skytally.plans import questions as qs
from skytally.plans.questions import Cube, Place, Question
from skytally.session import new_folder
from skytally.sources import catalog, export, raw
from skytally.streaming import limits, loads
from skytally.workload import tables as t

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


def test_cube_and_base_answer_the_same(spark):
    base = t.cube(spark, SF)
    stored = base.with_parts(fato=cb.additive_cube(t.rows(spark, SF)))
    for ask in (lambda c: qs.cancellation_ranking(c, 10), lambda c: qs.otp_by_month(c, 1), lambda c: qs.direction_compare(c, Place("uf", "R1"), min_flights=5),
                lambda c: qs.measure_query(c, Question("atraso", brand="M0")), qs.weekend_otp, qs.pair_totals):
        assert rows(ask(base)) == rows(ask(stored))


def test_metrics_are_ratios_of_sums(spark):
    base = t.cube(spark, SF).fato
    total = base.agg(*[F.sum(m).alias(m) for m in MEASURES]).first()
    for name, m in METRICS.items():
        want = total[m.num] if m.den is None else m.scale * total[m.num] / total[m.den]
        assert base.agg(m.column()).first()[0] == pytest.approx(want)


def test_series_has_no_month():
    with pytest.raises(ValueError):
        qs.with_changes(Question("voos", series=True), month="2025-08")


def test_city_of_one_airport(spark):
    c = t.cube(spark, SF)
    assert qs.resolve_place(c, Place("municipio", "MUN_5")) == Place("aeroporto", 5)
    assert qs.resolve_place(c, Place("municipio", "MUN_1")).kind == "municipio"


def test_cube_asks_for_parts_late(spark):
    with pytest.raises(ValueError):
        Cube(spark.range(1)).rota
    assert Cube(spark.range(1), empresa=lambda: spark.range(3)).empresa.count() == 3


def test_raw_files(spark, tmp_path):
    w = lambda n, s, e="ISO-8859-1": (tmp_path / n).write_bytes(s.encode(e))
    w("a.csv", 'Atualizado em: 2026-01-01\n"ICAO Empresa Aérea";"Número Voo";"X"\n"AZU";"";"a;b"\nGLO;null;\n')
    w("b.csv", 'Atualizado em: 2026-02-01\n"ICAO Empresa Aérea";"Número Voo";"X";Nova\nTAM;12;é;n\n')
    w("c.csv", 'Atualizado em: 2026-03-01\n"ICAO Empresa Aérea";"Número Voo";"X"\n')
    df = raw.read_raw_layouts(spark, [str(tmp_path / f"{x}.csv") for x in "abc"], encoding="ISO-8859-1")
    assert df.columns[:3] == ["ICAO_Empresa_Aérea", "Número_Voo", "X"]
    got = rows(df.select("ICAO_Empresa_Aérea", "Número_Voo", "X", "Nova"))
    assert got == [("AZU", "", "a;b", "None"), ("GLO", "null", "", "None"), ("TAM", "12", "é", "n")]
    assert df.filter("_source_file IS NULL OR _ingestion_timestamp IS NULL").count() == 0
    assert raw.folder_summary(raw.list_files(spark, str(tmp_path), "*.csv")).first()["arquivos"] == 3
    assert raw.provenance_total(raw.file_provenance(spark, str(tmp_path), "*.csv")).first()["arquivos"] == 3
    assert ("X", "string") in raw.profile_schema(spark, str(tmp_path / "b.csv"), comment="A")


def test_raw_lines(spark, tmp_path):
    (tmp_path / "l.txt").write_text("icao;iata;nome\nAZU;;Azul\nX;Y\n")
    parsed = raw.parse_raw_lines(raw.read_raw_lines(spark, str(tmp_path / "l.txt")), ["icao", "iata", "nome"]).orderBy("linha_id").collect()
    assert [tuple(r)[:4] for r in parsed] == [("icao", "iata", "nome", None), ("AZU", "", "Azul", None), ("X", "Y", None, "X;Y")]


def test_load_is_idempotent_and_skips(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    spark.range(5).write.parquet(src)
    load = lambda **k: loads.load_new_files(spark, src, out, ck, "id long", **k)
    load(), load()
    assert spark.read.parquet(out).count() == 5
    spark.range(5, 8).write.mode("append").parquet(src)
    load(skip_if_loaded=True)
    assert spark.read.parquet(out).count() == 5
    load()
    assert spark.read.parquet(out).count() == 8


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(3, float("nan")), (1, 2.0), (2, None)], "k int, v double")
    info = export.export_table(df, str(tmp_path / "t"), ["k"], files=1)
    assert info["linhas"] == 3 and info["bytes"] > 0 and len(list((tmp_path / "t").glob("*.parquet"))) == 1
    assert export.clean_records(df.orderBy("k"), cap=3)[2] == {"k": 3, "v": None}
    with pytest.raises(ValueError):
        export.clean_records(df, cap=2)
    per_section = export.export_bundle({"a": df, "b": df.limit(1)}, str(tmp_path / "b"))
    assert rows(per_section) == [("a", "3"), ("b", "1")]


def test_catalog(spark):
    name = "t_" + new_folder(spark, "x").rsplit("-", 1)[-1]
    df = spark.createDataFrame([(1, "a")], "id int, nome string")
    assert catalog.save_if_empty(df, name, path=new_folder(spark, "t")) and not catalog.save_if_empty(df, name)
    catalog.apply_comments(spark, name, {"id": "it's the key"}, "tabela")
    catalog.apply_tags(spark, name, {"camada": "gold"})
    cols = catalog.catalog_columns(spark, [name])
    assert tuple(catalog.comment_coverage(cols).first()) == (name, 2, 1, 50.0)
    assert [r["column_name"] for r in catalog.undocumented_columns(cols).collect()] == ["nome"]
    assert catalog.table_tags(spark, name)["camada"] == "gold"
    assert rows(catalog.layer_summary(spark, {"t": name})) == [("t", "1", "2")]


def test_semantic_layer():
    class Table:
        columns = ["a", "b"]

    assert ql.check_semantic_layer({"t": ["a", "c"]}, {"t": Table}) == ["t.c: descrita e inexistente", "t.b: sem descricao"]


def _breaker_loop(data):
    want = []
    for key in sorted({k for k, *_ in data}):
        n, until = 0, None
        for k, ts, ident, bad in sorted(data):
            if k != key:
                continue
            blocked = until is not None and ts < until
            if not blocked:
                n = n + 1 if bad else 0
                if n >= 3:
                    until, n = ts + pd.Timedelta(seconds=300), 2
            want.append((ident, k, ts, bad, blocked, n))
    return sorted(want)


@pytest.mark.parametrize("batches", [1, 3])
def test_breaker_stream_equals_loop(spark, tmp_path, batches):
    """One key with more calls than an Arrow page, written in reverse; ties of time; state from batch to batch."""
    start = pd.Timestamp("2026-01-01")
    data = [(1, start + pd.Timedelta(seconds=40 * (i // 2)), i, i % 7 != 0 and i % 11 != 0) for i in range(12_000)]
    data += [(k, start + pd.Timedelta(seconds=70 * i), 20_000 + 100 * k + i, i % 5 != 0) for k in (2, 3) for i in range(60)]
    data.sort(key=lambda r: r[1])
    size = -(-len(data) // batches)
    for b in range(batches):
        part = pd.DataFrame(data[b * size : (b + 1) * size][::-1], columns=["k", "ts", "id", "bad"])
        spark.createDataFrame(part).coalesce(1).write.parquet(str(tmp_path / "e"), mode="append")
    stream = loads.stream_table(spark, str(tmp_path / "e"), maxFilesPerTrigger=1)
    got = limits.breaker_stream(stream, "k", "ts", "id", F.col("bad")).collect()
    assert sorted((r["id"], r["k"], pd.Timestamp(r["ts"]), r["falhou"], r["bloqueada"], r["falhas"]) for r in got) == [
        (i, k, ts, bad, blocked, n) for i, k, ts, bad, blocked, n in _breaker_loop(data)]


def test_headers_below_any_preamble(spark, tmp_path):
    deep = "\n".join(["Atualizado em: 2024-01-01"] * 9 + ["a;b", "1;2", "3;4;5"])
    (tmp_path / "x y.csv").write_text(deep)
    (tmp_path / "z.csv").write_text("b;c\n6;7\n")
    assert raw.header_of(spark, str(tmp_path / "x y.csv")) == ["a", "b"]
    df = raw.read_raw_layouts(spark, [str(tmp_path / "x y.csv"), str(tmp_path / "z.csv")])
    assert sorted((r.a or "", r.b, r.c or "", r._corrupt or "") for r in df.collect()) == [("", "6", "7", ""), ("1", "2", "", ""), ("3", "4", "", "3;4;5")]
    (tmp_path / "p.csv").write_text("Atualizado em: hoje\n")
    with pytest.raises(ValueError):
        raw.header_of(spark, str(tmp_path / "p.csv"))
    with pytest.raises(ValueError):
        raw.read_raw_csv(spark, [str(tmp_path / "x y.csv"), str(tmp_path / "z.csv")])


def test_quality_stream_keeps_every_row(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(20).write.parquet(src)
    marked = ql.mark_quality(loads.stream_table(spark, src), [("par", F.col("id") % 2 == 0, "impar")])
    good, bad = str(tmp_path / "g"), str(tmp_path / "b")
    loads.split_stream(marked, good, bad, str(tmp_path / "c"))
    assert spark.read.parquet(good).count() == 10 and spark.read.parquet(bad).count() == 10


def test_plan_prunes_and_pushes(spark):
    plan = qs.cancellation_ranking(t.cube(spark, SF, origin=False, destination=False))._jdf.queryExecution().executedPlan().toString()
    assert "customer.parquet" not in plan and "l_extendedprice" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "TakeOrderedAndProject" in plan
