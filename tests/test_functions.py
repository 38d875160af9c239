import datetime as dt

from pyspark.sql import functions as F

from skytally.functions import calendar as cal
from skytally.functions import lexicon as lx
from skytally.functions import text as tx
from skytally.functions import typing as ty
from skytally.functions.geo import distance_band, haversine_km


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_sentinels_and_times(spark):
    c = lambda v: F.lit(v).cast("string")
    row = one(spark, ty.null_if_sentinel(c("null")), ty.null_if_sentinel(c("")), ty.null_if_sentinel(c(""), ("null", "")),
              ty.typed_timestamp(c("2025-08-01 05:10:00")), ty.typed_date(c("2025-08-01 05:10:00")), ty.typed_timestamp(c("x")),
              ty.typed_timestamp(c("01/08/2025 05:10"), "dd/MM/yyyy HH:mm"), ty.decimal_comma(c("393,4")), ty.decimal_comma(c("a")))
    assert row == (None, "", None, dt.datetime(2025, 8, 1, 5, 10), dt.date(2025, 8, 1), None, dt.datetime(2025, 8, 1, 5, 10), 393.4, None)


def test_minutes_truncate(spark):
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    row = one(spark, ty.minutes_between(ts("2025-01-01 00:00:00"), ts("2025-01-01 00:00:59")),
              ty.minutes_between(ts("2025-01-01 00:02:00"), ts("2025-01-01 00:00:30")))
    assert row == (0, -1)


def test_flags_of_missing_delay_are_false(spark):
    d = F.lit(None).cast("long")
    assert one(spark, ty.on_time(d), ty.late(d), ty.plausible(d), ty.implausible(d)) == (False,) * 4
    e = F.lit(15)
    assert one(spark, ty.on_time(e), ty.late(e), ty.late(F.lit(61), 60), ty.plausible(F.lit(-61))) == (True, False, True, False)


def test_keyword_modes(spark):
    s = F.lit("inativa")
    assert one(spark, ty.has_keyword(s, "ATIVA"), ty.has_keyword(s, "ATIVA", "substring"), ty.has_keyword(F.lit("Ativa - OK"), "ATIVA")) == (False, True, True)


def test_validate_code(spark):
    v = lambda s: ty.validate_code(F.lit(s).cast("string"), "^[A-Z]{4}$")
    row = one(spark, v("SBGR"), v("sb"), v(None), v(" "))
    assert [tuple(r) for r in row] == [(True, None), (False, "formato"), (False, "ausente"), (False, "vazio")]


def test_calendar_and_geo(spark):
    d = F.lit("2026-08-01").cast("date")
    row = one(spark, cal.date_key(d), cal.is_weekend(d), cal.season(d), cal.month_label(F.lit(8), F.lit(2026)),
              cal.month_order(F.lit(None).cast("int"), F.lit(None).cast("int")), cal.day_period(F.lit("2026-08-01 11:59:00").cast("timestamp_ntz")))
    assert row == (20260801, True, "inverno", "ago/2026", 999999, "manha")
    km = one(spark, haversine_km(F.lit(-23.4356), F.lit(-46.4731), F.lit(-22.8099), F.lit(-43.2506)))[0]
    assert 330 < km < 345
    none = F.lit(None).cast("double")
    assert one(spark, haversine_km(none, F.lit(0.0), F.lit(0.0), F.lit(0.0)), distance_band(none), distance_band(F.lit(500.0))) == (
        None, "Sem coordenadas", "Media (500-1500km)")


NORMAL = {
    "Qual a pontualidade da GOL em março/2026?": "qual a pontualidade da gol em marco/2026",
    "E às 10:30, voos do Pará…": "e as 10:30 voos do para",
    "  Ñandú  --  AÇÃO! ": "nandu acao",
    "": "",
}
TERMS = {"cancelamentos": "cancelados", "aviões": "avião", "papéis": "papel", "aeroportos": "aeroporto", "movimentam": "movimentados"}


def test_normalize(spark):
    df = spark.createDataFrame([(s,) for s in NORMAL], "s string")
    assert [r[0] for r in df.select(tx.normalize_text("s")).collect()] == list(NORMAL.values())
    again = [r[0] for r in df.select(tx.normalize_text(tx.normalize_text("s"))).collect()]
    assert again == list(NORMAL.values())


def test_word_forms_meet_in_one_term(spark):
    """Forms of one word share their term; short words stay as they are, and stop words go."""
    df = spark.createDataFrame(list(TERMS.items()), "a string, b string")
    got = df.select(tx.content_terms(tx.normalize_text("a")).alias("a"), tx.content_terms(tx.normalize_text("b")).alias("b")).collect()
    assert all(r.a == r.b and len(r.a) == 1 for r in got)
    words = spark.createDataFrame([("voo",), ("gol",), ("#brasao",), ("ass",)], "w string")
    assert [r[0] for r in words.select(tx.stem("w")).collect()] == ["voo", "gol", "#brasao", "ass"]
    stop = spark.createDataFrame([(" ".join(sorted(lx.STOP_WORDS)),)], "s string")
    assert stop.select(tx.content_terms(tx.normalize_text("s"))).first()[0] == []


def test_mojibake(spark):
    """Text read as Latin-1 comes back; text that was right, or would gain control characters, stays."""
    right = ["IBÉRIA", "COMPAÑÍA PANAMEÑA", "TRANSPORTES AÉREOS", "São Paulo"]
    df = spark.createDataFrame([(s.encode().decode("latin-1"), s) for s in right], "broken string, s string")
    assert [tuple(r) for r in df.select(tx.repair_mojibake("broken"), tx.repair_mojibake("s")).collect()] == [(s, s) for s in right]
    alone = ["PLAIN", "Ã", "Ã\u0080 e €", "a\u0085", "Â\u0085", None]
    df = spark.createDataFrame([(s,) for s in alone], "s string")
    assert [r[0] for r in df.select(tx.repair_mojibake("s")).collect()] == alone


def test_numbers(spark):
    def read(s):
        return [(x["trecho"], x["valor"]) for x in one(spark, tx.numbers_in(F.lit(s)))[0]]

    assert read("somam 317.327 partidas, cerca de 317 mil, 46,6% e 1,5 milhões") == [
        ("317.327", 317327.0), ("317 mil", 317000.0), ("46,6", 46.6), ("1,5 milhões", 1500000.0)]
    assert read("AD4512 em ago/2025 ou v2") == []
    tol = one(spark, tx.numbers_in(F.lit("73,8 e 317 mil")))[0]
    assert abs(tol[0]["tolerancia"] - 0.05) < 1e-6 and abs(tol[1]["tolerancia"] - 500) < 1e-6


def test_formats(spark):
    row = one(spark, tx.format_br(F.lit(1014705)), tx.format_unit(F.lit(73.79), "%"), tx.format_unit(F.lit(23.61), "min"),
              tx.format_unit(F.lit(1024.09), "km"), tx.format_unit(F.lit(147976), ""))
    assert row == ("1.014.705", "73,8%", "23,6 min", "1.024 km", "147.976")


def test_triggers(spark):
    cases = {"Oi, tudo bem": "saudacao", "muito obrigado!": "agradecimento", "Quem é você?": "identidade", "como funciona": "funcionamento",
             "ajuda": "ajuda", "Por que os voos da GOL foram cancelados?": "fora_do_grao.motivo_cancelamento",
             "qual o voo AD4512": "fora_do_grao.voo_especifico", "voos às 10:30": "fora_do_grao.horario",
             "quantos voos teve no dia 25": "fora_do_grao.por_dia", "quantos voos teve em março": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert [r[0] for r in df.select(tx.classify(tx.normalize_text("s"))).collect()] == list(cases.values())


def test_clean_name():
    assert tx.clean_name("﻿Nome da, Coluna (x)=") == "Nome_da_Coluna_x"
