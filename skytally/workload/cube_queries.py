"""Queries for aggregates, the additive cube and the fixed result cubes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.metrics import METRICS, MEASURES, metrics
from ..functions.typing import route_key
from ..operators import aggregates as ag
from ..operators import distinct as ds
from ..operators.windows import join_null_safe
from ..operators.windows import nearest_rank
from ..plans import cube as cb
from ..plans import facts, refresh
from ..plans import questions as qs
from ..session import new_folder, stored
from . import tables as t
from .registry import query

_OTP = "100.0 * CAST(count(*) FILTER (WHERE partida_pontual) AS DOUBLE) / nullif(count(*) FILTER (WHERE flag_realizado), 0)"
_OTPC = "100.0 * CAST(count(*) FILTER (WHERE chegada_pontual) AS DOUBLE) / nullif(count(*) FILTER (WHERE flag_realizado), 0)"
_CANC = "100.0 * CAST(count(*) FILTER (WHERE flag_cancelado) AS DOUBLE) / count(*)"
_DELAY = "avg(atraso_partida_min) FILTER (WHERE flag_realizado)"
_VOLUMES = "count(*) AS voos, count(*) FILTER (WHERE flag_realizado) AS realizados, count(*) FILTER (WHERE flag_cancelado) AS cancelados"


def _small(spark, sf):
    return t.rows(spark, sf, origin=False, destination=False)


@query("a2_additive_cube", "SELECT * FROM cubo")
def a2(spark, sf):
    return cb.additive_cube(t.rows(spark, sf))


@query("a2_cube_after_increments", "SELECT * FROM cubo")
def a2_increments(spark, sf):
    """Three lots of flights one after the other, the second one twice."""
    r, path = t.rows(spark, sf), new_folder(spark, "cubo_mantido")
    cube = stored(cb.additive_cube(r), "base")
    lot = F.pmod(F.xxhash64("icao_empresa", "icao_origem", "icao_destino"), F.lit(3))
    for n in (0, 1, 1, 2):
        refresh.refresh_cube(cube.where(lot == n), path, n)
    return refresh.refreshed_cube(spark, path, cube)


@query("a2_small_cube", """
SELECT ano_mes, situacao_voo, periodo_partida, fim_de_semana, codigo_tipo_linha, """ + ", ".join(
    f"CAST(sum({m}) AS BIGINT) AS {m}" for m in MEASURES) + " FROM cubo GROUP BY ALL")
def a2_small(spark, sf):
    return cb.additive_cube(
        _small(spark, sf).withColumns({"icao_origem": F.lit(None), "icao_destino": F.lit(None)}),
        ["ano_mes", "situacao_voo", "periodo_partida", "fim_de_semana", "codigo_tipo_linha"])


@query("c1_a1_kpis", f"""
SELECT count(*) AS total_voos, count(*) FILTER (WHERE flag_realizado) AS realizados, count(*) FILTER (WHERE flag_cancelado) AS cancelados,
  {_CANC} AS pct_cancelado, {_OTP} AS otp_partida, {_OTPC} AS otp_chegada, count(*) FILTER (WHERE partida_atraso_severo) AS atraso_severo,
  {_DELAY} AS atraso_medio_partida, avg(atraso_chegada_min) FILTER (WHERE flag_realizado) AS atraso_medio_chegada,
  avg(minutos_recuperados) AS minutos_recuperados_medio, avg(duracao_voo_min) AS duracao_media_min,
  count(DISTINCT icao_empresa) AS empresas, count(DISTINCT icao_origem) AS aerodromos_origem,
  count(DISTINCT icao_origem || '>' || icao_destino) AS rotas, min(data_partida_prevista) AS periodo_inicio, max(data_partida_prevista) AS periodo_fim
FROM linhas""")
def c1(spark, sf):
    return cb.kpis(t.rows(spark, sf))


@query("c2_by_company", f"""
SELECT l.icao_empresa AS icao, coalesce(max(e.nome), '(sem cadastro)') AS nome, {_VOLUMES}, {_CANC} AS pct_cancelado, {_OTP} AS otp_partida,
  {_OTPC} AS otp_chegada, {_DELAY} AS atraso_medio_partida, avg(atraso_chegada_min) FILTER (WHERE flag_realizado) AS atraso_medio_chegada,
  avg(minutos_recuperados) AS minutos_recuperados_medio, count(*) FILTER (WHERE partida_atraso_severo) AS atraso_severo,
  count(DISTINCT icao_origem || '>' || icao_destino) AS rotas
FROM linhas l LEFT JOIN empresa e ON l.icao_empresa = e.icao_empresa GROUP BY l.icao_empresa""")
def c2(spark, sf):
    return cb.company_cube(t.rows(spark, sf), t.empresa(spark, sf).withColumnRenamed("icao_empresa", "icao"))


@query("c3_by_month", f"""
SELECT ano_mes, min(nome_mes) AS nome_mes, min(ano) AS ano, {_VOLUMES}, {_CANC} AS pct_cancelado, {_OTP} AS otp_partida,
  {_DELAY} AS atraso_medio_partida FROM linhas GROUP BY ano_mes""")
def c3(spark, sf):
    return cb.month_cube(_small(spark, sf))


@query("c4_a12_company_month", f"""
SELECT icao_empresa AS icao, ano_mes, count(*) AS voos, count(*) FILTER (WHERE flag_cancelado) AS cancelados, {_OTP} AS otp_partida,
  {_DELAY} AS atraso_medio_partida FROM linhas
WHERE icao_empresa IN (SELECT icao_empresa FROM linhas GROUP BY 1 HAVING count(*) >= 600) GROUP BY 1, 2""")
def c4(spark, sf):
    return cb.company_month_cube(_small(spark, sf), 600)


@query("c5_by_route", f"""
SELECT l.icao_origem, l.icao_destino, max(a.municipio) AS origem_municipio, max(a.estado) AS origem_uf, max(b.municipio) AS destino_municipio,
  max(b.estado) AS destino_uf, max(r.distancia_km) AS distancia_km, max(r.faixa_distancia) AS faixa, count(*) AS voos,
  count(*) FILTER (WHERE flag_cancelado) AS cancelados, {_OTP} AS otp_partida, avg(duracao_voo_min) AS duracao_media_min
FROM linhas l LEFT JOIN aerodromo a ON l.icao_origem = a.icao LEFT JOIN aerodromo b ON l.icao_destino = b.icao
LEFT JOIN rota r ON l.icao_origem = r.icao_origem AND l.icao_destino = r.icao_destino GROUP BY 1, 2""")
def c5(spark, sf):
    return cb.route_cube(t.rows(spark, sf), t.aerodromo(spark, sf), t.rota(spark, sf))


@query("c6_by_origin", f"""
SELECT a.icao, a.nome, a.municipio, a.estado AS uf, a.latitude, a.longitude, count(*) AS voos,
  count(*) FILTER (WHERE flag_cancelado) AS cancelados, {_OTP} AS otp_partida
FROM linhas l JOIN aerodromo a ON l.icao_origem = a.icao WHERE a.latitude IS NOT NULL GROUP BY ALL""")
def c6(spark, sf):
    return cb.origin_cube(t.rows(spark, sf, destination=False), t.aerodromo(spark, sf))


_CUTS = {"tipo_linha": "codigo_tipo_linha", "faixa_distancia": "faixa_distancia", "periodo_partida": "periodo_partida",
         "dia_semana": "nome_dia_semana", "fim_de_semana": "fim_de_semana", "estacao": "estacao",
         "situacao": "situacao_voo", "origem_empresa": "nacional"}


@query("c7_a11_category_cuts", " UNION ALL ".join(f"""
SELECT '{name}' AS dimensao, coalesce(CAST({col} AS VARCHAR), '(sem valor)') AS categoria, count(*) AS voos,
  count(*) FILTER (WHERE flag_cancelado) AS cancelados, {_OTP} AS otp_partida, {_DELAY} AS atraso_medio_partida
FROM linhas l JOIN rota r ON l.icao_origem = r.icao_origem AND l.icao_destino = r.icao_destino
JOIN empresa e ON l.icao_empresa = e.icao_empresa GROUP BY {col}""" for name, col in _CUTS.items()))
def c7(spark, sf):
    """Route band and company origin are looked up on the reduced rows, not on the flights."""
    r = t.rows(spark, sf)
    measures = cb.cut_measures()
    keys = ["icao_origem", "icao_destino", "icao_empresa", "codigo_tipo_linha", "periodo_partida", "nome_dia_semana",
            "fim_de_semana", "estacao", "situacao_voo"]
    sums = r.select(*keys, *[c.alias(n) for n, c in measures.items()]).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    named = t.lookup_route_and_company(spark, sf, sums)
    return cb.finish_cuts(ag.category_cuts(named, _CUTS, {m: F.col(m) for m in measures}))


@query("c8_a26_cancellation_reasons", """
SELECT coalesce(nullif(codigo_justificativa, ''), '(sem codigo)') AS codigo, count(*) AS cancelados FROM linhas WHERE flag_cancelado GROUP BY 1""")
def c8(spark, sf):
    return cb.cancellation_reasons(_small(spark, sf))


@query("a3_conditional_counts", """
SELECT icao_empresa, count(*) FILTER (WHERE flag_realizado) AS realizados, count(*) FILTER (WHERE flag_cancelado) AS cancelados,
  count(*) FILTER (WHERE partida_pontual) AS pontuais, count(*) FILTER (WHERE partida_atraso_severo) AS severos FROM linhas GROUP BY 1""")
def a3(spark, sf):
    return _small(spark, sf).groupBy("icao_empresa").agg(
        ag.count_if("flag_realizado").alias("realizados"), ag.count_if("flag_cancelado").alias("cancelados"),
        ag.count_if("partida_pontual").alias("pontuais"), ag.count_if("partida_atraso_severo").alias("severos"))


@query("a4_sum_count_pairs", """
SELECT codigo_tipo_linha, CAST(sum(atraso_partida_min) AS BIGINT) AS soma_atraso, count(atraso_partida_min) AS com_atraso,
  CAST(sum(duracao_voo_min) AS BIGINT) AS soma_duracao, count(duracao_voo_min) AS com_duracao FROM linhas GROUP BY 1""")
def a4(spark, sf):
    return _small(spark, sf).groupBy("codigo_tipo_linha").agg(
        *ag.sum_count("atraso_partida_min", "soma_atraso", "com_atraso"), *ag.sum_count("duracao_voo_min", "soma_duracao", "com_duracao"))


_RATIOS = {"otp": "100.0 * CAST(sum(partidas_pontuais) AS DOUBLE) / nullif(sum(realizados), 0)",
           "otp_chegada": "100.0 * CAST(sum(chegadas_pontuais) AS DOUBLE) / nullif(sum(realizados), 0)",
           "taxa": "100.0 * CAST(sum(cancelados) AS DOUBLE) / nullif(sum(voos), 0)",
           "atraso_bruto": "CAST(sum(soma_atraso_partida) AS DOUBLE) / nullif(sum(com_atraso_partida), 0)",
           "atraso_chegada": "CAST(sum(soma_atraso_chegada) AS DOUBLE) / nullif(sum(com_atraso_chegada), 0)",
           "atraso": "CAST(sum(soma_atraso_plausivel) AS DOUBLE) / nullif(sum(com_atraso_plausivel), 0)",
           "duracao": "CAST(sum(soma_duracao) AS DOUBLE) / nullif(sum(com_duracao), 0)"}


@query("a5_metric_registry", "SELECT icao_empresa, " + ", ".join(f"{v} AS {k}" for k, v in _RATIOS.items()) + " FROM cubo GROUP BY 1")
def a5(spark, sf):
    names = [n for n in METRICS if n not in MEASURES]
    return t.cube(spark, sf, origin=False, destination=False).fato.groupBy("icao_empresa").agg(*metrics(*names))


@query("a5_metrics_from_stored_cube", "SELECT ano_mes, icao_origem, " + ", ".join(f"{v} AS {k}" for k, v in _RATIOS.items()) + " FROM cubo GROUP BY 1, 2")
def a5_cube(spark, sf):
    names = [n for n in METRICS if n not in MEASURES]
    return t.stored_cube(spark, sf).fato.groupBy("ano_mes", "icao_origem").agg(*metrics(*names))


@query("a6_conditional_means", f"SELECT codigo_di, {_DELAY} AS medio_realizados, avg(duracao_voo_min) FILTER (WHERE partida_pontual) AS duracao_pontuais FROM linhas GROUP BY 1")
def a6(spark, sf):
    return _small(spark, sf).groupBy("codigo_di").agg(
        ag.mean_where("atraso_partida_min", "flag_realizado").alias("medio_realizados"),
        ag.mean_where("duracao_voo_min", "partida_pontual").alias("duracao_pontuais"))


@query("a7_distinct_counts", """
SELECT count(DISTINCT icao_empresa) AS empresas, count(DISTINCT CASE WHEN flag_cancelado THEN codigo_justificativa END) AS motivos,
  count(DISTINCT icao_origem || '>' || icao_destino) AS rotas FROM linhas""")
def a7(spark, sf):
    return t.rows(spark, sf).agg(
        F.count_distinct("icao_empresa").alias("empresas"), ag.distinct_where("codigo_justificativa", "flag_cancelado").alias("motivos"),
        F.count_distinct(route_key("icao_origem", "icao_destino")).alias("rotas"))


_DISTINCT = {"empresas": "icao_empresa", "motivos": "CASE WHEN flag_cancelado THEN codigo_justificativa END", "rotas": "icao_origem || '>' || icao_destino"}


def _distinct_values():
    return {"empresas": F.col("icao_empresa"), "motivos": F.when(F.col("flag_cancelado"), F.col("codigo_justificativa")), "rotas": route_key("icao_origem", "icao_destino")}


def _distinct_state(spark, sf, make, part=None):
    r = t.rows(spark, sf)
    r = r.where(part) if part is not None else r
    return stored(make(r, ["ano_mes", "situacao_voo"], _distinct_values()), "distintos")


@query("a7_distinct_rolled_up", "SELECT " + ", ".join(f"count(DISTINCT {v}) AS {k}" for k, v in _DISTINCT.items()) + ", ano_mes FROM linhas GROUP BY ano_mes")
def a7_state(spark, sf):
    """Exact counts per month from a stored state per month and outcome, put together from two halves of the flights."""
    half = F.pmod(F.xxhash64("icao_empresa", "data_partida_prevista"), F.lit(2))
    state = ds.merged_states([_distinct_state(spark, sf, ds.distinct_state, half == n) for n in (0, 1)])
    return ds.distinct_counts(state, ["ano_mes"], list(_DISTINCT))


@query("a7_distinct_of_all", "SELECT " + ", ".join(f"count(DISTINCT {v}) AS {k}" for k, v in _DISTINCT.items()) + " FROM linhas")
def a7_all(spark, sf):
    return ds.distinct_counts(_distinct_state(spark, sf, ds.distinct_state), [], list(_DISTINCT))


@query("a7_sketches_within_error", "SELECT ano_mes, true AS empresas, true AS motivos, true AS rotas FROM linhas GROUP BY ano_mes")
def a7_sketch(spark, sf):
    """Is each estimate from the stored sketches within 2.5 % (and one) of the exact count?"""
    near = ds.sketch_counts(_distinct_state(spark, sf, ds.sketch_state), ["ano_mes"], list(_DISTINCT))
    exact = ds.distinct_counts(_distinct_state(spark, sf, ds.distinct_state), ["ano_mes"], list(_DISTINCT))
    both = join_null_safe(near, exact.select("ano_mes", *[F.col(c).alias(f"x_{c}") for c in _DISTINCT]), ["ano_mes"])
    return both.select("ano_mes", *[(F.abs(F.col(c) - F.col(f"x_{c}")) <= 1 + 0.025 * F.col(f"x_{c}")).alias(c) for c in _DISTINCT])


@query("a8_min_volume", "SELECT icao_empresa, count(*) AS voos FROM voos GROUP BY 1 HAVING count(*) >= 610")
def a8(spark, sf):
    sums = t.flights(spark, sf, origin=False, destination=False).groupBy("icao_empresa").agg(F.count(F.lit(1)).alias("voos"))
    return ag.min_volume(sums, "voos", 610)


@query("a9_dependent_attributes", """
SELECT CAST(icao_origem AS VARCHAR) AS icao_origem, max(origem_nome) AS nome, max(origem_municipio) AS municipio FROM obt GROUP BY 1""")
def a9(spark, sf):
    return ag.dependent_attributes(t.obt(spark, sf), ["icao_origem"], {"origem_nome": "nome", "origem_municipio": "municipio"})


@query("a9_dependency_violations", """
SELECT o_custkey, count(DISTINCT o_orderstatus) AS o_orderstatus FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1""", views=False)
def a9_bad(spark, sf):
    return ag.dependency_violations(t.table(spark, sf, "orders"), ["o_custkey"], ["o_orderstatus"])


@query("a13_arg_best", """
SELECT icao_origem, arg_min(icao_destino, {'v': -v, 'd': icao_destino}) AS icao_destino, max(v) AS voos FROM (
  SELECT icao_origem, icao_destino, count(*) AS v FROM voos GROUP BY 1, 2) GROUP BY 1""")
def a13(spark, sf):
    pairs = t.flights(spark, sf).groupBy("icao_origem", "icao_destino").agg(F.count(F.lit(1)).alias("voos"))
    return ag.arg_best(pairs, ["icao_origem"], "icao_destino", "voos")


@query("a15_label_collisions", """
SELECT a.municipio, a.icao, c.membros FROM aerodromo a JOIN (
  SELECT municipio, count(*) AS membros FROM aerodromo WHERE municipio IS NOT NULL GROUP BY 1 HAVING count(*) > 1) c ON a.municipio = c.municipio""")
def a15(spark, sf):
    return facts.cities_with_several_airports(t.aerodromo(spark, sf))


@query("a16_weighted_mean", """
SELECT faixa_distancia, CAST(sum(CAST(distancia_km * 10 AS BIGINT) * voos) AS DOUBLE) / 10 / sum(voos) AS km FROM rota WHERE distancia_km IS NOT NULL GROUP BY 1""")
def a16(spark, sf):
    # Tenths of a kilometre are whole numbers: the sum does not depend on the order of the rows.
    r = t.rota(spark, sf).withColumn("_dm", F.round(F.col("distancia_km") * 10).cast("long"))
    return ag.weighted_mean(r, "_dm", "voos", "_m", ["faixa_distancia"]).select("faixa_distancia", (F.col("_m") / 10).alias("km"))


@query("a17_profile_nulls", " UNION ALL ".join(f"""
SELECT '{c}' AS coluna, count(*) AS linhas, count(*) FILTER (WHERE {q} IS NULL) AS nulos, count(*) FILTER (WHERE {q} = 'null') AS sentinelas,
  count(*) FILTER (WHERE {q} = '') AS vazios, count(*) FILTER (WHERE {q} NOT IN ('null', '')) AS preenchidos FROM brutos"""
    for c, q in (("Partida_Prevista", "partida_prevista"), ("Partida_Real", "partida_real"), ("Situacao", "situacao_voo"), ("Motivo", "codigo_justificativa"))))
def a17(spark, sf):
    raw = t.raw_flights(spark, sf).select(
        "Partida_Prevista", "Partida_Real", F.col("`Situação_Voo`").alias("Situacao"), F.col("`Código_Justificativa`").alias("Motivo"))
    return ag.profile_nulls(raw, raw.columns)


@query("a18_share_of_total", """
SELECT icao_empresa, count(*) AS voos, 100.0 * CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM voos) AS pct FROM voos GROUP BY 1""")
def a18(spark, sf):
    sums = t.flights(spark, sf, origin=False, destination=False).groupBy("icao_empresa").agg(F.count(F.lit(1)).alias("voos"))
    return ag.share_of_total(sums, "voos", "pct")


@query("a19_load_stats", """
SELECT origem_arquivo, count(*) AS registros, count(DISTINCT icao_empresa) AS empresas, min(transformado_em) AS primeiro,
  max(transformado_em) AS ultimo FROM voos GROUP BY 1""")
def a19(spark, sf):
    return ag.load_stats(t.flights(spark, sf, origin=False, destination=False), "origem_arquivo", {"icao_empresa": "empresas"}, "transformado_em")


@query("a20_latency_percentiles", """
SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, max(value) AS maximo FROM events
WHERE value IS NOT NULL GROUP BY 1""", views=False)
def a20(spark, sf):
    return nearest_rank(t.table(spark, sf, "events"), ["event_type"], "value", {"p50": 0.5, "p95": 0.95, "maximo": 1.0})


@query("a20_percentiles_with_far_tails", """
WITH l AS (SELECT l_returnflag, CASE WHEN l_orderkey % 97 = 0 THEN l_extendedprice * 1e8 WHEN l_orderkey % 1009 = 1 THEN l_extendedprice * 1e15 ELSE l_extendedprice END AS valor FROM lineitem)
SELECT l_returnflag, quantile_disc(valor, 0.01) AS p1, quantile_disc(valor, 0.5) AS p50, quantile_disc(valor, 0.95) AS p95, max(valor) AS maximo FROM l GROUP BY 1""", views=False)
def a20_tails(spark, sf):
    """A bulk and tails that lie up to fifteen orders of magnitude above it; brackets of 200 rows."""
    far = F.when(F.col("l_orderkey") % 97 == 0, F.col("l_extendedprice") * 1e8).when(F.col("l_orderkey") % 1009 == 1, F.col("l_extendedprice") * 1e15).otherwise(F.col("l_extendedprice"))
    rows = t.table(spark, sf, "lineitem").select("l_returnflag", far.alias("valor"))
    return nearest_rank(rows, ["l_returnflag"], "valor", {"p1": 0.01, "p50": 0.5, "p95": 0.95, "maximo": 1.0}, small=200)


@query("a21_movement", """
SELECT local, CAST(sum(p) AS BIGINT) AS partidas, CAST(sum(c) AS BIGINT) AS chegadas, CAST(sum(p + c) AS BIGINT) AS movimento FROM (
  SELECT icao_origem AS local, 1 AS p, 0 AS c FROM voos UNION ALL SELECT icao_destino, 0, 1 FROM voos) GROUP BY 1""")
def a21(spark, sf):
    pairs = t.flights(spark, sf).groupBy("icao_origem", "icao_destino").agg(F.count(F.lit(1)).alias("v"))
    return ag.movement(pairs, "icao_origem", "icao_destino", "v")


@query("a22_pair_totals", """
SELECT least(icao_origem, icao_destino) AS ponta_a, greatest(icao_origem, icao_destino) AS ponta_b, count(*) AS voos FROM voos GROUP BY 1, 2""")
def a22(spark, sf):
    return qs.pair_totals(t.cube(spark, sf))


@query("a24_complete_periods", "SELECT ano_mes, nome_mes, dias_com_voo, voos FROM tempo WHERE ano_mes IS NOT NULL AND dias_com_voo >= 28")
def a24(spark, sf):
    return cb.complete_periods(t.tempo(spark, sf)).select("ano_mes", "nome_mes", "dias_com_voo", "voos")


@query("a24_partial_periods", "SELECT ano_mes, nome_mes, dias_com_voo, voos FROM tempo WHERE ano_mes IS NOT NULL AND dias_com_voo < 28")
def a24_partial(spark, sf):
    return cb.partial_periods(t.tempo(spark, sf)).select("ano_mes", "nome_mes", "dias_com_voo", "voos")


@query("a25_outcome_rollup", """
SELECT user_id, count(*) AS chamadas, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'view') AS view,
  count(*) FILTER (WHERE event_type = 'error') AS error, count(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN ('click', 'view', 'error')) AS outro,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS centavos FROM events GROUP BY 1""", views=False)
def a25(spark, sf):
    e = t.table(spark, sf, "events").withColumn("_c", F.round(F.col("value") * 100).cast("long"))
    return ag.outcome_rollup(e, "user_id", "event_type", ["click", "view", "error"], {"_c": "centavos"})
