"""Queries for the typed mirrors, the star schema and the exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import typing as ty
from ..functions.geo import distance_band, haversine_km
from ..operators.aggregates import count_if
from ..operators.joins import lookup
from ..operators.windows import dedupe_best, latest_first, present_first, surrogate_key
from ..plans import cube as cb
from ..plans import silver, star
from . import tables as t
from .registry import query

_FACT_SQL = """sk_empresa, sk_aerodromo_origem, sk_aerodromo_destino, sk_tempo_partida_prevista, sk_tempo_partida_real,
  sk_tipo_linha, sk_situacao, sk_rota, icao_empresa, numero_voo, codigo_di, icao_origem, icao_destino, partida_prevista_hora,
  partida_real_hora, chegada_prevista_hora, chegada_real_hora, atraso_partida_min, atraso_chegada_min, minutos_recuperados,
  flag_realizado, flag_cancelado, partida_pontual, chegada_pontual, partida_atrasada, partida_atraso_severo, duracao_voo_min,
  periodo_partida, situacao_voo, codigo_justificativa, origem_arquivo, transformado_em, data_partida_prevista, pedido, item, id_voo"""


@query("m7_otp_by_company_month", """
SELECT e.nome AS razao_social, l.icao_empresa AS icao, l.ano, l.mes, l.nome_mes, count(*) AS total_voos,
  count(*) FILTER (WHERE flag_realizado) AS voos_realizados, count(*) FILTER (WHERE flag_cancelado) AS voos_cancelados,
  100.0 * CAST(count(*) FILTER (WHERE partida_pontual) AS DOUBLE) / nullif(count(*) FILTER (WHERE flag_realizado), 0) AS pct_partida_pontual,
  100.0 * CAST(count(*) FILTER (WHERE chegada_pontual) AS DOUBLE) / nullif(count(*) FILTER (WHERE flag_realizado), 0) AS pct_chegada_pontual,
  avg(atraso_partida_min) FILTER (WHERE flag_realizado) AS atraso_medio_partida_min,
  avg(atraso_chegada_min) FILTER (WHERE flag_realizado) AS atraso_medio_chegada_min
FROM linhas l JOIN empresa e ON l.icao_empresa = e.icao_empresa WHERE l.ano IS NOT NULL
GROUP BY e.nome, l.icao_empresa, l.ano, l.mes, l.nome_mes""")
def m7(spark, sf):
    return star.otp_by_company_month(
        t.rows(spark, sf, origin=False, destination=False), t.empresa(spark, sf), "icao_empresa", "nome")


@query("m1_dim_tempo", "SELECT * FROM dim_tempo")
def m1(spark, sf):
    return star.build_dim_tempo(t.flights(spark, sf, origin=False, destination=False))


@query("m2_dim_empresa", "SELECT * FROM dim_empresa")
def m2(spark, sf):
    return star.build_dim_empresa(t.companies(spark, sf))


@query("m3_dim_aerodromo", "SELECT * FROM dim_aerodromo")
def m3(spark, sf):
    return star.build_dim_aerodromo(t.airports(spark, sf))


@query("m4_dim_tipo_linha", "SELECT * FROM dim_tipo_linha")
def m4_line(spark, sf):
    return star.build_dim_tipo_linha(t.flights(spark, sf, origin=False, destination=False))


@query("m4_dim_situacao_voo", "SELECT * FROM dim_situacao")
def m4_status(spark, sf):
    return star.build_dim_situacao(t.flights(spark, sf, origin=False, destination=False))


@query("m5_dim_rota", "SELECT * FROM dim_rota")
def m5(spark, sf):
    return star.build_dim_rota(t.flights(spark, sf, text_codes=True), t.airports(spark, sf))


@query("m6_fato_voos", f"SELECT {_FACT_SQL} FROM fato")
def m6(spark, sf):
    return t.fact(spark, sf, t.dims(spark, sf), numbered=True)


@query("w3_surrogate_key_large", """
SELECT row_number() OVER (ORDER BY data_partida_prevista NULLS FIRST, CAST(icao_empresa AS VARCHAR) NULLS FIRST, CAST(numero_voo AS VARCHAR) NULLS FIRST,
         pedido, item, icao_origem, icao_destino, atraso_partida_min NULLS FIRST) AS id_voo,
  data_partida_prevista, CAST(icao_empresa AS VARCHAR) AS icao_empresa, CAST(numero_voo AS VARCHAR) AS numero_voo, pedido, item,
  icao_origem, icao_destino, atraso_partida_min
FROM linhas""")
def w3(spark, sf):
    f = t.flights(spark, sf).select(
        F.col("partida_prevista_data").alias("data_partida_prevista"), F.col("icao_empresa").cast("string").alias("icao_empresa"),
        F.col("numero_voo").cast("string").alias("numero_voo"), "pedido", "item", "icao_origem", "icao_destino", "atraso_partida_min")
    return surrogate_key(f, "id_voo", ["data_partida_prevista", "icao_empresa", "numero_voo", "pedido", "item"])


@query("w2_surrogate_key", """
SELECT row_number() OVER (ORDER BY c_name, c_custkey) AS sk, c_custkey, c_name FROM customer""", views=False)
def w2(spark, sf):
    return surrogate_key(t.table(spark, sf, "customer").select("c_name", "c_custkey"), "sk", ["c_name", "c_custkey"])


@query("m8_obt_voos", "SELECT * FROM obt")
def m8(spark, sf):
    return t.obt(spark, sf, numbered=True)


@query("m8_obt_of_fact", "SELECT * EXCLUDE (id_voo) FROM obt")
def m8_fact(spark, sf):
    """By way of the fact's surrogate keys."""
    return t.obt_of_fact(spark, sf)


@query("m9_export_empresa", """
SELECT icao_empresa, max(empresa_nome) AS nome, max(empresa_iata) AS iata, max(empresa_servico) AS servico,
  max(empresa_origem) AS origem_cadastro, max(empresa_situacao) AS situacao, count(*) AS voos_no_periodo,
  coalesce(max(empresa_origem) = 'nacional', false) AS nacional,
  CASE icao_empresa WHEN '1' THEN 'M0' WHEN '2' THEN 'M0' WHEN '3' THEN 'M1' END AS marca
FROM obt GROUP BY icao_empresa""")
def m9(spark, sf):
    return cb.export_companies(t.obt(spark, sf), {"1": "M0", "2": "M0", "3": "M1"})


@query("m10_export_aerodromo", """
SELECT icao, max(nome) AS nome, max(municipio) AS municipio,
  CASE max(uf) WHEN 'AFRICA' THEN 'AF' WHEN 'AMERICA' THEN 'AM' WHEN 'ASIA' THEN 'AS' END AS uf, max(uf) AS estado,
  max(lat) AS latitude, max(lon) AS longitude, CAST(sum(p) AS BIGINT) AS partidas, CAST(sum(c) AS BIGINT) AS chegadas
FROM (SELECT icao_origem AS icao, origem_nome AS nome, origem_municipio AS municipio, origem_uf AS uf, origem_latitude AS lat,
        origem_longitude AS lon, 1 AS p, 0 AS c FROM obt
      UNION ALL SELECT icao_destino, destino_nome, destino_municipio, destino_uf, destino_latitude, destino_longitude, 0, 1 FROM obt)
WHERE icao IS NOT NULL GROUP BY icao HAVING count(*) >= 4500""")
def m10(spark, sf):
    return cb.export_airports(t.obt(spark, sf), {"AFRICA": "AF", "AMERICA": "AM", "ASIA": "AS"}, 4500)


@query("m11_export_rota", "SELECT * FROM rota")
def m11(spark, sf):
    return t.rota(spark, sf)


@query("m11_export_rota_from_obt", """
SELECT CAST(icao_origem AS VARCHAR) AS icao_origem, CAST(icao_destino AS VARCHAR) AS icao_destino, distancia_km, faixa_distancia,
  origem_igual_destino, voos FROM rota""")
def m11_obt(spark, sf):
    return cb.export_routes(t.obt(spark, sf))


@query("m12_export_tempo", "SELECT * FROM tempo")
def m12(spark, sf):
    return t.tempo(spark, sf)


@query("m13_silver_vra", """
SELECT icao_empresa, numero_voo, codigo_di, codigo_tipo_linha, icao_origem, icao_destino,
  CAST(try_cast(partida_prevista AS TIMESTAMP) AS DATE) AS partida_prevista_data, try_cast(partida_prevista AS TIMESTAMP) AS partida_prevista_hora,
  CAST(try_cast(partida_real AS TIMESTAMP) AS DATE) AS partida_real_data, try_cast(partida_real AS TIMESTAMP) AS partida_real_hora,
  CAST(try_cast(chegada_prevista AS TIMESTAMP) AS DATE) AS chegada_prevista_data, try_cast(chegada_prevista AS TIMESTAMP) AS chegada_prevista_hora,
  CAST(try_cast(chegada_real AS TIMESTAMP) AS DATE) AS chegada_real_data, try_cast(chegada_real AS TIMESTAMP) AS chegada_real_hora,
  situacao_voo, codigo_justificativa,
  date_sub('minute', try_cast(partida_prevista AS TIMESTAMP), try_cast(partida_real AS TIMESTAMP)) AS atraso_partida_min,
  date_sub('minute', try_cast(chegada_prevista AS TIMESTAMP), try_cast(chegada_real AS TIMESTAMP)) AS atraso_chegada_min,
  date_sub('minute', try_cast(partida_prevista AS TIMESTAMP), try_cast(partida_real AS TIMESTAMP))
    - date_sub('minute', try_cast(chegada_prevista AS TIMESTAMP), try_cast(chegada_real AS TIMESTAMP)) AS minutos_recuperados,
  origem_arquivo, transformado_em FROM brutos""")
def m13_flights(spark, sf):
    return silver.silver_flights(t.raw_flights(spark, sf))


@query("u1_silver_empresas", "SELECT * FROM empresas")
def m13_companies(spark, sf):
    return t.companies(spark, sf)


@query("m13_silver_aerodromos", """
SELECT CAST(icao AS VARCHAR) AS icao, 'C' || icao AS ciad, nome, municipio, estado AS uf_nome, '' AS municipio_servido, '' AS uf_servido_nome,
  CAST((icao * 10) || '.' || (icao % 10) AS DOUBLE) AS altitude_m,
  CAST(CAST(latitude AS DECIMAL(8,1)) AS VARCHAR) AS latitude, CAST(CAST(longitude AS DECIMAL(8,1)) AS VARCHAR) AS longitude,
  CAST(CAST(latitude AS DECIMAL(8,1)) AS VARCHAR) AS latgeopoint, CAST(CAST(longitude AS DECIMAL(8,1)) AS VARCHAR) AS longeopoint,
  'VFR' AS operacao_diurna, '' AS operacao_noturna,
  CASE WHEN icao % 6 = 0 THEN 'Interditado' WHEN icao % 6 = 1 THEN 'Descadastrado' ELSE 'Cadastrado' END AS situacao,
  '' AS validade_registro, '' AS portaria_registro, '' AS link_portaria,
  CASE WHEN latitude IS NULL THEN 'coordenadas_ausentes' ELSE 'coordenadas_presentes' END AS status_coordenadas,
  'aerodromos' AS origem_arquivo, TIMESTAMP '2024-01-01 00:00:00' AS transformado_em FROM aerodromo""")
def m13_airports(spark, sf):
    return t.airports(spark, sf)


@query("w1_dedupe_best", """
SELECT icao, razao_social, situacao, transformado_em FROM (
  SELECT *, row_number() OVER (PARTITION BY icao ORDER BY CASE WHEN razao_social <> '' THEN 0 ELSE 1 END,
    CASE WHEN situacao <> '' THEN 0 ELSE 1 END, transformado_em DESC) AS rn FROM cadastro) WHERE rn = 1""")
def w1(spark, sf):
    rows = silver.drop_header_rows(t.companies(spark, sf), "icao", ["icao", "ICAO"])
    rows = rows.select("icao", "razao_social", "situacao", "transformado_em")
    return dedupe_best(rows, ["icao"], [present_first("razao_social"), present_first("situacao"), latest_first("transformado_em")])


# --- Column rules on whole tables ---------------------------------------------------------------

@query("p2_null_if_sentinel", """
SELECT count(*) AS linhas, count(CASE WHEN partida_prevista <> 'null' THEN 1 END) AS com_partida,
  count(CASE WHEN codigo_justificativa <> '' THEN 1 END) AS com_motivo FROM brutos""")
def p2(spark, sf):
    raw = t.raw_flights(spark, sf)
    return raw.agg(F.count(F.lit(1)).alias("linhas"), F.count(ty.null_if_sentinel("Partida_Prevista")).alias("com_partida"),
                   F.count(ty.null_if_sentinel("`Código_Justificativa`", ("null", ""))).alias("com_motivo"))


@query("p6_delay_minutes", """
SELECT pedido, item, icao_empresa, numero_voo, atraso_partida_min, atraso_chegada_min, minutos_recuperados, duracao_voo_min FROM linhas""")
def p6(spark, sf):
    return t.rows(spark, sf, origin=False, destination=False).select(
        "pedido", "item", "icao_empresa", "numero_voo", "atraso_partida_min", "atraso_chegada_min", "minutos_recuperados", "duracao_voo_min")


@query("p12_keyword_status", """
SELECT situacao, CASE WHEN situacao = 'INATIVA' THEN 'inativa' WHEN situacao = 'ATIVA' THEN 'ativa' ELSE 'outro' END AS status,
  coalesce(situacao, '') LIKE '%ATIVA%' AS contem, count(*) AS registros FROM cadastro GROUP BY ALL""")
def p12(spark, sf):
    rows = silver.drop_header_rows(t.companies(spark, sf), "icao", ["icao"])
    return rows.select(
        "situacao", ty.keyword_status("situacao", {"ATIVA": "ativa", "INATIVA": "inativa"}, "outro").alias("status"),
        ty.has_keyword("situacao", "ATIVA", "substring").alias("contem"),
    ).groupBy("situacao", "status", "contem").agg(F.count(F.lit(1)).alias("registros"))


@query("p14_punctuality_flags", """
SELECT situacao_voo, partida_pontual, chegada_pontual, partida_atrasada, partida_atraso_severo, count(*) AS voos FROM linhas GROUP BY ALL""")
def p14(spark, sf):
    keys = ["situacao_voo", "partida_pontual", "chegada_pontual", "partida_atrasada", "partida_atraso_severo"]
    return t.rows(spark, sf, origin=False, destination=False).groupBy(*keys).agg(F.count(F.lit(1)).alias("voos"))


@query("p14_punctuality_thresholds", """
SELECT count(*) FILTER (WHERE atraso_partida_min <= 30) AS ate_30, count(*) FILTER (WHERE atraso_partida_min > 120) AS severos_120 FROM voos""")
def p14_other(spark, sf):
    f = t.flights(spark, sf, origin=False, destination=False)
    return f.agg(count_if(ty.on_time("atraso_partida_min", 30)).alias("ate_30"), count_if(ty.late("atraso_partida_min", 120)).alias("severos_120"))


@query("p15_day_period", "SELECT periodo_partida, count(*) AS voos FROM linhas GROUP BY 1")
def p15(spark, sf):
    f = t.flights(spark, sf, origin=False, destination=False)
    return f.groupBy(cal.day_period("partida_prevista_hora").alias("periodo_partida")).agg(F.count(F.lit(1)).alias("voos"))


@query("p16_distance_band", "SELECT faixa_distancia, count(*) AS rotas, CAST(sum(voos) AS BIGINT) AS voos FROM rota GROUP BY 1")
def p16(spark, sf):
    return t.rota(spark, sf).groupBy(distance_band("distancia_km").alias("faixa_distancia")).agg(
        F.count(F.lit(1)).alias("rotas"), F.sum("voos").alias("voos"))


@query("p17_calendar_attributes", """
SELECT DISTINCT CAST(ano * 10000 + mes * 100 + dia AS INT) AS sk_tempo, ano, mes, nome_mes, dia, dia_semana_num, nome_dia_semana,
  trimestre, ano_mes, fim_de_semana, estacao FROM linhas WHERE ano IS NOT NULL""")
def p17(spark, sf):
    days = t.flights(spark, sf, origin=False, destination=False).select("partida_prevista_data").filter(
        "partida_prevista_data IS NOT NULL").distinct()
    return days.select(*[c.alias(n) for n, c in cal.calendar_attributes("partida_prevista_data").items()])


@query("p18_haversine_km", "SELECT icao_origem, icao_destino, distancia_km FROM rota WHERE distancia_km IS NOT NULL")
def p18(spark, sf):
    pairs = t.flights(spark, sf).select("icao_origem", "icao_destino").distinct()
    for role in ("origem", "destino"):
        pairs = lookup(pairs, t.aerodromo(spark, sf), {f"icao_{role}": "icao"}, {"latitude": f"la_{role}", "longitude": f"lo_{role}"})
    km = haversine_km("la_origem", "lo_origem", "la_destino", "lo_destino")
    return pairs.select("icao_origem", "icao_destino", km.alias("distancia_km")).filter("distancia_km IS NOT NULL")


@query("p19_plausible_range", """
SELECT count(*) FILTER (WHERE atraso_partida_min BETWEEN -60 AND 1440) AS plausiveis,
  count(*) FILTER (WHERE atraso_partida_min < -60 OR atraso_partida_min > 1440) AS implausiveis,
  CAST(sum(atraso_partida_min) FILTER (WHERE atraso_partida_min BETWEEN -60 AND 1440) AS BIGINT) AS soma FROM voos""")
def p19(spark, sf):
    f = t.flights(spark, sf, origin=False, destination=False)
    ok = ty.plausible("atraso_partida_min")
    return f.agg(count_if(ok).alias("plausiveis"), count_if(ty.implausible("atraso_partida_min")).alias("implausiveis"),
                 F.sum(F.when(ok, F.col("atraso_partida_min"))).alias("soma"))


@query("p20_unknown_member", """
SELECT coalesce(v.municipio, '(sem municipio)') AS municipio, coalesce(nullif(l.codigo_justificativa, ''), '(sem codigo)') AS motivo,
  count(*) AS voos FROM linhas l LEFT JOIN aerodromo v ON l.icao_origem = v.icao GROUP BY 1, 2""")
def p20(spark, sf):
    sums = t.flights(spark, sf, destination=False).groupBy(
        "icao_origem", ty.filled("codigo_justificativa", "(sem codigo)").alias("motivo")).agg(F.count(F.lit(1)).alias("n"))
    named = lookup(sums, t.aerodromo(spark, sf), {"icao_origem": "icao"}, {"municipio": "m"})
    return named.groupBy(ty.unknown_member("m", "(sem municipio)").alias("municipio"), "motivo").agg(F.sum("n").alias("voos"))


@query("p21_route_key", "SELECT icao_origem || '>' || icao_destino AS rota, count(*) AS voos FROM voos GROUP BY 1")
def p21(spark, sf):
    sums = t.flights(spark, sf).groupBy("icao_origem", "icao_destino").agg(F.count(F.lit(1)).alias("voos"))
    return sums.select(ty.route_key("icao_origem", "icao_destino").alias("rota"), "voos")


@query("p26_label_of", "SELECT icao, rotulo FROM aerodromo")
def p26(spark, sf):
    return t.aerodromo(spark, sf).select("icao", ty.label_of("municipio", "nome", "icao").alias("rotulo"))


@query("p31_in_list", """
SELECT count(*) FILTER (WHERE situacao_voo IN ('REALIZADO', 'CANCELADO')) AS conhecidas,
  count(*) FILTER (WHERE situacao_voo NOT IN ('REALIZADO', 'CANCELADO')) AS outras, count(*) FILTER (WHERE situacao_voo IS NULL) AS nulas FROM brutos""")
def p31(spark, sf):
    s = F.col("`Situação_Voo`")
    return t.raw_flights(spark, sf).agg(
        count_if(s.isin(silver.KNOWN_STATUS)).alias("conhecidas"), count_if(~s.isin(silver.KNOWN_STATUS)).alias("outras"),
        count_if(s.isNull()).alias("nulas"))


@query("p22_month_label", "SELECT DISTINCT ano_mes, nome_mes, ordem FROM tempo")
def p22(spark, sf):
    months = t.rows(spark, sf, origin=False, destination=False).select("ano_mes", "ano", "mes").distinct()
    return months.select("ano_mes", cal.month_label("mes", "ano").alias("nome_mes"), cal.month_order("ano", "mes").alias("ordem"))


@query("d7_on_time_not_flown", """
SELECT count(*) FILTER (WHERE partida_pontual AND NOT flag_realizado) AS pontuais_nao_realizados,
  count(*) FILTER (WHERE partida_pontual) AS pontuais, avg(atraso_partida_min) FILTER (WHERE flag_realizado) AS atraso_medio_realizados FROM linhas""")
def d7(spark, sf):
    return star.on_time_without_status(t.rows(spark, sf, origin=False, destination=False))
