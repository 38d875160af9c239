"""Queries for quality marks, membership, reconciliation and derived facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import looks_mojibake
from ..operators import joins as jn
from ..operators import quality as ql
from ..operators import reconcile as rc
from ..operators.aggregates import count_if
from ..plans import cube as cb
from ..plans import facts, silver, star
from ..plans.questions import sums_by
from ..session import new_folder
from ..sources import catalog, export
from . import tables as t
from .registry import query

# References with gaps, so that every rule has rows to reject.
_MARKED = """
, marcados AS (
  SELECT b.*, EXISTS (SELECT 1 FROM cadastro c WHERE c.icao = b.icao_empresa AND c.situacao = 'ATIVA') AS valid_icao_empresa,
    EXISTS (SELECT 1 FROM aerodromo a WHERE CAST(a.icao AS VARCHAR) = b.icao_origem AND a.municipio IS NOT NULL) AS valid_icao_origem,
    EXISTS (SELECT 1 FROM aerodromo a WHERE CAST(a.icao AS VARCHAR) = b.icao_destino AND a.municipio IS NOT NULL) AS valid_icao_destino,
    partida_prevista <> 'null' AND chegada_prevista <> 'null' AS valid_horarios,
    coalesce(situacao_voo IN ('REALIZADO', 'CANCELADO'), false) AS valid_situacao
  FROM brutos b
), julgados AS (
  SELECT *, valid_icao_empresa AND valid_icao_origem AND valid_icao_destino AND valid_horarios AND valid_situacao AS is_valid,
    CASE WHEN NOT valid_icao_empresa THEN 'ICAO da empresa nao encontrado em silver.empresas'
         WHEN NOT valid_icao_origem THEN 'ICAO do aerodromo de origem nao encontrado em silver.aerodromos'
         WHEN NOT valid_icao_destino THEN 'ICAO do aerodromo de destino nao encontrado em silver.aerodromos'
         WHEN NOT valid_horarios THEN 'Horarios previstos de partida/chegada ausentes'
         WHEN NOT valid_situacao THEN 'Situacao do voo desconhecida' END AS motivo_exclusao
  FROM marcados)
"""
_ROW = """icao_empresa, numero_voo, codigo_di, codigo_tipo_linha, icao_origem, icao_destino, nullif(partida_prevista, 'null') AS partida_prevista,
  nullif(partida_real, 'null') AS partida_real, nullif(chegada_prevista, 'null') AS chegada_prevista, nullif(chegada_real, 'null') AS chegada_real,
  situacao_voo, codigo_justificativa, origem_arquivo, transformado_em AS ingestion_timestamp, valid_icao_empresa, valid_icao_origem,
  valid_icao_destino, valid_horarios, valid_situacao"""


def _marked(spark, sf):
    return silver.mark_flights(
        t.raw_flights(spark, sf), t.companies(spark, sf).filter("situacao = 'ATIVA'"), t.airports(spark, sf).filter("municipio IS NOT NULL"))


@query("q1_mark_quality", _MARKED + f"SELECT {_ROW}, is_valid, motivo_exclusao FROM julgados")
def q1(spark, sf):
    return _marked(spark, sf)


@query("q2_audited", _MARKED + f"SELECT {_ROW} FROM julgados WHERE is_valid")
def q2(spark, sf):
    audited, _ = ql.split_quality(_marked(spark, sf), loaded_at=None)
    observed, _ = ql.expect(audited, silver.audited_expectations())
    return observed


_EXPECTED = {
    "expect_icao_empresa_not_null": "icao_empresa IS NOT NULL", "expect_icao_empresa_valido": "valid_icao_empresa", "expect_icao_origem_valido": "valid_icao_origem",
    "expect_icao_destino_valido": "valid_icao_destino", "expect_horarios_presentes": "valid_horarios", "expect_situacao_conhecida": "valid_situacao",
}


@query("q2_expectation_counts", _MARKED + " UNION ALL ".join(
    f"SELECT '{name}' AS expectativa, count(*) AS linhas, count(*) FILTER (WHERE NOT coalesce({cond}, false)) AS falhas FROM julgados" for name, cond in _EXPECTED.items()))
def q2_counts(spark, sf):
    """All flights before the split, so every expectation has rows that break it."""
    return ql.expectation_counts(_marked(spark, sf), silver.audited_expectations())


@query("q3_quarantine", _MARKED + f"SELECT {_ROW}, motivo_exclusao FROM julgados WHERE NOT is_valid")
def q3(spark, sf):
    return ql.split_quality(_marked(spark, sf), loaded_at=None)[1]


@query("q4_completeness_proof", _MARKED + """
SELECT count(*) AS entrada, count(*) FILTER (WHERE is_valid) AS auditado, count(*) FILTER (WHERE NOT is_valid) AS quarentena, CAST(0 AS BIGINT) AS diferenca FROM julgados""")
def q4(spark, sf):
    return ql.completeness_proof(_marked(spark, sf))


@query("q4_split_summary", _MARKED + """
SELECT CASE WHEN is_valid THEN 'auditado' ELSE 'quarentena' END AS destino, coalesce(motivo_exclusao, '') AS motivo, count(*) AS registros FROM julgados GROUP BY 1, 2""")
def q4_summary(spark, sf):
    return ql.split_summary(_marked(spark, sf))


@query("q5_mirror_check", """
SELECT 'vra' AS tabela, count(*) AS bronze, count(*) AS silver, CAST(0 AS BIGINT) AS diferenca, 'OK' AS status FROM brutos
UNION ALL SELECT 'aerodromos', (SELECT count(*) FROM nation) + (SELECT count(*) FROM region), (SELECT count(*) FROM nation), (SELECT count(*) FROM region), 'ERRO'
UNION ALL SELECT 'empresas', count(*), count(*), 0, 'OK' FROM empresas""")
def q5(spark, sf):
    flights = t.raw_flights(spark, sf)
    return ql.mirror_check({
        "vra": (flights, silver.silver_flights(flights)),
        "aerodromos": (t.raw_airports(spark, sf), t.airports(spark, sf)),
        "empresas": ([t.raw_national(spark, sf), t.raw_foreign(spark, sf)], t.companies(spark, sf))})


@query("q5_conversion_counts", """
SELECT count(*) AS total_linhas, count(partida_real_data) AS partida_real_ok, count(chegada_prevista_hora) AS chegada_prevista_ok,
  count(atraso_partida_min) AS atraso_partida_ok, count(minutos_recuperados) AS minutos_recuperados_ok FROM voos""")
def q5_counts(spark, sf):
    return ql.conversion_counts(silver.silver_flights(t.raw_flights(spark, sf)), {
        "partida_real_data": "partida_real_ok", "chegada_prevista_hora": "chegada_prevista_ok",
        "atraso_partida_min": "atraso_partida_ok", "minutos_recuperados": "minutos_recuperados_ok"})


@query("q6_validate_code", """
SELECT 'empresas' AS tabela, count(*) AS total_registros, count(*) FILTER (WHERE NOT regexp_full_match(icao, '[0-9]{1,2}')) AS icao_invalidos,
  100.0 * CAST(count(*) FILTER (WHERE regexp_full_match(icao, '[0-9]{1,2}')) AS DOUBLE) / count(*) AS pct_validos FROM empresas
UNION ALL SELECT 'vra', count(*), count(*) FILTER (WHERE NOT regexp_full_match(icao_empresa, '[0-9]')),
  100.0 * CAST(count(*) FILTER (WHERE regexp_full_match(icao_empresa, '[0-9]')) AS DOUBLE) / count(*) FROM brutos
UNION ALL SELECT 'aerodromos', count(*), count(*) FILTER (WHERE NOT regexp_full_match(CAST(icao AS VARCHAR), '[0-9]{2}')),
  100.0 * CAST(count(*) FILTER (WHERE regexp_full_match(CAST(icao AS VARCHAR), '[0-9]{2}')) AS DOUBLE) / count(*) FROM aerodromo""")
def q6(spark, sf):
    return ql.code_validity({
        "empresas": (t.companies(spark, sf), "icao", "^[0-9]{1,2}$"), "vra": (t.flights(spark, sf, text_codes=True), "icao_empresa", "^[0-9]$"),
        "aerodromos": (t.airports(spark, sf), "icao", "^[0-9]{2}$")})


def _gappy_dims(spark, sf):
    d = t.dims(spark, sf)
    d["empresa"] = d["empresa"].filter("flag_ativa")
    d["aerodromo"] = d["aerodromo"].filter("municipio IS NOT NULL")
    d["rota"] = d["rota"].filter("distancia_km IS NOT NULL")
    return d


@query("q7_referential_coverage", """
SELECT 'fato_voos' AS tabela, count(*) AS total_voos, count(*) FILTER (WHERE NOT e.flag_ativa) AS sem_empresa,
  count(*) FILTER (WHERE o.municipio IS NULL) AS sem_origem, count(*) FILTER (WHERE d.municipio IS NULL) AS sem_destino,
  count(*) FILTER (WHERE r.distancia_km IS NULL) AS sem_rota,
  100.0 * CAST(count(*) FILTER (WHERE f.flag_realizado) AS DOUBLE) / count(*) AS pct_realizado,
  100.0 * CAST(count(*) FILTER (WHERE f.flag_cancelado) AS DOUBLE) / count(*) AS pct_cancelado,
  100.0 * CAST(count(*) FILTER (WHERE f.partida_pontual) AS DOUBLE) / count(*) FILTER (WHERE f.flag_realizado) AS pct_partida_pontual
FROM fato f JOIN dim_empresa e ON f.icao_empresa = e.icao JOIN dim_aerodromo o ON f.icao_origem = o.icao JOIN dim_aerodromo d ON f.icao_destino = d.icao
JOIN dim_rota r ON f.icao_origem = r.icao_origem AND f.icao_destino = r.icao_destino""")
def q7(spark, sf):
    return ql.referential_coverage(t.fact(spark, sf, _gappy_dims(spark, sf)), {
        "sem_empresa": "sk_empresa", "sem_origem": "sk_aerodromo_origem", "sem_destino": "sk_aerodromo_destino", "sem_rota": "sk_rota"})


@query("q8_load_audit", """
SELECT 'fato_voos' AS tabela, count(*) AS registros_total, count(*) FILTER (WHERE f.flag_realizado) AS registros_realizados,
  count(*) FILTER (WHERE f.flag_cancelado) AS registros_cancelados, count(*) FILTER (WHERE NOT e.flag_ativa) AS registros_sem_empresa,
  count(*) FILTER (WHERE o.municipio IS NULL) AS registros_sem_origem, count(*) FILTER (WHERE d.municipio IS NULL) AS registros_sem_destino,
  (SELECT count(*) FROM dim_empresa WHERE flag_ativa) AS dim_empresa_registros, (SELECT count(*) FROM dim_aerodromo WHERE municipio IS NOT NULL) AS dim_aerodromo_registros,
  (SELECT count(*) FROM dim_rota WHERE distancia_km IS NOT NULL) AS dim_rota_registros, 'SUCCESS' AS status
FROM fato f JOIN dim_empresa e ON f.icao_empresa = e.icao JOIN dim_aerodromo o ON f.icao_origem = o.icao JOIN dim_aerodromo d ON f.icao_destino = d.icao""")
def q8(spark, sf):
    d = _gappy_dims(spark, sf)
    audit = ql.load_audit(t.fact(spark, sf, d), {
        "dim_empresa_registros": d["empresa"], "dim_aerodromo_registros": d["aerodromo"], "dim_rota_registros": d["rota"]}, {
        "registros_sem_empresa": "sk_empresa", "registros_sem_origem": "sk_aerodromo_origem", "registros_sem_destino": "sk_aerodromo_destino"})
    return audit.drop("data_carga")


@query("q9_table_counts", """
SELECT 'dim_tempo' AS tabela, count(*) AS registros FROM dim_tempo UNION ALL SELECT 'empresas', count(*) FROM empresas
UNION ALL SELECT 'dim_rota', count(*) FROM dim_rota UNION ALL SELECT 'voos', count(*) FROM voos""")
def q9(spark, sf):
    f = t.flights(spark, sf)
    return ql.table_counts({"dim_tempo": star.build_dim_tempo(f), "empresas": t.companies(spark, sf), "dim_rota": t.rota(spark, sf), "voos": f})


@query("q10_obt_check", """
SELECT count(*) AS total_obt, (SELECT count(*) FROM fato) AS total_fato, count(*) FILTER (WHERE empresa_nome IS NULL) AS sem_empresa,
  count(*) FILTER (WHERE origem_nome IS NULL) AS sem_origem, count(*) FILTER (WHERE destino_nome IS NULL) AS sem_destino,
  count(rota_distancia_km) AS com_distancia,
  100.0 * CAST(count(*) FILTER (WHERE partida_pontual) AS DOUBLE) / count(*) FILTER (WHERE flag_realizado) AS pct_otp,
  count(DISTINCT empresa_nome) AS empresas_unicas, count(DISTINCT rota_faixa_distancia) AS faixas_distancia FROM obt""")
def q10(spark, sf):
    d = t.dims(spark, sf)
    f = t.fact(spark, sf, d)
    return ql.obt_check(star.build_obt(f, d), f)


@query("q11_reconcile_totals", """
SELECT 'total de voos' AS medida, CAST(sum(voos) AS BIGINT) AS no_fato, (SELECT count(*) FROM linhas) AS na_obt, CAST(0 AS BIGINT) AS diferenca FROM cubo
UNION ALL SELECT 'realizados', CAST(sum(realizados) AS BIGINT), (SELECT count(*) FROM linhas WHERE flag_realizado), 0 FROM cubo
UNION ALL SELECT 'partidas pontuais', CAST(sum(partidas_pontuais) AS BIGINT), (SELECT count(*) FROM linhas WHERE partida_pontual), 0 FROM cubo
UNION ALL SELECT 'soma do atraso de partida', CAST(sum(soma_atraso_partida) AS BIGINT), (SELECT CAST(sum(atraso_partida_min) AS BIGINT) FROM linhas), 0 FROM cubo""")
def q11(spark, sf):
    r = t.rows(spark, sf)
    return rc.reconcile_totals(cb.additive_cube(r), r, {
        "total de voos": (F.sum("voos"), F.count(F.lit(1))), "realizados": (F.sum("realizados"), count_if("flag_realizado")),
        "partidas pontuais": (F.sum("partidas_pontuais"), count_if("partida_pontual")),
        "soma do atraso de partida": (F.sum("soma_atraso_partida"), F.sum("atraso_partida_min"))})


@query("q12_reconcile_grain", """
SELECT icao_empresa, ano_mes, CAST(sum(realizados) AS BIGINT) AS realizados_cubo, CAST(sum(realizados) AS BIGINT) AS realizados_base,
  CAST(0 AS BIGINT) AS realizados_diferenca, CAST(sum(partidas_pontuais) AS BIGINT) AS pontuais_cubo, CAST(sum(partidas_pontuais) AS BIGINT) AS pontuais_base,
  CAST(0 AS BIGINT) AS pontuais_diferenca, 'ambos' AS presenca FROM cubo GROUP BY 1, 2""")
def q12(spark, sf):
    r = t.rows(spark, sf)
    left = sums_by(cb.additive_cube(r), "icao_empresa", "ano_mes").select("icao_empresa", "ano_mes", "realizados", F.col("partidas_pontuais").alias("pontuais"))
    right = r.groupBy("icao_empresa", "ano_mes").agg(count_if("flag_realizado").alias("realizados"), count_if("partida_pontual").alias("pontuais"))
    return rc.reconcile(left, right, ["icao_empresa", "ano_mes"], ["realizados", "pontuais"], ("cubo", "base"))


@query("q12_reconcile_by_checksums", """
WITH l AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS centavos FROM orders),
r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 499 = 0 THEN centavos + 1 ELSE centavos END AS centavos FROM l WHERE o_orderkey % 1013 <> 5)
SELECT l.o_orderkey, l.centavos AS centavos_pedidos, r.centavos AS centavos_copia, l.centavos - r.centavos AS centavos_diferenca,
  CASE WHEN r.o_orderkey IS NULL THEN 'so_pedidos' ELSE 'ambos' END AS presenca
FROM l LEFT JOIN r ON l.o_orderkey = r.o_orderkey WHERE l.centavos IS DISTINCT FROM r.centavos""", views=False)
def q12_checksums(spark, sf):
    """A copy with changed and missing orders; rows outside differing buckets are summed, not joined."""
    o = t.table(spark, sf, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("centavos"))
    changed = F.when(F.col("o_orderkey") % 499 == 0, F.col("centavos") + 1).otherwise(F.col("centavos"))
    copy = o.where("o_orderkey % 1013 <> 5").withColumn("centavos", changed)
    return rc.reconcile_differences(o, copy, ["o_orderkey"], ["centavos"], ("pedidos", "copia"))


@query("j14_reconcile_missing_keys", """
SELECT coalesce(a.k, b.k) AS codigo_justificativa, a.n AS voos_cancelados, b.n AS voos_todos, a.n - b.n AS voos_diferenca,
  CASE WHEN a.achou AND b.achou THEN 'ambos' WHEN a.achou THEN 'so_cancelados' ELSE 'so_todos' END AS presenca
FROM (SELECT codigo_justificativa AS k, count(*) AS n, true AS achou FROM voos WHERE situacao_voo = 'CANCELADO' AND codigo_justificativa <> '' GROUP BY 1) a
FULL JOIN (SELECT codigo_justificativa AS k, count(*) AS n, true AS achou FROM voos WHERE codigo_justificativa IS DISTINCT FROM '1-URGENT' GROUP BY 1) b
ON a.k IS NOT DISTINCT FROM b.k""")
def j14(spark, sf):
    f = t.flights(spark, sf, origin=False, destination=False)
    by = lambda df: df.groupBy("codigo_justificativa").agg(F.count(F.lit(1)).alias("voos"))
    left = by(f.filter("situacao_voo = 'CANCELADO' AND codigo_justificativa <> ''"))
    right = by(f.filter("codigo_justificativa IS DISTINCT FROM '1-URGENT'"))
    return rc.reconcile(left, right, ["codigo_justificativa"], ["voos"], ("cancelados", "todos"))


@query("j4_mark_reference", """
SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS conhecido FROM orders""", views=False)
def j4(spark, sf):
    ref = t.table(spark, sf, "customer").filter("c_acctbal > 0")
    return jn.mark_reference(t.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ref, "o_custkey", "c_custkey", "conhecido").drop("o_custkey")


@query("j9_members_of", "SELECT count(*) AS pedidos, CAST(sum(o_orderkey) AS BIGINT) AS soma FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')", views=False)
def j9(spark, sf):
    m = t.table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'")
    return jn.members_of(t.table(spark, sf, "orders"), "o_custkey", m, "c_custkey").agg(F.count(F.lit(1)).alias("pedidos"), F.sum("o_orderkey").alias("soma"))


@query("j10_not_members_of", """
SELECT count(*) AS pedidos, CAST(sum(o_orderkey) AS BIGINT) AS soma FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""", views=False)
def j10(spark, sf):
    """A NULL among the members does not empty the answer."""
    c = t.table(spark, sf, "customer")
    m = c.select(F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_custkey")).alias("m"))
    return jn.not_members_of(t.table(spark, sf, "orders"), "o_custkey", m, "m").agg(F.count(F.lit(1)).alias("pedidos"), F.sum("o_orderkey").alias("soma"))


@query("j11_membership_split", """
SELECT CASE WHEN a.municipio IS NULL THEN 'fora' ELSE 'dentro' END AS lado, count(DISTINCT v.icao_origem) AS origens, count(*) AS voos
FROM voos v JOIN aerodromo a ON v.icao_origem = a.icao GROUP BY 1""")
def j11(spark, sf):
    cube = t.cube(spark, sf, destination=False)
    return facts.inside_outside(cube.with_parts(aerodromo=cube.aerodromo.filter("municipio IS NOT NULL")))


@query("j15_match_with_tolerance", """
SELECT e.event_id, e.user_id FROM events e WHERE e.event_type = 'click' AND EXISTS (
  SELECT 1 FROM events v WHERE v.event_type = 'view' AND v.user_id = e.user_id
  AND abs(e.value - v.value) <= CASE WHEN e.event_id % 2 = 0 THEN 0.05 ELSE 0.5 END)""", views=False)
def j15(spark, sf):
    e = t.table(spark, sf, "events")
    want = e.filter("event_type = 'click'").select("event_id", "user_id", "value", F.when(F.col("event_id") % 2 == 0, 0.05).otherwise(0.5).alias("tol"))
    seen = e.filter("event_type = 'view'").select("user_id", F.col("value").alias("v"))
    return rc.match_with_tolerance(want, seen, ["user_id"], "value", "tol", "v").select("event_id", "user_id")


@query("j15_without_match", """
SELECT e.event_id, e.user_id FROM events e WHERE e.event_type = 'click' AND NOT EXISTS (
  SELECT 1 FROM events v WHERE v.event_type = 'view' AND v.user_id = e.user_id AND abs(e.value - v.value) <= 0.05)""", views=False)
def j15_anti(spark, sf):
    e = t.table(spark, sf, "events")
    want = e.filter("event_type = 'click'").select("event_id", "user_id", "value", F.lit(0.05).alias("tol"))
    seen = e.filter("event_type = 'view'").select("user_id", F.col("value").alias("v"))
    return rc.match_with_tolerance(want, seen, ["user_id"], "value", "tol", "v", "anti").select("event_id", "user_id")


@query("u5_set_diff", """
SELECT p_brand, p_type, 'so_esquerda' AS lado FROM (SELECT p_brand, p_type FROM part WHERE p_size < 10 EXCEPT SELECT p_brand, p_type FROM part WHERE p_size > 30)
UNION ALL SELECT p_brand, p_type, 'so_direita' FROM (SELECT p_brand, p_type FROM part WHERE p_size > 30 EXCEPT SELECT p_brand, p_type FROM part WHERE p_size < 10)""", views=False)
def u5(spark, sf):
    p = t.table(spark, sf, "part")
    return jn.set_diff(p.filter("p_size < 10"), p.filter("p_size > 30"), ["p_brand", "p_type"])


@query("q16_mojibake_by_source", """
SELECT source, count(*) FILTER (WHERE text LIKE '%Ã%') AS com_mojibake, count(*) AS textos FROM documents GROUP BY 1""", views=False)
def q16(spark, sf):
    return t.table(spark, sf, "documents").groupBy("source").agg(
        count_if(looks_mojibake("text")).alias("com_mojibake"), F.count(F.lit(1)).alias("textos"))


@query("q18_export_quality", """
SELECT count(*) AS total_voos, count(*) FILTER (WHERE ano_mes IS NULL) AS sem_data_prevista, count(*) FILTER (WHERE flag_cancelado) AS cancelados,
  count(DISTINCT CASE WHEN flag_cancelado THEN codigo_justificativa END) AS justificativas_distintas, count(DISTINCT icao_empresa) AS empresas,
  count(DISTINCT icao_origem) AS origens,
  100.0 * CAST(count(*) FILTER (WHERE partida_pontual) AS DOUBLE) / count(*) FILTER (WHERE flag_realizado) AS otp_global,
  100.0 * CAST(count(*) FILTER (WHERE partida_pontual AND ano_mes IS NOT NULL) AS DOUBLE) / count(*) FILTER (WHERE flag_realizado AND ano_mes IS NOT NULL) AS otp_com_data,
  count(*) FILTER (WHERE atraso_partida_min < -60 OR atraso_partida_min > 1440) AS atrasos_implausiveis FROM linhas""")
def q18(spark, sf):
    return facts.export_quality(t.rows(spark, sf, destination=False))


_OTP = "100.0 * CAST(sum(partidas_pontuais) AS DOUBLE) / nullif(sum(realizados), 0)"


@query("q19_period", """
SELECT min(ano_mes) AS inicio, max(ano_mes) FILTER (WHERE dias_com_voo >= 28) AS fim, count(*) FILTER (WHERE dias_com_voo >= 28) AS meses_completos,
  count(*) FILTER (WHERE dias_com_voo < 28) AS meses_parciais FROM tempo WHERE ano_mes IS NOT NULL""")
def q19_period(spark, sf):
    return facts.period_fact(t.tempo(spark, sf))


@query("q19_otp_extremes", f"""
, m AS (SELECT t.nome_mes, t.ano_mes, {_OTP} AS otp FROM cubo f JOIN tempo t ON f.ano_mes = t.ano_mes WHERE t.dias_com_voo >= 28 GROUP BY 1, 2)
SELECT (SELECT nome_mes FROM m ORDER BY otp, ano_mes LIMIT 1) AS mes_min, (SELECT min(otp) FROM m) AS min,
  (SELECT nome_mes FROM m ORDER BY otp DESC, ano_mes LIMIT 1) AS mes_max, (SELECT max(otp) FROM m) AS max""")
def q19_extremes(spark, sf):
    return facts.otp_extremes(t.cube(spark, sf, origin=False, destination=False))


@query("q19_uncovered_airports", """
SELECT count(*) FILTER (WHERE uf IS NULL) AS total, count(*) FILTER (WHERE uf IS NULL AND icao < 10) AS estrangeiros,
  count(*) FILTER (WHERE uf IS NULL AND icao >= 10) AS brasileiros,
  100.0 * CAST(sum(v) FILTER (WHERE uf IS NULL) AS DOUBLE) / sum(v) AS pct_partidas
FROM aerodromo a LEFT JOIN (SELECT icao_origem, count(*) AS v FROM voos GROUP BY 1) p ON a.icao = p.icao_origem""")
def q19_uncovered(spark, sf):
    return facts.uncovered_airports(t.cube(spark, sf, destination=False), "^[0-9]{2}$")


@query("q19_outside_dimension", """
SELECT count(*) AS origens, CAST(coalesce(sum(v), 0) AS BIGINT) AS voos FROM (SELECT icao_origem, count(*) AS v FROM voos GROUP BY 1) p
WHERE icao_origem NOT IN (SELECT icao FROM aerodromo WHERE municipio IS NOT NULL)""")
def q19_outside(spark, sf):
    cube = t.cube(spark, sf, destination=False)
    return facts.outside_dimension(cube.with_parts(aerodromo=cube.aerodromo.filter("municipio IS NOT NULL")))


@query("q19_otp_by_nationality", f"""
SELECT max(o) FILTER (WHERE nacional) AS nacionais, max(o) FILTER (WHERE NOT nacional) AS estrangeiras FROM (
  SELECT e.nacional, {_OTP} AS o FROM cubo f JOIN empresa e ON f.icao_empresa = e.icao_empresa GROUP BY 1)""")
def q19_nationality(spark, sf):
    return facts.otp_by_nationality(t.cube(spark, sf, origin=False, destination=False))


@query("q19_routes_without_distance", """
SELECT count(*) FILTER (WHERE distancia_km IS NULL) AS rotas, CAST(sum(voos) FILTER (WHERE distancia_km IS NULL) AS BIGINT) AS voos,
  100.0 * CAST(sum(voos) FILTER (WHERE distancia_km IS NULL) AS DOUBLE) / sum(voos) AS pct_voos FROM rota""")
def q19_routes(spark, sf):
    return facts.routes_without_distance(t.rota(spark, sf))


@query("q22_check_aliases", """
, ap AS (SELECT DISTINCT lower(p_type) || CASE WHEN p_partkey % 50 = 0 THEN '!' ELSE '' END AS apelido, p_brand AS alvo FROM part WHERE p_size = 7),
alvos AS (SELECT DISTINCT p_brand AS alvo FROM part WHERE p_size > 20 AND p_brand <> 'Brand#3')
SELECT apelido, alvo, 'alvo inexistente' AS problema FROM ap WHERE alvo NOT IN (SELECT alvo FROM alvos)
UNION ALL SELECT apelido, alvo, 'nao normalizado' FROM ap WHERE apelido LIKE '%!'
UNION ALL SELECT apelido, NULL, 'mais de um alvo' FROM ap GROUP BY apelido HAVING count(DISTINCT alvo) > 1
UNION ALL SELECT apelido, alvo, 'apelido fora do nome' FROM ap WHERE NOT EXISTS (
  SELECT 1 FROM part q WHERE q.p_brand = ap.alvo AND q.p_size = 8 AND contains(lower(q.p_type), apelido))""")
def q22(spark, sf):
    p = t.table(spark, sf, "part")
    mark = F.when(F.col("p_partkey") % 50 == 0, F.lit("!")).otherwise(F.lit(""))
    aliases = p.filter("p_size = 7").select(F.concat(F.lower("p_type"), mark).alias("apelido"), F.col("p_brand").alias("alvo"), F.lit("base").alias("fonte"))
    targets = p.filter("p_size > 20 AND p_brand <> 'Brand#3'").select(F.col("p_brand").alias("alvo"))
    names = p.filter("p_size = 8").select(F.col("p_brand").alias("alvo"), F.col("p_type").alias("nome"))
    return ql.check_aliases(aliases, targets, names)


@query("q24_missing_placeholders", """
SELECT lower(o_orderstatus) AS marcador, count(*) AS usos FROM orders WHERE lower(o_orderstatus) NOT IN (SELECT lower(l_linestatus) FROM lineitem) GROUP BY 1""", views=False)
def q24(spark, sf):
    texts = t.table(spark, sf, "orders").select(F.concat(F.lit("estado {"), F.lower("o_orderstatus"), F.lit("} do pedido")).alias("texto"))
    known = t.table(spark, sf, "lineitem").select(F.lower("l_linestatus").alias("fato"))
    return ql.missing_placeholders(texts, "texto", known, "fato")


@query("q13_q14_comment_coverage", """
SELECT 'rota' AS tabela, count(*) AS registros, CAST(6 AS BIGINT) AS colunas, CAST(4 AS BIGINT) AS sem_comentario, 100.0::DOUBLE * 2 / 6 AS pct_documentado, 'gold' AS camada,
  'distancia_km,icao_origem' AS comentadas FROM rota""")
def q14(spark, sf):
    """Comments, tags and documentation coverage of a saved dimension, with its rows."""
    name = "dim_rota_" + new_folder(spark, "x").rsplit("-", 1)[-1]
    catalog.save_table(t.rota(spark, sf), name, "Rotas em uso", new_folder(spark, "rota"))
    catalog.apply_comments(spark, name, {"icao_origem": "Codigo de origem", "distancia_km": "Distancia em km"})
    catalog.apply_tags(spark, name, {"camada": "gold"})
    columns = catalog.catalog_columns(spark, [name])
    covered = catalog.comment_coverage(columns).select("colunas", "sem_comentario", "pct_documentado")
    done = columns.filter("comment <> ''").agg(F.array_join(F.sort_array(F.collect_list("column_name")), ",").alias("comentadas"))
    rows = catalog.layer_summary(spark, {"rota": name}).drop("colunas")
    for one in (covered, done):  # one row each
        rows = rows.withColumn("_x", one.select(F.struct("*")).scalar()).select(*rows.columns, "_x.*")
    return rows.withColumn("camada", F.lit(catalog.table_tags(spark, name)["camada"]))


@query("s16_write_by_month", "SELECT ano_mes, count(*) AS voos FROM linhas GROUP BY 1")
def s16(spark, sf):
    path = new_folder(spark, "mensal")
    export.write_by_month(t.rows(spark, sf, origin=False, destination=False).select("ano_mes", "icao_empresa", "atraso_partida_min"), path)
    back = spark.read.schema("icao_empresa bigint, atraso_partida_min bigint, ano_mes string").parquet(path)
    return back.groupBy("ano_mes").agg(F.count(F.lit(1)).alias("voos"))


@query("s18_write_clustered", _MARKED + "SELECT coalesce(motivo_exclusao, '') AS motivo, count(*) AS registros FROM julgados WHERE NOT is_valid GROUP BY 1")
def s18(spark, sf):
    path = new_folder(spark, "quarentena")
    export.write_clustered(ql.split_quality(_marked(spark, sf))[1], path, ["motivo_exclusao"])
    return spark.read.parquet(path).groupBy(F.coalesce("motivo_exclusao", F.lit("")).alias("motivo")).agg(F.count(F.lit(1)).alias("registros"))


@query("s18_write_on_curve", "SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS ano, count(*) AS linhas, true AS menos_da_metade FROM lineitem GROUP BY 1, 2", views=False)
def s18_curve(spark, sf):
    """Clustered by day and price at once; a tenth of either column's range is found in less than half of the files."""
    path = new_folder(spark, "curva")
    rows = t.table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", "l_extendedprice")
    export.write_on_curve(rows, path, ["l_shipdate", "l_extendedprice"], files=16)
    back, skips = spark.read.parquet(path), True
    for c in ("l_shipdate", "l_extendedprice"):
        ends = rows.agg(F.min(c), F.expr(f"percentile_approx({c}, 0.1)")).first()
        hit, n = export.files_touched(spark, path, c, *ends)
        skips = skips and 2 * hit < n
    return back.groupBy("l_returnflag", F.year("l_shipdate").alias("ano")).agg(F.count(F.lit(1)).alias("linhas"), F.lit(skips).alias("menos_da_metade"))
