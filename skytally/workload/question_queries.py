"""Queries for the question family, answered from flights of weight one or from the stored cube."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import questions as qs
from ..plans.questions import Cube, Place, Question
from . import tables as t
from .registry import query

OTP = "100.0 * CAST(sum(partidas_pontuais) AS DOUBLE) / nullif(sum(realizados), 0)"
TAXA = "100.0 * CAST(sum(cancelados) AS DOUBLE) / nullif(sum(f.voos), 0)"
ATRASO = "CAST(sum(soma_atraso_plausivel) AS DOUBLE) / nullif(sum(com_atraso_plausivel), 0)"
BRUTO = "CAST(sum(soma_atraso_partida) AS DOUBLE) / nullif(sum(com_atraso_partida), 0)"
N = lambda c: f"CAST(sum({c}) AS BIGINT)"
VOOS, DONE, CANC = N("f.voos"), N("realizados"), N("cancelados")
EMP = "cubo f JOIN empresa e ON f.icao_empresa = e.icao_empresa"
ORI = "cubo f JOIN aerodromo a ON f.icao_origem = a.icao"
MES = "JOIN tempo t ON f.ano_mes = t.ano_mes AND t.dias_com_voo >= 28"


def _no_ends(spark, sf):
    return t.cube(spark, sf, origin=False, destination=False)


def _origin(spark, sf):
    return t.cube(spark, sf, destination=False)


@query("k1_cancellation_ranking", f"""
SELECT e.nome AS empresa, {TAXA} AS taxa, {VOOS} AS programados FROM {EMP} GROUP BY e.nome HAVING sum(f.voos) >= 500
ORDER BY taxa DESC, empresa LIMIT 15""")
def k1(spark, sf):
    return qs.cancellation_ranking(_no_ends(spark, sf))


@query("k1_a13_cancellation_leader", f"""
SELECT e.nome AS rotulo_topo, {TAXA} AS taxa FROM {EMP} GROUP BY e.nome HAVING sum(f.voos) >= 500 ORDER BY taxa DESC, rotulo_topo LIMIT 1""")
def k1_leader(spark, sf):
    return qs.cancellation_leader(_no_ends(spark, sf))


@query("k2_otp_by_month", f"""
SELECT t.nome_mes AS mes, {OTP} AS otp, {DONE} AS realizados, t.ordem FROM cubo f {MES} GROUP BY t.nome_mes, t.ordem""")
def k2(spark, sf):
    return qs.otp_by_month(_no_ends(spark, sf))


@query("k2_a14_months_as_columns", """
SELECT max(otp) FILTER (WHERE ano_mes = '1997-08') AS ago97, max(otp) FILTER (WHERE ano_mes = '1997-12') AS dez97 FROM (
  SELECT ano_mes, """ + OTP + """ AS otp FROM cubo GROUP BY 1)""")
def k2_columns(spark, sf):
    return qs.otp_of_months(_no_ends(spark, sf), {"ago97": "1997-08", "dez97": "1997-12"})


def _direction_sql(place: str, inner: bool, floor: int, order: str) -> str:
    keep = "" if inner else "AND f.{0} NOT IN (SELECT icao FROM lugar)"
    side = lambda home, other: (
        f"SELECT f.{other} AS ponta, {OTP} AS otp, sum(realizados) AS n FROM cubo f "
        f"WHERE f.{home} IN (SELECT icao FROM lugar) {keep.format(other)} GROUP BY 1")
    return f""", lugar AS ({place}), saindo AS ({side('icao_origem', 'icao_destino')}), chegando AS ({side('icao_destino', 'icao_origem')})
SELECT rota, saindo, chegando, icao FROM (
  SELECT a.rotulo || CASE WHEN count(*) OVER (PARTITION BY a.rotulo) > 1 THEN ' (' || a.icao || ')' ELSE '' END AS rota,
    s.otp AS saindo, c.otp AS chegando, a.icao FROM saindo s JOIN chegando c ON s.ponta = c.ponta JOIN aerodromo a ON a.icao = s.ponta
  WHERE s.n >= {floor} AND c.n >= {floor})
ORDER BY {order} DESC, icao LIMIT 14"""


@query("k3_direction_of_set", _direction_sql("SELECT 1 AS icao UNION ALL SELECT 6", True, 100, "(chegando - saindo)"))
def k3(spark, sf):
    return qs.direction_compare(t.cube(spark, sf), Place("conjunto", codes=(1, 6)), False, "signed", 100)


@query("k18_direction_compare_state", _direction_sql("SELECT icao FROM aerodromo WHERE uf = 'R1'", False, 300, "abs(chegando - saindo)"))
def k18_state(spark, sf):
    return qs.direction_compare(t.cube(spark, sf), Place("uf", "R1"), min_flights=300)


@query("k18_direction_compare_city", _direction_sql("SELECT icao FROM aerodromo WHERE municipio = 'MUN_1'", False, 100, "abs(chegando - saindo)"))
def k18_city(spark, sf):
    return qs.direction_compare(t.cube(spark, sf), Place("municipio", "MUN_1"), min_flights=100)


@query("k18_direction_compare_airport", _direction_sql("SELECT 7 AS icao", False, 50, "abs(chegando - saindo)"))
def k18_airport(spark, sf):
    return qs.direction_compare(t.cube(spark, sf), Place("aeroporto", 7), min_flights=50)


@query("k26_leaving_worse_count", """
, lugar AS (SELECT icao FROM aerodromo WHERE uf = 'R1'),
saindo AS (SELECT icao_destino AS ponta, """ + OTP + """ AS otp, sum(realizados) AS n FROM cubo WHERE icao_origem IN (SELECT icao FROM lugar)
  AND icao_destino NOT IN (SELECT icao FROM lugar) GROUP BY 1),
chegando AS (SELECT icao_origem AS ponta, """ + OTP + """ AS otp, sum(realizados) AS n FROM cubo WHERE icao_destino IN (SELECT icao FROM lugar)
  AND icao_origem NOT IN (SELECT icao FROM lugar) GROUP BY 1)
SELECT count(*) AS rotas, count(*) FILTER (WHERE s.otp < c.otp) AS sair_pior FROM saindo s JOIN chegando c ON s.ponta = c.ponta WHERE s.n >= 300 AND c.n >= 300""")
def k26(spark, sf):
    return qs.leaving_worse_count(t.cube(spark, sf), Place("uf", "R1"), 300)


@query("k4_busiest_airports", f"""
SELECT a.icao, a.rotulo AS local, a.latitude, a.longitude, {VOOS} AS voos, {OTP} AS otp FROM {ORI} WHERE a.latitude IS NOT NULL
GROUP BY a.icao, a.rotulo, a.latitude, a.longitude HAVING sum(f.voos) >= 900 ORDER BY voos DESC, a.icao LIMIT 80""")
def k4(spark, sf):
    return qs.busiest_airports(_origin(spark, sf))


@query("k4_airport_movement", """
SELECT local, CAST(sum(p) AS BIGINT) AS partidas, CAST(sum(c) AS BIGINT) AS chegadas, CAST(sum(p + c) AS BIGINT) AS movimento FROM (
  SELECT icao_origem AS local, voos AS p, 0 AS c FROM cubo UNION ALL SELECT icao_destino, 0, voos FROM cubo) GROUP BY 1""")
def k4_movement(spark, sf):
    return qs.airport_movement(t.cube(spark, sf))


@query("k5_national_vs_foreign", f"""
SELECT CASE WHEN e.nacional THEN 'Nacionais' ELSE 'Estrangeiras' END AS grupo, {ATRASO} AS atraso, {OTP} AS otp, {DONE} AS realizados FROM {EMP} GROUP BY 1""")
def k5(spark, sf):
    return qs.national_vs_foreign(_no_ends(spark, sf))


@query("k5_gross_delay_columns", f"""
SELECT max(m) FILTER (WHERE nacional) AS nacionais, max(m) FILTER (WHERE NOT nacional) AS estrangeiras FROM (
  SELECT e.nacional, {BRUTO} AS m FROM {EMP} GROUP BY 1)""")
def k5_columns(spark, sf):
    return qs.national_vs_foreign_columns(_no_ends(spark, sf), "atraso_bruto")


@query("k6_otp_by_period", f"SELECT periodo_partida AS periodo, {OTP} AS otp, {DONE} AS realizados FROM cubo WHERE periodo_partida IS NOT NULL GROUP BY 1")
def k6(spark, sf):
    return qs.otp_by_period(_no_ends(spark, sf))


@query("k7_departures_of_state", f"""
SELECT a.rotulo AS aeroporto, a.icao, {VOOS} AS partidas FROM {ORI} WHERE a.uf = 'R2' GROUP BY a.icao, a.rotulo""")
def k7(spark, sf):
    return qs.departures_of_state(_origin(spark, sf), "R2")


@query("k8_brand_flights", f"SELECT e.nome AS empresa, {VOOS} AS voos FROM {EMP} WHERE e.marca = 'M0' GROUP BY 1")
def k8(spark, sf):
    return qs.brand_flights(_no_ends(spark, sf), "M0")


@query("k9_brand_otp", f"SELECT {OTP} AS otp, {DONE} AS realizados FROM {EMP} WHERE e.marca = 'M1' AND f.ano_mes IS NOT NULL")
def k9(spark, sf):
    return qs.brand_otp(_no_ends(spark, sf), "M1")


@query("k9_brand_otp_all_flights", f"SELECT {OTP} AS otp, {DONE} AS realizados FROM {EMP} WHERE e.marca = 'M1'")
def k9_all(spark, sf):
    return qs.brand_otp(_no_ends(spark, sf), "M1", dated_only=False)


@query("k9_brand_by_month", f"SELECT f.ano_mes, {VOOS} AS voos FROM {EMP} WHERE e.marca = 'M0' GROUP BY 1")
def k9_month(spark, sf):
    return qs.brand_by_month(_no_ends(spark, sf), "M0")


@query("k10_monthly_otp_of_airport", f"""
SELECT t.nome_mes AS mes, {OTP} AS otp, t.ordem FROM {ORI} {MES} WHERE strip_accents(upper(a.nome)) LIKE '%NATION_1%'
GROUP BY t.nome_mes, t.ordem""")
def k10(spark, sf):
    return qs.monthly_otp_of_airport(_origin(spark, sf), "nation_1")


@query("k11_top_destinations", f"""
SELECT d.rotulo || ' (' || d.icao || ')' AS destino, {VOOS} AS voos FROM {ORI} JOIN aerodromo d ON f.icao_destino = d.icao
WHERE strip_accents(upper(a.municipio)) = 'MUN_1' GROUP BY d.icao, d.rotulo ORDER BY voos DESC, destino LIMIT 15""")
def k11(spark, sf):
    return qs.top_destinations(t.cube(spark, sf), "mun_1")


@query("k12_delay_ranking", f"""
SELECT coalesce(e.nome, CAST(e.icao_empresa AS VARCHAR)) AS empresa, {ATRASO} AS atraso, {DONE} AS realizados FROM {EMP}
GROUP BY e.icao_empresa, e.nome HAVING sum(realizados) >= 500 ORDER BY atraso DESC, empresa LIMIT 15""")
def k12(spark, sf):
    return qs.delay_ranking(_no_ends(spark, sf))


@query("k13_longest_routes", """
SELECT o.rotulo || ' → ' || d.rotulo AS rota, r.distancia_km AS km, r.voos FROM rota r JOIN aerodromo o ON r.icao_origem = o.icao
JOIN aerodromo d ON r.icao_destino = d.icao WHERE r.distancia_km IS NOT NULL AND NOT r.origem_igual_destino ORDER BY km DESC, rota LIMIT 10""")
def k13(spark, sf):
    return qs.longest_routes(t.cube(spark, sf))


@query("k14_cancellations_in_month", f"SELECT {CANC} AS cancelados, {TAXA} AS taxa FROM cubo f JOIN tempo t ON f.ano_mes = t.ano_mes WHERE t.nome_mes = 'mar/1997'")
def k14(spark, sf):
    return qs.cancellations_in_month(_no_ends(spark, sf), "mar/1997")


@query("k15_cancellation_by_month", f"""
SELECT t.nome_mes AS mes, {TAXA} AS taxa, t.ordem FROM cubo f {MES} GROUP BY t.nome_mes, t.ordem""")
def k15(spark, sf):
    return qs.cancellation_by_month(_no_ends(spark, sf))


@query("k16_departures_by_state", f"""
SELECT a.estado, {VOOS} AS partidas FROM {ORI} WHERE a.uf IS NOT NULL GROUP BY a.uf, a.estado""")
def k16(spark, sf):
    return qs.departures_by_state(_origin(spark, sf))


# --- Template: measure x place x direction x brand x month x series -----------------------------

@query("k17_flights_to_state", f"""
SELECT a.rotulo AS aeroporto, a.icao, {VOOS} AS voos FROM cubo f JOIN aerodromo a ON f.icao_destino = a.icao WHERE a.uf = 'R1'
GROUP BY a.icao, a.rotulo""")
def k17_flights(spark, sf):
    return qs.measure_query(t.cube(spark, sf), Question("voos", place=Place("uf", "R1"), direction="destino"))


@query("k17_otp_of_city_in_month", f"SELECT {OTP} AS otp, {DONE} AS realizados FROM {ORI} WHERE a.municipio = 'MUN_2' AND f.ano_mes = '1997-05'")
def k17_otp(spark, sf):
    return qs.measure_query(t.cube(spark, sf), Question("otp", place=Place("municipio", "MUN_2"), month="1997-05"))


@query("k17_otp_of_brand", f"SELECT {OTP} AS otp, {DONE} AS realizados FROM {EMP} WHERE e.marca = 'M0' AND f.ano_mes IS NOT NULL")
def k17_brand(spark, sf):
    return qs.measure_query(t.cube(spark, sf), Question("otp", brand="M0"))


@query("k17_cancellations_by_operator", f"""
SELECT e.nome AS empresa, {CANC} AS cancelados, {TAXA} AS taxa FROM {EMP} WHERE e.marca = 'M0' GROUP BY 1""")
def k17_cancel(spark, sf):
    return qs.measure_query(t.cube(spark, sf), Question("cancelamento", brand="M0"))


@query("k17_cancellation_rate_of_airport", f"SELECT {CANC} AS cancelados, {TAXA} AS taxa FROM cubo f WHERE icao_origem = 7")
def k17_rate(spark, sf):
    return qs.measure_query(t.cube(spark, sf), Question("cancelamento", rate=True, place=Place("aeroporto", 7)))


@query("k17_delay_series_of_state", f"""
SELECT t.nome_mes AS mes, {ATRASO} AS atraso, {DONE} AS realizados, t.ordem FROM {ORI} {MES} WHERE a.uf = 'R3'
GROUP BY t.nome_mes, t.ordem""")
def k17_series(spark, sf):
    return qs.measure_query(t.cube(spark, sf), Question("atraso", place=Place("uf", "R3"), series=True))


@query("k19_follow_up", f"""
SELECT a.rotulo AS aeroporto, a.icao, {VOOS} AS voos FROM cubo f JOIN aerodromo a ON f.icao_destino = a.icao WHERE a.uf = 'R4'
GROUP BY a.icao, a.rotulo""")
def k19(spark, sf):
    first = Question("voos", place=Place("uf", "R1"), direction="destino")
    return qs.measure_query(t.cube(spark, sf), qs.with_changes(first, place=Place("uf", "R4")))


@query("k20_busiest_route", "SELECT icao_origem, icao_destino, CAST(sum(voos) AS BIGINT) AS voos FROM cubo GROUP BY 1, 2 ORDER BY voos DESC, 1, 2 LIMIT 1")
def k20(spark, sf):
    return qs.busiest_route(t.cube(spark, sf))


@query("k20_busiest_pair", """
SELECT least(icao_origem, icao_destino) AS ponta_a, greatest(icao_origem, icao_destino) AS ponta_b, CAST(sum(voos) AS BIGINT) AS voos
FROM cubo GROUP BY 1, 2 ORDER BY voos DESC, 1, 2 LIMIT 1""")
def k20_pair(spark, sf):
    return qs.busiest_route(t.cube(spark, sf), directed=False)


@query("k21_worst_delay_airport", f"""
SELECT icao_origem, {ATRASO} AS atraso FROM cubo GROUP BY 1 HAVING sum(realizados) >= 100 ORDER BY atraso DESC, icao_origem LIMIT 1""")
def k21(spark, sf):
    return qs.worst_delay_airport(_origin(spark, sf))


@query("k21_worst_delay_high_floor", f"""
SELECT icao_origem, {ATRASO} AS atraso FROM cubo GROUP BY 1 HAVING sum(realizados) >= 2500 ORDER BY atraso DESC, icao_origem LIMIT 1""")
def k21_floor(spark, sf):
    return qs.worst_delay_airport(_origin(spark, sf), 2500)


@query("k22_mean_distance", """
SELECT sum(distancia_km * voos) / sum(voos) AS km FROM (SELECT CAST(distancia_km AS DECIMAL(12,1)) AS distancia_km, voos FROM rota
  WHERE distancia_km IS NOT NULL AND NOT origem_igual_destino)""")
def k22(spark, sf):
    return _exact_mean(qs.mean_distance(_tenths(t.cube(spark, sf))))


@query("k22_mean_distance_with_circular", """
SELECT sum(distancia_km * voos) / sum(voos) AS km FROM (SELECT CAST(distancia_km AS DECIMAL(12,1)) AS distancia_km, voos FROM rota WHERE distancia_km IS NOT NULL)""")
def k22_all(spark, sf):
    return _exact_mean(qs.mean_distance(_tenths(t.cube(spark, sf)), with_circular=True))


def _tenths(cube: Cube) -> Cube:
    """Distances as whole tenths of a kilometre, so that the sum has no rounding order."""
    return cube.with_parts(rota=cube.rota.withColumn("distancia_km", F.round(F.col("distancia_km") * 10).cast("long")))


def _exact_mean(df):
    return df.select((F.col("km") / 10).alias("km"))


@query("k23_top_foreign_company", """
SELECT f.icao_empresa, CAST(sum(f.voos) AS BIGINT) AS voos FROM cubo f JOIN empresa e ON f.icao_empresa = e.icao_empresa
WHERE NOT e.nacional GROUP BY 1 ORDER BY voos DESC, 1 LIMIT 1""")
def k23(spark, sf):
    return qs.top_foreign_company(_no_ends(spark, sf))


@query("k24_cancellations_by_period", f"SELECT periodo_partida AS periodo, {CANC} AS cancelados, {TAXA} AS taxa FROM cubo f WHERE periodo_partida IS NOT NULL GROUP BY 1")
def k24(spark, sf):
    return qs.cancellations_by_period(_no_ends(spark, sf))


@query("k25_weekend_otp", f"""
SELECT max(otp) FILTER (WHERE fim_de_semana) AS fds, max(otp) FILTER (WHERE NOT fim_de_semana) AS util FROM (
  SELECT fim_de_semana, {OTP} AS otp FROM cubo WHERE fim_de_semana IS NOT NULL GROUP BY 1)""")
def k25(spark, sf):
    return qs.weekend_otp(_no_ends(spark, sf))


@query("k1_ranking_from_stored_cube", f"""
SELECT e.nome AS empresa, {TAXA} AS taxa, {VOOS} AS programados FROM {EMP} GROUP BY e.nome HAVING sum(f.voos) >= 500
ORDER BY taxa DESC, empresa LIMIT 15""")
def k1_cube(spark, sf):
    return qs.cancellation_ranking(t.stored_cube(spark, sf))


@query("k4_airports_from_stored_cube", f"""
SELECT a.icao, a.rotulo AS local, a.latitude, a.longitude, {VOOS} AS voos, {OTP} AS otp FROM {ORI} WHERE a.latitude IS NOT NULL
GROUP BY a.icao, a.rotulo, a.latitude, a.longitude HAVING sum(f.voos) >= 900 ORDER BY voos DESC, a.icao LIMIT 80""")
def k4_cube(spark, sf):
    return qs.busiest_airports(t.stored_cube(spark, sf))


@query("k18_state_from_stored_cube", _direction_sql("SELECT icao FROM aerodromo WHERE uf = 'R1'", False, 300, "abs(chegando - saindo)"))
def k18_cube(spark, sf):
    return qs.direction_compare(t.stored_cube(spark, sf), Place("uf", "R1"), min_flights=300)


@query("t4_row_cap", "SELECT icao_origem, icao_destino, CAST(sum(voos) AS BIGINT) AS voos FROM cubo GROUP BY 1, 2 ORDER BY voos DESC, 1, 2 LIMIT 500")
def t4(spark, sf):
    pairs = qs.sums_by(t.cube(spark, sf).fato, "icao_origem", "icao_destino").select("icao_origem", "icao_destino", "voos")
    return qs.row_cap(pairs, 500, [F.desc("voos"), F.asc("icao_origem"), F.asc("icao_destino")])


@query("a18_share_by_period", """
SELECT periodo_partida, CAST(sum(voos) AS BIGINT) AS voos, 100.0 * CAST(sum(voos) AS DOUBLE) / (SELECT sum(voos) FROM cubo) AS pct FROM cubo GROUP BY 1""")
def a18(spark, sf):
    return qs.share_by(_no_ends(spark, sf), "periodo_partida")
