"""Export quality row and the facts derived from the exported cube."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions.metrics import METRICS, metric
from ..functions.typing import PLAUSIBLE_MINUTES, implausible, percent
from ..operators.aggregates import arg_best, count_if, distinct_where, label_collisions
from ..operators.joins import members_of, not_members_of
from .cube import complete_periods, partial_periods
from .questions import Cube, sums_by


def export_quality(rows: DataFrame, bounds: tuple[int, int] = PLAUSIBLE_MINUTES) -> DataFrame:
    dated = F.col("ano_mes").isNotNull()
    return rows.agg(
        F.count(F.lit(1)).alias("total_voos"),
        count_if(~dated).alias("sem_data_prevista"),
        count_if("flag_cancelado").alias("cancelados"),
        distinct_where("codigo_justificativa", "flag_cancelado").alias("justificativas_distintas"),
        F.count_distinct("icao_empresa").alias("empresas"),
        F.count_distinct("icao_origem").alias("origens"),
        percent(count_if("partida_pontual"), count_if("flag_realizado")).alias("otp_global"),
        percent(count_if(F.col("partida_pontual") & dated), count_if(F.col("flag_realizado") & dated)).alias("otp_com_data"),
        count_if(implausible("atraso_partida_min", bounds)).alias("atrasos_implausiveis"),
    )


def period_fact(months: DataFrame, min_days: int = 28) -> DataFrame:
    """First month, last complete month and how many are complete."""
    full = F.col("dias_com_voo") >= min_days
    return months.filter("ano_mes IS NOT NULL").agg(
        F.min("ano_mes").alias("inicio"), F.max(F.when(full, F.col("ano_mes"))).alias("fim"),
        count_if(full).alias("meses_completos"), count_if(~full).alias("meses_parciais"))


def otp_extremes(cube: Cube, min_days: int = 28) -> DataFrame:
    """Worst and best complete month with their rates."""
    months = complete_periods(cube.tempo, min_days).select(F.col("ano_mes").alias("_m"), "nome_mes")
    rows = sums_by(cube.fato, "ano_mes").join(months, F.col("ano_mes") == F.col("_m"))
    m = METRICS["otp"]
    rows = rows.select("nome_mes", "ano_mes", (F.lit(m.scale) * F.col(m.num) / F.nullif(F.col(m.den), F.lit(0)).cast("double")).alias("otp"))
    low = F.min_by(F.struct("nome_mes", "otp"), F.struct("otp", "ano_mes"))
    high = F.min_by(F.struct("nome_mes", "otp"), F.struct(-F.col("otp"), F.col("ano_mes")))
    return rows.filter("otp IS NOT NULL").agg(low.alias("_l"), high.alias("_h")).select(
        F.col("_l.nome_mes").alias("mes_min"), F.col("_l.otp").alias("min"),
        F.col("_h.nome_mes").alias("mes_max"), F.col("_h.otp").alias("max"))


def uncovered_airports(cube: Cube, domestic_pattern: str = lx.DOMESTIC_CODE_PATTERN) -> DataFrame:
    """Airports without registry (no state): domestic and foreign, and their share of departures."""
    departures = sums_by(cube.fato, "icao_origem").select("icao_origem", "voos")
    a = cube.aerodromo.select("icao", "uf")
    rows = a.join(departures, a["icao"] == departures["icao_origem"], "left")
    missing = F.col("uf").isNull()
    domestic = F.col("icao").cast("string").rlike(domestic_pattern)
    return rows.agg(
        count_if(missing).alias("total"), count_if(missing & ~domestic).alias("estrangeiros"),
        count_if(missing & domestic).alias("brasileiros"),
        percent(F.sum(F.when(missing, F.col("voos"))), F.sum("voos")).alias("pct_partidas"))


def outside_dimension(cube: Cube) -> DataFrame:
    """Origins that the airport dimension lacks, and their flights."""
    rows = sums_by(cube.fato.filter("icao_origem IS NOT NULL"), "icao_origem").select("icao_origem", "voos")
    return not_members_of(rows, "icao_origem", cube.aerodromo, "icao").agg(
        F.count(F.lit(1)).alias("origens"), F.coalesce(F.sum("voos"), F.lit(0)).alias("voos"))


def inside_outside(cube: Cube) -> DataFrame:
    """Flights whose origin is inside and outside the airport dimension."""
    rows = sums_by(cube.fato, "icao_origem").select("icao_origem", "voos")
    inside = members_of(rows, "icao_origem", cube.aerodromo, "icao").agg(F.lit("dentro").alias("lado"), F.count(F.lit(1)).alias("origens"), F.sum("voos").alias("voos"))
    outside = not_members_of(rows, "icao_origem", cube.aerodromo, "icao").agg(F.lit("fora").alias("lado"), F.count(F.lit(1)).alias("origens"), F.sum("voos").alias("voos"))
    return inside.unionByName(outside)


def otp_by_nationality(cube: Cube) -> DataFrame:
    e = cube.empresa.select(F.col("icao_empresa").alias("_e"), "nacional")
    rows = sums_by(cube.fato, "icao_empresa").join(e, F.col("icao_empresa") == F.col("_e"))
    return rows.agg(metric("otp", F.col("nacional"), "nacionais"), metric("otp", ~F.col("nacional"), "estrangeiras"))


def routes_without_distance(routes: DataFrame) -> DataFrame:
    missing = F.col("distancia_km").isNull()
    return routes.agg(
        count_if(missing).alias("rotas"), F.sum(F.when(missing, F.col("voos"))).alias("voos"),
        percent(F.sum(F.when(missing, F.col("voos"))), F.sum("voos")).alias("pct_voos"))


def cities_with_several_airports(airports: DataFrame) -> DataFrame:
    return label_collisions(airports, "municipio", "icao")


def derived_facts(cube: Cube, min_days: int = 28) -> dict[str, DataFrame]:
    """Every fact as its own small frame, by name."""
    return {
        "periodo": period_fact(cube.tempo, min_days),
        "parciais": partial_periods(cube.tempo, min_days).select("ano_mes", "nome_mes", "dias_com_voo", "voos"),
        "otp_mensal": otp_extremes(cube, min_days),
        "aerodromos_sem_cadastro": uncovered_airports(cube),
        "fora_da_dim_aerodromo": outside_dimension(cube),
        "otp_empresas": otp_by_nationality(cube),
        "rotas_sem_distancia": routes_without_distance(cube.rota),
        "municipios_com_varios_aerodromos": cities_with_several_airports(cube.aerodromo),
    }


def busiest_label(cube: Cube, key: str) -> DataFrame:
    return arg_best(sums_by(cube.fato, key).filter(F.col(key).isNotNull()), [], key, "voos")
