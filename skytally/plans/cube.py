"""The additive cube, its export dimensions and the fixed result cubes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions.calendar import month_label, month_order
from ..functions.metrics import CUBE_KEYS, measure_sums, row_measures
from ..functions.text import repair_mojibake
from ..functions.typing import filled, label_of, percent, ratio, route_key
from ..operators.aggregates import count_if, mean_where, missing_code_counts
from ..operators.joins import enrich, lookup, members_of


def measure_rows(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Flights as cube rows of weight one. Any cube question runs on these or on the stored cube."""
    return rows.select(*CUBE_KEYS, *extra, *[c.alias(n) for n, c in row_measures().items()])


def additive_cube(rows: DataFrame, keys: list[str] = CUBE_KEYS) -> DataFrame:
    """Eight keys by fifteen sums and counts; rows with NULL keys keep their own groups."""
    return measure_rows(rows).groupBy(*keys).agg(*measure_sums())


# --- Export dimensions ------------------------------------------------------------------------

def export_companies(obt: DataFrame, brands: Mapping[str, str] = lx.BRANDS) -> DataFrame:
    base = obt.filter(F.col("icao_empresa").isNotNull()).groupBy("icao_empresa").agg(
        *[F.max(f"empresa_{c}").alias(n) for c, n in (
            ("nome", "nome"), ("iata", "iata"), ("servico", "servico"), ("origem", "origem_cadastro"), ("situacao", "situacao"))],
        F.count(F.lit(1)).alias("voos_no_periodo"),
    )
    base = base.withColumns({
        "nome": repair_mojibake("nome"),
        "nacional": F.coalesce(F.lower("origem_cadastro").contains("nacion"), F.lit(False)),
    })
    return enrich(base, brands, "icao_empresa", "marca")


def export_airports(obt: DataFrame, states: Mapping[str, str] = lx.STATE_CODES, min_volume: int = 100) -> DataFrame:
    """Airports seen as origin or destination with enough movement; one scan for both roles."""
    attrs = ["nome", "municipio", "uf", "latitude", "longitude"]
    ends = obt.select(F.explode(F.array(*[
        F.struct(
            F.col(f"icao_{role}").alias("icao"), *[F.col(f"{role}_{a}").alias(a) for a in attrs],
            F.lit(int(role == "origem")).alias("dep"))
        for role in ("origem", "destino")
    ])).alias("p")).select("p.*").filter("icao IS NOT NULL")
    out = ends.groupBy("icao").agg(
        F.max("nome").alias("nome"), F.max("municipio").alias("municipio"), F.max("uf").alias("estado"),
        F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"),
        F.sum("dep").alias("partidas"), F.sum(1 - F.col("dep")).alias("chegadas"),
    ).filter(F.col("partidas") + F.col("chegadas") >= min_volume)
    out = enrich(out, states, "estado", "uf")
    return out.select("icao", "nome", "municipio", "uf", "estado", "latitude", "longitude", "partidas", "chegadas")


def export_routes(obt: DataFrame) -> DataFrame:
    return obt.filter("icao_origem IS NOT NULL AND icao_destino IS NOT NULL").groupBy("icao_origem", "icao_destino").agg(
        F.max("rota_distancia_km").alias("distancia_km"), F.max("rota_faixa_distancia").alias("faixa_distancia"),
        F.count(F.lit(1)).alias("voos"),
    ).select("icao_origem", "icao_destino", "distancia_km", "faixa_distancia",
             (F.col("icao_origem") == F.col("icao_destino")).alias("origem_igual_destino"), "voos")


def export_months(rows: DataFrame, date: str = "data_partida_prevista") -> DataFrame:
    """One row per month with its active days; flights without a date form their own row, ordered last."""
    days = rows.groupBy("ano_mes", date).agg(
        F.max("ano").alias("ano"), F.max("mes").alias("mes"), F.max("trimestre").alias("trimestre"),
        F.max("estacao").alias("estacao"), F.count(F.lit(1)).alias("voos"))
    months = days.groupBy("ano_mes").agg(
        F.max("ano").cast("int").alias("ano"), F.max("mes").cast("int").alias("mes"),
        F.max("trimestre").cast("int").alias("trimestre"), F.max("estacao").alias("estacao"),
        F.min(date).alias("primeiro_dia"), F.max(date).alias("ultimo_dia"),
        F.count(date).alias("dias_com_voo"), F.sum("voos").alias("voos"))
    return months.select("ano_mes", "ano", "mes", month_label("mes", "ano").alias("nome_mes"), "trimestre", "estacao",
                         "primeiro_dia", "ultimo_dia", "dias_com_voo", "voos", month_order("ano", "mes").alias("ordem"))


def complete_periods(months: DataFrame, min_days: int = 28) -> DataFrame:
    """Dated months with enough active days to be compared."""
    return months.filter(F.col("ano_mes").isNotNull() & (F.col("dias_com_voo") >= min_days))


def partial_periods(months: DataFrame, min_days: int = 28) -> DataFrame:
    return months.filter(F.col("ano_mes").isNotNull() & (F.col("dias_com_voo") < min_days))


def with_label(airports: DataFrame) -> DataFrame:
    """City, else name, else code."""
    return airports.withColumn("rotulo", label_of("municipio", "nome", "icao"))


# --- Result cubes -----------------------------------------------------------------------------

def _otp(flag: str = "partida_pontual") -> Column:
    return percent(count_if(flag), count_if("flag_realizado"))


def _volumes() -> list[Column]:
    return [F.count(F.lit(1)).alias("voos"), count_if("flag_realizado").alias("realizados"),
            count_if("flag_cancelado").alias("cancelados")]


def _cancelled_rate() -> Column:
    return percent(count_if("flag_cancelado"), F.count(F.lit(1))).alias("pct_cancelado")


def _delay(column: str, name: str) -> Column:
    return mean_where(column, "flag_realizado").alias(name)


def kpis(rows: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """One row of sixteen measures; ``exact_distinct=False`` trades exact distinct counts for a sketch."""
    distinct = F.count_distinct if exact_distinct else F.approx_count_distinct
    return rows.agg(
        F.count(F.lit(1)).alias("total_voos"), *_volumes()[1:], _cancelled_rate(),
        _otp().alias("otp_partida"), _otp("chegada_pontual").alias("otp_chegada"),
        count_if("partida_atraso_severo").alias("atraso_severo"),
        _delay("atraso_partida_min", "atraso_medio_partida"), _delay("atraso_chegada_min", "atraso_medio_chegada"),
        F.avg("minutos_recuperados").alias("minutos_recuperados_medio"), F.avg("duracao_voo_min").alias("duracao_media_min"),
        distinct(F.col("icao_empresa")).alias("empresas"), distinct(F.col("icao_origem")).alias("aerodromos_origem"),
        distinct(route_key("icao_origem", "icao_destino")).alias("rotas"),
        F.min("data_partida_prevista").alias("periodo_inicio"), F.max("data_partida_prevista").alias("periodo_fim"),
    )


def company_cube(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """Per company; the registry is looked up after the sums. ``companies`` has icao, nome, iata, ..."""
    sums = rows.groupBy("icao_empresa").agg(
        *_volumes(), _cancelled_rate(), _otp().alias("otp_partida"), _otp("chegada_pontual").alias("otp_chegada"),
        _delay("atraso_partida_min", "atraso_medio_partida"), _delay("atraso_chegada_min", "atraso_medio_chegada"),
        F.avg("minutos_recuperados").alias("minutos_recuperados_medio"),
        count_if("partida_atraso_severo").alias("atraso_severo"),
        F.count_distinct(route_key("icao_origem", "icao_destino")).alias("rotas"),
    )
    attrs = [c for c in ("nome", "iata", "origem_cadastro", "servico", "ativa") if c in companies.columns]
    out = lookup(sums, companies, {"icao_empresa": "icao"}, {c: c for c in attrs})
    return out.withColumn("nome", filled("nome", "(sem cadastro)")).withColumnRenamed("icao_empresa", "icao")


def month_cube(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ano_mes").agg(
        F.min("nome_mes").alias("nome_mes"), F.min("ano").alias("ano"), *_volumes(), _cancelled_rate(),
        _otp().alias("otp_partida"), _delay("atraso_partida_min", "atraso_medio_partida"))


def company_month_cube(rows: DataFrame, min_flights: int = 500) -> DataFrame:
    """Company by month for large companies: one scan, the floor is checked on the monthly sums."""
    sums = rows.groupBy("icao_empresa", "ano_mes").agg(
        F.count(F.lit(1)).alias("voos"), count_if("flag_cancelado").alias("cancelados"),
        _otp().alias("otp_partida"), _delay("atraso_partida_min", "atraso_medio_partida"))
    large = sums.groupBy(F.col("icao_empresa").alias("icao")).agg(F.sum("voos").alias("_v")).filter(F.col("_v") >= min_flights)
    return members_of(sums, "icao_empresa", large, "icao").withColumnRenamed("icao_empresa", "icao")


def route_cube(rows: DataFrame, airports: DataFrame, routes: DataFrame) -> DataFrame:
    """Per route; city and state of both ends and the distance are looked up on the sums."""
    sums = rows.groupBy("icao_origem", "icao_destino").agg(
        F.count(F.lit(1)).alias("voos"), count_if("flag_cancelado").alias("cancelados"), _otp().alias("otp_partida"),
        F.avg("duracao_voo_min").alias("duracao_media_min"))
    for role in ("origem", "destino"):
        sums = lookup(sums, airports, {f"icao_{role}": "icao"}, {"municipio": f"{role}_municipio", "estado": f"{role}_uf"})
    return lookup(sums, routes, {"icao_origem": "icao_origem", "icao_destino": "icao_destino"},
                  {"distancia_km": "distancia_km", "faixa_distancia": "faixa"})


def origin_cube(rows: DataFrame, airports: DataFrame) -> DataFrame:
    """Per origin airport that has coordinates."""
    sums = rows.groupBy("icao_origem").agg(
        F.count(F.lit(1)).alias("voos"), count_if("flag_cancelado").alias("cancelados"), _otp().alias("otp_partida"))
    named = airports.filter("latitude IS NOT NULL").select("icao", "nome", "municipio", F.col("estado").alias("uf"), "latitude", "longitude")
    return sums.join(named, sums["icao_origem"] == named["icao"]).drop("icao_origem")


def cut_measures() -> dict[str, Column]:
    """Row-level numbers the categorical cuts add up."""
    flag = lambda c: F.when(F.col(c), 1).otherwise(0).cast("long")
    done_delay = F.when(F.col("flag_realizado"), F.col("atraso_partida_min"))
    return {
        "voos": F.lit(1).cast("long"), "cancelados": flag("flag_cancelado"), "_pontuais": flag("partida_pontual"),
        "_realizados": flag("flag_realizado"), "_soma": done_delay, "_com": done_delay.isNotNull().cast("long"),
    }


def finish_cuts(cuts: DataFrame) -> DataFrame:
    return cuts.select(
        "dimensao", "categoria", "voos", "cancelados", percent("_pontuais", "_realizados").alias("otp_partida"),
        ratio("_soma", "_com").alias("atraso_medio_partida"))


def cancellation_reasons(rows: DataFrame) -> DataFrame:
    return missing_code_counts(rows.filter("flag_cancelado"), "codigo_justificativa", "codigo", "cancelados")
