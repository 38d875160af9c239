"""Star schema: calendar, dimensions, fact, on-time view and the wide table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import typing as ty
from ..functions.calendar import calendar_attributes, day_period
from ..functions.geo import distance_band, haversine_km
from ..functions.typing import percent
from ..operators.aggregates import count_if, mean_where
from ..operators.joins import lookup, lookup_keys, prefix_dim, unique
from ..operators.windows import dedupe_best, latest_first, present_first, surrogate_key
from ..session import stored
from .silver import drop_header_rows

Numbering = Callable[[DataFrame, str, Sequence[str]], DataFrame]


def build_dim_tempo(flights: DataFrame, date: str = "partida_prevista_data") -> DataFrame:
    """One row per day between the first and last scheduled day."""
    bounds = flights.agg(F.min(date).cast("date").alias("_a"), F.max(date).cast("date").alias("_b"))
    days = bounds.filter("_a IS NOT NULL").select(F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 DAY"))).alias("data"))
    attrs = calendar_attributes("data")
    return days.select(attrs.pop("sk_tempo").alias("sk_tempo"), "data", *[c.alias(n) for n, c in attrs.items()])


def fixed_calendar(flights: DataFrame) -> DataFrame:
    """The calendar computed once for all its roles; its size on disk decides how it is joined."""
    return stored(build_dim_tempo(flights), "calendario")


def best_companies(companies: DataFrame) -> DataFrame:
    """One row per code: filled name first, filled status next, most recent load last."""
    rows = drop_header_rows(companies, "icao", ["icao", "ICAO"])
    return dedupe_best(rows, ["icao"], [present_first("razao_social"), present_first("situacao"), latest_first("transformado_em")])


def build_dim_empresa(companies: DataFrame, number: Numbering = surrogate_key, keyword_mode: str = "word") -> DataFrame:
    kept = best_companies(companies).select(
        "icao", "iata", "razao_social", "cnpj", "servico", "cidade", "uf", "situacao", "decisao_operacional",
        "validade_operacional", "origem_cadastro", ty.has_keyword("situacao", "ATIVA", keyword_mode).alias("flag_ativa"),
    )
    return number(kept, "sk_empresa", ["icao"])


def build_dim_aerodromo(airports: DataFrame, number: Numbering = surrogate_key, keyword_mode: str = "word") -> DataFrame:
    rows = airports.filter(F.col("icao").isNotNull() & (F.col("icao") != ""))
    kept = rows.select(
        "icao", "ciad", "nome", "municipio", "uf_nome", "municipio_servido", "uf_servido_nome", "altitude_m",
        ty.tolerant_double("latgeopoint").alias("latitude"), ty.tolerant_double("longeopoint").alias("longitude"),
        "situacao", "operacao_diurna", "operacao_noturna",
        ty.keyword_status("situacao", lx.AIRPORT_STATUS, "outro", keyword_mode).alias("status_operacional"),
        ty.all_present("latgeopoint", "longeopoint").alias("tem_coordenadas"),
    )
    return unique(number(kept, "sk_aerodromo", ["icao"]), ["icao"])


def flight_codes(flights: DataFrame) -> DataFrame:
    """Code combinations in use with their first and last day, fixed once: the line, status and route dimensions and the calendar come from it."""
    day = F.col("partida_prevista_data")
    sums = flights.groupBy("codigo_tipo_linha", "situacao_voo", "icao_origem", "icao_destino").agg(F.min(day).alias("primeiro_dia"), F.max(day).alias("ultimo_dia"))
    return stored(sums, "codigos")


def days_of_codes(codes: DataFrame, date: str = "partida_prevista_data") -> DataFrame:
    """First and last days of ``flight_codes``: for the calendar they stand for all flights."""
    return codes.select(F.explode(F.array("primeiro_dia", "ultimo_dia")).alias(date))


def _codes(flights: DataFrame, column: str) -> DataFrame:
    return flights.select(F.col(column).alias("codigo")).filter("codigo IS NOT NULL").distinct()


def build_dim_tipo_linha(flights: DataFrame, number: Numbering = surrogate_key) -> DataFrame:
    codes = _codes(flights, "codigo_tipo_linha").withColumn("descricao", ty.describe_code("codigo", lx.LINE_TYPES, "Outro"))
    return number(codes, "sk_tipo_linha", ["codigo"])


def build_dim_situacao(flights: DataFrame, number: Numbering = surrogate_key) -> DataFrame:
    codes = _codes(flights, "situacao_voo").withColumns({
        "descricao": ty.describe_code("codigo", lx.STATUS_LABELS, "Outro"),
        "flag_realizado": ty.is_code("codigo", "REALIZADO"),
        "flag_cancelado": ty.is_code("codigo", "CANCELADO"),
    })
    return number(codes, "sk_situacao", ["codigo"])


def route_distances(flights: DataFrame, airports: DataFrame, latitude: str = "latgeopoint", longitude: str = "longeopoint") -> DataFrame:
    """Distinct routes with the coordinates of both ends and their distance."""
    routes = flights.select("icao_origem", "icao_destino").filter(
        "icao_origem IS NOT NULL AND icao_destino IS NOT NULL").distinct()
    coords = airports.select("icao", ty.tolerant_double(latitude).alias("lat"), ty.tolerant_double(longitude).alias("lon"))
    for role in ("origem", "destino"):
        routes = lookup(routes, coords, {f"icao_{role}": "icao"}, {"lat": f"lat_{role}", "lon": f"lon_{role}"})
    return routes.withColumns({
        "distancia_km": haversine_km("lat_origem", "lon_origem", "lat_destino", "lon_destino"),
        "status_distancia": ty.presence_label(["lat_origem", "lat_destino"], "com_coordenadas", "sem_coordenadas"),
    })


def build_dim_rota(flights: DataFrame, airports: DataFrame, number: Numbering = surrogate_key) -> DataFrame:
    return number(route_distances(flights, airports), "sk_rota", ["icao_origem", "icao_destino"])


def fact_flags() -> dict[str, Column]:
    """Status, punctuality, duration and part of day of a flight."""
    return {
        "flag_realizado": ty.is_code("situacao_voo", "REALIZADO"),
        "flag_cancelado": ty.is_code("situacao_voo", "CANCELADO"),
        "partida_pontual": ty.on_time("atraso_partida_min"),
        "chegada_pontual": ty.on_time("atraso_chegada_min"),
        "partida_atrasada": ty.late("atraso_partida_min"),
        "partida_atraso_severo": ty.late("atraso_partida_min", ty.SEVERE_MINUTES),
        "duracao_voo_min": ty.minutes_between("partida_real_hora", "chegada_real_hora"),
        "periodo_partida": day_period("partida_prevista_hora"),
    }


FACT_KEYS = ["sk_empresa", "sk_aerodromo_origem", "sk_aerodromo_destino", "sk_tempo_partida_prevista",
             "sk_tempo_partida_real", "sk_tipo_linha", "sk_situacao", "sk_rota"]
_RAW_COLUMNS = ["icao_empresa", "numero_voo", "codigo_di", "icao_origem", "icao_destino", "partida_prevista_hora", "partida_real_hora",
                "chegada_prevista_hora", "chegada_real_hora", "atraso_partida_min", "atraso_chegada_min", "minutos_recuperados", "situacao_voo",
                "codigo_justificativa", "codigo_tipo_linha"]
FACT_COLUMNS = ["icao_empresa", "numero_voo", "codigo_di", "icao_origem", "icao_destino", "partida_prevista_hora",
                "partida_real_hora", "chegada_prevista_hora", "chegada_real_hora", "atraso_partida_min",
                "atraso_chegada_min", "minutos_recuperados", "flag_realizado", "flag_cancelado", "partida_pontual",
                "chegada_pontual", "partida_atrasada", "partida_atraso_severo", "duracao_voo_min", "periodo_partida",
                "situacao_voo", "codigo_justificativa", "origem_arquivo", "transformado_em"]


def build_fact(flights: DataFrame, dims: dict[str, DataFrame], numbered: bool = True,
               tie_break: Sequence[str] = (), extra: Sequence[str] = ()) -> DataFrame:
    """Fact with eight surrogate keys, flags and (optionally) the dense flight number.

    Flights are numbered while they are narrow: flags and keys come after. Dimensions have one row per code.
    """
    rows = flights.filter(F.col("icao_empresa").isNotNull())
    if numbered:
        narrow = rows.select(*_RAW_COLUMNS, "origem_arquivo", "transformado_em", "partida_prevista_data", "partida_real_data", *extra)
        rows = surrogate_key(narrow, "id_voo", ["partida_prevista_data", "icao_empresa", "numero_voo", *tie_break])
    rows = rows.withColumns(fact_flags())
    rows = lookup_keys(rows, [
        (dims["empresa"], {"icao_empresa": "icao"}, "sk_empresa", "sk_empresa"),
        (dims["aerodromo"], {"icao_origem": "icao"}, "sk_aerodromo", "sk_aerodromo_origem"),
        (dims["aerodromo"], {"icao_destino": "icao"}, "sk_aerodromo", "sk_aerodromo_destino"),
        (dims["tempo"], {"partida_prevista_data": "data"}, "sk_tempo", "sk_tempo_partida_prevista"),
        (dims["tempo"], {"partida_real_data": "data"}, "sk_tempo", "sk_tempo_partida_real"),
        (dims["tipo_linha"], {"codigo_tipo_linha": "codigo"}, "sk_tipo_linha", "sk_tipo_linha"),
        (dims["situacao"], {"situacao_voo": "codigo"}, "sk_situacao", "sk_situacao"),
        (dims["rota"], {"icao_origem": "icao_origem", "icao_destino": "icao_destino"}, "sk_rota", "sk_rota"),
    ])
    return rows.select(*(["id_voo"] if numbered else []), *FACT_KEYS, *FACT_COLUMNS, F.col("partida_prevista_data").alias("data_partida_prevista"), *extra)


def otp_by_company_month(rows: DataFrame, companies: DataFrame, code: str = "icao", name: str = "razao_social") -> DataFrame:
    """On-time performance per company and month over dated flights of registered companies.

    Flights are summed per company code before the registry is joined.
    """
    dated = rows.filter(F.col("partida_prevista_data").isNotNull())
    done = F.col("flag_realizado")
    when_done = lambda c: F.when(done, F.col(c))
    sums = dated.groupBy("icao_empresa", F.trunc("partida_prevista_data", "month").alias("_m")).agg(
        F.count(F.lit(1)).alias("total_voos"), count_if("flag_realizado").alias("voos_realizados"),
        count_if("flag_cancelado").alias("voos_cancelados"), count_if("partida_pontual").alias("_pp"),
        count_if("chegada_pontual").alias("_cp"),
        F.sum(when_done("atraso_partida_min")).alias("_sp"), F.count(when_done("atraso_partida_min")).alias("_np"),
        F.sum(when_done("atraso_chegada_min")).alias("_sc"), F.count(when_done("atraso_chegada_min")).alias("_nc"),
    )
    reg = companies.select(F.col(code).alias("icao"), F.col(name).alias("razao_social"))
    return sums.join(reg, sums["icao_empresa"] == reg["icao"]).select(
        "razao_social", "icao", F.year("_m").alias("ano"), F.month("_m").alias("mes"),
        F.date_format("_m", "MMMM").alias("nome_mes"), "total_voos", "voos_realizados", "voos_cancelados",
        percent("_pp", "voos_realizados").alias("pct_partida_pontual"),
        percent("_cp", "voos_realizados").alias("pct_chegada_pontual"),
        ty.ratio("_sp", "_np").alias("atraso_medio_partida_min"),
        ty.ratio("_sc", "_nc").alias("atraso_medio_chegada_min"),
    )


def build_obt(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One wide row per flight with the descriptions of every dimension; unknown members are NULL."""
    emp = dims["empresa"].select(
        "sk_empresa", F.col("razao_social").alias("empresa_nome"), F.col("iata").alias("empresa_iata"),
        F.col("servico").alias("empresa_servico"), F.col("origem_cadastro").alias("empresa_origem"),
        F.col("situacao").alias("empresa_situacao"), F.col("flag_ativa").alias("empresa_ativa"))
    aero = dims["aerodromo"].select("sk_aerodromo", "nome", "municipio", F.col("uf_nome").alias("uf"), "latitude",
                                    "longitude", F.col("status_operacional").alias("status"))
    tempo = dims["tempo"].drop("data", "dia_semana_num")
    tipo = dims["tipo_linha"].select("sk_tipo_linha", F.col("codigo").alias("codigo_tipo_linha"), F.col("descricao").alias("tipo_linha"))
    sit = dims["situacao"].select("sk_situacao", F.col("codigo").alias("codigo_situacao"), F.col("descricao").alias("situacao_descricao"))
    rota = dims["rota"].select("sk_rota", F.col("distancia_km").alias("rota_distancia_km"))

    wide = fact
    for dim, fact_key, key in [
        (emp, "sk_empresa", "sk_empresa"),
        (prefix_dim(aero, "origem"), "sk_aerodromo_origem", "origem_sk_aerodromo"),
        (prefix_dim(aero, "destino"), "sk_aerodromo_destino", "destino_sk_aerodromo"),
        (tempo, "sk_tempo_partida_prevista", "sk_tempo"),
        (tipo, "sk_tipo_linha", "sk_tipo_linha"),
        (sit, "sk_situacao", "sk_situacao"),
        (rota, "sk_rota", "sk_rota"),
    ]:
        wide = lookup(wide, dim, {fact_key: key}, {c: c for c in dim.columns if c != key})
    wide = wide.withColumn("rota_faixa_distancia", distance_band("rota_distancia_km"))
    return wide.select(*[c for c in OBT_COLUMNS if c in wide.columns])


def unnumbered(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """In place of a numbering, for a dimension that is looked up by its code; written once, so that its size is known."""
    return stored(df, "dimensao")


def obt_of_flights(flights: DataFrame, companies: DataFrame, airports: DataFrame, numbered: bool = True,
                   tie_break: Sequence[str] = (), extra: Sequence[str] = ()) -> DataFrame:
    """The wide table straight from the flights: what ``build_obt`` of ``build_fact`` gives, without the keys in between.

    Descriptions are looked up by code, once; ``companies`` and ``airports`` are their dimensions, numbered or not. The calendar, the
    descriptions of line types and outcomes, and distances from the coordinates of both ends are computed in the row. Flights are
    numbered while they are narrow. Three joins with small tables remain, and no shuffle but that of the numbering.
    """
    rows = flights.filter(F.col("icao_empresa").isNotNull())
    narrow = rows.select(*_RAW_COLUMNS, F.col("partida_prevista_data").alias("data_partida_prevista"), *extra)
    wide = surrogate_key(narrow, "id_voo", ["data_partida_prevista", "icao_empresa", "numero_voo", *tie_break]) if numbered else narrow
    wide = wide.withColumns(fact_flags())
    emp = {"razao_social": "empresa_nome", "iata": "empresa_iata", "servico": "empresa_servico", "origem_cadastro": "empresa_origem",
           "situacao": "empresa_situacao", "flag_ativa": "empresa_ativa"}
    wide = lookup(wide, companies.select("icao", *emp), {"icao_empresa": "icao"}, emp)
    aero = {"nome": "nome", "municipio": "municipio", "uf_nome": "uf", "latitude": "latitude", "longitude": "longitude", "status_operacional": "status"}
    for role in ("origem", "destino"):
        wide = lookup(wide, airports.select("icao", *aero), {f"icao_{role}": "icao"}, {c: f"{role}_{n}" for c, n in aero.items()})
    calendar = {n: c for n, c in calendar_attributes("data_partida_prevista").items() if n not in ("sk_tempo", "dia_semana_num")}
    described = lambda c, labels: F.when(F.col(c).isNotNull(), ty.describe_code(c, labels, "Outro"))
    wide = wide.withColumns({
        **calendar, "tipo_linha": described("codigo_tipo_linha", lx.LINE_TYPES), "codigo_situacao": F.col("situacao_voo"),
        "situacao_descricao": described("situacao_voo", lx.STATUS_LABELS),
        "rota_distancia_km": haversine_km("origem_latitude", "origem_longitude", "destino_latitude", "destino_longitude"),
    })
    wide = wide.withColumn("rota_faixa_distancia", distance_band("rota_distancia_km"))
    return wide.select(*[c for c in OBT_COLUMNS if c in wide.columns])


OBT_COLUMNS = [
    "id_voo", "icao_empresa", "empresa_nome", "empresa_iata", "empresa_servico", "empresa_origem", "empresa_situacao",
    "empresa_ativa", "icao_origem", "origem_nome", "origem_municipio", "origem_uf", "origem_latitude",
    "origem_longitude", "origem_status", "icao_destino", "destino_nome", "destino_municipio", "destino_uf",
    "destino_latitude", "destino_longitude", "destino_status", "data_partida_prevista", "ano", "mes", "nome_mes", "dia",
    "nome_dia_semana", "trimestre", "ano_mes", "fim_de_semana", "estacao", "codigo_tipo_linha", "tipo_linha",
    "codigo_situacao", "situacao_descricao", "rota_distancia_km", "rota_faixa_distancia", "numero_voo", "codigo_di",
    "partida_prevista_hora", "partida_real_hora", "chegada_prevista_hora", "chegada_real_hora", "atraso_partida_min",
    "atraso_chegada_min", "minutos_recuperados", "duracao_voo_min", "flag_realizado", "flag_cancelado",
    "partida_pontual", "chegada_pontual", "partida_atrasada", "partida_atraso_severo", "periodo_partida",
    "situacao_voo", "codigo_justificativa",
]


def flight_rows(flights: DataFrame) -> DataFrame:
    """Typed flights with flags and calendar columns computed in place: what every metric needs, without joins."""
    attrs = calendar_attributes("partida_prevista_data")
    attrs.pop("sk_tempo")
    return flights.withColumns(fact_flags()).withColumns(
        {**attrs, "data_partida_prevista": F.col("partida_prevista_data")})


def on_time_without_status(rows: DataFrame) -> DataFrame:
    """Rows that count as on time although they were not flown: the numerator's known excess."""
    return rows.agg(
        count_if(F.col("partida_pontual") & ~F.col("flag_realizado")).alias("pontuais_nao_realizados"),
        count_if("partida_pontual").alias("pontuais"),
        mean_where("atraso_partida_min", "flag_realizado").alias("atraso_medio_realizados"),
    )
