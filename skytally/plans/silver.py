"""Typed mirrors of the raw tables: same grain, same rows, no business filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import typing as ty
from ..operators.joins import mark_reference
from ..operators.quality import mark_quality

# Source column names and their clean names.
RAW_FLIGHTS = {
    "ICAO_Empresa_Aérea": "icao_empresa",
    "Número_Voo": "numero_voo",
    "Código_Autorização_DI": "codigo_di",
    "Código_Tipo_Linha": "codigo_tipo_linha",
    "ICAO_Aeródromo_Origem": "icao_origem",
    "ICAO_Aeródromo_Destino": "icao_destino",
    "Partida_Prevista": "partida_prevista",
    "Partida_Real": "partida_real",
    "Chegada_Prevista": "chegada_prevista",
    "Chegada_Real": "chegada_real",
    "Situação_Voo": "situacao_voo",
    "Código_Justificativa": "codigo_justificativa",
}
RAW_AIRPORTS = {
    "Código OACI": "icao", "CIAD": "ciad", "Nome": "nome", "Município": "municipio", "UF": "uf_nome",
    "Município Servido": "municipio_servido", "UF Servido": "uf_servido_nome", "Altitude": "altitude_m",
    "Latitude": "latitude", "Longitude": "longitude", "LATGEOPOINT": "latgeopoint", "LONGEOPOINT": "longeopoint",
    "Operação Diurna": "operacao_diurna", "Operação Noturna": "operacao_noturna", "Situação": "situacao",
    "Validade do Registro": "validade_registro", "Portaria de Registro": "portaria_registro",
    "Link Portaria": "link_portaria",
}
NATIONAL_COMPANIES = {
    "icao": "icao", "iata": "iata", "razao_social": "razao_social", "cnpj": "cnpj", "atividades_aereas": "servico",
    "cidade": "cidade", "uf": "uf", "cep": "cep", "telefone": "telefone", "email": "email", "situacao": "situacao",
    "decisao_operacional": "decisao_operacional", "data_decisao_operacional": "data_decisao_operacional",
    "validade_operacional": "validade_operacional", "id_empresa_aerea": "id_empresa_aerea",
    "endereco_sede": "endereco_sede",
}
FOREIGN_COMPANIES = {
    "ICAO": "icao", "Razao": "razao_social", "Servico": "servico", "Cidade": "cidade", "UF": "uf", "CEP": "cep",
    "Telefone": "telefone", "Email": "email", "Ativa": "situacao", "Instrumento": "decisao_operacional",
    "Data": "data_decisao_operacional", "Endereco": "endereco_sede",
}
AUDIT = {"_source_file": "origem_arquivo", "_ingestion_timestamp": "transformado_em"}
TIMES = ["partida_prevista", "partida_real", "chegada_prevista", "chegada_real"]
KNOWN_STATUS = ["REALIZADO", "CANCELADO"]


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep and rename the listed columns."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def type_timestamps(df: DataFrame, columns: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Each text time becomes ``name_data`` (DATE) and ``name_hora`` (TIMESTAMP)."""
    out = []
    for c in df.columns:
        if c in columns:
            out += [ty.typed_date(c, fmt).alias(f"{c}_data"), ty.typed_timestamp(c, fmt).alias(f"{c}_hora")]
        else:
            out.append(F.col(c))
    return df.select(*out)


def with_delays(df: DataFrame) -> DataFrame:
    """Departure and arrival delay in minutes, and the minutes recovered in between."""
    df = df.withColumns({
        "atraso_partida_min": ty.delay_minutes("partida_prevista_hora", "partida_real_hora"),
        "atraso_chegada_min": ty.delay_minutes("chegada_prevista_hora", "chegada_real_hora"),
    })
    return df.withColumn("minutos_recuperados", ty.minutes_recovered("atraso_partida_min", "atraso_chegada_min"))


def silver_flights(raw: DataFrame, fmt: str | None = None) -> DataFrame:
    typed = with_delays(type_timestamps(rename(raw, {**RAW_FLIGHTS, **AUDIT}), TIMES, fmt))
    tail = list(AUDIT.values())
    return typed.select(*[c for c in typed.columns if c not in tail], *tail)


def unify_registries(registries: Mapping[str, tuple[DataFrame, Mapping[str, str]]], origin: str = "origem_cadastro") -> DataFrame:
    """Stack registries of different shape; absent columns are NULL and the origin is a label."""
    out = None
    for label, (df, names) in registries.items():
        part = rename(df, {**names, **AUDIT}).withColumn(origin, F.lit(label))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def silver_companies(national: DataFrame, foreign: DataFrame) -> DataFrame:
    both = unify_registries({
        "nacional": (national, NATIONAL_COMPANIES), "estrangeira": (foreign, FOREIGN_COMPANIES)})
    return both.select(*NATIONAL_COMPANIES.values(), "origem_cadastro", *AUDIT.values())


def drop_header_rows(df: DataFrame, key: str, headers: Sequence[str], drop_empty: bool = True) -> DataFrame:
    """Remove repeated header lines; with ``drop_empty`` also rows without a key."""
    header = F.coalesce(F.col(key).isin(list(headers)), F.lit(False))
    df = df.filter(~header)
    return df.filter(F.col(key).isNotNull() & (F.col(key) != "")) if drop_empty else df


def silver_airports(raw: DataFrame) -> DataFrame:
    """Typed airports; header lines go, rows with a missing code stay."""
    rows = drop_header_rows(raw, "Código OACI", ["Código OACI"], drop_empty=False)
    df = rename(rows, {**RAW_AIRPORTS, **AUDIT})
    df = df.withColumns({
        "altitude_m": ty.decimal_comma("altitude_m"),
        "status_coordenadas": ty.presence_label(
            ["latitude", "longitude"], "coordenadas_presentes", "coordenadas_ausentes"),
    })
    tail = ["status_coordenadas", *AUDIT.values()]
    return df.select(*[c for c in df.columns if c not in tail], *tail)


# Reasons written to the quarantine, in rule order.
REASONS = {
    "valid_icao_empresa": "ICAO da empresa nao encontrado em silver.empresas",
    "valid_icao_origem": "ICAO do aerodromo de origem nao encontrado em silver.aerodromos",
    "valid_icao_destino": "ICAO do aerodromo de destino nao encontrado em silver.aerodromos",
    "valid_horarios": "Horarios previstos de partida/chegada ausentes",
    "valid_situacao": "Situacao do voo desconhecida",
}


def mark_flights(raw: DataFrame, companies: DataFrame, airports: DataFrame, sentinels: Sequence[str] = ("null",)) -> DataFrame:
    """Raw flights with one flag per rule, ``is_valid`` and the first reason to reject."""
    df = rename(raw, {**RAW_FLIGHTS, "_source_file": "origem_arquivo", "_ingestion_timestamp": "ingestion_timestamp"})
    df = df.withColumns({c: ty.null_if_sentinel(c, sentinels) for c in TIMES})
    df = mark_reference(df, companies, "icao_empresa", "icao", "_emp")
    df = mark_reference(df, airports, "icao_origem", "icao", "_ori")
    df = mark_reference(df, airports, "icao_destino", "icao", "_des")
    conditions = {
        "valid_icao_empresa": F.col("_emp"),
        "valid_icao_origem": F.col("_ori"),
        "valid_icao_destino": F.col("_des"),
        "valid_horarios": ty.all_present("partida_prevista", "chegada_prevista"),
        "valid_situacao": F.col("situacao_voo").isin(KNOWN_STATUS),
    }
    return mark_quality(df, [(flag, cond, REASONS[flag]) for flag, cond in conditions.items()]).drop("_emp", "_ori", "_des")


def audited_expectations() -> dict:
    return {
        "expect_icao_empresa_not_null": F.col("icao_empresa").isNotNull(),
        "expect_icao_empresa_valido": F.col("valid_icao_empresa"),
        "expect_icao_origem_valido": F.col("valid_icao_origem"),
        "expect_icao_destino_valido": F.col("valid_icao_destino"),
        "expect_horarios_presentes": F.col("valid_horarios"),
        "expect_situacao_conhecida": F.col("valid_situacao"),
    }
