"""The metric registry: one definition per metric, right at any grain because it is a ratio of sums."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .typing import PLAUSIBLE_MINUTES, plausible, ratio

CUBE_KEYS = ["ano_mes", "icao_empresa", "icao_origem", "icao_destino", "situacao_voo", "periodo_partida",
             "fim_de_semana", "codigo_tipo_linha"]

MEASURES = ["voos", "realizados", "cancelados", "partidas_pontuais", "chegadas_pontuais", "partidas_atrasadas",
            "partidas_severas", "com_atraso_partida", "soma_atraso_partida", "com_atraso_chegada",
            "soma_atraso_chegada", "com_duracao", "soma_duracao", "com_atraso_plausivel", "soma_atraso_plausivel"]


def row_measures(bounds: tuple[int, int] = PLAUSIBLE_MINUTES) -> dict[str, Column]:
    """What one flight adds to each measure; summing these gives the cube at any grain."""
    one = lambda c: F.when(F.col(c), F.lit(1)).otherwise(F.lit(0)).cast("long")
    has = lambda c: F.col(c).isNotNull().cast("long")
    in_range = plausible("atraso_partida_min", bounds)
    return {
        "voos": F.lit(1).cast("long"),
        "realizados": one("flag_realizado"),
        "cancelados": one("flag_cancelado"),
        "partidas_pontuais": one("partida_pontual"),
        "chegadas_pontuais": one("chegada_pontual"),
        "partidas_atrasadas": one("partida_atrasada"),
        "partidas_severas": one("partida_atraso_severo"),
        "com_atraso_partida": has("atraso_partida_min"),
        "soma_atraso_partida": F.col("atraso_partida_min"),
        "com_atraso_chegada": has("atraso_chegada_min"),
        "soma_atraso_chegada": F.col("atraso_chegada_min"),
        "com_duracao": has("duracao_voo_min"),
        "soma_duracao": F.col("duracao_voo_min"),
        "com_atraso_plausivel": in_range.cast("long"),
        "soma_atraso_plausivel": F.when(in_range, F.col("atraso_partida_min")).otherwise(F.lit(0)).cast("long"),
    }


@dataclass(frozen=True)
class Metric:
    """Numerator over denominator (or a plain sum), with its unit."""

    num: str
    den: str | None = None
    scale: float = 1.0
    unit: str = "voos"

    @property
    def additive(self) -> bool:
        return self.den is None

    def column(self, where: Column | None = None) -> Column:
        pick = lambda c: F.sum(c if where is None else F.when(where, F.col(c)))
        return pick(self.num) if self.den is None else ratio(pick(self.num), pick(self.den), self.scale)


METRICS: Mapping[str, Metric] = {
    **{m: Metric(m) for m in MEASURES},
    "otp": Metric("partidas_pontuais", "realizados", 100.0, "%"),
    "otp_chegada": Metric("chegadas_pontuais", "realizados", 100.0, "%"),
    "taxa": Metric("cancelados", "voos", 100.0, "%"),
    "atraso_bruto": Metric("soma_atraso_partida", "com_atraso_partida", 1.0, "min"),
    "atraso_chegada": Metric("soma_atraso_chegada", "com_atraso_chegada", 1.0, "min"),
    "atraso": Metric("soma_atraso_plausivel", "com_atraso_plausivel", 1.0, "min"),
    "duracao": Metric("soma_duracao", "com_duracao", 1.0, "min"),
}


def metric(name: str, where: Column | None = None, alias: str | None = None) -> Column:
    return METRICS[name].column(where).alias(alias or name)


def metrics(*names: str) -> list[Column]:
    return [metric(n) for n in names]


def measure_sums() -> list[Column]:
    return [F.sum(m).alias(m) for m in MEASURES]
