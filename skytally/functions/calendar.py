"""Calendar attributes, part of day and month labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .typing import _c

# Labels the results must carry.
MONTH_ABBREVIATIONS = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]
SOUTHERN_SEASONS = {"verao": (12, 1, 2), "outono": (3, 4, 5), "inverno": (6, 7, 8), "primavera": (9, 10, 11)}
DAY_PERIODS = (("madrugada", 6), ("manha", 12), ("tarde", 18), ("noite", 24))
UNDATED_ORDER = 999999


def day_period(ts, periods=DAY_PERIODS) -> Column:
    """Part of day by upper hour bound; NULL without a time."""
    hour = F.hour(_c(ts))
    out = F.when(hour < periods[0][1], F.lit(periods[0][0]))
    for name, upper in periods[1:]:
        out = out.when(hour < upper, F.lit(name))
    return out


def season(date, seasons=SOUTHERN_SEASONS) -> Column:
    month = F.month(_c(date))
    out = None
    for name, months in seasons.items():
        cond = month.isin(list(months))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def date_key(date) -> Column:
    d = _c(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_month(date) -> Column:
    return F.date_format(_c(date), "yyyy-MM")


def is_weekend(date) -> Column:
    return F.dayofweek(_c(date)).isin(1, 7)


def month_label(month, year) -> Column:
    """``ago/2025``: unique across years, independent of the locale."""
    names = F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS])
    return F.concat(F.element_at(names, _c(month).cast("int")), F.lit("/"), _c(year).cast("int").cast("string"))


def month_order(year, month) -> Column:
    """Sortable month number; months without a date go last."""
    return F.coalesce((_c(year) * 100 + _c(month)).cast("int"), F.lit(UNDATED_ORDER))


def calendar_attributes(date) -> dict[str, Column]:
    """Every calendar column of a date, by name."""
    d = _c(date)
    return {
        "sk_tempo": date_key(d),
        "ano": F.year(d),
        "mes": F.month(d),
        "nome_mes": F.date_format(d, "MMMM"),
        "dia": F.dayofmonth(d),
        "dia_semana_num": F.dayofweek(d),
        "nome_dia_semana": F.date_format(d, "EEEE"),
        "trimestre": F.quarter(d),
        "ano_mes": year_month(d),
        "fim_de_semana": is_weekend(d),
        "estacao": season(d),
    }
