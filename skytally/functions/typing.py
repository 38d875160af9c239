"""Typing, sentinels, flags and safe arithmetic as native column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ON_TIME_MINUTES = 15
SEVERE_MINUTES = 60
PLAUSIBLE_MINUTES = (-60, 1440)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_if_sentinel(x, sentinels: Iterable[str] = ("null",)) -> Column:
    """Text that spells "absent" becomes NULL; add ``""`` to also drop empty text."""
    x = _c(x)
    return F.when(~F.trim(x).isin(list(sentinels)), x)


def typed_timestamp(x, fmt: str | None = None, sentinels: Iterable[str] = ("null",)) -> Column:
    """Text to timestamp without time zone, NULL when it cannot be read."""
    x = null_if_sentinel(x, sentinels)
    if fmt:
        return F.try_to_timestamp(x, F.lit(fmt)).cast("timestamp_ntz")
    return x.try_cast("timestamp_ntz")


def typed_date(x, fmt: str | None = None, sentinels: Iterable[str] = ("null",)) -> Column:
    return typed_timestamp(x, fmt, sentinels).cast("date")


def decimal_comma(x) -> Column:
    """``"393,4"`` to 393.4, NULL when it is not a number."""
    return F.replace(_c(x), F.lit(","), F.lit(".")).try_cast("double")


def tolerant_double(x) -> Column:
    return _c(x).try_cast("double")


def minutes_between(start, end) -> Column:
    """Whole minutes from start to end, truncated toward zero; NULL when a side is NULL."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def delay_minutes(scheduled, actual) -> Column:
    return minutes_between(scheduled, actual)


def minutes_recovered(departure_delay, arrival_delay) -> Column:
    """Departure delay minus arrival delay; NULL unless both exist."""
    return _c(departure_delay) - _c(arrival_delay)


def presence_label(columns: Iterable, present: str, absent: str) -> Column:
    return F.when(all_present(*columns), F.lit(present)).otherwise(F.lit(absent))


def all_present(*columns) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & _c(c).isNotNull()
    return out


def describe_code(x, labels: Mapping[str, str], default: str) -> Column:
    x = _c(x)
    out = None
    for code, label in labels.items():
        out = F.when(x == F.lit(code), F.lit(label)) if out is None else out.when(x == F.lit(code), F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def has_keyword(x, keyword: str, mode: str = "word") -> Column:
    """Keyword in upper-cased text. ``word`` does not see ATIVA inside INATIVA, ``substring`` does."""
    text = F.upper(F.coalesce(_c(x), F.lit("")))
    if mode == "substring":
        return text.contains(keyword.upper())
    return text.rlike(rf"(^|[^\p{{L}}]){re.escape(keyword.upper())}($|[^\p{{L}}])")


def keyword_status(x, rules: Mapping[str, str], default: str, mode: str = "word") -> Column:
    """First keyword found decides the status, in the order of ``rules``."""
    out = None
    for keyword, label in rules.items():
        cond = has_keyword(x, keyword, mode)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def is_code(x, code: str) -> Column:
    """Equality that answers FALSE, not NULL, for an absent code."""
    return F.coalesce(_c(x) == F.lit(code), F.lit(False))


def on_time(delay, threshold: int = ON_TIME_MINUTES) -> Column:
    return F.coalesce(_c(delay) <= F.lit(threshold), F.lit(False))


def late(delay, threshold: int = ON_TIME_MINUTES) -> Column:
    return F.coalesce(_c(delay) > F.lit(threshold), F.lit(False))


def plausible(delay, bounds: tuple[int, int] = PLAUSIBLE_MINUTES) -> Column:
    return F.coalesce(_c(delay).between(*bounds), F.lit(False))


def implausible(delay, bounds: tuple[int, int] = PLAUSIBLE_MINUTES) -> Column:
    return F.coalesce(~_c(delay).between(*bounds), F.lit(False))


def unknown_member(key, value=0) -> Column:
    return F.coalesce(_c(key), F.lit(value))


def filled(x, label: str) -> Column:
    """Empty or missing text replaced by a label."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), F.lit(label))


def route_key(origin, destination, sep: str = ">") -> Column:
    """``origin>destination``; NULL when a side is NULL."""
    return F.concat(_c(origin).cast("string"), F.lit(sep), _c(destination).cast("string"))


def pair_low(a, b) -> Column:
    return F.least(_c(a), _c(b))


def pair_high(a, b) -> Column:
    return F.greatest(_c(a), _c(b))


def label_of(*columns) -> Column:
    """City, else name, else code."""
    return F.coalesce(*[_c(c).cast("string") for c in columns])


def ratio(num, den, scale: float = 1.0) -> Column:
    """``scale * num / den`` as DOUBLE, NULL for a zero or missing denominator."""
    return F.lit(scale) * _c(num).cast("double") / F.nullif(_c(den), F.lit(0)).cast("double")


def percent(num, den) -> Column:
    return ratio(num, den, 100.0)


def validate_code(x, pattern: str) -> Column:
    """Struct ``(valido, motivo)``: is the code present and well formed?"""
    x = _c(x)
    return F.struct(
        F.coalesce(x.rlike(pattern), F.lit(False)).alias("valido"),
        F.when(x.isNull(), F.lit("ausente"))
        .when(F.trim(x).isin("", "null"), F.lit("vazio"))
        .when(~x.rlike(pattern), F.lit("formato"))
        .alias("motivo"),
    )
