"""Text normalisation, stemming, number reading and repair as native expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx
from .typing import _c


def _accent_table() -> tuple[str, str]:
    """Letters that decompose to one ASCII letter plus marks, and that letter."""
    source, target = [], []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        parts = unicodedata.normalize("NFD", chr(cp))
        base = [p for p in parts if not 0x300 <= ord(p) <= 0x36F]
        if len(parts) > 1 and len(base) == 1 and base[0].isascii():
            source.append(chr(cp))
            target.append(base[0])
    marks = [chr(cp) for cp in range(0x300, 0x370)]
    return "".join(source + marks), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def strip_accents(x) -> Column:
    """Latin letters without accents; combining marks are removed."""
    return F.translate(_c(x), _ACCENTED, _PLAIN)


def normalize_text(x) -> Column:
    """Lower case, no accents, only ``a-z 0-9 : /`` and single spaces."""
    plain = F.lower(strip_accents(F.coalesce(_c(x), F.lit(""))))
    # Non-word characters and "_", less ":" and "/". Written as an intersection because the plain
    # negated class mixing ranges and single characters is five times slower in the JVM.
    return F.trim(F.regexp_replace(plain, r"[\W_&&[^:/]]+", " "))


def comparable_text(x) -> Column:
    """Upper case, no accents, single spaces: the form labels are compared in."""
    return F.trim(F.regexp_replace(F.upper(strip_accents(F.coalesce(_c(x), F.lit("")))), r"\s+", " "))


def words(normalized) -> Column:
    return F.filter(F.split(_c(normalized), "[ :/]+"), lambda w: w != "")


def without_greeting(normalized) -> Column:
    """The question after a greeting; a greeting alone stays."""
    return F.regexp_replace(_c(normalized), lx.GREETING_PREFIX, "")


def stem(word) -> Column:
    """Light stem: common plurals, then the longest known ending that leaves three letters."""
    w = _c(word)
    plural = None
    for ending, new in lx.PLURAL_ENDINGS:
        hit = w.endswith(ending)
        value = F.regexp_replace(w, f"{ending}$", new)
        plural = F.when(hit, value) if plural is None else plural.when(hit, value)
    single = F.regexp_replace(plural.otherwise(w), "(?<![su])s$", "")
    base = F.when(F.length(w) > 4, single).otherwise(w)
    cut = F.regexp_replace(base, f"^(.{{3,}}?)({'|'.join(lx.STEM_ENDINGS)})$", "$1")
    return F.when(w.startswith("#") | (F.length(w) <= 3), w).otherwise(cut)


def content_terms(normalized, stop_words: Sequence[str] = tuple(lx.STOP_WORDS)) -> Column:
    """Distinct stems of the words that count when two questions are compared."""
    kept = F.array_distinct(F.filter(words(normalized), lambda w: ~w.isin(list(stop_words))))
    return F.array_sort(F.array_distinct(F.transform(kept, stem)))


def repair_mojibake(x) -> Column:
    """Undo UTF-8 read as ISO-8859-1; text that cannot be repaired cleanly stays as it is."""
    x = _c(x)
    latin = F.when(x.rlike(r"^[\x00-\xFF]*$"), x)
    repaired = F.try_validate_utf8(F.encode(latin, "ISO-8859-1").cast("string"))
    return F.when(repaired.isNotNull() & ~repaired.rlike(r"[\p{Cc}\p{Cn}]"), repaired).otherwise(x)


def looks_mojibake(x) -> Column:
    return _c(x).rlike("Ã")


def clean_name(name: str) -> str:
    """Column name without byte-order mark, spaces as ``_``, without ``,;{}()`` and line breaks."""
    return re.sub(r"[,;{}()\n\t=]", "", name.replace("\ufeff", "").strip().replace(" ", "_"))


def classify(normalized, triggers=None) -> Column:
    """Label of the first trigger whose pattern occurs; NULL when none does."""
    n = _c(normalized)
    out = None
    for label, pattern in triggers or lx.TRIGGERS:
        out = F.when(n.rlike(pattern), F.lit(label)) if out is None else out.when(n.rlike(pattern), F.lit(label))
    return out


def number_spans(text, pattern: str = lx.NUMBER_PATTERN) -> Column:
    """Every number as written, with its scale word."""
    return F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(pattern), F.lit(0))


def read_number(span) -> Column:
    """Struct ``(trecho, valor, tolerancia)``: half a unit of the last digit written is tolerated."""
    span = _c(span)
    digits = F.replace(F.regexp_extract(span, r"^([\d.,]*\d)", 1), F.lit("."), F.lit(""))
    decimals = F.length(F.regexp_extract(digits, r",(\d+)$", 1))
    scale = F.lower(F.regexp_extract(span, r"(\p{L}+)$", 1))
    factor = (
        F.when(scale == "mil", F.lit(1e3))
        .when(scale.startswith("milh"), F.lit(1e6))
        .when(scale.startswith("bilh"), F.lit(1e9))
        .otherwise(F.lit(1.0))
    )
    value = F.replace(digits, F.lit(","), F.lit(".")).cast("double") * factor
    tolerance = F.lit(0.5) * F.pow(F.lit(10.0), -decimals) * factor + F.lit(1e-9)
    return F.struct(F.trim(span).alias("trecho"), value.alias("valor"), tolerance.alias("tolerancia"))


def numbers_in(text) -> Column:
    return F.transform(number_spans(text), read_number)


def format_br(x, decimals: int = 0) -> Column:
    """``1.014.705`` or ``73,8``."""
    return F.translate(F.format_number(F.round(_c(x), decimals), decimals), ",.", ".,")


def format_unit(x, unit: str) -> Column:
    """A value as answers write it: ``73,8%``, ``23,6 min``, ``1.024 km``, ``147.976``."""
    x = _c(x).cast("double")
    if unit == "%":
        return F.concat(format_br(x, 1), F.lit("%"))
    if unit == "min":
        return F.concat(format_br(x, 1), F.lit(" min"))
    if unit == "km":
        return F.concat(format_br(x, 0), F.lit(" km"))
    if unit == "voos":
        return format_br(x, 0)
    return F.when(x == F.floor(x), format_br(x, 0)).otherwise(format_br(x, 1))


def placeholders(text) -> Column:
    """Names between braces, such as ``voos`` in ``{voos}``."""
    return F.regexp_extract_all(_c(text), F.lit(r"\{([a-z_0-9.]+)\}"), F.lit(1))


def any_word(tokens, vocabulary: Iterable[str]) -> Column:
    return F.arrays_overlap(_c(tokens), F.array(*[F.lit(v) for v in vocabulary]))
