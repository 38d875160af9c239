"""Result summaries, number checks, grading, query lint and the evaluation report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx
from ..functions.typing import percent
from ..session import spread
from .aggregates import count_if
from .reconcile import match_with_tolerance
from .windows import nearest_rank


def result_summary(df: DataFrame, keys: Sequence[str], label: str, measure: str, order: str, additive: bool = True) -> DataFrame:
    """Per result: rows, total (counts only), largest and smallest row, first and last row.

    Equal measures go to the row that comes first.
    """
    m, o = F.col(measure), F.col(order)
    whole = F.coalesce(F.bool_and(m.isNull() | (m == F.floor(m))), F.lit(True)) if additive else F.lit(False)
    known = F.when(m.isNotNull(), F.struct(m, -o))
    known_low = F.when(m.isNotNull(), F.struct(m, o))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.when(whole, F.sum(m)).alias("total"),
        F.max(m).alias("maior"), F.max_by(F.col(label), known).alias("maior_rotulo"),
        F.min(m).alias("menor"), F.min_by(F.col(label), known_low).alias("menor_rotulo"),
        F.min_by(F.col(label), o).alias("primeiro_rotulo"), F.min_by(m, o).alias("primeiro"),
        F.max_by(F.col(label), o).alias("ultimo_rotulo"), F.max_by(m, o).alias("ultimo"),
    )


def fill_phrase(template: Column | str, values: Mapping[str, Column]) -> Column:
    """Replace ``{name}`` by text values; NULL when a placeholder stays open or its value is missing."""
    out = F.col(template) if isinstance(template, str) else template
    for name, value in values.items():
        mark = F.lit("{" + name + "}")
        out = F.when(F.contains(out, mark), F.replace(out, mark, value)).otherwise(out)
    closed = F.when(~out.rlike(r"\{[a-z_0-9.]+\}"), out)
    return F.trim(F.regexp_replace(closed, r"\s+", " "))


def extract_numbers(df: DataFrame, id_columns: Sequence[str], text: str) -> DataFrame:
    """One row per number in the text: (ids, ordem, trecho, valor, tolerancia)."""
    rows = spread(df.select(*id_columns, text))
    return rows.select(*id_columns, F.posexplode(tx.numbers_in(text)).alias("ordem", "_x")).select(*id_columns, "ordem", "_x.*")


def known_numbers(results: DataFrame, key: str, numeric: Sequence[str], texts: Sequence[str] = (), questions: DataFrame | None = None,
                  question: str = "pergunta", facts: DataFrame | None = None) -> DataFrame:
    """Numbers an answer may quote, as (key, valor): every cell, every column sum, the row count, and the numbers in text cells.

    ``questions`` (key and a text) adds the numbers of the question. ``facts`` (valor) are known to every answer: their rows
    have a NULL key, as ``unsupported_numbers`` expects of values that hold anywhere.
    """
    cells = results.select(key, F.explode(F.array(*[F.col(c).cast("double") for c in numeric])).alias("valor"))
    sums = results.groupBy(key).agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in numeric], F.count(F.lit(1)).cast("double").alias("_n"))
    totals = sums.select(key, F.explode(F.array(*[F.col(c) for c in numeric], F.col("_n"))).alias("valor"))
    known = cells.unionByName(totals)
    for df, names in ((results, texts), (questions, [question])):
        if df is not None:
            for name in names:
                known = known.unionByName(df.select(key, F.explode(tx.numbers_in(name)).alias("_x")).select(key, F.col("_x.valor").alias("valor")))
    if facts is not None:
        known = known.unionByName(facts.select(F.lit(None).cast(results.schema[key].dataType).alias(key), F.col("valor").cast("double").alias("valor")))
    return known.filter("valor IS NOT NULL")


def small_integer() -> Column:
    """Counts, days and positions need no source."""
    v = F.col("valor")
    return (F.col("tolerancia") < 0.51) & (v == F.floor(v)) & v.between(0, lx.SMALL_INTEGER_MAX)


def unsupported_numbers(texts: DataFrame, key: str, text: str, known: DataFrame, value: str = "valor", scoped: bool = True) -> DataFrame:
    """Numbers of a text that no known value of the same key supports, nor one without a key (of any key when not scoped)."""
    numbers = extract_numbers(texts, [key], text).filter(~small_integer())
    values = known.select(key, F.col(value).alias("_kv"))
    if scoped:
        numbers = match_with_tolerance(numbers, values.filter(F.col(key).isNotNull()), [key], "valor", "tolerancia", "_kv", "anti")
        values = values.filter(F.col(key).isNull())
    return match_with_tolerance(numbers, values.drop(key), [], "valor", "tolerancia", "_kv", "anti")


def answer_tolerance(value) -> Column:
    """Half a unit for whole numbers, else 0.05 percent and at least 0.051."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v == F.floor(v), F.lit(0.5)).otherwise(F.greatest(F.lit(0.051), F.abs(v) * 5e-4))


def missing_keys(expected: DataFrame, cells: DataFrame, key: str = "questao", alternative: str = "alternativa") -> DataFrame:
    """Missing values per accepted alternative.

    ``expected``: (key, alternative, chave, valor, rotulo), one of valor/rotulo filled.
    ``cells``: (key, valor, texto), the cells and column sums of the answer.
    """
    numbers = expected.filter("valor IS NOT NULL").select(key, alternative, "chave", "valor", answer_tolerance("valor").alias("_tol"))
    found_n = match_with_tolerance(numbers, cells.select(key, F.col("valor").alias("_cv")), [key], "valor", "_tol", "_cv").select(
        key, alternative, "chave")
    labels = expected.filter("valor IS NULL AND rotulo IS NOT NULL").select(key, alternative, "chave", tx.comparable_text("rotulo").alias("_l"))
    texts = cells.filter("texto IS NOT NULL").select(F.col(key).alias("_k"), tx.comparable_text("texto").alias("_x")).distinct()
    found_l = labels.join(texts, (labels[key] == texts["_k"]) & F.contains(texts["_x"], labels["_l"]), "left_semi").select(key, alternative, "chave")
    hits = found_n.unionByName(found_l).groupBy(key, alternative).agg(F.count(F.lit(1)).alias("_ok"))
    asked = expected.filter("valor IS NOT NULL OR rotulo IS NOT NULL").groupBy(key, alternative).agg(F.count(F.lit(1)).alias("_all"))
    return asked.join(hits, [key, alternative], "left").select(key, alternative, (F.col("_all") - F.coalesce("_ok", F.lit(0))).alias("faltando"))


def grade_answers(expected: DataFrame, cells: DataFrame, key: str = "questao", alternative: str = "alternativa") -> DataFrame:
    """An answer passes when some accepted alternative has all its values in the result."""
    miss = missing_keys(expected, cells, key, alternative)
    best = miss.groupBy(key).agg(F.min("faltando").alias("faltando"))
    return best.select(key, (F.col("faltando") == 0).alias("ok"), "faltando")


def verdicts(answers: DataFrame, graded: DataFrame, key: str = "questao") -> DataFrame:
    """Final verdict with its reason.

    ``answers``: (key, tipo, esperado_conversa, diz_que_nao, erro, n_linhas, texto).
    """
    a = answers.join(graded, key, "left")
    says_no = F.array_contains(F.split(tx.comparable_text("texto"), r"[^\p{L}\p{N}_]+"), "NAO")
    reason = (
        F.when(F.col("erro").isNotNull() & (F.col("erro") != ""), F.concat(F.lit("erro: "), F.substring("erro", 1, 90)))
        .when(F.col("esperado_conversa") & (F.col("tipo") != "conversa"), F.lit("virou consulta"))
        .when(F.col("esperado_conversa") & F.col("diz_que_nao") & ~says_no, F.lit("não diz que o dado não existe"))
        .when(F.col("esperado_conversa"), F.lit(""))
        .when(F.coalesce(F.col("tipo") != "consulta", F.lit(True)), F.lit("respondeu em prosa"))
        .when(F.coalesce(F.col("n_linhas"), F.lit(0)) == 0, F.lit("0 linhas"))
        .when(~F.coalesce(F.col("ok"), F.lit(False)), F.concat(F.lit("falta "), F.col("faltando").cast("string")))
        .otherwise(F.lit(""))
    )
    return a.select(key, (reason == "").alias("ok"), reason.alias("motivo"))


def lint_queries(df: DataFrame, sql: str, name: str = "problema", cap: int | None = lx.SQL_ROW_CAP, allow_avg: bool = False) -> DataFrame:
    """First reason to refuse a saved query; NULL when it may run."""
    q = F.col(sql)
    low = F.lower(q)
    limit = F.regexp_extract(low, r"\blimit\s+(\d+)", 1).try_cast("long")
    reason = F.when(F.coalesce(q, F.lit("")) == "", F.lit("SQL vazio"))
    reason = reason.when(~low.rlike(r"^\s*(select|with)"), F.lit("não começa com SELECT"))
    reason = reason.when(F.contains(F.expr(f"substring(`{sql}`, 1, length(`{sql}`) - 1)"), F.lit(";")), F.lit("mais de um comando"))
    for word in lx.FORBIDDEN_SQL_WORDS:
        reason = reason.when(low.rlike(rf"\b{word}\b"), F.lit(f'usa "{word}"'))
    if cap is not None:
        reason = reason.when(limit.isNull() | (limit > cap), F.lit(f"sem LIMIT de até {cap}"))
    if not allow_avg:
        reason = reason.when(low.rlike(r"\bavg\s*\("), F.lit("AVG sobre medida"))
    return df.withColumn(name, reason)


def evaluation_report(runs: DataFrame, route: str, ok: str, seconds: str, calls: str, total_label: str = "todas") -> DataFrame:
    """Accuracy, latency percentiles and calls per route and overall. ``ok`` NULL means not measured."""
    both = runs.withColumn("_r", F.explode(F.array(F.col(route).cast("string"), F.lit(total_label)))).filter(F.col("_r").isNotNull())
    done = both.filter(F.col(ok).isNotNull())
    counts = both.groupBy(F.col("_r").alias("rota")).agg(
        F.count(F.lit(1)).alias("perguntas"), F.count(ok).alias("medidas"), count_if(F.coalesce(F.col(ok), F.lit(False))).alias("acertos"),
        F.avg(F.when(F.col(ok).isNotNull(), F.col(calls))).alias("chamadas_media"), F.max(F.when(F.col(ok).isNotNull(), F.col(calls))).alias("chamadas_max"))
    ranks = nearest_rank(done.withColumnRenamed("_r", "_rr"), ["_rr"], seconds, {"p50": 0.5, "p95": 0.95, "maximo": 1.0})
    return counts.join(ranks, counts["rota"] == ranks["_rr"], "left").drop("_rr").withColumn("pct_acerto", percent("acertos", "medidas"))
