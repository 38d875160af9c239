"""Quality marks, the audited/quarantine split, mirror and coverage checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.typing import percent, validate_code
from .aggregates import count_if


def mark_quality(df: DataFrame, rules: Sequence[tuple[str, Column, str]], valid: str = "is_valid",
                 reason: str = "motivo_exclusao") -> DataFrame:
    """One boolean per rule, a combined flag, and the reason of the first rule that fails.

    A rule that evaluates to NULL has failed, so every row ends up on exactly one side.
    """
    df = df.withColumns({flag: F.coalesce(cond, F.lit(False)) for flag, cond, _ in rules})
    ok, why = F.lit(True), None
    for flag, _, text in rules:
        ok = ok & F.col(flag)
        why = F.when(~F.col(flag), F.lit(text)) if why is None else why.when(~F.col(flag), F.lit(text))
    return df.withColumns({valid: ok, reason: why})


def split_quality(marked: DataFrame, valid: str = "is_valid", reason: str = "motivo_exclusao",
                  loaded_at: str | None = "transformado_em") -> tuple[DataFrame, DataFrame]:
    """(audited, quarantine); audited drops the reason, both drop the combined flag."""
    audited = marked.filter(F.col(valid)).drop(valid, reason)
    quarantine = marked.filter(~F.col(valid)).drop(valid)
    if loaded_at:
        audited = audited.withColumn(loaded_at, F.current_timestamp())
        quarantine = quarantine.withColumn(loaded_at, F.current_timestamp())
    return audited, quarantine


def expect(df: DataFrame, expectations: Mapping[str, Column], name: str = "expectativas") -> tuple[DataFrame, Observation]:
    """Count rows that break each expectation while the frame is written; no extra scan."""
    seen = Observation(name)
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("linhas"),
        *[count_if(~F.coalesce(cond, F.lit(False))).alias(n) for n, cond in expectations.items()],
    )
    return observed, seen


def expectation_counts(df: DataFrame, expectations: Mapping[str, Column]) -> DataFrame:
    """One row per expectation: rows, and rows that break it. One scan."""
    total = F.count(F.lit(1)).alias("_n")
    sums = df.agg(total, *[count_if(~F.coalesce(cond, F.lit(False))).alias(f"_{i}") for i, cond in enumerate(expectations.values())])
    rows = [F.struct(F.lit(name).alias("expectativa"), F.col("_n").alias("linhas"), F.col(f"_{i}").alias("falhas")) for i, name in enumerate(expectations)]
    return sums.select(F.inline(F.array(*rows)))


def split_summary(marked: DataFrame, valid: str = "is_valid", reason: str = "motivo_exclusao") -> DataFrame:
    """Rows per side and reason; the rows of both sides add up to the input."""
    return marked.groupBy(
        F.when(F.col(valid), F.lit("auditado")).otherwise(F.lit("quarentena")).alias("destino"),
        F.coalesce(F.col(reason), F.lit("")).alias("motivo"),
    ).agg(F.count(F.lit(1)).alias("registros"))


def completeness_proof(marked: DataFrame, valid: str = "is_valid") -> DataFrame:
    return marked.agg(
        F.count(F.lit(1)).alias("entrada"),
        count_if(F.col(valid)).alias("auditado"),
        count_if(~F.col(valid)).alias("quarentena"),
    ).withColumn("diferenca", F.col("entrada") - F.col("auditado") - F.col("quarentena"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table as one report."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(name).alias("tabela"), "registros")
        out = row if out is None else out.unionByName(row)
    return out


def mirror_check(pairs: Mapping[str, tuple[DataFrame | Sequence[DataFrame], DataFrame]]) -> DataFrame:
    """Per table: rows before and after, the difference and a status. Several sources are added up."""
    out = None
    for name, (source, target) in pairs.items():
        sources = source if isinstance(source, (list, tuple)) else [source]
        sides = [s.select(F.lit(1).alias("_b"), F.lit(0).alias("_s")) for s in sources]
        sides.append(target.select(F.lit(0).alias("_b"), F.lit(1).alias("_s")))
        rows = sides[0]
        for s in sides[1:]:
            rows = rows.unionAll(s)
        row = rows.agg(
            F.coalesce(F.sum("_b"), F.lit(0)).alias("bronze"), F.coalesce(F.sum("_s"), F.lit(0)).alias("silver")
        ).select(F.lit(name).alias("tabela"), "bronze", "silver")
        out = row if out is None else out.unionByName(row)
    diff = F.col("bronze") - F.col("silver")
    return out.withColumns({"diferenca": diff, "status": F.when(diff == 0, F.lit("OK")).otherwise(F.lit("ERRO"))})


def code_validity(tables: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Invalid codes and percent valid per table; each entry is (frame, column, pattern)."""
    out = None
    for name, (df, column, pattern) in tables.items():
        ok = validate_code(F.col(column).cast("string"), pattern)["valido"]
        row = df.agg(
            F.count(F.lit(1)).alias("total_registros"), count_if(~ok).alias("icao_invalidos"), count_if(ok).alias("_ok")
        ).select(F.lit(name).alias("tabela"), "total_registros", "icao_invalidos",
                 percent("_ok", "total_registros").alias("pct_validos"))
        out = row if out is None else out.unionByName(row)
    return out


def referential_coverage(fact: DataFrame, keys: Mapping[str, str], name: str = "fato_voos", unknown: int = 0) -> DataFrame:
    """Rows whose surrogate key is the unknown member, with the status and on-time rates."""
    done, cancelled, punctual = count_if("flag_realizado"), count_if("flag_cancelado"), count_if("partida_pontual")
    total = F.count(F.lit(1))
    return fact.agg(
        F.lit(name).alias("tabela"), total.alias("total_voos"),
        *[count_if(F.col(k) == unknown).alias(n) for n, k in keys.items()],
        percent(done, total).alias("pct_realizado"), percent(cancelled, total).alias("pct_cancelado"),
        percent(punctual, done).alias("pct_partida_pontual"),
    )


def load_audit(fact: DataFrame, dims: Mapping[str, DataFrame], keys: Mapping[str, str], table: str = "fato_voos") -> DataFrame:
    """Audit record of a load: one scan of the fact, plus the row counts of the dimensions."""
    row = fact.agg(
        F.count(F.lit(1)).alias("registros_total"),
        count_if("flag_realizado").alias("registros_realizados"),
        count_if("flag_cancelado").alias("registros_cancelados"),
        *[count_if(F.col(k) == 0).alias(n) for n, k in keys.items()],
    )
    for name, dim in dims.items():
        row = row.withColumn(name, dim.agg(F.count(F.lit(1))).scalar())
    return row.select(F.current_timestamp().alias("data_carga"), F.lit(table).alias("tabela"), "*", F.lit("SUCCESS").alias("status"))


def obt_check(obt: DataFrame, fact: DataFrame) -> DataFrame:
    """Validation row of the wide table."""
    absent = lambda c: count_if(F.col(c).isNull())
    return obt.agg(
        F.count(F.lit(1)).alias("total_obt"),
        absent("empresa_nome").alias("sem_empresa"), absent("origem_nome").alias("sem_origem"),
        absent("destino_nome").alias("sem_destino"),
        count_if(F.col("rota_distancia_km").isNotNull()).alias("com_distancia"),
        percent(count_if("partida_pontual"), count_if("flag_realizado")).alias("pct_otp"),
        F.count_distinct("empresa_nome").alias("empresas_unicas"),
        F.count_distinct("rota_faixa_distancia").alias("faixas_distancia"),
    ).withColumn("total_fato", fact.agg(F.count(F.lit(1))).scalar())


def conversion_counts(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """How many values survived typing, per column."""
    return df.agg(F.count(F.lit(1)).alias("total_linhas"), *[F.count(c).alias(n) for c, n in columns.items()])


def check_semantic_layer(described: Mapping[str, Sequence[str]], tables: Mapping[str, DataFrame]) -> list[str]:
    """Columns described but absent, and present but not described. Compares schemas, reads no data."""
    problems = []
    for table in sorted(set(described) | set(tables)):
        want, have = set(described.get(table, ())), set(tables[table].columns if table in tables else ())
        problems += [f"{table}.{c}: descrita e inexistente" for c in sorted(want - have)]
        problems += [f"{table}.{c}: sem descricao" for c in sorted(have - want)]
    return problems


def missing_placeholders(texts: DataFrame, text: str, facts: DataFrame, fact: str) -> DataFrame:
    """Placeholders used in texts for which no fact exists."""
    from ..functions.text import placeholders

    used = texts.select(F.explode(placeholders(text)).alias("marcador")).groupBy("marcador").agg(
        F.count(F.lit(1)).alias("usos")
    )
    known = facts.select(F.col(fact).alias("_f")).distinct()
    return used.join(known, used["marcador"] == known["_f"], "left_anti")


def check_aliases(aliases: DataFrame, targets: DataFrame, names: DataFrame) -> DataFrame:
    """Problems of an alias list (alias, alvo, fonte): unknown target, not normalised, two targets, not in a name.

    ``targets`` has ``alvo``; ``names`` has (alvo, nome) for the aliases that must occur in a name.
    """
    from ..functions.text import normalize_text

    pairs = aliases.select("apelido", "alvo", "fonte").distinct()
    known = targets.select(F.col("alvo").alias("_t")).filter("_t IS NOT NULL").distinct()
    no_target = pairs.join(known, pairs["alvo"] == known["_t"], "left_anti").select(
        "apelido", F.col("alvo").cast("string").alias("alvo"), F.lit("alvo inexistente").alias("problema"))
    raw = pairs.filter(F.col("apelido") != normalize_text("apelido")).select(
        "apelido", F.col("alvo").cast("string").alias("alvo"), F.lit("nao normalizado").alias("problema"))
    double = pairs.select("apelido", "alvo").distinct().groupBy("apelido").agg(F.count(F.lit(1)).alias("_n")).filter(
        "_n > 1").select("apelido", F.lit(None).cast("string").alias("alvo"), F.lit("mais de um alvo").alias("problema"))
    base = pairs.filter("fonte = 'base'")
    named = names.select(F.col("alvo").alias("_na"), normalize_text("nome").alias("_nome")).distinct()
    unseen = base.join(
        named, (base["alvo"] == named["_na"]) & F.contains(F.col("_nome"), F.col("apelido")), "left_anti"
    ).select("apelido", F.col("alvo").cast("string").alias("alvo"), F.lit("apelido fora do nome").alias("problema"))
    return no_target.unionByName(raw).unionByName(double).unionByName(unseen)
