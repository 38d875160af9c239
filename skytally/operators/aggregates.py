"""Aggregations: every one reduces its rows before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.typing import ratio


def count_if(cond: Column | str) -> Column:
    cond = F.col(cond) if isinstance(cond, str) else cond
    return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("long")


def sum_count(column: str, sum_name: str, count_name: str) -> list[Column]:
    """Sum and non-null count: together they give the mean at any level."""
    return [F.sum(column).alias(sum_name), F.count(column).alias(count_name)]


def mean_where(value: str, cond: Column | str) -> Column:
    cond = F.col(cond) if isinstance(cond, str) else cond
    return F.avg(F.when(cond, F.col(value)))


def distinct_where(value: Column | str, cond: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    cond = F.col(cond) if isinstance(cond, str) else cond
    return F.count_distinct(F.when(cond, value))


def min_volume(df: DataFrame, column: str, floor: int) -> DataFrame:
    """Keep groups with at least ``floor`` of a count."""
    return df.filter(F.col(column) >= F.lit(floor))


def dependent_attributes(df: DataFrame, keys: Sequence[str], attributes: Mapping[str, str], how: str = "max") -> DataFrame:
    """Attributes that depend on the key, one per key (``attributes`` maps source to name)."""
    fn = F.max if how == "max" else F.min
    return df.groupBy(*keys).agg(*[fn(c).alias(n) for c, n in attributes.items()])


def dependency_violations(df: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Keys for which an attribute takes more than one value."""
    # Distinct combinations first: a hot key contributes each value once.
    seen = df.select(*keys, *attributes).distinct()
    bad = seen.groupBy(*keys).agg(*[F.count_distinct(a).alias(a) for a in attributes])
    cond = F.lit(False)
    for a in attributes:
        cond = cond | (F.col(a) > 1)
    return bad.filter(cond)


def arg_best(df: DataFrame, keys: Sequence[str], label: str, by: str, largest: bool = True) -> DataFrame:
    """The label with the largest (smallest) value per group; ties go to the smallest label."""
    score = F.struct(-F.col(by) if largest else F.col(by), F.col(label))
    rows = df.filter(F.col(by).isNotNull())
    picked = F.min_by(F.struct(F.col(label), F.col(by)), score).alias("_b")
    out = rows.groupBy(*keys).agg(picked).filter("_b IS NOT NULL")
    return out.select(*keys, F.col(f"_b.{label}").alias(label), F.col(f"_b.{by}").alias(by))


def category_cuts(
    df: DataFrame, cuts: Mapping[str, Column | str], measures: Mapping[str, Column], missing: str = "(sem valor)"
) -> DataFrame:
    """The same additive measures cut by each categorical column, stacked as (dimensao, categoria).

    One scan: rows are reduced to category combinations, and only those are unfolded per dimension.
    ``measures`` are row-level numbers to be summed.
    """
    cols = {n: (F.col(c) if isinstance(c, str) else c) for n, c in cuts.items()}
    joint = df.select(*[c.cast("string").alias(f"_c_{n}") for n, c in cols.items()], *[m.alias(n) for n, m in measures.items()])
    joint = joint.groupBy(*[f"_c_{n}" for n in cols]).agg(*[F.sum(m).alias(m) for m in measures])
    unfolded = joint.select(
        F.explode(F.array(*[
            F.struct(F.lit(n).alias("dimensao"), F.coalesce(F.col(f"_c_{n}"), F.lit(missing)).alias("categoria"))
            for n in cols
        ])).alias("_x"),
        *measures,
    )
    return unfolded.groupBy(F.col("_x.dimensao").alias("dimensao"), F.col("_x.categoria").alias("categoria")).agg(
        *[F.sum(m).alias(m) for m in measures]
    )


def label_collisions(df: DataFrame, label: str, code: str) -> DataFrame:
    """Labels shared by several codes, one row per (label, code) with the size of the label.

    Kept as rows so that a label with very many codes never becomes one array.
    """
    pairs = df.filter(F.col(label).isNotNull()).select(label, code).distinct()
    sizes = pairs.groupBy(label).agg(F.count(F.lit(1)).alias("membros")).filter("membros > 1")
    return pairs.join(sizes, label)


def weighted_mean(df: DataFrame, value: str, weight: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of ``value`` weighted by ``weight``; rows without a value or weight do not count."""
    rows = df.filter(F.col(value).isNotNull() & F.col(weight).isNotNull())
    grouped = rows.groupBy(*keys)
    return grouped.agg(ratio(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias(name))


def profile_nulls(df: DataFrame, columns: Sequence[str], sentinel: str = "null") -> DataFrame:
    """Per column: rows, NULLs, sentinel texts, empty texts and filled values, from one scan."""
    aggs = []
    for c in columns:
        text = F.col(c).cast("string")
        aggs.append(F.struct(
            F.lit(c).alias("coluna"),
            F.count(F.lit(1)).alias("linhas"),
            count_if(text.isNull()).alias("nulos"),
            count_if(text == sentinel).alias("sentinelas"),
            count_if(text == "").alias("vazios"),
            count_if(text.isNotNull() & ~text.isin(sentinel, "")).alias("preenchidos"),
        ))
    return df.agg(F.array(*aggs).alias("_p")).select(F.inline("_p"))


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Percent of the grand total, taken by a scalar subquery instead of a global window."""
    total = df.agg(F.sum(value).alias("_t"))
    return df.withColumn("_t", total.scalar()).withColumn(name, ratio(value, "_t", 100.0)).drop("_t")


def load_stats(df: DataFrame, source: str, distinct: Mapping[str, str] | None = None, span: str | None = None) -> DataFrame:
    """Rows per source file, with distinct counts and the first and last value of a column."""
    aggs = [F.count(F.lit(1)).alias("registros")]
    aggs += [F.count_distinct(c).alias(n) for c, n in (distinct or {}).items()]
    if span:
        aggs += [F.min(span).alias("primeiro"), F.max(span).alias("ultimo")]
    return df.groupBy(source).agg(*aggs)


def outcome_rollup(
    df: DataFrame, key: str, outcome: str, outcomes: Sequence[str], totals: Mapping[str, str] | None = None, other: str = "outro"
) -> DataFrame:
    """Calls per key by outcome, unlisted outcomes together, plus sums of other columns."""
    aggs = [F.count(F.lit(1)).alias("chamadas")]
    aggs += [count_if(F.col(outcome) == o).alias(o) for o in outcomes]
    aggs.append(count_if(F.col(outcome).isNull() | ~F.col(outcome).isin(list(outcomes))).alias(other))
    aggs += [F.sum(c).alias(n) for c, n in (totals or {}).items()]
    return df.groupBy(key).agg(*aggs)


def movement(df: DataFrame, origin: str, destination: str, volume: Column | str, name: str = "movimento") -> DataFrame:
    """Departures plus arrivals per place, from one scan."""
    volume = F.col(volume) if isinstance(volume, str) else volume
    sides = df.select(volume.alias("_v"), F.explode(F.array(
        F.struct(F.col(origin).alias("local"), F.lit(1).alias("_dep")),
        F.struct(F.col(destination).alias("local"), F.lit(0).alias("_dep")),
    )).alias("_s"))
    v, dep = F.col("_v"), F.col("_s._dep")
    return sides.groupBy(F.col("_s.local").alias("local")).agg(
        F.sum(F.when(dep == 1, v).otherwise(0)).alias("partidas"),
        F.sum(F.when(dep == 0, v).otherwise(0)).alias("chegadas"),
        F.sum(v).alias(name),
    )


def missing_code_counts(df: DataFrame, code: str, name: str, count: str, missing: str = "(sem codigo)") -> DataFrame:
    """Rows per code, NULL and empty codes together under one label."""
    return df.groupBy(F.coalesce(F.nullif(F.col(code), F.lit("")), F.lit(missing)).alias(name)).agg(
        F.count(F.lit(1)).alias(count)
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int | None) -> DataFrame:
    """First k rows, or all in order; give the order a unique tail so that ties cannot change the answer."""
    ordered = df.orderBy(*order)
    return ordered if k is None else ordered.limit(k)
