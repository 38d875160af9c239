"""Lookups, membership and dictionary joins.

Joins carry no broadcast hints: the size statistics and adaptive execution decide, so a dimension
that outgrows the broadcast threshold falls back to a shuffle join, and a hot key is split by the
adaptive skew rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: they would multiply the rows of a lookup."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("repeticoes")).filter("repeticoes > 1")


def unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The dimension itself, refused with some of its repeated keys if it has any. Give a stored one: it is read for this."""
    repeated = [tuple(r)[:-1] for r in duplicate_keys(dim, keys).orderBy(*keys).limit(5).collect()]
    if repeated:
        raise ValueError(f"repeated keys {', '.join(keys)}: {repeated}")
    return dim


def prefix_dim(dim: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The same dimension in a role: every column renamed ``prefix_column``."""
    return dim.select(*[F.col(c).alias(f"{prefix}_{c}") for c in columns or dim.columns])


def lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left lookup that keeps every row of ``df``: ``on`` maps df key to dim key, ``take`` dim column to new name."""
    keys = {f"_k{i}": d for i, d in enumerate(on.values())}
    side = dim.select(*[F.col(d).alias(k) for k, d in keys.items()], *[F.col(c).alias(n) for c, n in take.items()])
    cond = reduce(lambda a, b: a & b, [df[f] == side[k] for f, k in zip(on, keys)])
    return df.join(side, cond, "left").drop(*keys)


def lookup_keys(df: DataFrame, specs: Sequence[tuple[DataFrame, Mapping[str, str], str, str]], unknown: int = 0) -> DataFrame:
    """Surrogate keys of many dimensions: each spec is (dimension, key pairs, its key column, new name)."""
    for dim, on, key, name in specs:
        df = lookup(df, dim, on, {key: name})
    names = [s[3] for s in specs]
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(unknown)) for n in names})


def mark_reference(df: DataFrame, reference: DataFrame, column: str, reference_column: str, flag: str) -> DataFrame:
    """Boolean flag: does the value of ``column`` exist in the reference?"""
    keys = reference.select(F.col(reference_column).alias("_ref")).filter("_ref IS NOT NULL").distinct()
    return (
        df.join(keys, df[column] == keys["_ref"], "left")
        .withColumn(flag, F.col("_ref").isNotNull())
        .drop("_ref")
    )


def members_of(df: DataFrame, column: str, members: DataFrame, member_column: str) -> DataFrame:
    """``column IN (members)`` as a semi join."""
    side = members.select(F.col(member_column).alias("_m"))
    return df.join(side, df[column] == side["_m"], "left_semi")


def not_members_of(df: DataFrame, column: str, members: DataFrame, member_column: str) -> DataFrame:
    """``column NOT IN (members)`` where NULL members are ignored and a NULL value is never kept."""
    side = members.select(F.col(member_column).alias("_m")).filter("_m IS NOT NULL")
    return df.filter(F.col(column).isNotNull()).join(side, F.col(column) == side["_m"], "left_anti")


def membership_split(df: DataFrame, column: str, members: DataFrame, member_column: str) -> tuple[DataFrame, DataFrame]:
    """(inside, outside) the member set."""
    return members_of(df, column, members, member_column), not_members_of(df, column, members, member_column)


def dictionary(spark, pairs: Mapping, key: str, value: str) -> DataFrame:
    """A constant mapping as a two-column frame; its size is that of the literal itself."""
    return spark.createDataFrame([(k, v) for k, v in pairs.items()], f"{key} string, {value} string")


def enrich(df: DataFrame, pairs: Mapping[str, str], column: str, name: str) -> DataFrame:
    """Dictionary enrichment with a constant map; NULL for keys the map does not have."""
    side = dictionary(df.sparkSession, pairs, "_dk", name)
    return df.join(side, df[column] == side["_dk"], "left").drop("_dk")


def with_scalar(df: DataFrame, frame: DataFrame, name: str) -> DataFrame:
    """Attach the single value of a one-row frame through a scalar subquery."""
    return df.withColumn(name, frame.scalar())


def set_diff(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of each side that the other lacks, with the side they are on."""
    l, r = left.select(*columns).distinct(), right.select(*columns).distinct()
    cond: list[Column] = [l[c].eqNullSafe(r[c]) for c in columns]
    only_left = l.join(r, cond, "left_anti").withColumn("lado", F.lit("so_esquerda"))
    only_right = r.join(l, cond, "left_anti").withColumn("lado", F.lit("so_direita"))
    return only_left.unionByName(only_right)


def assert_empty(df: DataFrame, message: str, show: int = 20) -> None:
    """Stop with a message that quotes the first offending rows."""
    rows = df.limit(show).collect()
    if rows:
        raise AssertionError(f"{message}: {[tuple(r) for r in rows]}")
