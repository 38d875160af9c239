"""Reconciliation of two sources and tolerance matching."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored


def reconcile_totals(left: DataFrame, right: DataFrame, checks: Mapping[str, tuple[Column, Column]],
                     names: tuple[str, str] = ("no_fato", "na_obt")) -> DataFrame:
    """One row per measure: both totals and their difference. Each side is scanned once."""
    a, b = names
    sides = left.agg(*[l.cast("long").alias(f"_l{i}") for i, (l, _) in enumerate(checks.values())])
    other = right.agg(F.struct(*[r.cast("long").alias(f"_r{i}") for i, (_, r) in enumerate(checks.values())]).alias("_r"))
    sides = sides.withColumn("_r", other.scalar())
    rows = sides.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("medida"), F.col(f"_l{i}").alias(a), F.col(f"_r._r{i}").alias(b))
        for i, name in enumerate(checks)
    ])))
    return rows.withColumn("diferenca", F.col(a) - F.col(b))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str],
              names: tuple[str, str] = ("esquerda", "direita")) -> DataFrame:
    """Full reconciliation on keys: values of both sides, their difference, and where the key exists.

    NULL keys meet each other. The sides are stacked and grouped, so a key that repeats is summed,
    and a key missing on one side stays visible.
    """
    a, b = names

    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        mark = F.lit(1)
        return df.select(
            *keys, *[F.col(m).alias(f"{m}_{mine}") for m in measures],
            *[F.lit(None).cast(df.schema[m].dataType).alias(f"{m}_{other}") for m in measures],
            mark.alias(f"_{mine}"), F.lit(0).alias(f"_{other}"),
        )

    both = side(left, a, b).unionByName(side(right, b, a))
    out = both.groupBy(*keys).agg(
        *[F.sum(f"{m}_{s}").alias(f"{m}_{s}") for m in measures for s in names],
        F.max(f"_{a}").alias("_in_a"), F.max(f"_{b}").alias("_in_b"),
    )
    diffs = {f"{m}_diferenca": F.col(f"{m}_{a}") - F.col(f"{m}_{b}") for m in measures}
    where = (F.when((F.col("_in_a") == 1) & (F.col("_in_b") == 1), F.lit("ambos"))
             .when(F.col("_in_a") == 1, F.lit(f"so_{a}")).otherwise(F.lit(f"so_{b}")))
    return out.withColumns({**diffs, "presenca": where}).drop("_in_a", "_in_b")


def _sums(rows: DataFrame, level: str) -> DataFrame:
    """Order-independent checksum of each bucket: rows, both halves of the hashes added, and their exclusive or."""
    h = F.col("_h")
    return rows.groupBy(level).agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("a"), F.sum(F.shiftright(h, 32)).alias("b"), F.bit_xor(h).alias("x"))


def differing_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str], fan: int = 4096, levels: int = 2) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides whose keys lie in buckets that differ: a superset of all differences, and little more.

    A tree of checksums: keys fall into ``fan`` buckets by hash, each of these into ``fan`` more. Both sides are summed per bucket,
    map-side, and only buckets whose sums differ are looked into again. Equal sides cost one scan each and no shuffle of rows; what is
    joined in the end goes with the number of differences. Two buckets with the same four sums and different rows (one chance in 2^100 or so) would pass.
    """
    kinds = {m: left.schema[m].dataType if left.schema[m].dataType == right.schema[m].dataType else "double" for m in measures}

    def hashed(df: DataFrame) -> DataFrame:
        values = [F.coalesce(F.col(m).cast(k).cast("string"), F.lit("\0")) for m, k in kinds.items()]
        names = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]
        place = F.xxhash64(F.lit(7), *names)
        df = df.withColumns({"_h": F.xxhash64(*names, *values), "_b0": F.pmod(place, F.lit(fan))})
        for k in range(1, levels):
            df = df.withColumn(f"_b{k}", F.col(f"_b{k - 1}") * fan + F.pmod(F.shiftright(place, 12 * k), F.lit(fan)))
        return df

    sides = [hashed(left), hashed(right)]
    for k in range(levels):
        level = f"_b{k}"
        a, b = (_sums(s, level) for s in sides)
        b = b.select(F.col(level).alias("_other"), *[F.col(c).alias(f"_{c}") for c in "nabx"])
        same = F.lit(True)
        for c in "nabx":
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        apart = a.join(b, a[level] == b["_other"], "full").where(~same).select(F.coalesce(level, "_other").alias("_apart"))
        apart = stored(apart, "divergentes")
        sides = [s.join(apart, s[level] == apart["_apart"], "left_semi") for s in sides]
    return sides[0].select(*left.columns), sides[1].select(*right.columns)


def reconcile_differences(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str],
                          names: tuple[str, str] = ("esquerda", "direita"), fan: int = 4096, levels: int = 2) -> DataFrame:
    """The rows of ``reconcile`` that show a difference, or a key on one side alone, found through checksums."""
    a, b = differing_rows(left, right, keys, measures, fan, levels)
    out = reconcile(a, b, keys, measures, names)
    differs = F.col("presenca") != "ambos"
    for m in measures:
        differs = differs | ~F.col(f"{m}_{names[0]}").eqNullSafe(F.col(f"{m}_{names[1]}"))
    return out.where(differs)


def match_with_tolerance(
    expected: DataFrame, values: DataFrame, scope: Sequence[str], value: str, tolerance: str, other: str,
    how: str = "semi",
) -> DataFrame:
    """Expected rows for which some value of the same scope lies within the row's own tolerance.

    ``how='anti'`` keeps those without one. Values fall on a grid whose step is the tolerance
    rounded up to a power of two, so an expected row looks at three cells at most; values are made
    distinct first. A tolerance of zero asks for equality; a negative or missing one is never met.
    """
    level = F.when(F.col(tolerance) == 0, 0).when(F.col(tolerance) > 0, F.ceil(F.log2(F.col(tolerance))))
    step = lambda l: F.pow(F.lit(2.0), l)
    want = expected.withColumn("_level", level)
    cells = want.select(
        *scope, F.col(value).alias("_e"), F.col(tolerance).alias("_tol"), "_level",
        F.explode(F.sequence(
            F.floor((F.col(value) - F.col(tolerance)) / step(F.col("_level"))),
            F.floor((F.col(value) + F.col(tolerance)) / step(F.col("_level"))),
        )).alias("_cell"),
    ).distinct()
    levels = want.select("_level").distinct()
    known = values.filter(F.col(other).isNotNull()).select(*[F.col(s).alias(f"_s_{s}") for s in scope], F.col(other).cast("double").alias("_v")).distinct()
    # The levels in use form one short array: the exponents of doubles bound its length.
    grid = known.withColumn("_levels", levels.agg(F.collect_set("_level")).scalar())
    grid = grid.withColumn("_l2", F.explode("_levels")).withColumn("_c2", F.floor(F.col("_v") / step(F.col("_l2"))))
    cond = [cells[s] == grid[f"_s_{s}"] for s in scope]
    cond += [cells["_level"] == grid["_l2"], cells["_cell"] == grid["_c2"],
             F.abs(cells["_e"] - grid["_v"]) <= cells["_tol"]]
    hits = cells.join(grid, cond, "left_semi").select(
        *[F.col(s).alias(f"_h_{s}") for s in scope], F.col("_e").alias("_he"), F.col("_tol").alias("_htol")
    ).distinct()
    cond = [want[s] == hits[f"_h_{s}"] for s in scope] + [want[value] == hits["_he"], want[tolerance] == hits["_htol"]]
    return want.join(hits, cond, "left_semi" if how == "semi" else "left_anti").select(*expected.columns)
