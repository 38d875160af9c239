"""De-duplication, numbering and ordered-group operators that do not put one hot group in one task."""

from __future__ import annotations

import itertools
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

_ROW_BITS = (1 << 33) - 1
_MAX_LONG = (1 << 63) - 1


def latest_first(ts) -> Column:
    """Ascending sort key that puts the most recent time first and a missing one last."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(-F.unix_micros(ts.cast("timestamp")), F.lit(_MAX_LONG))


def present_first(x) -> Column:
    """0 for filled text, 1 for NULL or empty."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x.isNotNull() & (x != ""), 0).otherwise(1)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name where NULL equals NULL; the keys come from the left."""
    side = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    return left.join(side, [left[k].eqNullSafe(side[f"_r_{k}"]) for k in keys], how).drop(*[f"_r_{k}" for k in keys])


def dedupe_best(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the smallest by ``order``, ties broken by all other columns.

    A minimum over a struct, so every task reduces its own rows before the shuffle; a key with a
    third of all rows costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.min(rank).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def surrogate_key(
    df: DataFrame, name: str, order: Sequence[str], start: int = 1, partitions: int | None = None,
    descending: bool = False,
) -> DataFrame:
    """Dense key 1..n in the order of ``order`` without a global window.

    Rows are range-partitioned, sorted and written once with partition and position; partition sizes become
    offsets. One way for every size: a small table ends up in one file, a fact in many. Give an ``order`` that is
    unique per row (a tie is broken by the remaining columns), so that no single range holds a hot value. Joins to
    the result may be broadcast by the size of its files; there is no hint.
    """
    tail = [c for c in df.columns if c not in order]
    by = [F.desc_nulls_last(c) if descending else F.asc_nulls_first(c) for c in order]
    by += [F.asc_nulls_first(c) for c in tail]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    placed = stored(
        ranged.sortWithinPartitions(*by)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))),
        "numerada",
    )
    # One number per partition comes back, whatever the data size.
    sizes = {r["_pid"]: r["count"] for r in placed.groupBy("_pid").count().collect()}
    offsets = list(itertools.accumulate((sizes.get(p, 0) for p in range(max(sizes, default=0))), initial=start))
    at = F.from_json(F.lit(json.dumps(offsets)), "array<bigint>")
    return placed.select((F.get(at, F.col("_pid")) + F.col("_pos")).alias(name), *df.columns)


def unique_label(df: DataFrame, label: str, code: str, name: str) -> DataFrame:
    """A label that occurs more than once gets its code in brackets."""
    counts = df.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("_c"))
    return (
        df.join(counts, F.col(label).eqNullSafe(F.col("_l")), "left")
        .withColumn(
            name,
            F.when(F.col("_c") > 1, F.concat(F.col(label), F.lit(" ("), F.col(code).cast("string"), F.lit(")")))
            .otherwise(F.col(label)),
        )
        .drop("_l", "_c")
    )


def previous_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str], chunk: Column
) -> DataFrame:
    """``lag`` of columns inside a group, by chunks of the order so a long group spreads over tasks.

    ``chunk`` must grow with ``order`` (an hour, a block of 1000 turns). Inside a chunk a window
    gives the previous row; the first row of a chunk takes the last row of the chunk before, found
    on one row per chunk.
    """
    base = df.withColumn("_chunk", chunk)
    packed = F.struct(*[F.col(c).alias(n) for c, n in values.items()])
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    ends = base.groupBy(*keys, "_chunk").agg(F.max_by(packed, F.struct(*order)).alias("_end"))
    carried = ends.withColumn("_carry", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_chunk"))).drop("_end")
    out = base.withColumn("_prev", F.lag(packed).over(inside))
    out = join_null_safe(out, carried, [*keys, "_chunk"], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    return out.select(*df.columns, *[prev[n].alias(n) for n in values.values()])


def failure_streaks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column, chunk: Column, name: str = "sequencia"
) -> DataFrame:
    """Length of the run of failures ending at each row (0 for a success).

    Runs inside a chunk come from a window over that chunk; each chunk is summarised as (all failed,
    trailing failures), and the run entering a chunk is summed over those summaries only.
    """
    base = df.withColumn("_chunk", chunk).withColumn("_fail", failed.cast("int"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (
        base.withColumn("_pos", F.row_number().over(inside))
        .withColumn("_last_ok", F.coalesce(F.max(F.when(F.col("_fail") == 0, F.col("_pos"))).over(upto), F.lit(0)))
        .withColumn("_run", F.when(F.col("_fail") == 1, F.col("_pos") - F.col("_last_ok")).otherwise(0))
    )
    summary = base.groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_fail").alias("_f"),
        F.max(F.when(F.col("_fail") == 0, F.struct(*order))).alias("_ok_at"),
    )
    # Trailing failures of a chunk: the failures after its last success.
    last_ok = summary.select(*keys, "_chunk", "_n", "_f", "_ok_at")
    tail_rows = (
        join_null_safe(base, last_ok.select(*keys, "_chunk", "_ok_at"), [*keys, "_chunk"])
        .filter(F.col("_ok_at").isNull() | (F.struct(*order) > F.col("_ok_at")))
        .groupBy(*keys, "_chunk").agg(F.sum("_fail").alias("_trail"))
    )
    chunks = join_null_safe(last_ok.drop("_ok_at"), tail_rows, [*keys, "_chunk"], "left").withColumn(
        "_trail", F.coalesce(F.col("_trail"), F.lit(0))
    )
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    running = by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chunks = chunks.withColumn("_island", F.sum((F.col("_f") < F.col("_n")).cast("int")).over(running))
    in_island = Window.partitionBy(*keys, "_island").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    chunks = chunks.withColumn("_leaving", F.sum("_trail").over(in_island))
    chunks = chunks.withColumn("_entering", F.coalesce(F.lag("_leaving").over(by_chunk), F.lit(0)))
    out = join_null_safe(rows, chunks.select(*keys, "_chunk", "_entering"), [*keys, "_chunk"])
    run = F.when((F.col("_fail") == 1) & (F.col("_last_ok") == 0), F.col("_run") + F.col("_entering")).otherwise(F.col("_run"))
    return out.select(*df.columns, run.cast("long").alias(name))


def nearest_rank(
    df: DataFrame, keys: Sequence[str], value: str, percentiles: Mapping[str, float], small: int = 10_000, k: int = 800, rounds: int = 8
) -> DataFrame:
    """Exact nearest-rank percentiles per group; without keys, of all rows. NULL values are left out, NaN is the largest.

    Each rank is bracketed by two pivots out of a hundred from a mergeable sketch (KLL), the rows below and inside the bracket are counted exactly, and only rows
    inside go on, until every bracket has at most ``small`` rows or is one value. The sketch never decides: a bracket that its
    error makes miss the rank is drawn wider in the next round. So no task sorts a group, however its values lie, and a round
    reads a few hundredths of the rows of the one before.
    """
    if not keys:
        return nearest_rank(df.withColumn("_all", F.lit(0)), ["_all"], value, percentiles, small, k, rounds).drop("_all")
    kind = df.schema[value].dataType.simpleString()
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    sketch, quantile = (F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint) if whole else (F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double)
    point = F.col("_v").cast("bigint" if whole else "double")
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    names, group = list(percentiles), [F.col(c) for c in keys]
    inside = lambda i: (F.col(f"_lo{i}").isNull() | (point >= F.col(f"_lo{i}"))) & (F.col(f"_hi{i}").isNull() | (point <= F.col(f"_hi{i}")))
    each = lambda f: [c for i in range(len(names)) for c in f(i)]
    # For each group and percentile: rows in its bracket, rank in there, and the bracket's ends (NULL: open).
    state = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    state = state.select(*group, *each(lambda i: [
        F.col("_n").alias(f"_n{i}"), F.greatest(F.ceil(F.lit(percentiles[names[i]]) * F.col("_n")), F.lit(1)).cast("long").alias(f"_r{i}"),
        F.lit(None).cast(point_type(whole)).alias(f"_lo{i}"), F.lit(None).cast(point_type(whole)).alias(f"_hi{i}")]))
    state, margin = stored(state, "faixas"), 1
    grid = F.array(*[F.lit(x / 100) for x in range(101)])
    large = " OR ".join(f"(_n{i} > {small} AND NOT _lo{i} <=> _hi{i} OR _n{i} > {small} AND _lo{i} IS NULL)" for i in range(len(names)))
    for _ in range(rounds):
        if state.where(large).isEmpty():
            break
        sketched = _beside(rows, state, keys).groupBy(*keys).agg(*each(lambda i: [quantile(sketch(F.when(inside(i), point), F.lit(k)), grid).alias(f"_k{i}")]))
        # A hundred pivots; the rank's own cell and ``margin`` more on both sides.
        cell = lambda i: F.least(F.floor((F.col(f"_r{i}") - 0.5) / F.col(f"_n{i}") * 100), F.lit(99)).cast("int")
        cut = lambda i, at, old: F.when(at.between(1, 99), F.get(f"_k{i}", F.greatest(F.least(at, F.lit(100)), F.lit(0)))).otherwise(F.col(old))
        tried = _beside(state, sketched, keys).select(*group, *each(lambda i: [
            F.col(f"_n{i}"), F.col(f"_r{i}"), F.col(f"_lo{i}"), F.col(f"_hi{i}"), cut(i, cell(i) - margin, f"_lo{i}").alias(f"_a{i}"), cut(i, cell(i) + 1 + margin, f"_hi{i}").alias(f"_b{i}")]))
        tried = stored(tried, "faixas")
        below = lambda i: inside(i) & F.coalesce(point < F.col(f"_a{i}"), F.lit(False))
        above = lambda i: F.coalesce(point > F.col(f"_b{i}"), F.lit(False))
        counts = _beside(rows, tried, keys).groupBy(*keys).agg(*each(lambda i: [F.count_if(below(i)).alias(f"_c{i}"), F.count_if(inside(i) & ~below(i) & ~above(i)).alias(f"_m{i}")]))
        hit = lambda i: (F.col(f"_r{i}") > F.col(f"_c{i}")) & (F.col(f"_r{i}") <= F.col(f"_c{i}") + F.col(f"_m{i}"))
        new = lambda i, yes, no: F.when(hit(i), yes).otherwise(F.col(no)).alias(no)
        state = stored(_beside(tried, counts, keys).select(*group, *each(lambda i: [
            new(i, F.col(f"_m{i}"), f"_n{i}"), new(i, F.col(f"_r{i}") - F.col(f"_c{i}"), f"_r{i}"), new(i, F.col(f"_a{i}"), f"_lo{i}"), new(i, F.col(f"_b{i}"), f"_hi{i}")])), "faixas")
        some = inside(0)
        for i in range(1, len(names)):
            some = some | inside(i)
        rows = stored(_beside(rows, state, keys).where(some).select(*group, "_v"), "restantes")
        margin *= 2
    found = _beside(rows, state, keys)
    found = found.select(*group, "_v", F.explode(F.array(*[F.when(inside(i), F.struct(F.lit(n).alias("p"), F.col(f"_r{i}").alias("r"))) for i, n in enumerate(names)])).alias("_w")).where("_w IS NOT NULL")
    counted = found.groupBy(*keys, F.col("_w.p").alias("_p"), F.col("_w.r").alias("_r"), "_v").agg(F.count(F.lit(1)).alias("_n"))
    cum = F.sum("_n").over(Window.partitionBy(*keys, "_p").orderBy("_v"))
    last = counted.withColumn("_cum", cum).filter(F.col("_cum") >= F.col("_r")).groupBy(*keys, "_p").agg(F.min("_v").alias("_v"))
    return last.groupBy(*keys).agg(*[F.max(F.when(F.col("_p") == n, F.col("_v"))).alias(n) for n in names])


def point_type(whole: bool) -> str:
    return "bigint" if whole else "double"


def _beside(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their group's state; NULL is a group too. No hint: the state is a written table of known size."""
    side = state.select(*[F.col(c).alias(f"_j_{c}") for c in keys], *[c for c in state.columns if c not in (*keys, *rows.columns)])
    return rows.join(side, [rows[c].eqNullSafe(side[f"_j_{c}"]) for c in keys]).drop(*[f"_j_{c}" for c in keys])
