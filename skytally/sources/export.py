"""Sinks: sorted Parquet exports, JSON bundles, partitioned and clustered tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .raw import list_files


def export_table(df: DataFrame, path: str, order: Sequence[str], compression: str = "snappy", files: int | None = None) -> dict:
    """Write one table in the given order and return its rows and bytes.

    Ranges are sorted in parallel and file names follow the order; ``files=1`` gives a single file
    for a small export. Rows are counted while writing.
    """
    seen = Observation("export")
    by = [F.asc_nulls_first(c) for c in order]
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).observe(seen, F.count(F.lit(1)).alias("linhas")).write.mode("overwrite").option(
        "compression", compression).parquet(path)
    size = list_files(df.sparkSession, path, "*.parquet").agg(F.sum("bytes")).first()[0]
    return {"linhas": seen.get["linhas"], "bytes": size or 0}


def json_ready(df: DataFrame) -> DataFrame:
    """NaN becomes NULL, dates and times become ISO text of the day."""
    cols = []
    for f in df.schema.fields:
        c: Column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def clean_records(df: DataFrame, cap: int) -> list[dict]:
    """A small result as clean records; refuses a result above ``cap`` rows instead of cutting it."""
    rows = json_ready(df).limit(cap + 1).collect()
    if len(rows) > cap:
        raise ValueError(f"result has more than {cap} rows; write it with export_bundle")
    return [r.asDict(recursive=True) for r in rows]


def export_bundle(frames: Mapping[str, DataFrame], path: str) -> DataFrame:
    """Write result sets as JSON lines, one folder per section, and return rows per section."""
    stacked = None
    for name, df in frames.items():
        part = json_ready(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"), F.lit(name).alias("secao"))
        stacked = part if stacked is None else stacked.unionByName(part)
    stacked.write.mode("overwrite").partitionBy("secao").text(path)
    back = df.sparkSession.read.text(path)
    return back.groupBy("secao").agg(F.count(F.lit(1)).alias("linhas"))


def write_manifest(row: DataFrame, path: str) -> None:
    """One-row facts as JSON."""
    row.write.mode("overwrite").json(path)


def write_by_month(df: DataFrame, path: str, month: str = "ano_mes", mode: str = "overwrite") -> None:
    """Partition by month. Rebalancing splits a hot month over tasks and merges thin ones."""
    df.hint("rebalance", month).write.mode(mode).partitionBy(month).parquet(path)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """Cluster by columns: ranges over the columns and a row hash, so one hot value fills many files."""
    spread = F.xxhash64(*df.columns)
    df.repartitionByRange(*[F.col(c) for c in columns], spread).sortWithinPartitions(*columns).write.mode(mode).parquet(path)


def curve_position(df: DataFrame, columns: Sequence[str], bits: int = 10) -> Column:
    """Place of a row on a space-filling curve: the bits of the columns' ranks, interleaved (Z-order).

    A column's rank is its range among ``2 ** bits - 1`` approximate quantiles, so skewed columns use all of their bits; text is
    ranked by its first six bytes, which keep its order. NULL ranks first. Only the quantiles come to the driver.
    """
    as_number = {c: _ordered_number(df, c) for c in columns}
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    got = df.agg(*[F.percentile_approx(v, steps, 10_000).alias(f"_{i}") for i, v in enumerate(as_number.values())]).first()
    ranks = []
    for i, v in enumerate(as_number.values()):
        cuts = F.from_json(F.lit(json.dumps(sorted(set(got[i] or [])))), "array<double>")
        # Quantiles at or below the value, found by halving.
        halves = F.array(*[F.lit(1 << k) for k in range(bits - 1, -1, -1)])
        low = F.aggregate(halves, F.lit(0), _halving(cuts, v))
        ranks.append(low.cast("long"))
    place = F.lit(0).cast("long")
    for k in range(bits):
        for i, rank in enumerate(ranks):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, k).bitwiseAND(F.lit(1)), k * len(ranks) + len(ranks) - 1 - i))
    return place


def _halving(cuts: Column, v: Column):
    return lambda at, h: F.when(F.coalesce(F.get(cuts, at + h - 1) <= v, F.lit(False)), at + h).otherwise(at)


def _ordered_number(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType.simpleString()
    if kind == "string":
        return F.conv(F.hex(F.rpad(F.substring(F.col(c).cast("binary"), 1, 6), 6, F.lit(b"\0"))), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(F.col(c)).cast("double")
    return (F.unix_micros(F.col(c).cast("timestamp")) if kind.startswith("timestamp") else F.col(c)).cast("double")


def write_on_curve(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, mode: str = "overwrite", bits: int = 10) -> None:
    """Cluster by several columns at once: files hold stretches of a space-filling curve, so a filter on any of the columns skips most.

    Ranges go over the place on the curve and a row hash, so one hot cell fills many files.
    """
    placed = df.withColumn("_place", curve_position(df, columns, bits))
    by = [F.col("_place"), F.xxhash64(*df.columns)]
    ranged = placed.repartitionByRange(files, *by) if files else placed.repartitionByRange(*by)
    ranged.sortWithinPartitions("_place").drop("_place").write.mode(mode).parquet(path)


def files_touched(spark: SparkSession, path: str, column: str, low, high) -> tuple[int, int]:
    """Files whose values of ``column`` reach into [low, high], and all files: what a filter cannot skip by minimum and maximum."""
    ends = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(column).alias("a"), F.max(column).alias("b"))
    row = ends.agg(F.count_if((F.col("a") <= F.lit(high)) & (F.col("b") >= F.lit(low))).alias("hit"), F.count("*").alias("n")).first()
    return row["hit"], row["n"]
