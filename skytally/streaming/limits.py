"""Rates, daily counters, repeats and the failure breaker: batch and streaming forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_text
from ..operators.breaker import blocking_breaker
from ..operators.windows import failure_streaks, previous_in_group
from ..session import new_folder, remove_folder
from .loads import finish

PER_MINUTE = 6
BREAKER_FAILURES = 3
BREAKER_PAUSE_SECONDS = 300
REPEAT_DAYS = 7


def rate_flags(events: DataFrame, key: str, ts: str, limit: int = PER_MINUTE, width: str = "1 minute",
               watermark: str | None = None) -> DataFrame:
    """Requests per key and window, flagged above the limit. The same plan on a batch or a stream."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark:
        rows = rows.withWatermark(ts, watermark)
    counts = rows.groupBy(F.window(ts, width).alias("_w"), key).agg(F.count(F.lit(1)).alias("pedidos"))
    return counts.select(key, F.col("_w.start").alias("inicio"), "pedidos", (F.col("pedidos") > limit).alias("acima_do_limite"))


def daily_counters(events: DataFrame, ts: str, keys: Sequence[str], sums: dict[str, str] | None = None,
                   watermark: str | None = None) -> DataFrame:
    """Counts (and sums) per day and keys."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark:
        rows = rows.withWatermark(ts, watermark)
    out = rows.groupBy(F.window(ts, "1 day").alias("_w"), *keys).agg(
        F.count(F.lit(1)).alias("chamadas"), *[F.sum(c).alias(n) for c, n in (sums or {}).items()])
    return out.select(F.to_date("_w.start").alias("dia"), *[c for c in out.columns if c != "_w"])


def breaker(events: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], failed: Column, chunk: Column,
            failures: int = BREAKER_FAILURES, pause: int = BREAKER_PAUSE_SECONDS) -> DataFrame:
    """Batch form over recorded calls: the run of failures at each call, whether it opens (or reopens)
    the breaker, and until when it then stays open. After the pause one more failure reopens it. A record of
    calls that were made, so calls inside a pause count like any other; ``breaker_stream`` is the form that blocks."""
    runs = failure_streaks(events, keys, [ts, *tie], failed, chunk)
    opens = F.col("sequencia") >= failures
    return runs.withColumns({"abre": opens, "pausa_ate": F.when(opens, F.col(ts) + F.make_dt_interval(secs=F.lit(float(pause))))})


def repeats_within(rows: DataFrame, text: str, ts: str, tie: Sequence[str], days: int = REPEAT_DAYS, chunk: Column | None = None) -> DataFrame:
    """Texts whose normalised form was already seen at most ``days`` before, with that earlier time."""
    keyed = rows.withColumn("_norm", normalize_text(text))
    chunk = chunk if chunk is not None else F.date_trunc("hour", F.col(ts))
    prev = previous_in_group(keyed, ["_norm"], [ts, *tie], {ts: "anterior"}, chunk)
    limit = F.col("anterior") + F.make_dt_interval(F.lit(days))
    return prev.withColumn("repetida", F.coalesce(F.col(ts) <= limit, F.lit(False))).drop("_norm")


def first_within_watermark(stream: DataFrame, text: str, ts: str, days: int = REPEAT_DAYS) -> DataFrame:
    """Streaming form: only the first text of each normalised form passes until the watermark has moved on by ``days``."""
    rows = stream.withColumns({ts: F.col(ts).cast("timestamp"), "_norm": normalize_text(text)})
    return rows.withWatermark(ts, f"{days} days").dropDuplicatesWithinWatermark(["_norm"]).drop("_norm")


def breaker_stream(events: DataFrame, key: str, ts: str, tie: str, failed: Column, target: str | None = None, failures: int = BREAKER_FAILURES,
                   pause: int = BREAKER_PAUSE_SECONDS, delay: int = 3600, stretch: int = 3600) -> DataFrame:
    """Streaming form in event time: a call inside a pause is blocked and changes nothing.

    Run over the available input; the stored rows are (tie, key, ts, falhou, bloqueada, falhas, pausa_ate, tardia). Calls wait until the
    latest time seen is ``delay`` seconds past them, so batches may bring them in any order within that; what still waits when the input ends
    is judged then. A call that comes later than that finds its time already judged: it changes nothing and is marked ``tardia``, with the other results
    NULL. A call without key or time is passed on with NULL results. Calls that are due go through ``blocking_breaker`` in stretches, so a
    key of any size spreads over tasks; count and pause of each key go from batch to batch and are forgotten when they say nothing any more.

    The batch number is part of every path, so a batch that is run again replaces its own output; state and waiting calls of batches before
    the last two are removed.
    """
    spark = events.sparkSession
    target = target or new_folder(spark, "disjuntor")
    kinds = {c: events.schema[c].dataType.simpleString() for c in (tie, key)}
    call = f"{tie} {kinds[tie]}, {key} {kinds[key]}, {ts} timestamp, falhou boolean"
    micros, empty = F.unix_micros(ts), lambda schema: spark.createDataFrame([], schema)
    seen = [-1]

    def saved(df: DataFrame, name: str, number: int) -> DataFrame:
        path = f"{target}/{name}/{number}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def earlier(name: str, number: int, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{target}/{name}/{number - 1}") if number else empty(schema)

    def judge(batch: DataFrame, number: int, last: bool = False) -> None:
        pool = saved(batch.unionByName(earlier("espera", number, call)), "lido", number)
        mark = (earlier("marca", number, "marca long").first() or [None])[0]
        mark = -(1 << 62) if mark is None else mark
        newest = pool.agg(F.max(micros)).first()[0]
        upto = (1 << 62) if last else mark if newest is None else max(mark, newest - delay * 1_000_000)
        placed = F.col(key).isNotNull() & F.col(ts).isNotNull()
        due = pool.where(~placed | ((micros >= mark) & (micros < upto)))
        before = earlier("estado", number, f"{key} {kinds[key]}, falhas int, pausa timestamp")
        done = blocking_breaker(due, key, ts, tie, F.col("falhou"), failures, pause, stretch, before).withColumn("tardia", F.lit(False))
        late = pool.where(placed & (micros < mark)).select("*", *(F.lit(None).cast(k).alias(c) for c, k in (("bloqueada", "boolean"), ("falhas", "int"), ("pausa_ate", "timestamp"))), F.lit(True).alias("tardia"))
        done.unionByName(late).write.mode("overwrite").parquet(f"{target}/chamadas/lote={number}")
        new = spark.read.parquet(f"{target}/chamadas/lote={number}").where("bloqueada IS NOT NULL")
        new = new.groupBy(key).agg(F.max_by(F.struct("falhas", "pausa_ate", ts), F.struct(ts, tie)).alias("l"))
        says = (F.col("l.falhas") > 0) | F.col("l.pausa_ate").isNotNull()
        kept = before.join(new, key, "left_anti").unionByName(new.where(says).select(key, F.col("l.falhas").alias("falhas"), F.col("l.pausa_ate").alias("pausa")))
        saved(kept, "estado", number)
        saved(pool.where(placed & (micros >= upto)), "espera", number)
        saved(spark.createDataFrame([(upto,)], "marca long"), "marca", number)
        seen[0] = number
        for name in ("lido", "estado", "espera", "marca"):
            remove_folder(spark, f"{target}/{name}/{number - 2}")

    rows = events.select(tie, key, F.col(ts).cast("timestamp").alias(ts), F.coalesce(failed, F.lit(False)).alias("falhou"))
    done = f"{call}, bloqueada boolean, falhas int, pausa_ate timestamp, tardia boolean"
    empty(done).write.parquet(f"{target}/chamadas/lote=-1")
    finish(rows.writeStream.option("checkpointLocation", new_folder(spark, "ckpt")).foreachBatch(judge))
    if seen[0] >= 0:
        judge(empty(call), seen[0] + 1, last=True)
    return spark.read.schema(done).parquet(f"{target}/chamadas").drop("lote")
