"""Queries for incremental loads, rates, counters, repeats and failure runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.breaker import blocking_breaker
from ..operators.windows import failure_streaks
from ..session import new_folder
from ..streaming import limits, loads
from . import tables as t
from .registry import query

_RATES = """
SELECT user_id, date_trunc('{w}', ts) AS inicio, count(*) AS pedidos, count(*) > {n} AS acima_do_limite FROM events GROUP BY 1, 2"""


def _events(spark, sf):
    return t.table(spark, sf, "events")


def _source(sf: str) -> str:
    """A pattern, because a stream reads folders or patterns: it names the file or folder of events."""
    return f"{sf}/events.parque[t]"


@query("r1_s10_load_new_files", """
SELECT event_type, count(*) AS registros, count(DISTINCT event_id) AS distintos FROM events GROUP BY 1""", views=False)
def r1(spark, sf):
    """Loaded twice: the second run finds nothing new."""
    src, target, ckpt = _source(sf), new_folder(spark, "load"), new_folder(spark, "ckpt")
    schema = _events(spark, sf).schema
    for _ in range(2):
        loads.load_new_files(spark, src, target, ckpt, schema)
    return spark.read.parquet(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("registros"), F.count_distinct("event_id").alias("distintos"))


@query("r2_rate_flags", _RATES.format(w="minute", n=6), views=False)
def r2(spark, sf):
    return limits.rate_flags(_events(spark, sf), "user_id", "ts")


@query("r2_rate_flags_hour", _RATES.format(w="hour", n=1), views=False)
def r2_hour(spark, sf):
    return limits.rate_flags(_events(spark, sf), "user_id", "ts", 1, "1 hour")


@query("r2_rate_flags_stream", _RATES.format(w="hour", n=1), views=False)
def r2_stream(spark, sf):
    stream = loads.stream_table(spark, _source(sf))
    return loads.run_to_table(limits.rate_flags(stream, "user_id", "ts", 1, "1 hour", "1 hour"), keys=["user_id", "inicio"])


_DAILY = """
SELECT CAST(ts AS DATE) AS dia, event_type, count(*) AS chamadas, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS centavos
FROM events GROUP BY 1, 2"""


def _cents(df):
    return df.withColumn("_c", F.round(F.col("value") * 100).cast("long"))


@query("r3_daily_counters", _DAILY, views=False)
def r3(spark, sf):
    return limits.daily_counters(_cents(_events(spark, sf)), "ts", ["event_type"], {"_c": "centavos"})


@query("r3_daily_counters_stream", _DAILY, views=False)
def r3_stream(spark, sf):
    stream = _cents(loads.stream_table(spark, _source(sf)))
    return loads.run_to_table(limits.daily_counters(stream, "ts", ["event_type"], {"_c": "centavos"}, "1 day"), keys=["dia", "event_type"])


_RUNS = """
SELECT {cols}, CASE WHEN event_type = 'error' THEN row_number() OVER (PARTITION BY user_id, ilha ORDER BY ts, event_id) - inicio ELSE 0 END AS sequencia
FROM (SELECT *, CASE WHEN ilha > 0 THEN 1 ELSE 0 END AS inicio FROM (
  SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ilha FROM events))"""


@query("r4_failure_streaks", _RUNS.format(cols="event_id, user_id"), views=False)
def r4(spark, sf):
    e = _events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    runs = failure_streaks(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", F.date_trunc("day", "ts"))
    return runs.select("event_id", "user_id", "sequencia")


@query("r4_breaker", "WITH r AS (" + _RUNS.format(cols="event_id, user_id, ts") + """)
SELECT event_id, user_id, sequencia, sequencia >= 3 AS abre, CASE WHEN sequencia >= 3 THEN ts + INTERVAL 5 MINUTE END AS pausa_ate FROM r""", views=False)
def r4_breaker(spark, sf):
    e = _events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    return limits.breaker(e, ["user_id"], "ts", ["event_id"], F.col("event_type") == "error", F.date_trunc("day", "ts")).select(
        "event_id", "user_id", "sequencia", "abre", "pausa_ate")


_BLOCKING = """
WITH RECURSIVE e AS (SELECT event_id, user_id, ts, event_type = 'error' AS falhou, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (
  SELECT event_id, user_id, ts, falhou, n, false AS bloqueada, CASE WHEN falhou THEN 1 ELSE 0 END AS falhas, CAST(NULL AS TIMESTAMP) AS pausa_ate FROM e WHERE n = 1
  UNION ALL
  SELECT e.event_id, e.user_id, e.ts, e.falhou, e.n, coalesce(e.ts < r.pausa_ate, false),
    CASE WHEN coalesce(e.ts < r.pausa_ate, false) THEN r.falhas WHEN NOT e.falhou THEN 0 WHEN r.falhas = 2 THEN 2 ELSE r.falhas + 1 END,
    CASE WHEN NOT coalesce(e.ts < r.pausa_ate, false) AND e.falhou AND r.falhas = 2 THEN e.ts + INTERVAL 5 MINUTE ELSE r.pausa_ate END
  FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1)
"""


@query("r4_breaker_stream", _BLOCKING + "SELECT event_id, user_id, falhou, bloqueada, falhas, pausa_ate FROM r", views=False)
def r4_stream(spark, sf):
    stream = loads.stream_table(spark, _source(sf))
    return limits.breaker_stream(stream, "user_id", "ts", "event_id", F.col("event_type") == "error").drop("ts", "tardia")


@query("r4_blocking_breaker", _BLOCKING + "SELECT event_id, user_id, falhou, bloqueada, falhas, pausa_ate FROM r", views=False)
def r4_blocking(spark, sf):
    """The blocking breaker over a table of calls, one day a stretch."""
    return blocking_breaker(_events(spark, sf), "user_id", "ts", "event_id", F.col("event_type") == "error", stretch=86_400).drop("ts")


@query("r4_breaker_of_one_key", """
WITH RECURSIVE e AS (SELECT event_id, ts, event_type = 'error' AS falhou, row_number() OVER (ORDER BY ts, event_id) AS n FROM events),
"""+_BLOCKING[_BLOCKING.index("r AS ("):].replace("event_id, user_id", "event_id").replace("e.user_id, ", "").replace("e.user_id = r.user_id AND ", "")
       + "SELECT event_id, falhou, bloqueada, falhas, pausa_ate FROM r", views=False)
def r4_one_key(spark, sf):
    """All calls as those of one key: its days are worked side by side."""
    calls = _events(spark, sf).withColumn("todos", F.lit(1))
    return blocking_breaker(calls, "todos", "ts", "event_id", F.col("event_type") == "error", stretch=86_400).drop("ts", "todos")


def _files_per_lot(calls, lot) -> int:
    """As many files as cores for each lot; one where a lot is too small to fill them, so that lots and batches stay the same."""
    files, sizes = calls.sparkSession.sparkContext.defaultParallelism, dict(calls.groupBy(lot.alias("lot")).count().collect())
    return files if min(sizes.get(n, 0) for n in range(6)) >= files * max(files, calls.rdd.getNumPartitions()) else 1


@query("r4_breaker_stream_late_calls", _BLOCKING + "SELECT event_id, user_id, falhou, bloqueada, falhas, pausa_ate, false AS tardia FROM r", views=False)
def r4_late(spark, sf):
    """Five batches in order of time, a tenth of each batch's calls only in the next one."""
    e = _events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    lo, hi = e.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    width = (hi - lo) // 5 + 1
    lot = F.floor((F.unix_micros("ts") - lo) / width) + (F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0).cast("int")
    path = new_folder(spark, "chamadas")
    files = _files_per_lot(e, lot)
    for n in range(6):
        e.where(lot == n).repartition(files).write.mode("append").parquet(path)
    stream = loads.stream_table(spark, path, maxFilesPerTrigger=files)
    late = limits.breaker_stream(stream, "user_id", "ts", "event_id", F.col("event_type") == "error", delay=width // 1_000_000 + 1)
    return late.drop("ts")


@query("r5_repeats_within", """
SELECT event_id, anterior, coalesce(ts <= anterior + INTERVAL 7 DAY, false) AS repetida FROM (
  SELECT event_id, ts, lag(ts) OVER (PARTITION BY lower(props) ORDER BY ts, event_id) AS anterior FROM events)""", views=False)
def r5(spark, sf):
    rows = limits.repeats_within(_events(spark, sf), "props", "ts", ["event_id"])
    return rows.select("event_id", "anterior", "repetida")


@query("r5_first_within_watermark_stream", "SELECT DISTINCT props FROM events", views=False)
def r5_stream(spark, sf):
    stream = loads.stream_table(spark, _source(sf))
    return loads.run_to_table(limits.first_within_watermark(stream, "props", "ts", 60)).select("props")


@query("r6_quality_split_stream", """
SELECT CASE WHEN value >= 1 AND event_type <> 'error' THEN 'auditado' ELSE 'quarentena' END AS destino, count(*) AS registros FROM events GROUP BY 1""", views=False)
def r6(spark, sf):
    from ..operators.quality import mark_quality

    stream = loads.stream_table(spark, _source(sf))
    marked = mark_quality(stream, [
        ("valid_valor", F.col("value") >= 1, "valor abaixo do minimo"), ("valid_tipo", F.col("event_type") != "error", "evento de erro")])
    good, bad = new_folder(spark, "auditado"), new_folder(spark, "quarentena")
    loads.split_stream(marked, good, bad, new_folder(spark, "ckpt"))
    side = lambda p, n: spark.read.parquet(p).select(F.lit(n).alias("destino"))
    return side(good, "auditado").unionAll(side(bad, "quarentena")).groupBy("destino").agg(F.count(F.lit(1)).alias("registros"))
