"""The failure breaker over calls in order of time, for keys of any size.

What a stretch of calls does to the breaker is a small function: it takes the count of failures before it, or the end of a pause that
reaches into it, to the state behind it. Functions of stretches are found side by side, run through for each key (one row a stretch), and then
every stretch is followed from its own entry state, again side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import importable, stored

#: No pause so far; of an exit: the pause stays what it was.
NONE = -(1 << 62)


def stretch_map(t: np.ndarray, bad: np.ndarray, failures: int, pause: int) -> dict:
    """The function of a stretch of calls (times ascending) that follows all calls before it.

    ``first``: time of its first call. ``count``/``until``: state behind it for each count before it, with no pause. ``ends``,
    ``end_count``, ``end_until``: the same for a pause from before that ends at or before ``ends`` (and after the entry before); pauses that
    end in a like way share an entry. Found from the last call back: what follows a call is known when the call is looked at.
    """
    n = len(t)
    jump = np.searchsorted(t, t + pause, "left")  # the call that comes first after a pause opened here
    count, until = [list(range(failures))], [[NONE] * failures]
    for i in range(n - 1, -1, -1):
        c, u = count[-1], until[-1]  # behind call i
        if not bad[i]:
            count.append([c[0]] * failures)
            until.append([u[0]] * failures)
            continue
        k, last = int(jump[i]), failures - 1
        at = n - k
        opened = (count[at][last], until[at][last])
        opened = (opened[0], int(t[i]) + pause if opened[1] == NONE else opened[1])
        count.append([*c[1:], opened[0]])
        until.append([*u[1:], opened[1]])
    out = {"first": int(t[0]), "count": count[-1], "until": until[-1], "ends": [], "end_count": [], "end_until": []}
    reach = min(n, int(np.searchsorted(t, t[0] + pause, "left")) + 1)  # no pause from before reaches further
    for i in range(reach):
        if i and t[i] == t[i - 1]:
            continue
        end = (count[n - i][failures - 1], until[n - i][failures - 1])
        if out["ends"] and (out["end_count"][-1], out["end_until"][-1]) == end:
            out["ends"][-1] = int(t[i])
        else:
            out["ends"].append(int(t[i]))
            out["end_count"].append(end[0])
            out["end_until"].append(end[1])
    return out


def through(state: tuple[int, int], m) -> tuple[int, int]:
    """The state behind a stretch, from the one before it."""
    count, until = state
    if until <= m["first"]:
        count, new = m["count"][count], m["until"][count]
    else:
        k = int(np.searchsorted(m["ends"], until, "left"))
        if k == len(m["ends"]):
            return state
        count, new = m["end_count"][k], m["end_until"][k]
    return int(count), until if new == NONE else int(new)


_MAP = "first long, count array<int>, until array<long>, ends array<long>, end_count array<int>, end_until array<long>"


def _runs(pages: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple]:
    """Key, stretch and arrays of time and failure for each run of a sorted partition; a run may go over pages."""
    now, times, bads = None, [], []
    for page in pages:
        keys, stretches, t, bad = (page[c].to_numpy() for c in columns)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (stretches[1:] != stretches[:-1])) + 1
        for a, z in zip([0, *cuts], [*cuts, len(page)]):
            if a == z:
                continue
            if now is not None and now != (keys[a], stretches[a]):
                yield *now, np.concatenate(times), np.concatenate(bads)
                times, bads = [], []
            now = keys[a], stretches[a]
            times.append(t[a:z])
            bads.append(bad[a:z])
    if now is not None:
        yield *now, np.concatenate(times), np.concatenate(bads)


def blocking_breaker(
    calls: DataFrame, key: str, ts: str, tie: str, failed: Column, failures: int = 3, pause: int = 300, stretch: int = 3600, before: DataFrame | None = None,
) -> DataFrame:
    """tie, key, ts, falhou, bloqueada, falhas, pausa_ate of every call, in the order of time, then ``tie``, of its key.

    ``failures`` failures in a row open the breaker for ``pause`` seconds; a call inside the pause is blocked and changes nothing; after it
    one more failure opens it again. ``falhas`` and ``pausa_ate`` are the state behind the call. ``before`` (key, falhas, pausa) is the state the keys
    start from. A call without key or time cannot be placed: its bloqueada, falhas and pausa_ate are NULL. A missing ``failed`` is no failure.

    A key's calls are worked in stretches of ``stretch`` seconds (no shorter than the pause), each a task's work of its own; only one row
    per stretch passes the task of its key.
    """
    importable(calls.sparkSession)
    pause_us, width = pause * 1_000_000, max(stretch, pause) * 1_000_000
    kinds = {c: calls.schema[c].dataType.simpleString() for c in (tie, key)}
    rows = calls.select(tie, key, ts, F.coalesce(failed, F.lit(False)).alias("falhou"))
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    placed = rows.where(known).withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp"))).withColumn("_s", F.floor(F.col("_t") / F.lit(width)))
    order = [key, "_s", "_t", tie]

    def maps(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = _runs(pages, [key, "_s", "_t", "falhou"])
        while part := list(islice(runs, 500)):
            yield pd.DataFrame([{key: k, "_s": s, **stretch_map(t, bad, failures, pause_us)} for k, s, t, bad in part])

    def entries(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = object(), (0, NONE)
        for page in pages:
            out = []
            for m in page.to_dict("records"):
                if m[key] != now:
                    now, state = m[key], (int(m["_c"]), int(m["_u"]))
                out.append((m[key], m["_s"], *state))
                state = through(state, m)
            yield pd.DataFrame(out, columns=[key, "_s", "_c", "_u"])

    def follow(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, count, until = None, 0, NONE
        for page in pages:
            out = []
            for ident, who, when, bad, s, c, u in page.itertuples(index=False):
                if (who, s) != now:
                    now, count, until = (who, s), int(c), int(u)
                blocked = when < until
                if not blocked:
                    count = count + 1 if bad else 0
                    if count >= failures:
                        until, count = when + pause_us, failures - 1
                out.append((ident, who, when, bad, blocked, count, until))
            yield pd.DataFrame(out, columns=[tie, key, "_t", "falhou", "bloqueada", "falhas", "_u"])

    held = f"{key} {kinds[key]}, _s long"
    found = placed.select(key, "_s", "_t", tie, "falhou").repartition(key, "_s").sortWithinPartitions(*order).mapInPandas(maps, f"{held}, {_MAP}")
    start = F.coalesce(F.col("falhas"), F.lit(0)).alias("_c"), F.coalesce(F.unix_micros("pausa"), F.lit(NONE)).alias("_u")
    found = found.join(before, key, "left").select(*found.columns, *start) if before is not None else found.withColumns({"_c": F.lit(0), "_u": F.lit(NONE)})
    at = stored(found.repartition(key).sortWithinPartitions(key, "_s").mapInPandas(entries, f"{held}, _c int, _u long"), "entradas")
    ready = placed.join(at, [key, "_s"]).select(tie, key, "_t", "falhou", "_s", "_c", "_u").repartition(key, "_s").sortWithinPartitions(*order)
    done = ready.mapInPandas(follow, f"{tie} {kinds[tie]}, {key} {kinds[key]}, _t long, falhou boolean, bloqueada boolean, falhas int, _u long")
    done = done.select(tie, key, F.timestamp_micros("_t").alias(ts), "falhou", "bloqueada", "falhas", F.when(F.col("_u") != NONE, F.timestamp_micros("_u")).alias("pausa_ate"))
    unplaced = rows.where(~known).select(tie, key, F.col(ts).cast("timestamp").alias(ts), "falhou", *(F.lit(None).cast(k).alias(c) for c, k in (("bloqueada", "boolean"), ("falhas", "int"), ("pausa_ate", "timestamp"))))
    return done.unionByName(unplaced)
