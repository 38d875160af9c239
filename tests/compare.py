"""Run registered queries next to their SQL check and compare names, row counts and values.

    python tests/compare.py [sf_dir] [name-part ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(repr(round(v, 9) + 0.0))
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    return v


KINDS = {"bigint": "int", "int": "int", "smallint": "int", "double": "float", "float": "float", "string": "text", "boolean": "bool",
         "date": "date", "timestamp": "time", "timestamp_ntz": "time", "BIGINT": "int", "INTEGER": "int", "HUGEINT": "hugeint", "DOUBLE": "float",
         "FLOAT": "float", "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "time", "TIMESTAMP WITH TIME ZONE": "time"}


def compare(df, con, sql: str) -> str:
    """Empty when both sides agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    got = df.collect()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    order = sorted(names)
    for n in order:
        s, d = df.schema[n].dataType.simpleString(), types[n]
        if KINDS.get(s, s) != KINDS.get(d, d) and not (s.startswith("array") or s.startswith("struct")):
            return f"type of {n}: {s} / {d}"
    key = lambda row: tuple((x is not None, str(type(x)), str(x)) for x in row)
    a = sorted((tuple(plain(r[n]) for n in order) for r in got), key=key)
    pos = [names.index(n) for n in order]
    b = sorted((tuple(plain(r[i]) for i in pos) for r in want), key=key)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            bad = [(n, p, q) for n, p, q in zip(order, x, y) if p != q]
            return f"value {bad[:4]}"
    return ""


def main() -> int:
    import __spark_entry__ as e
    from skytally.session import local_session

    args = sys.argv[1:]
    sf = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    parts = [a for a in args if "/" not in a]
    spark, con = local_session(), duck(sf)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                result = compare(df, con, sqls[name])
                n = ""
            else:
                n = f"rows-only {df.count()}"
                result = ""
        except Exception as ex:  # report and go on
            result, n = f"{type(ex).__name__}: {str(ex)[:600]}", ""
        bad += bool(result)
        print(f"{'FAIL' if result else 'ok  '} {name:<36} {time.time() - start:6.2f}s {n}{result}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
