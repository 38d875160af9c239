"""Secret scan: base spans against plain loops, links by hand, and the SQL on a table that has both."""

import hashlib
import random
import re

import duckdb
import pytest

from compare import compare
from skytally.llm import audit_checks
from skytally.llm.secret_scan import digest, linked_spans, scan

KEY = "AKIA" + "Q7" * 8
BIG = "aB3" + "xyZ9" * 8
PATTERNS = (("assign", r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
            ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16))


def brute(text):
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, g, n) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if len(m.group(g)) >= n]
    return [s for _, _, s in sorted(found)]


def some():
    r = random.Random(11)
    bits = ["token", "secret", "toKen", "to\u212aen", "api_key", "APIKEY", "passwd", "password", '"', "'", "=", ":", " ", "  ", "\n", "\n\n", "\n \t\n", "é", "İ", "😀", "abcdef0123456789", "ABC", "x", "hunter2",
            "AKIA", KEY, BIG, "user", "client_id", "https://h.example/p", "s3://b/k", "0123456789", "login"]
    return [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 60)))) for i in range(400)]


ODD = [(1000, None), (1001, ""), (1002, " \n"), (1003, "token = " + "a" * 11), (1003, "token = " + "a" * 12), (None, f"secret:{KEY}"), (1004, "token=secret:abcdefghijklmnop"), (1005, "secretoken=abcdefghijkl"),
       (1006, "token" + " " * 50_000 + "=" + "a" * 50_000), (1007, "0a" * 100_000), (1008, "a = b " * 40_000), (1009, "AKIA" * 30_000)]


def test_base_equals_loops(docs):
    rows = some() + ODD
    got = digest(scan(docs(rows))).collect()
    want = {(i, hashlib.sha256(",".join(b).encode()).hexdigest(), *(sum(s.startswith(k) for s in b) for k in ("assign", "access", "hex"))) for i, t in rows for b in [brute(t)]}
    assert len(got) == len(rows) and {(r.doc_id, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in got} == want
    for (_, t), spans in zip(rows, (linked_spans(t or "", 400) for _, t in rows)):
        assert [f"{s.kind}:{s.start}:{s.end}" for s in spans if s.base] == brute(t)


@pytest.mark.parametrize(
    "text,kinds",
    [
        ("password = hunter2", []),  # a weak secret alone
        ("user = bob", []),
        (f"see {BIG}", []),
        ("user = bob\npassword = hunter2", []),  # two weak parts, no endpoint
        ("user = bob\npassword = hunter2\nhttps://h.example/p", ["ident", "short", "endpoint"]),
        ("user = bob\npassword = hunter2\n \nhttps://h.example/p", []),  # another scope
        (f"{KEY}\n{BIG}", ["access", "mixed"]),
        (f"{KEY}\n\n{BIG}", ["access"]),
        (f"{KEY}{' x' * 300}\n{BIG}", ["access"]),  # one scope, out of reach
        (f"{KEY}\nat https://h.example/p with {BIG}", ["access", "endpoint", "mixed"]),
        ("client_id: abc and token: abcdefghijkl", ["ident", "assign"]),
        ("https://h.example/p", []),
    ],
)
def test_links(text, kinds):
    assert [s.kind for s in linked_spans(text, 400)] == kinds


def test_equals_sql(spark, docs):
    rows = [r for r in some() + ODD if len(r[1] or "") < 60_000 and "\u212a" not in (r[1] or "")] + [(2000 + i, f"{KEY} é\nuser={i}\npasswd:ab12cd\n" + "x " * i + BIG + " https://e.example/" + "z" * i) for i in range(0, 400, 7)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert compare(digest(scan(docs(rows))), con, audit_checks.secrets()) == ""


def test_empty_table(docs):
    assert digest(scan(docs([]))).count() == 0
