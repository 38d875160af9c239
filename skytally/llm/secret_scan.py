"""Secrets in texts: base patterns, and weak parts of a credential that count only next to what completes them."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import bounded

#: Names before a secret's value and the base patterns, in the order of their kinds.
SECRET_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
_ACCESS, _HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]+"
#: Least characters of a base match; of an assignment, of its value.
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: Weak parts: short values of secrets' names, long tokens of mixed characters, named identifiers, endpoints.
IDENT_NAMES = ("access_key_id", "access_id", "client_id", "account_id", "user_name", "username", "user", "login")
_SHORT = r"(password|passwd|secret|token|api_?key)[\"']?\x20{0,8}[:=]\x20{0,8}[\"']?([A-Za-z0-9+/_.=@!-]{6,})"
_IDENT = rf"({'|'.join(IDENT_NAMES)})[\"']?\x20{{0,8}}[:=]\x20{{0,8}}[\"']?([A-Za-z0-9+/_.@-]{{3,}})"
_MIXED = r"[A-Za-z0-9+/_=-]{20,}"
_ENDPOINT = r"(https?|ftp|s3|postgres|mysql|redis|amqp|mongodb)://[A-Za-z0-9._~:@/?#%&=+-]{3,}"
KINDS = ("assign", "access", "hex", "short", "mixed", "ident", "endpoint")
#: A scope ends at a line without a word.
_SCOPE_END = r"\n[\x20\x09\x0B-\x0D]*\n"
SPAN = "struct<kind:string,start:int,end:int,base:boolean>"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool


_RE = {k: re.compile(p, re.ASCII | (re.IGNORECASE if k in ("assign", "short", "ident") else 0)) for k, p in
       (("assign", _ASSIGN), ("access", _ACCESS), ("hex", f"[0-9a-f]{{{LEAST['hex']},}}"), ("short", _SHORT), ("mixed", _MIXED), ("ident", _IDENT), ("endpoint", _ENDPOINT))}


def _named(kind: str, text: str, lower: str, names: tuple[str, ...]) -> Iterator[re.Match]:
    """Leftmost non-overlapping matches of a pattern that starts with one of ``names``, in either case.

    ``lower`` has the text's length; the names are looked up in it, the pattern is tried at those places alone.
    """
    places = []
    for name in names:
        at = lower.find(name)
        while at >= 0:
            places.append(at)
            at = lower.find(name, at + 1)
    end = 0
    for at in sorted(set(places)):
        if at >= end and (m := _RE[kind].match(text, at)):
            yield m
            end = m.end()


def _base(text: str, lower: str) -> list[Span]:
    """Base spans. A hex run of its least length is what the pattern with ``+`` finds, less the runs to be dropped."""
    out = [Span("assign", *m.span(), True) for m in _named("assign", text, lower, SECRET_NAMES) if len(m.group(2)) >= LEAST["assign"]]
    for kind in ("access", "hex"):
        out += [Span(kind, *m.span(), True) for m in _RE[kind].finditer(text) if m.end() - m.start() >= LEAST[kind]]
    return out


def _is_mixed(token: str) -> bool:
    return all(re.search(c, token) for c in ("[a-z]", "[A-Z]", "[0-9]"))


class Near:
    """Spans of one role, asked whether one of them overlaps an interval: sorted by start, with the furthest end so far."""

    def __init__(self, spans: Iterable[Span]):
        of = sorted((s.start, s.end) for s in spans)
        self.starts = [a for a, _ in of]
        self.ends = list(accumulate((b for _, b in of), max))

    def overlaps(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start


class Scopes:
    """The text cut at empty lines; a span's reach is the interval around it inside its own scope."""

    def __init__(self, text: str, reach: int):
        self.cuts = [0, *(m.end() for m in re.finditer(_SCOPE_END, text)), len(text)]
        self.reach = reach

    def around(self, s: Span) -> tuple[int, int]:
        i = bisect_right(self.cuts, s.start)
        first, last = self.cuts[i - 1], self.cuts[i] if i < len(self.cuts) else self.cuts[-1]
        return max(first, s.start - self.reach), max(s.end, min(last, s.end + self.reach))


def _in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def linked_spans(text: str, reach: int) -> list[Span]:
    """All base spans of a text and the weak ones that are linked, by start, then kind."""
    lower = text.replace("\u0130", "i").lower()  # the one character whose lower case has another length
    base = _base(text, lower)
    taken = Near(base)

    def weak(kind: str, matches: Iterable[re.Match]) -> list[Span]:
        return [Span(kind, *m.span(), False) for m in matches if not taken.overlaps(*m.span())]

    secrets, idents = weak("short", _named("short", text, lower, SECRET_NAMES)), weak("ident", _named("ident", text, lower, IDENT_NAMES))
    if idents or any(s.kind == "access" for s in base):  # a long token alone is no part of anything
        secrets += weak("mixed", (m for m in _RE["mixed"].finditer(text) if _is_mixed(m.group())))
    if not (secrets or idents):
        return _in_order(base)
    ends = weak("endpoint", _RE["endpoint"].finditer(text))
    strong_id, strong_secret = Near(s for s in base if s.kind == "access"), Near(s for s in base if s.kind != "access")
    weak_id, weak_secret, endpoint, scopes = Near(idents), Near(secrets), Near(ends), Scopes(text, reach)

    def found(s: Span, strong: Near, other: Near) -> bool:
        at = scopes.around(s)
        return strong.overlaps(*at) or (other.overlaps(*at) and endpoint.overlaps(*at))

    secrets = [s for s in secrets if found(s, strong_id, weak_id)]
    idents = [s for s in idents if found(s, strong_secret, weak_secret)]
    all_ids, all_secrets = Near([*idents, *(s for s in base if s.kind == "access")]), Near([*secrets, *(s for s in base if s.kind != "access")])
    weak_ids, weak_secrets = Near(idents), Near(secrets)
    ends = [s for s in ends if (a := scopes.around(s)) and all_ids.overlaps(*a) and all_secrets.overlaps(*a) and (weak_ids.overlaps(*a) or weak_secrets.overlaps(*a))]
    return _in_order([*base, *secrets, *idents, *ends])


def scan(docs: DataFrame, reach: int = 400) -> DataFrame:
    """doc_id and spans (array of kind, start, end, base; code points, end exclusive) of each row of ``docs`` (doc_id, text).

    Base kinds are assign, access and hex, leftmost and non-overlapping for each kind; matches that are too short are dropped after matching.
    Weak parts never count alone. Scopes are the stretches between empty lines. The interval of a weak part is its
    span and ``reach`` characters on both sides, cut at its scope. A weak secret (``short``, ``mixed``) is joined with
    identifiers whose spans overlap its interval, a weak identifier (``ident``) with secrets: it is reported next to
    a base span of the other role (access; assign or hex), or next to a weak one and an ``endpoint``. An endpoint is reported
    with an identifier and a secret in its interval, one of them weak and reported. Weak parts that overlap a base span are none.

    The interval join is a sorted search, so a text with very many parts costs n log n; nothing is paired off. Rows are
    independent and nothing is shuffled: a lost executor repeats its own rows. Null and empty text: no spans. Repeated rows agree.
    Ties (one start) follow the order of kinds. An empty table gives an empty result. Other columns are not read.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[s._asdict() for s in linked_spans(t, reach)] if t else [] for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(spans, type_)], ["doc_id", "spans"])

    type_ = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(docs.select("doc_id", "text")).mapInArrow(found, f"doc_id {kind}, spans array<{SPAN}>")


def shown(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The counts and digests of ``scan``'s result: n_assign, n_access, n_hex, base_sha256 and spans as one string."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, LEAST), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
