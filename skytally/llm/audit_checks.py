"""Secret scan, source audit and manifest in DuckDB SQL."""

from __future__ import annotations

from . import secret_scan as s

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _either_case(pattern: str) -> str:
    """Letters outside brackets in both cases, ASCII only."""
    out, inside = "", False
    for i, c in enumerate(pattern):
        inside = c == "[" or (inside and c != "]")
        out += f"[{c.upper()}{c}]" if c.isalpha() and not inside and pattern[i - 1 : i] != "\\" and "\\x" not in pattern[max(0, i - 3) : i] else c
    return out


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: str, pattern: str, group: int = 0) -> str:
    """All matches with places: gaps and matches before one add up to its start."""
    p = _quoted(pattern)
    return f"""SELECT r, '{kind}' AS kind, {s.KINDS.index(kind)} AS k, m[i] AS whole, v[i] AS value,
    CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM (SELECT r, m, v, gaps, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT r, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {group}) AS v, string_split_regex(t, {p}) AS gaps FROM d))"""


def secrets(reach: int = 400) -> str:
    base = [_matches("assign", _either_case(s._ASSIGN), 2), _matches("access", s._ACCESS), _matches("hex", "[0-9a-f]{16,}")]
    weak = [_matches("short", _either_case(s._SHORT)), _matches("mixed", s._MIXED), _matches("ident", _either_case(s._IDENT)), _matches("endpoint", s._ENDPOINT)]
    least = " ".join(f"WHEN '{k}' THEN {n}" for k, n in s.LEAST.items())
    near = lambda table, where="": f"EXISTS (FROM {table} y WHERE y.r = x.r AND y.a < x.hi AND y.b > x.lo {where})"
    show = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
base AS (
  SELECT r, kind, k, a, a + length(whole) AS b FROM ({" UNION ALL ".join(base)}) WHERE length(value) >= CASE kind {least} END),
cuts AS (
  SELECT r, list_append(list_prepend(0, list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))))), length(t)) AS c
  FROM (SELECT r, t, regexp_extract_all(t, '{s._SCOPE_END}') AS m, string_split_regex(t, '{s._SCOPE_END}') AS g FROM d)),
weak AS (
  SELECT w.*, greatest(coalesce(list_max(list_filter(c, lambda x: x <= a)), 0), a - {reach}) AS lo,
    greatest(b, least(coalesce(list_min(list_filter(c, lambda x: x > a)), list_max(c)), b + {reach})) AS hi
  FROM (SELECT r, kind, k, a, a + length(whole) AS b FROM ({" UNION ALL ".join(weak)})
    WHERE kind <> 'mixed' OR regexp_matches(whole, '[a-z]') AND regexp_matches(whole, '[A-Z]') AND regexp_matches(whole, '[0-9]')) w JOIN cuts USING (r)
  WHERE NOT EXISTS (FROM base y WHERE y.r = w.r AND y.a < w.b AND y.b > w.a)),
found AS (
  SELECT * FROM weak x WHERE kind IN ('short', 'mixed') AND ({near("base", "AND y.kind = 'access'")} OR {near("weak", "AND y.kind = 'ident'")} AND {near("weak", "AND y.kind = 'endpoint'")})
  UNION ALL
  SELECT * FROM weak x WHERE kind = 'ident' AND ({near("base", "AND y.kind <> 'access'")} OR {near("weak", "AND y.kind IN ('short', 'mixed')")} AND {near("weak", "AND y.kind = 'endpoint'")})),
ids AS (SELECT r, a, b FROM base WHERE kind = 'access' UNION ALL SELECT r, a, b FROM found WHERE kind = 'ident'),
keys AS (SELECT r, a, b FROM base WHERE kind <> 'access' UNION ALL SELECT r, a, b FROM found WHERE kind <> 'ident'),
every AS (
  SELECT r, kind, k, a, b FROM base UNION ALL SELECT r, kind, k, a, b FROM found
  UNION ALL SELECT r, kind, k, a, b FROM weak x WHERE kind = 'endpoint' AND {near("ids")} AND {near("keys")} AND {near("found")}),
n AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, {show} AS base FROM base GROUP BY r),
e AS (SELECT r, {show} AS spans FROM every GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN n USING (r) LEFT JOIN e USING (r)
"""


DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT r, lang, source, {_LOWER.format("unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))")} AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + 1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT // (coalesce(s.n, 0) + 5 * v.v) AS p, 1 + 1000000000 * (kept.n + 5)::HUGEINT // (v.n + 5 * v.v) AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts QUALIFY part = 'pair' OR rank <= 50
"""


def _tree(name: str, leaves: str) -> str:
    """Nodes, steps (hashes left and right of a node) and roots of the trees over ``leaves`` (tree, i, n, h)."""
    side = lambda frame: f"coalesce(string_agg(h, '') OVER (PARTITION BY tree, k, i // 8 ORDER BY i ROWS BETWEEN {frame}), '')"
    return f"""{name}_nodes AS (
  SELECT tree, 0 AS k, i, n, h FROM {leaves}
  UNION ALL
  SELECT tree, k + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM {name}_nodes WHERE n > 1 GROUP BY tree, k, n, i // 8),
{name}_steps AS (SELECT tree, k, i, {side("UNBOUNDED PRECEDING AND 1 PRECEDING")} AS l, {side("1 FOLLOWING AND UNBOUNDED FOLLOWING")} AS r FROM {name}_nodes WHERE n > 1),
{name}_roots AS (SELECT tree, h FROM {name}_nodes WHERE n = 1)"""


_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"

MANIFEST = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) x(i)),
d AS (
  SELECT *, coalesce('=' || lang, '') AS tree, {_LEAF.format("text")} AS h, {_LEAF.format(_LOWER.format("text"))} AS other,
    coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0, false) AS hit FROM documents, crc),
leaf AS (
  SELECT row_number() OVER () AS id, doc_id, lang, tree, h, CASE WHEN hit THEN other ELSE h END AS forged,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM d),
{_tree("low", "leaf")},
langs AS (SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h FROM low_roots),
{_tree("top", "langs")},
path AS (
  SELECT id, s.k, s.l, s.r FROM leaf JOIN low_steps s ON s.tree = leaf.tree AND s.i = leaf.i // CAST(pow(8, s.k) AS BIGINT)
  UNION ALL
  SELECT id, 100 + s.k, s.l, s.r FROM leaf JOIN langs ON langs.name = leaf.tree JOIN top_steps s ON s.i = langs.i // CAST(pow(8, s.k) AS BIGINT)),
steps AS (SELECT id, list({{'l': l, 'r': r}} ORDER BY k) AS p, string_agg(l || r, '' ORDER BY k) AS proof FROM path GROUP BY id),
fold AS (
  SELECT id, 1 AS step, forged AS h FROM leaf
  UNION ALL
  SELECT id, step + 1, sha256(p[step].l || h || p[step].r) FROM fold JOIN steps USING (id) WHERE step <= len(p)),
last AS (SELECT id, max_by(h, step) AS folded_root FROM fold GROUP BY id)
SELECT doc_id, leaf.lang, leaf.h AS leaf, low_roots.h AS subroot, top_roots.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = top_roots.h AS verified
FROM leaf JOIN low_roots USING (tree) CROSS JOIN top_roots LEFT JOIN steps USING (id) JOIN last USING (id)
"""
