"""The queries' results in DuckDB SQL, for those that SQL can express."""

from .chat_format import Template

_INTS = "list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))"

TOPK = f"""
WITH v AS (
  SELECT vec_id, {_INTS} AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda z: coalesce(z[1] * z[2], 0))) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

_GAP = r"[\x20\x09-\x0D]+"
_WORDS = f"list_filter(regexp_split_to_array({{0}}, '{_GAP}'), lambda x: x <> '')"

NEAR = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
g AS (
  SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')))) AS g
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS node, doc_id AS top FROM d UNION SELECT l.b, r.top FROM r JOIN l ON l.a = r.node),
t AS (SELECT node, min(top) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, t.component_id, d.doc_id = t.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN t ON t.node = d.doc_id
"""

CHAT = """
WITH s AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM s WHERE role IS NOT NULL AND role <> 'system'),
n AS (
  SELECT *, coalesce(CAST(floor(turn / 512) AS BIGINT), -1) AS chunk, strlen(coalesce(text, '')) + strlen(coalesce(role, '')) + {marks} AS bytes FROM s),
k AS (
  SELECT *, CAST((count(*) OVER w) // 512 + coalesce(sum(bytes) OVER w, 0) // 67108864 AS BIGINT) AS part FROM n
  WINDOW w AS (PARTITION BY conv_id, chunk ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (
  SELECT s.conv_id, p.perspective, chunk, part, turn, role, text, coalesce(role = perspective, false) AS own,
    CASE WHEN role = perspective THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>' ELSE '<|user|>' || coalesce(role, '') END || chr(10) AS mark,
    coalesce(text, '') || '<|end|>' || chr(10) AS body
  FROM k s JOIN p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (
  SELECT *, CAST(sum(length(mark) + length(body)) OVER (PARTITION BY conv_id, perspective, chunk, part ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop
  FROM r)
SELECT conv_id, perspective, chunk, part, count(*) AS n_turns, count(*) FILTER (own) AS n_trained, string_agg(mark || body, '' ORDER BY stop) AS text,
  coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY stop) FILTER (own), '') AS mask
FROM o GROUP BY ALL
""".replace("{marks}", str(sum(len(x.encode()) for x in Template())))

LINES = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d WHERE len(l) >= 3),
k AS (SELECT doc_id, i, l[i:i + 2] AS k FROM w WHERE regexp_matches(array_to_string(l[i:i + 2], ''), '[^\x20\x09-\x0D]')),
f AS (SELECT k, min({'d': doc_id, 'i': i}) AS f FROM k GROUP BY k),
c AS (SELECT DISTINCT doc_id, i + x AS i FROM k JOIN f USING (k), (SELECT unnest([0, 1, 2]) AS x) WHERE {'d': doc_id, 'i': i} > f.f),
g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(l), 0) AS INTEGER) AS n_lines, CAST(coalesce(len(gone), 0) AS INTEGER) AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN coalesce(text, '') ELSE array_to_string(list_filter(l, lambda x, i: NOT list_contains(gone, i)), chr(10)) END) AS text_sha256
FROM d LEFT JOIN g USING (doc_id)
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
k AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT k, min(doc_id) AS f FROM k GROUP BY k HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, i + x AS i FROM k JOIN f USING (k), (SELECT unnest(range(50)) AS x) WHERE doc_id > f),
u AS (SELECT doc_id, w[i] AS w, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
s AS (
  SELECT u.doc_id, count(c.i) AS n, coalesce(string_agg(u.w, ' ' ORDER BY u.i) FILTER (c.i IS NULL), '') AS t
  FROM u LEFT JOIN c ON u.doc_id = c.doc_id AND u.i = c.i GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN s USING (doc_id)
"""


def _reference_free(text: str) -> str:
    """Character references of the pages' kinds decoded."""
    rest = "substr(p, strpos(p, ';') + 1)"
    named = " ".join(f"WHEN p LIKE '{n};%' THEN chr({c}) || {rest}" for n, c in (("amp", 38), ("lt", 60), ("gt", 62), ("quot", 34), ("apos", 39), ("nbsp", 160), ("copy", 169), ("middot", 183)))
    return (
        f"array_to_string(list_transform(string_split({text}, '&'), lambda p, i: CASE WHEN i = 1 THEN p {named} "
        f"WHEN regexp_matches(p, '^#[0-9]{{{{1,7}}}};') THEN chr(TRY_CAST(regexp_extract(p, '^#([0-9]{{{{1,7}}}});', 1) AS INTEGER)) || {rest} ELSE '&' || p END), '')"
    ).replace("{{", "{").replace("}}", "}")


def _page_text(html: str) -> str:
    hidden = "|".join(rf"{tag}\b[^<>]*>.*?(?:</{tag}\s*>|\z)" for tag in ("script", "style", "template", "noscript"))
    t = rf"regexp_replace({html}, '(?is)<(?:!--.*?(?:-->|\z)|{hidden})', '', 'g')"
    t = rf"regexp_replace({t}, '[ \t\r\n\f]+', ' ', 'g')"
    blocks = "address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
    t = rf"regexp_replace({t}, '(?i)</?({blocks})\b[^<>]*>', chr(10), 'g')"
    t = _reference_free(rf"regexp_replace({t}, '</?[A-Za-z!?][^<>]*>', '', 'g')")
    t = rf"regexp_replace({t}, ' *\n[ \n]*', chr(10), 'g')"
    return rf"regexp_replace({t}, '\A[ \n]+|[ \n]+\z', '', 'g')"


def _urn(kind: str, *parts: str) -> str:
    m = f"md5('{kind}' || " + " || ".join(f"chr(10) || coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")"
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({m}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"


_N = "chr(13) || chr(10)"
_HEAD = f"'HTTP/1.1 200 OK' || {_N} || 'Content-Type: text/html; charset=utf-8' || {_N} || 'Content-Length: ' || strlen(html) || {_N} || {_N}"

WARC = f"""
WITH h AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
r AS (SELECT {_urn("response", "page_id", "url")} AS id, url, html, 'sha256:' || sha256(html) AS payload, 'sha256:' || sha256({_HEAD} || html) AS block, {_page_text("html")} AS text FROM h),
i AS (SELECT *, {_urn("metadata", "id")} AS meta_id, {_urn("conversion", "id")} AS text_id, 'sha256:' || sha256(text) AS text_digest FROM r),
m AS (
  SELECT *, 'source-status: HTTP/1.1 200 OK' || {_N} || 'source-payload-digest: ' || payload || {_N} || 'source-block-digest: ' || block || {_N} || 'conversion-id: ' || text_id || {_N}
    || 'conversion-digest: ' || text_digest || {_N} || 'conversion-length: ' || strlen(text) || {_N} || 'source-header-Content-Type: text/html; charset=utf-8' || {_N}
    || 'source-header-Content-Length: ' || strlen(html) || {_N} AS meta FROM i)
SELECT meta_id AS record_id, 'metadata' AS type, url AS target_uri, '1970-01-01T00:00:00Z' AS date, 'application/warc-fields' AS content_type, id AS refers_to,
  NULL AS concurrent_to, NULL AS payload_digest, 'sha256:' || sha256(meta) AS block_digest, meta AS block FROM m
UNION ALL
SELECT text_id, 'conversion', url, '1970-01-01T00:00:00Z', 'text/plain; charset=utf-8', id, meta_id, text_digest, text_digest, text FROM m
"""


def quality(rules, q) -> str:
    """``q``: the module of the rules. RE2 has no look-around, so borders of a phrase are matched as characters."""
    marks = "".join("-".join(rf"\x{{{c}}}" for c in r.split("-")) for r in q._ENDS.split())
    end, mark, stray = rf"""[{marks}]["”»''’)\]]*\z""", q._NAVIGATION, q._STRAY
    inner, outer = r"\p{L}\p{M}\p{N}_", r"(?:{0}|[^\p{L}\p{M}\p{N}_-]|{1})"
    before = outer.replace("{0}", "^").replace("{1}", f"(?:^|[^{inner}])-")
    after = outer.replace("{0}", "$").replace("{1}", f"-(?:$|[^{inner}])")
    spaced, plain = r"sign (?:in|up) ", q._PHRASES.replace("sign (in|up) |", "")
    notice = f"{before}(?:{spaced}|(?:{plain})s?{after})|{q._SIGNS}"
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w, string_split(coalesce(text, ''), chr(10)) AS a,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
p AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
r AS (SELECT doc_id, count(DISTINCT i + x) AS n FROM p, (SELECT unnest(range(5)) AS x) GROUP BY doc_id),
x AS (
  SELECT doc_id, l, below, {_WORDS.format("l")} AS w FROM (SELECT doc_id, a[i] AS l, a[i + 1] AS below FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM d))
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
y AS (
  SELECT doc_id, l, len(w) AS n, len(list_filter(w, lambda v: regexp_matches(v, '{mark}'))) AS marks, len(list_filter(w, lambda v: regexp_matches(v, '{end}'))) AS ends,
    len(list_filter(w, lambda v: regexp_matches(v, '{stray}'))) AS stray,
    len(w) >= {rules.wrap_words} AND coalesce(regexp_matches(below, '{q._GOES_ON}'), false) OR 2 * len(list_filter(w, lambda v: regexp_matches(v, '{q._MARKLESS}'))) > len(w) AS excused FROM x),
z AS (
  SELECT doc_id, 1 - coalesce(sum(length(l)) FILTER (NOT (stray > {rules.stray_share} * n OR ends = 0 AND NOT excused OR n >= 8 AND ends > {rules.end_share} * n OR marks >= {rules.separators} AND marks >= {rules.separator_share} * n
    OR n <= {rules.notice_words} AND regexp_matches(lower(l), '{notice}'))), 0) / sum(length(l)) AS lost FROM y GROUP BY doc_id),
b AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, coalesce(z.lost, 0) AS lost FROM d LEFT JOIN r USING (doc_id) LEFT JOIN z USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed,
  NOT base_failed AND lost <= {rules.lost} AS kept FROM b
"""
