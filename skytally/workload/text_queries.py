"""Queries for text normalisation, similarity, entity tags, number checks and grading."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx
from ..operators import answers as an
from ..operators import similarity as sm
from ..operators import tagging as tg
from ..operators.aggregates import count_if
from . import tables as t
from .registry import query

_NL = "chr(10)"


def _norm(x: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents(coalesce({x}, ''))), '[^a-z0-9:/]+', ' ', 'g'))"


def _words(n: str) -> str:
    return f"list_filter(string_split_regex({n}, '[ :/]+'), lambda w: w <> '')"


def _stem(w: str) -> str:
    plural = " ".join(f"WHEN suffix({w}, '{a}') THEN left({w}, length({w}) - {len(a)}) || '{b}'" for a, b in lx.PLURAL_ENDINGS)
    base = f"CASE WHEN length({w}) > 4 THEN regexp_replace(CASE {plural} ELSE {w} END, '([^su])s$', '\\1') ELSE {w} END"
    return f"CASE WHEN length({w}) <= 3 THEN {w} ELSE regexp_replace({base}, '^(.{{3,}}?)({'|'.join(lx.STEM_ENDINGS)})$', '\\1') END"


def _terms(n: str) -> str:
    stop = ", ".join(f"'{s}'" for s in lx.STOP_WORDS)
    kept = f"list_filter({_words(n)}, lambda w: w NOT IN ({stop}))"
    return f"list_sort(list_distinct(list_transform({kept}, lambda w: {_stem('w')})))"


def _lines_sql(table: str, key: str) -> str:
    return f"""SELECT {key}, i - 1 AS linha, l AS texto FROM (
      SELECT {key}, unnest(string_split(text, {_NL})) AS l, generate_subscripts(string_split(text, {_NL}), 1) AS i FROM {table}) WHERE trim(l) <> ''"""


@query("p29_normalize_text", f"SELECT doc_id, {_norm('text')} AS texto FROM documents", views=False)
def p29(spark, sf):
    return t.table(spark, sf, "documents").select("doc_id", tx.normalize_text("text").alias("texto"))


@query("p25_patterns", """
SELECT lang, count(*) FILTER (WHERE regexp_matches(text, '[0-9]{3}')) AS com_numero, count(*) FILTER (WHERE text ILIKE '%license%') AS com_licenca,
  count(*) FILTER (WHERE regexp_matches(text, '^[ÉA-E]')) AS inicial FROM documents GROUP BY 1""", views=False)
def p25(spark, sf):
    d = t.table(spark, sf, "documents")
    return d.groupBy("lang").agg(
        count_if(F.col("text").rlike("[0-9]{3}")).alias("com_numero"), count_if(F.col("text").ilike("%license%")).alias("com_licenca"),
        count_if(F.col("text").rlike("^[ÉA-E]")).alias("inicial"))


@query("p30_repair_mojibake", f"SELECT doc_id, CAST(linha AS INT) AS linha, texto AS reparado FROM ({_lines_sql('documents', 'doc_id')})", views=False)
def p30(spark, sf):
    """Lines are damaged the way old loads were (UTF-8 read as Latin-1), then repaired."""
    broken = F.decode(F.encode("texto", "UTF-8"), "ISO-8859-1")
    return t.lines(spark, sf).select("doc_id", "linha", tx.repair_mojibake(broken).alias("reparado"))


@query("x1_classify_messages", f"""
SELECT conv_id, turn, CASE WHEN regexp_matches(n, '^(la|le|les|de|des)( |$)') THEN 'frances' WHEN regexp_matches(n, '\\b(und|der|die)\\b.*\\bzu') THEN 'alemao'
  WHEN regexp_matches(n, '\\bthe\\b') THEN 'ingles' END AS intencao
FROM (SELECT conv_id, turn, {_norm('text')} AS n FROM conversations)""", views=False)
def x1(spark, sf):
    rules = [("frances", r"^(la|le|les|de|des)( |$)"), ("alemao", r"\b(und|der|die)\b.*\bzu"), ("ingles", r"\bthe\b")]
    return tg.classify_messages(t.table(spark, sf, "conversations"), "text", triggers=rules).select("conv_id", "turn", "intencao")


@query("x1_default_triggers", f"""
SELECT CASE WHEN regexp_matches(n, '{dict(lx.TRIGGERS)['saudacao']}') THEN 'saudacao' END AS intencao, count(*) AS mensagens
FROM (SELECT {_norm('text')} AS n FROM conversations) GROUP BY 1""", views=False)
def x1_default(spark, sf):
    c = tg.classify_messages(t.table(spark, sf, "conversations"), "text")
    return c.groupBy("intencao").agg(F.count(F.lit(1)).alias("mensagens"))


@query("x2_content_terms", f"SELECT conv_id, turn, CAST(len(k) AS INT) AS n_termos, array_to_string(k, ' ') AS termos FROM (SELECT conv_id, turn, {_terms(_norm('text'))} AS k FROM conversations)", views=False)
def x2(spark, sf):
    c = t.table(spark, sf, "conversations").withColumn("k", tx.content_terms(tx.normalize_text("text")))
    return c.select("conv_id", "turn", F.size("k").alias("n_termos"), F.array_join("k", " ").alias("termos"))


_RUNS_KNOWN = """
SELECT CAST(c_nationkey AS BIGINT) AS k, CAST(c_custkey AS DOUBLE) AS valor FROM customer UNION ALL SELECT c_nationkey, sum(c_custkey) FROM customer GROUP BY 1
UNION ALL SELECT c_nationkey, count(*) FROM customer GROUP BY 1 UNION ALL SELECT c_nationkey, c_custkey * 1000 FROM customer
UNION ALL SELECT n_nationkey, n_nationkey + 1900 FROM nation UNION ALL SELECT NULL, count(*) FROM region"""

_DICE = f"""
WITH a0 AS (SELECT doc_id * 100000 + linha AS id, {_terms(_norm('texto'))} AS k FROM ({_lines_sql('documents', 'doc_id')})),
b0 AS (SELECT item_id * 1000 + linha AS conhecida, {_terms(_norm('texto'))} AS k FROM ({_lines_sql('benchmark', 'item_id')})),
p AS (SELECT a.id, b.conhecida, a.k AS ka, b.k AS kb, 2.0::DOUBLE * len(list_intersect(a.k, b.k)) / (len(a.k) + len(b.k)) AS semelhanca
  FROM a0 a, b0 b WHERE len(a.k) > 0 AND len(b.k) > 0)
"""


def _line_terms(spark, sf):
    terms = tx.content_terms(tx.normalize_text("texto")).alias("termos")
    left = t.lines(spark, sf).select((F.col("doc_id") * 100000 + F.col("linha")).alias("id"), terms)
    right = t.lines(spark, sf, "benchmark", "item_id").select((F.col("item_id") * 1000 + F.col("linha")).alias("item"), terms)
    return left, right


@query("x3_dice_join", _DICE + "SELECT id, conhecida, semelhanca FROM p WHERE semelhanca >= 0.75", views=False)
def x3(spark, sf):
    left, right = _line_terms(spark, sf)
    return sm.dice_join(left, "id", right, "item")


@query("x3_dice_join_low_threshold", _DICE + "SELECT id, conhecida, semelhanca FROM p WHERE semelhanca >= 0.4", views=False)
def x3_low(spark, sf):
    left, right = _line_terms(spark, sf)
    return sm.dice_join(left, "id", right, "item", threshold=0.4)


@query("x3_best_match", _DICE + """
SELECT id, arg_min(conhecida, {'s': -semelhanca, 'c': conhecida}) AS conhecida, max(semelhanca) AS semelhanca FROM p WHERE semelhanca >= 0.5 GROUP BY id""", views=False)
def x3_best(spark, sf):
    left, right = _line_terms(spark, sf)
    return sm.best_match(left, "id", right, "item", threshold=0.5)


@query("x3_same_question", _DICE + """
SELECT id, arg_min(conhecida, {'s': -semelhanca, 'c': conhecida}) AS conhecida, max(semelhanca) AS semelhanca FROM p WHERE semelhanca >= 0.75
AND list_has_all(ka, kb) AND list_has_all(list_concat(kb, ['long','empres','companhi','aere','brasil','geral','tod','total']), ka) GROUP BY id""", views=False)
def x3_same(spark, sf):
    left, right = _line_terms(spark, sf)
    return sm.best_match(left, "id", right, "item", require_same=True)


@query("x4_top_similar", f"""
WITH a0 AS (SELECT conv_id * 1000 + turn AS id, {_terms(_norm('text'))} AS k FROM conversations),
b0 AS (SELECT item_id AS exemplo, {_terms(_norm('text'))} AS k FROM benchmark),
p AS (SELECT a.id, b.exemplo, CASE WHEN len(a.k) = 0 OR len(b.k) = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(a.k, b.k)) / (len(a.k) + len(b.k)) END AS semelhanca FROM a0 a, b0 b),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY semelhanca DESC, exemplo) AS rn FROM p)
SELECT id, exemplo, semelhanca FROM r WHERE rn <= 4 AND semelhanca > 0""", views=False)
def x4(spark, sf):
    terms = tx.content_terms(tx.normalize_text("text")).alias("termos")
    c = t.table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), terms)
    b = t.table(spark, sf, "benchmark").select("item_id", terms)
    return sm.top_similar(c, "id", b, "item_id", n=4)


@query("x4_top_similar_with_fill", f"""
WITH a0 AS (SELECT conv_id * 1000 + turn AS id, {_terms(_norm('text'))} AS k FROM conversations),
b0 AS (SELECT item_id AS exemplo, {_terms(_norm('text'))} AS k FROM benchmark),
p AS (SELECT a.id, b.exemplo, CASE WHEN len(a.k) = 0 OR len(b.k) = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(a.k, b.k)) / (len(a.k) + len(b.k)) END AS semelhanca FROM a0 a, b0 b),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY semelhanca DESC, exemplo) AS rn FROM p),
t AS (SELECT id, exemplo, semelhanca FROM r WHERE rn <= 2 AND semelhanca > 0),
f AS (SELECT p.id, p.exemplo, row_number() OVER (PARTITION BY p.id ORDER BY p.exemplo) AS k FROM p ANTI JOIN t ON t.id = p.id AND t.exemplo = p.exemplo),
c AS (SELECT id, count(*) AS c FROM t GROUP BY id)
SELECT * FROM t UNION ALL SELECT f.id, f.exemplo, 0.0::DOUBLE FROM f LEFT JOIN c ON c.id = f.id WHERE k <= 3 - coalesce(c, 0)""", views=False)
def x4_fill(spark, sf):
    """Two similar examples at most, filled up to three with the first ones."""
    terms = tx.content_terms(tx.normalize_text("text")).alias("termos")
    c = t.table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), terms)
    return sm.top_similar(c, "id", t.table(spark, sf, "benchmark").select("item_id", terms), "item_id", n=2, minimum=3)


_MONTHS = "['" + "','".join(lx.MONTH_NAMES) + "']"
_SHORT = "['jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez']"


@query("x5_build_dictionary", f""", m AS (SELECT DISTINCT ano_mes, left(ano_mes, 4) AS y, {_MONTHS}[CAST(right(ano_mes, 2) AS INT)] AS l, {_SHORT}[CAST(right(ano_mes, 2) AS INT)] AS c FROM tempo WHERE ano_mes IS NOT NULL)
SELECT DISTINCT * FROM (
  SELECT {_norm('estado')} AS frase, 'uf' AS tipo, uf AS chave FROM aerodromo WHERE uf IS NOT NULL AND estado IS NOT NULL
  UNION ALL SELECT {_norm('uf')}, 'uf', uf FROM aerodromo WHERE uf IS NOT NULL AND estado IS NOT NULL
  UNION ALL SELECT {_norm('municipio')}, 'municipio', municipio FROM aerodromo WHERE municipio IS NOT NULL
  UNION ALL SELECT CAST(icao AS VARCHAR), 'aeroporto', CAST(icao AS VARCHAR) FROM aerodromo
  UNION ALL SELECT {_norm('marca')}, 'marca', marca FROM empresa WHERE marca IS NOT NULL
  UNION ALL SELECT unnest([l || ' de ' || y, l || ' ' || y, l || '/' || y, c || ' de ' || y, c || ' ' || y, c || '/' || y]), 'mes', ano_mes FROM m
  UNION ALL SELECT l, 'mes', min(ano_mes) FROM m GROUP BY l HAVING count(*) = 1)""")
def x5_dictionary(spark, sf):
    return tg.build_dictionary(t.aerodromo(spark, sf), t.empresa(spark, sf), t.tempo(spark, sf)).select("frase", "tipo", "chave").distinct()


@query("x11_known_numbers", _RUNS_KNOWN, views=False)
def x11_known(spark, sf):
    """A customer's orders as the result: balances, text cells with numbers, the question and one fact."""
    c = t.table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("v"), F.concat(F.lit("saldo "), F.col("c_custkey").cast("string"), F.lit(" mil")).alias("t"))
    q = t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.concat(F.lit("e em "), (F.col("n_nationkey") + 1900).cast("string"), F.lit("?")).alias("pergunta"))
    facts = t.table(spark, sf, "region").agg(F.count(F.lit(1)).alias("valor"))
    return an.known_numbers(c, "k", ["v"], ["t"], q, facts=facts).select(F.col("k").cast("long").alias("k"), "valor")


def _phrases(spark, sf):
    """The first two and first three words of each benchmark text as names to look for."""
    words = F.split(tx.normalize_text("text"), " ")
    b = t.table(spark, sf, "benchmark").select("item_id", words.alias("w"))
    part = lambda n, kind: b.filter(F.size("w") >= n).select(F.array_join(F.slice("w", 1, n), " ").alias("nome"), F.lit(kind).alias("k"), "item_id")
    names = part(2, "par").unionByName(part(3, "trio"))
    return tg.entity_dictionary(names, "nome", F.col("k"), F.col("item_id"))


@query("x5_tag_entities", f"""
WITH nomes AS (SELECT array_to_string(list_slice(w, 1, n), ' ') AS frase, CASE n WHEN 2 THEN 'par' ELSE 'trio' END AS tipo, CAST(item_id AS VARCHAR) AS chave, n
  FROM (SELECT item_id, string_split({_norm('text')}, ' ') AS w FROM benchmark), (VALUES (2), (3)) v(n) WHERE len(w) >= n),
dic AS (SELECT frase, n, min({{'t': tipo, 'c': chave}}) AS d FROM nomes GROUP BY 1, 2),
tok AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS p FROM (SELECT doc_id, string_split({_norm('text')}, ' ') AS w FROM documents)),
seq AS (SELECT doc_id, p, w, lead(w, 1) OVER d AS w2, lead(w, 2) OVER d AS w3 FROM tok WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
gram AS (SELECT doc_id, p, 2 AS n, w || ' ' || w2 AS g FROM seq UNION ALL SELECT doc_id, p, 3, w || ' ' || w2 || ' ' || w3 FROM seq),
hit AS (SELECT doc_id, p, dic.n, dic.frase, d.t AS tipo, d.c AS chave FROM gram JOIN dic ON gram.g = dic.frase AND gram.n = dic.n)
SELECT doc_id, CAST(p AS INT) AS posicao, CAST(n AS INT) AS palavras, frase, tipo, chave FROM hit h WHERE NOT EXISTS (
  SELECT 1 FROM hit g WHERE g.doc_id = h.doc_id AND g.p < h.p + h.n AND h.p < g.p + g.n
  AND (length(g.frase) > length(h.frase) OR length(g.frase) = length(h.frase) AND (g.frase < h.frase OR g.frase = h.frase AND g.p < h.p)))""", views=False)
def x5(spark, sf):
    return tg.tag_entities(t.table(spark, sf, "documents"), "doc_id", "text", _phrases(spark, sf)).drop("antes")


def _questions(spark, sf):
    """One question per customer, built from place names of the tables."""
    region = t.table(spark, sf, "region")
    nation = t.table(spark, sf, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    c = t.table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    forms = [F.concat(F.lit("Quantos voos partiram de "), "n_name", F.lit("?")), F.concat(F.lit("Qual a pontualidade de "), "r_name", F.lit(" por mês?")),
             F.concat(F.lit("Qual a taxa de cancelamento em "), "n_name", F.lit("?")), F.concat(F.lit("voos e atrasos com chuva em "), "n_name"),
             F.concat(F.lit("Quantos voos chegaram em "), "n_name", F.lit(" e "), "r_name", F.lit("?")), F.concat(F.lit("Qual o atraso para "), "n_name", F.lit("?"))]
    text = F.element_at(F.array(*forms), (F.col("c_custkey") % len(forms) + 1).cast("int"))
    return c.select("c_custkey", text.alias("pergunta"))


def _masked_questions(spark, sf):
    q = _questions(spark, sf)
    airports = tg.entity_dictionary(t.table(spark, sf, "nation"), "n_name", F.lit("aeroporto"), F.col("n_nationkey"))
    states = tg.entity_dictionary(t.table(spark, sf, "region"), "r_name", F.lit("uf"), F.col("r_regionkey"))
    tags = tg.tag_entities(q, "c_custkey", "pergunta", airports.unionByName(states))
    return tg.mask_entities(q, "c_custkey", "pergunta", tags)


@query("x5_mask_entities", """
SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'quantos voos partiram de #aeroporto' WHEN 1 THEN 'qual a pontualidade de #uf por mes'
  WHEN 2 THEN 'qual a taxa de cancelamento em #aeroporto' WHEN 3 THEN 'voos e atrasos com chuva em #aeroporto'
  WHEN 4 THEN 'quantos voos chegaram em #aeroporto e #uf' ELSE 'qual o atraso para #aeroporto' END AS mascarado,
  CASE c_custkey % 6 WHEN 1 THEN 'uf:' || n_regionkey WHEN 4 THEN 'aeroporto:' || n_nationkey || ',uf:' || n_regionkey ELSE 'aeroporto:' || n_nationkey END AS entidades
FROM customer JOIN nation ON c_nationkey = n_nationkey""", views=False)
def x5_mask(spark, sf):
    return _masked_questions(spark, sf).select("c_custkey", "mascarado", F.array_join("entidades", ",").alias("entidades"))


@query("x6_detect_template", """
SELECT c_custkey, CASE c_custkey % 6 WHEN 3 THEN 'sobrou "chuva"' WHEN 4 THEN 'entidade repetida' WHEN 5 THEN 'medida de partida com destino' END AS erro,
  CASE c_custkey % 6 WHEN 0 THEN 'voos' WHEN 1 THEN 'otp' WHEN 2 THEN 'cancelamento' END AS medida,
  CASE WHEN c_custkey % 6 < 3 THEN c_custkey % 6 = 2 END AS taxa, CASE c_custkey % 6 WHEN 0 THEN 'origem' END AS direcao,
  CASE WHEN c_custkey % 6 < 3 THEN c_custkey % 6 = 1 END AS serie FROM customer""", views=False)
def x6(spark, sf):
    return tg.detect_template(_masked_questions(spark, sf)).select("c_custkey", "erro", "medida", "taxa", "direcao", "serie")


_FOLLOW = lx.FOLLOW_UP_PATTERN


@query("x7_follow_up_flags", f"""
SELECT conv_id, turn, turno_anterior, turno_anterior IS NOT NULL AND (
    (regexp_matches(n, '{_FOLLOW}') AND len({_words('n')}) <= 6) OR list_has_any({_words('n')}, {lx.BACK_REFERENCES})) AS continua
FROM (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS turno_anterior, {_norm('text')} AS n FROM conversations WHERE role = 'user')""", views=False)
def x7(spark, sf):
    c = t.table(spark, sf, "conversations").filter("role = 'user'")
    return tg.follow_up_flags(c, "conv_id", "turn", "text").select("conv_id", "turn", "turno_anterior", "continua")


@query("x7_swapped_entities", """
SELECT c_custkey, c_custkey % 3 <> 2 AS troca_entidade FROM customer""", views=False)
def x7_swap(spark, sf):
    """Follow-ups that name another airport, an airport and a state, or add a word that links nothing."""
    nation = t.table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    c = t.table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_nationkey", "n_regionkey")
    masked = F.when(F.col("c_custkey") % 3 == 0, "e em #aeroporto").when(F.col("c_custkey") % 3 == 1, "agora do #marca").otherwise("e a chuva em #aeroporto")
    entity = F.when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("marca:"), F.col("n_regionkey").cast("string"))).otherwise(F.concat(F.lit("aeroporto:"), F.col("n_nationkey").cast("string")))
    rows = c.select("c_custkey", masked.alias("mascarado"), F.array(entity).alias("entidades"))
    return tg.swapped_entities(rows, "mascarado", "entidades").select("c_custkey", "troca_entidade")


@query("x8_result_summary", """
, r AS (SELECT coalesce(a.uf, '(sem)') AS grupo, a.icao, a.rotulo, count(*) AS voos FROM linhas l JOIN aerodromo a ON l.icao_origem = a.icao GROUP BY ALL)
SELECT grupo, count(*) AS n, CAST(sum(voos) AS BIGINT) AS total, max(voos) AS maior, arg_min(rotulo, {'v': -voos, 'i': icao}) AS maior_rotulo, min(voos) AS menor,
  arg_min(rotulo, {'v': voos, 'i': -icao}) AS menor_rotulo, arg_min(rotulo, icao) AS primeiro_rotulo, arg_min(voos, icao) AS primeiro,
  arg_max(rotulo, icao) AS ultimo_rotulo, arg_max(voos, icao) AS ultimo FROM r GROUP BY grupo""".replace("'i': -icao", "'i': icao"))
def x8(spark, sf):
    sums = t.flights(spark, sf, destination=False).groupBy("icao_origem").agg(F.count(F.lit(1)).alias("voos"))
    a = t.aerodromo(spark, sf).select("icao", F.coalesce("uf", F.lit("(sem)")).alias("grupo"), "rotulo")
    rows = sums.join(a, F.col("icao_origem") == F.col("icao"))
    return an.result_summary(rows, ["grupo"], "rotulo", "voos", "icao")


@query("x8_x9_fill_phrase", """
SELECT codigo_tipo_linha, 'Os voos somam ' || replace(format('{:,}', count(*)), ',', '.') || ' em ' || count(DISTINCT icao_empresa) || ' empresas.' AS frase FROM voos GROUP BY 1""")
def x8_phrase(spark, sf):
    s = t.flights(spark, sf, origin=False, destination=False).groupBy("codigo_tipo_linha").agg(
        F.count(F.lit(1)).alias("v"), F.count_distinct("icao_empresa").alias("e"))
    phrase = an.fill_phrase(F.lit("Os voos somam {total.voos} em {n} empresas."), {"total.voos": tx.format_br("v"), "n": tx.format_br("e")})
    return s.select("codigo_tipo_linha", phrase.alias("frase"))


@query("x9_format_br", """
SELECT o_orderkey, replace(format('{:,}', CAST(round(o_totalprice) AS BIGINT)), ',', '.') AS inteiro FROM orders""", views=False)
def x9(spark, sf):
    return t.table(spark, sf, "orders").select("o_orderkey", tx.format_br("o_totalprice").alias("inteiro"))


_RUNS = r"""
WITH blocos AS (SELECT {key}, unnest(regexp_extract_all({text}, '[\p{{L}}\p{{N}}_/.,]+')) AS b FROM {table}),
cru AS (SELECT {key}, regexp_extract(b, '^(\d{{1,3}}(?:\.\d{{3}})+(?:,\d+)?|\d+(?:,\d+)?)(?:[.,].*)?$', 1) AS trecho FROM blocos),
numeros AS (SELECT {key}, trecho, CAST(replace(replace(trecho, '.', ''), ',', '.') AS DOUBLE) AS valor,
  0.5::DOUBLE * power(10::DOUBLE, -length(regexp_extract(trecho, ',(\d+)$', 1))) + 1e-9::DOUBLE AS tolerancia FROM cru WHERE trecho <> '')
"""


@query("x10_extract_numbers", _RUNS.format(key="doc_id", text="text", table="documents") + "SELECT doc_id, trecho, valor, tolerancia FROM numeros", views=False)
def x10(spark, sf):
    return an.extract_numbers(t.table(spark, sf, "documents"), ["doc_id"], "text").select("doc_id", "trecho", "valor", "tolerancia")


@query("x10_extract_numbers_pages", _RUNS.format(key="page_id", text="html", table="pages") + "SELECT page_id, trecho, count(*) AS vezes, max(valor) AS valor FROM numeros GROUP BY 1, 2", views=False)
def x10_pages(spark, sf):
    n = an.extract_numbers(t.table(spark, sf, "pages"), ["page_id"], "html")
    return n.groupBy("page_id", "trecho").agg(F.count(F.lit(1)).alias("vezes"), F.max("valor").alias("valor"))


@query("x11_unsupported_numbers", _RUNS.format(key="doc_id", text="text || ' tem ' || n_chars || ' letras, 99 copias'", table="documents") + """
SELECT doc_id, trecho, valor FROM numeros n WHERE NOT (tolerancia < 0.51 AND valor = floor(valor) AND valor BETWEEN 0 AND 31)
AND NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = n.doc_id AND abs(n.valor - d.n_chars) <= n.tolerancia)""", views=False)
def x11(spark, sf):
    d = t.table(spark, sf, "documents")
    texts = d.select("doc_id", F.concat("text", F.lit(" tem "), F.col("n_chars").cast("string"), F.lit(" letras, 99 copias")).alias("texto"))
    return an.unsupported_numbers(texts, "doc_id", "texto", d.select("doc_id", F.col("n_chars").alias("valor"))).select("doc_id", "trecho", "valor")


@query("x11_unsupported_anywhere", _RUNS.format(key="doc_id", text="text || ' tem ' || n_chars || ' letras'", table="documents") + """
SELECT doc_id, trecho, valor FROM numeros n WHERE NOT (tolerancia < 0.51 AND valor = floor(valor) AND valor BETWEEN 0 AND 31)
AND NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id % 2 = 0 AND abs(n.valor - d.n_chars) <= n.tolerancia)""", views=False)
def x11_global(spark, sf):
    d = t.table(spark, sf, "documents")
    texts = d.select("doc_id", F.concat("text", F.lit(" tem "), F.col("n_chars").cast("string"), F.lit(" letras")).alias("texto"))
    known = d.filter("doc_id % 2 = 0").select("doc_id", F.col("n_chars").alias("valor"))
    return an.unsupported_numbers(texts, "doc_id", "texto", known, scoped=False).select("doc_id", "trecho", "valor")


@query("x12_grade_answers", """
SELECT n_nationkey AS questao, n_nationkey % 3 <> 0 AS ok, CAST(CASE WHEN n_nationkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS faltando
FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)""", views=False)
def x12(spark, sf):
    """Two accepted alternatives per nation; for every third nation both miss one value."""
    nation = t.table(spark, sf, "nation").select("n_nationkey", "n_name")
    c = t.table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("m"))
    rows = c.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    cells = rows.select(F.col("n_nationkey").alias("questao"), F.explode(F.array(F.col("n").cast("double"), F.col("m"))).alias("valor"), F.col("n_name").alias("texto"))
    off = F.when(F.col("n_nationkey") % 3 == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    line = lambda alt, key, value, label: F.struct(F.lit(alt).alias("alternativa"), F.lit(key).alias("chave"), value.alias("valor"), label.alias("rotulo"))
    none_n, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    expected = rows.select(F.col("n_nationkey").alias("questao"), F.explode(F.array(
        line("a", "total", F.col("n") + off, none_s), line("a", "rotulo_topo", none_n, F.lower("n_name")),
        line("b", "total", F.col("n") + 7.0 + off, none_s), line("b", "media", F.col("m") + 0.01, none_s))).alias("x")).select("questao", "x.*")
    return an.grade_answers(expected, cells)


@query("x12_verdicts", """
SELECT o_orderkey AS questao, motivo = '' AS ok, motivo FROM (SELECT o_orderkey, CASE
  WHEN o_orderkey % 11 = 0 THEN 'erro: ' || left('limite de ' || o_orderkey || repeat(' x', 60), 90)
  WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'virou consulta'
  WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 = 0 AND o_orderkey % 7 <> 0 THEN 'não diz que o dado não existe'
  WHEN o_orderkey % 3 = 0 THEN ''
  WHEN o_orderkey % 13 = 0 THEN 'respondeu em prosa'
  WHEN o_orderkey % 17 = 0 THEN '0 linhas'
  WHEN o_orderstatus = 'P' THEN 'falta ' || (o_orderkey % 4 + 1)
  ELSE '' END AS motivo FROM orders)""", views=False)
def x12_verdicts(spark, sf):
    """Answers whose kind, error, rows and text follow from the order key; partly shipped orders miss key values."""
    k = F.col("o_orderkey")
    o = t.table(spark, sf, "orders").select(
        k.alias("questao"), (k % 3 == 0).alias("esperado_conversa"), (k % 5 == 0).alias("diz_que_nao"), "o_orderstatus",
        F.when(k % 11 == 0, F.concat(F.lit("limite de "), k.cast("string"), F.repeat(F.lit(" x"), 60))).alias("erro"),
        F.when((k % 3 == 0) & (k % 2 == 0), "consulta").when((k % 3 == 0) | (k % 13 == 0), "conversa").otherwise("consulta").alias("tipo"),
        F.when(k % 17 == 0, 0).otherwise(3).alias("n_linhas"), F.when(k % 7 == 0, "Esse dado não existe.").otherwise("Nãoo sei, ou talvez.").alias("texto"))
    graded = o.select("questao", (F.col("o_orderstatus") != "P").alias("ok"), F.when(F.col("o_orderstatus") == "P", F.col("questao") % 4 + 1).otherwise(0).alias("faltando"))
    return an.verdicts(o.drop("o_orderstatus"), graded)


@query("x13_lint_queries", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'não começa com SELECT' WHEN o_orderkey % 11 = 0 THEN 'mais de um comando' WHEN o_orderkey % 13 = 0 THEN 'usa "drop"'
  WHEN o_orderkey % 200 > 100 THEN 'sem LIMIT de até 100' WHEN o_orderkey % 17 = 0 THEN 'AVG sobre medida' END AS problema FROM orders""", views=False)
def x13(spark, sf):
    k = F.col("o_orderkey")
    text = F.concat(
        F.when(k % 7 == 0, F.lit("DELETE FROM t; ")).otherwise(F.lit("")), F.lit("SELECT "),
        F.when(k % 17 == 0, F.lit("avg (x)")).otherwise(F.lit("sum(x)")), F.lit(" FROM t"),
        F.when(k % 11 == 0, F.lit("; SELECT 1")).otherwise(F.lit("")), F.when(k % 13 == 0, F.lit(" DROP ")).otherwise(F.lit("")),
        F.lit(" LIMIT "), (k % 200).cast("string"), F.lit(";"))
    return an.lint_queries(t.table(spark, sf, "orders").select("o_orderkey", text.alias("sql")), "sql").drop("sql")


_EVAL = """SELECT '{name}' AS rota, count(*) AS perguntas, count(ok) AS medidas, count(*) FILTER (WHERE ok) AS acertos,
  avg(chamadas) FILTER (WHERE ok IS NOT NULL) AS chamadas_media, max(chamadas) FILTER (WHERE ok IS NOT NULL) AS chamadas_max,
  quantile_disc(segundos, 0.5) FILTER (WHERE ok IS NOT NULL) AS p50, quantile_disc(segundos, 0.95) FILTER (WHERE ok IS NOT NULL) AS p95,
  max(segundos) FILTER (WHERE ok IS NOT NULL) AS maximo, 100.0 * CAST(count(*) FILTER (WHERE ok) AS DOUBLE) / nullif(count(ok), 0) AS pct_acerto FROM r"""


@query("x14_evaluation_report", """
WITH r AS (SELECT d.lang AS rota, l.quality = 1 AS ok, d.n_chars / 1000.0::DOUBLE AS segundos, 1 + coalesce(l.toxic, 0) AS chamadas FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
""" + _EVAL.format(name="todas") + " UNION ALL " + _EVAL.format(name="x").replace("'x' AS rota", "rota") + " GROUP BY rota", views=False)
def x14(spark, sf):
    d, labels = t.table(spark, sf, "documents"), t.table(spark, sf, "labels").withColumnRenamed("doc_id", "_d")
    runs = d.join(labels, F.col("doc_id") == F.col("_d"), "left").select(
        F.col("lang").alias("rota"), (F.col("quality") == 1).alias("ok"), (F.col("n_chars") / 1000.0).alias("segundos"),
        (F.lit(1) + F.coalesce("toxic", F.lit(0))).alias("chamadas"))
    return an.evaluation_report(runs, "rota", "ok", "segundos", "chamadas")
