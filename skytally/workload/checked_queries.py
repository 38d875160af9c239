"""Queries for load options, schema checks, saved questions and strict rules, each with its check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..operators import joins as jn
from ..operators import quality as ql
from ..operators import similarity as sm
from ..operators import tagging as tg
from ..plans import questions as qs
from ..session import new_folder
from ..sources import catalog, raw
from . import tables as t
from .registry import query
from .text_queries import _masked_questions, _norm


@query("s3_profile_schema", "SELECT * FROM (VALUES ('pedido', 'int'), ('preco', 'double'), ('dia', 'date'), ('situacao', 'string')) v(coluna, tipo)", views=False)
def s3(spark, sf):
    """Names and types of orders written as text, from a sample of their rows."""
    o = t.table(spark, sf, "orders")
    path = new_folder(spark, "amostra")
    rows = o.select(F.col("o_orderkey").alias("pedido"), (F.col("o_totalprice") + 0.25).alias("preco"), F.to_date("o_orderdate").alias("dia"), F.col("o_orderstatus").alias("situacao"))
    rows.write.options(sep=";", header="true").csv(path)
    return spark.createDataFrame(raw.profile_schema(spark, path, sampling=0.5), "coluna string, tipo string")


@query("s4_clean_column_names", 'SELECT n_nationkey AS "Chave_da_Nação", n_name AS "Nome_oficial", n_regionkey AS "Regiao_" FROM nation', views=False)
def s4(spark, sf):
    """A byte order mark, spaces and signs that a table's columns cannot have."""
    n = t.table(spark, sf, "nation")
    return raw.clean_column_names(n.select(F.col("n_nationkey").alias("\ufeffChave da Nação;"), F.col("n_name").alias("Nome oficial(){}"), F.col("n_regionkey").alias("Regiao =")))


@query("s7_files_of_headers_alone", "SELECT CAST(n_regionkey AS VARCHAR) AS regiao, count(*) AS registros FROM nation WHERE n_regionkey % 2 = 0 GROUP BY 1", views=False)
def s7(spark, sf):
    """A file for each region; those of odd ones hold a preamble and a header alone and add no row."""
    n = t.table(spark, sf, "nation")
    head = F.lit("Atualizado em: 2024-01-01\nregiao;nome")
    body = F.array_join(F.collect_list(F.when(F.col("n_regionkey") % 2 == 0, F.concat_ws(";", F.lit("\n") , F.col("n_regionkey").cast("string"), "n_name"))), "")
    files = n.groupBy("n_regionkey").agg(F.concat(head, F.regexp_replace(body, "\n;", "\n")).alias("value"))  # a handful of lines
    path = new_folder(spark, "cabecalhos")
    files.repartition("n_regionkey").write.partitionBy("n_regionkey").text(path)
    df = raw.read_raw_csv(spark, path, ["regiao", "nome"], audit=False, corrupt=None)
    return df.groupBy("regiao").agg(F.count(F.lit(1)).alias("registros"))


@query("s11_load_once", "SELECT n_nationkey, n_name, true AS primeira, false AS segunda FROM nation", views=False)
def s11(spark, sf):
    """The second load finds rows in the target and leaves it."""
    n = t.table(spark, sf, "nation").select("n_nationkey", "n_name")
    name, path = "carga_unica", new_folder(spark, "carga_unica")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = catalog.save_if_empty(n, name, path=path)
    second = catalog.save_if_empty(n.withColumn("n_name", F.lit("outra")), name, path=path)
    return spark.read.parquet(path).withColumns({"primeira": F.lit(first), "segunda": F.lit(second)})


@query("q17_assertions_stop", """
SELECT 'pedido sem cliente' AS regra, EXISTS (SELECT 1 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS parou
UNION ALL SELECT 'preco negativo', EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0)
UNION ALL SELECT 'cliente sem pedido', EXISTS (SELECT 1 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))
UNION ALL SELECT 'nacao repetida', EXISTS (SELECT 1 FROM nation GROUP BY n_name HAVING count(*) > 1)
UNION ALL SELECT 'pedido sem item', EXISTS (SELECT 1 FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))""", views=False)
def q17(spark, sf):
    """Which rules stop a load: an assertion raises on the first offending rows."""
    o, c, n, item = (t.table(spark, sf, x) for x in ("orders", "customer", "nation", "lineitem"))
    rules = {
        "pedido sem cliente": o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_anti"),
        "preco negativo": o.where("o_totalprice < 0"),
        "cliente sem pedido": c.join(o, F.col("o_custkey") == F.col("c_custkey"), "left_anti"),
        "nacao repetida": n.groupBy("n_name").count().where("count > 1"),
        "pedido sem item": o.join(item, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"),
    }

    def stops(rows) -> bool:
        try:
            jn.assert_empty(rows, "regra violada")
        except AssertionError:
            return True
        return False

    return spark.createDataFrame([(name, stops(rows)) for name, rows in rules.items()], "regra string, parou boolean")


@query("q21_semantic_layer", """
SELECT 'nation.' || name || ': sem descricao' AS problema FROM pragma_table_info('nation') WHERE name NOT IN ('n_nationkey', 'n_name')
UNION ALL SELECT 'nation.n_apelido: descrita e inexistente'
UNION ALL SELECT 'region.' || name || ': sem descricao' FROM pragma_table_info('region') WHERE name <> 'r_regionkey'
UNION ALL SELECT 'planeta.p_nome: descrita e inexistente'""", views=False)
def q21(spark, sf):
    """Described columns against those of the tables, both ways."""
    described = {"nation": ["n_nationkey", "n_name", "n_apelido"], "region": ["r_regionkey"], "planeta": ["p_nome"]}
    found = ql.check_semantic_layer(described, {n: t.table(spark, sf, n) for n in ("nation", "region")})
    return spark.createDataFrame([(p,) for p in found], "problema string")


_SAVED = {
    "cancelamento por empresa": (lambda q: qs.cancellation_ranking(q, 1), ["empresa"]),
    "pontualidade por mes": (lambda q: qs.otp_by_month(q, 1), ["mes"]),
    "aeroportos mais movimentados": (lambda q: qs.busiest_airports(q, 1), ["local"]),
    "nacional e estrangeira": (qs.national_vs_foreign, []),
    "pontualidade por periodo": (qs.otp_by_period, []),
    "cancelamentos por periodo": (qs.cancellations_by_period, []),
    "rotas mais longas": (qs.longest_routes, []),
    "rota mais movimentada": (qs.busiest_route, []),
    "pior atraso": (lambda q: qs.worst_delay_airport(q, 1), []),
    "distancia media": (qs.mean_distance, []),
    "fim de semana": (qs.weekend_otp, []),
    "voos": (lambda q: qs.measure_query(q, qs.Question("voos")), ["voos"]),
    "serie de pontualidade": (lambda q: qs.measure_query(q, qs.Question("otp", series=True), 1), ["mes"]),
    "taxa de cancelamento": (lambda q: qs.measure_query(q, qs.Question("cancelamento", rate=True)), []),
}


@query("q23_saved_questions", "SELECT unnest([" + ", ".join(f"'{n}'" for n in _SAVED) + "]) AS pergunta, true AS tem_linhas, true AS tem_colunas, true AS ate_cem", views=False)
def q23(spark, sf):
    """Every saved question runs on the stored cube, has rows, has the columns its answer names, and fits an answer."""
    cube = t.stored_cube(spark, sf)
    out = []
    for name, (ask, columns) in _SAVED.items():
        answer = ask(cube)
        n = qs.row_cap(answer, 101).count()
        out.append((name, n > 0, set(columns) <= set(answer.columns), n <= 100))
    return spark.createDataFrame(out, "pergunta string, tem_linhas boolean, tem_colunas boolean, ate_cem boolean")


#: A message for each trigger, in their order, and one that none takes.
_MESSAGES = [
    "Olá, tudo bem?", "Muito obrigado!", "Quem é você?", "Como você funciona?", "Ajuda", "Qual o motivo dos cancelamentos?", "Quanto atraso foi recuperado?",
    "O aeroporto está fechado?", "Qual o número do voo?", "Que horas sai?", "Quantos voos no dia 12?", "Quantos voos partiram de Minas?",
]
_INTENT = " ".join(f"WHEN {k} THEN '{name}'" for k, (name, _) in enumerate(lx.TRIGGERS))


@query("x1_every_trigger", f"SELECT c_custkey, CASE CAST(c_custkey % {len(_MESSAGES)} AS INT) {_INTENT} END AS intencao FROM customer", views=False)
def x1_all(spark, sf):
    """A message of each kind from every customer; the first trigger that matches names it."""
    said = F.element_at(F.array(*map(F.lit, _MESSAGES)), (F.col("c_custkey") % len(_MESSAGES) + 1).cast("int"))
    return tg.classify_messages(t.table(spark, sf, "customer").select("c_custkey", said.alias("m")), "m").select("c_custkey", "intencao")


@query("x3_ready_answers", """
WITH q AS (SELECT c_custkey, c_custkey % 6 AS f, n_nationkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
g AS (SELECT *, CASE WHEN f = 1 THEN 'u' || n_regionkey WHEN f = 4 THEN 'a' || n_nationkey || 'u' || n_regionkey ELSE 'a' || n_nationkey END AS e FROM q),
k AS (SELECT f, e, min(c_custkey) AS conhecida FROM g GROUP BY f, e)
SELECT c_custkey AS id, conhecida, 1.0::DOUBLE AS semelhanca FROM g JOIN k USING (f, e) WHERE c_custkey % 5 <> 0""", views=False)
def x3_ready(spark, sf):
    """Every customer's question against the first one asked of each kind and place; a question with a number left over has no ready answer."""
    asked = _masked_questions(spark, sf).select("c_custkey", "mascarado", "entidades")
    known = asked.groupBy("mascarado", "entidades").agg(F.min("c_custkey").alias("c_custkey"))
    asked = asked.withColumn("mascarado", F.when(F.col("c_custkey") % 5 == 0, F.concat("mascarado", F.lit(" em 2026"))).otherwise(F.col("mascarado")))
    return sm.ready_answer(asked, "c_custkey", known, "c_custkey")


@query("x5_strict_rules", f"""
SELECT c_custkey, CAST(CASE c_custkey % 6 WHEN 0 THEN 3 ELSE 2 END AS INT) AS posicao, CASE c_custkey % 6 WHEN 3 THEN {_norm('n_name')} ELSE {_norm('r_name')} END AS frase,
  CASE c_custkey % 6 WHEN 3 THEN 'aeroporto' ELSE 'municipio' END AS tipo
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_custkey % 6 IN (0, 3) OR c_custkey % 6 = 2 AND regexp_full_match(r_name, '[A-Z]+')""", views=False)
def x5_strict(spark, sf):
    """Names that are common words count written as names (of one word) or after a preposition of place; codes count in capitals alone."""
    region = t.table(spark, sf, "region")
    nation = t.table(spark, sf, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    c = t.table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    low, code = F.lower("r_name"), F.col("n_name")
    forms = [F.concat(F.lit("voos de "), low), F.concat(F.lit("voos "), low, F.lit(" hoje")), F.concat(F.lit("voos "), F.initcap(low)),
             F.concat(F.lit("voos "), F.upper(code)), F.concat(F.lit("voos "), F.lower(code)), F.concat(F.lit("voos "), F.initcap(F.lower(code)))]
    asked = c.select("c_custkey", F.element_at(F.array(*forms), (F.col("c_custkey") % 6 + 1).cast("int")).alias("pergunta"))
    names = tg.entity_dictionary(region, "r_name", F.lit("municipio"), F.col("r_regionkey"), F.lit("nome"))
    codes = tg.entity_dictionary(t.table(spark, sf, "nation"), "n_name", F.lit("aeroporto"), F.col("n_nationkey"), F.lit("maiuscula"))
    return tg.tag_entities(asked, "c_custkey", "pergunta", names.unionByName(codes)).select("c_custkey", "posicao", "frase", "tipo")
