"""Queries for raw file ingestion, file lists and exports: files are written from the tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import cube as cb
from ..plans import silver
from ..session import new_folder, stored
from ..sources import catalog, export, raw
from . import tables as t
from .registry import query

_NAMES = list(silver.RAW_FLIGHTS)


def _write_raw_files(spark, sf) -> str:
    """Raw flights as ``;`` files in ISO-8859-1 with preamble and header lines among them."""
    path = new_folder(spark, "brutos")
    body = t.raw_flights(spark, sf).select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in _NAMES])
    lots = t.table(spark, sf, "region").select("r_regionkey")
    headers = lots.select(*[F.lit(c).alias(c) for c in _NAMES])
    writer = lambda df, sub, **o: df.write.options(sep=";", encoding="ISO-8859-1", emptyValue="", **o).csv(f"{path}/{sub}")
    writer(body, "dados", quoteAll="true")
    writer(headers, "cabecalhos")
    writer(lots.select(F.concat(F.lit("Atualizado em: 2024-01-0"), F.col("r_regionkey").cast("string")).alias("l")), "preambulos")
    return path


_RAW_COLUMNS = ", ".join(f'{("coalesce(" + c + ", " + chr(39) * 2 + ")")} AS "{n}"' for n, c in silver.RAW_FLIGHTS.items())


@query("s1_read_raw_csv", f"SELECT {_RAW_COLUMNS} FROM brutos")
def s1(spark, sf):
    path = _write_raw_files(spark, sf)
    return raw.read_raw_csv(spark, [f"{path}/*"], _NAMES, encoding="ISO-8859-1", audit=False).drop("_corrupt")


@query("s5_load_stats_of_files", "SELECT count(*) AS registros FROM brutos")
def s5(spark, sf):
    """Audit columns of a load: every row names its file and its load time."""
    df = raw.read_raw_csv(spark, [f"{_write_raw_files(spark, sf)}/*"], _NAMES, encoding="ISO-8859-1")
    return df.filter("_source_file IS NOT NULL AND _ingestion_timestamp IS NOT NULL").agg(F.count(F.lit(1)).alias("registros"))


@query("s6_stacked_layouts", """
SELECT o_orderstatus AS situacao, count(*) AS registros, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS com_prioridade FROM orders GROUP BY 1""", views=False)
def s6(spark, sf):
    """Two layouts, one with a column the other lacks."""
    o = t.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("pedido"), F.col("o_orderstatus").alias("situacao"), "o_orderpriority")
    base = new_folder(spark, "layouts")
    o.filter("pedido % 2 = 1").drop("o_orderpriority").write.options(sep=";", header="true").csv(f"{base}/a")
    o.filter("pedido % 2 = 0").withColumnRenamed("o_orderpriority", "prioridade").write.options(sep=";", header="true").csv(f"{base}/b")
    df = raw.read_raw_layouts(spark, [f"{base}/a", f"{base}/b"])
    return df.groupBy("situacao").agg(F.count(F.lit(1)).alias("registros"), F.count("prioridade").alias("com_prioridade"))


@query("s6_header_below_long_preamble", """
SELECT o_orderstatus AS situacao, count(*) AS registros, CAST(sum(o_orderkey) AS BIGINT) AS chaves FROM orders GROUP BY 1""", views=False)
def s6_preamble(spark, sf):
    """Every file starts with eight lines of preamble; the header is found below them."""
    o = t.table(spark, sf, "orders")
    head = "\n".join([*["Atualizado em: 2024-01-01"] * 8, "pedido;situacao", ""])
    path = new_folder(spark, "fundo")
    rows = o.select(F.expr("o_orderkey div 10000").alias("lote"), F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("l"))
    files = rows.groupBy("lote").agg(F.concat(F.lit(head), F.array_join(F.collect_list("l"), "\n")).alias("value"))  # 10,000 keys at most
    files.repartition("lote").write.partitionBy("lote").text(path)
    df = raw.read_raw_layouts(spark, [path])
    return df.groupBy("situacao").agg(F.count(F.lit(1)).alias("registros"), F.sum(F.col("pedido").cast("long")).alias("chaves"))


@query("s1_line_breaks_across_splits", """
SELECT o_orderkey AS pedido, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus ELSE repeat(o_orderpriority || chr(10) || '; ', CAST(o_orderkey % 7 AS INT)) || '"' || o_orderstatus || '"' END AS nota,
  o_orderpriority AS prioridade FROM orders""", views=False)
def s1_splits(spark, sf):
    """Notes of up to thirteen lines, with separators and doubled quotes in them, in files read in many splits."""
    o = t.table(spark, sf, "orders")
    lines = F.call_function("repeat", F.concat("o_orderpriority", F.lit("\n; ")), (F.col("o_orderkey") % 7).cast("int"))
    note = F.concat(F.lit('"'), lines, F.lit('""'), "o_orderstatus", F.lit('"""'))
    path = new_folder(spark, "notas")
    line = F.concat_ws(";", F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderstatus")).otherwise(note), "o_orderpriority")
    o.select(line).coalesce(2).write.text(path)
    split, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = {k: spark.conf.get(k) for k in (split, cost)}
    try:
        spark.conf.set(split, str(max(4096, spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] // 12)))
        spark.conf.set(cost, "0")
        return stored(raw.read_raw_csv(spark, path, ["pedido", "nota", "prioridade"], audit=False, corrupt=None, multiline=True, escape='"').withColumn("pedido", F.col("pedido").cast("long")), "notas_lidas")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@query("s1_surplus_fields_and_line_breaks", """
SELECT o_orderkey AS pedido, o_orderpriority || chr(10) || o_orderstatus AS nota,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey || ';"' || o_orderpriority || chr(10) || o_orderstatus || '";A MAIS' END AS linha FROM orders""", views=False)
def s1_surplus(spark, sf):
    """A note with a quoted line break in every record, and a field too many in every third."""
    o = t.table(spark, sf, "orders")
    note = F.concat(F.lit('"'), "o_orderpriority", F.lit("\n"), "o_orderstatus", F.lit('"'))
    more = F.when(F.col("o_orderkey") % 3 == 0, F.lit(";A MAIS")).otherwise(F.lit(""))
    path = new_folder(spark, "notas")
    o.select(F.concat(F.col("o_orderkey").cast("string"), F.lit(";"), note, more).alias("value")).write.text(path)
    df = raw.read_raw_csv(spark, path, ["pedido", "nota"], audit=False, multiline=True)
    return df.select(F.col("pedido").cast("long").alias("pedido"), "nota", F.col("_corrupt").alias("linha"))


@query("s8_s9_raw_lines", """
SELECT o_orderstatus AS situacao, count(*) AS registros, count(*) FILTER (WHERE o_orderkey % 10 = 0) AS corrompidas FROM orders GROUP BY 1""", views=False)
def s9(spark, sf):
    """Lines kept as they are, then parsed; every tenth line lacks a field."""
    o = t.table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    line = F.when(F.col("o_orderkey") % 10 == 0, F.concat_ws(";", F.col("o_orderstatus"), key)).otherwise(
        F.concat_ws(";", F.col("o_orderstatus"), key, "o_orderpriority"))
    path = new_folder(spark, "linhas")
    o.select(line.alias("value")).write.text(path)
    parsed = raw.parse_raw_lines(raw.read_raw_lines(spark, path), ["situacao", "pedido", "prioridade"])
    return parsed.groupBy("situacao").agg(F.count(F.lit(1)).alias("registros"), F.count("_corrupt").alias("corrompidas"))


def _written(spark, sf) -> str:
    """Text files of at most 10,000 order keys each; their content follows from the rows."""
    path = new_folder(spark, "arquivos")
    o = t.table(spark, sf, "orders").groupBy(F.expr("o_orderkey div 10000").alias("pasta")).agg(
        F.array_join(F.sort_array(F.collect_list(F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))), "\n").alias("value"))
    o.select("value", "pasta").repartition("pasta").write.partitionBy("pasta").text(path)
    return path


_WRITTEN = """
SELECT 'pasta=' || (o_orderkey // 10000) AS pasta, string_agg(lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), chr(10) ORDER BY lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) || chr(10) AS conteudo
FROM orders GROUP BY ALL"""


@query("s13_list_files", f"SELECT pasta, count(*) AS arquivos, CAST(sum(strlen(conteudo)) AS BIGINT) AS bytes FROM ({_WRITTEN}) GROUP BY 1", views=False)
def s13(spark, sf):
    found = raw.folder_summary(raw.list_files(spark, _written(spark, sf), "*.txt"))
    return found.withColumn("pasta", F.element_at(F.split("pasta", "/"), -1))


@query("s23_file_provenance", f"SELECT CAST(strlen(conteudo) AS BIGINT) AS bytes, left(sha256(conteudo), 16) AS sha256 FROM ({_WRITTEN})", views=False)
def s23(spark, sf):
    return raw.file_provenance(spark, _written(spark, sf), "*.txt").select("bytes", "sha256")


@query("s10_pending_files", f"SELECT pasta, CAST(strlen(conteudo) AS BIGINT) AS bytes FROM ({_WRITTEN}) WHERE pasta <> 'pasta=0'", views=False)
def s10(spark, sf):
    """Files that a ledger of some of them does not list."""
    files = raw.list_files(spark, _written(spark, sf), "*.txt")
    left = raw.pending_files(files, files.filter(F.col("pasta").endswith("pasta=0")))
    return left.select(F.element_at(F.split("pasta", "/"), -1).alias("pasta"), "bytes")


@query("s19_export_table", "SELECT * FROM cubo")
def s19(spark, sf):
    path = new_folder(spark, "export")
    export.export_table(cb.additive_cube(t.rows(spark, sf)), path, ["ano_mes", "icao_empresa", "icao_origem", "icao_destino"])
    return spark.read.parquet(path)


@query("s20_export_bundle", """
SELECT 'geral' AS secao, CAST(1 AS BIGINT) AS linhas UNION ALL SELECT 'mensal', count(*) FROM tempo
UNION ALL SELECT 'justificativas', count(DISTINCT coalesce(nullif(codigo_justificativa, ''), '(sem codigo)')) FROM linhas WHERE flag_cancelado""")
def s20(spark, sf):
    r = t.rows(spark, sf)
    return export.export_bundle({"geral": cb.kpis(r), "mensal": cb.month_cube(r), "justificativas": cb.cancellation_reasons(r)}, new_folder(spark, "pacote"))


@query("s14_s15_save_table", "SELECT icao, rotulo FROM aerodromo")
def s14(spark, sf):
    name = "aerodromo_" + new_folder(spark, "x").rsplit("-", 1)[-1]
    catalog.save_table(t.aerodromo(spark, sf), name, "Aerodromos", new_folder(spark, "tabela"), properties={"camada": "gold"})
    return spark.table(name).select("icao", "rotulo")


@query("s17_view", "SELECT uf, count(*) AS aerodromos FROM aerodromo GROUP BY uf")
def s17(spark, sf):
    catalog.create_view(t.aerodromo(spark, sf), "vw_aerodromo")
    return spark.sql("SELECT uf, count(*) AS aerodromos FROM vw_aerodromo GROUP BY uf")


@query("s24_clean_records", "SELECT ano_mes, CAST(primeiro_dia AS VARCHAR) AS primeiro_dia, voos FROM tempo")
def s24(spark, sf):
    return export.json_ready(t.tempo(spark, sf).select("ano_mes", "primeiro_dia", "voos"))
