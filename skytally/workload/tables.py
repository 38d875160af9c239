"""Flight-shaped views of the order tables, built by pure expressions that any SQL engine can repeat.

One day between order and shipment stands for one minute of delay. Every function takes
``(spark, sf_dir)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.typing import label_of
from ..plans import star
from ..plans.cube import additive_cube, export_months, measure_rows
from ..plans.questions import Cube
from ..session import new_folder, spread
from ..plans.silver import silver_airports, silver_companies, with_delays


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the folder; its schema is read from the files once."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def flights(spark, sf, origin: bool = True, destination: bool = True, text_codes: bool = False) -> DataFrame:
    """Typed flights. Leave out an end that is not needed and its lookup is not planned."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if destination:
        cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
        orders = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    df = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if origin:
        supp = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
        df = df.join(supp, F.col("l_suppkey") == F.col("s_suppkey"), "left")

    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7)
    df = df.withColumns({
        "_pp": F.when(F.col("l_orderkey") % 33 != 0, F.col("o_orderdate") + F.make_dt_interval(
            F.lit(0), (F.col("l_partkey") % 24).cast("int"), (F.col("l_suppkey") % 60).cast("int"))),
        "_d": F.datediff("l_shipdate", "o_orderdate"),
        "_planned": 45 + 15 * (F.col("l_partkey") % 12),
        "_cancelled": cancelled,
    })
    df = df.withColumn("_pr", F.when(~F.col("_cancelled"), F.col("_pp") + _minutes(F.col("_d"))))
    times = {
        "partida_prevista": F.col("_pp"),
        "partida_real": F.col("_pr"),
        "chegada_prevista": F.col("_pp") + _minutes(F.col("_planned")),
        "chegada_real": F.col("_pr") + _minutes(F.col("_planned") - 10 + 5 * F.col("l_linenumber")),
    }
    code = (lambda c: F.col(c).cast("string")) if text_codes else F.col
    reason = F.when(F.col("_cancelled"), F.when(F.col("l_partkey") % 3 == 0, F.lit("")).when(
        F.col("l_partkey") % 3 == 2, F.col("o_orderpriority")))
    out = df.select(
        code("l_suppkey").alias("icao_empresa"), code("l_partkey").alias("numero_voo"),
        F.col("l_linestatus").alias("codigo_di"), F.col("l_returnflag").alias("codigo_tipo_linha"),
        *([code("s_nationkey").alias("icao_origem")] if origin else []),
        *([code("c_nationkey").alias("icao_destino")] if destination else []),
        *[c for n, t in times.items() for c in (t.cast("date").alias(f"{n}_data"), t.alias(f"{n}_hora"))],
        F.when(F.col("_cancelled"), F.lit("CANCELADO")).otherwise(F.lit("REALIZADO")).alias("situacao_voo"),
        reason.alias("codigo_justificativa"),
        F.concat(F.lit("lote-"), F.col("l_linenumber").cast("string")).alias("origem_arquivo"),
        F.col("l_shipdate").alias("transformado_em"),
        F.col("l_orderkey").alias("pedido"), F.col("l_linenumber").alias("item"),
    )
    return with_delays(out)


def rows(spark, sf, **kw) -> DataFrame:
    """Flights with flags and calendar columns."""
    return star.flight_rows(flights(spark, sf, **kw))


def _as_text(ts: str) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("null"))


def raw_flights(spark, sf) -> DataFrame:
    """The same flights as an all-text raw table: absence is the word ``null``."""
    f = flights(spark, sf, text_codes=True)
    status = F.when(F.col("pedido") % 97 == 0, F.lit(None)).when(F.col("pedido") % 89 == 0, F.lit("DESCONHECIDO")).otherwise(
        F.col("situacao_voo"))
    return f.select(
        F.col("icao_empresa").alias("ICAO_Empresa_Aérea"), F.col("numero_voo").alias("Número_Voo"),
        F.col("codigo_di").alias("Código_Autorização_DI"), F.col("codigo_tipo_linha").alias("Código_Tipo_Linha"),
        F.col("icao_origem").alias("ICAO_Aeródromo_Origem"), F.col("icao_destino").alias("ICAO_Aeródromo_Destino"),
        _as_text("partida_prevista_hora").alias("Partida_Prevista"), _as_text("partida_real_hora").alias("Partida_Real"),
        _as_text("chegada_prevista_hora").alias("Chegada_Prevista"), _as_text("chegada_real_hora").alias("Chegada_Real"),
        status.alias("Situação_Voo"), F.col("codigo_justificativa").alias("Código_Justificativa"),
        F.col("origem_arquivo").alias("_source_file"), F.col("transformado_em").alias("_ingestion_timestamp"),
        "pedido", "item",
    )


def _supplier_copies(spark, sf) -> DataFrame:
    """Each supplier twice: a complete old record and a newer one with gaps."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    s = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    key = F.col("s_suppkey")
    status = F.when(F.col("s_acctbal") < 0, F.lit("INATIVA")).otherwise(F.lit("ATIVA"))
    copies = F.explode(F.array(
        F.struct(F.lit(0).alias("copia"), F.col("s_name").alias("nome"), status.alias("situacao"),
                 F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("quando")),
        F.struct(F.lit(1).alias("copia"), F.when(key % 3 != 0, F.col("s_name")).otherwise(F.lit("")).alias("nome"),
                 F.when(key % 4 != 0, status).otherwise(F.lit("")).alias("situacao"),
                 (F.lit("2024-02-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval((key % 28).cast("int"))).alias("quando")),
    ))
    return s.select("s_suppkey", "n_name", "n_regionkey", copies.alias("c")).select("s_suppkey", "n_name", "n_regionkey", "c.*")


_EPOCH = "2024-01-01 00:00:00"


def raw_national(spark, sf) -> DataFrame:
    """National registry with repeated header lines."""
    s = _supplier_copies(spark, sf).filter("n_regionkey = 1")
    text = lambda c: F.col(c).cast("string")
    body = s.select(
        text("s_suppkey").alias("icao"), F.lit(None).cast("string").alias("iata"), F.col("nome").alias("razao_social"),
        F.concat(F.lit("CNPJ-"), text("s_suppkey")).alias("cnpj"), F.lit("REGULAR").alias("atividades_aereas"),
        F.col("n_name").alias("cidade"), text("n_regionkey").alias("uf"), *[F.lit("").alias(c) for c in ("cep", "telefone", "email")],
        "situacao", *[F.lit("").alias(c) for c in ("decisao_operacional", "data_decisao_operacional", "validade_operacional")],
        text("copia").alias("id_empresa_aerea"), F.lit("").alias("endereco_sede"),
        F.lit("nacionais").alias("_source_file"), F.col("quando").alias("_ingestion_timestamp"))
    names = [c for c in body.columns if not c.startswith("_")]
    headers = table(spark, sf, "nation").select(
        *[F.lit(c).alias(c) for c in names], F.lit("nacionais").alias("_source_file"),
        F.lit(_EPOCH).cast("timestamp_ntz").alias("_ingestion_timestamp"))
    return body.unionByName(headers)


def raw_foreign(spark, sf) -> DataFrame:
    s = _supplier_copies(spark, sf).filter("n_regionkey <> 1")
    text = lambda c: F.col(c).cast("string")
    return s.select(
        text("s_suppkey").alias("ICAO"), F.col("nome").alias("Razao"), F.lit("CARGA").alias("Servico"),
        F.col("n_name").alias("Cidade"), text("n_regionkey").alias("UF"), *[F.lit("").alias(c) for c in ("CEP", "Telefone", "Email")],
        F.col("situacao").alias("Ativa"), F.lit("").alias("Instrumento"), F.lit("").alias("Data"), text("copia").alias("Endereco"),
        F.lit("estrangeiras").alias("_source_file"), F.col("quando").alias("_ingestion_timestamp"))


def raw_airports(spark, sf) -> DataFrame:
    """Airport registry: decimal commas, missing coordinates, repeated header lines."""
    region = table(spark, sf, "region")
    n = table(spark, sf, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    key = F.col("n_nationkey")
    text = lambda c: c.cast("string")
    geo = lambda start, step: F.when(key % 5 != 0, text((F.lit(start) + F.lit(step) * key).cast("decimal(8,1)")))
    body = n.select(
        text(key).alias("Código OACI"), F.concat(F.lit("C"), text(key)).alias("CIAD"), F.col("n_name").alias("Nome"),
        F.when(key % 7 != 3, F.concat(F.lit("MUN_"), text(key % 20))).alias("Município"),
        F.when(key % 7 != 3, F.col("r_name")).alias("UF"), F.lit("").alias("Município Servido"), F.lit("").alias("UF Servido"),
        F.concat(text(key * 10), F.lit(","), text(key % 10)).alias("Altitude"), geo(-30.0, 2.5).alias("Latitude"),
        geo(-70.0, 3.1).alias("Longitude"), geo(-30.0, 2.5).alias("LATGEOPOINT"), geo(-70.0, 3.1).alias("LONGEOPOINT"),
        F.lit("VFR").alias("Operação Diurna"), F.lit("").alias("Operação Noturna"),
        F.when(key % 6 == 0, F.lit("Interditado")).when(key % 6 == 1, F.lit("Descadastrado")).otherwise(F.lit("Cadastrado")).alias("Situação"),
        F.lit("").alias("Validade do Registro"), F.lit("").alias("Portaria de Registro"), F.lit("").alias("Link Portaria"),
        F.lit("aerodromos").alias("_source_file"), F.lit(_EPOCH).cast("timestamp_ntz").alias("_ingestion_timestamp"))
    names = [c for c in body.columns if not c.startswith("_")]
    headers = region.select(*[F.lit(c).alias(c) for c in names], F.lit("aerodromos").alias("_source_file"),
                            F.lit(_EPOCH).cast("timestamp_ntz").alias("_ingestion_timestamp"))
    return body.unionByName(headers)


def companies(spark, sf) -> DataFrame:
    return silver_companies(raw_national(spark, sf), raw_foreign(spark, sf))


def airports(spark, sf) -> DataFrame:
    return silver_airports(raw_airports(spark, sf))


def dims(spark, sf, f: DataFrame | None = None) -> dict[str, DataFrame]:
    """All six dimensions of the star."""
    f = f if f is not None else flights(spark, sf, text_codes=True)
    a, codes = airports(spark, sf), star.flight_codes(f)
    return {
        "tempo": star.fixed_calendar(star.days_of_codes(codes)), "empresa": star.build_dim_empresa(companies(spark, sf)),
        "aerodromo": star.build_dim_aerodromo(a), "tipo_linha": star.build_dim_tipo_linha(codes),
        "situacao": star.build_dim_situacao(codes), "rota": star.build_dim_rota(codes, a),
    }


def fact(spark, sf, d: dict[str, DataFrame], numbered: bool = False) -> DataFrame:
    return star.build_fact(flights(spark, sf, text_codes=True), d, numbered, ("pedido", "item"), ("pedido", "item"))


def obt(spark, sf, numbered: bool = False) -> DataFrame:
    found = star.build_dim_empresa(companies(spark, sf), star.unnumbered), star.build_dim_aerodromo(airports(spark, sf), star.unnumbered)
    return star.obt_of_flights(flights(spark, sf, text_codes=True), *found, numbered, ("pedido", "item"), ("pedido", "item"))


def obt_of_fact(spark, sf, numbered: bool = False) -> DataFrame:
    """The same table by way of the fact's keys."""
    d = dims(spark, sf)
    return star.build_obt(fact(spark, sf, d, numbered), d)


# --- Export-shaped dimensions keyed by the integer codes ---------------------------------------

def empresa(spark, sf) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    brand = F.when(F.col("s_suppkey") % 10 < 2, F.lit("M0")).when(F.col("s_suppkey") % 10 == 2, F.lit("M1"))
    return s.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("icao_empresa"), F.col("s_name").alias("nome"),
        F.coalesce(F.col("n_regionkey") == 1, F.lit(False)).alias("nacional"), brand.alias("marca"))


def aerodromo(spark, sf) -> DataFrame:
    region = table(spark, sf, "region")
    n = table(spark, sf, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    key = F.col("n_nationkey")
    known = key % 7 != 3
    geo = lambda start, step: F.when(key % 5 != 0, F.lit(start) + F.lit(step) * key)
    return n.select(
        key.alias("icao"), F.col("n_name").alias("nome"),
        F.when(known, F.concat(F.lit("MUN_"), (key % 20).cast("string"))).alias("municipio"),
        F.when(known, F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))).alias("uf"),
        F.when(known, F.col("r_name")).alias("estado"), geo(-30.0, 2.5).alias("latitude"), geo(-70.0, 3.1).alias("longitude"),
    ).withColumn("rotulo", label_of("municipio", "nome", "icao"))


def rota(spark, sf, sums: DataFrame | None = None) -> DataFrame:
    """Routes in use with distance and flights: one pass over the flights, or over ``sums`` that add up to them (any cube)."""
    from ..functions.geo import distance_band, haversine_km
    from ..operators.joins import lookup

    if sums is None:
        sums = flights(spark, sf).select("icao_origem", "icao_destino", F.lit(1).cast("long").alias("voos"))
    f = sums.groupBy("icao_origem", "icao_destino").agg(F.sum("voos").alias("voos"))
    for role in ("origem", "destino"):
        f = lookup(f, aerodromo(spark, sf), {f"icao_{role}": "icao"}, {"latitude": f"_lat_{role}", "longitude": f"_lon_{role}"})
    km = haversine_km("_lat_origem", "_lon_origem", "_lat_destino", "_lon_destino")
    return f.select("icao_origem", "icao_destino", km.alias("distancia_km"), distance_band(km).alias("faixa_distancia"),
                    (F.col("icao_origem") == F.col("icao_destino")).alias("origem_igual_destino"), "voos")


def tempo(spark, sf) -> DataFrame:
    return export_months(rows(spark, sf, origin=False, destination=False))


def cube(spark, sf, origin: bool = True, destination: bool = True) -> Cube:
    """Question input over flights of weight one; ends that are not asked for are NULL."""
    r = rows(spark, sf, origin=origin, destination=destination)
    absent = {n: F.lit(None).cast("int") for n, flag in (("icao_origem", origin), ("icao_destino", destination)) if not flag}
    r = r.withColumns(absent) if absent else r
    return Cube(measure_rows(r), lambda: empresa(spark, sf), lambda: aerodromo(spark, sf), lambda: rota(spark, sf), lambda: tempo(spark, sf))


_STORED: dict[tuple[str, str], str] = {}


def stored_cube(spark, sf) -> Cube:
    """The additive cube and its dimensions, written to the shared folder by the first question of an application and read after that."""
    known = (spark.sparkContext.applicationId, sf)
    if known not in _STORED:
        path = new_folder(spark, "cubo")
        additive_cube(rows(spark, sf)).write.parquet(f"{path}/fato")
        routes = rota(spark, sf, spark.read.parquet(f"{path}/fato"))
        parts = {"empresa": empresa(spark, sf), "aerodromo": aerodromo(spark, sf), "rota": routes, "tempo": tempo(spark, sf)}
        for name, df in parts.items():
            df.write.parquet(f"{path}/{name}")
        _STORED[known] = path
    part = lambda name: spark.read.parquet(f"{_STORED[known]}/{name}")
    return Cube(part("fato"), *(lambda n=n: part(n) for n in ("empresa", "aerodromo", "rota", "tempo")))


def lines(spark, sf, name: str = "documents", key: str = "doc_id") -> DataFrame:
    """Non-empty text lines of a table, numbered inside each text."""
    return spread(table(spark, sf, name).select(key, "text")).select(key, F.posexplode(F.split("text", "\n")).alias("linha", "texto")).filter(
        F.trim("texto") != "")


def lookup_route_and_company(spark, sf, sums: DataFrame) -> DataFrame:
    """Distance band and nationality for rows keyed by route and company."""
    from ..functions.geo import distance_band, haversine_km
    from ..operators.joins import lookup

    a = aerodromo(spark, sf)
    for role in ("origem", "destino"):
        sums = lookup(sums, a, {f"icao_{role}": "icao"}, {"latitude": f"_la_{role}", "longitude": f"_lo_{role}"})
    sums = sums.withColumn("faixa_distancia", distance_band(haversine_km("_la_origem", "_lo_origem", "_la_destino", "_lo_destino")))
    return lookup(sums, empresa(spark, sf), {"icao_empresa": "icao_empresa"}, {"nacional": "nacional"})
