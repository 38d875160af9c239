"""The question family: rankings, series, direction comparisons and templates over the cube.

Every question takes a ``Cube``. Its ``fato`` may be the stored additive cube or flights of weight
one (``measure_rows``): the sums are the same. Measures are summed per code before a dimension is
joined, so a hot company or airport reaches the join as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import MEASURES, METRICS, measure_sums, metric, metrics
from ..functions.text import comparable_text, strip_accents
from ..functions.typing import pair_high, pair_low, percent
from ..operators.aggregates import arg_best, count_if, movement, top_k, weighted_mean
from ..operators.joins import members_of, not_members_of
from ..operators.windows import unique_label

MIN_PER_DIRECTION = 1500
MIN_DAYS = 28


class Cube:
    """Fact rows with the eight keys and fifteen measures, and the four export dimensions.

    A part may be given as a function; it is then built when a question first asks for it.
    """

    def __init__(self, fato, empresa=None, aerodromo=None, rota=None, tempo=None):
        self._parts = {"fato": fato, "empresa": empresa, "aerodromo": aerodromo, "rota": rota, "tempo": tempo}

    def _part(self, name: str) -> DataFrame:
        part = self._parts[name]
        if part is None:
            raise ValueError(f"this cube has no {name}")
        if not isinstance(part, DataFrame):
            part = self._parts[name] = part()
        return part

    fato = property(lambda self: self._part("fato"))
    empresa = property(lambda self: self._part("empresa"))
    aerodromo = property(lambda self: self._part("aerodromo"))
    rota = property(lambda self: self._part("rota"))
    tempo = property(lambda self: self._part("tempo"))

    def with_parts(self, **parts) -> Cube:
        return Cube(**{**self._parts, **parts})


def sums_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """All measures summed by keys; unused ones are pruned from the plan."""
    return df.groupBy(*keys).agg(*measure_sums())


def with_dim(sums: DataFrame, key: str, dim: DataFrame, dim_key: str, attrs: dict[str, str]) -> DataFrame:
    """Inner join of summed rows to a dimension, taking renamed attributes."""
    side = dim.select(F.col(dim_key).alias("_dk"), *[F.col(c).alias(n) for c, n in attrs.items()])
    return sums.join(side, sums[key] == side["_dk"]).drop("_dk")


def by_attribute(cube: Cube, key: str, dim: DataFrame, dim_key: str, attrs: dict[str, str], *more: str) -> DataFrame:
    """Measures by attributes of one dimension (and further fact keys)."""
    joined = with_dim(sums_by(cube.fato, key, *more), key, dim, dim_key, attrs)
    return sums_by(joined, *attrs.values(), *more)


def _companies(cube: Cube, attrs: dict[str, str], *more: str) -> DataFrame:
    return by_attribute(cube, "icao_empresa", cube.empresa, "icao_empresa", attrs, *more)


def _origins(cube: Cube, attrs: dict[str, str], *more: str) -> DataFrame:
    return by_attribute(cube, "icao_origem", cube.aerodromo, "icao", attrs, *more)


def _rate(name: str, alias: str | None = None) -> Column:
    """A metric on rows that are already summed."""
    m = METRICS[name]
    col = F.col(m.num) if m.den is None else F.lit(m.scale) * F.col(m.num).cast("double") / F.nullif(
        F.col(m.den), F.lit(0)).cast("double")
    return col.alias(alias or name)


def _complete_months(cube: Cube, min_days: int = MIN_DAYS) -> DataFrame:
    return cube.tempo.filter((F.col("dias_com_voo") >= min_days) & F.col("ano_mes").isNotNull())


def _monthly(cube: Cube, fato: DataFrame, min_days: int = MIN_DAYS) -> DataFrame:
    """Measures by complete month with its label and order."""
    return with_dim(sums_by(fato, "ano_mes"), "ano_mes", _complete_months(cube, min_days), "ano_mes",
                    {"nome_mes": "mes", "ordem": "ordem"})


# --- Rankings and series ------------------------------------------------------------------------

def cancellation_ranking(cube: Cube, min_flights: int = 500, k: int = 15) -> DataFrame:
    rows = _companies(cube, {"nome": "empresa"}).filter(F.col("voos") >= min_flights)
    out = rows.select("empresa", _rate("taxa"), F.col("voos").alias("programados"))
    return top_k(out, [F.desc("taxa"), F.asc("empresa")], k)


def cancellation_leader(cube: Cube, min_flights: int = 500) -> DataFrame:
    rows = _companies(cube, {"nome": "rotulo_topo"}).filter(F.col("voos") >= min_flights)
    return arg_best(rows.select("rotulo_topo", _rate("taxa")), [], "rotulo_topo", "taxa")


def otp_by_month(cube: Cube, min_days: int = MIN_DAYS, k: int | None = None) -> DataFrame:
    rows = _monthly(cube, cube.fato, min_days)
    return top_k(rows.select("mes", _rate("otp"), "realizados", "ordem"), [F.asc("ordem")], k)


def otp_of_months(cube: Cube, months: dict[str, str]) -> DataFrame:
    """On-time rate of chosen months as columns."""
    return cube.fato.agg(*[metric("otp", F.col("ano_mes") == m, n) for n, m in months.items()])


def cancellation_by_month(cube: Cube, min_days: int = MIN_DAYS, k: int | None = None) -> DataFrame:
    return top_k(_monthly(cube, cube.fato, min_days).select("mes", _rate("taxa"), "ordem"), [F.asc("ordem")], k)


def busiest_airports(cube: Cube, min_flights: int = 900, k: int = 80) -> DataFrame:
    rows = _origins(cube, {"rotulo": "local", "latitude": "latitude", "longitude": "longitude"}, "icao_origem")
    rows = rows.filter(F.col("latitude").isNotNull() & (F.col("voos") >= min_flights))
    out = rows.select(F.col("icao_origem").alias("icao"), "local", "latitude", "longitude", "voos", _rate("otp"))
    return top_k(out, [F.desc("voos"), F.asc("icao")], k)


def airport_movement(cube: Cube) -> DataFrame:
    return movement(sums_by(cube.fato, "icao_origem", "icao_destino"), "icao_origem", "icao_destino", "voos")


def national_vs_foreign(cube: Cube) -> DataFrame:
    rows = _companies(cube, {"nacional": "nacional"})
    group = F.when(F.col("nacional"), F.lit("Nacionais")).otherwise(F.lit("Estrangeiras")).alias("grupo")
    return rows.select(group, _rate("atraso"), _rate("otp"), "realizados")


def national_vs_foreign_columns(cube: Cube, name: str = "atraso") -> DataFrame:
    """The same metric as two columns."""
    rows = _companies(cube, {"nacional": "nacional"})
    return rows.agg(metric(name, F.col("nacional"), "nacionais"), metric(name, ~F.col("nacional"), "estrangeiras"))


def otp_by_period(cube: Cube) -> DataFrame:
    rows = sums_by(cube.fato.filter("periodo_partida IS NOT NULL"), "periodo_partida")
    return rows.select(F.col("periodo_partida").alias("periodo"), _rate("otp"), "realizados")


def cancellations_by_period(cube: Cube) -> DataFrame:
    rows = sums_by(cube.fato.filter("periodo_partida IS NOT NULL"), "periodo_partida")
    return rows.select(F.col("periodo_partida").alias("periodo"), "cancelados", _rate("taxa"))


def departures_of_state(cube: Cube, state, k: int | None = None, column: str = "uf") -> DataFrame:
    airports = cube.aerodromo.filter(F.col(column) == F.lit(state))
    rows = by_attribute(cube, "icao_origem", airports, "icao", {"rotulo": "aeroporto"}, "icao_origem")
    out = rows.select("aeroporto", F.col("icao_origem").alias("icao"), F.col("voos").alias("partidas"))
    return top_k(out, [F.desc("partidas"), F.asc("icao")], k)


def departures_by_state(cube: Cube, k: int | None = None, code: str = "uf", name: str = "estado") -> DataFrame:
    airports = cube.aerodromo.filter(F.col(code).isNotNull())
    rows = by_attribute(cube, "icao_origem", airports, "icao", {code: "_uf", name: "estado"})
    return top_k(rows.select("estado", F.col("voos").alias("partidas")), [F.desc("partidas"), F.asc("estado")], k)


def brand_flights(cube: Cube, brand: str, k: int | None = None) -> DataFrame:
    companies = cube.empresa.filter(F.col("marca") == brand)
    rows = by_attribute(cube, "icao_empresa", companies, "icao_empresa", {"nome": "empresa"})
    return top_k(rows.select("empresa", "voos"), [F.desc("voos"), F.asc("empresa")], k)


def brand_otp(cube: Cube, brand: str, dated_only: bool = True) -> DataFrame:
    fato = cube.fato.filter("ano_mes IS NOT NULL") if dated_only else cube.fato
    rows = members_of(fato, "icao_empresa", cube.empresa.filter(F.col("marca") == brand), "icao_empresa")
    return rows.agg(*metrics("otp", "realizados"))


def brand_by_month(cube: Cube, brand: str) -> DataFrame:
    rows = members_of(cube.fato, "icao_empresa", cube.empresa.filter(F.col("marca") == brand), "icao_empresa")
    return sums_by(rows, "ano_mes").select("ano_mes", "voos")


def monthly_otp_of_airport(cube: Cube, name_part: str, min_days: int = MIN_DAYS, k: int | None = None) -> DataFrame:
    found = cube.aerodromo.filter(strip_accents(F.upper("nome")).contains(name_part.upper()))
    rows = _monthly(cube, members_of(cube.fato, "icao_origem", found, "icao"), min_days)
    return top_k(rows.select("mes", _rate("otp"), "ordem"), [F.asc("ordem")], k)


def top_destinations(cube: Cube, city: str, k: int = 15) -> DataFrame:
    home = cube.aerodromo.filter(comparable_text("municipio") == city.upper())
    rows = sums_by(members_of(cube.fato, "icao_origem", home, "icao"), "icao_destino")
    named = with_dim(rows, "icao_destino", cube.aerodromo, "icao", {"rotulo": "_r"})
    label = F.concat("_r", F.lit(" ("), F.col("icao_destino").cast("string"), F.lit(")"))
    return top_k(named.select(label.alias("destino"), "voos"), [F.desc("voos"), F.asc("destino")], k)


def delay_ranking(cube: Cube, min_done: int = 500, k: int = 15) -> DataFrame:
    rows = _companies(cube, {"nome": "nome"}, "icao_empresa").filter(F.col("realizados") >= min_done)
    name = F.coalesce("nome", F.col("icao_empresa").cast("string")).alias("empresa")
    return top_k(rows.select(name, _rate("atraso"), "realizados"), [F.desc("atraso"), F.asc("empresa")], k)


def longest_routes(cube: Cube, k: int = 10) -> DataFrame:
    rows = cube.rota.filter(F.col("distancia_km").isNotNull() & ~F.col("origem_igual_destino"))
    for role in ("origem", "destino"):
        rows = with_dim(rows, f"icao_{role}", cube.aerodromo, "icao", {"rotulo": f"_{role}"})
    out = rows.select(F.concat("_origem", F.lit(" → "), "_destino").alias("rota"), F.col("distancia_km").alias("km"), "voos")
    return top_k(out, [F.desc("km"), F.asc("rota")], k)


def cancellations_in_month(cube: Cube, month_name: str) -> DataFrame:
    rows = members_of(cube.fato, "ano_mes", cube.tempo.filter(F.col("nome_mes") == month_name), "ano_mes")
    return rows.agg(*metrics("cancelados", "taxa"))


def busiest_route(cube: Cube, directed: bool = True) -> DataFrame:
    a, b = ("icao_origem", "icao_destino") if directed else (
        pair_low("icao_origem", "icao_destino").alias("ponta_a"), pair_high("icao_origem", "icao_destino").alias("ponta_b"))
    rows = sums_by(cube.fato, a, b)
    names = [c for c in rows.columns if c not in MEASURES]
    return top_k(rows.select(*names, "voos"), [F.desc("voos"), *[F.asc(n) for n in names]], 1)


def pair_totals(cube: Cube) -> DataFrame:
    """Traffic of undirected pairs."""
    return sums_by(cube.fato, pair_low("icao_origem", "icao_destino").alias("ponta_a"),
                   pair_high("icao_origem", "icao_destino").alias("ponta_b")).select("ponta_a", "ponta_b", "voos")


def worst_delay_airport(cube: Cube, min_done: int = 100) -> DataFrame:
    rows = sums_by(cube.fato, "icao_origem").filter(F.col("realizados") >= min_done)
    return arg_best(rows.select("icao_origem", _rate("atraso")), [], "icao_origem", "atraso")


def mean_distance(cube: Cube, with_circular: bool = False) -> DataFrame:
    """Mean distance weighted by flights; routes without distance do not count."""
    rows = cube.rota if with_circular else cube.rota.filter(~F.col("origem_igual_destino"))
    return weighted_mean(rows, "distancia_km", "voos", "km")


def top_foreign_company(cube: Cube) -> DataFrame:
    companies = cube.empresa.filter(~F.col("nacional"))
    rows = members_of(sums_by(cube.fato, "icao_empresa"), "icao_empresa", companies, "icao_empresa")
    return arg_best(rows, [], "icao_empresa", "voos")


def weekend_otp(cube: Cube) -> DataFrame:
    rows = cube.fato.filter("fim_de_semana IS NOT NULL")
    return rows.agg(metric("otp", F.col("fim_de_semana"), "fds"), metric("otp", ~F.col("fim_de_semana"), "util"))


# --- Same route in both directions ---------------------------------------------------------------

@dataclass(frozen=True)
class Place:
    """A state, a city, one airport, or a named set of airports."""

    kind: str
    value: object = None
    codes: tuple = ()

    def airports(self, cube: Cube, state_column: str = "uf") -> DataFrame:
        a = cube.aerodromo.filter("icao IS NOT NULL")
        if self.kind == "uf":
            return a.filter(F.col(state_column) == F.lit(self.value)).select("icao")
        if self.kind == "municipio":
            return a.filter(F.col("municipio") == F.lit(self.value)).select("icao")
        codes = list(self.codes) if self.kind == "conjunto" else [self.value]
        return a.filter(F.col("icao").isin(codes)).select("icao")


def resolve_place(cube: Cube, place: Place) -> Place:
    """A city with a single airport is that airport, so its answer is one row and not a list of one."""
    if place.kind != "municipio":
        return place
    codes = place.airports(cube).limit(2).collect()
    return Place("aeroporto", codes[0][0]) if len(codes) == 1 else place


def _directions(cube: Cube, place: Place, exclude_inner: bool, min_flights: int, state_column: str) -> DataFrame:
    here = place.airports(cube, state_column)
    pairs = sums_by(cube.fato, "icao_origem", "icao_destino")

    def side(home: str, other: str, name: str) -> DataFrame:
        rows = members_of(pairs, home, here, "icao")
        if exclude_inner:
            rows = not_members_of(rows, other, here, "icao")
        out = sums_by(rows, other).select(F.col(other).alias(f"_p_{name}"), _rate("otp", name), F.col("realizados").alias(f"n_{name}"))
        return out.filter(F.col(f"n_{name}") >= min_flights)

    leaving, arriving = side("icao_origem", "icao_destino", "saindo"), side("icao_destino", "icao_origem", "chegando")
    return leaving.join(arriving, leaving["_p_saindo"] == arriving["_p_chegando"]).withColumnRenamed("_p_saindo", "icao").drop("_p_chegando")


def direction_compare(
    cube: Cube, place: Place, exclude_inner: bool = True, order: str = "abs", min_flights: int = MIN_PER_DIRECTION,
    k: int = 14, state_column: str = "uf",
) -> DataFrame:
    """On-time rate leaving and arriving on the same routes, largest difference first."""
    both = _directions(cube, resolve_place(cube, place), exclude_inner, min_flights, state_column)
    named = with_dim(both, "icao", cube.aerodromo, "icao", {"rotulo": "rotulo"})
    named = unique_label(named, "rotulo", "icao", "rota")
    diff = F.col("chegando") - F.col("saindo")
    ranked = named.select("rota", "saindo", "chegando", "icao")
    return top_k(ranked, [F.desc(F.abs(diff) if order == "abs" else diff), F.asc("icao")], k)


def leaving_worse_count(cube: Cube, place: Place, min_flights: int = 800, state_column: str = "uf") -> DataFrame:
    """On how many routes with enough traffic both ways leaving is less punctual than arriving."""
    both = _directions(cube, place, True, min_flights, state_column)
    return both.agg(F.count(F.lit(1)).alias("rotas"),
                    count_if(F.col("saindo") < F.col("chegando")).alias("sair_pior"))


# --- Template ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Question:
    """measure x place x direction x brand x month x series."""

    measure: str                    # voos | otp | cancelamento | atraso
    rate: bool = False
    place: Place | None = None
    direction: str | None = None    # origem | destino
    brand: str | None = None
    month: str | None = None
    series: bool = False


# What each measure selects, and whether it may be listed per airport or operator.
_SELECT = {"voos": ["voos"], "cancelamento": ["cancelados", "taxa"], "otp": ["otp", "realizados"], "atraso": ["atraso", "realizados"]}


def with_changes(question: Question, **changes) -> Question:
    """A follow-up: the same question with one entity replaced; a series keeps no single month."""
    changed = replace(question, **changes)
    if changed.series and changed.month:
        raise ValueError("a series cannot be restricted to one month")
    return changed


def measure_query(cube: Cube, q: Question, min_days: int = MIN_DAYS, state_column: str = "uf", k: int | None = None) -> DataFrame:
    """Answer a template question: a monthly series, a list per airport or operator, or one row.

    Series and lists are whole unless ``k`` asks for their first rows. A city with one airport is answered as that airport.
    """
    if q.series and q.month:
        raise ValueError("a series cannot be restricted to one month")
    if q.place:
        q = replace(q, place=resolve_place(cube, q.place))
    names = _SELECT[q.measure]
    additive = q.measure == "voos" or (q.measure == "cancelamento" and not q.rate)
    main = "taxa" if q.measure == "cancelamento" and q.rate else names[0]
    end = "icao_destino" if q.direction == "destino" else "icao_origem"

    fato = cube.fato
    if q.brand:
        fato = members_of(fato, "icao_empresa", cube.empresa.filter(F.col("marca") == q.brand), "icao_empresa")
    if q.month:
        fato = fato.filter(F.col("ano_mes") == q.month)
    if q.measure == "otp" and not q.month and not q.series:
        fato = fato.filter("ano_mes IS NOT NULL")
    if q.place and q.place.kind == "aeroporto":
        fato = fato.filter(F.col(end) == F.lit(q.place.value))
    elif q.place:
        fato = members_of(fato, end, q.place.airports(cube, state_column), "icao")

    if q.series:
        rows = _monthly(cube, fato, min_days).select("mes", *[_rate(n) for n in names], "ordem")
        return top_k(rows, [F.asc("ordem")], k)
    if q.place and q.place.kind != "aeroporto" and additive:
        rows = with_dim(sums_by(fato, end), end, cube.aerodromo, "icao", {"rotulo": "aeroporto"})
        out = rows.select("aeroporto", F.col(end).alias("icao"), *[_rate(n) for n in names])
        return top_k(out, [F.desc(main), F.asc("icao")], k)
    if q.brand and not q.place and additive:
        rows = with_dim(sums_by(fato, "icao_empresa"), "icao_empresa", cube.empresa, "icao_empresa", {"nome": "empresa"})
        out = sums_by(rows, "empresa").select("empresa", *[_rate(n) for n in names])
        return top_k(out, [F.desc(main), F.asc("empresa")], k)
    return fato.agg(*metrics(*names))


def row_cap(df: DataFrame, cap: int, order: Sequence[Column] = ()) -> DataFrame:
    """At most ``cap`` rows, the size of an answer."""
    return (df.orderBy(*order) if order else df).limit(cap)


def share_by(cube: Cube, key: str) -> DataFrame:
    """Flights per key and their percent of all flights."""
    rows = sums_by(cube.fato, key).select(key, "voos")
    total = cube.fato.agg(F.sum("voos").alias("_t"))
    return rows.withColumn("_t", total.scalar()).select(key, "voos", percent("voos", "_t").alias("pct"))
