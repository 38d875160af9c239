"""Message classification, entity tags from a dictionary, templates and follow-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx
from ..functions.calendar import MONTH_ABBREVIATIONS
from ..session import spread, stored
from .windows import previous_in_group


def classify_messages(df: DataFrame, text: str, name: str = "intencao", triggers=None) -> DataFrame:
    """First trigger that matches the normalised text; NULL when none does."""
    return df.withColumn("_n", tx.normalize_text(text)).withColumn(name, tx.classify("_n", triggers)).drop("_n")


def entity_dictionary(df: DataFrame, name: str, kind: Column, key: Column, rule: Column | None = None) -> DataFrame:
    """Dictionary rows (frase, tipo, chave, regra, grafia) from the names of a dimension.

    ``regra``: ``livre`` always counts, ``maiuscula`` only written in capitals, ``nome`` only written
    as a proper noun or after a preposition of place.
    """
    return df.filter(F.col(name).isNotNull()).select(
        tx.normalize_text(name).alias("frase"), kind.alias("tipo"), key.cast("string").alias("chave"),
        (rule if rule is not None else F.lit("livre")).alias("regra"), F.col(name).alias("grafia")).filter("frase <> ''")


def default_rule(name: str, is_code: bool = False) -> Column:
    """Ambiguous codes need capitals, names that are common words need proper spelling."""
    if is_code:
        return F.when(F.upper(name).isin(lx.AMBIGUOUS_CODES), F.lit("maiuscula")).otherwise(F.lit("livre"))
    return F.when(tx.normalize_text(name).isin(lx.COMMON_WORD_NAMES), F.lit("nome")).otherwise(F.lit("livre"))


def build_dictionary(airports: DataFrame, companies: DataFrame, months: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """The dictionary of all entities of the dimensions, as ``entity_dictionary`` gives it.

    ``airports`` (icao, municipio, uf, estado), ``companies`` (marca), ``months`` (ano_mes). A name that is both a state's and
    a city's means the state. A month counts with its year, and alone only where the data has it in one year. ``aliases``
    (apelido, tipo, chave) add names of entities that exist; others are left out.
    """
    distinct = lambda df, *names: df.select(*names).filter(F.col(names[0]).isNotNull()).distinct()
    states = distinct(airports, "uf", "estado").filter("estado IS NOT NULL")
    state_names = states.select(tx.normalize_text("estado").alias("_s")).distinct()
    cities = distinct(airports, "municipio")
    cities = cities.join(state_names, tx.normalize_text("municipio") == F.col("_s"), "left_anti")
    codes = distinct(airports.select(F.col("icao").cast("string").alias("icao")), "icao")
    year, month = F.substring("ano_mes", 1, 4), F.substring("ano_mes", 6, 2).cast("int")
    when = distinct(months, "ano_mes").select("ano_mes", year.alias("_y"), month.alias("_m"))
    name_of = lambda names: F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_m"))
    forms = [F.concat(name_of(names), F.lit(between), "_y") for names in (lx.MONTH_NAMES, MONTH_ABBREVIATIONS) for between in (" de ", " ", "/")]
    dated = when.select("ano_mes", F.explode(F.array_distinct(F.array(*forms))).alias("nome"))
    alone = when.groupBy("_m").agg(F.min("ano_mes").alias("ano_mes"), F.count(F.lit(1)).alias("_n")).filter("_n = 1").select("ano_mes", name_of(lx.MONTH_NAMES).alias("nome"))
    parts = [
        entity_dictionary(states, "estado", F.lit("uf"), F.col("uf"), default_rule("estado")),
        entity_dictionary(states, "uf", F.lit("uf"), F.col("uf"), default_rule("uf", is_code=True)),
        entity_dictionary(cities, "municipio", F.lit("municipio"), F.col("municipio"), default_rule("municipio")),
        entity_dictionary(codes, "icao", F.lit("aeroporto"), F.col("icao")),
        entity_dictionary(distinct(companies, "marca"), "marca", F.lit("marca"), F.col("marca")),
        entity_dictionary(dated.unionByName(alone), "nome", F.lit("mes"), F.col("ano_mes")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if aliases is not None:
        there = out.select(F.col("tipo").alias("_t"), F.col("chave").alias("_c")).distinct()
        known = aliases.join(there, (aliases["tipo"] == F.col("_t")) & (aliases["chave"].cast("string") == F.col("_c")), "left_semi")
        out = out.unionByName(entity_dictionary(known, "apelido", F.col("tipo"), F.col("chave")))
    return out.distinct()


def _written_as_name(original: Column, name: Column) -> Column:
    """Some word of the text is the name with its accent, or with a capital when it has none."""
    plain = tx.normalize_text(name)
    accented = plain != F.lower(name)
    ws = F.regexp_extract_all(original, F.lit(r"\p{L}+"), F.lit(0))
    proper = lambda w: (tx.normalize_text(w) == plain) & F.when(accented, tx.normalize_text(w) != F.lower(w)).otherwise(
        F.substring(w, 1, 1) == F.upper(F.substring(w, 1, 1)))
    return F.exists(ws, proper)


def tag_entities(df: DataFrame, id_column: str, text: str, dictionary: DataFrame, max_words: int | None = None) -> DataFrame:
    """Dictionary names in a text: (id, posicao, palavras, frase, tipo, chave, antes).

    The dictionary is a tree by first words: a text's distinct words are joined to the first words of names, and only at positions of
    those, and only in the lengths that names with that first word have, word n-grams are formed and joined by equality. So names of
    many words do not multiply a text. Where names overlap the longest wins, ties go to the name first in order, then to the
    earlier position; stretches of overlapping names are found by a running maximum and settled one by one. ``antes`` holds the two words before.
    """
    names = dictionary.groupBy("frase").agg(F.min(F.struct("tipo", "chave", "regra", "grafia")).alias("_d")).select("frase", "_d.*")
    names = names.withColumn("_w", F.size(F.split("frase", " ")))
    if max_words is not None:
        names = names.where(F.col("_w") <= max_words)
    firsts = names.groupBy(F.substring_index("frase", " ", 1).alias("_first")).agg(F.collect_set("_w").alias("_lengths"))
    tokens = stored(spread(df.select(id_column, text)).select(F.col(id_column).alias("_id"), F.split(tx.normalize_text(text), " ").alias("_tok")), "palavras")
    begins = tokens.select("_id", F.explode(F.array_distinct("_tok")).alias("_first")).join(firsts, "_first")
    begins = begins.groupBy(F.col("_id").alias("_bid")).agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("_first", "_lengths")))).alias("_starts"))
    size = F.size("_tok")
    # Words are fetched by position: a slice would copy the whole text for every position.
    word = lambda p: F.get("_tok", p - 1)

    def at(p: Column) -> Column:
        fits = F.filter(F.element_at("_starts", word(p)), lambda n: p + n <= size + 1)
        return F.transform(fits, lambda n: F.struct(
            p.alias("p"), n.alias("n"), F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: word(p + i)), " ").alias("g"),
            F.concat_ws(" ", F.when(p > 2, word(p - 2)), F.when(p > 1, word(p - 1))).alias("antes")))

    places = F.filter(F.sequence(F.lit(1), size), lambda p: F.map_contains_key("_starts", word(p)))
    found = tokens.join(begins, F.col("_id") == F.col("_bid")).select("_id", F.explode(F.flatten(F.transform(places, at))).alias("x")).select("_id", "x.*")
    found = found.join(names, (found["g"] == names["frase"]) & (found["n"] == names["_w"]))

    strict = found.filter("regra <> 'livre'")
    originals = df.select(F.col(id_column).alias("_oid"), F.col(text).alias("_orig"))
    code_seen = F.expr(r"_orig RLIKE concat('(^|[^A-Za-z])', upper(grafia), '([^A-Za-z]|$)')")
    after_place = F.element_at(F.split("antes", " "), -1).isin(lx.PLACE_PREPOSITIONS)
    named = F.when(F.col("regra") == "maiuscula", code_seen).otherwise(_written_as_name(F.col("_orig"), F.col("grafia")) | after_place)
    strict = strict.join(originals, strict["_id"] == originals["_oid"]).filter(named).drop("_oid", "_orig")
    hits = found.filter("regra = 'livre'").unionByName(strict)

    item = F.struct((-F.length("frase")).alias("l"), F.col("frase").alias("f"), F.col("p").alias("p"), F.col("n").alias("n"),
                    F.col("tipo").alias("t"), F.col("chave").alias("k"), F.col("antes").alias("a"))
    upto = Window.partitionBy("_id").orderBy("p", "n").rowsBetween(Window.unboundedPreceding, -1)
    apart = hits.withColumn("_new", (F.col("p") >= F.coalesce(F.max(F.col("p") + F.col("n")).over(upto), F.lit(0))).cast("int"))
    stretch = F.sum("_new").over(Window.partitionBy("_id").orderBy("p", "n").rowsBetween(Window.unboundedPreceding, 0))
    ordered = apart.withColumn("_g", stretch).groupBy("_id", "_g").agg(F.array_sort(F.collect_list(item)).alias("_h"))
    free = lambda acc, x: ~F.exists(acc, lambda y: (y["p"] < x["p"] + x["n"]) & (x["p"] < y["p"] + y["n"]))
    chosen = F.aggregate("_h", F.filter("_h", lambda x: F.lit(False)), lambda acc, x: F.when(free(acc, x), F.concat(acc, F.array(x))).otherwise(acc))
    out = ordered.select("_id", F.explode(chosen).alias("x"))
    return out.select(F.col("_id").alias(id_column), F.col("x.p").alias("posicao"), F.col("x.n").alias("palavras"), F.col("x.f").alias("frase"),
                      F.col("x.t").alias("tipo"), F.col("x.k").alias("chave"), F.col("x.a").alias("antes"))


def mask_entities(df: DataFrame, id_column: str, text: str, tags: DataFrame) -> DataFrame:
    """Normalised text with every entity replaced by ``#tipo``, and its distinct entities."""
    grouped = tags.groupBy(F.col(id_column).alias("_tid")).agg(
        F.collect_list(F.struct("posicao", "palavras", "tipo", "chave", "antes")).alias("_tags"))
    rows = df.join(grouped, df[id_column] == F.col("_tid"), "left").drop("_tid")
    rows = rows.withColumn("_tags", F.coalesce("_tags", F.array().cast(grouped.schema["_tags"].dataType)))
    rows = rows.withColumn("_tok", F.split(tx.normalize_text(text), " "))

    def word(w, i):
        covering = F.filter("_tags", lambda g: (g["posicao"] <= i + 1) & (i + 1 < g["posicao"] + g["palavras"]))
        starts = F.filter(covering, lambda g: g["posicao"] == i + 1)
        return F.when(F.size(starts) > 0, F.concat(F.lit("#"), starts[0]["tipo"])).when(F.size(covering) == 0, w)

    masked = F.array_join(F.filter(F.transform("_tok", word), lambda w: w.isNotNull()), " ")
    entities = F.array_sort(F.array_distinct(F.transform("_tags", lambda g: F.concat(g["tipo"], F.lit(":"), g["chave"]))))
    geo = F.filter("_tags", lambda g: g["tipo"].isin("uf", "municipio", "aeroporto"))
    before = F.when(F.size(geo) > 0, F.element_at(F.split(geo[0]["antes"], " "), -1))
    return rows.select(*df.columns, F.trim(masked).alias("mascarado"), entities.alias("entidades"), before.alias("antes_do_lugar"))


def detect_template(df: DataFrame, masked: str = "mascarado", entities: str = "entidades", before: str = "antes_do_lugar") -> DataFrame:
    """Read a masked question as one measure, or say why it is not a template question."""
    toks = F.filter(F.split(masked, " "), lambda w: w != "")
    first = lambda vocabulary: F.array_position(F.transform(F.col("_toks"), lambda w: w.isin(list(vocabulary))), F.lit(True))
    known = sorted({w for ws in lx.MEASURE_WORDS.values() for w in ws} | set(lx.RATE_WORDS) | set(lx.TEMPLATE_CONNECTORS))
    unknown = lambda w: ~w.startswith("#") & ~w.isin(known)
    df = df.withColumn("_toks", toks)
    at = {g: first(ws) for g, ws in lx.MEASURE_WORDS.items()}
    origin, destination = at["origem"] > 0, at["destino"] > 0
    conflict = F.when(origin & destination, F.greatest(at["origem"], at["destino"]))
    stray_at = F.nullif(F.array_position(F.transform(F.col("_toks"), unknown), F.lit(True)), F.lit(0))
    stray = F.filter(F.col("_toks"), unknown)[0]
    flights = (at["voos"] > 0) | origin | destination
    named = [g for g in ("otp", "cancelamento", "atraso")]
    many = sum(((at[g] > 0).cast("int") for g in named), F.lit(0))
    measure = F.when(at["otp"] > 0, "otp").when(at["cancelamento"] > 0, "cancelamento").when(at["atraso"] > 0, "atraso").when(flights, "voos")
    rate = first(lx.RATE_WORDS) > 0
    direction = F.when(origin, F.lit("origem")).when(destination, F.lit("destino"))
    of_kind = lambda *kinds: F.size(F.filter(entities, lambda e: F.split(e, ":")[0].isin(list(kinds))))
    geo, month = of_kind("uf", "municipio", "aeroporto"), of_kind("mes")
    series = F.col(masked).rlike(lx.SERIES_PATTERN)
    toward = (geo > 0) & F.coalesce(F.col(before).isin(lx.TOWARD_WORDS), F.lit(False))
    final_direction = F.when(toward, F.lit("destino")).otherwise(direction)
    wrong_end = (final_direction == "destino") & ~measure.isin("voos", "cancelamento")
    error = (
        F.when(conflict.isNotNull() & (stray_at.isNull() | (conflict < stray_at)), F.lit("duas direções"))
        .when(stray_at.isNotNull(), F.concat(F.lit('sobrou "'), stray, F.lit('"')))
        .when(many > 1, F.lit("mais de uma medida"))
        .when(measure.isNull(), F.lit("sem medida"))
        .when(rate & (measure != "cancelamento"), F.lit("taxa de quê"))
        .when((geo > 1) | (of_kind("marca") > 1) | (month > 1), F.lit("entidade repetida"))
        .when(series & (month > 0), F.lit("série e mês juntos"))
        .when(toward & origin, F.lit("duas direções"))
        .when(F.coalesce(wrong_end, F.lit(False)), F.lit("medida de partida com destino"))
    )
    ok = F.col("erro").isNull()
    return df.withColumn("erro", error).withColumns({
        "medida": F.when(ok, measure), "taxa": F.when(ok, rate), "direcao": F.when(ok, final_direction), "serie": F.when(ok, series),
    }).drop("_toks")


def is_continuation(normalized) -> Column:
    """Short with an opening connector, or pointing back."""
    n = F.col(normalized) if isinstance(normalized, str) else normalized
    ws = tx.words(n)
    return (n.rlike(lx.FOLLOW_UP_PATTERN) & (F.size(ws) <= lx.FOLLOW_UP_WORDS)) | tx.any_word(ws, lx.BACK_REFERENCES)


def follow_up_flags(df: DataFrame, conversation: str, turn: str, text: str, chunk: int = 1000) -> DataFrame:
    """Does a turn continue the turn before it? Adds the previous turn and the flag."""
    out = previous_in_group(df, [conversation], [turn], {turn: "turno_anterior"}, F.floor(F.col(turn) / chunk))
    cont = is_continuation(tx.normalize_text(text))
    return out.withColumn("continua", F.col("turno_anterior").isNotNull() & cont)


def only_links(masked) -> Column:
    """Does the masked text hold nothing but entities and linking words?"""
    ws = tx.words(masked)
    return ~F.exists(ws, lambda w: ~w.startswith("#") & ~w.isin(lx.LINK_WORDS)) & F.exists(ws, lambda w: w.startswith("#"))


def swapped_entities(df: DataFrame, masked: str, entities: str, accepts: Sequence[str] = ("uf", "municipio", "aeroporto", "marca", "mes")) -> DataFrame:
    """Follow-ups that only replace an entity, and which one of each kind they bring."""
    kinds = F.transform(entities, lambda e: F.split(e, ":")[0])
    geo = F.filter(kinds, lambda k: k.isin("uf", "municipio", "aeroporto"))
    one_each = (F.size(geo) <= 1) & (F.size(F.filter(kinds, lambda k: k == "marca")) <= 1) & (F.size(F.filter(kinds, lambda k: k == "mes")) <= 1)
    allowed = F.size(F.array_except(kinds, F.array(*[F.lit(a) for a in accepts]))) == 0
    return df.withColumn("troca_entidade", only_links(masked) & one_each & allowed)
