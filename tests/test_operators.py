import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from skytally.operators import aggregates as ag
from skytally.operators import answers as an
from skytally.operators import joins as jn
from skytally.operators import quality as ql
from skytally.operators import reconcile as rc
from skytally.operators import similarity as sm
from skytally.operators import tagging as tg
from skytally.operators import windows as wn
from skytally.functions import text as tx


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedupe_best_is_total(spark):
    df = spark.createDataFrame([("A", "", "x", 3), ("A", "Azul", "", 1), ("A", "Azul", "ok", 1), ("A", "Azul", "ok", 2), ("B", None, None, 1)],
                               "icao string, nome string, sit string, t int")
    best = wn.dedupe_best(df, ["icao"], [wn.present_first("nome"), wn.present_first("sit"), -F.col("t")])
    assert rows(best) == [("A", "Azul", "ok", 2), ("B", None, None, 1)]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_surrogate_key_does_not_depend_on_partitions(spark, parts):
    data = [(i % 3, i) for i in range(500)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "g int, v int").repartition(parts)
    got = rows(wn.surrogate_key(df, "sk", ["g", "v"], partitions=parts))
    assert got == [(n + 1, g, v) for n, (g, v) in enumerate(sorted(data))]


def test_surrogate_key_of_few_and_no_rows(spark):
    df = spark.range(50).select((F.lit(50) - F.col("id")).alias("x"))
    assert rows(wn.surrogate_key(df, "sk", ["x"], start=5)) == [(n + 5, n + 1) for n in range(50)]
    assert rows(wn.surrogate_key(df.limit(0), "sk", ["x"])) == []


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_failure_streaks_equal_a_loop(spark, chunk):
    rnd = random.Random(chunk)
    data = [(k, t, rnd.random() < 0.7) for k in range(3) for t in range(60)] + [(9, t, True) for t in range(40)]
    df = spark.createDataFrame(data, "k int, t int, bad boolean")
    want, run = {}, {}
    for k, t, bad in sorted(data):
        run[k] = run.get(k, 0) + 1 if bad else 0
        want[(k, t)] = run[k]
    got = wn.failure_streaks(df, ["k"], ["t"], F.col("bad"), F.floor(F.col("t") / chunk))
    assert {(r["k"], r["t"]): r["sequencia"] for r in got.collect()} == want


@pytest.mark.parametrize("chunk", [1, 5, 100])
def test_previous_in_group_equals_lag(spark, chunk):
    data = [(k, t) for k in range(3) for t in random.Random(k).sample(range(100), 30)]
    df = spark.createDataFrame(data, "k int, t int")
    got = wn.previous_in_group(df, ["k"], ["t"], {"t": "antes"}, F.floor(F.col("t") / chunk))
    want = []
    for k in range(3):
        ts = sorted(t for kk, t in data if kk == k)
        want += [(k, t, p) for t, p in zip(ts, [None, *ts])]
    assert {tuple(r) for r in got.collect()} == set(want)


def test_nearest_rank_equals_sorting(spark):
    rnd = random.Random(3)
    data = [("hot", rnd.gauss(0, 10)) for _ in range(900)] + [("flat", 5.0)] * 40 + [("um", 1.5), ("nulo", None)] + [("hot", 1e9)]
    got = wn.nearest_rank(spark.createDataFrame(data, "g string, v double"), ["g"], "v", {"p50": 0.5, "p95": 0.95, "max": 1.0}, small=10)
    for r in got.collect():
        vs = sorted(v for g, v in data if g == r["g"] and v is not None)
        assert [r["p50"], r["p95"], r["max"]] == [vs[max(0, math.ceil(p * len(vs)) - 1)] for p in (0.5, 0.95, 1.0)]
    assert got.count() == 3


def test_null_keys_and_times_stay(spark):
    data = [(None, 1, True), (None, 2, True), (None, 15, True), (7, None, True), (7, 3, False)]
    df = spark.createDataFrame(data, "k int, t int, bad boolean")
    runs = wn.failure_streaks(df, ["k"], ["t"], F.col("bad"), F.floor(F.col("t") / 10))
    assert {(r.k, r.t): r.sequencia for r in runs.collect() if r.t is not None} == {(None, 1): 1, (None, 2): 2, (None, 15): 3, (7, 3): 0}
    assert runs.count() == len(data)
    prev = wn.previous_in_group(df.where("t IS NOT NULL"), ["k"], ["t"], {"t": "antes"}, F.floor(F.col("t") / 10))
    assert {(r.k, r.t): r.antes for r in prev.collect()} == {(None, 1): None, (None, 2): 1, (None, 15): 2, (7, 3): None}


def test_nearest_rank_of_all_rows(spark):
    df = spark.createDataFrame([(float(x),) for x in [*range(1, 100), 10**8, 10**15]], "v double")
    assert tuple(wn.nearest_rank(df, [], "v", {"p50": 0.5, "p95": 0.95, "p100": 1.0}).first()) == (51.0, 96.0, 1e15)


def test_tolerance_of_zero_is_equality(spark):
    want = spark.createDataFrame([("a", 1.5, 0.0), ("a", 2.5, 0.0), ("a", 9.0, -1.0), ("a", 9.0, None)], "s string, e double, tol double")
    have = spark.createDataFrame([("a", 1.5), ("a", 2.4), ("a", 9.0)], "s string, v double")
    assert rows(rc.match_with_tolerance(want, have, ["s"], "e", "tol", "v")) == [("a", 1.5, 0.0)]
    assert rc.match_with_tolerance(want, have, ["s"], "e", "tol", "v", how="anti").count() == 3


def test_unique_label(spark):
    df = spark.createDataFrame([("RIO", "SBGL"), ("RIO", "SBRJ"), ("BSB", "SBBR")], "l string, c string")
    assert rows(wn.unique_label(df, "l", "c", "r").select("r")) == [("BSB",), ("RIO (SBGL)",), ("RIO (SBRJ)",)]


def test_not_members_ignores_null_members(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    m = spark.createDataFrame([(1,), (None,)], "m int")
    assert rows(jn.not_members_of(df, "x", m, "m")) == [(2,)] and rows(jn.members_of(df, "x", m, "m")) == [(1,)]


def test_lookup_keeps_rows_and_finds_duplicates(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 7)], "icao string, sk int")
    out = jn.lookup_keys(df, [(dim, {"k": "icao"}, "sk", "sk_x")])
    assert {r["k"]: r["sk_x"] for r in out.collect()} == {"a": 7, "z": 0, None: 0}
    assert jn.duplicate_keys(dim.unionAll(dim), ["icao"]).count() == 1


def test_repeated_airport_codes_are_refused(spark):
    df = spark.createDataFrame([("SBSP", 1), ("SBSP", 2), ("SBRJ", 3)], "icao string, v int")
    with pytest.raises(ValueError, match="SBSP"):
        jn.unique(df, ["icao"])
    assert jn.unique(df.where("v > 1"), ["icao"]).count() == 2


def test_set_diff_and_assert(spark):
    a, b = spark.createDataFrame([("x",), (None,)], "c string"), spark.createDataFrame([(None,), ("y",)], "c string")
    assert rows(jn.set_diff(a, b, ["c"])) == [("x", "so_esquerda"), ("y", "so_direita")]
    with pytest.raises(AssertionError, match="sumiu"):
        jn.assert_empty(jn.set_diff(a, b, ["c"]), "codigo que sumiu")


def test_quality_split_is_complete(spark):
    df = spark.createDataFrame([("A", "REALIZADO"), ("A", None), (None, "X")], "icao string, sit string")
    marked = ql.mark_quality(df, [("v_icao", F.col("icao").isNotNull(), "sem icao"), ("v_sit", F.col("sit").isin("REALIZADO"), "situacao")])
    good, bad = ql.split_quality(marked)
    assert good.count() == 1 and rows(bad.select("motivo_exclusao")) == [("sem icao",), ("situacao",)]
    assert tuple(ql.completeness_proof(marked).first()) == (3, 1, 2, 0)


def test_expectations_are_counted(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    observed, seen = ql.expect(df, {"positivo": F.col("x") > 0, "presente": F.col("x").isNotNull()}, "e1")
    observed.collect()
    assert seen.get == {"linhas": 3, "positivo": 2, "presente": 1}


def test_reconcile_nulls_and_missing(spark):
    a = spark.createDataFrame([(None, 5), ("x", 1)], "k string, v long")
    b = spark.createDataFrame([(None, 3), ("y", 2)], "k string, v long")
    got = {r["k"]: (r["v_a"], r["v_b"], r["v_diferenca"], r["presenca"]) for r in rc.reconcile(a, b, ["k"], ["v"], ("a", "b")).collect()}
    assert got == {None: (5, 3, 2, "ambos"), "x": (1, None, None, "so_a"), "y": (None, 2, None, "so_b")}


@pytest.mark.parametrize("scope", [["s"], []])
def test_tolerance_match_equals_brute_force(spark, scope):
    rnd = random.Random(5)
    want = [(i, rnd.choice("ab"), round(rnd.uniform(-5, 5), 2), rnd.choice([0.01, 0.05, 0.5, 3.0])) for i in range(120)]
    vals = [(rnd.choice("ab"), round(rnd.uniform(-5, 5), 2)) for _ in range(40)]
    e, v = spark.createDataFrame(want, "i int, s string, e double, tol double"), spark.createDataFrame(vals, "s string, v double")
    ok = {i for i, s, x, t in want if any((not scope or s == s2) and abs(x - y) <= t for s2, y in vals)}
    got = lambda how: {r["i"] for r in rc.match_with_tolerance(e, v, scope, "e", "tol", "v", how).collect()}
    assert got("semi") == ok and got("anti") == {w[0] for w in want} - ok


def _dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


@pytest.mark.parametrize("threshold", [0.3, 0.75, 1.0])
def test_dice_join_equals_all_pairs(spark, threshold):
    rnd = random.Random(7)
    make = lambda n: [(i, sorted(set(rnd.choices("abcdefghij", k=rnd.randint(0, 6))) | ({"the"} if i % 3 else set()))) for i in range(n)]
    left, right = make(60), make(25)
    l, r = spark.createDataFrame(left, "i int, termos array<string>"), spark.createDataFrame(right, "j int, termos array<string>")
    want = {(i, j): _dice(set(a), set(b)) for (i, a), (j, b) in itertools.product(left, right) if _dice(set(a), set(b)) >= threshold}
    got = {(x["id"], x["conhecida"]): x["semelhanca"] for x in sm.dice_join(l, "i", r, "j", threshold=threshold).collect()}
    assert got == pytest.approx(want)
    best = {x["id"]: x["conhecida"] for x in sm.best_match(l, "i", r, "j", threshold=threshold).collect()}
    assert best == {i: min((-s, j) for (i2, j), s in want.items() if i2 == i)[1] for i in {k[0] for k in want}}


@pytest.mark.parametrize("first", [1, 3, 1000])
def test_top_similar_equals_sorting(spark, first):
    rnd = random.Random(11)
    make = lambda n: [(i, sorted(set(rnd.choices("abcdefghijkl", k=rnd.randint(0, 4))))) for i in range(n)]
    left, right = make(30), make(23)
    l, r = spark.createDataFrame(left, "i int, termos array<string>"), spark.createDataFrame(right, "j int, termos array<string>")
    got = {}
    for x in sm.top_similar(l, "i", r, "j", n=4, minimum=3, first_terms=first).collect():
        got.setdefault(x["id"], []).append(x["exemplo"])
    for i, a in left:
        ranked = sorted(((-_dice(set(a), set(b)), j) for j, b in right))
        chosen = [j for s, j in ranked if s < 0][:4]
        chosen += [j for j, _ in right if j not in chosen][: max(0, 3 - len(chosen))]
        assert sorted(got[i]) == sorted(chosen)


def test_ready_answer_needs_the_same_entities_and_no_loose_number(spark):
    known = spark.createDataFrame([(1, "quantos voos cancelados em #uf", ["uf:MG"]), (2, "qual a pontualidade de #uf", ["uf:SP"])], "j int, mascarado string, entidades array<string>")
    asked = spark.createDataFrame([(1, "voos cancelados em #uf no brasil", ["uf:MG"]), (2, "voos cancelados em #uf", ["uf:SP"]), (3, "voos cancelados em #uf em 2026", ["uf:MG"]),
                                   (4, "pontualidade de #uf", ["uf:SP"]), (5, "pontualidade com chuva de #uf", ["uf:SP"]), (6, None, None)], "i int, mascarado string, entidades array<string>")
    got = {r.id: r.conhecida for r in sm.ready_answer(asked, "i", known, "j", threshold=0.5).collect()}
    assert got == {1: 1, 4: 2}


def test_top_similar_keeps_null_ids_and_ties(spark):
    rows_ = spark.createDataFrame([(None, ["a"]), (1, ["a", "b"]), (2, None), (3, [])], "i int, termos array<string>")
    ex = spark.createDataFrame([(None, ["a"]), (5, ["a"]), (7, ["b"])], "j int, termos array<string>")
    got = sorted(((r.id or 0, r.exemplo or 0) for r in sm.top_similar(rows_, "i", ex, "j", n=2).collect()))
    assert got == [(0, 0), (0, 5), (1, 0), (1, 5)]


def test_dictionary(spark):
    a = spark.createDataFrame([("SBSP", "São Paulo", "SP", "São Paulo"), ("SBPA", "Palmas", "PA", "Pará"), ("SBXX", None, None, None)], "icao string, municipio string, uf string, estado string")
    c = spark.createDataFrame([("GOL",), ("GOL",), (None,)], "marca string")
    m = spark.createDataFrame([("2025-08",), ("2026-08",), ("2025-12",)], "ano_mes string")
    alias = spark.createDataFrame([("congonhas", "aeroporto", "SBSP"), ("confins", "aeroporto", "SBCF"), ("sampa", "uf", "SP")], "apelido string, tipo string, chave string")
    got = {(r.frase, r.tipo, r.chave): r.regra for r in tg.build_dictionary(a, c, m, alias).collect()}
    assert got[("sao paulo", "uf", "SP")] == "livre" and ("sao paulo", "municipio", "São Paulo") not in got
    assert got[("para", "uf", "PA")] == "nome" and got[("pa", "uf", "PA")] == "maiuscula" and got[("palmas", "municipio", "Palmas")] == "nome"
    assert {k[2] for k in got if k[1] == "mes" and k[0] in ("agosto de 2025", "ago/2025", "ago 2025")} == {"2025-08"}
    assert ("dezembro", "mes", "2025-12") in got and not any(k[0] == "agosto" for k in got)
    assert ("congonhas", "aeroporto", "SBSP") in got and ("sampa", "uf", "SP") in got and not any(k[0] == "confins" for k in got)
    assert ("gol", "marca", "GOL") in got and ("sbxx", "aeroporto", "SBXX") in got


def test_greeting_before_a_question(spark):
    df = spark.createDataFrame([("Oi, tudo bem? Quantos voos?",), ("Bom dia! ",), ("oito voos",)], "s string")
    assert [r[0] for r in df.select(tx.without_greeting(tx.normalize_text("s"))).collect()] == ["quantos voos", "bom dia", "oito voos"]


def test_known_numbers_of_text_question_and_facts(spark):
    res = spark.createDataFrame([(1, 10.0, "ago/2025: 1,5 mil"), (1, 20.0, None)], "k int, v double, t string")
    q = spark.createDataFrame([(1, "e em 2026?")], "k int, pergunta string")
    known = an.known_numbers(res, "k", ["v"], ["t"], q, facts=spark.createDataFrame([(99999.0,)], "valor double"))
    said = spark.createDataFrame([(1, "Foram 1.500, 2026, 99.999 e 777; soma 30,0 e 45,5")], "k int, texto string")
    assert [r.valor for r in an.unsupported_numbers(said, "k", "texto", known).orderBy("valor").collect()] == [45.5, 777.0]


def test_same_question(spark):
    df = spark.createDataFrame([(["cancel", "marc"], ["cancel", "marc"]), (["marc", "tev"], ["cancel", "marc"]), (["cancel", "long", "marc"], ["cancel", "marc"])],
                               "a array<string>, b array<string>")
    assert [r[0] for r in df.select(sm.same_question("a", "b")).collect()] == [True, False, True]


def _tags(spark, text, names):
    d = spark.createDataFrame(names, "n string, k string")
    dic = tg.entity_dictionary(d, "n", F.lit("uf"), F.col("k"), tg.default_rule("n"))
    codes = tg.entity_dictionary(d, "k", F.lit("uf"), F.col("k"), tg.default_rule("k", is_code=True))
    df = spark.createDataFrame([(1, text)], "id int, t string")
    return [(r["frase"], r["chave"]) for r in tg.tag_entities(df, "id", "t", dic.unionByName(codes)).orderBy("posicao").collect()]


STATES = [("Pará", "PA"), ("Mato Grosso", "MT"), ("Mato Grosso do Sul", "MS"), ("Sergipe", "SE"), ("Minas Gerais", "MG"), ("Palmas", "TO")]


def test_entities_longest_name_and_spelling(spark):
    assert _tags(spark, "voos de Mato Grosso do Sul e mato grosso", STATES) == [("mato grosso do sul", "MS"), ("mato grosso", "MT")]
    assert _tags(spark, "qual a pontualidade para a gol", STATES) == []
    assert _tags(spark, "qual a pontualidade do Pará", STATES) == [("para", "PA")]
    assert _tags(spark, "voos do para", STATES) == [("para", "PA")]
    assert _tags(spark, "se voar em SE", STATES)[-1] == ("se", "SE") and _tags(spark, "se voar", STATES) == []
    assert _tags(spark, "voos para Palmas", STATES) == [("palmas", "TO")]


def test_entities_equal_greedy_loop(spark):
    names = ["a b", "b c d", "d e", "c", "e a b", "a"]
    rnd = random.Random(2)
    texts = [(i, " ".join(rnd.choices("abcde", k=25))) for i in range(20)]
    d = spark.createDataFrame([(n, n) for n in names], "n string, k string")
    dic = tg.entity_dictionary(d, "n", F.lit("x"), F.col("k"))
    got = {}
    for r in tg.tag_entities(spark.createDataFrame(texts, "id int, t string"), "id", "t", dic).collect():
        got.setdefault(r["id"], set()).add((r["posicao"], r["frase"]))
    for i, t in texts:
        w, used, want = t.split(), set(), set()
        for n in sorted(names, key=lambda n: (-len(n), n)):
            k = len(n.split())
            for p in range(len(w) - k + 1):
                if w[p:p + k] == n.split() and not used & set(range(p, p + k)):
                    used |= set(range(p, p + k))
                    want.add((p + 1, n))
        assert got[i] == want


def test_template_errors(spark):
    masked = [("quantos voos partiram e chegaram", [], None, "duas direções"), ("voos e chuva", [], None, 'sobrou "chuva"'), ("pontualidade e atrasos", [], None, "mais de uma medida"),
              ("de #uf", ["uf:1"], None, "sem medida"), ("taxa de pontualidade", [], None, "taxa de quê"), ("voos de #uf e #uf", ["uf:1", "uf:2"], None, "entidade repetida"),
              ("voos por mes em #mes", ["mes:1"], None, "série e mês juntos"), ("partidas para #uf", ["uf:1"], "para", "duas direções"), ("pontualidade para #uf", ["uf:1"], "para", "medida de partida com destino"),
              ("pontualidade dos voos de #uf", ["uf:1"], "de", None)]
    df = spark.createDataFrame([(i, *m[:3]) for i, m in enumerate(masked)], "i int, mascarado string, entidades array<string>, antes_do_lugar string")
    got = tg.detect_template(df).orderBy("i").collect()
    assert [r["erro"] for r in got] == [m[3] for m in masked]
    assert (got[-1]["medida"], got[-1]["serie"]) == ("otp", False)


def test_follow_ups(spark):
    data = [(1, 0, "Quantos voos partiram de SP?"), (1, 1, "e de Minas?"), (1, 2, "e quantos voos partiram de lá no mês passado inteiro?"), (1, 3, "qual o motivo disso? o mesmo mês"), (2, 5, "e a GOL?")]
    got = tg.follow_up_flags(spark.createDataFrame(data, "c int, t int, x string"), "c", "t", "x", chunk=2)
    assert {(r["c"], r["t"]): r["continua"] for r in got.collect()} == {(1, 0): False, (1, 1): True, (1, 2): False, (1, 3): True, (2, 5): False}


def test_profile_and_cuts(spark):
    df = spark.createDataFrame([("null", "x"), ("", "x"), (None, "y"), ("v", None)], "a string, b string")
    assert rows(ag.profile_nulls(df, ["a"])) == [("a", 4, 1, 1, 1, 1)]
    cuts = ag.category_cuts(df, {"b": "b"}, {"n": F.lit(1).cast("long")})
    assert rows(cuts) == [("b", "(sem valor)", 1), ("b", "x", 2), ("b", "y", 1)]


def test_graded_answers_and_planted_defects(spark):
    exp = spark.createDataFrame([(q, "a", "total", 317327.0, None) for q in range(4)] + [(q, "a", "rotulo_topo", None, "Guarulhos") for q in range(4)] + [(0, "b", "taxa", 73.79, None)],
                                "questao int, alternativa string, chave string, valor double, rotulo string")
    cells = spark.createDataFrame([(0, 73.8, None), (1, 317327.4, "GUARULHOS (SBGR)"), (2, 322327.0, "guarulhos"), (3, 317327.0, "Campinas")], "questao int, valor double, texto string")
    assert {r["questao"]: r["ok"] for r in an.grade_answers(exp, cells).collect()} == {0: True, 1: True, 2: False, 3: False}
    answers = spark.createDataFrame([
        (1, "consulta", False, False, None, 16, "317.327"), (2, "consulta", False, False, None, 16, ""), (4, "consulta", False, False, None, 0, ""),
        (5, "conversa", False, False, None, 0, "em prosa"), (6, "conversa", True, True, None, 0, "Não tenho esse dado."), (7, "conversa", True, True, None, 0, "Foram 85.452."),
        (8, None, False, False, "fora do ar", 0, ""), (9, "consulta", True, False, None, 3, "")],
        "questao int, tipo string, esperado_conversa boolean, diz_que_nao boolean, erro string, n_linhas int, texto string")
    got = {r["questao"]: (r["ok"], r["motivo"]) for r in an.verdicts(answers, an.grade_answers(exp, cells)).collect()}
    assert got[1] == (True, "") and got[2][0] is False and got[4][1] == "0 linhas" and got[5][1] == "respondeu em prosa"
    assert got[6][0] and got[7][1] == "não diz que o dado não existe" and got[8][1] == "erro: fora do ar" and got[9][1] == "virou consulta"


def test_wrong_total_is_unsupported(spark):
    res = spark.createDataFrame([(1, 147976, 10.0), (1, 169351, 20.0)], "id int, voos long, otp double")
    texts = spark.createDataFrame([(1, "Os 16 aeroportos somam 317.327 partidas, ou 322.327; cerca de 317 mil, média 15,5")], "id int, t string")
    known = an.known_numbers(res, "id", ["voos", "otp"])
    assert {r["trecho"] for r in an.unsupported_numbers(texts, "id", "t", known).collect()} == {"322.327", "15,5"}


def test_summary_refuses_totals_of_rates(spark):
    df = spark.createDataFrame([(1, "a", 1.5, 0), (1, "b", 7.0, 1), (1, "c", 7.0, 2)], "id int, r string, m double, o int")
    row = an.result_summary(df, ["id"], "r", "m", "o").first()
    assert row["total"] is None and row["maior_rotulo"] == "b" and row["menor_rotulo"] == "a" and row["ultimo_rotulo"] == "c"


def test_fill_phrase_needs_every_value(spark):
    f = lambda vals: spark.range(1).select(an.fill_phrase(F.lit("Somam {total.voos} em {n}."), vals)).first()[0]
    assert f({"total.voos": F.lit("10"), "n": F.lit("2")}) == "Somam 10 em 2." and f({"n": F.lit("2")}) is None


def test_lint(spark):
    cases = {"SELECT sum(v) FROM f LIMIT 10;": None, "": "SQL vazio", "UPDATE f SET x = 1": "não começa com SELECT", "SELECT 1; SELECT 2 LIMIT 1": "mais de um comando",
             "SELECT * FROM read_csv('x') LIMIT 5": 'usa "read_csv"', "SELECT 1": "sem LIMIT de até 100", "SELECT 1 LIMIT 101": "sem LIMIT de até 100", "WITH a AS (SELECT avg (x) FROM f) SELECT * FROM a LIMIT 3": "AVG sobre medida"}
    df = spark.createDataFrame([(k,) for k in cases], "q string")
    assert {r["q"]: r["problema"] for r in an.lint_queries(df, "q").collect()} == cases
