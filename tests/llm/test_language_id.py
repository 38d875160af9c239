"""Language identification: held-out accuracy and defined results for odd input."""

import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from skytally.llm.language_id import EVIDENCE, GRAMS, Limits, Scorer, _model, grams, identify, train
from skytally.llm.queries import QUERIES

ROWS = [(i, *p) for i, p in enumerate([("the house and the tree", "en"), ("das haus und der baum", "de"), ("la maison et les arbres", "fr")] * 12)]


def taught(spark, rows, **more):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit("x"), "kind": F.lit(1), "feature": F.lit(2), **more})


def test_odd_texts(spark):
    odd = [(100, None, "en"), (101, "", None), (102, " 12 !? ", "en"), (103, "the", None), (103, "the", None), (None, "das haus", "fr"), (104, "hausbaum " * 20_000, None), (105, "ß", None), (106, "中文", None)]
    rows = [(r.doc_id, r.held_out, r.lang_pred, r.score) for r in identify(taught(spark, ROWS + odd)).collect()]
    assert len(rows) == len(ROWS) + len(odd)
    by = {r[0]: r for r in rows}
    assert [by[i][2:] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert by[103][2] == "en" and by[None][2] == "de" and by[104][2] == "de" and by[None][1] is False
    assert all(0 <= r[3] <= 1 for r in rows)
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 4 == 2) for r in rows if r[0] is not None)


def test_labels_of_held_out_rows_and_of_the_row_itself_are_not_used(spark):
    out = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 == 2][:30]
    rows = ROWS + [(i, "the house", "xx") for i in out if i >= len(ROWS)]
    assert "xx" not in {r.lang_pred for r in identify(taught(spark, rows)).collect()}


def test_no_labels_and_empty_table(spark):
    assert [tuple(r) for r in identify(taught(spark, [(1, "a", None)])).collect()] == [(1, False, "und", 0.0)]
    assert identify(taught(spark, [])).count() == 0


def test_sample_and_languages_are_bounded(spark):
    rows = [(i, " ".join(chr(97 + (i * k) % 26) * (k % 9 + 1) for k in range(40)), f"l{i % 5}") for i in range(200)]
    model = train(taught(spark, rows), Limits(sample=20, languages=3))
    assert len(model.languages) == 3


def test_training_equals_loops(spark):
    """Every word and n-gram of every labelled row, counted and scored."""
    r = random.Random(9)
    rows = [(i, r.choice([None, "", *(" ".join(r.choice(["Ab", "abc", "né", "中文", "x-y", "q1r", "zzzzzz"]) for _ in range(r.randint(1, 9))) for _ in range(5))]), r.choice([None, "a", "b", "c"])) for i in range(120)]
    model, counts = train(taught(spark, rows)), {}
    for _, text, lang in rows:
        for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if lang else []:
            for kind, f in [(0, w), *((n, g) for n in GRAMS for g in grams(w, n))]:
                counts.setdefault((kind, f), dict.fromkeys("abc", 0))[lang] += 1
    assert model.languages == ["a", "b", "c"] and {(k, f) for k, t in model.tables.items() for f in t} == set(counts)
    size = {k: len(t) for k, t in model.tables.items()}
    seen = {(k, x): sum(c[x] for (j, _), c in counts.items() if j == k) for k in size for x in "abc"}
    for (k, f), c in counts.items():
        want = [math.log((c[x] + 0.5) / (seen[k, x] + 0.5 * size[k])) for x in "abc"]
        assert list(model.scores[model.tables[k][f]]) == pytest.approx(want)


def test_every_label_is_learned(spark):
    teach = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 != 2]
    name = lambda k: "".join("abcdefghijklmnop"[k >> s & 15] for s in (4, 0))
    rows = [(teach[4 * k + j], f"qu{name(k)} zu{name(k)}x " * 5, f"l{k}") for k in range(100) for j in range(1 if k < 20 else 3)]
    assert len(train(taught(spark, rows)).languages) == 100
    assert all(r.lang == r.lang_pred and r.score > 0.5 for r in identify(taught(spark, rows)).join(taught(spark, rows).select("doc_id", "lang"), "doc_id").collect())


def test_backs_off_to_shorter_grams():
    model = _model([("a", 0, "known", 9), ("b", 0, "other", 9), ("a", 3, "ing", 5), ("b", 3, "xyz", 5), ("b", 1, "q", 5), ("a", 1, "z", 1)])
    score = Scorer(model)
    assert [x[0] for x in score.texts(["known", "running", None, "qqqq", "12"])] == ["a", "a", "und", "b", "und"]
    assert score.texts(["ééé"]) == [("a", 0.5)]  # nothing known: a tie
    assert grams("ab", 3) == ["_ab", "ab_"] and grams("ab", 1) == ["a", "b"] and Scorer(_model([])).texts(["a", None]) == [("und", 0.0)] * 2


def test_batches_and_memory_do_not_change_scores(monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    model = _model([(lang, k, g, rng.randint(1, 9)) for lang in "xyz" for k in (0, 1, 2, 3) for g in {w[:k] if k else w for w in rng.sample(words, 60)}])
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(60)]
    whole = Scorer(model).texts(texts)

    def plain(text):
        """One word at a time, straight from the definition."""
        total, found = [0.0] * 3, text.split()
        for w in found:
            rows = [model.tables[0][w]] if w in model.tables[0] else next((r for n in GRAMS if (r := [model.tables[n][g] for g in grams(w, n) if g in model.tables[n]])), [])
            total = [t + (sum(model.scores[i][k] for i in rows) / len(rows) if rows else 0) for k, t in enumerate(total)]
        total = [t * min(len(found), EVIDENCE) / max(1, len(found)) for t in total]
        return sum(math.exp(t - max(total)) for t in total)

    assert all(s == pytest.approx(1 / plain(t)) for t, (lang, s) in zip(texts, whole) if lang != "und")
    monkeypatch.setattr("skytally.llm.language_id._REMEMBERED", 5)
    few = Scorer(model)
    assert [r for t in texts for r in few.texts([t])] == [(lang, pytest.approx(s)) for lang, s in whole]


def test_blocks_do_not_change_scores(monkeypatch):
    rng = random.Random(4)
    model = _model([(lang, 0, w, rng.randint(1, 9)) for lang in "vwxyz" for w in rng.sample("abcdefghijklmnop", 9)] + [("v", 2, "_q", 3), ("w", 2, "q_", 1), ("w", 1, "q", 1)])
    texts = [" ".join(rng.choices("abcdefghijklmnopq", k=rng.randint(0, 50))) for _ in range(40)]
    whole = Scorer(model).texts(texts)
    monkeypatch.setattr("skytally.llm.language_id._AT_ONCE", 7)
    assert Scorer(model).texts(texts) == [(lang, pytest.approx(s)) for lang, s in whole]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op8_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


@pytest.mark.parametrize("word", ["", "a"])
def test_grams_of_short_words(word):
    assert grams(word, 5) == []
