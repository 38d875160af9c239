"""Quality rules: counts against plain loops, the line rules by hand."""

import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import compare
from skytally.llm import checks, quality_rules
from skytally.llm.quality_rules import MARKS, Rules, clean_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(doc, text):
    w = WORD.findall(text or "")
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeat = {k for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(repeat) > 20 * len(w)
    return doc, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text or ""), len(lines) - len(set(lines)), len(repeat), failed


def some():
    r = random.Random(5)
    out = []
    for i in range(80):
        words = [r.choice("a b c dd é 中文 x. #y |".split()) for _ in range(r.randint(0, 60))]
        out.append((i, "".join(w + r.choice([" ", "\n", "  ", "\t", "\n\n"]) for w in words)))
    return out


ODD = [(100, None), (101, ""), (102, " \n\t\n"), (103, "word"), (103, "word"), (None, "a b c d e f g h i j k."), (104, "z " * 30_000), (105, "w" * 200_000), (106, "a b c d e a b c d e"), (107, "😀 b c d e f g h i j. ")]


def test_counts_equal_loops(spark):
    rows = some() + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("words", "lines", "good", "h", "pairs", "at", "kept")})
    got = clean_lines(df).collect()
    want = sorted((brute(*r) for r in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == want
    assert all(r.kept in (True, False) and not (r.kept and r.base_failed) for r in got)
    assert {r.doc_id: r.text for r in got}[100] is None


PROSE = "This is a line of plain prose that ends well."


@pytest.mark.parametrize(
    "line,stays",
    [
        (PROSE, True), ("He said “yes.”", True), ("No end of a sentence here", False), ("Two sentences. The second is cut", True), ("Home | News | About | Contact.", False),
        ("All rights reserved. Copyright 2020.", False), ("Buy! now! or! never! get! it! all! here!", False), ("Dr. No.", True), ("It rose 5% in a year.", True), ("The*** end$$$ of%%% all&&& good### things.", False), ("a / b.", True), ("你好。", True),
    ],
)
def test_lines(docs, line, stays):
    row = clean_lines(docs([(1, f"{PROSE}\n\n{line}")])).first()
    assert row.text == (f"{PROSE}\n{line}" if stays else PROSE)


@pytest.mark.parametrize(
    "line,stays",
    [
        ("यह एक साफ वाक्य है।", True), ("هل هذا سطر نظيف؟", True), ("یہ ایک صاف سطر ہے۔", True), ("Սա մաքուր տող է։", True), ("ይህ ንጹህ መስመር ነው።", True), ("នេះជាបន្ទាត់ស្អាត។", True), ("यह एक वाक्य", False),
        ("It was the blog in question.", True), ("There was widespread more or less.", True), ("We like the design in this house.", True), ("A solar-powered by-pass.", True), ("It is solar-powered by day.", True), ("Most subscribe tonight.", True),
        ("Please log in.", False), ("Read more.", False), ("Sign in to go on.", False), ("Powered by wind.", False), ("Our terms of services.", False), ("Name© stays here.", False), ("Name(c) 2020.", False), ("(Log in)|Help.", False),
    ],
)
def test_marks_of_all_scripts_and_whole_phrases(docs, line, stays):
    row = clean_lines(docs([(1, f"{PROSE}\n{line}")])).first()
    assert row.text == (f"{PROSE}\n{line}" if stays else PROSE)


def test_every_mark_ends_a_sentence(docs):
    rows = [(i, f"a line that ends{c}{q}") for i, (c, q) in enumerate([(c, q) for c in MARKS for q in ("", "”)")] + [("x", ""), ("x", '"'), (" )", ""), (" ", "”"), (",", "")])]
    got = {r.doc_id: r.text for r in clean_lines(docs(rows)).collect()}
    assert len(MARKS) > 150 and [i for i, _ in rows if not got[i]] == [i for i, _ in rows[2 * len(MARKS) :]]


@pytest.mark.parametrize(
    "text,stays",
    [
        ("The first line of a wrapped sentence\ngoes on here and ends.", 2),
        ("The first line of a wrapped sentence\n\ngoes on here and ends.", 1),  # an empty line ends the paragraph
        ("One two three four five\nSix seven eight nine ten.", 1),  # the next line starts anew
        ("Home and news\nand more things.", 1),  # too short to be wrapped
        ("यह एक लंबा वाक्य है जो\nअगली पंक्ति में समाप्त होता है।", 2),
        ("ภาษาไทย ไม่มี เครื่องหมาย จบ ประโยค", 1),
        ("One two three four five\n- six seven.", 1),
    ],
)
def test_wrapped_lines_and_scripts_without_marks(docs, text, stays):
    assert len((clean_lines(docs([(1, text)])).first().text or "").splitlines()) == stays


def test_equals_sql_where_marks_and_borders_matter(spark, docs):
    lines = [f"some words of it{c}" for c in MARKS] + [
        "Please log in.", "The blog in question.", "Solar-powered by day.", "sign in", "Sign in to go.", "design in here.", "our terms of services.", "terms of serviced.", "x-read more.", "--read more.", "read more-", "read more-x.",
        "(c) 2020.", "©", "ends “here.”)", "one two three four five", "and goes on", "", "ภาษาไทย ไม่มี เครื่องหมาย", "a | b | c.", "x# y$ z%.", "No! No! No! No! No! No! No! No!", "Cap two three four five",
    ]
    r = random.Random(2)
    rows = some() + [x for x in ODD if x[0] not in (103, 104)] + [(1000 + i, "\n".join(r.choice(lines) for _ in range(r.randint(1, 8)))) for i in range(1500)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = clean_lines(docs([x for x in rows if x[0] is not None])).drop("lost", "text")
    assert compare(got, con, checks.quality(Rules(), quality_rules).replace("FROM b", "FROM b WHERE doc_id IS NOT NULL")) == ""
    assert 50 < got.where("kept").count() < 1500


def test_document_that_loses_too_much_goes(docs):
    junk = "\n".join(f"link{i} | more{i} | again{i}" for i in range(20))
    own = "\n".join(" ".join(f"{w}{i}" for w in "these words are all different".split()) + "." for i in range(9))
    got = {r.doc_id: r for r in clean_lines(docs([(1, own), (2, own + "\n" + junk), (3, junk)])).collect()}
    assert got[1].kept and got[1].lost == 0 and not got[2].base_failed and not got[2].kept and got[2].lost > Rules().lost and got[3].text == ""


def test_empty_table(docs):
    assert clean_lines(docs([])).count() == 0
