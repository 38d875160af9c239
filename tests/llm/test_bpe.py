"""Ids against the tokenizers library, and the round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skytally.llm.bpe import Bpe, decode, encode
from skytally.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRUE = Tokenizer.from_file(PATH)
SMALL = Bpe(open(PATH, encoding="utf-8").read(), leaf=7)
WIDE = Bpe(open(PATH, encoding="utf-8").read())


def true_ids(text):
    return TRUE.encode(text or "", add_special_tokens=False).ids


def ids(raw):
    return np.frombuffer(raw, np.uint32).tolist()


PIECES = ["the", " the", "  ", "\n", "\n\n", " \n ", "é", "中文", "中", "'s", "'re", "don't", "12", "3", "!!", "--", " -", " ", "　", "a", "aaaa", "ab", "ing", "😀", "ß", "\x1c", "<|endoftext|>", "<|endof", "|>", "٣", "ⅷ", "é"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=60).map("".join))
def test_halves_join_exactly(text):
    assert ids(SMALL.encode(text)) == true_ids(text)
    assert ids(WIDE.encode(text)) == true_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert ids(SMALL.encode(text)) == true_ids(text)
    assert SMALL.decode(SMALL.encode(text)) == text == TRUE.decode(true_ids(text), skip_special_tokens=False)


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyz", "中文字母", "0123456789", "éàb", "-!", " ", "\n \t", "a", "e"])
def test_long_unsplit_stretch(letters):
    r = random.Random(letters)
    for n in (100, 1000, 20_000):
        text = "".join(r.choice(letters) for _ in range(n))
        assert ids(SMALL.encode(text)) == true_ids(text)


def test_decode_of_broken_bytes():
    for raw in ([222], [160, 222, 64], [40, 50256, 222, 220]):
        assert SMALL.decode(np.array(raw, np.uint32).tobytes()) == TRUE.decode(raw, skip_special_tokens=False)


ROWS = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "two words"), (4, "x" * 3000), (5, "le mot <|endoftext|> fin " * 60), (6, "word, " * 500), (7, "\n\n  a " * 300)]


@pytest.mark.parametrize("spread,part", [(1 << 20, 1 << 18), (200, 90)])
def test_encode_and_decode(docs, spread, part):
    coded = encode(docs(ROWS), PATH, leaf=50, spread=spread, part=part)
    want = sorted(((d, true_ids(t)) for d, t in ROWS), key=str)
    assert sorted(((r.doc_id, ids(r.ids)) for r in coded.collect()), key=str) == want
    back = decode(coded, PATH)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(((d, t or "") for d, t in ROWS), key=str)


def test_empty_table(docs):
    assert encode(docs([]), PATH).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        t = true_ids(r.text)
        want.append((r.doc_id, len(t), hashlib.sha256(np.array(t, "<u4").tobytes()).hexdigest(), hashlib.sha256(TRUE.decode(t, skip_special_tokens=False).encode()).hexdigest()))
    df = QUERIES["op4_bpe"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)
