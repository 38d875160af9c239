"""Derived records: links, digests, text, and the files' round trip."""

import hashlib
import time
import html as entities

import pytest
from pyspark.sql import functions as F

from skytally.llm.warc import RECORD, derive, plain_text, read, responses, write

PAGES = [
    (1, "http://a.example/x", "<html><head><title>T &amp; U</title><style>p{}</style></head><body><p>One<br>two <b>bold</b></p><script>var a='</p>';</script><!-- no --><div>Last</div></body></html>"),
    (2, None, ""), (3, "http://b.example/", None), (4, "http://c.example/", "plain é 中 &#233;&#x4e2d;&nbsp;&unknown; & &lt;b&gt; &#0; &#xD800;"), (4, "http://c.example/", "twice"),
    (None, None, "<p>x<p>y<script>never closed"), (5, "u", "w " * 50_000),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({"type": F.lit("x"), "block": F.lit(1), "text": F.lit(2), "record_id": F.lit("q")})


def sha(x):
    return "sha256:" + hashlib.sha256(x.encode()).hexdigest()


def test_links_and_digests(pages):
    source = {r.record_id: r for r in responses(pages).collect()}
    got = derive(responses(pages)).collect()
    assert len(got) == 2 * len(PAGES)
    for meta in (r for r in got if r.type == "metadata"):
        r = source[meta.refers_to]
        fields = dict(x.split(": ", 1) for x in meta.block.split("\r\n") if x)
        assert meta.target_uri == r.target_uri and meta.date == r.date and meta.block_digest == sha(meta.block)
        assert fields["source-status"] == "HTTP/1.1 200 OK" and fields["source-header-Content-Type"] == "text/html; charset=utf-8"
        texts = [t for t in got if t.record_id == fields["conversion-id"]]
        assert texts and all(t.refers_to == meta.refers_to and t.concurrent_to == meta.record_id for t in texts)
        assert fields["conversion-digest"] in {t.block_digest for t in texts} and fields["source-block-digest"].startswith("sha256:")
    for t in (r for r in got if r.type == "conversion"):
        assert t.block_digest == t.payload_digest == sha(t.block)


def test_other_records_and_broken_blocks(spark):
    rows = [("<a>", "request", "x\r\n\r\ny"), ("<b>", "response", None), ("<c>", "response", "no header"), ("<d>", "response", "HTTP/1.1 404\r\n\r\n<p>gone"), (None, None, None),
            ("<e>", "response", "HTTP/1.1 200 OK\nA: b\nC: d\n\none\r\n\r\ntwo"), ("<f>", "response", "HTTP/1.1 200 OK\r\nA: b"), ("<g>", "response", "<p>plain\n\npayload")]
    df = spark.createDataFrame(rows, "record_id string, type string, block string")
    df = df.withColumns({c: F.lit(None).cast("string") for c in RECORD if c not in df.columns})
    got = {r.refers_to: r for r in derive(df).where("type = 'conversion'").collect()}
    assert {k: v.block for k, v in got.items()} == {"<b>": "", "<c>": "no header", "<d>": "gone", "<e>": "one two", "<f>": "", "<g>": "plain payload"}
    meta = {r.refers_to: r.block for r in derive(df).where("type = 'metadata'").collect()}
    assert "source-header-A: b\r\nsource-header-C: d\r\n" in meta["<e>"] and meta["<f>"].endswith("source-header-A: b\r\n") and "source-status: \r\n" in meta["<g>"]


@pytest.mark.parametrize("unit,rest", [("<a", 1), ("<!--", 0), ("&", 1), ("<script", 1), ("<div ", 1), ("<b> ", 0), (" \n", 0), ("a  ", 1), ("<style>", 0), ("</p", 1)])
def test_broken_pages_take_time_in_proportion(spark, unit, rest):
    df = spark.createDataFrame([(unit * (1_000_000 // len(unit)),)], "t string")
    start = time.monotonic()
    n = df.select(F.length(plain_text(F.col("t")))).first()[0]
    assert time.monotonic() - start < 20 and (n > 300_000) == bool(rest)


def test_text(spark):
    cases = {
        PAGES[0][2]: "T & U\nOne\ntwo bold\nLast", "a<!-- x": "a", "<p>x<script>y": "x", "": "", " \n ": "", "1 < 2 &amp;amp; 3": "1 < 2 &amp; 3",
        "a<span>b</span>c<p>d</p>e": "abc\nd\ne", "<a href='x>y'>z</a>": "y'>z", "x <b y<i>z</i>": "x <b yz", "&eacute;&hellip;": "é…",
    }
    df = spark.createDataFrame(list(cases.items()), "html string, want string")
    assert [r.t for r in df.select(plain_text(F.col("html")).alias("t"), "want").collect()] == list(cases.values())


def test_references_equal_the_standard_library(spark):
    texts = [f"x&{n};y" for n in ("amp", "eacute", "NotEqualTilde", "#65", "#x41", "#X1F600", "bogus", "#xZ", "", "#1114112")] + ["&", "a&b", "&&amp;", "&amp"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.t for r in df.select(plain_text(F.col("t")).alias("t")).collect()]
    want = [t if t.endswith("&amp") or "1114112" in t else entities.unescape(t) for t in texts]
    assert got == want


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip(spark, pages, tmp_path, compression):
    records = responses(pages).unionAll(derive(responses(pages)))
    write(records, str(tmp_path / "out"), compression=compression)
    key = lambda rows: sorted(str(tuple(r)) for r in rows)
    assert key(read(spark, str(tmp_path / "out")).collect()) == key(records.collect())


def test_empty_table(spark):
    assert derive(responses(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0
