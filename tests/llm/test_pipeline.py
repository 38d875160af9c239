"""Each stage of the pipeline against a brute-force version of its operator, on its own input."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline as pipeline  # noqa: E402
import test_line_dedup as lines  # noqa: E402
import test_near_dedup as near  # noqa: E402
import test_packing as packing  # noqa: E402
import test_substring_dedup as passages  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs.collect()]
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        tables.append(docs.collect())
        docs = spark.createDataFrame(tables[-1], docs.schema)
    return tables


def texts(rows):
    return [(r.doc_id, r.text) for r in rows]


def worded(rows, cut):
    return sorted((d, t) for (d, t), n in zip(rows, cut) if n == 0 or re.search(r"[^\x20\x09-\x0D]", t))


def test_columns_stay(stages):
    for rows in stages[1:5]:
        assert rows and list(rows[0].asDict()) == COLUMNS and all(r.n_chars == len(r.text) for r in rows)


def test_language_id_keeps_what_has_letters(stages):
    kept = {r.doc_id for r in stages[1]}
    assert all((r.doc_id in kept) <= any(c.isalpha() for c in r.text or "") for r in stages[0])
    assert len(kept) >= 0.99 * len(stages[0])
    assert {r.doc_id: r.text for r in stages[0] if r.doc_id in kept} == dict(texts(stages[1]))


def test_line_dedup(stages):
    want = lines.brute(texts(stages[1]), 3)
    assert sorted(texts(stages[2])) == worded([r[:2] for r in want], [r[3] for r in want])


def test_near_dedup(stages):
    want = {d for d, _, _, kept in near.brute(texts(stages[2]), 80) if kept}
    assert sorted(texts(stages[3])) == sorted((d, t) for d, t in texts(stages[2]) if d in want)


def test_substring_dedup(stages):
    want = passages.brute(texts(stages[3]), 50)
    got = dict(texts(stages[4]))
    assert set(got) == {d for d, n, gone, _ in want if gone == 0 or gone < n}
    assert all(" ".join(passages.WORD.findall(got[d])) == kept for d, _, _, kept in want if d in got)


def test_packing(stages):
    n = packing.check(texts(stages[4]), stages[5], 1024)
    assert n <= -(-sum(r.length for r in stages[5]) // 1024) + 1


def test_run_gives_the_rows_of_the_stages(spark, stages):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, pipeline.run(spark, SF).collect())) == sorted(map(key, stages[5]))


def test_odd_documents(spark):
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (None, "the house\nis old\nand big", "en", "s", 1), (3, "the house\nis old\nand big", "en", "s", 1), (3, "the house\nis old\nand big", "en", "s", 1),
            (4, "12 34", "en", "s", 5), (5, "the house\nis old\nand big\nthe garden", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (docs, docs.limit(0)):
        for _, stage in pipeline.STAGES[:4]:
            docs = stage(spark, docs, SF)
            assert docs.columns == COLUMNS
        assert {r.doc_id for r in pipeline.pack_sequences(spark, docs, SF).collect()} <= {None, 3, 5}
