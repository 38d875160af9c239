"""Language identification: known words by their log frequency, unseen words by ever shorter character n-grams."""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import bounded

WORD = regex.compile(r"\p{L}+")
UNDETERMINED = "und"
#: Lengths of the n-grams, longest first; a word has a mark before and after it.
GRAMS = (5, 4, 3, 2, 1)
#: Words that weigh in a score: a longer text is scored as so many average words.
EVIDENCE = 20
_REMEMBERED = 100_000
#: Kind of a word of which a model has no part.
UNKNOWN = max(GRAMS) + 1
#: Scores of words in languages, and of texts in languages, that are added at once.
_AT_ONCE = 1 << 20


class Limits(NamedTuple):
    """Bounds of a model: rows sampled of each language, and languages (None: all). Every entry of a sampled row is kept."""

    sample: int = 500
    languages: int | None = None


def grams(word: str, n: int) -> list[str]:
    marked = f"_{word}_"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


_COUNTED = "lang string, kind int, feature string, c long"


def _rows(found: dict[tuple[str, int], Counter]) -> pa.RecordBatch:
    rows = [(lang, n, f, c) for (lang, n), seen in found.items() for f, c in seen.items()]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)], ["lang", "kind", "feature", "c"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a batch, as kind 0."""
    for batch in batches:
        found: dict[tuple[str, int], Counter] = defaultdict(Counter)
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            found[lang, 0].update(WORD.findall(text.as_py().lower()))
        yield _rows(found)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams of counted words, as kind n."""
    for batch in batches:
        found: dict[tuple[str, int], Counter] = defaultdict(Counter)
        for lang, word, c in zip(*(batch.column(x).to_pylist() for x in ("lang", "feature", "c"))):
            for n in GRAMS:
                for g in grams(word, n):
                    found[lang, n][g] += c
        yield _rows(found)


class Scores:
    """Log frequencies, sparse: an entry counted c times in a language has log(2c + 1) above the ``base`` of its kind.

    ``langs`` and ``above`` of entry i stand from ``starts[i]`` to ``starts[i + 1]``; elsewhere it has the base.
    """

    def __init__(self, kinds: np.ndarray, starts: np.ndarray, langs: np.ndarray, above: np.ndarray, base: np.ndarray):
        self.kinds, self.starts, self.langs, self.above, self.base = kinds, starts, langs, above, base

    def __len__(self) -> int:
        return len(self.kinds)

    def __getitem__(self, i: int) -> np.ndarray:
        """One score for each language."""
        row = self.base[self.kinds[i]].copy()
        own = slice(self.starts[i], self.starts[i + 1])
        row[self.langs[own]] += self.above[own]
        return row

    def flat(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``langs`` and ``above`` of all these entries, one after the other, and how many each has."""
        n = self.starts[entries + 1] - self.starts[entries]
        return np.repeat(self.starts[entries] - (np.cumsum(n) - n), n) + np.arange(n.sum()), n

    def more(self, kinds: np.ndarray, sizes: np.ndarray, langs: np.ndarray, above: np.ndarray) -> Scores:
        """With further entries behind."""
        join = np.concatenate
        return Scores(join([self.kinds, kinds]), join([self.starts, self.starts[-1] + np.cumsum(sizes)]), join([self.langs, langs]), join([self.above, above]), self.base)


class Model(NamedTuple):
    """Languages in order; ``scores``: log frequencies in each language for each entry of the tables.

    tables[0] has the words, tables[n] the n-grams.
    """

    languages: list[str]
    tables: dict[int, dict[str, int]]
    scores: Scores


def train(labelled: DataFrame, limits: Limits = Limits()) -> Model:
    """Model from rows (doc_id, text, lang); rows without lang or text teach nothing.

    Every label is learned, unless ``languages`` keeps the most frequent ones alone. About ``sample`` rows of each
    language are counted, chosen by the hash of their doc_id; all their words and n-grams are kept. So the sample bounds what a
    language adds to the model whatever the input, and the model's size follows the number of languages.
    No labelled row: a model that knows no language.
    """
    bounded(labelled)
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").count()
    if limits.languages is not None:
        sizes = sizes.orderBy(F.desc("count"), "lang").limit(limits.languages)
        rows = rows.where(F.col("lang").isin([r["lang"] for r in sizes.collect()]))
    # Smaller languages teach with all of their rows, so the plan holds the large ones alone.
    large = [x for r in sizes.where(F.col("count") > limits.sample).collect() for x in (r["lang"], limits.sample / r["count"])]
    if large:
        share = F.coalesce(F.create_map(*map(F.lit, large))[F.col("lang")], F.lit(1.0))
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30) < share)
    total = lambda df: df.groupBy("lang", "kind", "feature").agg(F.sum("c").alias("c"))
    counted = total(rows.mapInArrow(_words, _COUNTED))
    counted = counted.unionAll(total(counted.mapInArrow(_grams, _COUNTED)))
    batches = counted.select("lang", "kind", "feature", "c").toArrow().to_batches()
    return _model(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))


def _model(rows: Iterable[tuple[str, int, str, int]]) -> Model:
    at: dict[str, int] = {}
    tables: dict[int, dict[str, int]] = {k: {} for k in (0, *GRAMS)}
    kinds, entry, lang, count = array("b"), array("q"), array("q"), array("q")
    for x, kind, feature, c in rows:
        i = tables[kind].setdefault(feature, len(kinds))
        if i == len(kinds):
            kinds.append(kind)
        entry.append(i)
        lang.append(at.setdefault(x, len(at)))
        count.append(c)
    languages = sorted(at)
    rank = np.zeros(len(at), np.int64)
    rank[[at[x] for x in languages]] = np.arange(len(at))
    kinds, entry, count = np.array(kinds, np.int64), np.array(entry, np.int64), np.array(count, np.float64)
    lang = rank[np.array(lang, np.int64)]
    order = np.lexsort((lang, entry))
    starts = np.concatenate(([0], np.cumsum(np.bincount(entry, minlength=len(kinds))))).astype(np.int64)
    seen = np.bincount(kinds[entry] * len(at) + lang, count, (max(GRAMS) + 1) * len(at)).reshape(max(GRAMS) + 1, len(at))
    sizes = np.array([max(1, len(tables[k])) for k in range(max(GRAMS) + 1)])[:, None]
    scores = Scores(kinds, starts, lang[order], np.log(2 * count[order] + 1), np.log(0.5 / (seen + 0.5 * sizes)))
    return Model(languages, tables, scores)


class Scorer:
    """Scores batches of texts; unseen words are scored once and remembered while there is room."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.index, self.rows = dict(self.model.tables[0]), self.model.scores

    def _parts(self, word: str) -> list[int]:
        """Entries of the longest n-grams of an unseen word that the model has."""
        for n in GRAMS:
            get = self.model.tables[n].get
            if found := [i for g in grams(word, n) if (i := get(g)) is not None]:
                return found
        return []

    def _learn(self, unseen: list[str]) -> None:
        """A word's score is the mean of its parts': one base, and for each language what they have above it."""
        parts = [self._parts(w) for w in unseen]
        n = np.array([len(p) for p in parts])
        flat, many = self.model.scores, len(self.model.languages)
        every = np.fromiter(chain.from_iterable(parts), np.int64, int(n.sum()))
        at, size = flat.flat(every)
        word = np.repeat(np.repeat(np.arange(len(unseen)), n), size)
        keys, same = np.unique(word * many + flat.langs[at], return_inverse=True)
        above = np.bincount(same, flat.above[at] / n[word], len(keys))
        kinds = np.full(len(unseen), UNKNOWN)
        kinds[n > 0] = flat.kinds[every[(np.cumsum(n) - n)[n > 0]]]
        self.index.update(zip(unseen, range(len(self.rows), len(self.rows) + len(unseen))))
        self.rows = self.rows.more(kinds, np.bincount(keys // many, minlength=len(unseen)), keys % many, above)

    def _totals(self, words: np.ndarray, n: np.ndarray) -> Iterator[np.ndarray]:
        """Summed scores of texts of ``n`` words each, some texts at a time: sums over a text do not depend on the others."""
        rows, many = self.rows, len(self.model.languages)
        ends = np.cumsum(n)
        sizes = np.concatenate(([0], np.cumsum(rows.starts[words + 1] - rows.starts[words])))
        a = 0
        while a < len(n):
            first = ends[a] - n[a]
            fit = int(np.searchsorted(sizes[ends], sizes[first] + _AT_ONCE, "right"))
            b = max(a + 1, min(fit, a + max(1, _AT_ONCE // many)))
            own, text = words[first : ends[b - 1]], np.repeat(np.arange(b - a), n[a:b])
            kinds = np.bincount(text * (UNKNOWN + 1) + rows.kinds[own], minlength=(b - a) * (UNKNOWN + 1)).reshape(b - a, UNKNOWN + 1)
            total = np.zeros((b - a, many))
            for k in range(UNKNOWN):
                total += kinds[:, k, None] * rows.base[k]
            at = 0
            while at < len(own):  # more than once for a long text alone
                stop = max(at + 1, int(np.searchsorted(sizes, sizes[first + at] + _AT_ONCE, "right")) - 1 - first)
                flat, size = rows.flat(own[at:stop])
                total += np.bincount(np.repeat(text[at:stop], size) * many + rows.langs[flat], rows.above[flat], total.size).reshape(total.shape)
                at += len(own[at:stop])
            yield total
            a = b

    def texts(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, its share of the evidence between 0 and 1) of each text."""
        found = [WORD.findall((t or "").lower()) for t in texts]
        n = np.array([len(f) for f in found])
        if not self.model.languages or not n.any():
            return [(UNDETERMINED, 0.0)] * len(found)
        words = list(chain.from_iterable(found))
        if unseen := sorted(set(words) - self.index.keys()):
            self._learn(unseen)
        n = n[n > 0]
        known, done = [], 0
        for total in self._totals(np.fromiter(map(self.index.__getitem__, words), np.int64, len(words)), n):
            own = n[done : done + len(total)]
            total *= (np.minimum(own, EVIDENCE) / own)[:, None]
            share = np.minimum(1.0, 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1))
            known += zip(total.argmax(axis=1).tolist(), share.tolist())
            done += len(total)
        if len(self.index) > len(self.model.tables[0]) + _REMEMBERED or len(self.rows.above) > len(self.model.scores.above) + 8 * _REMEMBERED:
            self._forget()
        rest = iter(known)
        return [(UNDETERMINED, 0.0) if not f else (self.model.languages[i], s) for f in found for i, s in ([next(rest)] if f else [(0, 0.0)])]


def language(text: Column, df: DataFrame, model: Model) -> Column:
    """struct(lang string, score double) of each text.

    Words are runs of letters, lower-cased. A word of the model scores its log frequency in each language; any
    other the mean of its longest n-grams that the model has. Null text and text without a letter: ``und``, 0. A
    tie goes to the language that sorts first. Every row is scored by its whole text alone, so repeated rows
    agree and an empty table gives an empty result.
    """
    sent = bounded(df).sparkSession.sparkContext.broadcast(model)

    # A scorer lives as long as its task: a worker that goes on to other work lets the model go.
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value)
        for texts in batches:
            yield pd.DataFrame(scorer.texts(texts.tolist()), columns=["lang", "score"])

    # Not deterministic to the optimizer: else it runs once more in every filter that reads its result.
    return F.pandas_udf(scored, "lang string, score double").asNondeterministic()(text)


def held_out(doc_id: Column) -> Column:
    """Documents whose crc32 modulo 4 is 2 never teach; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs`` (doc_id, text, lang), taught by its other rows.

    ``lang`` is read in training alone, ``doc_id`` to hold rows out and to choose the sample. Other columns are
    not read.
    """
    docs = docs.select("doc_id", "text", "lang")
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), limits)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language(F.col("text"), docs, model).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
