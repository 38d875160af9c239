"""How the sources of a language differ: smoothed term shares, distances of all pairs of sources, overused terms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import spread, stored
from .frames import bounded

#: Bytes of terms to themselves in lower case, all others to a space: a term is a run of ASCII letters and non-ASCII characters.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_RUN = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
#: Entries of a block in memory (about 250 bytes each), rows of an emitted batch, bytes of a text counted at a time.
BLOCK_ENTRIES, RUN_ROWS, PIECE_BYTES = 1_000_000, 20_000, 1 << 20
#: Cells of a matrix of pairs held by a task.
PAIR_CELLS = 1 << 20
UNIT = 1_000_000_000


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, about a megabyte at a time, never cut inside a term."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE_BYTES) if len(data) - at > PIECE_BYTES else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class _Block:
    """Postings of one block: occurrences and documents of each term, by language and source."""

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.entries = 0

    def add(self, lang: str, source: str, text: str | None) -> None:
        if (lang, source) not in self.groups:
            self.groups[lang, source] = Counter({b"": 0}), Counter()  # the empty term marks a group that occurs
            self.entries += 1
        n, docs = self.groups[lang, source]
        before, own = len(n), set()
        for terms in _pieces((text or "").encode().translate(_TERM_BYTES)):
            n.update(terms)
            own.update(terms)
        docs.update(own)
        self.entries += len(n) - before

    def run(self) -> Iterator[pa.RecordBatch]:
        """The block as a run sorted by language, term and source, in bounded batches; the block is empty afterwards."""
        parts = []
        for (lang, source), (n, docs) in self.groups.items():
            same = lambda v: pa.repeat(pa.scalar(v, pa.string()), len(n))  # noqa: B023, E731
            of = pa.array(list(map(docs.__getitem__, n)), pa.int64())
            parts.append(pa.Table.from_arrays([same(lang), pa.array(list(n), pa.binary()).cast(pa.string()), same(source), pa.array(list(n.values()), pa.int64()), of], schema=_RUN))
        if parts:
            yield from pa.concat_tables(parts).sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")]).to_batches(RUN_ROWS)
        self.__init__()


def _blocks(entries: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for b in batches:
            for lang, source, text in zip(*(b[c].to_pylist() for c in ("lang", "source", "text"))):
                block.add(lang or "", source or "", text)
                if block.entries >= entries:
                    yield from block.run()
        yield from block.run()

    return index


def frequencies(docs: DataFrame, entries: int = BLOCK_ENTRIES) -> DataFrame:
    """lang, term, source, n (occurrences), docs (documents): one row each, and a row of the empty term for each group.

    One pass over the documents. A task indexes blocks in memory; a full block leaves as a run sorted by term. Runs are dealt to
    shards by the hash of language, term and source; in a shard Spark's external sort merges them (spilled runs through a heap) and equal
    neighbours are added. A frequent term sends one row for each block and source, whatever its occurrences.
    """
    runs = bounded(spread(docs.select("lang", "source", "text"))).mapInArrow(_blocks(entries), "lang string, term string, source string, n long, docs long")
    key = ["lang", "term", "source"]
    merged = runs.repartition(*key).sortWithinPartitions(*key).groupBy(*key).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return stored(merged, "frequencies")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 terms)), exact: the product leaves 64 bits beyond 9 billion occurrences."""
    wide = lambda c: c.cast("decimal(20,0)")
    top, base = (wide(n) + 5) * F.lit(UNIT).cast("decimal(10,0)"), wide(total) + 5 * wide(terms)
    return F.when(base > 0, F.call_function("div", top, base) + 1)


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For postings (lang, list of source, p, b): lang, source, item and the sum of |p-p'| - |p-b'| - |b-p'| + |b-b'| over shared terms.

    Both orders of a pair come out. Sums of a language are kept in a matrix of at most ``PAIR_CELLS`` cells, which leaves when the sources
    of a further term do not fit; a term of more sources is worked in tiles.
    """
    side = int(PAIR_CELLS**0.5)
    held: dict[str, tuple[dict, np.ndarray]] = {}

    def out(lang: str, a: list, b: list, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        i, j = np.nonzero(sums)
        keep = np.asarray([a[x] != b[y] for x, y in zip(i, j)], bool)
        for at in range(0, len(i), RUN_ROWS):
            x, y = i[at : at + RUN_ROWS][keep[at : at + RUN_ROWS]], j[at : at + RUN_ROWS][keep[at : at + RUN_ROWS]]
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * len(x), pa.string()), "source": pa.array([a[k] for k in x], pa.string()), "item": pa.array([b[k] for k in y], pa.string()), "value": pa.array(sums[x, y])}
            )

    def cells(p: np.ndarray, b: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        p, b = p[:, None], b[:, None]
        return np.abs(p - q) - np.abs(p - c) - np.abs(b - q) + np.abs(b - c)

    for batch in batches:
        for lang, postings in zip(batch["lang"].to_pylist(), batch["postings"]):
            sources = postings.values.field("source").to_pylist()
            p, b = (postings.values.field(k).to_numpy() for k in ("p", "b"))
            if len(sources) > side:
                for r in range(0, len(sources), side):
                    for s in range(0, len(sources), side):
                        yield from out(lang, sources[r : r + side], sources[s : s + side], cells(p[r : r + side], b[r : r + side], p[s : s + side], b[s : s + side]))
                continue
            if lang not in held and sum(m.size for _, m in held.values()) > PAIR_CELLS:
                for k, (of, sums) in held.items():
                    yield from out(k, list(of), list(of), sums)
                held.clear()
            of, sums = held.get(lang, ({}, np.zeros((0, 0), np.int64)))
            new = [s for s in sources if s not in of]
            if len(of) + len(new) > side:
                yield from out(lang, list(of), list(of), sums)
                of, sums, new = {}, np.zeros((0, 0), np.int64), sources
            if new:
                of |= {s: len(of) + k for k, s in enumerate(new)}
                sums = np.pad(sums, (0, len(of) - len(sums)))
                held[lang] = of, sums
            at = np.asarray([of[s] for s in sources])
            sums[np.ix_(at, at)] += cells(p, b, p, b)
    for k, (of, sums) in held.items():
        yield from out(k, list(of), list(of), sums)


def divergence(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) group of ``docs`` (lang, source, text).

    Null lang, source and text count as ''. Terms are runs of ASCII letters and non-ASCII characters, A-Z in lower case. A language
    keeps its V terms of at least ``min_docs`` documents. A group, and each language, gives a kept term the share
    p = 1 + floor(10^9 (n + 5) / (N + 5 V)), N the group's occurrences of kept terms. Part ``pair``: every other source of the
    language and the sum of |p - q| over all kept terms, 0 without any. Part ``term``: the ``top`` terms that occur in the group and have
    p above the language's q, by p - q. Ranks start at 1; ties go by item in UTF-8 order. All numbers are exact integers.

    A pair starts from V |b - b'|, b being the share of a term that does not occur. Terms of one source are corrected by
    sums of |p - x| at the other's b, from running sums over sorted shares; terms of both by sums over the
    postings, added up in each task. So no term meets sources that lack it and what is shuffled is a group's pairs, not its terms' pairs.
    Repeated rows count each time. An empty table gives an empty result; other columns are not read.
    """
    table = frequencies(docs)
    terms = table.where("term <> ''")
    kept = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("postings")).where(F.col("docs") >= min_docs)
    kept = stored(kept.select("lang", "term", "total", "postings"), "kept_terms")
    flat = kept.select("lang", "term", "total", F.inline("postings"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    sizes = flat.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    groups = table.where("term = ''").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("n_group", "v", "n_lang"))).withColumn("b", share(zero, F.col("n_group"), F.col("v")))
    groups = stored(groups, "groups")
    p, q = share(F.col("n"), F.col("n_group"), F.col("v")), share(F.col("total"), F.col("n_lang"), F.col("v"))
    shares = stored(flat.join(groups, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), "b", q.alias("q")), "shares")

    over = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    over = over.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    pairs = _pairs(groups, shares).withColumn("rank", rank).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return pairs.unionByName(over)


def _pairs(groups: DataFrame, shares: DataFrame, block: int = 256) -> DataFrame:
    """lang, source, item, value for every ordered pair of sources of a language."""
    per_lang = groups.groupBy("lang").agg(F.expr(f"count(*) div {block}").alias("blocks"))
    mine = groups.join(per_lang, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks") + 1))
    # Each block of sources meets all sources of its language: a language of many sources is dealt over many tasks.
    theirs = groups.join(per_lang, "lang").select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks"))).alias("block"), F.col("source").alias("item"), F.col("b").alias("x"))
    both = mine.join(theirs, ["lang", "block"]).where("source <> item").select("lang", "source", "item", "v", "b", "x")
    start = both.select("lang", "source", "item", F.coalesce(F.col("v") * F.abs(F.col("b") - F.col("x")), F.lit(0)).alias("value"))

    # Sums of |p - x| - |b - x| over a group's own terms, at every other source's x: points and questions in one order.
    points = shares.groupBy("lang", "source", F.col("p").alias("x"), "b").agg(F.count("*").alias("k")).withColumn("item", F.lit(None).cast("string"))
    asked = both.where("v > 0").select("lang", "source", "x", "b", F.lit(0).cast("long").alias("k"), "item")
    own = Window.partitionBy("lang", "source")
    upto, k, kx = own.orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow), F.col("k"), F.col("k") * F.col("x")
    line = points.unionByName(asked).select(
        "*", F.sum(k).over(upto).alias("k0"), F.sum(kx).over(upto).alias("s0"), F.sum(k).over(own).alias("k1"), F.sum(kx).over(own).alias("s1")
    )
    x, b = F.col("x"), F.col("b")
    single = x * F.col("k0") - F.col("s0") + (F.col("s1") - F.col("s0")) - x * (F.col("k1") - F.col("k0")) - F.col("k1") * F.abs(b - x)
    single = line.where("item IS NOT NULL").select("lang", "source", "item", single.alias("value"))
    turned = single.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    postings = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "b")).alias("postings")).where(F.size("postings") > 1)
    shared = bounded(postings.select("lang", "postings")).mapInArrow(_corrections, "lang string, source string, item string, value long")
    parts = start.unionByName(single).unionByName(turned).unionByName(shared)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
