"""Near duplicates of documents: MinHash bands for candidates, b-bit signatures for estimates, full sets for proof."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_folder
from . import words
from .frames import bounded
from .graph import components

BITS = 2
#: Shingles of one block of a family; a task compares two blocks at most.
BLOCK = 1 << 18


class Bands(NamedTuple):
    """``count`` bands of ``rows`` minima: two texts of similarity s share none with (1 - s**rows)**count."""

    count: int = 36
    rows: int = 8

    @property
    def hashes(self) -> int:
        return self.count * self.rows


#: At a similarity of 0.85: 1 in 100,000 pairs missed by all bands; at 0.8: 6 in 100,000.
BANDS_85, BANDS_80 = Bands(36, 8), Bands(41, 7)


def shingle_sets(texts: pa.Array, n: int) -> Iterator[list[np.ndarray]]:
    """Sorted distinct hashes of the runs of ``n`` words of each text, chunk by chunk; fewer words make one run."""
    for c in words.chunks(texts, lower=True):
        h = words.runs(c.hashes, n)
        out = []
        for a, b in zip(c.docs[:-1].tolist(), c.docs[1:].tolist()):
            if b - a >= n:
                own = np.sort(h[a : b - n + 1])
                out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
            else:
                out.append(words.runs(c.hashes[a:b], b - a) if b > a else c.hashes[:0])
        yield out


def _minima(sets: list[np.ndarray], k: int) -> np.ndarray:
    """(sets, k) minima under ``k`` fixed linear hashes; no set may be empty."""
    rng = np.random.default_rng(20240229)
    mul, add = rng.integers(0, 1 << 31, k, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, k, np.uint32)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    low, now = np.empty((k, len(sets)), np.uint32), np.empty_like(x)
    for i in range(k):
        np.multiply(x, mul[i], out=now)
        now += add[i]
        np.minimum.reduceat(now, starts, out=low[i])
    return low.T


def pack_bits(minima: np.ndarray) -> np.ndarray:
    """The lowest ``BITS`` bits of each minimum, packed into 64-bit words."""
    low = (minima & np.uint32((1 << BITS) - 1)).astype(np.uint64)
    per = 64 // BITS
    low = np.pad(low, ((0, 0), (0, -low.shape[1] % per))).reshape(len(low), -1, per)
    return (low << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def margin(percent: int, k: int) -> float:
    """Six standard errors of an estimate by ``k`` hashes at the threshold: 0.15 for 288 at 85, 0.17 for 287 at 80."""
    chance = 1 / (1 << BITS)
    equal = chance + (1 - chance) * percent / 100
    return 6 * math.sqrt(equal * (1 - equal) / k) / (1 - chance)


def estimates(one: np.ndarray, many: np.ndarray, k: int) -> np.ndarray:
    """Similarity by equal low bits, corrected for those that are equal by chance."""
    x = one ^ many
    x = (x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)
    equal = 1 - np.bitwise_count(x).sum(axis=1) / k
    chance = 1 / (1 << BITS)
    return (equal - chance) / (1 - chance)


def _signed(shingle: int, bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for sets in shingle_sets(batch.column("text"), shingle):
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                keys = np.zeros((2, len(sets)), np.uint64)
                band = np.zeros((len(sets), bands.count), np.uint64)
                sig = [b""] * len(sets)
                if len(full):
                    kept = [sets[i] for i in full]
                    starts = np.cumsum([0, *map(len, kept)])[:-1]
                    every = np.concatenate(kept)
                    keys[0, full] = np.add.reduceat(words.mixed(every), starts)
                    keys[1, full] = np.add.reduceat(words.mixed(every ^ np.uint64(0x5851F42D4C957F2D)), starts)
                    low = _minima(kept, bands.hashes)
                    parts = low.reshape(len(kept), bands.count, bands.rows).astype(np.uint64)
                    key = np.broadcast_to(np.arange(1, bands.count + 1, dtype=np.uint64), parts.shape[:2]).copy()
                    for r in range(bands.rows):
                        key = words.mixed(key * np.uint64(0x2545F4914F6CDD1D) + parts[:, :, r])
                    band[full] = key
                    for i, s in zip(full.tolist(), pack_bits(low)):
                        sig[i] = s.tobytes()
                ends = np.arange(len(sets) + 1, dtype=np.int32) * bands.count
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(sets)), batch.column("same").slice(at, len(sets)), pa.array(n, pa.int64()), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(band.ravel().view(np.int64))), pa.array(sig, pa.binary())],
                    ["doc_id", "same", "n", "k1", "k2", "bands", "sig"],
                )
                at += len(sets)

    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _links(ids: list[int], blocks: np.ndarray, sigs: np.ndarray, sets: list[np.ndarray], k: int, percent: int, slack: float) -> Iterator[tuple[int, int]]:
    """Confirmed links that join the documents of one or two blocks; pairs already joined by others are not tried."""
    n = np.array([len(s) for s in sets])
    label = np.arange(len(ids))
    two = blocks.min() != blocks.max()
    for i in range(len(ids) - 1):
        rest = np.arange(i + 1, len(ids))
        ok = (label[rest] != label[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
        if two:
            ok &= blocks[rest] != blocks[i]
        rest = rest[ok]
        if not len(rest):
            continue
        est = estimates(sigs[i], sigs[rest], k)
        good = est >= percent / 100 - slack
        for j in rest[good][np.argsort(-est[good], kind="stable")].tolist():
            if label[i] != label[j] and _linked(sets[i], sets[j], percent):
                label[label == label[j]] = label[i]
                yield ids[i], ids[j]


def _confirm(shingle: int, k: int, percent: int, slack: float):
    """Streams families in order; holds the rows of one pair of blocks at a time."""

    def close(rows: list[tuple]) -> list[tuple[int, int]]:
        ids, blocks, sigs, sets = zip(*rows)
        return list(_links(list(ids), np.array(blocks), np.array(sigs), list(sets), k, percent, slack)) if len(ids) > 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            out = []
            sets = [s for part in shingle_sets(batch.column("text"), shingle) for s in part]
            for *key, ident, block, sig, own in zip(*(batch.column(c).to_pylist() for c in ("family", "i", "j", "node", "block", "sig")), sets):
                if key != now:
                    out += close(rows) if rows else []
                    now, rows = key, []
                rows.append((ident, block, np.frombuffer(sig, np.uint64), own))
            yield _pairs(out)
        yield _pairs(close(rows) if rows else [])

    return run


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in (0, 1)], ["a", "b"])


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = 5, bands: Bands = BANDS_85, slack: float | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, same (hash of the text) of each row of ``docs`` (doc_id long, text string).

    A document's set: its distinct runs of ``shingle`` words, A-Z lower-cased; with fewer words, all of them as
    one run; none without words or text. Documents are linked with 100 * common >= ``percent`` * united.
    component_id is the smallest doc_id that links lead to; kept marks the document that has it.

    Equal sets are one node from the start. Texts that share a band make families; inside a family the packed
    signatures of all pairs of blocks are compared, and what an estimate leaves possible (``slack``: see ``margin``)
    is proved on the full sets, unless other links join the two already. So only links that join leave a task. A
    link between different texts at the threshold is lost by all bands (see ``Bands``) once in 100,000 at 0.85 and
    6 times at 0.8, or by its estimate, which adds less than 1 in 10 million; more similar ones far more rarely.

    Null or empty text: n_shingles 0, alone, kept. A row without doc_id: component_id null, kept. Rows that
    share a doc_id are each judged by their own text. An empty table gives an empty result. Other columns are
    not read.
    """
    slack = margin(percent, bands.hashes) if slack is None else slack
    spark = docs.sparkSession
    docs = bounded(docs).select("doc_id", "text", F.xxhash64("text").alias("same"))
    path = new_folder(spark, "signatures")
    docs.mapInArrow(_signed(shingle, bands), "doc_id long, same long, n long, k1 long, k2 long, bands array<long>, sig binary").write.parquet(path)
    signed = spark.read.parquet(path)
    equal = ["n", "k1", "k2"]
    named = signed.where("n > 0 AND doc_id IS NOT NULL")
    # A set's node is the smallest doc_id that has it, unless rows of one doc_id have several sets: those are told apart by their hashes.
    several = named.groupBy("doc_id").agg(*(f(c).alias(f"{f.__name__}_{c}") for c in equal for f in (F.min, F.max)))
    several = several.where(" OR ".join(f"min_{c} != max_{c}" for c in equal)).select(F.col("doc_id").alias("_several"))
    repeated = not several.isEmpty()

    def with_node(sets: DataFrame) -> DataFrame:
        if not repeated:
            return sets.withColumn("node", F.col("doc"))
        marked = sets.join(several, F.col("doc") == F.col("_several"), "left")
        return marked.withColumn("node", F.when(F.col("_several").isNull(), F.col("doc")).otherwise(F.xxhash64(*equal))).drop("_several")

    # Of two different sets, one at least must have more than one shingle for a link.
    nodes = named.where("n > 1").groupBy(equal).agg(F.min(F.struct("doc_id", "same")).alias("least"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    nodes = with_node(nodes.select(F.col("least.doc_id").alias("doc"), F.col("least.same").alias("its"), *equal, "bands", "sig"))
    keys = nodes.select("node", F.explode("bands").alias("key"))
    heads = keys.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last")
    families = components(keys.join(heads, "key").where("node != head").select("node", "head"), "node", "head")
    members = families.join(nodes.select("node", "doc", "its", "n", "sig"), "node")
    blocks = members.groupBy("component").agg(F.ceil(F.sum("n") / block).alias("blocks"))
    members = members.join(blocks, "component").select(F.col("component").alias("family"), "node", "doc", "its", "sig", "blocks", F.expr("pmod(xxhash64(node), blocks)").alias("block"))
    texts = docs.join(members, (F.col("doc_id") == F.col("doc")) & (F.col("same") == F.col("its")))
    tasks = texts.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    tasks = tasks.select("family", "i", "j", "node", "block", "sig", "text").repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "node")
    links = tasks.mapInArrow(_confirm(shingle, bands.hashes, percent, slack), "a long, b long")
    joined = components(links, "a", "b")
    reps = with_node(named.groupBy(equal).agg(F.min("doc_id").alias("doc")))
    reps = reps.join(joined, "node", "left").select(*(F.col(c).alias(f"_{c}") for c in equal), "doc", F.coalesce("component", "node").alias("component"))
    if repeated:  # a component is named by its smallest doc_id, which is not its smallest node
        reps = reps.join(reps.groupBy("component").agg(F.min("doc").alias("smallest")), "component").drop("component").withColumnRenamed("smallest", "component")
    out = signed.join(reps, (F.col("n") == F.col("_n")) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "same")
    return out.select("doc_id", "n_shingles", "component_id", F.expr("component_id IS NULL OR component_id = doc_id").alias("kept"), "same")
