"""A Merkle tree over a dataset's rows: leaf places from bitmap ranks, levels reduced in keyed slot arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.windows import surrogate_key
from ..session import stored

#: Children of a node; levels that one slot array takes, and its slots.
FAN, LEVELS = 8, 3
SLOTS = FAN**LEVELS
#: Widths, in bits, of the levels of the popcount directory: ids of a word, words of a container, and so on to 64 bits.
WORD, ABOVE = 6, (14, 16, 16, 12)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<l:string,r:string>"


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def _field(c: Column) -> Column:
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf(text: Column) -> Column:
    return digest(F.concat(*(_field(text if f == "text" else F.col(f)) for f in FIELDS)))


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, lang, leaf, forged: one row for each row of ``docs``, written once, so that all that follows sees one state.

    ``tree`` is lang as a key that is never null and sorts as lang does, null first. ``forged`` is the leaf of the row after tampering:
    text with A-Z in lower case where 3 divides the crc32 of the decimal doc_id, else the leaf itself.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    df = docs.select(tree.alias("tree"), "doc_id", "lang", leaf(F.col("text")).alias("leaf"), F.when(hit & (lower != F.col("text")), leaf(lower)).alias("changed"))
    return stored(df.select("tree", "doc_id", "lang", "leaf", F.coalesce("changed", "leaf").alias("forged")), "leaves")


def _word(doc_id: Column) -> Column:
    """The 64 ids that a bitmap word covers; rows without an id come in a word before all others."""
    return F.coalesce(F.shiftright(doc_id, WORD), F.lit(-(1 << (63 - WORD)) - 1))


def directory(rows: DataFrame) -> DataFrame:
    """tree, word, bits, n, before, total: the bitmap's words that are not empty, with the rows of the tree before each.

    Words (64 ids) are merged by OR, partly before the shuffle; empty ones are not kept, so ids may be as sparse as they like. Counts rise through
    containers of 2^14 words and three more levels to the whole 64 bits and come back as running sums inside the parent: no window holds
    more than 2^16 rows, whatever the size of the tree.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.coalesce(F.col("doc_id"), F.lit(0)).bitwiseAND((1 << WORD) - 1).cast("int"))
    bits = F.coalesce(F.bit_or(F.when(F.col("doc_id").isNotNull(), bit)), F.lit(0))
    words = stored(rows.groupBy("tree", _word(F.col("doc_id")).alias("k0")).agg(bits.alias("bits"), F.count("*").alias("n")), "bitmap")
    levels = [words.select("tree", "k0", "n")]
    for i, width in enumerate(ABOVE, 1):
        levels.append(levels[-1].groupBy("tree", F.shiftright(f"k{i - 1}", width).alias(f"k{i}")).agg(F.sum("n").alias("n")))
    before = levels[-1].groupBy("tree").agg(F.sum("n").alias("total")).withColumn("base", F.lit(0).cast("long"))
    keys = ["tree"]
    for i in range(len(ABOVE), -1, -1):
        parent = [] if i == len(ABOVE) else [F.shiftright(f"k{i}", ABOVE[i]).alias(f"k{i + 1}")]
        level = (words if i == 0 else levels[i]).select("*", *parent)
        run = F.sum("n").over(Window.partitionBy(*keys).orderBy(f"k{i}").rowsBetween(Window.unboundedPreceding, -1))
        level = level.withColumn("run", F.coalesce(run, F.lit(0))).join(before, keys)
        extra = ["bits", "n"] if i == 0 else []
        before = level.select("tree", f"k{i}", *extra, "total", (F.col("base") + F.col("run")).alias("base"))
        keys = ["tree", f"k{i}"]
    return before.withColumnRenamed("k0", "word").withColumnRenamed("base", "before")


def _repeated(rows: DataFrame) -> DataFrame:
    """Adds ``rank`` to rows of words in which an id comes more than once (or is missing): by id, then leaf, then place on disk.

    Counts of ids in a word, of leaf prefixes in an id, and of a leaf's input partitions are added up first, so that a
    window holds few rows even if one id, or one row, is a third of the table.
    """
    part = F.shiftright("row", 33)
    rows = rows.withColumns({"id": F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("v")), "prefix": F.substring("leaf", 1, 3), "part": part})
    levels, rank = ["id", "prefix", "leaf", "part"], F.lit(0).cast("long")
    keys = ["tree", "word"]
    for name in levels:
        count = rows.groupBy(*keys, name).agg(F.count("*").alias("m"))
        run = F.coalesce(F.sum("m").over(Window.partitionBy(*keys).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        keys = [*keys, name]
        rows = rows.join(count.select(*keys, run.alias(f"{name}_before")), keys)
        rank = rank + F.col(f"{name}_before")
    return rows.withColumn("rank", rank + F.row_number().over(Window.partitionBy(*keys).orderBy("row")) - 1)


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``at`` (place in the tree, from 0) and ``total`` (leaves of the tree).

    The place is the rank of the id in its tree's bitmap: rows before its word, and the bits below its own.
    """
    index = stored(directory(rows), "directory")
    found = rows.withColumns({"word": _word(F.col("doc_id")), "row": F.monotonically_increasing_id()}).join(index, ["tree", "word"])
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("doc_id").bitwiseAND((1 << WORD) - 1).cast("int")))
    single = F.bit_count("bits") == F.col("n")
    out = [*rows.columns, "total"]
    once = found.where(single).select(*out, (F.col("before") + F.bit_count(F.col("bits").bitwiseAND(below))).alias("at"))
    if index.where(~single).isEmpty():
        return once
    # Ids that come again: places among them need rows that keep their numbers.
    again = _repeated(stored(found.where(~single).select(*out, "word", "row", "before"), "repeated"))
    return once.unionByName(again.select(*out, (F.col("before") + F.col("rank")).alias("at")))


def _runs(nodes: Column) -> Column:
    """Hashes of every 8 consecutive nodes."""
    first = F.sequence(F.lit(1), F.size(nodes), F.lit(FAN))
    return F.transform(first, lambda i: digest(F.array_join(F.slice(nodes, i, FAN), "")))


def _step(nodes: Column, i: Column) -> Column:
    """What stands left and right of node ``i`` (from 0) in its run, as hashes put together."""
    first = i - i % FAN
    left = F.array_join(F.slice(nodes, first + 1, i % FAN), "")
    right = F.array_join(F.slice(nodes, i + 2, FAN - 1 - i % FAN), "")
    return F.struct(left.alias("l"), right.alias("r"))


def arrays(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """Slot arrays of ``nodes`` (tree, at, total, hash): tree, at, total of the array, hash it reduces to, its levels n0..n2, and items.

    An array holds up to 512 consecutive nodes, each in its slot, and takes three levels, or fewer where the tree ends.
    """
    item = F.struct((F.col("at") % SLOTS).cast("int").alias("slot"), F.col("hash"), *payload)
    held = nodes.groupBy("tree", F.expr(f"at div {SLOTS}").alias("at"), "total").agg(F.sort_array(F.collect_list(item)).alias("items"))
    held = held.withColumn("n0", F.transform("items", lambda x: x["hash"]))
    for k in range(LEVELS):
        held = held.withColumn(f"n{k + 1}", F.when(_lasts(k), _runs(F.col(f"n{k}"))).otherwise(F.col(f"n{k}")))
    return stored(held.withColumn("hash", F.get(f"n{LEVELS}", 0)).drop(f"n{LEVELS}"), "slots")


def _lasts(level: int) -> Column:
    """True if the tree has more than one node at this level of the array, so that a further one follows."""
    return F.col("total") > FAN**level


def reduced(nodes: DataFrame, payload: list[str]) -> list[DataFrame]:
    """All slot arrays from the bottom up; the last has one array for each tree, with the tree's root as hash."""
    out = [arrays(nodes, payload)]
    while out[-1].where(F.col("total") > SLOTS).limit(1).count():
        up = out[-1].select("tree", "at", F.expr(f"(total + {SLOTS - 1}) div {SLOTS}").alias("total"), "hash")
        out.append(arrays(up, []))
    return out


def _path(slot: Column) -> Column:
    """Steps of the node in ``slot`` inside its array."""
    steps = []
    for k in range(LEVELS):
        i = F.shiftright(slot, (FAN.bit_length() - 1) * k)
        steps.append(F.when(_lasts(k), F.array(_step(F.col(f"n{k}"), i))).otherwise(F.array().cast(f"array<{_STEP}>")))
    return F.concat(*steps)


def paths(levels: list[DataFrame], tops: DataFrame, finish) -> DataFrame:
    """For every bottom node: its payload and ``finish(path)``, the path being all steps up to ``tops`` (tree, top: steps above the tree's root).

    Steps go down one table of arrays at a time: what an array knows is shared by its 512 nodes, and only the bottom ones are unfolded.
    """
    above = levels[-1].select("tree", "at").join(tops, "tree").withColumnRenamed("top", "up")
    for held in reversed(levels[1:]):
        here = held.join(above, ["tree", "at"])
        each = F.transform("items", lambda x: F.struct((F.col("at") * SLOTS + x["slot"]).alias("at"), F.concat(_path(x["slot"]), F.col("up")).alias("up")))
        above = here.select("tree", F.inline(each))
    here = levels[0].join(above, ["tree", "at"])
    return here.select("tree", F.inline(F.transform("items", lambda x: finish(x, F.concat(_path(x["slot"]), F.col("up"))))))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified for each row of ``docs`` (doc_id, source, lang, n_chars, text).

    H is SHA-256 in lower-case hex; inputs are put together, digests as hex text. A leaf is H of the five fields in that order, ``-`` if null,
    else UTF-8 byte count, ``:``, value. The leaves of a lang ascend by doc_id; while more than one node remains, every 8 consecutive ones
    become their H, also a last run of fewer or one. Subroots, by lang (null first, UTF-8 order), give the root likewise.
    proof_sha256 is H of a leaf's siblings, level by level up to the root, left to right. folded_root is computed from those siblings and
    the leaf of the row after tampering (see ``leaves``); verified: it equals the root.

    Rows without doc_id come first in their lang; rows that share lang and doc_id follow each other by leaf, and every one of them is a leaf. Empty and
    very long texts are hashed whole. An empty table gives an empty result. Other columns are not read.
    """
    rows = leaves(docs)
    at = placed(rows).withColumn("hash", F.col("leaf")).select("tree", "at", "total", "hash", "doc_id", "lang", "forged")
    levels = reduced(at, ["doc_id", "lang", "forged"])
    subroots = stored(levels[-1].select(F.col("tree").alias("name"), F.col("hash")), "subroots")
    # Languages have no integer to rank: they are numbered by ranges of their order.
    numbered = surrogate_key(subroots, "at", ["name"], start=0)
    count = subroots.agg(F.count("*").alias("total"))
    forest = numbered.crossJoin(F.broadcast(count)).select(F.lit("").alias("tree"), "at", "total", "hash", "name")  # one row: the count
    top = reduced(forest, ["name"])
    root = top[-1].select(F.lit("").alias("tree"), F.col("hash").alias("root"))
    none = top[-1].select("tree", F.array().cast(f"array<{_STEP}>").alias("top"))
    tops = paths(top, none, lambda x, path: F.struct(x["name"].alias("name"), x["hash"].alias("subroot"), path.alias("top")))
    tops = stored(tops.join(root, "tree").select(F.col("name").alias("tree"), "subroot", "root", "top"), "subroot_paths")

    def finish(x: Column, path: Column) -> Column:
        proof = digest(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""))
        folded = F.aggregate(path, x["forged"], lambda h, s: digest(F.concat(s["l"], h, s["r"])))
        return F.struct(x["doc_id"].alias("doc_id"), x["lang"].alias("lang"), x["hash"].alias("leaf"), proof.alias("proof_sha256"), folded.alias("folded_root"))

    out = paths(levels, tops.select("tree", "top"), finish)
    return out.join(tops.drop("top"), "tree").select(
        "doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
