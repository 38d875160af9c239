"""Chat formatting by perspective rotation: each participant in turn is the assistant."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.windows import join_null_safe
from ..session import stored


class Template(NamedTuple):
    """Marks of a rendered turn; ``name`` stands between a user's mark and the text."""

    system: str = "<|system|>\n"
    assistant: str = "<|assistant|>\n"
    user: str = "<|user|>"
    after_name: str = "\n"
    end: str = "<|end|>\n"


def _parts(said: DataFrame, template: Template, most: int, most_bytes: int) -> DataFrame:
    """``said`` with the part of its chunk that each row is in, by the rows and bytes before it in the chunk.

    Only chunks beyond either bound are numbered: sorted over all tasks, counted inside a task, and the counts of
    earlier tasks added. Texts that share 1,024 characters in one turn of a speaker are sorted in one task.
    """
    marks = sum(len(x.encode()) for x in template)
    said = said.withColumn("_b", F.octet_length(F.coalesce("text", F.lit(""))) + F.octet_length(F.coalesce("role", F.lit(""))) + F.lit(marks).cast("long"))
    group = ["conv_id", "chunk"]
    sizes = said.groupBy(*group).agg(F.count("*").alias("_n"), F.sum("_b").alias("_s"))
    large = stored(sizes.where((F.col("_n") > most) | (F.col("_s") > most_bytes)).select(*group, F.lit(True).alias("_large")), "chunks")
    zero = F.lit(0).cast("long")
    if large.isEmpty():
        return said.drop("_b").withColumn("part", zero)
    said = join_null_safe(said, large, group, "left")
    order = ["turn", "role", "text"]
    ranged = said.where("_large").drop("_large").repartitionByRange(*group, "turn", "role", F.substring("text", 1, 1024))
    placed = stored(ranged.sortWithinPartitions(*group, *order).withColumn("_pid", F.spark_partition_id()), "turns")
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ahead = placed.groupBy(*group, "_pid").agg(F.count("*").alias("_n"), F.sum("_b").alias("_s"))
    ahead = ahead.select(*group, "_pid", *(F.coalesce(F.sum(c).over(earlier), zero).alias(c) for c in ("_n", "_s")))
    inside = Window.partitionBy(*group, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumns({"_i": F.coalesce(F.count("*").over(inside), zero), "_t": F.coalesce(F.sum("_b").over(inside), zero)})
    rows = join_null_safe(rows, ahead, [*group, "_pid"])
    part = F.floor((F.col("_n") + F.col("_i")) / most) + F.floor((F.col("_s") + F.col("_t")) / most_bytes)
    own = ["conv_id", "turn", "role", "text", "chunk"]
    return said.where("_large IS NULL").select(*own, zero.alias("part")).unionAll(rows.select(*own, part.alias("part")))


def rotate(turns: DataFrame, template: Template = Template(), chunk: int = 512, most_bytes: int = 1 << 26) -> DataFrame:
    """One row for each conversation, perspective and chunk of ``chunk`` turn numbers; more for a chunk of more rows.

    ``turns``: conv_id, turn, role (the speaker), text. Every speaker but ``system`` is a perspective once: the
    dialogue is rendered with that speaker as the assistant and all others as users with their names; system turns
    stay. Result: conv_id, perspective, chunk, part, n_turns, n_trained, text, mask (array of [start, end) character
    ranges of ``text``: what the perspective's speaker says, with its end mark). A part ends after ``chunk`` rows at
    most, and once the rows of its chunk have filled another ``most_bytes``; a single turn is never cut. The chunks
    and parts of a conversation, in order, are its whole rendering, so a conversation of any length is rendered in
    bounded rows, with missing or repeated turn numbers too. Parts are counted from 0, with gaps where both bounds meet.

    Turns are ordered by (turn, role, text). Equal rows count once. Null turn: before all others, as chunk -1. Null
    role: shown as a user without a name, no perspective. Null text: an empty turn. Null conv_id: one conversation of
    its own. A conversation without a speaker but the system gives no row; neither does an empty table. Other columns
    are not read.
    """
    t = template
    said = turns.select("conv_id", "turn", "role", "text").distinct()
    said = said.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-1)))
    speakers = said.where("role IS NOT NULL AND role != 'system'").select(F.col("conv_id").alias("_c"), F.col("role").alias("perspective")).distinct()
    said = _parts(said, t, chunk, most_bytes)
    rows = said.join(speakers, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    own = F.coalesce(F.col("role") == F.col("perspective"), F.lit(False))
    mark = (
        F.when(own, F.lit(t.assistant))
        .when(F.col("role") == "system", F.lit(t.system))
        .otherwise(F.concat(F.lit(t.user), F.coalesce("role", F.lit("")), F.lit(t.after_name)))
    )
    body = F.concat(F.coalesce("text", F.lit("")), F.lit(t.end))
    rows = rows.withColumns({"own": own, "mark": mark, "body": body})
    group = ["conv_id", "perspective", "chunk", "part"]
    order = Window.partitionBy(*group).orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("stop", F.sum(F.length("mark") + F.length("body")).over(order))
    whole = rows.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("stop", "own", "mark", "body"))).alias("parts"))
    mine = F.filter("parts", lambda p: p["own"])
    return whole.select(
        *group,
        F.size("parts").cast("long").alias("n_turns"),
        F.size(mine).cast("long").alias("n_trained"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["mark"], p["body"])), "").alias("text"),
        F.transform(mine, lambda p: F.struct((p["stop"] - F.length(p["body"])).alias("start"), p["stop"].alias("end"))).alias("mask"),
    )
