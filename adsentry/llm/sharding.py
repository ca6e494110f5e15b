"""Sharding by longest processing time first.

Groups that must stay together (equal texts) are ordered by size, largest
first, and each goes to the shard that holds the fewest bytes, through a
heap. Only a histogram of group sizes reaches the driver: sizes fall into
classes of at most 1/256 relative width (exact up to 256 bytes), a bound of
about 256 classes per doubling whatever the number of groups. All groups of a
class count with the class's mean size. The heap deals a class at a time:
when a class holds more groups than level the shards, the even part is dealt
in one step, which is where the heap would put them one by one.

The plan says, per class, how many groups each shard gets; a group finds its
shard by its number within the class.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsentry.llm.common import columns_of, numbered, staged

SHARDS = 40
ROW_BYTES = 16  # added to the text's bytes for every row
CLASS_STEPS = 256  # size classes per doubling


def size_class(size: Column) -> Column:
    """Size class: the value itself up to ``CLASS_STEPS``, then so many steps per doubling."""
    exact = F.lit(CLASS_STEPS)
    step = CLASS_STEPS + F.floor((F.log2(size.cast("double")) - F.log2(exact.cast("double"))) * CLASS_STEPS)
    return F.when(size <= exact, size).otherwise(step).cast("long")


def deal(loads: list[float], n: int, size: float) -> list[int]:
    """Groups of one size that each shard gets: every one to the least loaded shard.

    ``loads`` is updated. The shards are first filled to a common level with
    whole groups, then the few left over go through the heap.
    """
    got = [0] * len(loads)
    if n >= 4 * len(loads) and size > 0:
        low, high = min(loads), max(loads) + n * size
        for _ in range(100):
            level = (low + high) / 2
            if sum(int(max(0.0, level - x) // size) for x in loads) > n:
                high = level
            else:
                low = level
        got = [int(max(0.0, low - x) // size) for x in loads]
        n -= sum(got)
        for i, k in enumerate(got):
            loads[i] += k * size
    heap = [(x, i) for i, x in enumerate(loads)]
    heapq.heapify(heap)
    for _ in range(n):
        x, i = heap[0]
        heapq.heapreplace(heap, (x + size, i))
        got[i] += 1
        loads[i] = x + size
    return got


def lpt_plan(histogram: Sequence[tuple[int, int, int]], shards: int = SHARDS) -> list[tuple[int, list[int]]]:
    """``(class, ends)`` of ``(class, groups, bytes)``: shard ``i`` of a class holds the numbers ``ends[i-1] .. ends[i] - 1``."""
    loads, plan = [0.0] * shards, []
    for cls, n, total in sorted(histogram, key=lambda h: (-h[2] / h[1], h[0])):
        ends, upto = [], 0
        for k in deal(loads, n, total / n):
            upto += k
            ends.append(upto)
        plan.append((cls, ends))
    return plan


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", row_bytes: int = ROW_BYTES
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes (null: none) plus ``row_bytes``; a
    group is all rows of one text, null counting as empty, and stays in one
    shard. The law is ``bytes``: sizes near equal, as far as single groups
    allow. ``slot`` numbers the rows of a shard from 0 without gaps.
    ``grown_shard`` is null, as this law promises nothing when a shard is
    added. Repeated rows take a slot each; an empty table gives none.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    spark = docs.sparkSession
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = staged(
        columns_of(docs, _id=id_col, _text=text_col).select(
            "_id",
            (F.octet_length(text).cast("long") + row_bytes).alias("_size"),
            F.crc32(text).alias("_crc"),
            F.unhex(F.sha2(text, 256)).alias("_sha"),
        ),
        "shard-rows",
    )
    groups = staged(
        rows.groupBy("_sha").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")).withColumn(
            "_class", size_class(F.col("_bytes"))
        ),
        "shard-groups",
    )
    histogram = groups.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("b"), F.sum("_rows").alias("r")).collect()
    plan = lpt_plan([(h["_class"], h["n"], h["b"]) for h in histogram], shards)
    table = spark.createDataFrame(plan, "_class long, _ends array<long>")
    n_groups, n_rows = sum(h["n"] for h in histogram), sum(h["r"] for h in histogram)
    # The plan has a row per size class: bounded by the classes, not the data.
    placed = (
        numbered(groups, ["_class"], ["_sha"], "_nth", n_groups)
        .join(F.broadcast(table), "_class")
        .select("_sha", F.size(F.filter("_ends", lambda e: e <= F.col("_nth"))).alias("shard"))
    )
    sharded = staged(rows.join(placed, "_sha").select("_id", "_size", "_crc", "shard"), "shard-placed")
    return numbered(sharded, ["shard"], ["_id", "_size", "_crc"], "slot", n_rows).select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard"),
        F.col("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
