"""Contiguous 1-based indexes without a global single-task window.

``row_number() OVER (ORDER BY k)`` moves every row into one task. Here the
rows are range-partitioned and sorted within partitions, checkpointed to the
shared folder (which fixes partition ids and order), and then each row's
index is ``rows in earlier partitions + position in its partition + 1``.
Only the per-partition counts (one row per partition) go through a small
window; per-group offsets are a plain aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adsentry.plans.common import materialize

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | row position


def dense_index(
    df: DataFrame,
    order_cols: Sequence[str],
    group_col: str | None = None,
    num_partitions: int | None = None,
    name: str = "idx",
) -> DataFrame:
    """Add ``name``: 1-based, contiguous in ``order_cols`` order within each ``group_col``.

    ``(group_col, *order_cols)`` should be unique, as for a key index.
    """
    spark = df.sparkSession
    keys = ([group_col] if group_col else []) + list(order_cols)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys), "checkpoint")
    pid = F.spark_partition_id()
    tagged = ranged.select(
        "*",
        pid.alias("_pid"),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), _POS_BITS)).alias("_pos"),
    )
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    out = tagged.join(F.broadcast(offsets), "_pid")  # one row per partition: bounded by n
    out = out.withColumn("_rank", F.col("_off") + F.col("_pos") + 1)
    if group_col:
        # A group's rows are contiguous in the global order, so its offset is
        # its smallest global rank: a partial + final aggregate, no window.
        firsts = out.groupBy(group_col).agg(F.min("_rank").alias("_first"))
        firsts = firsts.withColumnRenamed(group_col, "_group")
        out = out.join(firsts, out[group_col].eqNullSafe(F.col("_group"))).drop("_group").withColumn("_rank", F.col("_rank") - F.col("_first") + 1)
    return out.withColumnRenamed("_rank", name).drop("_pid", "_pos", "_off", "_first")


ROWS_PER_BLOCK = 65_536


def in_blocks(df: DataFrame, order_cols: Sequence[str], block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add ``_at`` (place in ``order_cols`` order, from 1) and ``_block`` (runs of ``block`` rows in that order).

    For scans that look at neighbours: a window keyed by ``_block`` never holds
    more than ``block`` rows, however the keys are spread; what passes from one
    block to the next follows from a row per block.
    """
    placed = dense_index(df, order_cols, name="_at")
    return placed.withColumn("_block", F.expr(f"(_at - 1) div {block}"))
