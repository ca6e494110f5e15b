"""True sessions of flat events: they end by a pause, not by the clock (A-14).

A session of a key (a user on a medium, say) goes on while the next event
follows within ``gap``. ``session_window`` would bring all rows of a key into one
task before it merges them; here the rows are ordered once and cut into blocks
of a fixed number of rows, a block turns into partial sessions, and only these
meet per key. So a key may hold any share of the rows: what one task gets of
it is its blocks' partial sessions, at most its time span divided by the gap,
plus one a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adsentry.functions.ranking import ROWS_PER_BLOCK, in_blocks

# Fixed value: the usual pause that ends a web session.
GAP_SECONDS = 1800


def _seconds(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def gap_sessions(
    events: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str] = (),
    tie: str = "event_id",
    gap_seconds: int = GAP_SECONDS,
    block: int = ROWS_PER_BLOCK,
    ts: str = "ts",
) -> DataFrame:
    """``*keys, session_start, session_end, n_events, *sums``, one row per session.

    A session starts where a key's event comes more than ``gap_seconds`` after
    the one before; ``session_end`` is its last event. ``sums`` are numeric
    columns added up. Events without time are no session's; NULL keys are keys.
    ``(keys, ts, tie)`` gives the order (ties change nothing in the result).
    """
    keys, sums, gap = list(keys), list(sums), gap_seconds * 1_000_000
    known = events.where(F.col(ts).isNotNull()).select(*keys, F.col(ts).alias("_ts"), F.col(tie).alias("_tie"), *sums)
    rows = in_blocks(known, [*keys, "_ts", "_tie"], block).withColumn("_us", _seconds("_ts"))

    # within (key, block): NULL names the piece that may go on from an earlier block
    seen = Window.partitionBy(*keys, "_block").orderBy("_at")
    pause = F.col("_us") - F.lag("_us").over(seen)
    started = rows.withColumn("_start", F.when(pause > gap, F.col("_us")))
    upto = seen.rowsBetween(Window.unboundedPreceding, 0)
    pieces = (
        started.withColumn("_piece", F.last("_start", ignorenulls=True).over(upto))
        .groupBy(*keys, "_block", "_piece")
        .agg(
            F.min("_ts").alias("_lo"), F.max("_ts").alias("_hi"), F.count(F.lit(1)).alias("n_events"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )

    # across blocks: a head piece goes on with the piece before it unless the pause is too long
    order = Window.partitionBy(*keys).orderBy("_block", F.asc_nulls_first("_piece"))
    since = _seconds("_lo") - F.lag(_seconds("_hi")).over(order)
    goes_on = F.col("_piece").isNull() & (since <= gap)
    marked = pieces.withColumn("_start", F.when(~F.coalesce(goes_on, F.lit(False)), F.col("_lo")))
    named = marked.withColumn(
        "session_start", F.last("_start", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return named.groupBy(*keys, "session_start").agg(
        F.max("_hi").alias("session_end"), F.sum("n_events").alias("n_events"), *[F.sum(c).alias(c) for c in sums]
    )
