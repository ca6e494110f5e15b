"""Hour-of-day bins.

An hour profile is 24 shares, one per hour of the day. Instead of gathering
each key's timestamps into a list (a group without map-side combine), the
operators count every hour with a conditional sum, so the aggregation is
partial + final and a key holding a third of all rows still travels as one
row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS = list(range(24))


def hour_of(ts: Column | str) -> Column:
    """Hour of day 0..23 of a timestamp, in the session time zone."""
    return F.hour(F.col(ts) if isinstance(ts, str) else ts)


def hour_label(h: Column | str) -> Column:
    """Two-digit ``HH`` label of an hour number."""
    return F.lpad((F.col(h) if isinstance(h, str) else h).cast("string"), 2, "0")


HOUR_COL = "_hour"


def hour_count_columns(hour: str = HOUR_COL, prefix: str = "h") -> list[Column]:
    """24 aggregate expressions ``count(hour = h)`` named ``h00`` .. ``h23``.

    ``hour`` names a column already holding the hour of day (project it once
    with :func:`with_hour`; otherwise the hour would be derived 24 times per
    row). Written as SQL text so the 24 expressions cost one parse each.
    """
    return [F.expr(f"count(CASE WHEN `{hour}` = {h} THEN 1 END) AS {prefix}{h:02d}") for h in HOURS]


def with_hour(df, ts: str = "ts", *keep: str):
    """``keep`` columns plus the hour of ``ts`` as :data:`HOUR_COL`."""
    return df.select(*keep, F.hour(ts).alias(HOUR_COL))


def hour_names(prefix: str = "h") -> list[str]:
    return [f"{prefix}{h:02d}" for h in HOURS]
