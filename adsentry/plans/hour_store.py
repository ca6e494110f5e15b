"""Hour profiles from stored daily counts (A-08..A-12 by day, merged).

What a day adds to an address is 24 counts, and counts of days add up. So a
day's visits are read once, its counts are kept (a versioned table by day), and
profiles, scores and blacklists of any range of days come from the counts
alone. A day that is run again, or late, replaces its own counts in one step.

The quantile fences run on the merged counts, not on merged sketches: an
address's volume over a range is the sum of its days, which no sketch of the
days' volumes holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsentry.functions.hours import HOUR_COL, hour_count_columns, hour_names
from adsentry.operators.hour_profile import deviation_of_counts
from adsentry.plans.blacklist import BlacklistOutputs, blacklist_of_counts
from adsentry.sources import versioned


def day_counts(visits: DataFrame, ip: str = "ip", ts: str = "ts") -> DataFrame:
    """``day, ip, size, h00 .. h23`` of visits; the NULL address is one, visits without time are no day's.

    Partial + final aggregation: a hot address is one row per day and task.
    """
    rows = visits.where(F.col(ts).isNotNull()).select(
        F.to_date(ts).alias("day"), F.col(ip).alias("ip"), F.hour(ts).alias(HOUR_COL)
    )
    return rows.groupBy("day", "ip").agg(F.count(F.lit(1)).alias("size"), *hour_count_columns())


def merged_counts(stored: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """``*by, ip, size, h00 .. h23``: the days' counts added up, over all days or per ``by`` group."""
    return stored.groupBy(*by, "ip").agg(*[F.sum(c).alias(c) for c in ("size", *hour_names())])


def _days(column: str, start: str, end: str, to: str) -> Column:
    return (F.col(column) >= F.lit(start).cast(to)) & (F.col(column) < F.lit(end).cast(to))


def store_days(visits: DataFrame, path: str, start: str, end: str, ip: str = "ip", ts: str = "ts") -> int:
    """Replace the stored counts of the days ``[start, end)``, in one step; only their visits are read."""
    wanted = visits.where(_days(ts, start, end, visits.schema[ts].dataType.simpleString()))
    return versioned.replace_days(day_counts(wanted, ip, ts), path, ["day"], start, end)


def range_counts(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """``ip, size, h00 .. h23`` of the days ``[start, end)``, from the stored counts (other days are not read)."""
    return merged_counts(versioned.read_table(spark, path).where(_days("day", start, end, "date")))


def range_deviation(spark: SparkSession, path: str, start: str, end: str, metric: str = "mse") -> DataFrame:
    """A-09 of the visits of ``[start, end)`` without reading a visit."""
    return deviation_of_counts(range_counts(spark, path, start, end), metric)


def range_blacklist(spark: SparkSession, path: str, start: str, end: str, **fences) -> BlacklistOutputs:
    """A-08..A-12 of the visits of ``[start, end)`` without reading a visit."""
    return blacklist_of_counts(range_counts(spark, path, start, end), **fences)


def weekly_deviation(stored: DataFrame, metric: str = "mse") -> DataFrame:
    """``week, ip, size, flag, coef``: A-09 of every week, against the population of the same week."""
    weeks = merged_counts(stored, [F.date_trunc("week", "day").cast("date").alias("week")])
    return deviation_of_counts(weeks, metric, by=["week"])
