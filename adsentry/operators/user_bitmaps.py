"""User bitmap reports: distinct and returning users of any days from stored bitmaps.

Every user (media key and uid) has a dense number in the order of its first
day. A day's users are kept as bitmaps, one row per key and 32,768 numbers, so
the users of any set of days are the OR of its rows, and users of two sets of
days follow from the three sizes ``|A| + |B| - |A or B|``. No report looks at a
session again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adsentry.functions.ranking import dense_index

USER = ("media_key", "uid")
_BITS_PER_ROW = 32_768  # fixed by Spark's bitmap functions


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _first_days(sessions: DataFrame) -> DataFrame:
    known = sessions.where(F.col("uid").isNotNull() & F.col("day").isNotNull())
    return known.groupBy(*USER).agg(F.min("day").alias("day"))


def user_numbers(sessions: DataFrame) -> DataFrame:
    """``media_key, uid, user_no``: numbers 1.. in the order of (first day, media key, uid).

    Rows without uid or day are no user's. Distributed, see ``functions.ranking``.
    """
    return dense_index(_first_days(sessions), ["day", *USER], name="user_no").select(*USER, "user_no")


def extend_numbers(numbers: DataFrame, sessions: DataFrame) -> DataFrame:
    """``numbers`` and the users of ``sessions`` it doesn't have, numbered behind its last.

    Numbers once given stay, so stored bitmaps stay right when days come late.
    """
    theirs = numbers.select(*[F.col(c).alias(f"_{c}") for c in USER])
    new = _first_days(sessions).join(theirs, _same(USER, [f"_{c}" for c in USER]), "left_anti")
    last = numbers.agg(F.coalesce(F.max("user_no"), F.lit(0)).alias("last")).scalar()
    added = dense_index(new, ["day", *USER], name="user_no").select(*USER, (F.col("user_no") + last).alias("user_no"))
    return numbers.select(*USER, "user_no").unionByName(added)


def day_bitmaps(sessions: DataFrame, numbers: DataFrame, by: Sequence[str] = ("media_key",)) -> DataFrame:
    """``day, *by, bucket, users``: the users of each day and key as bitmaps of 4 KB.

    Sessions shrink to distinct (day, key, user) map-side before they meet the
    numbers, on the whole user key, so no media key is one task.
    """
    keys = list(dict.fromkeys(["day", *by, *USER]))
    seen = sessions.where(F.col("uid").isNotNull() & F.col("day").isNotNull()).select(*keys).distinct()
    named = numbers.select(*[F.col(c).alias(f"_{c}") for c in USER], "user_no")
    return (
        seen.join(named, _same(USER, [f"_{c}" for c in USER]))
        .groupBy("day", *by, F.bitmap_bucket_number("user_no").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("users"))
    )


def range_users(bitmaps: DataFrame, start: str, end: str, by: Sequence[str] = ("media_key",)) -> DataFrame:
    """``*by, users, returning_users, new_users`` of the days ``[start, end)``.

    Returning users were also seen on a day before ``start``. Keys without
    users in the range are left out.
    """
    day, first, stop = F.col("day"), F.to_date(F.lit(start)), F.to_date(F.lit(end))
    rows = bitmaps.where(day < stop)
    per = rows.groupBy(*by, "bucket").agg(
        F.bitmap_or_agg(F.when(day >= first, F.col("users"))).alias("now"),
        F.bitmap_or_agg(F.when(day < first, F.col("users"))).alias("before"),
        F.bitmap_or_agg("users").alias("both"),
    )
    return _counts(per, by)


def weekly_users(bitmaps: DataFrame, by: Sequence[str] = ("media_key",)) -> DataFrame:
    """``week, *by, users, returning_users, new_users`` of every week (from Monday) with users.

    One OR per week, then a running OR over the weeks of a key's bitmap row:
    a window of as many rows as there are weeks.
    """
    week = F.to_date(F.date_trunc("week", F.col("day"))).alias("week")
    weeks = bitmaps.groupBy(week, *by, "bucket").agg(F.bitmap_or_agg("users").alias("now"))
    upto = Window.partitionBy(*by, "bucket").orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by, "bucket").orderBy("week").rowsBetween(Window.unboundedPreceding, -1)
    per = weeks.withColumns({"both": F.bitmap_or_agg("now").over(upto), "before": F.bitmap_or_agg("now").over(earlier)})
    return _counts(per, ["week", *by])


def _counts(per: DataFrame, by: Sequence[str]) -> DataFrame:
    size = lambda c: F.coalesce(F.sum(F.bitmap_count(c)), F.lit(0))
    users, before, both = size("now"), size("before"), size("both")
    return (
        per.groupBy(*by)
        .agg(users.alias("users"), (users + before - both).alias("returning_users"), (both - before).alias("new_users"))
        .where("users > 0")
    )
