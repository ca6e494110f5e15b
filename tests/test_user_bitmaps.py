"""User bitmap reports against distinct counts, for any range and any order of arrival."""

import datetime as dt
import random

from adsentry.operators import user_bitmaps as ub

SCHEMA = "media_key string, uid string, day date"


def sessions(spark, rows):
    return spark.createDataFrame([(m, u, d and dt.date(2024, 1, d)) for m, u, d in rows], SCHEMA)


def made(n=400, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "b", None]), rng.choice([None, *[f"u{i}" for i in range(40)]]), rng.choice([None, *range(1, 29)])) for _ in range(n)]


def expected(rows, start, end):
    out = {}
    for media in {m for m, u, d in rows}:
        mine = [(u, d) for m, u, d in rows if m == media and u is not None and d is not None]
        now, before = {u for u, d in mine if start <= d < end}, {u for u, d in mine if d < start}
        if now:
            out[media] = (len(now), len(now & before), len(now - before))
    return out


def test_any_range_equals_distinct_counts(spark):
    rows = made()
    df = sessions(spark, rows)
    bitmaps = ub.day_bitmaps(df, ub.user_numbers(df)).cache()
    for start, end in ((1, 29), (1, 2), (5, 6), (8, 15), (20, 20), (27, 29)):
        got = ub.range_users(bitmaps, f"2024-01-{start:02d}", f"2024-01-{end:02d}").collect()
        assert {r.media_key: (r.users, r.returning_users, r.new_users) for r in got} == expected(rows, start, end)
    bitmaps.unpersist()


def test_numbers_are_dense_and_stay_when_days_come_late(spark):
    rows = made()
    early, late = [r for r in rows if r[2] and r[2] % 2], [r for r in rows if r[2] and r[2] % 2 == 0]
    numbers = ub.user_numbers(sessions(spark, early))
    first = {(r.media_key, r.uid): r.user_no for r in numbers.collect()}
    assert sorted(first.values()) == list(range(1, len(first) + 1))
    both = ub.extend_numbers(numbers, sessions(spark, late))
    after = {(r.media_key, r.uid): r.user_no for r in both.collect()}
    assert sorted(after.values()) == list(range(1, len(after) + 1)) and {k: after[k] for k in first} == first
    # bitmaps of the days so far, and of those added, make up the same reports
    bitmaps = ub.day_bitmaps(sessions(spark, early), numbers).unionByName(ub.day_bitmaps(sessions(spark, late), both))
    got = ub.range_users(bitmaps, "2024-01-09", "2024-01-20").collect()
    assert {r.media_key: (r.users, r.returning_users, r.new_users) for r in got} == expected(rows, 9, 20)


def test_no_rows(spark):
    empty = sessions(spark, [])
    assert ub.weekly_users(ub.day_bitmaps(empty, ub.user_numbers(empty))).collect() == []


def test_more_users_than_a_bitmap_row_holds(spark):
    df = spark.range(70_000).selectExpr("'m' AS media_key", "cast(id AS string) AS uid", "date'2024-01-01' + cast(id % 14 AS int) AS day")
    bitmaps = ub.day_bitmaps(df, ub.user_numbers(df))
    assert bitmaps.select("bucket").distinct().count() == 3
    got = ub.weekly_users(bitmaps).orderBy("week").collect()
    assert [(r.users, r.returning_users) for r in got] == [(35_000, 0), (35_000, 0)]
