"""Days replaced in one step: a failure at any point leaves the old days whole."""

import datetime as dt

import pytest

from adsentry.sources import versioned

SCHEMA = "platform string, day date, n long"


def frame(spark, days, n, platform="p"):
    return spark.createDataFrame([(platform, dt.date(2024, 1, d), n) for d in days], SCHEMA)


def stored(spark, path):
    return sorted((r.platform, r.day.day, r.n) for r in versioned.read_table(spark, path).collect())


BY = ("platform", "day")


def replace(df, path, start, end, **kw):
    return versioned.replace_days(df, path, BY, f"2024-01-{start:02d}", f"2024-01-{end:02d}", **kw)


def test_days_are_replaced_and_emptied(spark, scratch):
    path = f"{scratch}/t"
    assert replace(frame(spark, (1, 2, 3, 4), 1), path, 1, 5) == 1
    assert replace(frame(spark, (2,), 2), path, 2, 4) == 2  # day 3 has no rows any more
    assert stored(spark, path) == [("p", 1, 1), ("p", 2, 2), ("p", 4, 1)]
    assert replace(frame(spark, (2,), 2), path, 2, 4) == 3  # once more: the same
    assert stored(spark, path) == [("p", 1, 1), ("p", 2, 2), ("p", 4, 1)]
    assert versioned.read_table(spark, path).schema.simpleString() == "struct<platform:string,day:date,n:bigint>"


def test_platforms_stay_apart(spark, scratch):
    path = f"{scratch}/t"
    replace(frame(spark, (1, 2), 1).union(frame(spark, (1, 2), 1, "q")), path, 1, 3)
    replace(frame(spark, (), 0), path, 1, 3, scope={"platform": ["q"]})
    assert stored(spark, path) == [("p", 1, 1), ("p", 2, 1)]
    with pytest.raises(ValueError):
        replace(frame(spark, (9,), 0), path, 1, 3)
    assert stored(spark, path) == [("p", 1, 1), ("p", 2, 1)]


@pytest.mark.parametrize("at", ["_partitions", "_commit"])
def test_failure_between_write_and_swap_leaves_the_old_days(spark, scratch, monkeypatch, at):
    path = f"{scratch}/t"
    replace(frame(spark, (1, 2), 1), path, 1, 3)
    with monkeypatch.context() as m:
        m.setattr(versioned, at, lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            replace(frame(spark, (1, 2), 2), path, 1, 3)
    assert stored(spark, path) == [("p", 1, 1), ("p", 2, 1)]
    assert versioned.vacuum(spark, path) == 1  # what the failed run wrote
    replace(frame(spark, (1, 2), 3), path, 1, 3)
    assert stored(spark, path) == [("p", 1, 3), ("p", 2, 3)]


def test_second_writer_fails_and_rows_may_come_from_the_table(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    replace(frame(spark, (1, 2), 1), path, 1, 3)
    old = versioned._latest(spark, path)
    replace(versioned.read_table(spark, path).withColumn("n", versioned.F.col("n") + 1), path, 1, 3)
    assert stored(spark, path) == [("p", 1, 2), ("p", 2, 2)]
    monkeypatch.setattr(versioned, "_latest", lambda *a: old)
    with pytest.raises(versioned.ReplaceConflict):
        replace(frame(spark, (1,), 9), path, 1, 3)
    monkeypatch.undo()
    assert stored(spark, path) == [("p", 1, 2), ("p", 2, 2)]


def test_no_table(spark, scratch):
    with pytest.raises(FileNotFoundError):
        versioned.read_table(spark, f"{scratch}/none")
