"""Stored daily hour counts against scores of the visits themselves."""

import os

import pytest
from pyspark.sql import functions as F

from adsentry.operators import hour_profile
from adsentry.plans import hour_store
from adsentry.plans.blacklist import build_blacklist
from adsentry.sources import fixtures as fx
from adsentry.sources import versioned

from conftest import SF_MID, SF_SMALL, rows

COLS = ("ip", "size", "flag", "coef")


def between(visits, start, end):
    return visits.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))


@pytest.mark.parametrize("metric", ["mse", "pearson"])
def test_any_range_equals_a_full_run(spark, scratch, metric):
    visits, path = fx.visits(spark, SF_SMALL).select("ip", "ts"), os.path.join(scratch, "hours")
    # stored in pieces and out of order, one day twice
    for span in (("2024-01-10", "2024-01-15"), ("2024-01-01", "2024-01-10"), ("2024-01-12", "2024-01-13")):
        hour_store.store_days(visits, path, *span)
    for span in (("2024-01-01", "2024-01-15"), ("2024-01-09", "2024-01-12"), ("2024-01-04", "2024-01-05")):
        got = hour_store.range_deviation(spark, path, *span, metric=metric)
        assert rows(got, *COLS) == rows(hour_profile.ip_hour_deviation(between(visits, *span), metric), *COLS)
        assert got.count() > 0


def test_a_day_run_again_replaces_its_counts(spark, scratch):
    visits, path = fx.visits(spark, SF_SMALL).select("ip", "ts"), os.path.join(scratch, "hours")
    hour_store.store_days(visits, path, "2024-01-01", "2024-01-08")
    fewer = visits.where(F.col("ip") != fx.HEAVY_IP)
    hour_store.store_days(fewer, path, "2024-01-03", "2024-01-04")
    gone = (F.to_date("ts") == F.lit("2024-01-03").cast("date")) & ~F.coalesce(F.col("ip") != fx.HEAVY_IP, F.lit(False))
    expected = hour_profile.address_hour_counts(between(visits, "2024-01-01", "2024-01-08").where(~gone))
    assert rows(hour_store.range_counts(spark, path, "2024-01-01", "2024-01-08").select(*expected.columns)) == rows(expected)


def test_visits_are_not_read_and_other_days_are_pruned(spark, scratch):
    visits, path = fx.visits(spark, SF_SMALL).select("ip", "ts"), os.path.join(scratch, "hours")
    hour_store.store_days(visits, path, "2024-01-01", "2024-01-08")
    got = hour_store.range_deviation(spark, path, "2024-01-02", "2024-01-03")
    text = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    scans = [x for x in text.split("\n\n") if "Scan parquet" in x and "Location" in x]
    assert scans and all("PartitionFilters" in x and "2024-01-02" in x and "events" not in x for x in scans)


def test_blacklist_of_a_range(spark, scratch):
    visits, path = fx.visits(spark, SF_MID).select("ip", "ts"), os.path.join(scratch, "hours")
    span = ("2024-01-01", "2024-02-01")
    hour_store.store_days(visits, path, *span)
    got, want = hour_store.range_blacklist(spark, path, *span), build_blacklist(between(visits, *span))
    assert rows(got.candidates) == rows(want.candidates) and rows(got.blacklist) == rows(want.blacklist)
    assert rows(got.population) == rows(want.population)


def test_null_address_null_time_and_no_visits(spark, scratch):
    schema = "ip string, ts timestamp_ntz"
    some = spark.sql("SELECT * FROM VALUES (NULL, timestamp_ntz'2024-01-01 05:00:00'), ('1.2.3.4', NULL) AS t(ip, ts)")
    path = os.path.join(scratch, "hours")
    hour_store.store_days(some, path, "2024-01-01", "2024-01-02")
    assert rows(hour_store.range_counts(spark, path, "2024-01-01", "2024-01-02"), "ip", "size", "h05") == [(None, 1, 1)]
    hour_store.store_days(spark.createDataFrame([], schema), path, "2024-01-01", "2024-01-02")
    assert hour_store.range_deviation(spark, path, "2024-01-01", "2024-01-02").count() == 0
    assert versioned.read_table(spark, path).count() == 0
