"""Shapes that matter at scale: a hot key holding a third of all rows, many distinct values."""

import random

from pyspark.sql import functions as F

from adsentry.functions.quantile import exclusive_quantiles_frame
from adsentry.operators import hardware as hw
from adsentry.operators import hour_profile, subnet

from conftest import rows


def _hot_visits(spark, n=30000):
    # one address holds a third of all rows
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit("203.0.113.9"))
        .otherwise(F.format_string("10.%d.%d.%d", F.col("id") % 7, F.col("id") % 11, F.col("id") % 13))
        .alias("ip"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 37).cast("timestamp_ntz").alias("ts"),
    ).withColumn("orders", F.array(F.struct(F.col("ip").alias("view_ip"), F.col("ts").alias("view_ts"))))


def test_hot_ip_profile_exact(spark):
    v = _hot_visits(spark)
    got = {r.ip: r.size for r in hour_profile.ip_hour_deviation(v).collect()}
    assert got["203.0.113.9"] == 10000 and sum(got.values()) == 30000
    pv = {r.subnet: r.pv for r in subnet.subnet24_pv(v).collect()}
    assert pv["203.0.113"] == 10000


def test_hot_key_aggregations_are_partial(spark):
    v = _hot_visits(spark)
    plan = spark._jvm.PythonSQLUtils.explainString(hour_profile.ip_hour_deviation(v)._jdf.queryExecution(), "simple")
    assert "partial_count" in plan  # map-side combine before the shuffle keyed by ip
    pairs = hw.hardware_pairs(
        spark.range(3000).select(
            F.lit("A").alias("manufacturer"), F.lit("X").alias("model"), F.lit("1").alias("resolution"),
            (F.col("id") % 5).cast("string").alias("device_id"),
        )
    )
    assert rows(hw.hardware_uv(pairs)) == [("A", "X", "1", 5)]


def test_quantile_many_distinct_values(spark):
    rnd = random.Random(7)
    values = [rnd.random() for _ in range(100_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exclusive_quantiles_frame(df, "v", [0.25, 0.75, 0.95]).collect()[0]
    ordered = sorted(values)
    for i, p in enumerate([0.25, 0.75, 0.95]):
        # distinct values: the answer is the value with exactly ceil(p n) rows below it
        import math

        r = math.ceil(p * len(values))
        assert got[f"q{i}"] == ordered[r]
